"""Readers for the file layouts the library works on."""

from tableworks.sources.readers import (  # noqa: F401
    read_access_log,
    read_claims,
    read_corpus,
    read_labelled_docs,
    read_numeric_csv,
    read_questions,
    read_ratings,
    read_report,
    read_tag_scores,
    read_tagged,
    read_tags,
)
