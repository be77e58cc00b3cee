"""Writers of the text layouts that the readers take; Spark writes one file per partition."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_lines(df: DataFrame, line: Column, path: str, compression: str = "none") -> None:
    """One line per row: corpora, logs, questions, tagged sentences."""
    df.select(line.alias("value")).write.text(path, compression=compression)


def write_csv(df: DataFrame, path: str, header: bool = True, null: str = "", compression: str = "none") -> None:
    """CSV as the rating, tag, numeric and claim readers take it."""
    df.write.csv(path, header=header, nullValue=null, compression=compression)


def tagged_line(words: str = "words", tags: str = "tags") -> Column:
    """``words<TAB>tags``"""
    return F.concat(F.array_join(words, " "), F.lit("\t"), F.array_join(tags, " "))


def question_line(tokens: str = "tokens", first: str = "first", second: str = "second") -> Column:
    """``text ____ text : first/second``"""
    return F.concat(F.array_join(tokens, " "), F.lit(" : "), F.col(first), F.lit("/"), F.col(second))


def write_labelled_docs(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", label: str = "label",
    classes: Mapping[int, str] | None = None,
) -> None:
    """A folder for each class and a file for each document, written where its row is.

    ``path`` is one that every executor can write to. A file is written under a temporary
    name and moved, so a task that runs twice leaves one whole file.
    """
    names = dict(classes or {-1: "neg", 1: "pos"})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        for batch in batches:
            for key, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{root.rstrip('/')}/{names[label]}"
                files.create_dir(folder, recursive=True)
                draft = f"{folder}/.{uuid.uuid4().hex}"
                with files.open_output_stream(draft) as out:
                    out.write((text or "").encode())
                files.move(draft, f"{folder}/{key}.txt")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = df.select(F.col(key).cast("string"), F.col(text), F.col(label).cast("int"))
    rows.where(F.col(label).isin(list(names))).mapInArrow(write, "n long").agg(F.sum("n")).collect()
