"""From documents to packed batches: quality rules, near-duplicates, repeated passages, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableworks.llm import mixing, packing, quality, simhash, similar, suffix
from tableworks.llm.common import new_folder, stored, tidied, without_rows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the one with the smallest id; of these, no two with a similarity of 0.8.

    Fingerprints find what is nearly equal; five-word shingles, compared whole, the rest.
    What both find are ids; texts are read where they are and move once, if at all.
    """
    classes_to, gone_to = new_folder(spark, "classes"), new_folder(spark, "gone")
    with tidied(spark):
        classes = stored(simhash.near_duplicates(docs).select("key", "row", "keeper"), classes_to)
        same = classes.filter("not keeper").select("key", "row").distinct()
        gone = stored(same.unionByName(similar.copies(docs, without=same)).distinct(), gone_to)
    return without_rows(docs, gone, classes, "doc_id")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start in an earlier one too."""
    left = suffix.without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words each document gives to the mix, a row for each round."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long"))


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their bucket, batch and place."""
    return packing.pack(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("suffix dedup", repeated_passages),
    ("mixing", mix_sources),
    ("packing", length_buckets),
]

#: Hashes, permutations and the choice of boundaries have no SQL form; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{i}")
    return docs
