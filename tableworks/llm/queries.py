"""The training-data queries: ``name -> function(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableworks.llm import (
    edits, extract, merkle, mixing, packing, pivots, quality, sharding, simhash, spelling, suffix, tokens, warc,
)
from tableworks.llm.common import new_folder

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_warc_archives(spark, sf):
    root = warc.write_archives(table(spark, sf, "pages").select("page_id", "url", "html"))
    return warc.read_archives(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_length_buckets(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack(docs).withColumnRenamed("key", "doc_id")


@query
def op3_token_counts(spark, sf):
    import public_tokenizers

    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op4_path_ratios(spark, sf):
    pages = extract.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query
def op5_suffix_repeats(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return suffix.remove_repeats(docs, keep_text=False).select("doc_id", *[F.col(f"r_{n}").alias(n) for n in names])


@query
def op6_simhash(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        F.col("key").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op7_mix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.taken_words(docs).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op8_virtual_slots(spark, sf):
    """Version 1 of the map places the records; version 2, edited for one shard more, is stored beside it."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    maps = new_folder(spark, "shard-maps")
    placed = sharding.shard_by_slots(docs, maps)
    edited = sharding.edit_map(spark, maps, 25).select("virtual_slot", F.col("shard").alias("shard_version_2"))
    return placed.join(F.broadcast(edited), "virtual_slot").select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "shard_version_2",
    )


@query
def op9_permutation_index(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return pivots.nearest(rows, rows.filter("vec_id % 50 = 0"))


@query
def op10_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"),
        F.col("q_n_symbols").alias("n_symbols"), F.col("q_n_dup_lines").alias("n_dup_lines"),
        F.col("q_n_repeat_words").alias("n_repeat_words"), F.col("q_base_failed").alias("base_failed"),
        F.col("q_kept").alias("kept"), F.array_join("q_failed", ",").alias("failed_rules"),
    )


@query
def op11_merkle_manifest(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    made = merkle.manifest(docs, more={"now": merkle.leaf([*map(F.col, ("doc_id", "source", "lang", "n_chars")), text])})
    made = made.withColumn("folded_root", merkle.folded(F.col("now"), F.col("path")))
    return made.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_spelling_variants(spark, sf):
    runs = spelling.runs(table(spark, sf, "documents").select("doc_id", "text"))
    return spelling.variants(spelling.counted(spelling.with_slips(runs, 199)))


@query
def op13_edit_fingerprints(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return edits.beside_next(docs).withColumnRenamed("key", "doc_id")
