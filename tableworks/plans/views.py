"""Inputs of the named queries, made from the star-schema tables.

Each view stands for one of the file layouts the operators work on, and uses
every row and every text of its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableworks.functions import text as tx
from tableworks.functions.hashing import bucket
from tableworks.operators.corpus import document_lines
from tableworks.operators.split import hash_split
from tableworks.sources.readers import CLAIM_SCHEMA, LOG_SCHEMA

#: Name and type of each column of the claim file.
CLAIM_FIELDS = [tuple(f.split()) for f in CLAIM_SCHEMA.split(", ")]
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Text for one task: its n-grams are counted in memory, some 20 times as much.
TEXT_BYTES = 16 * 2**20


def busy(spark: SparkSession, sf: str, name: str, text: str | None = None) -> DataFrame:
    """A table that is parsed, hashed or trained on, not just counted.

    The test tables are one row group each, which no setting can split. Only such a table,
    with fewer splits than the session works on at once, is dealt out by row; one with a
    ``text`` also if a split would have more than ``TEXT_BYTES`` of it, since files are
    split by their compressed size.
    """
    rows, wanted = table(spark, sf, name), spark.sparkContext.defaultParallelism
    if text:
        wanted = max(wanted, -(-(rows.agg(F.sum(F.octet_length(text))).first()[0] or 0) // TEXT_BYTES))
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() < wanted else rows


def _cents(col: str):
    return F.round(F.col(col) * 100).cast("bigint")


def row_key():
    """Text key of a line item; all five members are needed for it to be unique."""
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return F.concat_ws(":", *parts, _cents("l_extendedprice"))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Access-log text lines, one per event; a value under 0.5 has a broken time."""
    event = F.col("event_type")
    suffix = F.when(event.isin("view", "click"), ".gif").otherwise(".html")
    path = F.concat(F.lit("/"), event, F.lit("/"), (F.col("user_id") % 20).cast("string"), suffix)
    stamp = F.when(F.col("value") < 0.5, F.lit("[broken")).otherwise(
        F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"))
    )
    size = F.when(event == "error", "-").otherwise(_cents("value").cast("string"))
    line = F.concat_ws(
        " ",
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.org")),
        F.lit("-"), F.lit("-"), stamp, F.lit("+0000]"),
        F.concat(F.lit('"GET '), path, F.lit(' HTTP/1.0"')),
        F.when(event == "error", "404").otherwise("200"), size,
    )
    return busy(spark, sf, "events").select(line.alias("value"))


def raw_log(spark: SparkSession, sf: str) -> DataFrame:
    fields = F.from_csv("value", LOG_SCHEMA.simpleString()[7:-1].replace(":", " "),
                        {"sep": " ", "quote": '"'})
    return log_lines(spark, sf).select(fields.alias("f")).select("f.*")


def numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a 0/1 label and a rule's score and prediction."""
    return busy(spark, sf, "lineitem").select(
        row_key().alias("row_key"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
    )


NUMERIC_FEATURES = ["quantity", "price", "discount", "tax", "line"]


def measured(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a 0/1 label that two features give, turned over for about one row in ten."""
    rule = F.col("quantity") / 50 + 6 * F.col("discount") > 0.805
    flipped = bucket("row_key", 77) % 10 == 0
    return numeric(spark, sf).drop("prediction").withColumn("label", (rule != flipped).cast("double"))


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as ratings: a part of the customer, one of the item, and a little of neither."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", row_key().alias("row_key")
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "row_key",
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (1 + (F.col("o_custkey") % 5) * 0.5 + (F.col("l_partkey") % 4) * 0.75 + (F.col("l_quantity") % 2) * 0.25).alias("rating"),
    )


def tag_scores(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return lines.groupBy(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("tag_id")).agg(
        F.avg(F.col("l_discount") * F.col("l_quantity")).alias("relevance")
    )


def tag_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("tag_id"), F.col("s_name").alias("tag")
    )


def assignment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_size").alias("cluster")
    )


def wide_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """Order keys as items, more of them than there are parts: many have no line."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("item"), F.dayofmonth("o_orderdate").alias("cluster")
    )


CLAIM_CATEGORIES = ["brand", "type", "priority", "linestatus"]
CLAIM_MEASURES = ["quantity", "price", "retail", "part_size"]


def claims(spark: SparkSession, sf: str) -> DataFrame:
    """Insurance-like rows; one part type is turned to NULL. Some of the large ones are paid."""
    # The key is made after the joins, of numbers that are smaller than its text.
    lines = busy(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_linestatus",
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_retailprice", "p_size")
    paid = (F.col("l_quantity") >= 30) & (F.col("l_discount") >= 0.09)
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            row_key().alias("row_key"),
            F.col("year").cast("string").alias("year"),
            F.col("p_brand").alias("brand"),
            F.nullif("p_type", F.lit("PROMO")).alias("type"),
            F.col("o_orderpriority").alias("priority"),
            F.col("l_linestatus").alias("linestatus"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.col("p_retailprice").alias("retail"),
            F.col("p_size").cast("double").alias("part_size"),
            F.when(paid, F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0).alias("label"),
        )
    )


def claim_file(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in the columns of the claim file; some categories are missing."""
    year = F.year("l_shipdate")
    made = {
        "Row_ID": F.col("l_orderkey").cast("int"), "Household_ID": F.col("l_partkey").cast("int"),
        "Vehiclhe": F.col("l_linenumber").cast("int"), "Calendar_Year": year.cast("string"), "Model_Year": (year - 10).cast("int"),
        "label": F.col("l_extendedprice") * F.col("l_discount"),
    }
    categories = [F.col("l_returnflag"), F.col("l_linestatus"), F.when(F.col("l_discount") > 0.03, F.col("l_returnflag"))]
    columns = []
    for i, (name, kind) in enumerate(CLAIM_FIELDS):
        value = made.get(name)
        if value is None:
            value = categories[int(name[3:]) % 3 - 1] if name.startswith("Cat") else F.col("l_returnflag")
            value = F.col("l_quantity") * (i % 5 + 1) if kind == "double" else value
        columns.append(value.cast(kind).alias(name))
    return busy(spark, sf, "lineitem").select(*columns)


CLAIM_CUT = 2000


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return busy(spark, sf, "documents", "text").select("doc_id", "text")


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have a quality label, as -1 or +1, with a hash split."""
    labels = table(spark, sf, "labels").select(
        "doc_id", (2 * F.col("quality") - 1).alias("label")
    )
    return hash_split(documents(spark, sf).join(labels, "doc_id"), "doc_id", [0.8, 0.2], 5)


def _sent_id(owner: str):
    return F.concat_ws(":", F.col(owner).cast("string"), F.col("line_no").cast("string")).alias("sent_id")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document as tokens without punctuation."""
    return document_lines(documents(spark, sf)).select(
        _sent_id("doc_id"), tx.sentence_tokens("line").alias("tokens")
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Fill-the-blank questions, two candidates each, from every benchmark line with a word.

    The third word (the last of shorter lines) is blanked. It stands against the sixth,
    or else the first other word of the line or of its text, or else a common word.
    """
    lines = table(spark, sf, "benchmark").select(
        "item_id", tx.split_blanks(F.lower("text")).alias("item"), F.posexplode(tx.lines("text")).alias("line_no", "line")
    )
    tokens = lines.select(_sent_id("item_id").alias("q_id"), "item", tx.split_blanks(F.lower("line")).alias("all")).where(
        F.size("all") >= 1
    ).withColumn("at", F.least(F.lit(3), F.size("all"))).withColumn("word", F.element_at("all", F.col("at")))
    other = F.filter(F.concat(F.slice("all", 6, 1), "all", "item"), lambda t: t != F.col("word"))
    common = F.when(F.col("word") == "the", "of").otherwise("the")
    tokens = tokens.withColumn("rival", F.coalesce(F.try_element_at(other, F.lit(1)), common))
    blanked = F.concat(
        F.slice("all", F.lit(1), F.col("at") - 1), F.array(F.lit(tx.BLANK)), F.slice("all", F.col("at") + 1, F.size("all"))
    )
    return tokens.select(
        "q_id", blanked.alias("tokens"),
        F.posexplode(F.array("word", "rival")).alias("cand_no", "cand"),
    ).withColumn("cand_no", F.col("cand_no") + 1)


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document with a tag per token by its shape.

    ``part`` 0 or 1 is a hash split of the documents.
    """

    def shape(t):
        capital = t.rlike(r"^\p{Lu}")
        return (
            F.when(t.rlike(r"[0-9_]"), "MISC")
            .when(~capital, "O")
            .when(F.length(t) >= 9, "ORG")
            .when(F.length(t) >= 5, "PER")
            .otherwise("LOC")
        )

    parted = hash_split(documents(spark, sf), "doc_id", [0.8, 0.2], 5)
    # Split before the lines are rows: the filter would have every line split once more.
    lines = parted.select("doc_id", "part", F.posexplode(F.transform(tx.lines("text"), tx.split_blanks)).alias("line_no", "words"))
    words = lines.select(_sent_id("doc_id"), "part", "words")
    return words.where(F.size("words") > 0).withColumn("tags", F.transform("words", shape))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )


def vector_questions(spark: SparkSession, sf: str) -> DataFrame:
    """For every vector: is the next one nearer or the one after it?"""
    ids = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"))
    return ids.select("id", (F.col("id") + 1).alias("a"), (F.col("id") + 2).alias("b"))
