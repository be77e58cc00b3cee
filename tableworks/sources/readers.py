"""File readers with explicit schemas: no inference pass over the data.

A gzip file is one partition whatever its size, so the readers that meet them
take ``partitions``. Other files split by ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableworks.functions import text as tx

LOG_FIELDS = ["host", "ident", "user", "stamp", "offset", "request", "status", "bytes"]
LOG_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in LOG_FIELDS])

# The columns of the insurance-claim file.
CLAIM_INTS = ["Row_ID", "Household_ID", "Vehiclhe"]
CLAIM_CATEGORIES = (
    ["Blind_Make", "Model_Year"] + [f"Cat{i}" for i in range(1, 13)] + ["OrdCat", "NVCat"]
)
CLAIM_MEASURES = [f"Var{i}" for i in range(1, 9)] + [f"NVVar{i}" for i in range(1, 5)]
CLAIM_SCHEMA = (
    "Row_ID int, Household_ID int, Vehiclhe int, Calendar_Year string, Model_Year int, "
    "Blind_Make string, Blind_Model string, Blind_Submodel string, "
    + "".join(f"Cat{i} string, " for i in range(1, 13))
    + "OrdCat string, "
    + "".join(f"Var{i} double, " for i in range(1, 9))
    + "NVCat string, "
    + "".join(f"NVVar{i} double, " for i in range(1, 5))
    + "label double"
)

# The columns of the particle-event file.
PARTICLE_FEATURES = [f"low_{i}" for i in range(1, 22)] + [f"high_{i}" for i in range(1, 8)]


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def _below(spark: SparkSession, path: str):
    """The path of a row's file below the folder that is read (whole, if a pattern is read)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().toString()
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    file, prefix = plain(F.col("file")), plain(F.lit(root.rstrip("/") + "/"))
    return F.when(F.startswith(file, prefix), F.substr(file, F.length(prefix) + 1)).otherwise(file)


def read_access_log(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Space-delimited, quoted access log as eight text columns."""
    raw = spark.read.csv(path, schema=LOG_SCHEMA, sep=" ", quote='"')
    return _spread(raw, partitions)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``userId, movieId, rating``; further columns of the file are left out."""
    schema = "userId int, movieId int, rating double, timestamp bigint"
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True).drop("timestamp")


def read_tag_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="movieId int, tagId int, relevance double", header=True)


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema="tagId int, tag string", header=True)


def read_numeric_csv(
    spark: SparkSession, path: str, names: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Headerless CSV of doubles."""
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    return _spread(spark.read.csv(path, schema=schema), partitions)


def read_claims(
    spark: SparkSession, path: str, null: str = "?", partitions: int | None = None
) -> DataFrame:
    return _spread(
        spark.read.csv(path, schema=CLAIM_SCHEMA, header=True, nullValue=null), partitions
    )


def read_labelled_docs(
    spark: SparkSession, path: str, classes: Mapping[str, int] | None = None
) -> DataFrame:
    """A tree of text files, one document each, its class the folder it is in.

    ``doc_id`` is the path below ``path``.
    """
    classes = classes or {"neg": -1, "pos": 1}
    folder = F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    label = F.coalesce(*[F.when(folder == c, F.lit(v)) for c, v in classes.items()])
    return (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
        .select(
            _below(spark, path).alias("doc_id"),
            "text",
            label.alias("label"),
        )
        .where(F.col("label").isNotNull())
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """One sentence per line: ``sent_id, tokens``."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("sent_id"),
        tx.sentence_tokens("value").alias("tokens"),
    )


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """``text with ____ : first/second`` as one row per candidate.

    Columns ``q_id, tokens, cand_no, cand``; ``cand_no`` starts at 1.
    """
    parts = F.filter(F.split(F.lower("value"), ":"), lambda p: p != "")
    return (
        spark.read.text(path)
        .select(F.monotonically_increasing_id().alias("q_id"), parts.alias("parts"))
        .where(F.size("parts") >= 2)
        .select(
            "q_id",
            tx.split_blanks(F.col("parts")[0]).alias("tokens"),
            F.posexplode(F.split(F.trim(F.col("parts")[1]), "/")).alias("cand_no", "cand"),
        )
        .withColumn("cand_no", F.col("cand_no") + 1)
    )


def read_report(spark: SparkSession, path: str, form: str) -> DataFrame:
    """``lines, read``: how many lines there are and how many ``read_questions``
    (``form='questions'``) or ``read_tagged`` (``form='tagged'``) makes rows of."""
    parts = {
        "questions": F.size(F.filter(F.split("value", ":"), lambda p: p != "")) >= 2,
        "tagged": F.size(F.split("value", "\t")) == 2,
    }
    return spark.read.text(path).agg(
        F.count("*").alias("lines"), F.count(F.when(parts[form], 1)).alias("read")
    )


def read_tagged(
    spark: SparkSession,
    path: str,
    token_vocab: DataFrame | None = None,
    tag_vocab: DataFrame | None = None,
    form: str = "arrays",
) -> DataFrame:
    """Lines of ``words<TAB>tags``.

    ``form``: ``arrays`` (``sent_id, words, tags``), ``words``, ``tags``, or
    ``rows`` (``sent_id, pos, word, tag``). With vocabularies (``word, ix`` and
    ``tag, ix``) the row form gains ``word_ix`` and ``tag_ix``.
    """
    parts = F.split("value", "\t")
    arrays = spark.read.text(path).where(F.size(parts) == 2).select(
        F.monotonically_increasing_id().alias("sent_id"),
        tx.split_blanks(parts[0]).alias("words"),
        tx.split_blanks(parts[1]).alias("tags"),
    )
    if form == "arrays":
        return arrays
    if form in ("words", "tags"):
        return arrays.select("sent_id", form)
    return tagged_rows(arrays, token_vocab, tag_vocab)


def tagged_rows(
    arrays: DataFrame, token_vocab: DataFrame | None = None, tag_vocab: DataFrame | None = None
) -> DataFrame:
    """Aligned words and tags as rows; the longer of two unequal lists is cut."""
    shared = F.least(F.size("words"), F.size("tags"))
    zipped = F.arrays_zip(
        F.slice("words", 1, shared).alias("word"), F.slice("tags", 1, shared).alias("tag")
    )
    rows = arrays.select("sent_id", F.posexplode(zipped).alias("pos", "pair")).select(
        "sent_id", "pos", F.col("pair.word").alias("word"), F.col("pair.tag").alias("tag")
    )
    if token_vocab is not None:
        rows = rows.join(token_vocab.select("word", F.col("ix").alias("word_ix")), "word", "left")
    if tag_vocab is not None:
        rows = rows.join(tag_vocab.select("tag", F.col("ix").alias("tag_ix")), "tag", "left")
    return rows
