"""Column helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, functions as F

from tableworks.session import shared_folder

#: ASCII white space; everything else belongs to words.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def remove(spark, *paths: str) -> None:
    """Delete written folders on whatever file system they are."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


_scopes: list[list[str]] = []


@contextmanager
def tidied(spark) -> Iterator[None]:
    """Folders named inside by ``new_folder`` are deleted at the end; store results elsewhere before."""
    mine: list[str] = []
    _scopes.append(mine)
    try:
        yield
    finally:
        _scopes.remove(mine)
        remove(spark, *mine)


def new_folder(spark, name: str) -> str:
    """The name of a new folder that every executor can reach."""
    import uuid

    path = f"{shared_folder(spark).rstrip('/')}/tableworks/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


def stored(df: DataFrame, path: str, **options: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a table that a join may send to every executor.
SENT = 2**17


def looked_up(rows: DataFrame, few: DataFrame, on, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``few``, a table that is cheap to count; it is sent whole up to ``SENT`` rows and else sorted.

    The planner knows a table by its compressed files and takes an explode for no larger than
    what it is made of; left to itself, it sends either side, however many rows it has.
    """
    return rows.join(F.broadcast(few) if few.count() <= SENT else few.hint("merge"), on, how)


#: Rows are known by key and hash; this many slots of hashes are broadcast, whatever the data.
SLOTS = 2**18


def row_of(documents: DataFrame, key: str) -> tuple[Column, Column]:
    """The key of a row as a number, and a hash of the whole row."""
    return F.col(f"`{key}`").cast("long"), F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns])


def without_rows(documents: DataFrame, gone: DataFrame, each: DataFrame, key: str) -> DataFrame:
    """``documents`` without the rows ``gone`` (``key, row``); of equal rows one is kept.

    ``each`` has ``key, row`` of all documents.  Only documents that may be gone or repeated,
    by the slot of their hash, are shuffled; the slots are at most ``SLOTS`` numbers.  The
    caller's columns travel as one struct and may have any name.
    """
    again = each.groupBy("key", "row").agg(F.count("*").alias("n")).filter("n > 1").select("key", "row")
    asked = gone.select("key", "row").unionByName(again)
    slots = F.broadcast(asked.select(F.pmod("row", F.lit(SLOTS)).alias("slot")).distinct())
    number, row = row_of(documents, key)
    own = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"), number.alias("key"), row.alias("row"))
    own = own.withColumn("slot", F.pmod("row", F.lit(SLOTS)))
    kept = own.join(slots, "slot", "left_anti").select("own.*")
    maybe = own.join(slots, "slot", "left_semi").drop("slot")
    same = maybe["key"].eqNullSafe(gone["key"]) & (maybe["row"] == gone["row"])
    return kept.union(looked_up(maybe, gone, same, "left_anti").dropDuplicates(["key", "row"]).select("own.*"))
