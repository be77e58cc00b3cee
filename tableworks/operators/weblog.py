"""Web-log reports: parsing, weekday averages, most requested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

STAMP = "'['dd/MMM/yyyy:HH:mm:ss Z']'"
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def parse_access_log(raw: DataFrame, zone: str = "UTC", keep_bad: bool = False) -> DataFrame:
    """``host, ts, path, status, bytes`` from the eight raw text columns.

    ``ts`` is the wall-clock time in ``zone``. Rows whose time cannot be read are
    dropped unless ``keep_bad``, which leaves them with a NULL ``ts``.
    """
    stamp = F.concat_ws(" ", "stamp", "offset")
    instant = F.try_to_timestamp(stamp, F.lit(STAMP)).cast("timestamp_ntz")
    ts = F.convert_timezone(None, F.lit(zone), instant)
    # A filter on ts would be pushed below and parse every time stamp twice, which
    # is the costly part; unpacking a list of none or one parses it once.
    ts = ts.alias("ts") if keep_bad else F.explode(F.array_compact(F.array(ts))).alias("ts")
    return raw.select(
        "host",
        ts,
        F.get(F.split("request", " "), F.lit(1)).alias("path"),
        F.col("status").try_cast("int").alias("status"),
        F.col("bytes").try_cast("bigint").alias("bytes"),
    )


def parse_report(raw: DataFrame, zone: str = "UTC") -> DataFrame:
    """How many rows were read and how many of them have no readable time."""
    return parse_access_log(raw, zone, keep_bad=True).agg(
        F.count("*").alias("rows"), F.count_if(F.col("ts").isNull()).alias("dropped")
    )


def weekday_average(log: DataFrame, ts: str = "ts", complete: bool = True) -> DataFrame:
    """Requests per weekday, its number of different dates, and their ratio.

    Counted by date first: what is left to shuffle is one row per date and task.
    The limit cuts nothing; it lets the seven rows be sorted without a range sort.
    """
    by_date = log.groupBy(F.to_date(ts).alias("date")).agg(F.count("*").alias("n"))
    by_day = by_date.groupBy(F.date_format("date", "E").alias("weekday")).agg(
        F.sum("n").alias("requests"), F.count("date").alias("days")
    )
    order = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.col("weekday"))
    if complete:
        week = log.sparkSession.createDataFrame([(d,) for d in WEEKDAYS], "weekday string")
        by_day = by_day.join(week, "weekday", "right").na.fill(0, ["requests", "days"])
    return by_day.withColumn("average", F.try_divide("requests", "days")).orderBy(
        order
    ).limit(len(WEEKDAYS))


def top_values(df: DataFrame, col: str, like: str | None = None, k: int = 20) -> DataFrame:
    """The ``k`` commonest values, ties in value order."""
    kept = df.where(F.col(col).like(like)) if like else df
    return (
        kept.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value").limit(k)
    )
