"""Newest-row and latest-version selection."""

import re
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from accesslens.functions import times
from accesslens.functions.keys import dashboard_session_key


def latest_version(df: DataFrame, keys: list, version_col: str) -> DataFrame:
    """One row per key, the one with the highest version (equal versions are interchangeable).

    Spark cuts each map task to one row per key before the shuffle, so a key with very many
    versions costs no more than any other.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(version_col).desc())
    ranked = df.withColumn("version_rank", F.row_number().over(order))
    return ranked.filter("version_rank = 1").drop("version_rank")


def latest_per_session(acct: DataFrame) -> DataFrame:
    """The newest accounting row of every session."""
    key = dashboard_session_key(F.col("id"), F.col("nas_ip"), F.col("acct_session_id"))
    order = Window.partitionBy("session_key").orderBy(F.desc("ts"), F.desc("id"))
    ranked = acct.withColumn("session_key", key).withColumn(
        "latest_rank", F.row_number().over(order)
    )
    return ranked.filter("latest_rank = 1").drop("latest_rank")


_DAY = re.compile(r"/dt=(\d{4}-\d{2}-\d{2})/")


def stored_days(df: DataFrame) -> list[date]:
    """The days that a stored table has directories for, newest first; none if it isn't laid out by day. Reads no
    data: the paths are those that a scan would list."""
    if "dt" not in df.columns:
        return []
    return sorted({date.fromisoformat(m.group(1)) for f in df.inputFiles() if (m := _DAY.search(f))}, reverse=True)


def newest_days(df: DataFrame, limit: int, day_of_order: str = "dt") -> DataFrame:
    """``df`` from the day on that its ``limit`` newest rows can't lie before; as it is, if all days are needed.

    Days are walked backwards, twice as many at a time, and their matching rows counted until there are enough. A row
    of a later day is newer, so earlier days needn't be read at all. Rows without a day come last.
    """
    days, reach = stored_days(df), 1
    while reach < len(days):
        part = df.filter(F.col(day_of_order) >= F.lit(days[reach - 1]))
        if part.select(F.lit(1)).limit(limit).count() >= limit:
            return part
        reach *= 2
    return df


def newest_value(df: DataFrame, ts: str) -> DataFrame:
    """One row with the largest ``ts``, from the newest day that has rows."""
    return newest_days(df, 1).agg(F.max(ts).alias(ts))


def newest(df: DataFrame, limit: int | None, ts: str = "ts", tie: str = "id") -> DataFrame:
    """The ``limit`` newest rows, newest first; all rows without a limit.

    A plain top-k sends ``limit`` rows from every task to one reducer, which at hundreds of
    thousands of scan tasks is a bottleneck. So a first pass over the time column alone counts rows
    per minute and finds the minute in which the k-th newest row lies. That bound is a scalar
    subquery, which Spark pushes into the Parquet scan, so the second pass reads only the newest
    row groups and the top-k sees about ``limit`` rows in all. Of a table stored by day only the newest days that
    have enough rows are read.
    """
    if limit is None:
        return df.orderBy(F.desc(ts), F.desc(tie))
    times.at_least(limit, 0, "limit")
    df = newest_days(df, limit)
    minute = times.bucket(F.col(ts), "1 minute").alias("minute")
    per_minute = df.groupBy(minute).agg(F.count("*").alias("n"))
    # One row per minute: the running total is bounded by the time range, not by the data.
    newer = F.sum("n").over(
        Window.orderBy(F.desc("minute")).rowsBetween(Window.unboundedPreceding, -1)
    )
    bound = (
        per_minute.withColumn("newer", newer)
        .filter(F.coalesce(F.col("newer"), F.lit(0)) < limit)
        .agg(F.min("minute").alias("since"))
    )
    recent = df.filter(F.col(ts) >= bound.scalar())
    return recent.orderBy(F.desc(ts), F.desc(tie)).limit(limit)
