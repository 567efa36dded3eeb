"""Sinks: appended detail, newline-delimited JSON, CSV export and rollup storage."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesslens.operators.latest import newest
from accesslens.operators.rollups import Rollup, final
from accesslens.sources.tables import with_partition


def append(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Append to a table laid out by day. Rows of a file are ordered by account and time, which
    keeps the row-group ranges of account queries narrow."""
    keys = [c for c in ("username", ts) if c in df.columns]
    day = with_partition(df, ts).sortWithinPartitions("dt", *keys)
    day.write.mode("append").partitionBy("dt").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 1000, **options) -> None:
    """Append to a relational table in insert batches."""
    df.write.mode("append").option("batchsize", batch_rows).options(**options).jdbc(url, table)


def write_ndjson(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line, gzip compressed, every column present."""
    df.write.mode(mode).option("compression", "gzip").option("ignoreNullFields", False).json(path)


def export_csv(auth: DataFrame, path: str, limit: int | None = 1000) -> None:
    """The newest records as CSV with a header: one file, or several in order if all rows are asked for."""
    rows = newest(auth, limit)
    # To whole seconds, printed like "2024-01-31 23:59:59".
    shown = F.substring(F.col("ts").cast("string"), 1, 19)
    out = rows.select(
        shown.alias("ts"), shown.alias("first_seen"), shown.alias("last_seen"),
        F.lit(1).alias("request_count"), "username", "raw_username", "result", "reason_zh",
        "mac_addr", "nas_ip", "nas_identifier", "nas_port_id", "nas_port_type", "nas_port",
        "latency_ms", "reply_msg",
    )
    # A limit already brought the rows into one partition; without one, files follow each other in order.
    out = out if limit is None else out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def store_partial(partial: DataFrame, path: str, batch_id: int | str, bucket: str = "bucket_start") -> None:
    """Add one batch of rollup partials under its own directory of each day.

    Writing the same batch again replaces exactly what it wrote before, so retried micro-batches
    do not count twice, and late rows simply land in the directories of their day.
    """
    rows = with_partition(partial, bucket).withColumn("batch", F.lit(str(batch_id)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "dt", "batch"
    ).parquet(path)


def load_partials(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """Stored partials with their day ``dt``, on which filters prune directories."""
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.filter(F.col("dt") >= F.lit(since))
    return rows.drop("batch")


def load_rollup(spark: SparkSession, path: str, rollup: Rollup, since: date | None = None) -> DataFrame:
    """The rollup as of all stored batches: partials folded on read. Its day ``dt`` stays a column, so the range of a
    report reaches the directories."""
    by_day = rollup.by_day()
    return final(by_day, by_day.merge(load_partials(spark, path, since)))


def compact_rollup(spark: SparkSession, source: str, target: str, rollup: Rollup, bucket: str = "bucket_start") -> None:
    """Fold all stored batches into one, in a new place, for readers to switch to."""
    store_partial(rollup.merge(load_partials(spark, source).drop("dt")), target, "compacted", bucket)
