"""Retention by age."""

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesslens.functions import times
from accesslens.sources.store import TableSet


def retain(
    df: DataFrame, ts_col: str, days: int, now: datetime, whole_days: bool = False
) -> DataFrame:
    """Rows that are not older than ``days``.

    Tables laid out by day lose whole days: the day of the cut-off itself stays. The filter is a
    literal, and on tables with a ``dt`` column it is repeated there so that old directories are
    not even listed.
    """
    cutoff = (now - timedelta(days=days)).replace(microsecond=0)
    if whole_days:
        cutoff = datetime.combine(cutoff.date(), datetime.min.time())
    kept = df.filter(F.col(ts_col) >= times.ntz(cutoff))
    if "dt" in df.columns:
        kept = kept.filter(F.col("dt") >= F.lit(cutoff.date()))
    return kept


def retain_tables(found: TableSet, days: dict[str, int], now: datetime, ts: dict[str, str] | None = None) -> None:
    """Keep each table of a set for its own number of days, to the second: whole days leave the log, and the day of
    the cut-off is written anew without its older rows. Readers see a table before or after, never in between."""
    for relation, kept in days.items():
        cutoff = (now - timedelta(days=kept)).replace(microsecond=0)
        found.retain(relation, cutoff, (ts or {}).get(relation, "ts"))


def drop_days(spark: SparkSession, path: str, days: int, now: datetime) -> list[date]:
    """Delete the day directories of a stored table that lie wholly before the cut-off; returns
    their days. Only ``dt=YYYY-MM-DD`` directories directly below ``path`` are ever touched, and no
    data is read. Deleting again does nothing, so an interrupted run can be repeated."""
    cutoff = (now - timedelta(days=days)).date()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if not (status.isDirectory() and name.startswith("dt=")):
            continue
        try:
            day = date.fromisoformat(name.removeprefix("dt="))
        except ValueError:  # rows without a day
            continue
        if day < cutoff:
            if not files.delete(status.getPath(), True):
                raise OSError(f"could not delete {status.getPath()}")
            dropped.append(day)
    return sorted(dropped)
