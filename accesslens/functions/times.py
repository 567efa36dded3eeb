"""Zone-free time arithmetic on TIMESTAMP_NTZ columns, and report windows.

Only operations that never consult the session time zone are used, so results do not depend on
how a cluster is configured.
"""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def _since_epoch(c: Column) -> Column:
    # Both sides are zone-free, so this is a plain difference of clock readings.
    return c - ntz(datetime(1970, 1, 1))


def epoch_ms(c: Column) -> Column:
    """Milliseconds since 1970-01-01 00:00 on the column's own clock."""
    return (_since_epoch(c) * 1000).cast("interval second").cast("bigint")


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the column's own clock."""
    return _since_epoch(c).cast("interval second").cast("bigint")


def from_epoch_ms(ms: Column) -> Column:
    """Inverse of :func:`epoch_ms`."""
    return ntz(datetime(1970, 1, 1)) + ms * F.expr("INTERVAL '0.001' SECOND")


def ntz(value: datetime) -> Column:
    """A literal TIMESTAMP_NTZ, independent of driver and session zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def instant(c: Column) -> Column:
    """The clock reading as an instant (ms), for watermarks, which Spark keeps on instants only."""
    return F.timestamp_millis(epoch_ms(c))


def from_instant(c: Column) -> Column:
    """Inverse of :func:`instant`."""
    return from_epoch_ms(F.unix_millis(c))


def to_ms_precision(c: Column) -> Column:
    return from_epoch_ms(epoch_ms(c))


def bucket(c: Column, width: str) -> Column:
    """Start of the tumbling window of ``width`` that holds ``c``."""
    return F.window(c, width).getField("start")


def bucket_10m(c: Column) -> Column:
    return bucket(c, "10 minutes")


def latency_ms(req: Column, resp: Column) -> Column:
    """Whole milliseconds from request to response, never negative; NULL if either is missing."""
    gap = epoch_ms(resp) - epoch_ms(req)
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0))).cast("int")


def parse_timestamp(c: Column, ingest_date: Column) -> Column:
    """Read ``yyyy-MM-dd HH:mm:ss.f`` or a bare ``HH:mm:ss.f`` taken to be on ``ingest_date``."""
    clock = r"\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}"
    full = F.when(c.rlike(rf"\A\d{{4}}-\d{{1,2}}-\d{{1,2}} {clock}\z"), c)
    today = F.when(
        c.rlike(rf"\A{clock}\z"), F.concat(ingest_date.cast("date").cast("string"), F.lit(" "), c)
    )
    return F.coalesce(full, today).try_cast("timestamp_ntz")


def slot_label(c: Column, seconds: int) -> Column:
    """Floor to a multiple of ``seconds`` and print as ``yyyy-MM-dd HH:mm``."""
    width = F.lit(seconds * 1000)
    floored = epoch_ms(c) - F.pmod(epoch_ms(c), width)
    return F.substring(from_epoch_ms(floored).cast("string"), 1, 16)


def at_least(value: int, least: int, name: str) -> int:
    """The number as it is; an error if it makes no sense, never another number."""
    if int(value) < least:
        raise ValueError(f"{name} must be {least} or more, not {value}")
    return int(value)


def window_start(now: datetime, hours: int, valid_from: datetime | None = None) -> datetime:
    """``hours`` before ``now`` at whole seconds, but not before ``valid_from``."""
    since = now - timedelta(hours=hours)
    if valid_from is not None:
        since = max(since, valid_from)
    return since.replace(microsecond=0)


def date_range(
    start: date | None, end: date | None, max_days: int | None = None
) -> tuple[datetime, datetime] | None:
    """Half-open time range for inclusive dates, swapped when reversed. Longer than ``max_days``: an error."""
    if start is None and end is None:
        return None
    low, high = sorted((start or end, end or start))
    if max_days is not None and (high - low).days >= max_days:
        raise ValueError(f"{low} to {high} is more than {max_days} days")
    midnight = datetime.min.time()
    return datetime.combine(low, midnight), datetime.combine(high + timedelta(days=1), midnight)


def in_report_window(
    c: Column,
    now: datetime,
    hours: int = 24,
    start: date | None = None,
    end: date | None = None,
    valid_from: datetime | None = None,
    max_days: int | None = None,
    day: Column | None = None,
) -> Column:
    """Predicate on literals only, so that it reaches the Parquet scan.

    ``day``, the date that a table is laid out by, is bounded too, so that other days aren't listed.
    """
    chosen = date_range(start, end, max_days)
    low, high = chosen or (window_start(now, hours, valid_from), None)
    inside = c >= ntz(low)
    if high is not None:
        inside = inside & (c < ntz(high))
    if day is not None:
        inside = inside & (day >= F.lit(low.date()))
        if high is not None:
            inside = inside & (day < F.lit(high.date()))
    return inside


def stored_day(df: DataFrame) -> Column | None:
    """The date that a stored table is laid out by, if it is."""
    return F.col("dt") if "dt" in df.columns else None
