"""The table of stream counters: a row per interval and collector, of which the newest version counts.

Counters are worked out anew when late packets arrive. A new version is appended, never merged into what is
stored; reading picks the newest per key, within the days asked for. Closed days are replaced by their newest
versions, a day's rows by that day's only.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from accesslens.functions import times
from accesslens.operators.latest import latest_version
from accesslens.sources.store import TableSet

RELATION, KEYS, VERSION = "collector_metrics", ["metric_time", "event_id"], "ingested_at"


def record(found: TableSet, counters: DataFrame, batch: object, at: datetime, collector: str = "") -> bool:
    """Append counters (one row per ``metric_time``) as the version of the time ``at``. A batch delivered again
    changes nothing; returns whether it was new."""
    if found.has(batch):
        return False
    interval = F.date_format("metric_time", "yyyy-MM-dd HH:mm:ss.SSS")
    rows = counters.withColumns({
        "event_id": F.sha2(F.concat_ws("|", F.lit("metrics"), F.lit(collector), interval), 256),
        VERSION: times.ntz(at),
    })
    found.stage(rows, RELATION, day="metric_time")
    found.commit(batch)
    return True


def current(found: TableSet, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The newest version of each row whose interval begins in [since, until). All versions of a row lie in one day, so
    only days of the range are read."""
    rows, at = found.read(RELATION), F.col("metric_time")
    if since is not None:
        rows = rows.filter((F.col("dt") >= F.lit(since.date())) & (at >= times.ntz(since)))
    if until is not None:
        rows = rows.filter((F.col("dt") <= F.lit(until.date())) & (at < times.ntz(until)))
    return latest_version(rows, KEYS, VERSION).drop("dt")


def compact(found: TableSet, until: date) -> None:
    """Replace the days before ``until`` by their newest versions."""
    found.compact(RELATION, until, lambda rows: latest_version(rows, KEYS, VERSION), "metric_time")
