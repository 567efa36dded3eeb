"""From a stream of captured packets to every table, one commit a micro-batch.

The packets of a turn are decoded once; authentication is paired, accounting is thinned out, freed of copies and
turned into deltas, with what each of these has to remember; detail, the unified events, the ten-minute rollups, the
account and session rollups and the stream's own counters are then staged under the micro-batch's name. All of
them become visible together, or none.
"""

from pyspark.sql import DataFrame, functions as F

from accesslens import constants as C
from accesslens.operators import accounting, decode, events, pairing, rollups
from accesslens.operators.rollups import Rollup
from accesslens.plans import ingest
from accesslens.sources import tables as detail
from accesslens.sources.store import TableSet
from accesslens.streaming.ordered import Step, Turn, counted, exchanged, thinned, unseen

AUTH_ROLLUPS = [
    rollups.STAT_10M, rollups.REASON_10M, rollups.NAS_10M, rollups.USER_10M, rollups.USER_MAC_10M,
    rollups.WIDE_10M, rollups.AUTH_STATES_10M,
]
ACCT_ROLLUPS = [rollups.ACCT_1H, rollups.ACCT_1H_BY_SESSION]


def packets(ports: list[int] | None = None, sample_s: int = C.INTERIM_INTERVAL_SECONDS, scale: int = C.COUNTER_SCALE) -> Step:
    """The step that :func:`ordered.in_order` runs over rows of captured packets, ``ts="pkt_time"``."""

    def step(ready: DataFrame, turn: Turn) -> None:
        decoded = turn.once(ingest.decode_stage(ready, ports))
        auth = turn.once(pairing.undecoded_packets(decoded))
        acct = turn.once(accounting.identifiable_accounting(decode.project_accounting(decoded)))
        control = accounting.identifiable_control(decode.project_control(decoded))
        pairs = turn.once(accounting.identifiable_auth(pairing.paired_records(exchanged(auth, turn))))
        _store(turn, pairs, thinned(acct, turn, sample_s, tie="seq"), control, scale)

    return step


def _store(turn: Turn, auth: DataFrame, acct: DataFrame, control: DataFrame, scale: int) -> None:
    log = turn.once(detail.to_auth_log(auth))
    turn.tables.stage(log, "auth_log", day="ts")
    turn.tables.stage(detail.to_acct_log(acct), "acct_log", day="ts")
    for spec in AUTH_ROLLUPS:
        turn.tables.stage(spec.partial(log), spec.name, day=next(iter(spec.keys)))

    def once(rows: DataFrame, ts: str, kind: str) -> DataFrame:
        return unseen(events.identify(rows), turn, ts, memory=f"seen_{kind}")

    new = turn.once(once(acct, "ts", "accounting"))
    deltas = turn.once(counted(new, turn, scale, tie="event_id"))
    turn.tables.stage(events.aaa_events(once(auth, "resp_ts", "auth"), deltas, once(control, "ts", "control")), "aaa_events", day="event_time")
    timed = deltas.withColumn("event_time", F.col("ts"))
    for spec in ACCT_ROLLUPS:
        turn.tables.stage(spec.partial(timed), spec.name, day=next(iter(spec.keys)))


def rollup(tables: TableSet, spec: Rollup) -> DataFrame:
    """A rollup as of all commits: partials folded on read. Its day ``dt`` stays a column, on which filters prune directories."""
    rows = tables.read(spec.name)
    by_day = spec.by_day()
    return rollups.final(by_day, by_day.merge(rows if "dt" in rows.columns else rows.withColumn("dt", F.lit(None).cast("date"))))


def compact(tables: TableSet, spec: Rollup, until) -> None:
    """Fold the partials of days before ``until`` into one commit."""
    tables.compact(spec.name, until, spec.merge, next(iter(spec.keys)))


def sessions(tables: TableSet) -> DataFrame:
    """Hourly traffic with the exact number of sessions, and the estimate of the stored sketches beside it."""
    keys = list(rollups.ACCT_1H.keys)
    exact = rollups.exact_sessions(rollup(tables, rollups.ACCT_1H_BY_SESSION).drop("dt"))
    sketched = rollup(tables, rollups.ACCT_1H).select(*keys, F.col("sessions").alias("sessions_estimate"))
    return exact.join(sketched, keys)
