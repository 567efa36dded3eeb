"""Micro-batches worked on in the order of event time, with nothing lost.

A stream's rows arrive out of order. Each micro-batch is split by the stored high-water mark, the latest event time
of the batches before it: rows more than the allowed delay behind it are *late* and go to a side table, with a count per
interval. The others wait until the mark has moved past them by the delay; then they can't be overtaken any more, and the
batch operators run over them together with the little that has to be remembered per key. Results, late rows,
counts, waiting rows and memory are one commit of a :class:`TableSet`, so a repeated batch changes nothing.

What is emitted and what lies in the side table are together all rows: ``flush`` ends a stream by emitting those still
waiting.
"""

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from accesslens.constants import (
    COUNTER_SCALE, DEDUP_HOURS, INTERIM_INTERVAL_SECONDS, PAIRING_TTL_SECONDS, SPAN_GAP_MINUTES,
)
from accesslens.functions import times
from accesslens.functions.keys import counter_session_key
from accesslens.functions.text import blank_to_null
from accesslens.operators import accounting, pairing
from accesslens.operators.rollups import Rollup, final
from accesslens.operators.spans import SPAN_KEYS, finish, span_pieces
from accesslens.sources.store import TableSet

LATE, LATE_COUNTS, WAITING = "late", "late_counts", "waiting"


@dataclass(frozen=True)
class Turn:
    """What a step sees: the tables, and between which event times its rows lie (after, up to)."""

    tables: TableSet
    after: datetime | None
    until: datetime | None
    def once(self, rows: DataFrame) -> DataFrame:
        """Rows that the turn reads several times: stored beside the tables and read again, so they survive executors
        and what follows has a short plan."""
        return self.tables.worked_out(rows)

    def memory(self, relation: str, schema: T.StructType) -> DataFrame:
        return self.tables.read(relation, schema)

    def passed(self, at: F.Column) -> F.Column:
        """Whether a time is behind the rows of this turn; always at the end of a stream."""
        return F.lit(True) if self.until is None else at <= times.ntz(self.until)

    def decided(self, at: F.Column) -> F.Column:
        """Whether a time lies in this turn."""
        inside = self.passed(at)
        return inside if self.after is None else inside & (at > times.ntz(self.after))


# A step stages its results and memory in ``turn.tables``.
Step = Callable[[DataFrame, Turn], None]


def _turn(step: Step, ready: DataFrame, turn: Turn) -> None:
    try:
        step(ready, turn)
    finally:
        turn.tables.tidy()


def take(rows: DataFrame, batch: object, tables: TableSet, step: Step, ts: str, delay: timedelta, interval: timedelta = timedelta(minutes=10)) -> None:
    """One micro-batch. Rows without a time are late, too."""
    if tables.has(batch):
        return
    tables.discard()
    mark = tables.mark()
    rows = rows.persist()
    try:
        high = rows.agg(F.max(ts)).first()[0]
        now = max((m for m in (mark, high) if m is not None), default=None)
        on_time = F.col(ts).isNotNull()
        if mark is not None:
            on_time &= F.col(ts) > times.ntz(mark - delay)
        late = rows.filter(~on_time)
        tables.stage(late, LATE)
        ms, width = times.epoch_ms(F.col(ts)), F.lit(int(interval.total_seconds() * 1000))
        # Not F.window: that leaves out rows without a time.
        counts = late.groupBy(times.from_epoch_ms(ms - F.pmod(ms, width)).alias("interval")).agg(F.count("*").alias("late_rows"))
        tables.stage(counts, LATE_COUNTS)
        open_ = tables.read(WAITING, rows.schema).unionByName(rows.filter(on_time))
        if now is None:
            tables.stage(open_, WAITING, replace=True)
        else:
            until = now - delay
            ready = F.col(ts) <= times.ntz(until)
            _turn(step, open_.filter(ready), Turn(tables, None if mark is None else mark - delay, until))
            tables.stage(open_.filter(~ready), WAITING, replace=True)
        tables.commit(batch, now)
    finally:
        rows.unpersist()


def flush(tables: TableSet, step: Step, delay: timedelta) -> None:
    """The end of a stream: rows that wait are worked on as if the mark had passed them."""
    if tables.has("flush"):
        return
    tables.discard()
    mark = tables.mark()
    waiting = tables.read(WAITING)
    _turn(step, waiting, Turn(tables, None if mark is None else mark - delay, None))
    tables.stage(waiting.limit(0), WAITING, replace=True)
    tables.commit("flush")


def in_order(stream: DataFrame, tables: TableSet, step: Step, checkpoint: str, ts: str = "ts", delay: timedelta = timedelta(minutes=10)) -> DataStreamWriter:
    """The stream through a step."""
    return stream.writeStream.foreachBatch(lambda rows, batch: take(rows, batch, tables, step, ts, delay)).option("checkpointLocation", checkpoint)


def late_counts(tables: TableSet) -> DataFrame:
    """Late rows per interval, over all batches."""
    return tables.read(LATE_COUNTS).groupBy("interval").agg(F.sum("late_rows").alias("late_rows"))


# --- Steps ----------------------------------------------------------------------------------------


def _remembered(turn: Turn, relation: str, fresh: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest remembered row of every key that occurs in ``fresh``. Memory is added to by every turn: a key's row
    is written when the key was seen, and read only for keys seen again."""
    known = turn.memory(relation, fresh.schema).join(fresh.select(*keys).distinct(), keys, "left_semi")
    rest = [c for c in fresh.columns if c not in keys]
    newest = known.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("row"))
    return newest.select(*keys, *[F.col("row")[c].alias(c) for c in rest]).select(*fresh.columns)


def _newest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("row")).select(*keys, *[F.col("row")[c].alias(c) for c in (*order, *rest)]).select(*rows.columns)


def counted(ready: DataFrame, turn: Turn, scale: int = COUNTER_SCALE, ts: str = "ts", tie: str = "id", memory: str = "counters") -> DataFrame:
    """Counter deltas. Remembers each counter's last record."""
    session = F.col("acct_session_id")
    key = counter_session_key(F.col("username"), F.col("nas_ip"), F.col("src_ip"), session)
    keyed = ready.filter(blank_to_null(session).isNotNull()).withColumn("counter", key)
    before = _remembered(turn, memory, keyed, ["counter"], [ts, tie])
    both = ready.withColumn("is_old", F.lit(False)).unionByName(before.drop("counter").withColumn("is_old", F.lit(True)))
    turn.tables.stage(_newest(keyed, ["counter"], [ts, tie]), memory)
    return accounting.accounting_deltas(both, scale, ts, tie).filter("NOT is_old").drop("is_old")


def thinned(ready: DataFrame, turn: Turn, interval_s: int = INTERIM_INTERVAL_SECONDS, ts: str = "ts", tie: str = "id", memory: str = "last_kept") -> DataFrame:
    """Interim updates thinned out. Remembers each session's last kept update."""
    keyed = ready.filter(accounting.sampled(ready)).withColumn("sampling_key", accounting.interim_key())
    before = _remembered(turn, memory, keyed, ["sampling_key"], [ts, tie])
    both = ready.withColumn("is_old", F.lit(False)).unionByName(before.drop("sampling_key").withColumn("is_old", F.lit(True)))
    kept = accounting.sample_interim(both, interval_s, ts, tie).filter("NOT is_old").drop("is_old")
    kept = turn.once(kept)
    again = kept.filter(accounting.sampled(kept)).withColumn("sampling_key", accounting.interim_key())
    turn.tables.stage(_newest(again, ["sampling_key"], [ts, tie]), memory)
    return kept


def exchanged(ready: DataFrame, turn: Turn, ttl_s: int = PAIRING_TTL_SECONDS, memory: str = "near_packets") -> DataFrame:
    """Every authentication request and response once, as :func:`pairing.auth_exchanges` gives it, from rows of
    :func:`pairing.auth_packets`. Remembers the packets of the last ``ttl_s``: a response is decided by the packet
    before it, a request when the time limit has passed."""
    both = turn.memory(memory, ready.schema).unionByName(ready)
    decided = F.when(F.col("request").isNull(), F.col("at")).otherwise(F.col("at") + F.expr(f"INTERVAL {ttl_s} SECOND"))
    near = both.limit(0) if turn.until is None else both.filter(F.col("at") > times.ntz(turn.until - timedelta(seconds=ttl_s)))
    turn.tables.stage(near, memory, replace=True)
    return pairing.auth_exchanges(both, ttl_s).filter(turn.decided(decided))


def unseen(ready: DataFrame, turn: Turn, ts: str = "ts", hours: int = DEDUP_HOURS, memory: str = "seen") -> DataFrame:
    """Rows whose ``event_id`` hasn't come within the horizon. Remembers ids by day, so that old days aren't read."""
    once = accounting.dedup_events(ready)
    once = turn.once(once)
    ids = once.select("event_id", F.col(ts).alias("seen_at"))
    known = turn.memory(memory, ids.schema)
    if turn.after is not None:
        since = turn.after - timedelta(hours=hours)
        known = known.filter(F.col("seen_at") > times.ntz(since))
        known = known.filter(F.col("dt") >= F.lit(since.date())) if "dt" in known.columns else known
    turn.tables.stage(ids, memory, day="seen_at")
    return once.join(known.select("event_id"), "event_id", "left_anti").select(*ready.columns)


def _staged(fn: Callable[..., DataFrame], out: str, day: str, **options) -> Step:
    return lambda ready, turn: turn.tables.stage(fn(ready, turn, **options), out, day=day)


def deltas(**options) -> Step:
    return _staged(counted, "deltas", options.get("ts", "ts"), **options)


def sample(**options) -> Step:
    return _staged(thinned, "sampled", options.get("ts", "ts"), **options)


def pair(**options) -> Step:
    return _staged(exchanged, "exchanges", "at", **options)


def rollup(spec: Rollup, width: timedelta = timedelta(minutes=10)) -> Step:
    """A rollup whose buckets are emitted once, when the mark has passed their end. Remembers open buckets."""
    bucket = next(iter(spec.keys))
    end = F.col(bucket) + F.expr(f"INTERVAL {int(width.total_seconds())} SECOND")

    def step(ready: DataFrame, turn: Turn) -> None:
        fresh = spec.partial(ready)
        both = turn.once(spec.merge(turn.memory(f"{spec.name}_open", fresh.schema), fresh))
        turn.tables.stage(final(spec, both.filter(turn.passed(end))), spec.name, day=bucket)
        turn.tables.stage(both.filter(~turn.passed(end)), f"{spec.name}_open", replace=True)

    return step


def spans(gap_minutes: int = SPAN_GAP_MINUTES) -> Step:
    """Event spans, each emitted once, when the mark has passed its end and the gap. An open span is remembered as one
    row, under its last piece."""
    pieces, gap = span_pieces(gap_minutes), F.expr(f"INTERVAL '{gap_minutes}' MINUTE")
    plain = {k: k for k in SPAN_KEYS}

    def step(ready: DataFrame, turn: Turn) -> None:
        fresh = pieces.partial(ready)
        both = pieces.merge(turn.memory("spans_open", fresh.schema), fresh)
        order = Window.partitionBy(*SPAN_KEYS).orderBy("piece")
        opens = F.coalesce(F.col("first_seen") - F.lag("last_seen").over(order) > gap, F.lit(True))
        numbered = both.withColumn("opens", opens.cast("int")).withColumn("span", F.sum("opens").over(order)).drop("opens")
        last = F.max("piece").over(Window.partitionBy(*SPAN_KEYS, "span"))
        folding = replace(pieces, keys={**plain, "span": "span", "piece": "piece"})
        folded = turn.once(folding.merge(numbered.withColumn("piece", last)).drop("span"))
        closed = turn.passed(F.col("last_seen") + gap)
        turn.tables.stage(finish(replace(pieces, keys={**plain, "piece": "piece"}), folded.filter(closed)).drop("piece"), "spans", day="first_seen")
        turn.tables.stage(folded.filter(~closed), "spans_open", replace=True)

    return step
