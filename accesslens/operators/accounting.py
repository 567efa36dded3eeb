"""Accounting records: identification, de-duplication, down-sampling and counter deltas."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from accesslens.constants import (
    ACCT_DEVICE_STATUSES, ACCT_INTERIM, ACCT_START, ACCT_STOP, COUNTER_SCALE,
    INTERIM_INTERVAL_SECONDS, SESSION_STATE_DAYS, UNMATCHED_USER,
)
from accesslens.functions import times
from accesslens.functions.counters import octet_total
from accesslens.functions.keys import counter_session_key, event_id
from accesslens.functions.text import blank_to_null, is_business_account, or_else, text


def _named_user() -> Column:
    return text(F.col("username")).isin("", UNMATCHED_USER) == F.lit(False)


def identifiable_auth(auth: DataFrame) -> DataFrame:
    """Authentication records whose account name was recognised."""
    return auth.filter(_named_user())


def identifiable_accounting(acct: DataFrame) -> DataFrame:
    """Accounting records of known accounts, and device on/off reports of known devices."""
    return acct.filter(known_accounting())


def known_accounting() -> Column:
    device = F.col("acct_status_type").isin(ACCT_DEVICE_STATUSES)
    known_device = or_else(F.col("nas_ip"), F.col("src_ip")).isNotNull()
    return F.when(F.coalesce(device, F.lit(False)), known_device).otherwise(_named_user())


def identifiable_control(control: DataFrame) -> DataFrame:
    """Control records that name an account, a session, a terminal or an access server."""
    return control.filter(known_control())


def known_control() -> Column:
    other = or_else(F.col("acct_session_id"), F.col("mac_addr"), F.col("nas_ip"))
    return _named_user() | other.isNotNull()


def business_only(df: DataFrame) -> DataFrame:
    return df.filter(is_business_account(F.col("username")))


def with_event_id(df: DataFrame) -> DataFrame:
    return df.withColumn("event_id", event_id(df))


def dedup_events(df: DataFrame) -> DataFrame:
    """One row per ``event_id``. Copies are folded on the map side before the shuffle, so a record
    that was delivered very often costs one row per task."""
    return df.dropDuplicates(["event_id"])


# --- Interim down-sampling --------------------------------------------------------------------

# A chunk holds at most one entry per millisecond once equal times are folded, so two hours bound
# the array of one chunk whatever the number of rows.
_CHUNK_MS = 2 * 3600 * 1000


def interim_key() -> Column:
    place = text(or_else(F.col("nas_ip"), F.col("src_ip")))
    who = or_else(*[F.col(c) for c in ("acct_session_id", "username", "framed_ip", "mac_addr")])
    # NULL when there is nothing to tell sessions apart by.
    return F.when(who.isNotNull(), F.concat_ws("|", place, who))


def sample_interim(
    acct: DataFrame, interval_s: int = INTERIM_INTERVAL_SECONDS, ts: str = "ts", tie: str = "id",
    chunk_ms: int = _CHUNK_MS,
) -> DataFrame:
    """Thin out interim updates: of each session keep the first, then always the next one that is
    at least ``interval_s`` after the last one kept. Other records pass. ``tie`` must be unique.

    The rule is greedy, so whether a row stays depends on all rows before it. To spread one busy
    session over many tasks its time line is cut into chunks. Each chunk is first summarised as a
    step function "may keep again from" -> "may keep again from after this chunk". The functions are
    composed level by level into those of longer and longer spans; going back down, each span's start
    gives the starts of its parts, and chunks are thinned out independently.

    At most one row per session and slot of the interval's length stays, so a row meets its verdict
    by session and slot.
    """
    if interval_s <= 0:
        return acct
    interval = int(interval_s) * 1000
    slot = F.floor(F.col("ms") / interval).cast("bigint")
    kept = kept_interims(acct, interval_s, ts, tie, chunk_ms).select(
        F.col("key").alias("kept_key"), slot.alias("kept_slot"), F.col(tie).alias("kept_tie")
    )
    own = F.floor(times.epoch_ms(F.col(ts)) / interval).cast("bigint")
    # Rows that aren't subject to the rule meet nothing; they are spread by their own number.
    met = (F.col("kept_key") == F.when(sampled(acct), interim_key()).otherwise(F.lit(""))) & (
        F.col("kept_slot") == F.when(sampled(acct), own).otherwise(F.xxhash64(F.col(tie)))
    )
    stays = ~sampled(acct) | F.coalesce(F.col("kept_tie") == F.col(tie), F.lit(False))
    return acct.join(kept, met, "left").filter(stays).select(*acct.columns)


def sampled(acct: DataFrame) -> Column:
    """Whether a row is subject to down-sampling."""
    interim = (F.col("acct_status_type") == ACCT_INTERIM) & interim_key().isNotNull()
    return F.coalesce(interim, F.lit(False))


def kept_interims(
    acct: DataFrame, interval_s: int = INTERIM_INTERVAL_SECONDS, ts: str = "ts", tie: str = "id",
    chunk_ms: int = _CHUNK_MS,
) -> DataFrame:
    """Key, time (epoch ms) and tie of the interim updates that stay."""
    slim = acct.filter(sampled(acct)).select(
        interim_key().alias("key"), times.epoch_ms(F.col(ts)).alias("ms"), F.col(tie).alias("tie")
    )
    return greedily_kept(slim, interval_s, chunk_ms).withColumnRenamed("tie", tie)


def greedily_kept(slim: DataFrame, interval_s: int, chunk_ms: int = _CHUNK_MS) -> DataFrame:
    """Of rows (key, ms, tie) those that stay."""
    interval = int(interval_s) * 1000
    # Of rows at the same time only the first can stay.
    distinct = slim.groupBy("key", "ms").agg(F.min("tie").alias("tie"))
    chunk = F.floor(F.col("ms") / chunk_ms).cast("bigint")
    chunks = distinct.groupBy("key", chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("ms", "tie"))).alias("rows")
    )
    starts = _chunk_starts(chunks.select("key", "chunk", F.col("rows.ms").alias("ms")), interval, chunk_ms)
    entry = f"struct<ms: bigint, tie: {slim.schema['tie'].dataType.simpleString()}>"
    kept = F.expr(
        f"""aggregate(rows, named_struct('resume', resume, 'kept', cast(array() AS array<{entry}>)),
          (s, r) -> if(r.ms >= s.resume,
            named_struct('resume', r.ms + {interval}L, 'kept', array_append(s.kept, r)), s),
          s -> s.kept)"""
    )
    return chunks.join(starts, ["key", "chunk"]).select("key", F.inline(kept))


# Chunks of a span, and how many levels of spans there are: with chunks of two hours the topmost spans
# are 85 days long, and only these are ever chained over a session's whole life.
_FAN, _LEVELS = 32, 2


def _chunk_starts(chunks: DataFrame, interval: int, chunk_ms: int) -> DataFrame:
    """(key, chunk, resume): from which time on a row of the chunk may be kept."""

    # The helpers are local so that they travel to the workers with the function itself.
    def steps_of(t: np.ndarray, reach: int):
        """Step function of one chunk as (upper bounds of the start, resulting restart).

        ``t`` is sorted and distinct; starts lie below ``reach``, so only rows up to the first one
        beyond it can be kept first.
        """
        n = len(t)
        following = np.searchsorted(t, t + interval)
        last = np.where(following == n, np.arange(n), np.minimum(following, n - 1))
        while True:
            jumped = last[last]
            if np.array_equal(jumped, last):
                break
            last = jumped
        first = min(int(np.searchsorted(t, reach)) + 1, n)
        return merged(t[:first], t[last[:first]] + interval)

    def merged(bound: np.ndarray, resume: np.ndarray):
        ends = np.append(resume[1:] != resume[:-1], True)
        return bound[ends], resume[ends]

    def composed_of(parts, unit: int):
        """One step function for all parts in a row; it has no more steps than starts can tell apart."""
        reach = int(parts[0]["chunk"]) * unit + interval
        bound, resume = (np.asarray(parts[0]["f"][c], np.int64) for c in ("bound", "resume"))
        for part in parts[1:]:
            b, r = (np.asarray(part["f"][c], np.int64) for c in ("bound", "resume"))
            step = np.searchsorted(b, resume)
            moved = np.where(step < len(b), r[np.minimum(step, len(b) - 1)], resume)
            # A start behind every row so far reaches this part as it is.
            lower = np.maximum(np.append(bound[-1], b[:-1]), bound[-1])
            rest = (b > bound[-1]) & (lower < reach)
            bound, resume = merged(np.concatenate([bound, b[rest]]), np.concatenate([moved, r[rest]]))
        return bound, resume

    def chain_of(at, parts) -> list:
        out = []
        for part in parts:
            out.append({"chunk": part["chunk"], "resume": at})
            f = part["f"]
            step = int(np.searchsorted(f["bound"], at))
            if step < len(f["bound"]):
                at = int(f["resume"][step])
        return out

    def as_frame(found) -> pd.DataFrame:
        return pd.DataFrame({"bound": [f[0] for f in found], "resume": [f[1] for f in found]})

    function = "struct<bound: array<bigint>, resume: array<bigint>>"

    @F.pandas_udf(function)
    def steps(chunk: pd.Series, ms: pd.Series) -> pd.DataFrame:
        return as_frame([steps_of(np.asarray(t), int(c) * chunk_ms + interval) for c, t in zip(chunk, ms)])

    @F.pandas_udf(function)
    def composed(parts: pd.Series, unit: pd.Series) -> pd.DataFrame:
        return as_frame([composed_of(p, int(u)) for p, u in zip(parts, unit)])

    @F.pandas_udf("array<struct<chunk: bigint, resume: bigint>>")
    def chain(at: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([chain_of(int(a), p) for a, p in zip(at, parts)])

    def in_order(functions: DataFrame, *by) -> DataFrame:
        return functions.groupBy("key", *by).agg(F.array_sort(F.collect_list(F.struct("chunk", "f"))).alias("parts"))

    functions, spans = chunks.select("key", "chunk", steps("chunk", "ms").alias("f")), []
    for level in range(_LEVELS):
        spans.append(in_order(functions, F.floor(F.col("chunk") / _FAN).cast("bigint").alias("span")))
        unit = F.lit(chunk_ms * _FAN**level).cast("bigint")
        functions = spans[-1].select("key", F.col("span").alias("chunk"), composed("parts", unit).alias("f"))
    # No row has been kept before a session's first span.
    earliest = F.lit(np.iinfo(np.int64).min).cast("bigint")
    starts = in_order(functions).select("key", F.inline(chain(earliest, "parts")))
    for parts in reversed(spans):
        starts = parts.join(starts.withColumnRenamed("chunk", "span"), ["key", "span"]).select(
            "key", F.inline(chain("resume", "parts"))
        )
    return starts


# --- Counter deltas ---------------------------------------------------------------------------

# A counter's records are ordered within pieces of six hours; a counter that is alive costs one
# more row, its last, per piece.
_COUNTER_CHUNK_MS = 6 * 3600 * 1000


def accounting_deltas(
    acct: DataFrame, scale: int = COUNTER_SCALE, ts: str = "ts", tie: str = "id",
    start_resets: bool = False, chunk_ms: int = _COUNTER_CHUNK_MS,
) -> DataFrame:
    """Add totals and the traffic since the previous record of the same counter.

    The first record of a counter, one after a stop, and one more than two days after its
    predecessor are baselines with zero traffic. A total that went down counts zero for its side
    and sets ``counter_rollback``. Records without a session id have no counter.

    One shuffle on (counter, time chunk), so that a busy counter is spread over many tasks. The
    last record of a chunk is repeated in front of the counter's next one.
    """
    incoming = octet_total(F.col("input_octets"), F.col("input_gigawords"), scale)
    outgoing = octet_total(F.col("output_octets"), F.col("output_gigawords"), scale)
    session = F.col("acct_session_id")
    key = counter_session_key(F.col("username"), F.col("nas_ip"), F.col("src_ip"), session)
    # A record without a session is its own group: it never meets another one.
    lone = F.concat(F.lit("event:"), F.col(tie).cast("string"))
    rows = acct.withColumns({
        "input_total": incoming, "output_total": outgoing,
        "counter_key": F.when(blank_to_null(session).isNull(), lone).otherwise(key),
        "chunk": F.floor(times.epoch_ms(F.col(ts)) / chunk_ms).cast("bigint"),
    })
    state = [ts, tie, "acct_status_type", "input_total", "output_total"]
    counted = rows.filter(blank_to_null(session).isNotNull() & F.col("chunk").isNotNull())
    both = rows.withColumn("carried", F.lit(False)).unionByName(
        _carried_tails(counted, state), allowMissingColumns=True
    )
    order = Window.partitionBy("counter_key", "chunk").orderBy(F.desc("carried"), ts, tie)
    before = F.lag(F.struct(*state)).over(order)
    out = both.withColumn("before", before).filter(~F.col("carried"))
    stale = F.col(ts) - F.col("before")[ts] > F.expr(f"INTERVAL {SESSION_STATE_DAYS} DAY")
    baseline = F.col("before").isNull() | stale | (
        F.coalesce(F.col("before.acct_status_type"), F.lit(0)) == ACCT_STOP
    )
    if start_resets:
        baseline = baseline | (F.coalesce("acct_status_type", F.lit(0)) == ACCT_START)
    grown_in = F.col("input_total") - F.col("before.input_total")
    grown_out = F.col("output_total") - F.col("before.output_total")
    fell = (grown_in < 0) | (grown_out < 0)
    zero = F.lit(0).cast("bigint")
    return out.withColumns({
        "input_delta": F.when(baseline, zero).otherwise(F.greatest(grown_in, zero)),
        "output_delta": F.when(baseline, zero).otherwise(F.greatest(grown_out, zero)),
        "counter_rollback": F.when(baseline, 0).otherwise(fell.cast("int")),
    }).select(
        *acct.columns, "input_total", "output_total", "input_delta", "output_delta",
        "counter_rollback",
    )


def _carried_tails(rows: DataFrame, state: list[str]) -> DataFrame:
    """The last record of every chunk of a counter, addressed to the counter's next chunk."""
    tails = rows.groupBy("counter_key", "chunk").agg(F.max(F.struct(*state)).alias("tail"))
    # One row per chunk: few, however many records the counter has.
    following = F.lead("chunk").over(Window.partitionBy("counter_key").orderBy("chunk"))
    return tails.withColumn("chunk", following).filter("chunk IS NOT NULL").select(
        "counter_key", "chunk", "tail.*", F.lit(True).alias("carried")
    )
