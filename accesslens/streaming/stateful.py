"""Keyed streaming operators whose state Spark's windows cannot express.

Pairing, down-sampling and counter deltas keep one small value per key. Rows of a key are put into
time order within a micro-batch. The wide part of a row passes through Python as one opaque JSON
text, so no value is altered by the conversion.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from accesslens.constants import (
    ACCT_STOP, COUNTER_SCALE, INTERIM_INTERVAL_SECONDS, PAIRING_TTL_SECONDS, SESSION_STATE_DAYS,
)
from accesslens.functions import times
from accesslens.functions.counters import octet_total
from accesslens.functions.keys import counter_session_key
from accesslens.functions.text import blank_to_null
from accesslens.operators import accounting
from accesslens.operators.pairing import auth_packets, record_columns

_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_TIMEOUT = GroupStateTimeout.EventTimeTimeout
SAMPLE_BUCKETS = 1024  # of sessions that are thinned out together


def _packed(*columns) -> Column:
    return F.to_json(F.struct(*columns), _JSON)


def _marked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withColumn("mark", times.instant(F.col(ts))).withWatermark("mark", delay)


def _unpacked(name: str, schema: StructType):
    return F.from_json(F.col(name), schema, _JSON)


def stream_deltas(
    acct: DataFrame, scale: int = COUNTER_SCALE, delay: str = "10 minutes", ts: str = "ts",
    tie: str = "id",
) -> DataFrame:
    """Streaming :func:`accounting.accounting_deltas`; the state of a counter is dropped by a stop
    or after two days of silence."""
    silence = SESSION_STATE_DAYS * 86_400_000
    session = F.col("acct_session_id")
    key = counter_session_key(F.col("username"), F.col("nas_ip"), F.col("src_ip"), session)
    lone = F.concat(F.lit("event:"), F.col(tie).cast("string"))
    rows = _marked(acct, ts, delay).select(
        "mark", F.col(ts).alias("at"), times.epoch_ms(F.col(ts)).alias("ms"), F.col(tie).alias("tie"),
        F.when(blank_to_null(session).isNull(), lone).otherwise(key).alias("key"),
        F.coalesce(F.col("acct_status_type").cast("int"), F.lit(0)).alias("status"),
        octet_total(F.col("input_octets"), F.col("input_gigawords"), scale).alias("input_total"),
        octet_total(F.col("output_octets"), F.col("output_gigawords"), scale).alias("output_total"),
        _packed(*acct.columns).alias("record"),
    )

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["at", "tie"], kind="stable")
        before = state.get if state.exists else None
        out = []
        for r in rows.itertuples(index=False):
            total = (int(r.input_total), int(r.output_total))
            grown, fell = (0, 0), 0
            if before is not None and r.ms - before[2] <= silence:
                diff = (total[0] - before[0], total[1] - before[1])
                grown, fell = (max(diff[0], 0), max(diff[1], 0)), int(min(diff) < 0)
            out.append((r.record, *total, *grown, fell))
            before = None if r.status == ACCT_STOP else (*total, int(r.ms))
        if before is None or str(key[0]).startswith("event:"):
            if state.exists:
                state.remove()
        else:
            state.update(before)
            state.setTimeoutTimestamp(max(before[2], state.getCurrentWatermarkMs()) + silence + 1)
        yield pd.DataFrame(out, columns=[
            "record", "input_total", "output_total", "input_delta", "output_delta",
            "counter_rollback",
        ])

    out = rows.groupBy("key").applyInPandasWithState(
        step,
        "record string, input_total long, output_total long, input_delta long, output_delta long, "
        "counter_rollback int",
        "input_total long, output_total long, ms long", "append", _TIMEOUT,
    )
    return out.select(_unpacked("record", acct.schema).alias("r"), *out.columns[1:]).select(
        "r.*", *out.columns[1:]
    )


def stream_sample(
    acct: DataFrame, interval_s: int = INTERIM_INTERVAL_SECONDS, delay: str = "10 minutes",
    ts: str = "ts", tie: str = "id", buckets: int = SAMPLE_BUCKETS,
) -> DataFrame:
    """Streaming :func:`accounting.sample_interim`. Rows that aren't subject to it need no state and
    pass beside it; of those that are, rows without a time are left out, as they are there.

    Calling Python for a group costs far more than thinning out a session does, so sessions are put
    into ``buckets`` by their hash and a bucket's state lists the sessions that may still drop a row:
    those kept within the interval before the watermark. The number of buckets belongs to the
    checkpoint; it bounds the calls of a micro-batch, and rows per call are its rows over ``buckets``.
    """
    interval = int(interval_s) * 1000
    rows = _marked(acct.filter(accounting.sampled(acct)), ts, delay).select(
        "mark", times.epoch_ms(F.col(ts)).alias("ms"), F.col(tie).alias("tie"),
        accounting.interim_key().alias("key"), _packed(*acct.columns).alias("record"),
    ).filter(F.col("ms").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["ms", "tie"], kind="stable")
        last = dict(zip(*state.get)) if state.exists else {}
        kept = []
        for session, ms, record in zip(rows["key"], rows["ms"].tolist(), rows["record"]):
            before = last.get(session)
            if before is None or ms - before >= interval:
                kept.append(record)
                last[session] = ms
        # Once the watermark is past this point every row that can still come is kept anyway.
        watermark = state.getCurrentWatermarkMs()
        last = {session: ms for session, ms in last.items() if ms + interval >= watermark}
        if last:
            state.update((list(last), list(last.values())))
            state.setTimeoutTimestamp(max(*last.values(), watermark) + interval + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"record": kept})

    out = rows.groupBy("bucket").applyInPandasWithState(
        step, "record string", "sessions array<string>, ms array<long>", "append", _TIMEOUT
    )
    kept = out.select(_unpacked("record", acct.schema).alias("r")).select("r.*")
    return kept.unionByName(acct.filter(~accounting.sampled(acct)))


def stream_exchanges(
    decoded: DataFrame, ttl_s: int = PAIRING_TTL_SECONDS, delay: str = "10 seconds"
) -> DataFrame:
    """Streaming pairing: one row per response (``matched`` or ``unmatched``) and one per request
    that stayed unanswered for the time limit (``expired``)."""
    ttl_us = ttl_s * 1_000_000
    packets = auth_packets(decoded)
    flow = ["client_ip", "client_port", "server_ip", "server_port", "packet_identifier"]
    rows = _marked(packets, "at", delay).select(
        "mark", *flow, "seq", "at", times.epoch_ms(F.col("at")).alias("ms"),
        F.col("request").isNotNull().alias("is_request"),
        F.coalesce(F.to_json("request", _JSON), F.to_json("response", _JSON)).alias("record"),
    )
    request_schema = packets.schema["request"].dataType
    response_schema = packets.schema["response"].dataType

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_ = state.get if state.exists else None
        out = []
        if state.hasTimedOut:
            out.append((open_[2], "expired", open_[0], None))
            open_ = None
        else:
            rows = pd.concat(list(batches)).sort_values(["at", "seq"], kind="stable")
            for r in rows.itertuples(index=False):
                at_us = r.at.value // 1000
                late = open_ is not None and at_us - open_[1] > ttl_us
                if late:
                    out.append((open_[2], "expired", open_[0], None))
                    open_ = None
                if r.is_request:
                    open_ = (r.record, at_us, int(r.seq))
                elif open_ is None:
                    out.append((int(r.seq), "unmatched", None, r.record))
                else:
                    out.append((int(r.seq), "matched", open_[0], r.record))
                    open_ = None
        if open_ is None:
            if state.exists:
                state.remove()
        else:
            state.update(open_)
            state.setTimeoutTimestamp(
                max(open_[1] // 1000, state.getCurrentWatermarkMs()) + ttl_s * 1000 + 1
            )
        yield pd.DataFrame(out, columns=["seq", "outcome", "request", "response"])

    out = rows.groupBy(*flow).applyInPandasWithState(
        step, "seq long, outcome string, request string, response string",
        "record string, at_us long, seq long", "append", _TIMEOUT,
    )
    return out.select(
        "seq", "outcome", _unpacked("request", request_schema).alias("matched"),
        _unpacked("response", response_schema).alias("response"),
    )


def stream_pair(
    decoded: DataFrame, ttl_s: int = PAIRING_TTL_SECONDS, delay: str = "10 seconds"
) -> DataFrame:
    """Streaming :func:`pairing.pair_auth`."""
    return record_columns(stream_exchanges(decoded, ttl_s, delay).filter("outcome = 'matched'"))
