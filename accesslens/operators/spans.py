"""Event spans: runs of like authentication events with pauses of at most ten minutes."""

from dataclasses import replace

from pyspark.sql import DataFrame, Window, functions as F

from accesslens.constants import SPAN_GAP_MINUTES
from accesslens.functions.keys import stable_key
from accesslens.operators.rollups import LATEST_ATTRIBUTES, Rollup

SPAN_KEYS = ["username", "src_ip", "mac_addr", "nas_port_id", "result"]


def span_pieces(gap_minutes: int) -> Rollup:
    return Rollup(
        "auth_event_span",
        {**{k: k for k in SPAN_KEYS}, "piece": f"window(ts, '{gap_minutes} minutes').start"},
        {
            "request_count": "count(*)", "latency_count": "count(latency_ms)",
            "latency_sum_ms": "coalesce(sum(latency_ms), 0)",
        },
        {"latency_min_ms": "latency_ms", "first_seen": "ts"},
        {"latency_max_ms": "latency_ms", "last_seen": "ts"},
        last_row=(*LATEST_ATTRIBUTES, "req_ts", "latency_ms"), first_row=("reason_zh",),
    )


def auth_event_spans(auth: DataFrame, gap_minutes: int = SPAN_GAP_MINUTES) -> DataFrame:
    """One row per span; a pause of exactly the gap still belongs to the span.

    Events in one time slot as wide as the gap always share a span, so they are folded first, with
    map-side aggregation. What is left per key is at most one row per slot, and only those rows are
    ordered, compared with their predecessor and folded again. A key that holds a third of all
    events therefore costs no more than one that is seen in every slot.
    """
    pieces = span_pieces(gap_minutes)
    order = Window.partitionBy(*SPAN_KEYS).orderBy("piece")
    pause = F.col("first_seen") - F.lag("last_seen").over(order)
    opens = F.coalesce(pause > F.expr(f"INTERVAL '{gap_minutes}' MINUTE"), F.lit(True))
    numbered = pieces.partial(auth).withColumn("opens", opens.cast("int"))
    numbered = numbered.withColumn("span", F.sum("opens").over(order)).drop("opens")
    # Spans of a key are already together, so this fold needs no further shuffle.
    spans = replace(pieces, keys={**{k: k for k in SPAN_KEYS}, "span": "span"})
    return finish(spans, spans.merge(numbered)).drop("span")


def finish(spec: Rollup, partial: DataFrame) -> DataFrame:
    """Report form of folded spans."""
    key = stable_key(*[F.col(k) for k in SPAN_KEYS])
    out = spec.final(partial)
    return out.withColumn("event_key", key).withColumnRenamed("req_ts", "latest_req_ts")
