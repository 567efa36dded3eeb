"""Streaming twins of the stateless and windowed operators, on Spark's own streaming state."""

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from accesslens.constants import DEDUP_HOURS, SPAN_GAP_MINUTES
from accesslens.functions import times
from accesslens.operators.rollups import Rollup
from accesslens.operators.spans import SPAN_KEYS, finish, span_pieces


def stream_rollup(
    df: DataFrame, rollup: Rollup, width: str = "10 minutes", delay: str = "10 minutes",
    ts: str = "ts",
) -> DataFrame:
    """Rollup partials; each bucket is emitted once, when the watermark has passed its end.

    Rows later than ``delay`` are dropped by the watermark (Spark reports their number). Where late
    rows must count, use :func:`accesslens.streaming.writes.stream_merge`.
    """
    bucket, *others = rollup.keys
    marked = df.withColumn("mark", times.instant(F.col(ts))).withWatermark("mark", delay)
    keyed = marked.filter(rollup.where).select(
        "*", *[F.expr(rollup.keys[n]).alias(f"key_{n}") for n in others]
    )
    out = keyed.groupBy(F.window("mark", width).alias("w"), *[f"key_{n}" for n in others]).agg(
        *rollup.aggregates()
    )
    rest = [c for c in out.columns if c != "w" and not c.startswith("key_")]
    return out.select(
        times.from_instant(F.col("w.start")).alias(bucket), *[F.col(f"key_{n}").alias(n) for n in others], *rest
    )


def stream_spans(
    df: DataFrame, delay: str = "10 minutes", gap_minutes: int = SPAN_GAP_MINUTES
) -> DataFrame:
    """Event spans, each emitted when the watermark has passed its end plus the gap."""
    spec = replace(span_pieces(gap_minutes), keys={k: k for k in SPAN_KEYS})
    session = F.session_window("mark", f"{gap_minutes} minutes").alias("session")
    marked = df.withColumn("mark", times.instant(F.col("ts"))).withWatermark("mark", delay)
    folded = marked.groupBy(session, *SPAN_KEYS).agg(*spec.aggregates())
    return finish(spec, folded)


def stream_dedup(df: DataFrame, hours: int = DEDUP_HOURS, ts: str = "event_time") -> DataFrame:
    """Drop copies of an event that arrive within the horizon."""
    marked = df.withColumn("mark", times.instant(F.col(ts))).withWatermark("mark", f"{hours} hours")
    return marked.dropDuplicatesWithinWatermark(["event_id"]).drop("mark")
