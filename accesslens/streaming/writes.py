"""Micro-batch writers: detail rows and rollup partials, idempotent per batch."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from accesslens.operators import rollups
from accesslens.operators.rollups import Rollup
from accesslens.sources.sinks import store_partial

RISK_ROLLUPS = [
    rollups.REASON_10M, rollups.NAS_10M, rollups.USER_10M, rollups.USER_MAC_10M,
]


def stream_merge(df: DataFrame, path: str, rollup: Rollup, checkpoint: str) -> DataStreamWriter:
    """Keep a stored rollup up to date, however late rows arrive.

    Each micro-batch stores its own partials; reading folds them. No watermark, so nothing is too
    late, and a retried batch replaces its own output.
    """
    bucket = next(iter(rollup.keys))

    def write(batch: DataFrame, batch_id: int) -> None:
        store_partial(rollup.partial(batch), path, batch_id, bucket)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def stream_writes(auth: DataFrame, base: str, checkpoint: str) -> DataStreamWriter:
    """Detail and totals first, then the account, terminal, reason and server rollups, from one
    reading of each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store_partial(batch, f"{base}/auth_log", batch_id, "ts")
            for rollup in [rollups.STAT_10M, *RISK_ROLLUPS]:
                store_partial(rollup.partial(batch), f"{base}/{rollup.name}", batch_id)
        finally:
            batch.unpersist()

    return auth.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
