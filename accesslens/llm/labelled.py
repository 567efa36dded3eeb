"""Labelled rows for training: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: str, folds: int) -> Column:
    """crc32 of the key's decimal text, modulo the number of folds. A null key: null."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, most: int,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text, label of at most ``most`` labelled documents that may be learnt from.

    Keys are taken in order of their hash, so the sample is the same however the tables lie. Where a key
    has several labels, the largest counts; null keys and labels are left out, and labels other than 0 and 1.
    Only the sample's keys are broadcast, and ``most`` bounds them.
    """
    chosen = (
        labels.select(F.col(key).alias("label_key"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("label_key").isNotNull())
        .withColumnRenamed("label_key", key).where(may_learn)
        .groupBy(F.col(key).alias("id")).agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(most)
    )
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "id")
