"""A join with small facts about keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT = 1000  # keys with more than a thousandth of all rows; there can't be more than a thousand


def attached(rows: DataFrame, facts: DataFrame, keys: list[str], spread: str, hot: int = HOT) -> DataFrame:
    """``rows`` left-joined with ``facts``, one row a key, whose column ``n`` counts the key's rows.

    Keys with more than one in ``hot`` of the rows counted are at most ``hot`` by arithmetic, so their facts are
    broadcast; the rows of these keys are dealt by the column ``spread`` and meet nothing there. Facts are
    narrow: their other columns have bounded sizes. Nulls among the keys match nothing.
    """
    values = [c for c in facts.columns if c not in keys]
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = facts.where(F.col("n") * hot > F.lit(total))
    rare = facts.where(F.col("n") * hot <= F.lit(total))
    named = lambda df, end: df.select(*keys, *[F.col(c).alias(c + end) for c in values])
    near = rows.join(F.broadcast(named(often, "_often")), keys, "left")
    near = near.withColumn("salt_", F.when(F.col("n_often").isNotNull(), 1 + F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(F.lit(0)))
    far = near.join(named(rare, "_rare").withColumn("salt_", F.lit(0).cast("long")).hint("shuffle_hash"), [*keys, "salt_"], "left")
    return far.select(*rows.columns, *[F.coalesce(f"{c}_often", f"{c}_rare").alias(c) for c in values])
