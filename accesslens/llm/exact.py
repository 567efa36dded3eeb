"""Exact copies: rows grouped by a 128-bit content hash, bytes compared inside each group.

Only texts whose hash occurs twice are grouped by their bytes; a hot group is folded in every map
task before it is shuffled. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's group of equal texts, white space aside: key, keep_id, group_size, kept, text_sha256.

    Of a group the row with the most code points stays, then the smallest key. A null text counts as
    empty, and empty texts are one group. Rows that repeat with one key share its fate, each counts in
    group_size. A null key stays only where its group has no other key. An empty table gives no rows.
    Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"), F.length(whole).alias("points"), F.regexp_replace(whole, SPACES, "").alias("norm"),
    ).withColumn("hash", F.unhex(F.md5("norm"))).withColumn("sha", F.sha2("norm", 256))
    slim = rows.select("id", "points", "hash", "sha")
    repeated = slim.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    # Grouping by the bytes themselves: two texts with one hash are two groups.
    by_length = (
        rows.join(repeated.hint("shuffle_hash"), "hash", "left_semi")
        .groupBy("hash", "norm", "sha", "points").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    )
    groups = by_length.groupBy("hash", "norm", "sha").agg(
        F.max_by("first", F.when(F.col("first").isNotNull(), F.col("points")).otherwise(-1)).alias("keep"),
        F.sum("n").alias("size"),
    ).select("hash", "sha", "keep", "size")
    return slim.join(groups, ["hash", "sha"], "left").select(
        F.col("id").alias(key),
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | F.col("id").eqNullSafe(F.col("keep"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), g AS (
    SELECT norm, count(*) AS group_size, first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id
    FROM d GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""
