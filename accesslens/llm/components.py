"""Connected components over edges, without collecting any node's neighbours."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. Only a session on this machine that names none, as
    in tests, gets a temporary one; elsewhere that raises, as executors would write to their own disks."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return f"{tempfile.gettempdir()}/accesslens-checkpoints"


def named(column: str) -> str:
    """A column's name in quotes, as names may hold dots and blanks."""
    return "`" + column.replace("`", "``") + "`"


def cut(rows: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows, written as Parquet under the shared folder and read again.

    Unlike checkpoint(), this works the rows out once. Shuffle files of the write go when it ends, as nothing reads them
    again; else they stay until the driver collects its garbage. The folder is the job's scratch space: whoever runs the job
    empties it, as results that are read lazily may still need it here.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(rows.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b): the smallest node reachable.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its smallest one
    (large star), then its smaller neighbours (small star). Rounds grow with the logarithm of the size.
    Edges from a node to itself keep it in the result. Nulls are no nodes.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL")
    alone = edges.where("a = b").select(F.col("a").alias("node"))
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u")
        small = moved.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v")
        now = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
    found = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    nodes = found.select("node", "component").unionByName(
        found.select(F.col("component").alias("node"), "component").distinct())
    lone = alone.distinct().join(nodes, "node", "left_anti").select("node", F.col("node").alias("component"))
    return nodes.unionByName(lone)
