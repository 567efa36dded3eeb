"""Materialised intermediate results and folders for streaming state."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def staged(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there. Runs at once.

    For results that several later steps read and that are expensive to make again, such as decoded
    packets. The rows are in the folder that ``spark.checkpoint.dir`` names, so they survive the
    loss of executors; the caller removes them.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows, shuffled by ``keys`` to as many tasks as shuffles have, and as cores at least. Spark would join small
    shuffles into about as many tasks as cores; where rows are heavy to work on, some cores then get twice the work."""
    spark = df.sparkSession
    width = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(width, *[F.col(k) for k in keys])


def shared(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that several later steps of one query read. Nothing runs here: the rows are shuffled by ``keys`` (all
    columns by default), and Spark uses the shuffle again for every reader.

    It does so for equal shuffles only, and each reader would prune columns and push filters of its own below it. They
    stop at the generator.
    """
    return dealt(df, *(keys or df.columns)).select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def scratch(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, for the state and output of a streaming run."""
    return f"{_base(spark)}/{uuid.uuid4().hex}"


def _base(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="accesslens-checkpoint-")
