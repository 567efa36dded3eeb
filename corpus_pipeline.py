"""A training corpus from ``documents``: five stages, each over all that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm import bpe, decontaminate, jaccard, lines, quality
from accesslens.llm.components import cut, named

LEAST_QUALITY = 0.3
SIMILAR_PERCENT, SHINGLE_WORDS = 80, 5
VOCABULARY = "byte_bpe_50k.tiktoken"


#: Rows, and bytes, of an Arrow batch. Texts and token sets make Spark's default of 10 000 rows over 100 MB in each task.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """From here on this session hands rows to Python in batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, counts the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least ``LEAST_QUALITY``; the model learns from the labels of this folder."""
    _small_batches(spark)
    model = quality.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = "score" + "_" * max(map(len, docs.columns))
    return quality.score(docs, model, name=name).where(F.col(name) >= LEAST_QUALITY).select(*map(named, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines go; so do documents that were nothing else."""
    _small_batches(spark)
    return _counted(lines.cleaned(docs))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    _small_batches(spark)
    return jaccard.one_each(docs, SIMILAR_PERCENT, SHINGLE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that were nothing else go."""
    _small_batches(spark)
    return _counted(decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256, and the digest of the decoded text."""
    _small_batches(spark)
    coded = bpe.encode_decode(docs, bpe.read_ranks(public_tokenizers.path(VOCABULARY)))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

#: SQL can express neither the classifier nor the merges; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what a stage keeps is written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
