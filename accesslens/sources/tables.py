"""Detail tables: reading, shaping and day layout."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from accesslens import schemas
from accesslens.functions import times
from accesslens.functions.text import blank_to_null, is_business_account, or_else, text


def _stored(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    by_day = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(by_day).parquet(path)


def auth_log(spark: SparkSession, path: str) -> DataFrame:
    """Stored authentication detail."""
    return _stored(spark, schemas.AUTH_LOG, path)


def acct_log(spark: SparkSession, path: str) -> DataFrame:
    """Stored accounting detail."""
    return _stored(spark, schemas.ACCT_LOG, path)


def aaa_events(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, schemas.AAA_EVENTS, path)


def packets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PACKETS).parquet(path)


def between(df: DataFrame, since: datetime, until: datetime, ts: str = "ts") -> DataFrame:
    """Half-open time range that also prunes the day directories."""
    found = df.filter((F.col(ts) >= times.ntz(since)) & (F.col(ts) < times.ntz(until)))
    if "dt" in df.columns:
        found = found.filter(F.col("dt").between(F.lit(since.date()), F.lit(until.date())))
    return found


def with_partition(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add the day that the table is laid out by."""
    return df.withColumn("dt", F.to_date(ts))


# Stored text columns in which the empty string is NULL. Texts are stored whole.
_NULLABLE = [
    "mac_addr", "calling_sta", "called_sta", "nas_ip", "nas_identifier", "nas_port_id", "framed_ip", "src_ip",
]


def _name_columns(empty: str) -> dict:
    raw = F.coalesce(or_else(F.col("raw_username"), F.col("username")), F.lit(empty))
    return {
        "username": F.coalesce(or_else(F.col("username")), raw),
        "raw_username": raw,
    }


def to_auth_log(records: DataFrame, id_col: str = "seq") -> DataFrame:
    """Detail rows of paired records of business accounts."""
    shaped = records.select(
        F.col(id_col).alias("id"),
        times.to_ms_precision(F.col("resp_ts")).alias("ts"),
        times.to_ms_precision(F.col("req_ts")).alias("req_ts"),
        times.latency_ms(F.col("req_ts"), F.col("resp_ts")).alias("latency_ms"),
        *[c.alias(n) for n, c in _name_columns("(空)").items()],
        F.col("result_code").cast("int").alias("result"),
        text(F.col("reply_raw")).alias("reply_msg"),
        text(F.col("reason_zh")).alias("reason_zh"),
        F.coalesce(blank_to_null(F.col("risk")), F.lit("unknown")).alias("risk_level"),
        *[blank_to_null(F.col(n)).alias(n) for n in _NULLABLE],
        F.col("nas_port").cast("bigint"), F.col("nas_port_type").cast("int"),
    )
    return shaped.filter(is_business_account(F.col("username"))).select(
        schemas.AUTH_LOG.fieldNames()
    )


def to_acct_log(records: DataFrame, id_col: str = "seq") -> DataFrame:
    """Detail rows of accounting records of business accounts."""
    names = _name_columns("")
    shaped = records.select(
        F.col(id_col).alias("id"), times.to_ms_precision(F.col("ts")).alias("ts"),
        names["username"].alias("username"),
        F.nullif(names["raw_username"], F.lit("")).alias("raw_username"),
        F.col("acct_status_type").cast("int"),
        blank_to_null(F.col("acct_session_id")).alias("acct_session_id"),
        *[
            F.col(c).cast("bigint")
            for c in ("input_octets", "input_gigawords", "output_octets", "output_gigawords")
        ],
        *[blank_to_null(F.col(n)).alias(n) for n in [*_NULLABLE, "dst_ip"]],
        F.col("nas_port").cast("bigint"), F.col("nas_port_type").cast("int"),
    )
    return shaped.filter(is_business_account(F.col("username"))).select(
        schemas.ACCT_LOG.fieldNames()
    )
