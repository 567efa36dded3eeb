"""Work that several readers share, and slices that all tasks write."""

from pathlib import Path

from pyspark.sql import functions as F

from accesslens.operators import pairing, staging
from accesslens.plans import catalog, ingest
from accesslens.sources import fixtures, packets

SF = "/root/testdata/sf0.001"


def _plan(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def _rows(spark):
    return spark.range(100).selectExpr("id", "id % 7 AS a", "concat('x', id % 3) AS b")


def test_readers_of_shared_rows_use_one_shuffle(spark):
    rows = staging.shared(_rows(spark), "id")
    by_a = rows.filter("id > 5").groupBy(F.col("a").cast("string").alias("k")).count()
    by_b = rows.groupBy(F.col("b").alias("k")).count()
    plan = _plan(spark, by_a.unionByName(by_b))
    assert plan.count("Range (") == 1 and "ReusedExchange" in plan
    assert rows.schema.simpleString() == _rows(spark).schema.simpleString()
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, _rows(spark).collect()))


def test_accounting_packets_are_decoded_at_most_twice(spark):
    decoded = ingest.decode_stage(packets.capture(fixtures.all_rows(fixtures.events(spark, SF))))
    assert _plan(spark, ingest.records(decoded).accounting).count("FileScan") <= 2


def test_a_slice_is_written_by_all_its_tasks(spark, tmp_path):
    rows = fixtures.auth_log(fixtures.events(spark, SF)).repartition(6, "id")
    files = []
    for _ in fixtures.delivered(rows, str(tmp_path / "in")):
        files.append(len(list(Path(tmp_path / "in").glob("*.parquet"))) - sum(files))
    assert len(files) > 1 and min(files) > 1
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "in")).count() == rows.count()


def test_encoding_has_at_least_as_many_tasks_as_shuffles(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert catalog._frames(spark, SF).rdd.getNumPartitions() == 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_only_paired_packets_are_decoded(spark):
    decoded = ingest.decode_stage(packets.capture(fixtures.all_rows(fixtures.events(spark, SF))))
    for rows in (pairing.pair_auth(decoded), pairing.unmatched_responses(decoded), pairing.expired_requests(decoded)):
        above, _, below = _plan(spark, rows).partition("Window [")
        assert "attrs#" in above and "attrs#" not in below


def test_pairing_has_as_many_tasks_as_shuffles(spark):
    decoded = ingest.decode_stage(packets.capture(fixtures.all_rows(fixtures.events(spark, SF))))
    _, _, below = _plan(spark, pairing.pair_auth(decoded)).partition("Window [")
    assert "REPARTITION_BY_NUM" in below.split("Generate")[0]
