"""Streaming operators over file slices give what the batch operators give."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from accesslens.operators import accounting, decode, pairing, rollups, spans
from accesslens.sources import fixtures, packets, sinks
from accesslens.streaming import stateful, windows, writes

SF = "/root/testdata/sf0.001"
LATER = datetime(2024, 1, 9)


def _stream(spark, df, path, ts, slices=3):
    """``df`` as a file stream whose slices follow each other in time."""
    n = F.ntile(slices).over(Window.orderBy(ts))
    cut = df.withColumn("slice", n).persist()
    for i in range(1, slices + 1):
        cut.filter(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(path)
    cut.unpersist()
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _with_sentinel(spark, df, **values):
    """One row far in the future closes all windows."""
    row = df.limit(1).select(*[
        F.lit(values[c]).cast(t).alias(c) if c in values else F.col(c) for c, t in df.dtypes
    ])
    return df.unionByName(row)


def _run(stream, tmp_path, name):
    query = (
        stream.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    return stream.sparkSession.table(name)


def _rows(df, columns=None):
    return sorted((tuple(r) for r in (df.select(columns) if columns else df).collect()), key=repr)


@pytest.fixture(scope="module")
def auth(spark):
    return fixtures.auth_log(fixtures.events(spark, SF), 600).persist()


@pytest.fixture(scope="module")
def acct(spark):
    return fixtures.acct_log(fixtures.events(spark, SF), 600).persist()


def test_rollup(spark, auth, tmp_path):
    src = _with_sentinel(spark, auth, ts=str(LATER), id=-1)
    stream = _stream(spark, src, str(tmp_path / "in"), "ts")
    got = _run(windows.stream_rollup(stream, rollups.USER_10M), tmp_path, "s_rollup")
    assert _rows(rollups.USER_10M.final(got)) == _rows(rollups.rollup_user_10m(auth))


def test_spans(spark, auth, tmp_path):
    src = _with_sentinel(spark, auth, ts=str(LATER), id=-1, username="GDF0")
    stream = _stream(spark, src, str(tmp_path / "in"), "ts")
    got = _run(windows.stream_spans(stream), tmp_path, "s_spans")
    want = spans.auth_event_spans(auth)
    assert _rows(got.select(want.columns)) == _rows(want)


def test_dedup(spark, acct, tmp_path):
    events = accounting.with_event_id(acct).withColumn("event_time", F.col("ts"))
    copies = events.unionByName(events.filter("id % 3 = 0"))
    stream = _stream(spark, copies, str(tmp_path / "in"), "ts")
    got = _run(windows.stream_dedup(stream), tmp_path, "s_dedup")
    assert _rows(got, ["id", "event_id"]) == _rows(events, ["id", "event_id"])


def test_deltas(spark, acct, tmp_path):
    stream = _stream(spark, acct, str(tmp_path / "in"), "ts")
    got = _run(stateful.stream_deltas(stream), tmp_path, "s_deltas")
    want = accounting.accounting_deltas(acct)
    assert _rows(got.select(want.columns)) == _rows(want)


def test_sample(spark, acct, tmp_path):
    stream = _stream(spark, acct, str(tmp_path / "in"), "ts")
    got = _run(stateful.stream_sample(stream, 600), tmp_path, "s_sample")
    want = accounting.sample_interim(acct, 600)
    assert acct.filter(~accounting.sampled(acct)).count() < want.count() < acct.count()
    assert _rows(got.select(want.columns)) == _rows(want)


def test_sessions_are_sampled_by_bucket(spark, tmp_path):
    # 3000 sessions: times 0, 5, 11 and 30 minutes of each; the last one comes in a turn of its own.
    rows = spark.range(3000).selectExpr("concat('s', id) AS acct_session_id", "explode(array(0, 5, 11, 30)) AS minute", "id AS n").selectExpr(
        "n * 100 + minute AS id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + minute * INTERVAL '60' SECOND AS ts", "acct_session_id",
        "3 AS acct_status_type", "'u' AS username", "cast(NULL AS string) AS framed_ip", "cast(NULL AS string) AS mac_addr",
        "'10.0.0.1' AS nas_ip", "'10.0.0.1' AS src_ip")
    for later in (False, True):
        rows.filter(F.col("ts").cast("string").endswith("00:30:00") == later).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        stateful.stream_sample(stream, 600).writeStream.format("memory").queryName("s_buckets")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert _rows(spark.table("s_buckets"), ["id"]) == _rows(rows.filter("id % 100 <> 5"), ["id"])
    assert 0 < max(p.stateOperators[0].numRowsUpdated for p in query.recentProgress) <= 1024


def test_sample_in_one_bucket(spark, acct, tmp_path):
    # Slices follow each other, so sessions leave the bucket's state while others are added to it.
    timeless = acct.limit(1).withColumns({"ts": F.lit(None).cast("timestamp_ntz"), "acct_status_type": F.lit(3)})
    stream = _stream(spark, acct.unionByName(timeless), str(tmp_path / "in"), "ts", slices=6)
    got = _run(stateful.stream_sample(stream, 60, "1 minute", buckets=1), tmp_path, "s_bucket")
    want = accounting.sample_interim(acct, 60)
    assert want.count() < acct.count()
    assert _rows(got.select(want.columns)) == _rows(want)


def test_pairing(spark, tmp_path):
    captured = packets.datagrams(fixtures.all_rows(fixtures.events(spark, SF)))
    datagrams = captured.filter("src_port = 1812 OR dst_port = 1812").persist()
    stream = decode.decode_packets(_stream(spark, datagrams, str(tmp_path / "in"), "pkt_time"))
    got = _run(stateful.stream_pair(stream), tmp_path, "s_pair")
    want = pairing.pair_auth(decode.decode_packets(datagrams))
    assert _rows(got.select(want.columns)) == _rows(want)
    datagrams.unpersist()


def test_merge_takes_late_rows(spark, auth, tmp_path):
    # Slices in reverse time order: every later slice is late.
    src = auth.withColumn("back", F.lit(LATER).cast("timestamp_ntz") - F.col("ts"))
    stream = _stream(spark, src, str(tmp_path / "in"), "back")
    query = writes.stream_merge(
        stream.drop("back"), str(tmp_path / "out"), rollups.USER_MAC_10M, str(tmp_path / "ck")
    ).trigger(availableNow=True).start()
    query.awaitTermination(240)
    got = sinks.load_rollup(spark, str(tmp_path / "out"), rollups.USER_MAC_10M).drop("dt")
    want = rollups.rollup_user_mac_10m(auth)
    assert _rows(got.select(want.columns)) == _rows(want)


def test_two_write_paths(spark, auth, tmp_path):
    stream = _stream(spark, auth, str(tmp_path / "in"), "ts", slices=2)
    base = str(tmp_path / "tables")
    query = writes.stream_writes(stream, base, str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert spark.read.parquet(f"{base}/auth_log").count() == auth.count()
    for rollup in [rollups.STAT_10M, *writes.RISK_ROLLUPS]:
        got = sinks.load_rollup(spark, f"{base}/{rollup.name}", rollup).drop("dt")
        assert _rows(got) == _rows(rollup.compute(auth).select(got.columns))
