"""Scalar functions, reports, sinks and retention."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accesslens.functions import counters, keys, text, times
from accesslens.operators import retention, rollups, staging
from accesslens.plans import catalog, reports
from accesslens.schemas import AUTH_LOG
from accesslens.sources import fixtures, sinks, tables
from tests.test_operators import auth_row

SF = "/root/testdata/sf0.001"


def _map(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_normalize_mac(spark):
    good = ["AA-BB-CC-DD-EE-FF", "aabb.ccdd.eeff", "AABBCCDDEEFF", "aa:bb:cc:dd:ee:ff"]
    assert _map(spark, text.normalize_mac, good) == ["aa:bb:cc:dd:ee:ff"] * 4
    assert _map(spark, text.normalize_mac, ["", None, "\t Host-1 ", "AABB"]) == ["", None, "host-1", "aabb"]


def test_normalize_username(spark):
    cases = {
        "gdf1234": "GDF1234", "a:tok::GDC0001x gdf99999": "GDF99999", "\x01 12345\x7f": "12345", "123": "(未匹配)",
        "GDF12": "(未匹配)", "": "", "bob": "(未匹配)", "GDX1234": "(未匹配)", " 1234 5678": "(未匹配)",
    }
    assert _map(spark, text.normalize_username, list(cases)) == list(cases.values())
    assert _map(spark, text.normalize_username, [None]) == [None]


def test_business_account(spark):
    values = ["GDF1", "gdc77", "42", "GDF", "xGDF1", "GDF1\n", "", None]
    assert _map(spark, text.is_business_account, values) == [True, True, True, False, False, False, False, False]


def test_coercions(spark):
    assert _map(spark, text.uint, ["7", "-7", "x", "", None, "1.5"]) == [7, 0, 0, 0, 0, 0]
    assert _map(spark, text.text, ["a", None]) == ["a", ""]
    assert _map(spark, lambda c: text.clip_or_null(c, 2), ["abc", "", None]) == ["ab", None, None]
    assert _map(spark, keys.code_name, [2, 45, 99], "int") == ["Access-Accept", "CoA-NAK", "code=99"]
    total = lambda c: counters.octet_total(c, F.lit(2), 1024)
    assert _map(spark, total, [5, None], "long") == [(2 * 2**32 + 5) * 1024, 2 * 2**32 * 1024]


def test_reply_reason(spark):
    known = "006:Search Err or User not exists"
    assert _map(spark, lambda c: keys.reply_reason(c)[0], [known, "other", "", None]) == ["账号不存在", "other", None, None]
    assert _map(spark, lambda c: keys.reply_reason(c)[1], [known, "other", "", None]) == ["high", "unknown", "unknown", "unknown"]


def test_timestamps(spark):
    day = F.lit("2024-05-06").cast("date")
    values = ["2024-01-02 03:04:05.678", "03:04:05.5", "—", "nonsense", "2024-01-02 03:04:05", None, "2024-13-02 03:04:05.1"]
    got = _map(spark, lambda c: times.parse_timestamp(c, day), values)
    assert got == [datetime(2024, 1, 2, 3, 4, 5, 678000), datetime(2024, 5, 6, 3, 4, 5, 500000)] + [None] * 5
    stamps = [datetime(2024, 3, 10, 2, 30, 0, 123000), datetime(1969, 12, 31, 23, 59, 59, 999000)]
    ms = _map(spark, times.epoch_ms, stamps, "timestamp_ntz")
    assert ms == [1710037800123, -1]
    back = _map(spark, times.from_epoch_ms, ms, "long")
    assert back == stamps
    assert _map(spark, lambda c: times.from_instant(times.instant(c)), stamps, "timestamp_ntz") == stamps
    assert _map(spark, lambda c: times.slot_label(c, 420), stamps[:1], "timestamp_ntz") == ["2024-03-10 02:26"]


def test_report_window():
    now = datetime(2024, 1, 10, 12, 0, 0, 999)
    assert times.window_start(now, 24) == datetime(2024, 1, 9, 12)
    assert times.window_start(now, 24, datetime(2024, 1, 10)) == datetime(2024, 1, 10)
    assert times.date_range(None, None) is None
    assert times.date_range(date(2024, 1, 5), date(2024, 1, 3)) == (datetime(2024, 1, 3), datetime(2024, 1, 6))
    assert times.date_range(date(2024, 1, 5), None) == (datetime(2024, 1, 5), datetime(2024, 1, 6))
    assert times.date_range(date(2024, 1, 1), date(2024, 6, 1))[1] == datetime(2024, 6, 2)
    with pytest.raises(ValueError):
        times.date_range(date(2024, 1, 1), date(2024, 2, 1), max_days=31)


@pytest.fixture(scope="module")
def auth(spark):
    return fixtures.auth_log(fixtures.events(spark, SF)).persist()


def test_empty_reports(spark, auth):
    none = auth.filter("false")
    row = reports.stats(rollups.rollup_stat_10m(none), fixtures.NOW).first()
    assert (row.total, row.accept_rate, row.avg_latency_ms) == (0, 0.0, 0.0)
    acct = fixtures.acct_log(fixtures.events(spark, SF)).filter("false")
    assert reports.acct_dashboard_stats(acct).first().session_count == 0
    assert reports.acct_history(acct, "", fixtures.NOW).count() == 0
    assert reports.ingest_status(rollups.rollup_stat_10m(none), acct, fixtures.NOW).first().accounting_lag_seconds is None
    assert reports.recent(none).count() == 0


def test_risk_pages_cover_everything_once(spark, auth):
    users = rollups.rollup_user_10m(auth).persist()
    want = users.groupBy("username").agg(F.sum("request_count").alias("n")).filter("n > 3").count()
    seen, page = [], 1
    while True:
        rows = reports.risk_accounts(users, fixtures.NOW, page=page, page_size=4, min_count=3).collect()
        seen += [r.username for r in rows]
        assert rows[0].total == len(seen) + rows[0].has_next
        if not rows[0].has_next:
            break
        page += 1
    assert len(seen) == len(set(seen)) == want


def test_multi_mac_nests_terminals(spark):
    rows = [auth_row(i, i, user=u, mac=m) for i, (u, m) in enumerate([
        ("GDF1", "a"), ("GDF1", "b"), ("GDF1", "b"), ("GDF2", "a"), ("GDF3", None), ("GDF1", "c"), ("GDF4", "x"), ("GDF4", "y")])]
    terminals = rollups.rollup_user_mac_10m(spark.createDataFrame(rows, AUTH_LOG))
    got = reports.multi_mac(terminals, datetime(2024, 3, 10, 12)).collect()
    assert [(r.username, r.mac_count, r.nas_count) for r in got] == [("GDF1", 3, 1), ("GDF4", 2, 1)]
    assert [d.mac_addr for d in got[0].mac_details] == ["c", "b", "a"]
    assert reports.multi_mac(terminals, datetime(2024, 3, 10, 12), min_mac=3).count() == 1


def test_date_range_overrides_hours(spark, auth):
    users = rollups.rollup_user_10m(auth)
    day = reports.top_reject(users, datetime(2030, 1, 1), start=date(2024, 1, 1), limit=5)
    assert day.count() == 5 and reports.top_reject(users, datetime(2030, 1, 1)).count() == 0


def test_detail_roundtrip_prunes_days(spark, auth, tmp_path):
    path = str(tmp_path / "auth")
    sinks.append(auth, path)
    sinks.append(auth.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAY")), path)
    stored = tables.auth_log(spark, path)
    assert stored.count() == 2 * auth.count() and set(AUTH_LOG.fieldNames()) <= set(stored.columns)
    recent = tables.between(stored, datetime(2024, 1, 4), datetime(2024, 1, 5))
    assert recent.count() == auth.count() and len(recent.inputFiles()) > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    kept = retention.retain(stored, "ts", 1, datetime(2024, 1, 4, 18), whole_days=True)
    assert kept.count() == auth.count()


def test_exports(spark, auth, tmp_path):
    sinks.write_ndjson(auth, str(tmp_path / "json"))
    back = spark.read.schema(AUTH_LOG).json(str(tmp_path / "json"))
    assert back.count() == auth.count() and back.filter("mac_addr IS NULL").count() == auth.filter("mac_addr IS NULL").count()
    assert any(p.name.endswith(".json.gz") for p in (tmp_path / "json").iterdir())
    sinks.export_csv(auth, str(tmp_path / "csv"), 25)
    (part,) = (tmp_path / "csv").glob("part-*")
    lines = part.read_text().splitlines()
    assert len(lines) == 26 and lines[0].startswith("ts,first_seen,last_seen,request_count,username")
    assert len(lines[1].split(",")[0]) == 19


def test_rollup_store_is_idempotent(spark, auth, tmp_path):
    spec, path = rollups.USER_10M, str(tmp_path / "r")
    for n in (0, 1, 1, 2):
        sinks.store_partial(spec.partial(auth.filter(F.col("id") % 3 == n)), path, n)
    want = sorted(map(repr, spec.compute(auth).collect()))
    assert sorted(map(repr, sinks.load_rollup(spark, path, spec).drop("dt").collect())) == want
    sinks.compact_rollup(spark, path, str(tmp_path / "c"), spec)
    assert sorted(map(repr, sinks.load_rollup(spark, str(tmp_path / "c"), spec).drop("dt").collect())) == want


def test_detail_shaping(spark):
    long = "x" * 300
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1), "GDF12345", long, 2, "", None, "low", long, "", "n", 7, 15),
         (2, datetime(2024, 1, 1), None, "bob", "bob", 2, "", None, "low", long, "", "n", 7, 15)],
        "seq long, req_ts timestamp_ntz, resp_ts timestamp_ntz, username string, raw_username string, result_code int, "
        "reply_raw string, reason_zh string, risk string, calling_sta string, mac_addr string, nas_ip string, nas_port long, nas_port_type long",
    ).selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in ("called_sta", "nas_identifier", "nas_port_id", "framed_ip", "src_ip")])
    (r,) = tables.to_auth_log(df).collect()
    assert (r.id, r.latency_ms, len(r.raw_username), len(r.calling_sta), r.mac_addr, r.reason_zh) == (1, 1000, 300, 300, None, "")


def test_reports_read_only_the_days_they_need(spark, auth, tmp_path):
    path = str(tmp_path / "auth")
    sinks.append(auth, path)
    stored = spark.read.parquet(path)
    scan = reports.record_search(stored, datetime(2024, 1, 2), hours=24)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "dt#" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_building_a_batch_query_runs_nothing(spark):
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        for part in (catalog.ROLLUPS, catalog.REPORTS, catalog.STATEFUL, catalog.DECODING):
            for query in part.values():
                query(spark, SF)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_intermediate_results_need_a_shared_folder():
    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "spark://cluster:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.scratch(Elsewhere)


def test_only_whole_days_are_dropped(spark, auth, tmp_path):
    path = str(tmp_path / "auth")
    sinks.append(auth, path)
    sinks.append(auth.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAY")), path)
    (tmp_path / "auth" / "dt=__HIVE_DEFAULT_PARTITION__").mkdir()
    # The day of the cut-off itself stays.
    assert retention.drop_days(spark, path, 1, datetime(2024, 1, 2, 18)) == []
    assert retention.drop_days(spark, path, 1, datetime(2024, 1, 5, 18)) == [date(2024, 1, 1)]
    assert retention.drop_days(spark, path, 1, datetime(2024, 1, 5, 18)) == []
    left = sorted(p.name for p in (tmp_path / "auth").glob("dt=*"))
    assert left == ["dt=2024-01-04", "dt=__HIVE_DEFAULT_PARTITION__"]
    assert tables.auth_log(spark, path).count() == auth.count()
