"""Tables kept by commits, and streams worked on in the order of event time."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accesslens.operators import accounting, retention, rollups, spans
from accesslens.schemas import ACCT_LOG
from accesslens.sources import fixtures, metrics
from accesslens.sources.store import TableSet
from accesslens.streaming import ordered

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(spark, tmp_path):
    return TableSet(spark, str(tmp_path / "set"))


def rows(spark, *found):
    return spark.createDataFrame([(i, datetime(2024, 1, d, h)) for i, d, h in found], "id long, ts timestamp_ntz")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_commit_shows_all_tables_at_once(spark, tables):
    reader = TableSet(spark, tables.path)
    schema = rows(spark).schema
    tables.stage(rows(spark, (1, 1, 0)), "a", day="ts")
    tables.stage(rows(spark, (2, 1, 0)), "b")
    assert ids(reader.read("a", schema)) == [] and not reader.refresh().has("x")
    with pytest.raises(ValueError):
        reader.read("a")
    tables.commit("x", datetime(2024, 1, 1))
    reader.refresh()
    assert (ids(reader.read("a")), ids(reader.read("b")), reader.has("x"), reader.mark()) == ([1], [2], True, datetime(2024, 1, 1))
    tables.stage(rows(spark, (9, 1, 0)), "a", day="ts")
    tables.discard()  # as after a failure
    tables.stage(rows(spark, (3, 2, 0)), "a", day="ts")
    tables.stage(rows(spark, (4, 1, 0)), "b", replace=True)
    tables.commit("y")
    reader.refresh()
    assert (ids(reader.read("a")), ids(reader.read("b")), reader.mark()) == ([1, 3], [4], datetime(2024, 1, 1))
    assert tables.vacuum("b") == 1 and ids(reader.read("b")) == [4]


def test_compaction_and_retention_switch_over(spark, tables):
    for batch, day in enumerate((1, 2, 3)):
        tables.stage(rows(spark, *[(10 * batch + h, day, h) for h in (1, 13)], (90 + batch, 20, 0)), "t", day="ts")
        tables.commit(batch)
    old = tables.read("t")
    tables.compact("t", date(2024, 1, 3), lambda df: df.filter("id <> 1"), "ts")
    found = ids(tables.read("t"))
    assert found == sorted(set(ids(old)) - {1})
    late = rows(spark, (55, 1, 5))  # a late row for a compacted day is a commit like any other
    tables.stage(late, "t", day="ts")
    tables.commit("late")
    assert ids(tables.read("t")) == sorted([*found, 55])
    for _ in range(2):
        retention.retain_tables(tables, {"t": 10}, datetime(2024, 1, 12, 12))
    assert ids(tables.read("t")) == sorted(r.id for r in old.filter(F.col("ts") >= F.lit("2024-01-02 12:00:00").cast("timestamp_ntz")).collect())
    assert "dt" in tables.read("t").columns
    with pytest.raises(ValueError):
        tables.stage(late, "plain")
        tables.commit("plain")
        tables.retain("plain", datetime(2024, 1, 1), "ts")
    before = ids(tables.read("t"))
    tables.vacuum("t")
    assert ids(tables.read("t")) == before


def test_reports_prune_days(spark, tables):
    tables.stage(rows(spark, (1, 1, 0), (2, 9, 0)), "t", day="ts")
    tables.commit(0)
    plan = tables.read("t").filter(F.col("dt") >= F.lit(date(2024, 1, 5)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def taken(spark, tables, batches, step, ts="ts", delay=timedelta(minutes=10)):
    for number, batch in enumerate(batches):
        for _ in range(2):  # a repeated batch changes nothing
            ordered.take(batch, number, tables, step, ts, delay)
    ordered.flush(tables, step, delay)
    ordered.flush(tables, step, delay)


@pytest.fixture(scope="module")
def acct(spark):
    return fixtures.acct_log(fixtures.events(spark, SF)).cache()


@pytest.fixture(scope="module")
def auth(spark):
    return fixtures.auth_log(fixtures.events(spark, SF), 600).cache()


def split(df, minutes):
    """By time, with some rows one batch late; and a row without a time."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    n = F.floor((F.col("ts") - start).cast("interval second").cast("decimal(20,6)") / (minutes * 60)) + F.when(F.col("id") % 9 == 0, 1).otherwise(0)
    numbered = df.withColumn("n", n.cast("int"))
    last = numbered.agg(F.max("n")).first()[0]
    batches = [numbered.filter(F.col("n") == i).drop("n") for i in range(last + 1)]
    nameless = df.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")).withColumn("id", F.lit(-1).cast("long"))
    return [batches[0].unionByName(nameless), *batches[1:], batches[0].limit(0)]


def test_nothing_is_lost(spark, tables, acct):
    taken(spark, tables, split(acct, 240), ordered.deltas())
    late, emitted = ids(tables.read("late")), ids(tables.read("deltas"))
    assert sorted(late + emitted) == sorted([-1, *ids(acct)])
    assert -1 in late and len(late) > 5 and len(emitted) > 100
    assert sum(r.late_rows for r in ordered.late_counts(tables).collect()) == len(late)
    on_time = acct.join(tables.read("late").select("id"), "id", "left_anti")
    names = ["id", "input_total", "input_delta", "output_delta", "counter_rollback"]
    want = accounting.accounting_deltas(on_time).select(names).collect()
    assert sorted(tables.read("deltas").select(names).collect()) == sorted(want)


def test_spans_and_buckets_are_emitted_once(spark, tables, auth):
    spec = rollups.USER_10M
    rollup_step, spans_step = ordered.rollup(spec), ordered.spans()

    def both(ready, turn):
        rollup_step(ready, turn)
        spans_step(ready, turn)

    taken(spark, tables, split(auth, 24), both)
    on_time = auth.join(tables.read("late").select("id"), "id", "left_anti")
    want = spec.compute(on_time)
    assert sorted(map(repr, tables.read(spec.name).select(want.columns).collect())) == sorted(map(repr, want.collect()))
    want = spans.auth_event_spans(on_time)
    assert sorted(map(repr, tables.read("spans").select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_empty_streams(spark, tables):
    for batch in range(2):
        ordered.take(spark.createDataFrame([], ACCT_LOG), batch, tables, ordered.deltas(), "ts", timedelta(minutes=1))
    assert tables.read("late").count() == 0 and tables.mark() is None


def test_newest_version_of_counters(spark, tables):
    def counters(*found):
        return spark.createDataFrame([(datetime(2024, 1, d, h), n) for d, h, n in found], "metric_time timestamp_ntz, auth_records long")

    def seen(*bounds):
        return sorted((r.metric_time.day, r.metric_time.hour, r.auth_records) for r in metrics.current(tables, *bounds).collect())

    first = counters((1, 0, 5), (1, 12, 6), (2, 0, 7))
    assert metrics.record(tables, first, "a", datetime(2024, 1, 3))
    assert metrics.record(tables, counters((1, 12, 8)), "b", datetime(2024, 1, 4))
    assert not metrics.record(tables, counters((1, 12, 9)), "b", datetime(2024, 1, 5))  # delivered again
    assert metrics.record(tables, counters((2, 0, 1)), "c", datetime(2024, 1, 1))  # an older version comes late
    assert metrics.record(tables, counters((2, 0, 30)), "d", datetime(2024, 1, 1), collector="other")
    want = [(1, 0, 5), (1, 12, 8), (2, 0, 7), (2, 0, 30)]
    assert seen() == want
    metrics.compact(tables, date(2024, 1, 2))
    assert seen() == want and tables.read(metrics.RELATION).filter("dt = '2024-01-01'").count() == 2
    assert tables.read(metrics.RELATION).filter("dt = '2024-01-02'").count() == 3  # not folded yet
    assert seen(datetime(2024, 1, 1, 12), datetime(2024, 1, 2)) == [(1, 12, 8)]
