"""Stateful operators against step-by-step simulations, with and without splitting of hot keys."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from accesslens.operators import accounting, events, latest, pairing, rollups, spans, terminal
from accesslens.schemas import ACCT_LOG, AUTH_LOG

BASE = datetime(2024, 3, 10, 1, 30)  # an hour that daylight saving removes in some zones


def at(ms: int) -> datetime:
    return BASE + timedelta(milliseconds=ms)


def acct_row(i, ms, user="GDF10001", session="s-1", status=3, octets=0, out=0, giga=0, nas="10.0.0.1"):
    values = dict(
        id=i, ts=at(ms), username=user, raw_username=user, acct_status_type=status,
        acct_session_id=session, input_octets=octets, input_gigawords=giga, output_octets=out,
        output_gigawords=0, nas_ip=nas, src_ip="10.0.0.9",
    )
    return tuple(values.get(f) for f in ACCT_LOG.fieldNames())


def auth_row(i, ms, user="GDF10001", result=2, mac=None, latency=None, reason=""):
    values = dict(
        id=i, ts=at(ms), req_ts=at(ms), latency_ms=latency, username=user, raw_username=user,
        result=result, reply_msg="", reason_zh=reason, risk_level="unknown", mac_addr=mac,
        nas_ip="10.0.0.1", src_ip="10.0.0.1", nas_port_id="p",
    )
    return tuple(values.get(f) for f in AUTH_LOG.fieldNames())


# --- Down-sampling ---


def test_sample_table_case(spark):
    rows = [acct_row(i, s * 1000) for i, s in enumerate([0, 30, 59, 60, 61, 119, 120, 200])]
    rows += [acct_row(100, 1000, status=1), acct_row(101, 1000, status=2)]
    rows += [acct_row(102 + i, 1000 + i, user=None, session=None) for i in range(3)]
    got = accounting.sample_interim(spark.createDataFrame(rows, ACCT_LOG))
    assert sorted(r.id for r in got.collect()) == [0, 3, 6, 7, 100, 101, 102, 103, 104]


# Chunks of half a second are shorter than the interval, and their spans fill three levels.
@pytest.mark.parametrize("chunk_ms", [500, 60_000, 3_600_000])
def test_sample_equals_simulation(spark, chunk_ms):
    rnd = random.Random(7)
    rows = []
    for i in range(4000):
        # A third of all rows belong to one session, dense enough to have no pause.
        hot = rnd.random() < 0.34
        rows.append(acct_row(
            i, rnd.randrange(0, 1_200_000), session="hot" if hot else f"s-{rnd.randrange(40)}",
            status=rnd.choice([3, 3, 3, 3, 1]),
        ))
    expect, last = set(), {}
    fields = ACCT_LOG.fieldNames()
    for r in sorted((dict(zip(fields, r)) for r in rows), key=lambda r: (r["ts"], r["id"])):
        key = r["acct_session_id"]
        if r["acct_status_type"] != 3:
            expect.add(r["id"])
        elif key not in last or r["ts"] - last[key] >= timedelta(seconds=20):
            expect.add(r["id"])
            last[key] = r["ts"]
    got = accounting.sample_interim(
        spark.createDataFrame(rows, ACCT_LOG).repartition(8), 20, chunk_ms=chunk_ms
    )
    assert {r.id for r in got.collect()} == expect


# --- Counter deltas ---


def simulate_deltas(rows, start_resets=False):
    state, out = {}, {}
    for r in sorted(rows, key=lambda r: (r["ts"], r["id"])):
        total = ((r["input_gigawords"] << 32) + r["input_octets"], r["output_octets"])
        grown, fell = (0, 0), 0
        if r["acct_session_id"]:
            key = (r["username"], r["nas_ip"], r["acct_session_id"])
            before = state.get(key)
            fresh = before is None or r["ts"] - before[1] > timedelta(days=2)
            if not fresh and not (start_resets and r["acct_status_type"] == 1):
                diff = [a - b for a, b in zip(total, before[0])]
                grown, fell = tuple(max(d, 0) for d in diff), int(min(diff) < 0)
            state[key] = (total, r["ts"])
            if r["acct_status_type"] == 2:
                del state[key]
        out[r["id"]] = (*grown, fell)
    return out


@pytest.mark.parametrize("chunk_ms", [60_000, 6 * 3_600_000, 10**12])
@pytest.mark.parametrize("start_resets", [False, True])
def test_deltas_equal_simulation(spark, chunk_ms, start_resets):
    rnd = random.Random(11)
    rows = []
    for i in range(5000):
        hot = rnd.random() < 0.34
        rows.append(acct_row(
            i, rnd.randrange(0, 12 * 86_400_000), user="GDF1" if hot else f"GDF{rnd.randrange(60)}",
            session="hot" if hot else rnd.choice(["a", "b", "", None]),
            status=rnd.choice([3, 3, 3, 2, 1, None]), octets=rnd.randrange(1000),
            out=rnd.randrange(1000), giga=rnd.randrange(3),
        ))
    df = spark.createDataFrame(rows, ACCT_LOG).repartition(8)
    got = accounting.accounting_deltas(
        df, scale=1, start_resets=start_resets, chunk_ms=chunk_ms
    )
    fields = ACCT_LOG.fieldNames()
    expect = simulate_deltas([dict(zip(fields, r)) for r in rows], start_resets)
    have = {r.id: (r.input_delta, r.output_delta, r.counter_rollback) for r in got.collect()}
    assert have == expect


def test_corrupt_counters_saturate(spark):
    rows = [acct_row(0, 0, octets=5), acct_row(1, 1000, octets=2**32 - 1, giga=2**32 - 1)]
    got = accounting.accounting_deltas(spark.createDataFrame(rows, ACCT_LOG)).orderBy("id").collect()
    assert got[0].input_total == 5 * 1024
    assert got[1].input_total == 2**62 - 1 and got[1].input_delta == 2**62 - 1 - 5 * 1024
    rows = [acct_row(i, i, session=f"s{i // 2}", octets=i % 2, giga=(i % 2) * (2**32 - 1)) for i in range(8)]
    deltas = accounting.accounting_deltas(spark.createDataFrame(rows, ACCT_LOG)).withColumns(
        {"event_time": F.col("ts"), "event_id": F.col("id")})
    assert rollups.acct_rollup_1h(deltas).first().input_bytes == 2**63 - 1
    assert rollups.acct_rollup_1h_exact(deltas).first().input_bytes == 2**63 - 1


def test_deltas_of_repeated_record(spark):
    """Two reports five minutes apart, the second delivered twice; then another account and a reset."""
    rows = [
        acct_row(1, 0, octets=100, out=200), acct_row(2, 300_000, octets=160, out=290),
        acct_row(2, 300_000, octets=160, out=290), acct_row(3, 0, user="GDF10002", octets=80),
        acct_row(4, 600_000, octets=50, out=290),
    ]
    df = accounting.dedup_events(accounting.with_event_id(spark.createDataFrame(rows, ACCT_LOG)))
    got = {r.id: r for r in accounting.accounting_deltas(df, tie="event_id").collect()}
    assert len(got) == 4
    assert (got[1].input_delta, got[1].output_delta) == (0, 0)
    assert (got[2].input_delta, got[2].output_delta) == (61440, 92160)
    assert (got[3].input_delta, got[3].counter_rollback) == (0, 0)
    assert (got[4].input_delta, got[4].output_delta, got[4].counter_rollback) == (0, 0, 1)


# --- Pairing ---


def simulate_pairs(packets, ttl):
    open_, pairs, unmatched, expired = {}, {}, set(), set()
    for p in sorted(packets, key=lambda p: (p["at"], p["seq"])):
        held = open_.get(p["flow"])
        if held and p["at"] - held["at"] > ttl:
            expired.add(held["seq"])
            held = open_.pop(p["flow"]) and None
        if p["request"]:
            open_[p["flow"]] = p
        elif held:
            pairs[p["seq"]] = held["seq"]
            del open_[p["flow"]]
        else:
            unmatched.add(p["seq"])
    return pairs, unmatched, expired | {p["seq"] for p in open_.values()}


@pytest.mark.parametrize("chunk_s", [60, 300, 10**6])
def test_pairing_equals_simulation(spark, chunk_s):
    rnd = random.Random(3)
    packets, rows = [], []
    for seq in range(4000):
        flow = 0 if rnd.random() < 0.34 else rnd.randrange(200)
        ms = rnd.randrange(0, 3_600_000 if flow else 36_000_000)
        if seq % 500 == 0:
            ms = (ms // 60_000) * 60_000  # right on a chunk border
        request = rnd.random() < 0.6
        packets.append(dict(seq=seq, at=at(ms), flow=flow, request=request))
        role = (seq,)
        rows.append((seq, at(ms), flow, "c", 1, "s", 2, role if request else None, None if request else role))
    df = spark.createDataFrame(
        rows, "seq long, at timestamp_ntz, packet_identifier int, client_ip string, client_port int, "
        "server_ip string, server_port int, request struct<seq: long>, response struct<seq: long>",
    ).repartition(8)
    got = pairing.auth_exchanges(df, 30, chunk_s).collect()
    pairs, unmatched, expired = simulate_pairs(packets, timedelta(seconds=30))
    assert len(got) == 4000
    assert {r.seq: r.matched.seq for r in got if r.matched} == pairs
    assert {r.seq for r in got if r.response and not r.matched} == unmatched
    assert {r.seq for r in got if r.is_expired} == expired
    assert len(set(pairs.values())) == len(pairs)


# --- Spans ---


def test_span_gap_is_inclusive(spark):
    gap = 600_000
    rows = [auth_row(1, 0), auth_row(2, gap), auth_row(3, 2 * gap + 1), auth_row(4, 5 * gap, result=3)]
    got = spans.auth_event_spans(spark.createDataFrame(rows, AUTH_LOG)).orderBy("first_seen").collect()
    assert [(r.result, r.request_count) for r in got] == [(2, 2), (2, 1), (3, 1)]
    assert got[0].last_seen == at(gap)


def test_spans_equal_simulation(spark):
    rnd = random.Random(5)
    rows = [
        auth_row(i, rnd.randrange(0, 40_000_000), user=f"GDF{0 if rnd.random() < .34 else rnd.randrange(30)}",
                 result=rnd.choice([2, 3]), latency=rnd.choice([None, rnd.randrange(100)]))
        for i in range(3000)
    ]
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        spans_ = groups.setdefault((r[4], r[6]), [])
        if spans_ and r[1] - spans_[-1][1] <= timedelta(minutes=10):
            spans_[-1][1] = r[1]
            spans_[-1][2] += 1
            spans_[-1][3] += r[3] or 0
        else:
            spans_.append([r[1], r[1], 1, r[3] or 0])
    expect = sorted((*k, *s) for k, v in groups.items() for s in v)
    got = spans.auth_event_spans(spark.createDataFrame(rows, AUTH_LOG)).collect()
    have = sorted(
        (r.username, r.result, r.first_seen, r.last_seen, r.request_count, r.latency_sum_ms) for r in got
    )
    assert have == expect


# --- Rollups ---


@pytest.mark.parametrize("rollup", [
    rollups.STAT_10M, rollups.REASON_10M, rollups.NAS_10M, rollups.USER_10M, rollups.USER_MAC_10M,
    rollups.WIDE_10M, rollups.USER_SUMMARY, rollups.NAS_STATS, rollups.USER_MAC_SUMMARY,
    rollups.AUTH_STATES_10M,
], ids=lambda r: r.name)
def test_merge_of_any_split_is_the_whole(spark, rollup):
    rnd = random.Random(2)
    rows = [
        auth_row(i, rnd.randrange(0, 3_000_000), user=f"GDF{rnd.randrange(5)}", result=rnd.choice([2, 3, 11]),
                 mac=rnd.choice([None, "m1", "m2"]), latency=rnd.choice([None, 5, 9]),
                 reason=rnd.choice(["", "r1", "r2"]))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, AUTH_LOG)
    parts = [rollup.partial(df.filter(F.pmod(F.hash("id"), F.lit(3)) == n)) for n in range(3)]
    merged = rollups.final(rollup, rollups.merge_rollup(rollup, rollup.merge(parts[2], parts[0]), parts[1]))
    whole = rollup.compute(df)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.select(merged.columns).collect()))


def test_challenge_counts_as_request_only(spark):
    df = spark.createDataFrame([auth_row(1, 0, result=11), auth_row(2, 1, result=2)], AUTH_LOG)
    row = rollups.rollup_stat_10m(df).first()
    assert (row.request_count, row.accept_count, row.reject_count) == (2, 1, 0)
    assert rollups.nas_stats(df).first().reject_cnt == 1


def test_sketch_estimate_is_mergeable(spark):
    acct = spark.createDataFrame([acct_row(i, i * 1000, session=f"s{i % 50}") for i in range(500)], ACCT_LOG)
    deltas = accounting.accounting_deltas(acct).withColumns({"event_time": F.col("ts"), "event_id": F.col("id")})
    halves = [rollups.ACCT_1H.partial(deltas.filter(F.col("id") % 2 == n)) for n in (0, 1)]
    merged = rollups.ACCT_1H.final(rollups.ACCT_1H.merge(*halves)).first()
    assert merged.sessions == 50 == rollups.acct_rollup_1h_exact(deltas).first().sessions


# --- Others ---


def test_newest_equals_plain_top_k(spark):
    rnd = random.Random(4)
    rows = [auth_row(i, rnd.randrange(0, 600_000)) for i in range(2000)]
    df = spark.createDataFrame(rows, AUTH_LOG)
    for k in (0, 1, 57, 1999, 5000):
        want = [r.id for r in df.orderBy(F.desc("ts"), F.desc("id")).limit(k).collect()]
        assert [r.id for r in latest.newest(df, k).collect()] == want


def test_terminal_path_takes_newest_completed(spark):
    ev = spark.createDataFrame(
        [auth_row(1, 0, mac="aa:bb:cc:dd:ee:ff"), auth_row(2, 7_200_000, mac="aa:bb:cc:dd:ee:ff"),
         auth_row(3, 90_000_000, mac="aa:bb:cc:dd:ee:ff"), auth_row(4, 0, mac="00:00:00:00:00:01"),
         auth_row(5, 0)], AUTH_LOG)
    snaps = spark.createDataFrame(
        [(1, "b1", at(-10), 1, "x", "AABBCCDDEEFF"), (2, "b2", at(3_600_000), 2, "y", "aabbccddeeff"),
         (3, "bad", at(3_700_000), 3, "z", "aabbccddeeff"), (4, "b3", at(100_000_000), 4, "w", "aabbccddeeff")],
        "id long, batch_id string, collected_at timestamp_ntz, olt_device_id int, onu_mac string, terminal_mac string",
    ).selectExpr("*", "'o' AS olt_name", "1 AS vlan_id", "'i' AS if_index", "'p' AS port_name")
    batches = spark.createDataFrame(
        [("b1", "completed"), ("b2", "completed"), ("bad", "partial"), ("b3", "completed")], "batch_id string, status string")
    got = {r.id: r.batch_id for r in terminal.terminal_path(ev, snaps, batches).collect()}
    assert got == {1: "b1", 2: "b2", 3: "b2", 4: None, 5: None}


def test_control_events_keep_evidence(spark):
    control = spark.createDataFrame(
        [(at(0), "GDF12345", 42, "Disconnect-NAK", 503, 3799, 51000, 8, "session-control")],
        "ts timestamp_ntz, username string, result_code int, result string, error_cause long, src_port int, "
        "dst_port int, packet_identifier int, acct_session_id string",
    )
    nothing = spark.createDataFrame([], "resp_ts timestamp_ntz, req_ts timestamp_ntz, ts timestamp_ntz, event_id string")
    row = events.aaa_events(nothing, nothing, events.identify(control)).first()
    assert (row.event_type, row.error_cause, row.src_port, row.packet_identifier) == ("control", 503, 3799, 8)
    assert (row.nas_ip, row.input_total) == ("", 0)


def test_identifiable(spark):
    schema = "username string, acct_status_type long, nas_ip string, src_ip string, acct_session_id string, mac_addr string"
    rows = [("GDF1", 3, None, None, None, None), ("(未匹配)", 3, "n", None, "s", "m"), ("(未匹配)", 7, "n", None, None, None),
            ("", 8, "", "x", None, None), ("", 15, "", None, None, None), ("GDF1", None, None, None, None, None)]
    df = spark.createDataFrame(rows, schema)
    assert accounting.identifiable_accounting(df).count() == 4
    assert accounting.identifiable_auth(df).count() == 2
    assert accounting.identifiable_control(df).count() == 4
