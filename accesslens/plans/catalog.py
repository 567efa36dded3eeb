"""Named queries over the test tables: one entry per operator and report."""

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from accesslens.functions import keys, text, times
from accesslens.operators import (
    accounting, decode, events, latest, pairing, quality, retention, rollups, spans, staging,
    terminal,
)
from accesslens.plans import ingest, reports
from accesslens.sources import fixtures, metrics, packets, sinks, tables
from accesslens.sources.store import TableSet
from accesslens.streaming import ingest as stream_ingest, ordered, stateful, windows, writes
from accesslens.sources.fixtures import NOW

Query = Callable[[SparkSession, str], DataFrame]


def _over_auth(fn: Callable[[DataFrame], DataFrame], factor: int = 60) -> Query:
    return lambda spark, sf_dir: fn(fixtures.auth_log(fixtures.events(spark, sf_dir), factor))


def _over_acct(fn: Callable[[DataFrame], DataFrame], factor: int = 60) -> Query:
    return lambda spark, sf_dir: fn(fixtures.acct_log(fixtures.events(spark, sf_dir), factor))


def _joined_lists(summary: DataFrame) -> DataFrame:
    return summary.withColumns({
        c: F.array_join(c, ",") for c in ("mac_list", "nas_list")
    })


def _ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.events(spark, sf_dir)
    stat = rollups.rollup_stat_10m(fixtures.auth_log(ev))
    return reports.ingest_status(stat, fixtures.acct_log(ev), NOW)


def _decimals_to_bigint(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(c).cast("bigint").alias(c) if t.startswith("decimal") else F.col(c)
        for c, t in df.dtypes
    ])


ROLLUPS: dict[str, Query] = {
    "rollup_stat_10m": _over_auth(rollups.rollup_stat_10m),
    "rollup_reason_10m": _over_auth(rollups.rollup_reason_10m),
    "rollup_nas_10m": _over_auth(rollups.rollup_nas_10m),
    "rollup_user_10m": _over_auth(rollups.rollup_user_10m),
    "rollup_user_mac_10m": _over_auth(rollups.rollup_user_mac_10m),
    "rollup_auth_wide_10m": _over_auth(rollups.rollup_auth_wide_10m),
    "user_summary": _over_auth(lambda a: _joined_lists(rollups.user_summary(a))),
    "nas_stats": _over_auth(rollups.nas_stats),
    "user_mac_summary": _over_auth(rollups.user_mac_summary),
    "auth_rollup_states": _over_auth(rollups.auth_rollup_10m_states),
}

REPORTS: dict[str, Query] = {
    "stats": _over_auth(lambda a: reports.stats(rollups.rollup_stat_10m(a), NOW)),
    "recent": _over_auth(reports.recent),
    "record_search": _over_auth(
        lambda a: reports.record_search(a, NOW, mac="0200.0000.0001", result=3)
    ),
    "record_search_account": _over_auth(
        lambda a: reports.record_search(a, NOW, hours=24, username=" gdf10003 ")
    ),
    "user_detail": _over_auth(lambda a: reports.user_detail(a, "GDF10005")),
    "timeline": _over_auth(
        lambda a: reports.timeline(rollups.rollup_stat_10m(a), NOW, interval_min=30)
    ),
    "top_reject": _over_auth(lambda a: reports.top_reject(rollups.rollup_user_10m(a), NOW)),
    "risk_accounts": _over_auth(lambda a: reports.risk_accounts(
        rollups.rollup_user_10m(a), NOW, page=2, page_size=20, min_count=30
    )),
    "multi_mac_summary": _over_auth(
        lambda a: reports.multi_mac_summary(rollups.rollup_user_mac_10m(a), NOW, min_mac=3)
    ),
    "multi_mac_detail": _over_auth(
        lambda a: reports.multi_mac_detail(rollups.rollup_user_mac_10m(a), NOW, min_mac=3)
    ),
    "reason_distribution": _over_auth(
        lambda a: reports.reason_distribution(rollups.rollup_reason_10m(a), NOW)
    ),
    "nas_distribution": _over_auth(
        lambda a: reports.nas_distribution(rollups.rollup_nas_10m(a), NOW)
    ),
    "ingest_status": _ingest_status,
    "acct_dashboard_stats": _over_acct(
        lambda a: _decimals_to_bigint(reports.acct_dashboard_stats(a))
    ),
    "acct_dashboard_sessions": _over_acct(reports.acct_dashboard_sessions),
    "acct_history": _over_acct(lambda a: reports.acct_history(a, "gdf10007", NOW)),
    "latest_per_session": _over_acct(lambda a: latest.latest_per_session(a).select(
        "id", "ts", "username", "nas_ip", "acct_session_id", "acct_status_type", "session_key"
    )),
}


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.capture(fixtures.all_rows(_spread(fixtures.events(spark, sf_dir))))


def _spread(ev: DataFrame) -> DataFrame:
    """Encoding is heavy and splits are few, so the rows are dealt first: to as many tasks as shuffles have, which
    grows with the cluster that an input needs, not only with its cores."""
    return staging.dealt(ev, "event_id")


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.decode_stage(_frames(spark, sf_dir))


def _decoded_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For several kinds of records: their readers share the datagrams."""
    return ingest.decode_stage(_frames(spark, sf_dir), keep=lambda d: staging.shared(d, "seq"))


def _over_decoded(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_decoded(spark, sf_dir))


def _deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    acct = fixtures.acct_log(fixtures.events(spark, sf_dir))
    return accounting.accounting_deltas(acct).withColumns({
        "event_time": F.col("ts"), "event_id": F.col("id"),
    })


def _dedup(acct: DataFrame) -> DataFrame:
    copies = fixtures.with_duplicates(acct)
    return accounting.dedup_events(accounting.with_event_id(copies)).drop("event_id")


def _versions(auth: DataFrame) -> DataFrame:
    versioned = auth.select("username", "nas_ip", "result", F.col("id").alias("version"))
    return latest.latest_version(versioned, ["username", "result"], "version")


def _merged(auth: DataFrame) -> DataFrame:
    """The terminal rollup from three partial inputs, folded in two steps."""
    spec = rollups.USER_MAC_10M
    first, second, third = (spec.partial(auth.filter(F.col("id") % 3 == n)) for n in range(3))
    return rollups.final(spec, rollups.merge_rollup(spec, spec.merge(third, first), second))


def _terminal_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    auth = fixtures.auth_log(fixtures.events(spark, sf_dir))
    snapshots, batches = fixtures.snapshots(auth)
    # Addresses that name no terminal, on both sides, and other spellings of those that do.
    seen = auth.selectExpr("id", "ts", """CASE id % 19 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'zz'
        WHEN 4 THEN upper(replace(mac_addr, ':', '-')) ELSE mac_addr END AS mac_addr""")
    nameless = snapshots.withColumn("terminal_mac", F.when(F.col("id") % 2 == 0, "--"))
    return terminal.terminal_path(seen, snapshots.unionByName(nameless), batches)


def _text_functions(auth: DataFrame) -> DataFrame:
    raw = F.concat(F.lit("\u0001"), "raw_username", F.when(F.col("id") % 2 == 0, "!").otherwise(""))
    mixed = (
        F.when(F.col("id") % 4 == 0, raw).when(F.col("id") % 4 == 1, F.col("nas_port_id"))
        .when(F.col("id") % 4 == 2, F.concat(F.lit(" "), F.col("id").cast("string"), F.lit("\t")))
        .otherwise("")
    )
    reason, risk = keys.reply_reason(F.col("reply_msg"))
    return auth.select(
        "id", text.normalize_mac(F.col("calling_sta")).alias("mac"),
        text.normalize_mac(F.col("called_sta")).alias("not_a_mac"),
        text.normalize_username(mixed).alias("username"),
        text.is_business_account(F.trim(mixed)).alias("is_business"),
        text.clip_or_null(F.col("called_sta"), 4).alias("clipped"),
        reason.alias("reason"), risk.alias("risk"), keys.code_name(F.col("result")).alias("code_name"),
        keys.code_name(F.col("id") % 50).alias("any_code_name"),
        keys.stable_key(*[F.col(c) for c in ("username", "mac_addr", "result")]).alias("stable_key"),
        times.latency_ms(F.col("req_ts"), F.col("ts")).alias("latency"),
        times.slot_label(F.col("ts"), 420).alias("slot"),
        times.parse_timestamp(F.col("req_ts").cast("string"), F.col("ts")).alias("parsed"),
    )


STATEFUL: dict[str, Query] = {
    "dedup_events": _over_acct(_dedup),
    "sample_interim": _over_acct(
        lambda a: accounting.sample_interim(a, 300).select("id", "ts", "username", "acct_status_type"),
        factor=600,
    ),
    "accounting_deltas": lambda spark, sf_dir: _deltas(spark, sf_dir).select(
        "id", "input_total", "output_total", "input_delta", "output_delta", "counter_rollback"
    ),
    "acct_rollup_1h_exact": lambda spark, sf_dir: rollups.acct_rollup_1h_exact(_deltas(spark, sf_dir)),
    "acct_rollup_1h_sketch": lambda spark, sf_dir: rollups.acct_rollup_1h(_deltas(spark, sf_dir)),
    "event_spans": _over_auth(spans.auth_event_spans, factor=600),
    "latest_version": _over_auth(_versions),
    "merge_rollup": _over_auth(_merged),
    "retention": _over_auth(lambda a: retention.retain(
        tables.with_partition(a), "ts", 0, NOW.replace(hour=7, minute=30)
    ).select("id", "ts", "dt")),
    "terminal_path": _terminal_path,
    "text_functions": _over_auth(_text_functions),
}

def _event_views(decoded: DataFrame) -> DataFrame:
    """Rows per typed view and result of the unified table."""
    # A view's filter empties the other branches of the union, so no branch is worked out twice.
    unified = ingest.unified(ingest.records(decoded))
    views = [events.auth_events, events.accounting_events, events.control_events]
    counts = [
        view(unified).groupBy("event_type", "result_code").agg(F.count("*").alias("n"))
        for view in views
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


DECODING: dict[str, Query] = {
    "extract_udp": lambda spark, sf_dir: decode.extract_udp(_frames(spark, sf_dir)).select(
        "seq", "pkt_time", "src_ip", "dst_ip", "src_port", "dst_port",
        F.length("payload").alias("payload_length"),
    ),
    "decode_accounting": _over_decoded(decode.project_accounting),
    "decode_control": _over_decoded(decode.project_control),
    "pair_auth": _over_decoded(pairing.pair_auth),
    "unmatched_responses": _over_decoded(
        lambda d: pairing.unmatched_responses(d).select("seq", "resp_ts", "result_code", "dst_ip")
    ),
    "expired_requests": _over_decoded(
        lambda d: pairing.expired_requests(d).select("seq", "req_ts", "username", "src_ip")
    ),
    "stream_quality": lambda spark, sf_dir: quality.stream_quality(staging.shared(_frames(spark, sf_dir), "seq")),
    "decode_requests": _over_decoded(decode.project_request),
    "business_auth_log": lambda spark, sf_dir: accounting.business_only(
        tables.to_auth_log(pairing.pair_auth(_decoded(spark, sf_dir)))
    ).select("id", "username", "result"),
    "event_views": lambda spark, sf_dir: _event_views(_decoded_once(spark, sf_dir)),
    "aaa_events": lambda spark, sf_dir: ingest.unified(
        ingest.records(_decoded_once(spark, sf_dir))
    ).drop("event_id"),
    "auth_log_from_packets": _over_decoded(
        lambda d: tables.to_auth_log(ingest.records(d).auth)
    ),
    "acct_log_from_packets": _over_decoded(
        lambda d: tables.to_acct_log(ingest.records(d).accounting)
    ),
}


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.event_stream(spark, sf_dir)


def _drain(stream: DataFrame) -> DataFrame:
    """Everything the stream yields for the input there is, through a Parquet sink."""
    spark = stream.sparkSession
    base = staging.scratch(spark)
    stream.writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/state"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    acct = fixtures.acct_log(_stream_events(spark, sf_dir))
    return _drain(stateful.stream_deltas(acct).select(
        "id", "input_total", "output_total", "input_delta", "output_delta", "counter_rollback"
    ))


def _stream_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    acct = fixtures.acct_log(_stream_events(spark, sf_dir), 600)
    return _drain(stateful.stream_sample(acct, 300).select("id", "ts", "username", "acct_status_type"))


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = fixtures.with_duplicates(fixtures.acct_log(_stream_events(spark, sf_dir)))
    marked = accounting.with_event_id(copies).withColumn("event_time", F.col("ts"))
    return _drain(windows.stream_dedup(marked).drop("event_id", "event_time"))


def _stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    auth, base = fixtures.auth_log(_stream_events(spark, sf_dir)), staging.scratch(spark)
    writer = writes.stream_merge(auth, f"{base}/out", rollups.USER_MAC_10M, f"{base}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sinks.load_rollup(spark, f"{base}/out", rollups.USER_MAC_10M).drop("dt")


def _stream_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = packets.capture(fixtures.all_rows(_spread(_stream_events(spark, sf_dir))))
    return _drain(stateful.stream_pair(ingest.decode_stage(captured)))


def _stream_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    auth, base = fixtures.auth_log(_stream_events(spark, sf_dir)), staging.scratch(spark)
    writer = writes.stream_writes(auth, f"{base}/out", f"{base}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    return sinks.load_rollup(spark, f"{base}/out/{rollups.STAT_10M.name}", rollups.STAT_10M).drop("dt")


STREAMING: dict[str, Query] = {
    "stream_deltas": _stream_deltas,
    "stream_sample": _stream_sample,
    "stream_dedup": _stream_dedup,
    "stream_merge": _stream_merge,
    "stream_pair": _stream_pair,
    "stream_writes": _stream_writes,
}


# --- Streams in the order of event time, over slices of which some rows come late -----------------


def _in_order(
    rows: DataFrame, step: ordered.Step, ts: str = "ts", delay: timedelta = timedelta(minutes=10), **delivery,
) -> TableSet:
    spark, base = rows.sparkSession, staging.scratch(rows.sparkSession)
    stream, found = None, TableSet(spark, f"{base}/out")
    for _ in fixtures.delivered(rows, f"{base}/in", ts, **delivery):
        # A slice is many files, so it is delivered as the one micro-batch of all that is new.
        stream = stream or spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        ordered.in_order(stream, found, step, f"{base}/state", ts, delay).trigger(availableNow=True).start().awaitTermination()
    ordered.flush(found, step, delay)
    return found


def _with_late(found: TableSet, emitted: DataFrame, key: str) -> DataFrame:
    """What a stream emitted and, marked, the keys in its side table."""
    late = found.read(ordered.LATE).select(F.col(key), F.lit(True).alias("is_late"))
    return emitted.withColumn("is_late", F.lit(False)).unionByName(late, allowMissingColumns=True)


def _late_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _in_order(fixtures.acct_log(fixtures.events(spark, sf_dir)), ordered.deltas())
    return _with_late(found, found.read("deltas").select(
        "id", "input_total", "output_total", "input_delta", "output_delta", "counter_rollback"), "id")


def _late_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _in_order(fixtures.acct_log(fixtures.events(spark, sf_dir), 600), ordered.sample(interval_s=300), minutes=24)
    return _with_late(found, found.read("sampled").select("id", "ts", "username", "acct_status_type"), "id")


def _late_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _spread(fixtures.events(spark, sf_dir))
    decoded = ingest.decode_stage(packets.capture(fixtures.all_rows(ev.filter("event_type IN ('signup', 'purchase', 'error')"))))
    found = _in_order(pairing.auth_packets(decoded), ordered.pair(), "at", timedelta(seconds=10), key="seq", delayed="{key} div 8 % 40 = 0")
    return _with_late(found, found.read("exchanges").select(
        "seq", F.col("matched").isNotNull().alias("is_matched"), "is_expired"), "seq")


def _late_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a rollup emitted once, and late rows per interval."""
    found = _in_order(fixtures.auth_log(fixtures.events(spark, sf_dir)), ordered.rollup(rollups.USER_10M))
    late = ordered.late_counts(found).select(F.col("interval").alias("bucket_start"), F.lit(None).cast("string").alias("username"), "late_rows")
    return found.read(rollups.USER_10M.name).drop("dt").unionByName(late, allowMissingColumns=True)


def _late_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _in_order(fixtures.auth_log(fixtures.events(spark, sf_dir), 600), ordered.spans(), minutes=24)
    return found.read("spans").drop("dt")


def _ingested(spark: SparkSession, sf_dir: str) -> TableSet:
    frames = _frames(spark, sf_dir)
    # In the last five minutes of a slice every seventh packet comes with the next one, which is in time.
    return _in_order(frames, stream_ingest.packets(), "pkt_time", key="seq", minutes=360,
                     delayed="{key} % 7 = 0 AND {us} % 21600000000 >= 21300000000")


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of every table that the packet stream has filled: one row per detail row or group."""
    found = _ingested(spark, sf_dir)
    text_of = lambda *cs: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cs])

    def part(relation: str, rows: DataFrame, keys: list[str], *numbers: str) -> DataFrame:
        counted = [F.coalesce(F.col(n).cast("bigint"), F.lit(0)) if n else F.lit(0).cast("bigint") for n in (*numbers, "", "", "")[:3]]
        return rows.select(F.lit(relation).alias("relation"), text_of(*keys).alias("key"), *[c.alias(f"n{i}") for i, c in enumerate(counted)])

    hourly = found.read("aaa_events").groupBy("event_type", F.col("username")).agg(
        F.count("*").alias("n"), F.sum("input_delta").alias("traffic"), F.sum("result_code").alias("codes"))
    counts = ("request_count", "accept_count", "reject_count")
    parts = [
        part("auth_log", found.read("auth_log"), ["id", "username", "reason_zh"], "result", "latency_ms"),
        part("acct_log", found.read("acct_log"), ["id", "username", "acct_session_id"], "acct_status_type", "input_octets"),
        part("aaa_events", hourly, ["event_type", "username"], "n", "traffic", "codes"),
    ]
    for spec, keys in (
        (rollups.STAT_10M, []), (rollups.NAS_10M, ["nas_ip"]), (rollups.USER_10M, ["username", "main_reason"]),
        (rollups.USER_MAC_10M, ["username", "mac_addr", "nas_port_id"]),
        (rollups.WIDE_10M, ["username", "src_ip", "mac_addr", "nas_port_id", "result", "framed_ip"]),
    ):
        parts.append(part(spec.name, stream_ingest.rollup(found, spec), ["bucket_start", *keys], *counts))
    parts.append(part(rollups.REASON_10M.name, stream_ingest.rollup(found, rollups.REASON_10M), ["bucket_start", "result", "reason_zh"], "request_count"))
    parts.append(part(rollups.AUTH_STATES_10M.name, stream_ingest.rollup(found, rollups.AUTH_STATES_10M),
                      ["bucket", "username", "mac_addr", "nas_ip", "reason_zh"], "requests", "accepts", "challenges"))
    parts.append(part(rollups.ACCT_1H.name, stream_ingest.sessions(found), ["bucket", "username", "mac_addr", "nas_ip"], "input_bytes", "starts", "sessions"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _sketch_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored by two batches and merged on read: the exact number of sessions, and whether the estimate is within
    5 % and one of it."""
    rows, found = _deltas(spark, sf_dir), TableSet(spark, staging.scratch(spark))
    for batch in range(2):
        for spec in stream_ingest.ACCT_ROLLUPS:
            found.stage(spec.partial(rows.filter(F.col("id") % 2 == batch)), spec.name, day=next(iter(spec.keys)))
        found.commit(batch)
    both = stream_ingest.sessions(found)
    near = F.abs(F.col("sessions_estimate") - F.col("sessions")) <= F.greatest(F.lit(1), F.col("sessions") * 0.05)
    return both.select("bucket", "username", "mac_addr", "nas_ip", "sessions", near.alias("is_near"))


ORDERED: dict[str, Query] = {
    "late_deltas": _late_deltas,
    "late_sample": _late_sample,
    "late_pair": _late_pair,
    "late_rollup": _late_rollup,
    "late_spans": _late_spans,
    "stream_ingest": _stream_ingest,
    "acct_rollup_1h_stored": _sketch_bound,
}


# --- Tables kept by commits ----------------------------------------------------------------------


def _compacted_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup over a month from three batches: read, with its first half compacted and a batch delivered again, and
    read once more; both readings side by side."""
    auth = fixtures.auth_log(fixtures.events(spark, sf_dir), factor=1)
    found, spec = TableSet(spark, staging.scratch(spark)), rollups.USER_10M

    def deliver(batch: int) -> None:
        if not found.has(batch):
            found.stage(spec.partial(auth.filter(F.col("id") % 3 == batch)), spec.name, day="bucket_start")
            found.commit(batch)

    for batch in (0, 1):
        deliver(batch)
    first = staging.staged(stream_ingest.rollup(found, spec))
    stream_ingest.compact(found, spec, date(2024, 1, 15))
    for batch in (1, 2):
        deliver(batch)
    stream_ingest.compact(found, spec, date(2024, 1, 20))
    found.vacuum(spec.name)
    keys = list(spec.keys)
    before = first.select(*keys, F.col("request_count").alias("before_count"))
    after = stream_ingest.rollup(found.refresh(), spec).drop("dt")
    return after.join(before, keys, "left")


def _metric_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a month in two versions: the first of two thirds of the records, then all of the days up to the 20th
    again; the second is delivered twice and the first half of the month compacted. The newest versions, from noon of the
    3rd on."""
    auth = fixtures.auth_log(fixtures.events(spark, sf_dir), factor=1)

    def counters(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.window("ts", "10 minutes").getField("start").alias("metric_time")).agg(
            F.count("*").alias("auth_records"), F.count_if(F.col("result") == 11).alias("challenge_records"))

    found = TableSet(spark, staging.scratch(spark))
    metrics.record(found, counters(auth.filter("id % 3 > 0")), "first", datetime(2024, 2, 1))
    metrics.compact(found, date(2024, 1, 10))
    for _ in range(2):
        metrics.record(found, counters(auth.filter(F.col("ts") < times.ntz(datetime(2024, 1, 21)))), "second", datetime(2024, 2, 2))
    metrics.compact(found, date(2024, 1, 16))
    return metrics.current(found.refresh(), datetime(2024, 1, 3, 12))


#: Days that each table is kept, in the named query.
RETAIN = {"auth_log": 10, "acct_log": 20}


def _retention_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of a month with cut-offs in the middle of a day; cutting twice is harmless."""
    ev, found = fixtures.events(spark, sf_dir), TableSet(spark, staging.scratch(spark))
    found.stage(fixtures.auth_log(ev, factor=1), "auth_log", day="ts")
    found.stage(fixtures.acct_log(ev, factor=1), "acct_log", day="ts")
    found.commit("month")
    for _ in range(2):
        retention.retain_tables(found, RETAIN, datetime(2024, 1, 25, 12))
    kept = [found.read(t).select(F.lit(t).alias("relation"), "id", "ts") for t in RETAIN]
    return kept[0].unionByName(kept[1])


def _record_search_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging.scratch(spark)
    sinks.append(fixtures.auth_log(fixtures.events(spark, sf_dir)), path)
    return reports.record_search(tables.auth_log(spark, path), NOW, mac="0200.0000.0001", result=3)


def _nas_stats_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, auth = staging.scratch(spark), fixtures.auth_log(fixtures.events(spark, sf_dir))
    sinks.write_ndjson(auth, path)
    return rollups.nas_stats(spark.read.schema(auth.schema).json(path))


def _top_reject_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From two stored batches of partials, one of which is delivered again."""
    path, auth = staging.scratch(spark), fixtures.auth_log(fixtures.events(spark, sf_dir))
    for batch in (0, 1, 0):
        half = auth.filter(F.col("id") % 2 == batch)
        sinks.store_partial(rollups.USER_10M.partial(half), path, batch)
    return reports.top_reject(sinks.load_rollup(spark, path, rollups.USER_10M), NOW)


def _retention_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of days, of which those before the tenth are dropped; dropping twice is harmless."""
    path = staging.scratch(spark)
    sinks.append(fixtures.auth_log(fixtures.events(spark, sf_dir), factor=1), path)
    for _ in range(2):
        retention.drop_days(spark, path, 10, NOW.replace(day=20))
    return tables.auth_log(spark, path).select("id", "ts")


def _range_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day of a range that leaves out days at both ends; its bounds reach the directories."""
    path = staging.scratch(spark)
    sinks.append(fixtures.auth_log(fixtures.events(spark, sf_dir), factor=1), path)
    stored = tables.between(tables.auth_log(spark, path), NOW.replace(day=5), NOW.replace(day=25))
    return stored.groupBy("dt").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def _stored_month(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A month of stored days: authentication, accounting, and the totals rollup."""
    base, ev = staging.scratch(spark), fixtures.events(spark, sf_dir)
    auth = fixtures.auth_log(ev, factor=1)
    sinks.append(auth, f"{base}/auth")
    sinks.append(fixtures.acct_log(ev, factor=1), f"{base}/acct")
    sinks.store_partial(rollups.STAT_10M.partial(auth), f"{base}/stat", 0)
    return tables.auth_log(spark, f"{base}/auth"), tables.acct_log(spark, f"{base}/acct"), sinks.load_rollup(spark, f"{base}/stat", rollups.STAT_10M)


def _export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest records, written as CSV with a header and read back as text."""
    path, auth = staging.scratch(spark), fixtures.auth_log(fixtures.events(spark, sf_dir))
    sinks.export_csv(auth, path, 500)
    names = ("ts first_seen last_seen request_count username raw_username result reason_zh mac_addr nas_ip nas_identifier "
             "nas_port_id nas_port_type nas_port latency_ms reply_msg").split()
    rows = spark.read.schema(", ".join(f"{n} string" for n in names)).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(*[F.coalesce(n, F.lit("")).alias(n) for n in names])


def _top_reject_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates, given in the wrong order, over a stored month: days outside aren't read."""
    path, auth = staging.scratch(spark), fixtures.auth_log(fixtures.events(spark, sf_dir), factor=1)
    sinks.store_partial(rollups.USER_10M.partial(auth), path, 0)
    users = sinks.load_rollup(spark, path, rollups.USER_10M)
    return reports.top_reject(users, NOW, start=date(2024, 1, 9), end=date(2024, 1, 5), limit=None)


def _identifiable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records name somebody: accounts, device reports and control records with names left out by turns."""
    acct = fixtures.acct_log(fixtures.events(spark, sf_dir)).withColumns({
        "username": F.expr("CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN '(未匹配)' WHEN 2 THEN NULL ELSE username END"),
        "nas_ip": F.expr("CASE WHEN id % 3 = 0 THEN nas_ip WHEN id % 3 = 1 THEN ' ' END"),
        "src_ip": F.expr("CASE WHEN id % 4 = 0 THEN src_ip END"), "mac_addr": F.expr("CASE WHEN id % 7 = 0 THEN mac_addr END"),
        "acct_session_id": F.expr("CASE WHEN id % 6 = 0 THEN acct_session_id END"),
        "acct_status_type": F.expr("CASE WHEN id % 4 < 2 THEN 7 + 8 * (id % 2) ELSE acct_status_type END"),
    })
    kinds = {"auth": accounting.identifiable_auth, "accounting": accounting.identifiable_accounting, "control": accounting.identifiable_control}
    found = [keep(acct).select("id", F.lit(kind).alias("kind")) for kind, keep in kinds.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _multi_mac_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested list as text, in its order."""
    macs = rollups.rollup_user_mac_10m(fixtures.auth_log(fixtures.events(spark, sf_dir)))
    entry = lambda d: F.concat_ws("|", d["mac_addr"], d["total_cnt"].cast("string"), d["reject_cnt"].cast("string"), d["nas_port_id"])
    return reports.multi_mac(macs, NOW, min_mac=3).select(
        "username", "mac_count", "total_cnt", F.array_join(F.transform("mac_details", entry), ";").alias("details"))


def _stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that the watermark has passed when the input is through."""
    auth = fixtures.auth_log(_stream_events(spark, sf_dir))
    found = _drain(windows.stream_rollup(auth, rollups.USER_10M))
    return rollups.final(rollups.USER_10M, found)


def _stream_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    auth = fixtures.auth_log(_stream_events(spark, sf_dir), 600)
    return _drain(windows.stream_spans(auth))


def _recent_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent(_stored_month(spark, sf_dir)[0], 700)


def _ingest_status_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, acct, stat = _stored_month(spark, sf_dir)
    return reports.ingest_status(stat, acct, NOW)


def _risk_accounts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three pages by cursor and one behind the end."""
    users = rollups.rollup_user_10m(fixtures.auth_log(fixtures.events(spark, sf_dir)))
    pages, cursor = [], None
    for number in range(1, 4):
        page = reports.risk_accounts_after(users, NOW, cursor, page_size=30, min_count=30)
        pages.append(page.withColumn("page", F.lit(number)))
        cursor = reports.cursor_of(page) or cursor
    behind = reports.risk_accounts_after(users, NOW, (-1, -1, NOW, ""), page_size=30, min_count=30)
    out = behind.withColumn("page", F.lit(99))
    for page in pages:
        out = out.unionByName(page)
    return out


STORED: dict[str, Query] = {
    "recent_stored": _recent_stored,
    "export_csv": _export_csv,
    "top_reject_range": _top_reject_range,
    "identifiable": _identifiable,
    "multi_mac_nested": _multi_mac_nested,
    "stream_rollup": _stream_rollup,
    "stream_spans": _stream_spans,
    "port_filter": lambda spark, sf_dir: decode.filter_ports(decode.extract_udp(_frames(spark, sf_dir)), [1812, 51000]).select(
        "seq", "src_port", "dst_port"),
    "ingest_status_stored": _ingest_status_stored,
    "risk_accounts_pages": _risk_accounts_pages,
    "compacted_store": _compacted_store,
    "metric_versions": _metric_versions,
    "retention_border": _retention_border,
    "retention_stored": _retention_stored,
    "range_stored": _range_stored,
    "record_search_stored": _record_search_stored,
    "nas_stats_ndjson": _nas_stats_ndjson,
    "top_reject_stored": _top_reject_stored,
}


def queries() -> dict[str, Query]:
    return {**ROLLUPS, **REPORTS, **STATEFUL, **DECODING, **STREAMING, **ORDERED, **STORED}
