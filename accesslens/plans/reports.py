"""Report queries over rollups and detail tables.

Every function takes ``now`` (never the wall clock) and returns one lazy DataFrame. Time filters are
literals, so they prune partitions and reach the Parquet scan. Sort orders end in a unique key.
"""

from datetime import date, datetime

from pyspark.sql import DataFrame, Window, functions as F

from accesslens.functions import times
from accesslens.functions.counters import octet_total
from accesslens.functions.text import normalize_mac, strip
from accesslens.operators.latest import latest_per_session, newest, newest_value

_RECENT = [
    "username", "raw_username", "result", "reason_zh", "mac_addr", "nas_ip", "nas_identifier",
    "nas_port_id", "nas_port_type", "nas_port",
]


def _record_columns(*rest: str) -> list:
    return [
        F.col("ts"), F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"),
        F.lit(1).alias("request_count"), *[F.col(c) for c in rest],
    ]


def stats(stat10m: DataFrame, now: datetime, hours: int = 24, valid_from=None) -> DataFrame:
    """Totals, accept and reject percentages and mean latency; one row."""
    hours = times.at_least(hours, 1, "hours")
    total, accepts, rejects = F.col("total"), F.col("accepts"), F.col("rejects")
    zero = F.lit(0)

    def percent(part):
        return F.coalesce(F.round(part * 100.0 / F.nullif(total, zero), 1), F.lit(0.0))

    sums = stat10m.filter(times.in_report_window(F.col("bucket_start"), now, hours, valid_from=valid_from, day=times.stored_day(stat10m))).agg(
        F.coalesce(F.sum("request_count"), zero).alias("total"),
        F.coalesce(F.sum("accept_count"), zero).alias("accepts"),
        F.coalesce(F.sum("reject_count"), zero).alias("rejects"),
        F.sum("latency_sum_ms").alias("latency_sum"), F.sum("latency_count").alias("latency_n"),
    )
    mean = F.round(F.col("latency_sum") * 1.0 / F.nullif(F.col("latency_n"), zero), 1)
    return sums.select(
        "total", "accepts", "rejects", percent(accepts).alias("accept_rate"),
        percent(rejects).alias("reject_rate"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_latency_ms"), F.lit(hours).alias("hours"),
    )


def recent(auth: DataFrame, limit: int | None = 100) -> DataFrame:
    """Newest authentication records."""
    top = newest(auth, limit)
    return top.select(*_record_columns(*_RECENT, "latency_ms", "reply_msg"))


def record_search(
    auth: DataFrame, now: datetime, hours: int = 3, username: str | None = None,
    mac: str | None = None, result: int | None = None, limit: int | None = 300,
) -> DataFrame:
    """Authentication records by window, account, terminal address and result; newest first."""
    found = auth.filter(times.in_report_window(F.col("ts"), now, times.at_least(hours, 1, "hours"), day=times.stored_day(auth)))
    if (username or "").strip():
        found = found.filter(F.col("username") == username.strip().upper())
    if (mac or "").strip():
        found = found.filter(F.col("mac_addr") == normalize_mac(F.lit(mac)))
    if result in (2, 3):
        found = found.filter(F.col("result") == result)
    top = newest(found, limit)
    return top.select(
        *_record_columns(*_RECENT, "framed_ip", "src_ip", "latency_ms", "reply_msg")
    )


def user_detail(auth: DataFrame, username: str, limit: int | None = 50) -> DataFrame:
    """One account's newest authentication records."""
    top = newest(auth.filter(F.col("username") == username), limit)
    return top.select(*_record_columns(
        "raw_username", "result", "reason_zh", "mac_addr", "nas_ip", "nas_identifier",
        "nas_port_id", "nas_port_type", "nas_port", "reply_msg", "latency_ms", "framed_ip",
    ))


def _top(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    """The first rows in this order; all of them without a limit."""
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(times.at_least(limit, 0, "limit"))


def _with_bytes(acct: DataFrame) -> DataFrame:
    incoming = octet_total(F.col("input_octets"), F.col("input_gigawords"))
    outgoing = octet_total(F.col("output_octets"), F.col("output_gigawords"))
    return acct.withColumns({
        "input_bytes": incoming, "output_bytes": outgoing, "total_bytes": incoming + outgoing,
    })


_COUNTERS = [
    "ts", "username", "raw_username", "acct_status_type", "acct_session_id", "input_octets",
    "input_gigawords", "output_octets", "output_gigawords", "input_bytes", "output_bytes",
    "total_bytes", "mac_addr",
]


def _dashboard_rows(acct: DataFrame, newest_rows: int | None) -> DataFrame:
    return acct if newest_rows is None else newest(acct, newest_rows)


def acct_dashboard_stats(acct: DataFrame, newest_rows: int | None = None) -> DataFrame:
    """Counts over all rows, and traffic over the latest row of each session; over the newest rows if asked."""
    sample = _dashboard_rows(acct, newest_rows)
    status, zero = F.col("acct_status_type"), F.lit(0)
    reports = sample.agg(
        F.count("*").alias("report_count"),
        F.count_if(status == 1).alias("start_count"), F.count_if(status == 2).alias("stop_count"),
    )
    sums = {
        c: F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), zero.cast("decimal(38,0)")).alias(c)
        for c in ("input_bytes", "output_bytes", "total_bytes")
    }
    # A single row, taken along as a scalar.
    counts = reports.select(F.struct("*")).scalar()
    sessions = _with_bytes(latest_per_session(sample)).agg(
        F.count("*").alias("session_count"),
        F.count_if(status.isin(1, 3)).alias("active_sessions"),
        *sums.values(), F.max("ts").alias("last_seen"),
    )
    return sessions.withColumn("counts", counts).select("counts.*", *sessions.columns)


def acct_dashboard_sessions(
    acct: DataFrame, limit: int | None = 80, newest_rows: int | None = None
) -> DataFrame:
    """The latest row of each session, newest first; of those among the newest rows if asked."""
    latest = latest_per_session(_dashboard_rows(acct, newest_rows))
    top = _top(_with_bytes(latest), limit, F.desc("ts"), F.desc("id"))
    return top.select(*_COUNTERS, "framed_ip", "nas_ip", "nas_identifier", "nas_port_id", "nas_port")


def acct_history(
    acct: DataFrame, username: str | None, now: datetime, hours: int = 48, limit: int | None = 300
) -> DataFrame:
    """One account's newest accounting records; no account, no rows."""
    name = (username or "").strip().upper()
    hours = times.at_least(hours, 1, "hours")
    found = acct.filter(
        (F.col("username") == name) & (F.lit(name) != "")
        & times.in_report_window(F.col("ts"), now, hours, day=times.stored_day(acct))
    )
    top = newest(_with_bytes(found), limit)
    return top.select(
        *_COUNTERS, "calling_sta", "framed_ip", "nas_ip", "nas_identifier", "nas_port_id",
        "nas_port", "src_ip", "dst_ip",
    )


def top_reject(
    user10m: DataFrame, now: datetime, hours: int = 24, start: date | None = None,
    end: date | None = None, limit: int | None = 20, valid_from=None,
) -> DataFrame:
    """Accounts with the most rejects."""
    window = times.in_report_window(F.col("bucket_start"), now, hours, start, end, valid_from, day=times.stored_day(user10m))
    totals = user10m.filter(window).groupBy("username").agg(
        F.sum("reject_count").alias("reject_cnt"), F.sum("accept_count").alias("accept_cnt"),
        F.sum("request_count").alias("total_cnt"), F.max("main_reason").alias("last_reason"),
        F.max("last_seen").alias("last_seen"),
    )
    top = _top(totals.filter("reject_cnt > 0"), limit, F.desc("reject_cnt"), F.desc("last_seen"), F.asc("username"))
    return top.select(
        "username", "reject_cnt", "accept_cnt", "total_cnt", F.lit(0).alias("mac_count"),
        F.lit(0).alias("nas_count"), "last_reason", "last_seen", F.lit("").alias("mac_list"),
        F.lit("").alias("nas_list"),
    )


def risk_accounts(
    user10m: DataFrame, now: datetime, hours: int = 24, start: date | None = None,
    end: date | None = None, page: int = 1, page_size: int = 100, min_count: int = 100,
    valid_from=None,
) -> DataFrame:
    """One page of accounts with more than ``min_count`` requests, worst first.

    Up to ``page_size`` rows. Each row carries ``has_next`` and the reported ``total``, which counts
    rows up to this page plus one when there is more: one row past the page is read, nothing is
    counted.
    """
    page, size = times.at_least(page, 1, "page"), times.at_least(page_size, 1, "page_size")
    offset = (page - 1) * size
    window = times.in_report_window(F.col("bucket_start"), now, hours, start, end, valid_from, day=times.stored_day(user10m))
    totals = user10m.filter(window).groupBy("username").agg(
        F.sum("request_count").alias("total_cnt"), F.sum("reject_count").alias("reject_cnt"),
        F.sum("accept_count").alias("accept_cnt"), F.max("last_seen").alias("last_seen"),
    )
    order = [F.desc("reject_cnt"), F.desc("total_cnt"), F.desc("last_seen"), F.asc("username")]
    rows = (
        totals.filter(F.col("total_cnt") > times.at_least(min_count, 0, "min_count"))
        .orderBy(*order).offset(offset).limit(size + 1)
    )
    # At most size + 1 rows are left here.
    blank = F.lit("")
    shown = F.least(F.col("rows_read"), F.lit(size))
    more = (F.col("rows_read") > size)
    ranked = rows.withColumn("page_rank", F.expr("row_number() over (order by reject_cnt desc, total_cnt desc, last_seen desc, username)"))
    counted = ranked.withColumn("rows_read", F.expr("count(*) over ()"))
    return counted.filter(F.col("page_rank") <= size).select(
        "username", "total_cnt", "reject_cnt", "accept_cnt", blank.alias("mac_list"),
        blank.alias("nas_list"), blank.alias("nas_ports"), blank.alias("nas_port_ids"), "last_seen",
        (F.lit(offset) + shown + more.cast("int")).cast("bigint").alias("total"),
        more.alias("has_next"), "page_rank",
    ).orderBy("page_rank")


Cursor = tuple[int, int, datetime, str]


def risk_accounts_after(
    user10m: DataFrame, now: datetime, after: Cursor | None = None, hours: int = 24, start: date | None = None,
    end: date | None = None, page_size: int = 100, min_count: int = 100, valid_from=None,
) -> DataFrame:
    """The page of accounts behind a cursor: the last row of the page before, as (reject_cnt, total_cnt, last_seen,
    username); the first page without one.

    Any page costs the same: the cursor is a predicate, and each task keeps one page at most. Row 0 of a page is a
    summary that exists for empty pages, too: ``total``, the number of all such accounts, and ``has_next``.
    """
    size = times.at_least(page_size, 1, "page_size")
    window = times.in_report_window(F.col("bucket_start"), now, hours, start, end, valid_from, day=times.stored_day(user10m))
    totals = user10m.filter(window).groupBy("username").agg(
        F.sum("request_count").alias("total_cnt"), F.sum("reject_count").alias("reject_cnt"),
        F.sum("accept_count").alias("accept_cnt"), F.max("last_seen").alias("last_seen"),
    ).filter(F.col("total_cnt") > times.at_least(min_count, 0, "min_count"))
    behind = F.lit(True)
    if after is not None:
        rejects, requests, seen, name = after
        place = F.struct(-F.col("reject_cnt"), -F.col("total_cnt"), -times.epoch_ms(F.col("last_seen")), F.col("username"))
        cursor = F.struct(F.lit(-rejects).cast("bigint"), F.lit(-requests).cast("bigint"), -times.epoch_ms(times.ntz(seen)), F.lit(name))
        behind = place > cursor
    order = [F.desc("reject_cnt"), F.desc("total_cnt"), F.desc("last_seen"), F.asc("username")]
    rows = totals.filter(behind).orderBy(*order).limit(size)  # a page of rows from here on
    ranked = rows.withColumn("page_rank", F.row_number().over(Window.orderBy(*order)).cast("int"))
    summary = totals.agg(F.count("*").alias("total"), (F.count_if(behind) > size).alias("has_next"))
    return ranked.unionByName(summary.withColumn("page_rank", F.lit(0)), allowMissingColumns=True).select(
        "page_rank", "username", "total_cnt", "reject_cnt", "accept_cnt", "last_seen", "total", "has_next")


def cursor_of(page: DataFrame) -> Cursor | None:
    """The cursor for the page behind this one; None if this one is empty."""
    last = page.filter("page_rank > 0").orderBy(F.desc("page_rank")).limit(1).collect()
    return (last[0].reject_cnt, last[0].total_cnt, last[0].last_seen, last[0].username) if last else None


def _terminals(user_mac10m: DataFrame, window) -> DataFrame:
    return user_mac10m.filter(window & (F.col("mac_addr") != ""))


def multi_mac_summary(
    user_mac10m: DataFrame, now: datetime, hours: int = 24, start: date | None = None,
    end: date | None = None, min_mac: int = 2, limit: int | None = 100, valid_from=None,
) -> DataFrame:
    """Accounts seen on at least ``min_mac`` terminals."""
    window = times.in_report_window(F.col("bucket_start"), now, hours, start, end, valid_from, day=times.stored_day(user_mac10m))
    per_mac = _terminals(user_mac10m, window).groupBy("username", "mac_addr").agg(
        F.sum("request_count").alias("total_cnt"), F.sum("accept_count").alias("accept_cnt"),
        F.sum("reject_count").alias("reject_cnt"), F.max("nas_ip").alias("nas_ip"),
        F.max("last_seen").alias("last_seen"),
    )
    # Per (account, server) first, so that an account with very many terminals is pre-reduced.
    per_nas = per_mac.groupBy("username", "nas_ip").agg(
        F.sum("total_cnt").alias("total_cnt"), F.sum("accept_cnt").alias("accept_cnt"),
        F.sum("reject_cnt").alias("reject_cnt"), F.count("*").alias("mac_count"),
        F.max("last_seen").alias("last_seen"),
    )
    per_user = per_nas.groupBy("username").agg(
        F.sum("total_cnt").alias("total_cnt"), F.sum("accept_cnt").alias("accept_cnt"),
        F.sum("reject_cnt").alias("reject_cnt"), F.sum("mac_count").alias("mac_count"),
        F.count("nas_ip").alias("nas_count"), F.max("last_seen").alias("last_seen"),
    )
    return _top(
        per_user.filter(F.col("mac_count") >= times.at_least(min_mac, 1, "min_mac")), limit,
        F.desc("mac_count"), F.desc("total_cnt"), F.desc("reject_cnt"), F.asc("username"),
    )


def multi_mac_detail(
    user_mac10m: DataFrame, now: datetime, hours: int = 24, start: date | None = None,
    end: date | None = None, min_mac: int = 2, limit: int | None = 100, valid_from=None,
) -> DataFrame:
    """The terminals of the accounts in :func:`multi_mac_summary`, one row each."""
    window = times.in_report_window(F.col("bucket_start"), now, hours, start, end, valid_from, day=times.stored_day(user_mac10m))
    top = multi_mac_summary(user_mac10m, now, hours, start, end, min_mac, limit, valid_from)
    return _terminals(user_mac10m, window).join(top.select("username"), "username", "left_semi").groupBy(
        "username", "mac_addr"
    ).agg(
        F.sum("request_count").alias("total_cnt"), F.sum("accept_count").alias("accept_cnt"),
        F.sum("reject_count").alias("reject_cnt"), F.max("nas_ip").alias("nas_ip"),
        F.max("nas_identifier").alias("nas_identifier"), F.max("nas_port_id").alias("nas_port_id"),
        F.max("nas_port").alias("nas_port"), F.max("last_seen").alias("last_seen"),
    )


def multi_mac(
    user_mac10m: DataFrame, now: datetime, hours: int = 24, start: date | None = None,
    end: date | None = None, min_mac: int = 2, limit: int | None = 100, valid_from=None,
) -> DataFrame:
    """Summary rows with their terminals nested in ``mac_details``, newest terminal first.

    The nested list holds one entry per distinct terminal of the account; callers that expect very
    long lists use :func:`multi_mac_detail`.
    """
    args = (now, hours, start, end, min_mac, limit, valid_from)
    top = multi_mac_summary(user_mac10m, *args)
    fields = [
        "last_seen", "mac_addr", "total_cnt", "accept_cnt", "reject_cnt", "nas_ip",
        "nas_identifier", "nas_port_id", "nas_port",
    ]
    nested = multi_mac_detail(user_mac10m, *args).groupBy("username").agg(
        F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("mac_details")
    )
    return top.join(nested, "username").orderBy(
        F.desc("mac_count"), F.desc("total_cnt"), F.desc("reject_cnt"), "username"
    )


def reason_distribution(reason10m: DataFrame, now: datetime, hours: int = 24, valid_from=None) -> DataFrame:
    """Rejects per reason, most frequent first."""
    window = times.in_report_window(F.col("bucket_start"), now, times.at_least(hours, 1, "hours"), valid_from=valid_from, day=times.stored_day(reason10m))
    return reason10m.filter(window & (F.col("result") == 3)).groupBy("reason_zh").agg(
        F.sum("request_count").alias("cnt")
    ).orderBy(F.desc("cnt"), "reason_zh")


def nas_distribution(nas10m: DataFrame, now: datetime, hours: int = 24, valid_from=None) -> DataFrame:
    """Requests per access server, busiest first."""
    window = times.in_report_window(F.col("bucket_start"), now, times.at_least(hours, 1, "hours"), valid_from=valid_from, day=times.stored_day(nas10m))
    return nas10m.filter(window & (F.col("nas_ip") != "")).groupBy("nas_ip").agg(
        F.sum("request_count").alias("total"), F.sum("accept_count").alias("accepts"),
        F.sum("reject_count").alias("rejects"), F.max("last_seen").alias("last_seen"),
    ).orderBy(F.desc("total"), "nas_ip")


def timeline(
    stat10m: DataFrame, now: datetime, hours: int = 6, interval_min: int = 5, valid_from=None
) -> DataFrame:
    """Accepts and rejects per time slot, oldest first; empty slots are not filled in."""
    seconds = 60 * times.at_least(interval_min, 1, "interval_min")
    window = times.in_report_window(F.col("bucket_start"), now, times.at_least(hours, 1, "hours"), valid_from=valid_from, day=times.stored_day(stat10m))
    slot = times.slot_label(F.col("bucket_start"), seconds).alias("bucket")
    return stat10m.filter(window).groupBy(slot).agg(
        F.sum("accept_count").alias("accepts"), F.sum("reject_count").alias("rejects")
    ).orderBy("bucket")


def ingest_status(stat10m: DataFrame, acct: DataFrame, now: datetime) -> DataFrame:
    """Newest response and accounting times and their lag behind ``now`` in seconds."""
    def lag(c: str):
        return (times.ntz(now) - F.col(c)).cast("interval second").cast("bigint")

    # Times of a row lie within the bucket, or on the day, that the table is stored by.
    both = newest_value(stat10m, "last_seen").withColumnRenamed("last_seen", "last_response_ts").withColumn(
        "last_accounting_ts", newest_value(acct, "ts").scalar()
    )
    return both.select(
        times.ntz(now).alias("db_now"), "last_response_ts",
        F.lit(None).cast("timestamp_ntz").alias("last_request_ts"),
        lag("last_response_ts").alias("auth_response_lag_seconds"),
        F.lit(None).cast("bigint").alias("auth_request_lag_seconds"), "last_accounting_ts",
        lag("last_accounting_ts").alias("accounting_lag_seconds"),
    )
