"""Keyed rollups as mergeable partial states.

A rollup is declared once as keys plus associative measures. ``partial`` aggregates detail rows,
``merge`` folds any number of partials together, ``final`` turns states into report columns.
"Latest value" attributes are kept as ``max(struct(ts, id, value))``: the maximum of a struct is
associative and does not depend on arrival order, so folding any split of the input gives the same
rows as one pass over the whole.

Hot keys need no salting: Spark aggregates on the map side first, so one task sends at most one row
per key whatever share of the rows that key holds.
"""

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.functions.keys import stable_key

_STATE = "state_"
_MAX = 2**63 - 1


def _added(name: str) -> Column:
    """Sum of partial sums; it stays at the largest BIGINT instead of overflowing."""
    return F.coalesce(F.try_sum(name), F.lit(_MAX)).alias(name)


@dataclass(frozen=True)
class Rollup:
    """Declaration of one rollup, as SQL expressions over the detail rows."""

    name: str
    keys: dict[str, str]
    # Aggregates that are added up, minimised or maximised when partials are folded.
    sums: dict[str, str]
    mins: dict[str, str] = field(default_factory=dict)
    maxs: dict[str, str] = field(default_factory=dict)
    # output column -> (row condition, attribute), taken from the latest row that matches
    latest: dict[str, tuple[str, str]] = field(default_factory=dict)
    # attributes taken together from the latest / the earliest row of the group
    last_row: tuple[str, ...] = ()
    first_row: tuple[str, ...] = ()
    sketches: dict[str, str] = field(default_factory=dict)
    where: str = "true"
    order: tuple[str, str] = ("ts", "id")

    def partial(self, detail: DataFrame) -> DataFrame:
        rows = detail.filter(self.where)
        keyed = rows.select("*", *[F.expr(c).alias(f"key_{n}") for n, c in self.keys.items()])
        out = keyed.groupBy(*[f"key_{n}" for n in self.keys]).agg(*self.aggregates())
        return out.withColumnsRenamed({f"key_{n}": n for n in self.keys})

    def aggregates(self) -> list[Column]:
        """The measures of a partial, over detail rows."""
        aggs = [F.expr(c).cast("bigint").alias(n) for n, c in self.sums.items()]
        aggs += [F.min(F.expr(c)).alias(n) for n, c in self.mins.items()]
        aggs += [F.max(F.expr(c)).alias(n) for n, c in self.maxs.items()]
        for name, (condition, attribute) in self.latest.items():
            row = F.struct(*self.order, F.col(attribute).alias("value"))
            aggs.append(F.max(F.when(F.expr(condition), row)).alias(_STATE + name))
        if self.last_row:
            aggs.append(F.max(F.struct(*self.order, *self.last_row)).alias(_STATE + "last"))
        if self.first_row:
            aggs.append(F.min(F.struct(*self.order, *self.first_row)).alias(_STATE + "first"))
        aggs += [F.hll_sketch_agg(F.expr(c)).alias(_STATE + n) for n, c in self.sketches.items()]
        return aggs

    def merge(self, *partials: DataFrame) -> DataFrame:
        rows = reduce(DataFrame.unionByName, partials)
        aggs = [_added(n) for n in self.sums]
        aggs += [F.min(n).alias(n) for n in self.mins]
        aggs += [F.max(n).alias(n) for n in self.maxs]
        aggs += [F.max(_STATE + n).alias(_STATE + n) for n in self.latest]
        if self.last_row:
            aggs.append(F.max(_STATE + "last").alias(_STATE + "last"))
        if self.first_row:
            aggs.append(F.min(_STATE + "first").alias(_STATE + "first"))
        aggs += [F.hll_union_agg(_STATE + n).alias(_STATE + n) for n in self.sketches]
        return rows.groupBy(*self.keys).agg(*aggs)

    def final(self, partial: DataFrame) -> DataFrame:
        columns = [F.col(n) for n in (*self.keys, *self.sums, *self.mins, *self.maxs)]
        columns += [F.col(_STATE + n)["value"].alias(n) for n in self.latest]
        columns += [F.col(_STATE + "last")[a].alias(a) for a in self.last_row]
        columns += [F.col(_STATE + "first")[a].alias(a) for a in self.first_row]
        columns += [F.hll_sketch_estimate(_STATE + n).alias(n) for n in self.sketches]
        return partial.select(*columns)

    def compute(self, detail: DataFrame) -> DataFrame:
        return final(self, self.partial(detail))

    def by_day(self) -> "Rollup":
        """The same rollup over stored partials, with the day of its buckets as a key: a day belongs to one bucket, so
        groups are the same, and a report's filter on the day reaches the directories."""
        return self if "dt" in self.keys else replace(self, keys={**self.keys, "dt": "dt"})


_BUCKET = "window(ts, '10 minutes').start"
# Challenges count as requests only.
_COUNTS = {
    "request_count": "count(*)",
    "accept_count": "count_if(result = 2)",
    "reject_count": "count_if(result = 3)",
}
_LATENCY = {"latency_count": "count(latency_ms)", "latency_sum_ms": "coalesce(sum(latency_ms), 0)"}
_SEEN = {"mins": {"first_seen": "ts"}, "maxs": {"last_seen": "ts"}}
_SEEN_AND_LATENCY = {
    "mins": {"latency_min_ms": "latency_ms", "first_seen": "ts"},
    "maxs": {"latency_max_ms": "latency_ms", "last_seen": "ts"},
}
_MAIN_REASON = {"main_reason": ("result = 3 AND reason_zh <> ''", "reason_zh")}
_PLACE = {
    c: (f"{c} IS NOT NULL", c) for c in ("nas_ip", "nas_port", "nas_identifier", "nas_port_id")
}
LATEST_ATTRIBUTES = (
    "raw_username", "reply_msg", "risk_level", "calling_sta", "called_sta", "nas_ip", "nas_port",
    "nas_identifier", "nas_port_type", "framed_ip",
)

STAT_10M = Rollup(
    "auth_stat_10m", {"bucket_start": _BUCKET}, {**_COUNTS, **_LATENCY}, **_SEEN_AND_LATENCY
)
REASON_10M = Rollup(
    "auth_reason_10m",
    {"bucket_start": _BUCKET, "result": "result", "reason_zh": "coalesce(reason_zh, '')"},
    {"request_count": "count(*)"}, **_SEEN,
)
NAS_10M = Rollup(
    "auth_nas_10m", {"bucket_start": _BUCKET, "nas_ip": "coalesce(nas_ip, '')"}, _COUNTS, **_SEEN
)
USER_10M = Rollup(
    "auth_user_10m", {"bucket_start": _BUCKET, "username": "username"}, _COUNTS, **_SEEN,
    latest=_MAIN_REASON,
)
USER_MAC_10M = Rollup(
    "auth_user_mac_10m",
    {"bucket_start": _BUCKET, "username": "username", "mac_addr": "coalesce(mac_addr, '')"},
    _COUNTS, **_SEEN, latest={**_PLACE, **_MAIN_REASON},
)
WIDE_10M = Rollup(
    "auth_rollup_10m",
    {
        "bucket_start": _BUCKET, "username": "username", "src_ip": "src_ip",
        "mac_addr": "mac_addr", "nas_port_id": "nas_port_id", "result": "result",
    },
    {**_COUNTS, **_LATENCY}, **_SEEN_AND_LATENCY,
    last_row=LATEST_ATTRIBUTES, first_row=("reason_zh",),
)
# Lifetime summaries count everything that is not an accept as a reject.
_LIFETIME = {"accept_cnt": "count_if(result = 2)", "reject_cnt": "count_if(result <> 2)"}
USER_SUMMARY = Rollup(
    "user_summary", {"username": "username", "mac_addr": "mac_addr", "nas_ip": "nas_ip"},
    _LIFETIME, **_SEEN, latest={"main_reason": ("result <> 2 AND reason_zh <> ''", "reason_zh")},
)
NAS_STATS = Rollup(
    "nas_stats", {"nas_ip": "coalesce(nas_ip, 'unknown')"},
    {"total_cnt": "count(*)", **_LIFETIME}, maxs={"last_seen": "ts"},
)
USER_MAC_SUMMARY = Rollup(
    "user_mac_summary", {"username": "upper(username)", "mac_addr": "mac_addr"},
    {
        "total_cnt": "count(*)", "accept_cnt": "count_if(result = 2)",
        "reject_cnt": "count_if(result = 3)",
    },
    **_SEEN, latest={**_PLACE, **_MAIN_REASON}, where="mac_addr IS NOT NULL",
)
AUTH_STATES_10M = Rollup(
    "auth_rollup_states",
    {
        "bucket": _BUCKET, "username": "coalesce(username, '')",
        "mac_addr": "coalesce(mac_addr, '')", "nas_ip": "coalesce(nas_ip, '')",
        "reason_zh": "coalesce(reason_zh, '')",
    },
    {
        "requests": "count(*)", "accepts": "count_if(result = 2)",
        "rejects": "count_if(result = 3)", "challenges": "count_if(result = 11)",
    },
    maxs={"last_seen": "ts"},
)
_ACCT_1H_KEYS = {
    "bucket": "window(event_time, '1 hour').start", "username": "coalesce(username, '')",
    "mac_addr": "coalesce(mac_addr, '')", "nas_ip": "coalesce(nas_ip, '')",
}
_ACCT_1H_SUMS = {
    # Saturating: corrupt counters must not fail the job.
    "input_bytes": f"coalesce(try_sum(input_delta), {_MAX})",
    "output_bytes": f"coalesce(try_sum(output_delta), {_MAX})",
    "starts": "count_if(acct_status_type = 1)", "stops": "count_if(acct_status_type = 2)",
    "interims": "count_if(acct_status_type = 3)",
    "nas_restarts": "count_if(acct_status_type IN (7, 8))",
}
ACCT_1H = Rollup(
    "acct_rollup_1h", _ACCT_1H_KEYS, _ACCT_1H_SUMS, maxs={"last_seen": "event_time"},
    sketches={"sessions": "nullif(acct_session_id, '')"}, order=("event_time", "event_id"),
)
# The same grain split by session: the exact distinct count is then a plain count.
ACCT_1H_BY_SESSION = Rollup(
    "acct_by_session_1h", {**_ACCT_1H_KEYS, "session": "nullif(acct_session_id, '')"},
    _ACCT_1H_SUMS, maxs={"last_seen": "event_time"}, order=("event_time", "event_id"),
)


def rollup_stat_10m(auth: DataFrame) -> DataFrame:
    return STAT_10M.compute(auth)


def rollup_reason_10m(auth: DataFrame) -> DataFrame:
    return REASON_10M.compute(auth)


def rollup_nas_10m(auth: DataFrame) -> DataFrame:
    return NAS_10M.compute(auth)


def rollup_user_10m(auth: DataFrame) -> DataFrame:
    return USER_10M.compute(auth)


def rollup_user_mac_10m(auth: DataFrame) -> DataFrame:
    return USER_MAC_10M.compute(auth)


def rollup_auth_wide_10m(auth: DataFrame) -> DataFrame:
    return WIDE_10M.compute(auth)


def user_summary(auth: DataFrame) -> DataFrame:
    return USER_SUMMARY.compute(auth)


def nas_stats(auth: DataFrame) -> DataFrame:
    return NAS_STATS.compute(auth)


def user_mac_summary(auth: DataFrame) -> DataFrame:
    return USER_MAC_SUMMARY.compute(auth)


def auth_rollup_10m_states(auth: DataFrame) -> DataFrame:
    return AUTH_STATES_10M.compute(auth)


def acct_rollup_1h(deltas: DataFrame) -> DataFrame:
    """Hourly traffic; ``sessions`` is the estimate of a mergeable distinct-count sketch."""
    return ACCT_1H.compute(deltas)


def acct_rollup_1h_exact(deltas: DataFrame) -> DataFrame:
    """Hourly traffic with the exact number of distinct sessions.

    Rows are first reduced to one per (group, session), so a hot group never gathers its sessions
    in one task.
    """
    return exact_sessions(ACCT_1H_BY_SESSION.partial(deltas))


def exact_sessions(by_session: DataFrame) -> DataFrame:
    """Hourly traffic from partials by session, or from their folded form."""
    return by_session.groupBy(*_ACCT_1H_KEYS).agg(
        *[_added(c) for c in _ACCT_1H_SUMS],
        F.count("session").alias("sessions"), F.max("last_seen").alias("last_seen"),
    )


def final(rollup: Rollup, partial: DataFrame) -> DataFrame:
    """Report form of a partial, including the columns that need more than unwrapping."""
    if rollup.name == USER_SUMMARY.name:
        return _final_user_summary(partial)
    out = rollup.final(partial)
    if rollup.name == WIDE_10M.name:
        bucket_text = F.concat(F.col("bucket_start").cast("string"), F.lit(".000"))
        rest = [F.col(c) for c in WIDE_10M.keys if c != "bucket_start"]
        out = out.withColumn("rollup_key", stable_key(bucket_text, *rest))
    return out


def _final_user_summary(partial: DataFrame) -> DataFrame:
    """One row per account. The partial grain is (account, address, server), so the lists hold
    each distinct value once and grow with the number of distinct values, not with rows."""
    return partial.groupBy("username").agg(
        F.sum("accept_cnt").alias("accept_cnt"), F.sum("reject_cnt").alias("reject_cnt"),
        F.array_sort(F.collect_set("mac_addr")).alias("mac_list"),
        F.array_sort(F.collect_set("nas_ip")).alias("nas_list"),
        F.max("state_main_reason")["value"].alias("main_reason"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
    )


def merge_rollup(rollup: Rollup, existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Upsert as re-aggregation: stored partials and new partials folded by key."""
    return rollup.merge(existing, delta)
