"""Counters that describe the quality of the packet stream, per interval."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from accesslens import constants as C
from accesslens.functions import times
from accesslens.operators import accounting, decode, pairing, staging

COUNTERS = [
    "captured_packets", "parsed_records", "auth_records", "accounting_records", "control_records",
    "challenge_records", "interim_sampled_out", "unmatched_auth_responses",
    "expired_auth_requests", "malformed_packets", "accounting_responses", "unknown_codes",
]


def _counts(rows: DataFrame, at: str, interval: str, **flags: str) -> DataFrame:
    return rows.groupBy(F.window(at, interval).getField("start").alias("metric_time")).agg(*[
        (F.count_if(F.expr(flags[c])) if c in flags else F.lit(0)).cast("bigint").alias(c)
        for c in COUNTERS
    ])


def packet_facts(datagrams: DataFrame) -> DataFrame:
    """What the counters have to know of each datagram, from one walk over its attributes: endpoints, code,
    account name, whether it is an accounting or a control record, and the session that sampling goes by."""
    rows = decode.with_identity(decode.decode_packets(datagrams), decode.access_server()).withColumns({
        "acct_status_type": decode.attr_uint(C.ATTR_ACCT_STATUS_TYPE),
        "acct_session_id": decode.attr_text(C.ATTR_ACCT_SESSION_ID),
        "framed_ip": decode.attr_ip(C.ATTR_FRAMED_IP),
    })
    whole = ~F.col("is_malformed")
    is_accounting = whole & (F.col("code") == C.ACCOUNTING_REQUEST) & accounting.known_accounting()
    is_control = whole & F.col("code").isin(C.CONTROL_CODES) & accounting.known_control()
    return rows.select(
        "seq", "pkt_time", "packet_identifier", "src_ip", "src_port", "dst_ip", "dst_port", "code", "is_malformed", "username",
        F.coalesce(is_accounting, F.lit(False)).alias("is_accounting"), F.coalesce(is_control, F.lit(False)).alias("is_control"),
        F.when(is_accounting & accounting.sampled(rows), accounting.interim_key()).alias("sampling_key"),
    )


def stream_quality(
    packets: DataFrame, interval: str = "10 minutes", ports: list[int] | None = None,
    sample_s: int = C.INTERIM_INTERVAL_SECONDS, keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per interval with capture, decode, pairing and sampling counters.

    Every datagram becomes one narrow row of facts; pairing and sampling work on these. ``keep`` may store
    them; without it their readers share a shuffle of them, and nothing runs here.
    Every reader's rows are reduced to one per interval before they are brought together.
    """
    facts = packet_facts(decode.filter_ports(decode.extract_udp(packets), ports))
    facts = keep(facts) if keep else staging.shared(facts, "seq")
    exchanges = pairing.auth_exchanges(pairing.auth_packets(
        facts, [F.col("username")], [F.col("code").alias("result_code")]
    ))
    named = f"coalesce(matched.username, '') NOT IN ('', '{C.UNMATCHED_USER}')"
    updates = facts.filter("sampling_key IS NOT NULL").select(
        F.col("sampling_key").alias("key"), times.epoch_ms(F.col("pkt_time")).alias("ms"), F.col("seq").alias("tie")
    )
    known = ", ".join(str(c) for c in C.CODE_NAMES)
    parts = [
        _counts(packets, "pkt_time", interval, captured_packets="true"),
        _counts(
            facts, "pkt_time", interval, malformed_packets="is_malformed",
            accounting_responses=f"NOT is_malformed AND code = {C.ACCOUNTING_RESPONSE}",
            unknown_codes=f"NOT is_malformed AND code NOT IN ({known})",
            parsed_records="is_accounting OR is_control", control_records="is_control",
            accounting_records="is_accounting AND sampling_key IS NULL", interim_sampled_out="sampling_key IS NOT NULL",
        ),
        _counts(
            exchanges, "at", interval, parsed_records=named, auth_records=named,
            challenge_records=f"{named} AND response.result_code = {C.ACCESS_CHALLENGE}",
            unmatched_auth_responses="response IS NOT NULL AND matched IS NULL",
            expired_auth_requests="is_expired",
        ),
    ]
    if sample_s > 0:
        kept = accounting.greedily_kept(updates, sample_s).select(times.from_epoch_ms(F.col("ms")).alias("ts"))
    else:
        kept = updates.select(times.from_epoch_ms(F.col("ms")).alias("ts"))
    # A kept update moves from the sampled-out count to the records.
    parts.append(_counts(kept, "ts", interval, accounting_records="true").withColumn(
        "interim_sampled_out", -F.col("accounting_records")
    ))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("metric_time").agg(*[F.sum(c).alias(c) for c in COUNTERS])
