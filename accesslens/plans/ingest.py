"""From captured packets to records, detail tables and unified events."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from accesslens import constants as C
from accesslens.operators import accounting, decode, events, pairing, staging

Keep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Records:
    auth: DataFrame
    accounting: DataFrame
    control: DataFrame


def decode_stage(packets: DataFrame, ports: list[int] | None = None, keep: Keep | None = None) -> DataFrame:
    """Frames to packets with their header; a narrow projection, no shuffle unless ``keep`` makes one: it gets the
    datagrams. Each kind of record walks the attributes of its own packets only."""
    datagrams = decode.filter_ports(decode.extract_udp(packets), ports)
    return decode.decode_header(keep(datagrams) if keep else datagrams)


def records(
    decoded: DataFrame, sample_s: int = C.INTERIM_INTERVAL_SECONDS, keep: Keep | None = None,
) -> Records:
    """Identifiable records; interim updates are thinned out here, before any delta is taken.

    The sampler reads accounting records several times. ``keep`` may store them (such as
    ``staging.staged``, or a function that writes and rereads a table). Without it nothing runs
    here, and readers share shuffles of the records where Spark finds them equal (:func:`staging.shared`).
    """
    acct = accounting.identifiable_accounting(decode.project_accounting(decoded))
    kept = keep(acct) if keep else staging.shared(acct, "seq")
    return Records(
        accounting.identifiable_auth(pairing.pair_auth(decoded)),
        accounting.sample_interim(kept, sample_s, tie="seq"),
        accounting.identifiable_control(decode.project_control(decoded)),
    )


def unified(rec: Records, scale: int = C.COUNTER_SCALE, keep: Keep | None = None) -> DataFrame:
    """De-duplicated events with counter deltas. ``keep`` as in ``records``: deltas read twice."""
    def once(df: DataFrame) -> DataFrame:
        return accounting.dedup_events(events.identify(df))

    acct = once(rec.accounting)
    kept = keep(acct) if keep else staging.shared(acct, "event_id")
    deltas = accounting.accounting_deltas(kept, scale, tie="event_id")
    return events.aaa_events(once(rec.auth), deltas, once(rec.control))
