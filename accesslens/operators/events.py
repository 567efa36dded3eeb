"""The unified event table and its typed views."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.constants import EVENT_TEXT_COLUMNS
from accesslens.functions.text import text, uint
from accesslens.operators.accounting import with_event_id
from accesslens.schemas import AAA_EVENTS

# Where a packet was captured is not part of the record, so copies get the same id.
_CAPTURE_COLUMNS = ["seq"]


def identify(records: DataFrame) -> DataFrame:
    """Add the content hash that identifies copies of a record."""
    return with_event_id(records.drop(*_CAPTURE_COLUMNS))


def _unified(records: DataFrame, kind: str, at: Column) -> DataFrame:
    have = set(records.columns)
    columns = []
    for field in AAA_EVENTS.fields:
        name = field.name
        if name == "event_time":
            c = at
        elif name == "event_type":
            c = F.lit(kind)
        elif name == "event_id":
            c = F.col("event_id")
        elif name in EVENT_TEXT_COLUMNS:
            c = text(F.col(name)) if name in have else F.lit("")
        else:
            c = uint(F.col(name)) if name in have else F.lit(0)
        columns.append(c.cast(field.dataType).alias(name))
    return records.select(*columns)


def aaa_events(auth: DataFrame, acct: DataFrame, control: DataFrame) -> DataFrame:
    """All records in one table of fixed columns: text defaults to empty, numbers to zero.

    Inputs carry ``event_id`` (see :func:`identify`); accounting carries totals and deltas.
    """
    parts = [
        _unified(auth, "auth", F.coalesce("resp_ts", "req_ts")),
        _unified(acct, "accounting", F.col("ts")),
        _unified(control, "control", F.col("ts")),
    ]
    return reduce(DataFrame.unionByName, parts)


def auth_events(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'auth'")


def accounting_events(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'accounting'")


def control_events(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'control'")
