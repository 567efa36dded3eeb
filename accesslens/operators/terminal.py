"""Terminal paths: which network path a terminal had at the time of an event."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesslens.functions.text import compact_mac

PATH_COLUMNS = [
    "batch_id", "collected_at", "olt_device_id", "olt_name", "vlan_id", "if_index", "port_name",
    "onu_mac",
]


def _terminal(address: Column) -> Column:
    """The 12 hex digits of a whole address, else NULL."""
    digits = compact_mac(address)
    return F.when(F.length(digits) == 12, digits)


def terminal_path(
    events: DataFrame, snapshots: DataFrame, batches: DataFrame, ts: str = "ts",
    slot: str = "1 hour",
) -> DataFrame:
    """Events with the newest completed snapshot row of their terminal at or before the event.

    Left outer: events of unknown terminals, and those whose address isn't 12 hex digits, keep NULL
    path columns. Snapshots without such an address belong to no terminal. Of several rows of a
    terminal at the same time the last one (by id) counts.

    Events and snapshots of a (terminal, slot) are ordered together, so a busy terminal is spread over its
    slots. The newest snapshot of each slot is carried into the later slots that have events: one row
    per terminal and slot with anything in it, however long a snapshot stays valid.
    """
    done = batches.filter("status = 'completed'").select("batch_id")
    rows = snapshots.join(done, "batch_id", "left_semi").withColumn(
        "terminal", _terminal(F.col("terminal_mac"))
    ).filter("terminal IS NOT NULL AND collected_at IS NOT NULL")
    # One row per terminal and collection time, before any ordering.
    latest = rows.groupBy("terminal", "collected_at").agg(
        F.max(F.struct("id", *[c for c in PATH_COLUMNS if c != "collected_at"])).alias("row")
    )
    path = F.struct(*[F.col("collected_at") if c == "collected_at" else F.col(f"row.{c}") for c in PATH_COLUMNS])
    placed = latest.select(
        "terminal", F.col("collected_at").alias("at"), F.lit(0).alias("kind"), path.alias("path")
    )
    keyed = events.select(
        _terminal(F.col("mac_addr")).alias("terminal"), F.col(ts).alias("at"), F.lit(1).alias("kind"),
        F.struct("*").alias("event"),
    )
    named = F.col("terminal").isNotNull() & F.col("at").isNotNull()
    both = placed.unionByName(keyed.filter(named), allowMissingColumns=True).withColumn(
        "slot", F.window("at", slot).getField("start")
    )
    until_now = Window.partitionBy("terminal", "slot").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("path", F.last("path", ignorenulls=True).over(until_now)).filter("kind = 1")
    slots = both.groupBy("terminal", "slot").agg(
        F.max_by("path", F.when(F.col("kind") == 0, F.col("at"))).alias("newest")
    )
    earlier = Window.partitionBy("terminal").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("terminal", "slot", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    joined = met.join(carried.filter("carried IS NOT NULL"), ["terminal", "slot"], "left").select(
        "event", F.coalesce("path", "carried").alias("path")
    )
    others = keyed.filter(~named).select("event")
    return joined.unionByName(others, allowMissingColumns=True).select(
        "event.*", *[F.col("path")[c].alias(c) for c in PATH_COLUMNS]
    )
