"""Latest live annotation by item and kind, kept up as events arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_live(events: DataFrame) -> DataFrame:
    """The latest event of each (item_id, kind) that is not revoked, again after each change.

    events: event_id, item_id, kind, value, created_at, revokes_event_id; a row with revokes_event_id takes that event
    back, before or after it comes. A key without a live event gives a row of nulls. Events that come twice count once;
    if their times or values differ, the later time counts. The state of a key is its events and the ids taken back, as an
    aggregation of Spark's own keeps them.
    """
    text = lambda c: F.col(c).cast("string")
    event = F.struct(text("event_id").alias("id"), F.lit(1).alias("live"), F.col("created_at").cast("timestamp").alias("at"), text("value").alias("value"))
    back = F.struct(text("revokes_event_id").alias("id"), F.lit(0).alias("live"), F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("string").alias("value"))
    seen = events.groupBy(text("item_id").alias("item_id"), text("kind").alias("kind")).agg(F.collect_set(F.when(F.col("revokes_event_id").isNull(), event).otherwise(back)).alias("_seen"))
    best = F.struct(F.lit(None).cast("timestamp").alias("at"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("value"))
    none = F.struct(F.lit(None).cast("string").alias("gone"), best.alias("best"))

    def step(held: Column, e: Column) -> Column:
        """A taken back id stands before its event, as rows are sorted."""
        later = F.greatest(held["best"], F.struct(e["at"].alias("at"), e["id"].alias("id"), e["value"].alias("value")))
        kept = F.when(e["id"] == held["gone"], held["best"]).otherwise(later)
        return F.when(e["live"] == 0, F.struct(e["id"].alias("gone"), held["best"].alias("best"))).otherwise(F.struct(held["gone"].alias("gone"), kept.alias("best")))

    last = F.aggregate(F.array_sort("_seen"), none, step)["best"]
    return seen.select("item_id", "kind", last.alias("_last")).select("item_id", "kind", F.col("_last.id").alias("event_id"), F.col("_last.value").alias("value"), F.col("_last.at").alias("created_at"))


def deduplicated(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Each event id once within the lateness (idempotent delivery)."""
    return events.withWatermark("created_at", lateness).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", width: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Events by window and kind, final once the watermark has passed."""
    return events.withWatermark(at, lateness).groupBy(F.window(at, width), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), kind, "n")


def append_each_batch(events: DataFrame, path: str, checkpoint: str, keys: list[str]):
    """Append every micro-batch to a table once, by batch folder, so that a repeated batch replaces itself (DML-1, DML-6)."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
