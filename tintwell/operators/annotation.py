"""The append-only annotation log: which events may be appended, which items are complete, how far a set is.

events: event_id, item_id, annotator_id, kind, value, created_at, supersedes_event_id. items: item_id, set_id, blind,
occurrence. Kinds are those of EVENT_KINDS; a revoke names the event it takes back in supersedes_event_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Kinds of events.
EVENT_KINDS = ("role", "eligibility", "region", "mask", "multi_shade", "occurrence_relation", "revoke", "adjudication")
BLIND_KINDS = ("role", "eligibility")


def live(events: DataFrame) -> DataFrame:
    """Events that are no revocation and that none takes back (J-6)."""
    gone = events.where("kind = 'revoke'").select(F.col("supersedes_event_id").alias("event_id"))
    return events.where("kind <> 'revoke'").join(gone, "event_id", "left_anti")


def _scope(events: DataFrame, items: DataFrame) -> DataFrame:
    """events with scope: the annotator for blind labels, else nothing, as each blind annotator revises their own label alone."""
    blind = items.select("item_id", "blind")
    own = F.when(F.col("blind") & F.col("kind").isin(*BLIND_KINDS), F.col("annotator_id")).otherwise("")
    return events.join(blind, "item_id").withColumn("scope", own)


def latest_live(events: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, kind, scope, event_id, value) of the last live event of each (W-2)."""
    rows = _scope(live(events), items)
    last = F.max_by(F.struct("event_id", "value"), F.struct("created_at", "event_id"))
    return rows.groupBy("item_id", "kind", "scope").agg(last.alias("e")).select("item_id", "kind", "scope", "e.event_id", "e.value")


def append_problems(events: DataFrame, items: DataFrame, new: DataFrame) -> DataFrame:
    """Every new event with problem, null where it may be appended to events (P-17, append rules).

    A label must name the latest live event of its item and kind as the one it supersedes, or none if there is none; a
    revoke must name a live event of its item. New events are judged against events, not against each other; of several
    for one item, kind and scope only the first may be appended at a time.
    """
    known = items.select("item_id", "blind")
    rows = new.join(known, "item_id", "left").withColumn("scope", F.when(F.col("blind") & F.col("kind").isin(*BLIND_KINDS), F.col("annotator_id")).otherwise(""))
    last = latest_live(events, items).select("item_id", "kind", "scope", F.col("event_id").alias("_last"))
    target = events.where("kind <> 'revoke'").select(F.col("event_id").alias("supersedes_event_id"), F.col("item_id").alias("_target_item"))
    alive = live(events).select(F.col("event_id").alias("supersedes_event_id"), F.lit(True).alias("_alive"))
    rows = rows.join(last, ["item_id", "kind", "scope"], "left").join(target, "supersedes_event_id", "left").join(alive, "supersedes_event_id", "left")
    place = F.row_number().over(Window.partitionBy("item_id", "kind", "scope", F.when(F.col("kind") == "revoke", F.col("supersedes_event_id"))).orderBy("created_at", "event_id"))
    named, revoke = F.col("supersedes_event_id"), F.col("kind") == "revoke"
    problem = (
        F.when(F.col("blind").isNull(), "unknown_item")
        .when(~F.col("kind").isin(*EVENT_KINDS), "unknown_kind")
        .when(revoke & named.isNull(), "revoke_names_no_event")
        .when(revoke & ~F.col("_target_item").eqNullSafe(F.col("item_id")), "revoke_target_not_on_item")
        .when(revoke & F.col("_alive").isNull(), "already_revoked")
        .when(~revoke & named.isNotNull() & ~named.eqNullSafe(F.col("_last")), "supersedes_not_latest")
        .when(~revoke & named.isNull() & F.col("_last").isNotNull(), "revision_without_reference")
        .when(F.col("_place") > 1, "one_at_a_time")
    )
    return rows.withColumn("_place", place).select(*new.columns, problem.alias("problem"))


def item_status(items: DataFrame, events: DataFrame) -> DataFrame:
    """(item_id, set_id, status): completed, in_progress or pending, from live events.

    An occurrence item needs a relation; a blind one two annotators for role and for eligibility; any other one of each.
    """
    alive = live(events)
    count = lambda kind: F.count_distinct(F.when(F.col("kind") == kind, F.col("annotator_id")))
    seen = alive.groupBy("item_id").agg(count("role").alias("roles"), count("eligibility").alias("eligibilities"), F.count_if(F.col("kind") == "occurrence_relation").alias("relations"), F.count(F.lit(1)).alias("n"))
    both = items.join(seen, "item_id", "left").na.fill(0, ["roles", "eligibilities", "relations", "n"])
    need = F.when(F.col("blind"), 2).otherwise(1)
    done = F.when(F.col("occurrence"), F.col("relations") > 0).otherwise((F.col("roles") >= need) & (F.col("eligibilities") >= need))
    return both.select("item_id", "set_id", F.when(done, "completed").when(F.col("n") > 0, "in_progress").otherwise("pending").alias("status"))


def progress(items: DataFrame, events: DataFrame) -> DataFrame:
    """(set_id, item_status, event_types): maps of counts by set (A-3)."""
    as_map = lambda: F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n"))))
    states = item_status(items, events).groupBy("set_id", F.col("status").alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("set_id").agg(as_map().alias("item_status"))
    kinds = events.join(items.select("item_id", "set_id"), "item_id").groupBy("set_id", F.col("kind").alias("k")).agg(F.count(F.lit(1)).alias("n")).groupBy("set_id").agg(as_map().alias("event_types"))
    return states.join(kinds, "set_id", "left")


def leaking_split_pairs(items: DataFrame, group: str = "group_id", split: str = "split") -> DataFrame:
    """(left_split, right_split, shared): groups that two splits share, for each pair of splits that share any (A-23)."""
    a = items.select(F.col(group).alias("g"), F.col(split).alias("left_split")).distinct()
    b = items.select(F.col(group).alias("g"), F.col(split).alias("right_split")).distinct()
    return a.join(b, "g").where("left_split < right_split").groupBy("left_split", "right_split").agg(F.count(F.lit(1)).alias("shared"))
