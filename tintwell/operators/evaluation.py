"""Truth from annotation events, and measures of predictions against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) (A-20)."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of each class of a confusion table (A-20)."""
    sides = matrix.select(F.inline(F.array(F.struct(F.col("truth").alias("class"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p")), F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p")))), F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("h"))
    sums = sides.groupBy("class").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"), (F.sum("h") / 2).cast("bigint").alias("hits"))
    scored = sums.withColumns({"precision": _ratio(F.col("hits"), F.col("predicted")), "recall": _ratio(F.col("hits"), F.col("support"))})
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", F.when(p + r > 0, p * r * 2.0 / (p + r)).otherwise(0.0))


def macro_f1(per_class: DataFrame) -> DataFrame:
    """One row: the mean F1 over classes that occur in the truth, and their number (H-17)."""
    return per_class.where("support > 0").agg(F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"), F.count(F.lit(1)).alias("class_count"))


def binary_metrics(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """One row of tp, fp, fn, precision, recall and f1; 0 on empty denominators (A-21)."""
    counts = df.agg(F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("tp", "fp", "fn", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


def agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """One row: pairs, equal pairs, their ratio, and a map from 'first|second' to counts (A-22)."""
    cells = confusion(df.where(F.col(first).isNotNull() & F.col(second).isNotNull()), first, second)
    return cells.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("equal"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.concat_ws("|", "truth", "predicted"), "n")))).alias("cells")).withColumn("agreement", _ratio(F.col("equal"), F.col("total")))


def resolved_truth(events: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, truth, resolution) of each item (PIPE-9).

    events: event_id, item_id, annotator_id, kind (label, adjudication or revoke), value, created_at, revokes_event_id.
    items: item_id, blind. An adjudication that is not revoked wins, the latest of several. Otherwise an item that is not
    blind takes its latest label, and a blind one needs the latest labels of at least two annotators, all equal.
    """
    live = events.where("kind <> 'revoke'").join(events.where("kind = 'revoke'").select(F.col("revokes_event_id").alias("event_id")), "event_id", "left_anti")
    at = F.struct("created_at", "event_id")
    final = live.where("kind = 'adjudication'").groupBy("item_id").agg(F.max_by("value", at).alias("final"))
    each = live.where("kind = 'label'").groupBy("item_id", "annotator_id").agg(F.max_by("value", at).alias("value"), F.max(at).alias("at"))
    labels = each.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("values"), F.max_by("value", "at").alias("last"))
    both = items.join(final, "item_id", "left").join(labels, "item_id", "left")
    truth = F.when(F.col("final").isNotNull(), F.col("final")).when(~F.col("blind"), F.col("last")).when((F.col("n") >= 2) & (F.col("values") == 1), F.col("last"))
    how = F.when(F.col("final").isNotNull(), "adjudicated").when(truth.isNotNull(), F.when(F.col("blind"), "agreed").otherwise("latest")).otherwise("unresolved")
    return both.select("item_id", truth.alias("truth"), how.alias("resolution"))


def gates(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row of booleans, each an aggregate condition, and passed, their conjunction (A-24)."""
    row = df.agg(*(F.coalesce(c, F.lit(False)).alias(name) for name, c in conditions.items()))
    every = F.lit(True)
    for name in conditions:
        every = every & F.col(name)
    return row.withColumn("passed", every)


def call_plan(units: DataFrame, cached: Column, failed_children: Column, headroom: float = 1.2) -> DataFrame:
    """One row: units, cache hits, calls, calls with headroom rounded up, and the worst case of a retry each (A-28)."""
    base = units.agg(F.count(F.lit(1)).alias("units"), F.count_if(cached).alias("cache_hits"), F.count_if(~cached).alias("calls"), F.count_if(~cached & failed_children).alias("retries"))
    return base.select("units", "cache_hits", "calls", F.ceil(F.col("calls") * headroom).alias("suggested_cap"), (F.col("calls") * 2).alias("worst_case"), "retries")
