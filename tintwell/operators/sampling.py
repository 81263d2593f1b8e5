"""Repeatable samples: quotas by stratum, caps by split, even spacing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintwell.functions.ids import hash_percent, split_name, stable_rank
from tintwell.operators.ranking import numbered
from tintwell.operators.scratch import staged


def _quota(column: str, quotas: Mapping[str, int]):
    out = F.lit(0)
    for name, n in quotas.items():
        out = F.when(F.col(column) == name, n).otherwise(out)
    return out


def by_quota(df: DataFrame, key: str, stratum: str, quotas: Mapping[str, int], seed: int | str, label: str, carried: DataFrame | None = None) -> DataFrame:
    """The first rows of each stratum in hash order, as many as its quota, less the carried ones, which come too (O-5, O-7, O-8)."""
    ranked = df.where(F.col(stratum).isin(*quotas)).withColumn("_hash", stable_rank(seed, label, F.col(key)))
    quota = _quota(stratum, quotas)
    if carried is not None:
        held = df.join(carried.select(key), key, "left_semi")
        counts = held.groupBy(stratum).agg(F.count(F.lit(1)).alias("_held"))
        ranked = ranked.join(carried.select(key), key, "left_anti").join(F.broadcast(counts), stratum, "left")  # one row for each stratum
        quota = quota - F.coalesce("_held", F.lit(0))
    place = F.row_number().over(Window.partitionBy(stratum).orderBy("_hash", key))
    # The literal lets each task drop rows beyond the largest quota before the exchange.
    taken = ranked.withColumn("_place", place).where(F.col("_place") <= max(quotas.values(), default=0)).where(F.col("_place") <= quota).select(*df.columns)
    return taken if carried is None else taken.unionByName(held)


def sequential_quota(df: DataFrame, key: str, tags: str, quotas: Mapping[str, int], target: int, seed: int | str) -> DataFrame:
    """Strata of an array of tags in the order of quotas, each row once, then the rest in hash order up to target (O-5).

    Each step takes a bounded number of rows and is written, so none is worked again for a later one, and what is
    selected so far is a broadcast of at most target keys.
    """
    taken = None
    for tag, n in quotas.items():
        pool = df.where(F.array_contains(tags, tag))
        if taken is not None:
            pool = pool.join(F.broadcast(taken.select(key)), key, "left_anti")
        some = staged(pool.orderBy(stable_rank(seed, tag, F.col(key)), key).limit(n).withColumn("stratum", F.lit(tag)), "stratum")
        taken = some if taken is None else taken.unionByName(some)
    rest = df if taken is None else df.join(F.broadcast(taken.select(key)), key, "left_anti")
    more = rest.orderBy(stable_rank(seed, "fill", F.col(key)), key).withColumn("stratum", F.lit("fill"))
    missing = target - (taken.count() if taken is not None else 0)
    more = more.limit(max(0, missing))
    return more if taken is None else taken.unionByName(more)


def with_split_caps(df: DataFrame, key: str, strata: Mapping[str, int], stratum: str, caps: Mapping[str, int], split: str, seed: int | str) -> DataFrame:
    """Quotas by stratum with a cap on each split over all strata, in the order of strata (O-6).

    A row whose split is full is passed over and later ones of the stratum still count. Within a stratum that is: of each
    split the first rows up to what its cap leaves, then of those the first up to the quota. What is left of the caps is
    carried between strata as a few numbers.
    """
    left, parts = dict(caps), []
    for name, quota in strata.items():
        pool = df.where(F.col(stratum) == name).withColumn("_hash", stable_rank(seed, name, F.col(key)))
        within = F.row_number().over(Window.partitionBy(split).orderBy("_hash", key))
        few = pool.withColumn("_n", within).where(F.col("_n") <= max(left.values(), default=0)).where(F.col("_n") <= _quota(split, left))
        some = staged(few.orderBy("_hash", key).limit(quota).select(*df.columns), "stratum")
        for row in some.groupBy(split).count().collect():  # one row for each split
            left[row[0]] -= row[1]
        parts.append(some)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def with_split(df: DataFrame, group: str, seed: int | str, train: int = 60, dev: int = 20) -> DataFrame:
    """df with split, the same for all rows of a group (O-10)."""
    return df.withColumn("split", split_name(hash_percent(seed, F.col(group)), train, dev))


def leaking_groups(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """Groups with rows in more than one split (A-23)."""
    return df.groupBy(group).agg(F.count_distinct(split).alias("split_count")).where("split_count > 1")


def evenly(df: DataFrame, order: list[str], count: int) -> DataFrame:
    """About `count` rows at equal distances in the order, the first and last among them (O-9)."""
    rows = numbered(df, order, "_number")
    n = rows.count()
    if count >= n:
        return rows.drop("_number")
    at = sorted({round(i * (n - 1) / (count - 1)) + 1 if count > 1 else 1 for i in range(count)})
    return rows.where(F.col("_number").isin(at)).drop("_number")
