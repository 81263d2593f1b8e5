"""Integrity rules as queries: each gives one row (rule, violations)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, rule: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def unique(df: DataFrame, rule: str, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return _row(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), rule)


def foreign_key(child: DataFrame, parent: DataFrame, rule: str, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child whose key is not null and not in parent."""
    keys = parent.select(F.col(parent_key).alias("_key"))
    return _row(child.where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_key"), "left_anti"), rule)


def holds(df: DataFrame, rule: str, condition: Column) -> DataFrame:
    """Rows for which the condition is false; null passes, as in a CHECK."""
    return _row(df.where(~condition), rule)


def report(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def changed_paths(before: DataFrame, after: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """(path, change): added, removed or modified between two inventories (U-B)."""
    a = before.select(path, F.col(digest).alias("_a"))
    b = after.select(path, F.col(digest).alias("_b"))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "modified")
    return a.join(b, path, "full").select(path, change.alias("change")).where("change is not null")


def forbidden_columns(df: DataFrame, forbidden: set[str]) -> set[str]:
    """Names of df's columns that must not be there (P-15)."""
    return {c for c in df.columns if c.lower() in {f.lower() for f in forbidden}}
