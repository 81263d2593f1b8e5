"""Bounded, repeatable samples of labelled rows, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; remainder 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def held_out(id_col: str) -> Column:
    return F.coalesce(fold(id_col) == 0, F.lit(False))


def bounded(rows: DataFrame, class_col: str, id_col: str, per_class: int, max_classes: int = 256) -> DataFrame:
    """About per_class rows of each class, and never more than twice that: those with the smallest hashes of their id.

    One count by class sets the share of hashes to take, so nothing is sorted and no class meets in one task.
    """
    counts = rows.groupBy(class_col).count().orderBy(F.desc("count"), class_col).limit(max_classes).collect()
    if not counts:
        return rows.limit(0)
    share = None
    for value, n in counts:
        take = F.when(F.col(class_col) == F.lit(value), F.lit(min(1.0, per_class / n)))
        share = take if share is None else share.when(F.col(class_col) == F.lit(value), F.lit(min(1.0, per_class / n)))
    at = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.where(at < F.coalesce(share, F.lit(0.0))).limit(2 * per_class * len(counts))
