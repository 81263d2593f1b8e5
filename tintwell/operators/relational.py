"""Patterns that recur in every pipeline: latest rows, matches with fallback, upserts, groups and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns (W-2, W-4, W-5)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order)))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def latest_value(df: DataFrame, keys: list[str], value: str, order: list[str], to: str) -> DataFrame:
    """The value of the last row of each key, in one aggregation (W-3)."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(to))


def without_revoked(events: DataFrame, revocations: DataFrame, key: str = "event_id", target: str = "revokes_event_id") -> DataFrame:
    """Events that no revocation names (J-6)."""
    return events.join(revocations.select(F.col(target).alias(key)), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of child without a parent (J-5, J-7)."""
    return child.join(parent.select(F.col(parent_key).alias("_key")), F.col(child_key) == F.col("_key"), "left_anti")


def having_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the keys (P-3, J-8, J-9)."""
    return df.join(keys.select(on), on, "left_semi")


def narrowed(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows that have every wanted value that is given: a list is any of its values, None asks for nothing (P-9)."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return df


def selected(df: DataFrame, key: str, path: str, one: object = None, listed: DataFrame | None = None, folder: str | None = None, limit: int | None = None) -> DataFrame:
    """The rows that exactly one selector names: a key, a list of keys, a folder of the path, or a number of first rows by path (P-10)."""
    given = [s for s in (one, listed, folder, limit) if s is not None]
    if len(given) != 1:
        raise ValueError(f"exactly one selector is needed, not {len(given)}")
    if one is not None:
        return df.where(F.col(key) == F.lit(one))
    if listed is not None:
        return having_keys(df, listed, key)
    if folder is not None:
        return df.where(F.startswith(F.col(path), F.lit(folder.rstrip("/") + "/")))
    return df.orderBy(F.lower(path), path, key).limit(limit)


def exact_then_folded(left: DataFrame, right: DataFrame, left_path: str, right_path: str, right_id: str) -> DataFrame:
    """left, row for row, with matched id, method and confidence: the same path at 1.0, else a path that is the only one of its folded form at 0.99 (J-14).

    Where several rows of right have the path, the smallest id counts. Folding is to lower case.
    """
    exact = right.groupBy(F.col(right_path).alias("_exact")).agg(F.min(right_id).alias("_exact_id"))
    folded = right.groupBy(F.lower(right_path).alias("_folded")).agg(F.count(F.lit(1)).alias("_n"), F.min(right_id).alias("_folded_id")).where("_n = 1")
    both = left.join(exact, F.col(left_path) == F.col("_exact"), "left").join(folded, F.lower(left_path) == F.col("_folded"), "left")
    method = F.when(F.col("_exact_id").isNotNull(), "downloader_exact_path").when(F.col("_folded_id").isNotNull(), "downloader_casefold_path").otherwise("unmatched")
    confidence = F.when(F.col("_exact_id").isNotNull(), 1.0).when(F.col("_folded_id").isNotNull(), 0.99)
    return both.select(*left.columns, F.coalesce("_exact_id", "_folded_id").alias("matched_id"), method.alias("match_method"), confidence.alias("match_confidence"))


def path_then_digest(left: DataFrame, right: DataFrame, path: str, digest: str, order: str, value: str) -> DataFrame:
    """left with the value of right's last row of the same path, else of its first row of the same digest, by right's order column (J-15)."""
    by_path = right.groupBy(F.col(path).alias("_path")).agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias("_by_path"))
    by_digest = right.groupBy(F.col(digest).alias("_digest")).agg(F.min_by(F.struct(F.col(value).alias("v")), order).alias("_by_digest"))
    both = left.join(by_path, F.col(path) == F.col("_path"), "left").join(by_digest, F.col(digest) == F.col("_digest"), "left")
    method = F.when(F.col("_by_path").isNotNull(), "path").when(F.col("_by_digest").isNotNull(), "digest").otherwise("none")
    return both.select(*left.columns, F.coalesce("_by_path", "_by_digest")["v"].alias(value), method.alias("match_method"))


def insert_if_absent(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """existing, and of new the first row by order of each key that existing lacks (DML-1)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = new.withColumn("_place", place).where("_place = 1").drop("_place")
    return existing.unionByName(first.join(existing.select(*keys), keys, "left_anti"))


def replace_by_key(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and of existing the rows whose key is not in new (DML-2)."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def upsert_keeping(existing: DataFrame, new: DataFrame, keys: list[str], keep: Column) -> DataFrame:
    """Rows of either side by key; where both have one, existing's stays if keep (over its columns) holds (DML-3)."""
    others = [c for c in existing.columns if c not in keys]
    old = existing.select(*keys, F.struct(*others).alias("_old"), F.coalesce(keep, F.lit(False)).alias("_keep"))
    fresh = new.select(*keys, F.struct(*others).alias("_new"))
    value = F.when(F.col("_new").isNull() | F.col("_keep"), F.col("_old")).otherwise(F.col("_new"))
    return old.join(fresh, keys, "full").select(*keys, value.alias("_v")).select(*keys, *(F.col(f"_v.{c}") for c in others)).select(*existing.columns)


def rollup_status(members: DataFrame, records: DataFrame, folder: str) -> DataFrame:
    """Counts of both sides by folder and a status by the number of records (A-11)."""
    a = members.groupBy(folder).agg(F.count(F.lit(1)).alias("file_count"))
    b = records.groupBy(folder).agg(F.count(F.lit(1)).alias("record_count"))
    both = a.join(b, folder, "full").withColumns({"file_count": F.coalesce("file_count", F.lit(0)), "record_count": F.coalesce("record_count", F.lit(0))})
    return both.withColumn("status", F.when(F.col("record_count") > 1, "multi_source_record").when(F.col("record_count") == 1, "single_source_record").otherwise("orphan_physical_folder"))


def alias_groups(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keys with more than one name, the names sorted (A-12)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(name)).alias("names"), F.count(F.lit(1)).alias("row_count")).where(F.size("names") > 1)


def tag_counts(df: DataFrame, tags: str, to: str = "tag") -> DataFrame:
    """How many rows have each tag of an array column (A-8, A-9)."""
    return df.select(F.explode(tags).alias(to)).groupBy(to).agg(F.count(F.lit(1)).alias("row_count"))


def json_key_sums(df: DataFrame, column: str) -> DataFrame:
    """Sum and count of the numeric values of each key of a JSON object column (A-10)."""
    pairs = df.select(F.explode(F.from_json(column, "map<string,string>")).alias("key", "value"))
    return pairs.where("try_cast(value AS double) IS NOT NULL").groupBy("key").agg(F.sum(F.expr("try_cast(value AS double)")).alias("total"), F.count(F.lit(1)).alias("row_count"))


def nested(parents: DataFrame, children: DataFrame, key: str, to: str, order: list[str]) -> DataFrame:
    """parents with their children as a sorted array of structs, empty where there is none (SNK-9, A-25)."""
    fields = [c for c in children.columns if c != key]
    fields = order + [c for c in fields if c not in order]
    packed = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(to))
    out = parents.join(packed, key, "left")
    return out.withColumn(to, F.coalesce(to, F.array().cast(packed.schema[to].dataType)))


def attempt_numbers(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df with attempt, counted from 1 within each key (W-7)."""
    return df.withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def completeness(parents: DataFrame, children: DataFrame, key: str, available: Column) -> DataFrame:
    """Expected children, one and those there are, against available ones, by parent (J-23)."""
    counted = children.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_if(available).alias("available_children"))
    out = parents.select(key).join(counted, key, "left")
    return out.select(key, (F.coalesce("_n", F.lit(0)) + 1).alias("expected"), F.coalesce("available_children", F.lit(0)).alias("available_children"))
