"""Layouts, sizes and flags of images as rows, without their pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintwell.functions.geometry import tile_starts


def size_facts(width: Column, height: Column, places: int = 4) -> Column:
    """struct(aspect_ratio, megapixels, orientation), rounded half to even (M-14)."""
    ratio = F.bround(width.cast("double") / height, 6)
    shape = F.when(width > height, "landscape").when(width < height, "portrait").otherwise("square")
    return F.struct(ratio.alias("aspect_ratio"), F.bround(width.cast("double") * height / 1e6, places).alias("megapixels"), shape.alias("orientation"))


def tile_rows(images: DataFrame, key: str, width: str, height: str, tile: int = 2048, overlap: int = 512) -> DataFrame:
    """Tiles of each image along its longer side, with box, shift to the image and overlap with the neighbours (G-6, G-7)."""
    c = F.col
    tall = c(height) >= c(width)
    length = F.when(tall, c(height)).otherwise(c(width)).cast("bigint")
    rows = images.select(key, width, height, tall.alias("_tall"), length.alias("_n"), F.array_sort(tile_starts(length, tile, overlap)).alias("_s"))
    each = rows.select("*", F.posexplode("_s").alias("tile_index", "_a"))
    end = F.least(c("_a") + tile, c("_n"))
    before, after = F.get("_s", c("tile_index") - 1), F.get("_s", c("tile_index") + 1)
    zero = F.lit(0).cast("bigint")
    return each.select(
        key,
        "tile_index",
        F.when(c("_tall"), zero).otherwise(c("_a")).alias("x0"),
        F.when(c("_tall"), c("_a")).otherwise(zero).alias("y0"),
        F.when(c("_tall"), c(width).cast("bigint")).otherwise(end).alias("x1"),
        F.when(c("_tall"), end).otherwise(c(height).cast("bigint")).alias("y1"),
        F.coalesce(before + tile - c("_a"), zero).alias("overlap_before"),
        F.coalesce(end - after, zero).alias("overlap_after"),
    )


def flag_rows(df: DataFrame, key: str, listed: str, **flags: Column) -> DataFrame:
    """One row for each quality flag: those of a ;-list and those whose condition holds, each once (G-18)."""
    own = F.filter(F.transform(F.split(F.coalesce(listed, F.lit("")), ";"), F.trim), lambda v: v != "")
    more = F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), name) for name, cond in flags.items())))
    return df.select(key, F.explode(F.array_distinct(F.concat(own, more))).alias("flag"))


def inconsistent(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Keys with more than one value of any of the columns (A-30)."""
    counts = df.groupBy(key).agg(*(F.count_distinct(v).alias(v) for v in values))
    broken = F.lit(False)
    for v in values:
        broken = broken | (F.col(v) > 1)
    return counts.where(broken)


def one_relation_each(fusions: DataFrame, item: str, relation: str, confidence: str) -> DataFrame:
    """(item, relation, confidence, problem): the smallest confidence; a problem where an item has not exactly one relation (A-26)."""
    found = fusions.groupBy(item).agg(F.min(relation).alias("relation"), F.count_distinct(relation).alias("_n"), F.min(confidence).alias("confidence"))
    return found.select(item, F.when(F.col("_n") == 1, F.col("relation")).alias("relation"), "confidence", F.when(F.col("_n") == 0, "no_relation").when(F.col("_n") > 1, "several_relations").alias("problem"))


def planned_units(images: DataFrame, key: str, width: str, height: str, is_long: str, tile: int = 2048, overlap: int = 512) -> DataFrame:
    """Units of analysis: one of an ordinary image, a global one and one for each tile of a long one (PIPE-6)."""
    long = images.where(is_long)
    tiles = tile_rows(long, key, width, height, tile, overlap).select(key, F.lit("tile").alias("scope"), F.col("tile_index").alias("unit_index"))
    plain = images.where(~F.col(is_long)).select(key, F.lit("image").alias("scope"), F.lit(None).cast("int").alias("unit_index"))
    whole = long.select(key, F.lit("global").alias("scope"), F.lit(None).cast("int").alias("unit_index"))
    return plain.unionByName(whole).unionByName(tiles)
