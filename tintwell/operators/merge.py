"""Order-dependent merging of overlapping tile observations, as a fold over each image's sorted observations.

An observation joins the merged item it overlaps most, the later one among equals, if the overlap reaches the threshold;
else it founds a new item. An item takes the box, type and text of its most confident source. The fold is a native
aggregate over an array, so one image's observations, which the tiling bounds, are all that one step holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintwell.functions.geometry import iou
from tintwell.functions.text import visible_text

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def _fold(sorted_items: Column, kind: str, comparable, merge, threshold: float) -> Column:
    start = F.array().cast(f"array<{kind}>")

    def step(done: Column, one: Column) -> Column:
        scores = F.transform(done, lambda c: F.when(comparable(c, one), F.coalesce(iou(c["box"], one["box"]), F.lit(-1.0))).otherwise(F.lit(-1.0)))
        best = F.coalesce(F.array_max(scores), F.lit(-1.0))
        # Of equal scores the later one counts: the first in the reversed array.
        at = F.size(scores) - F.array_position(F.reverse(scores), best).cast("int")
        joined = F.transform(done, lambda c, i: F.when(i == at, merge(c, one, best)).otherwise(c))
        return F.when(best >= threshold, joined).otherwise(F.concat(done, F.array(one)))

    return F.aggregate(sorted_items, start, step)


def merge_texts(observations: DataFrame, threshold: float = 0.5, ascii_only: bool = False) -> DataFrame:
    """Merged texts of each image (A-14, text rule).

    observations: image_id, unit_id, item_id, raw_text, text_type, box (may be null), confidence. Texts must be equal
    after normalisation; an item without a box never merges. Returns image_id, position, raw_text, normalized_text,
    text_type, box, confidence, sources (unit_id, item_id), merge_ious.
    """
    kind = f"struct<unit_id:string,item_id:string,norm:string,raw_text:string,text_type:string,box:{BOX},confidence:double,sources:array<struct<unit_id:string,item_id:string>>,ious:array<double>>"
    one = F.struct("unit_id", "item_id", visible_text(F.col("raw_text"), ascii_only).alias("norm"), "raw_text", "text_type", "box", F.col("confidence").cast("double").alias("confidence"), F.array(F.struct("unit_id", "item_id")).alias("sources"), F.array().cast("array<double>").alias("ious"))

    def merge(c: Column, o: Column, score: Column) -> Column:
        better = o["confidence"] > c["confidence"]
        pick = lambda k: F.when(better, o[k]).otherwise(c[k]).alias(k)
        return F.struct(c["unit_id"].alias("unit_id"), c["item_id"].alias("item_id"), c["norm"].alias("norm"), pick("raw_text"), pick("text_type"), pick("box"), pick("confidence"), F.concat(c["sources"], o["sources"]).alias("sources"), F.concat(c["ious"], F.array(score)).alias("ious"))

    # The box is left out of the order: ids are unique within an image.
    packed = observations.select("image_id", one.alias("o")).groupBy("image_id").agg(F.array_sort(F.collect_list("o"), lambda a, b: _by_ids(a, b)).alias("o"))
    done = packed.select("image_id", F.posexplode(_fold(F.col("o"), kind, lambda c, o: c["norm"] == o["norm"], merge, threshold)).alias("position", "m"))
    return done.select("image_id", "position", "m.raw_text", F.col("m.norm").alias("normalized_text"), "m.text_type", "m.box", "m.confidence", "m.sources", F.col("m.ious").alias("merge_ious"))


def _by_ids(a: Column, b: Column) -> Column:
    return F.when(a["unit_id"] < b["unit_id"], -1).when(a["unit_id"] > b["unit_id"], 1).when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0)


def merge_regions(observations: DataFrame, threshold: float = 0.6, ascii_only: bool = False) -> DataFrame:
    """Merged colour regions of each image (A-14, region rule).

    observations: image_id, unit_id, item_id, region_type, shade_code, box, confidence, linked_ids, risks. Types must be
    equal and codes must not conflict. A missing code is taken from a later source; links and risks become sorted unions.
    Returns image_id, position, region_type, shade_code, box, confidence, linked_ids, risks, sources.
    """
    kind = f"struct<unit_id:string,item_id:string,region_type:string,shade_code:string,code:string,box:{BOX},confidence:double,linked_ids:array<string>,risks:array<string>,sources:array<struct<unit_id:string,item_id:string>>>"
    code = F.nullif(visible_text(F.coalesce("shade_code", F.lit("")), ascii_only), F.lit(""))
    one = F.struct("unit_id", "item_id", "region_type", "shade_code", code.alias("code"), "box", F.col("confidence").cast("double").alias("confidence"), F.array_sort(F.array_distinct("linked_ids")).alias("linked_ids"), F.array_sort(F.array_distinct("risks")).alias("risks"), F.array(F.struct("unit_id", "item_id")).alias("sources"))

    def merge(c: Column, o: Column, _: Column) -> Column:
        better = o["confidence"] > c["confidence"]
        pick = lambda k: F.when(better, o[k]).otherwise(c[k]).alias(k)
        both = lambda k: F.array_sort(F.array_union(c[k], o[k])).alias(k)
        return F.struct(c["unit_id"].alias("unit_id"), c["item_id"].alias("item_id"), c["region_type"].alias("region_type"), F.coalesce(c["shade_code"], o["shade_code"]).alias("shade_code"), F.coalesce(c["code"], o["code"]).alias("code"), pick("box"), pick("confidence"), both("linked_ids"), both("risks"), F.concat(c["sources"], o["sources"]).alias("sources"))

    comparable = lambda c, o: (c["region_type"] == o["region_type"]) & F.coalesce(c["code"] == o["code"], F.lit(True))
    packed = observations.select("image_id", one.alias("o")).groupBy("image_id").agg(F.array_sort(F.collect_list("o"), lambda a, b: _by_ids(a, b)).alias("o"))
    done = packed.select("image_id", F.posexplode(_fold(F.col("o"), kind, comparable, merge, threshold)).alias("position", "m"))
    return done.select("image_id", "position", "m.region_type", "m.shade_code", "m.box", "m.confidence", "m.linked_ids", "m.risks", "m.sources")


def overlapping(observations: DataFrame, group: list[str], key: str, threshold: float) -> DataFrame:
    """Pairs of one group whose boxes overlap by at least the threshold (J-18)."""
    side = lambda s: observations.select(*group, F.col(key).alias(f"{s}_id"), F.col("box").alias(f"{s}_box"))
    both = side("left").join(side("right"), group).where("left_id < right_id").withColumn("iou", iou(F.col("left_box"), F.col("right_box")))
    return both.where(F.col("iou") >= threshold).select(*group, "left_id", "right_id", "iou")
