"""Structured model responses: strict reading, rules across fields, and narrow repairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintwell.functions.geometry import repaired_box
from tintwell.functions.text import without_code_fence

# Vocabularies, literals and limits of the response contract.
ROLES = ("single_bullet", "single_swatch", "lip_effect", "multi_shade_comparison", "color_card", "packaging", "text_promo", "invalid")
TEXT_TYPES = ("shade_code", "shade_name", "brand", "product_name", "claim", "price", "instruction", "other")
REGION_TYPES = ("bullet", "swatch", "lip", "color_block", "product_fill", "other")
LAYOUTS = ("single_panel", "collage", "grid", "long_detail_strip", "decorative_strip", "unknown")
SCOPES = ("image", "global_thumbnail", "tile")
SCHEMA_VERSION, CONTEXT_POLICY = "quick-image-extraction-1.0", "image_only"
MOST_ITEMS, MOST_ROLES = 20, 7

TEXT_ITEM = "struct<text_item_id:string,text:string,text_type:string,bbox_norm:array<double>,confidence:double>"
REGION = "struct<region_id:string,region_type:string,bbox_norm:array<double>,shade_code_text:string,shade_name_text:string,visual_color_name:string,confidence:double,risks:array<string>,linked_text_item_ids:array<string>,association_confidence:double>"
FIELDS = {
    "schema_version": "string",
    "scope": "string",
    "input_context_policy": "string",
    "primary_role": "string",
    "secondary_roles": "array<string>",
    "role_confidence": "double",
    "layout_type": "string",
    "layout_summary": "string",
    "representative_color_eligible": "boolean",
    "eligibility_confidence": "double",
    "eligibility_reasons": "array<string>",
    "summary": "string",
    "quality_risks": "array<string>",
    "text_items": f"array<{TEXT_ITEM}>",
    "color_regions": f"array<{REGION}>",
}
OPTIONAL = ("secondary_roles", "eligibility_reasons", "quality_risks", "text_items", "color_regions")
RESPONSE = ", ".join(f"{k} {v}" for k, v in FIELDS.items()) + ", _bad string"


def _strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def _box_ok(b: Column) -> Column:
    at = lambda k: F.get(b, F.lit(k))
    return F.coalesce((F.size(b) == 4) & F.forall(b, lambda v: v.between(0.0, 1.0)) & (at(0) < at(2)) & (at(1) < at(3)), F.lit(False))


def _distinct(ids: Column) -> Column:
    return F.size(F.array_distinct(ids)) == F.size(ids)


def parsed(df: DataFrame, raw: str) -> DataFrame:
    """df with response, a struct, and problems, the names of the rules it breaks in order (JS-4, JS-5).

    The schema is closed: unknown keys are a problem, as are missing ones without a default. Lists are short and their ids
    unique; links point to text items of the response; a link has an association confidence and the other way round; a
    response about the global thumbnail has no items.
    """
    r = lambda name: F.col(f"response.{name}")
    df = df.withColumn("response", F.from_json(raw, RESPONSE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    keys = _strings(F.map_keys(F.from_json(raw, "map<string,string>")))
    texts, regions = F.coalesce(r("text_items"), F.array().cast(f"array<{TEXT_ITEM}>")), F.coalesce(r("color_regions"), F.array().cast(f"array<{REGION}>"))
    text_ids, secondary = F.transform(texts, lambda t: t["text_item_id"]), _strings(r("secondary_roles"))
    linked = lambda g: _strings(g["linked_text_item_ids"])
    unit = lambda c: F.coalesce(c.between(0.0, 1.0), F.lit(False))
    among = lambda c, names: F.coalesce(c.isin(*names), F.lit(False))
    rules = {
        "not_json": F.col("response").isNull() | r("_bad").isNotNull(),
        "missing_keys": F.size(F.array_except(F.array(*(F.lit(k) for k in FIELDS if k not in OPTIONAL)), keys)) > 0,
        "unknown_keys": F.size(F.array_except(keys, F.array(*map(F.lit, FIELDS)))) > 0,
        "literal": (r("schema_version") != SCHEMA_VERSION) | (r("input_context_policy") != CONTEXT_POLICY) | ~among(r("scope"), SCOPES) | ~among(r("layout_type"), LAYOUTS),
        "role": ~among(r("primary_role"), ROLES) | F.exists(secondary, lambda x: ~among(x, ROLES)) | F.array_contains(secondary, r("primary_role")) | ~_distinct(secondary) | (F.size(secondary) > MOST_ROLES),
        "confidence": ~unit(r("role_confidence")) | ~unit(r("eligibility_confidence")) | F.exists(texts, lambda t: ~unit(t["confidence"])) | F.exists(regions, lambda g: ~unit(g["confidence"])),
        "too_many_items": (F.size(texts) > MOST_ITEMS) | (F.size(regions) > MOST_ITEMS) | F.exists(regions, lambda g: F.size(linked(g)) > MOST_ITEMS),
        "too_long": (F.length(r("layout_summary")) > 1000) | (F.length(r("summary")) > 2000) | F.exists(texts, lambda t: ~F.coalesce(F.length(t["text"]).between(1, 1000), F.lit(False))),
        "duplicate_ids": ~_distinct(text_ids) | ~_distinct(F.transform(regions, lambda g: g["region_id"])) | F.exists(regions, lambda g: ~_distinct(linked(g))),
        "item_type": F.exists(texts, lambda t: ~among(t["text_type"], TEXT_TYPES)) | F.exists(regions, lambda g: ~among(g["region_type"], REGION_TYPES)),
        "bbox": F.exists(texts, lambda t: t["bbox_norm"].isNotNull() & ~_box_ok(t["bbox_norm"])) | F.exists(regions, lambda g: ~_box_ok(g["bbox_norm"])),
        "broken_link": F.exists(regions, lambda g: F.exists(linked(g), lambda i: ~F.array_contains(text_ids, i))),
        "link_confidence": F.exists(regions, lambda g: (F.size(linked(g)) > 0) != g["association_confidence"].isNotNull()),
        "global_items": (r("scope") == "global_thumbnail") & ((F.size(texts) > 0) | (F.size(regions) > 0)),
    }
    problems = F.array_compact(F.array(*(F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules.items())))
    return df.withColumn("problems", F.when(rules["not_json"], F.array(F.lit("not_json"))).otherwise(problems))


def repaired(df: DataFrame, raw: str, width: str, height: str, to: str = "repaired_json") -> DataFrame:
    """df with the response text after narrow repairs, and repair_actions (JS-3, JS-6).

    A code fence is taken off; boxes in pixels or thousandths become fractions where one reading fits. An action names the
    list, the place and the convention. A text that cannot be read is null.
    """
    bare = without_code_fence(F.col(raw))
    df = df.withColumn("_r", F.from_json(bare, RESPONSE, {"columnNameOfCorruptRecord": "_bad"}))
    w, h = F.col(width).cast("double"), F.col(height).cast("double")

    def read(b: Column) -> Column:
        at = lambda k: F.get(b, F.lit(k))
        return repaired_box(F.struct(at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1")), w, h)

    def fix(b: Column) -> Column:
        found = read(b)
        use = (F.size(b) == 4) & found["action"].isin("pixels", "millesimal")
        return F.when(use, F.array(found["box"]["x0"], found["box"]["y0"], found["box"]["x1"], found["box"]["y1"])).otherwise(b)

    def actions(name: str) -> Column:
        done = F.transform(f"_r.{name}", lambda t, i: F.when((F.size(t["bbox_norm"]) == 4) & read(t["bbox_norm"])["action"].isin("pixels", "millesimal"), F.concat(F.lit(f"{name}["), i.cast("string"), F.lit("]:"), read(t["bbox_norm"])["action"], F.lit("_to_normalized"))))
        return F.coalesce(F.array_compact(done), F.array().cast("array<string>"))

    texts = F.transform("_r.text_items", lambda t: t.withField("bbox_norm", fix(t["bbox_norm"])))
    regions = F.transform("_r.color_regions", lambda g: g.withField("bbox_norm", fix(g["bbox_norm"])))
    # A key that the response does not have is left out again, so that it stays missing.
    plain = [F.col(f"_r.{k}").alias(k) for k in FIELDS if k not in ("text_items", "color_regions")]
    fixed = F.struct(*plain, texts.alias("text_items"), regions.alias("color_regions"))
    good = F.col("_r").isNotNull() & F.col("_r._bad").isNull() & (F.size(F.array_except(_strings(F.map_keys(F.from_json(bare, "map<string,string>"))), F.array(*map(F.lit, FIELDS)))) == 0)
    return df.withColumns({to: F.when(good, F.to_json(fixed)).otherwise(bare), "repair_actions": F.concat(actions("text_items"), actions("color_regions"))}).drop("_r")


def strict_or_repaired(df: DataFrame, raw: str, width: str, height: str) -> DataFrame:
    """df with response, problems, repair_actions and status: succeeded, repaired or schema_failed (JS-6, JS-7).

    A response without its code fence that meets the contract has succeeded; one that does after repairs is repaired.
    """
    bare = df.withColumn("_bare", without_code_fence(F.col(raw)))
    first = parsed(bare, "_bare").withColumnsRenamed({"response": "_r1", "problems": "_p1"})
    second = parsed(repaired(first, raw, width, height, "_fixed"), "_fixed")
    strict, fine = F.size("_p1") == 0, F.size("problems") == 0
    none = F.array().cast("array<string>")
    return second.withColumns({
        "status": F.when(strict, "succeeded").when(fine, "repaired").otherwise("schema_failed"),
        "response": F.when(strict, F.col("_r1")).when(fine, F.col("response")),
        "repair_actions": F.when(~strict & fine, F.col("repair_actions")).otherwise(none),
        "problems": F.when(strict | fine, none).otherwise(F.col("_p1")),
    }).drop("_r1", "_p1", "_fixed", "_bare")


def attempts(requests: DataFrame, raws: DataFrame, results: DataFrame, key: str = "cache_key") -> DataFrame:
    """Attempts pieced together from what files are there, with the status they imply (JS-8)."""
    mark = lambda df, name: df.select(key, F.lit(True).alias(name)).distinct()
    both = mark(requests, "requested").join(mark(raws, "answered"), key, "full").join(mark(results, "parsed"), key, "full")
    has = {c: F.coalesce(c, F.lit(False)) for c in ("requested", "answered", "parsed")}
    status = F.when(has["parsed"] & has["answered"], "succeeded").when(has["answered"], "schema_failed").when(has["requested"], "interrupted").otherwise("inconsistent")
    return both.select(key, *(v.alias(k) for k, v in has.items()), status.alias("status"))
