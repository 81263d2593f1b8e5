"""Shade identities from codes, and how an image's shades relate to its product's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tintwell.functions.text import shade_key, shade_tokens


def resolve_codes(codes: DataFrame, records: DataFrame, ascii_only: bool = False) -> DataFrame:
    """(image_id, code) with identity_status and the resolved record (J-20).

    codes: image_id, code. records: image_id, record_id, sku, color_text. A record supports a code if the code is the
    only token of its colour text. One distinct SKU that is not blank resolves it, to the smallest record with that SKU;
    none leaves it unmatched and several ambiguous.
    """
    tokens = shade_tokens(F.col("color_text"), ascii_only)
    single = records.where(F.trim(F.coalesce("sku", F.lit(""))) != "").withColumn("_t", tokens).where(F.size("_t") == 1).select("image_id", F.get("_t", F.lit(0)).alias("code"), F.trim("sku").alias("sku"), "record_id")
    found = single.groupBy("image_id", "code").agg(F.count_distinct("sku").alias("n"), F.min("sku").alias("sku"), F.min("record_id").alias("record_id"))
    both = codes.join(found, ["image_id", "code"], "left")
    status = F.when(F.col("n") == 1, "business_resolved").when(F.col("n") > 1, "image_local_ambiguous").otherwise("image_local_unmatched")
    return both.select("image_id", "code", status.alias("identity_status"), F.when(F.col("n") == 1, F.col("sku")).alias("sku"), F.when(F.col("n") == 1, F.col("record_id")).alias("record_id"))


def context_relation(role_valid: Column, context: Column, depicted: Column, multi: Column) -> Column:
    """struct(relation, confidence, conflict, overlap) of shade arrays of the product and of the image (P-13, J-21)."""
    keys = lambda a: F.array_distinct(F.transform(a, shade_key))
    overlap = F.array_intersect(keys(depicted), keys(context))
    no_context, no_depicted = F.size(context) == 0, F.size(depicted) == 0
    meets = F.size(overlap) > 0
    relation = F.when(~role_valid, "unrelated").when(no_context, "insufficient_evidence").when(no_depicted, "same_product_unspecified_shade").when(meets & (multi | (F.size(depicted) > 1)), "contains_context_shade").when(meets, "exact_shade_match").otherwise("shade_conflict")
    confidence = F.when(~role_valid, 0.75).when(no_context, 0.35).when(no_depicted, 0.55).when(meets & (multi | (F.size(depicted) > 1)), 0.85).when(meets, 0.9).otherwise(0.65)
    return F.struct(relation.alias("relation"), confidence.alias("confidence"), (role_valid & (no_context | (~no_context & ~no_depicted & ~meets))).alias("conflict"), overlap.alias("overlap"))


def linked_codes(regions: DataFrame, texts: DataFrame) -> DataFrame:
    """(image_id, region_id) with the texts of kind shade_code that a region links to, in order of their ids (J-19)."""
    wanted = regions.select("image_id", "region_id", F.explode("linked_ids").alias("text_id")).distinct()
    found = wanted.join(texts.where("text_type = 'shade_code'").select("image_id", "text_id", "normalized_text"), ["image_id", "text_id"])
    packed = found.groupBy("image_id", "region_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("text_id", "normalized_text"))), lambda s: s["normalized_text"]).alias("linked_texts"))
    return regions.join(packed, ["image_id", "region_id"], "left").withColumn("linked_texts", F.coalesce("linked_texts", F.array().cast("array<string>")))


def exclusion_reasons(links_broken: Column, tokens: Column, direct_tokens: Column, color_problem: Column, extraction_status: Column, semantics: Column, region_type: Column, color_confidence: Column, association_confidence: Column, expected_semantics: str = "image_observed_color_candidate", formal_types: tuple[str, ...] = ("swatch",), accepted: tuple[str, ...] = ("high", "medium")) -> Column:
    """Every reason, in order, why an observation is not formal; it is formal if there is none (P-11)."""
    code = F.when(F.size(tokens) == 1, F.get(tokens, F.lit(0)))
    reasons = F.array(
        F.when(links_broken, "invalid_linked_text_item_ids"),
        F.when(tokens.isNull(), "no_linked_shade_code").when(F.size(tokens) == 0, "shade_code_unparseable").when(F.size(tokens) > 1, "shade_code_ambiguous"),
        F.when(code.isNotNull() & (F.size(direct_tokens) > 0) & (direct_tokens != F.array(code)), "direct_linked_shade_code_conflict"),
        color_problem,
        F.when(extraction_status != "succeeded", F.concat(F.lit("extraction_status_"), extraction_status)),
        F.when(~semantics.eqNullSafe(F.lit(expected_semantics)), "unexpected_source_semantics"),
        F.when(~F.coalesce(region_type.isin(*formal_types), F.lit(False)), "region_type_not_formal"),
        F.when(~F.coalesce(color_confidence.isin(*accepted), F.lit(False)), "color_confidence_not_accepted"),
        F.when(association_confidence.isNull(), "missing_association_confidence"),
    )
    return F.array_distinct(F.array_compact(reasons))


def image_roles(analyses: DataFrame) -> DataFrame:
    """(image_id, role, confidence, status, risks): the preferred scope's most confident role and the units' outcome (A-18, J-10).

    analyses: image_id, unit_id, scope, status, role, confidence, risks. Scopes rank merged_content_summary, image, global_thumbnail, tile;
    a tile's role is a fallback. succeeded and cache_hit units count as good, skipped ones apart, all others as failed.
    """
    scope = F.when(F.col("scope") == "merged_content_summary", 3).when(F.col("scope") == "image", 2).when(F.col("scope") == "global_thumbnail", 1).otherwise(0)
    good = F.col("status").isin("succeeded", "cache_hit")
    best = F.max_by(F.when(good, F.struct("role", "confidence", "scope")), F.when(good, F.struct(scope, "confidence", "unit_id")))
    sums = analyses.groupBy("image_id").agg(best.alias("best"), F.count_if(~good & (F.col("status") != "skipped")).alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("risks")))).alias("risks"))
    status = F.when(F.col("best").isNull() & (F.col("skipped") > 0) & (F.col("failed") == 0), "skipped").when(F.col("best").isNull(), "failed").when((F.col("failed") > 0) | (F.col("best.scope") == "tile"), "partial").otherwise("success")
    return sums.select("image_id", "best.role", "best.confidence", status.alias("status"), "risks")


def preferred_assets(assets: DataFrame) -> DataFrame:
    """The asset of each image, scope and tile: a padded preview before others, then the latest (A-19)."""
    place = F.row_number().over(Window.partitionBy("image_id", "scope", "tile_index").orderBy((F.col("asset_type") == "padded_preview").desc(), F.col("created_at").desc(), F.col("asset_id").desc()))
    return assets.withColumn("_p", place).where("_p = 1").drop("_p")
