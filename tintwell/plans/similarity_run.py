"""The similarity pipeline: from extracted regions to observations, profiles, pairs and nearest shades."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintwell.functions import color, ids, text
from tintwell.operators import entities, relational, similarity

NAMESPACE = ids.NAMESPACE


@dataclass(frozen=True)
class Options:
    top_k: int = 10
    max_delta_e00: float | None = None
    lab_tolerance: float = 1e-6
    representation: str = "swatch"
    snapshot: str = "snapshot"

    def __post_init__(self) -> None:
        if self.top_k < 1 or (self.max_delta_e00 is not None and self.max_delta_e00 < 0):
            raise ValueError("top_k must be positive and max_delta_e00 must not be negative")


def observations(regions: DataFrame, texts: DataFrame, records: DataFrame, options: Options = Options()) -> DataFrame:
    """One row for each region: its code, identity, colour and every reason why it is not formal.

    regions: image_id, region_id, region_type, shade_code_text, linked_ids, links_broken, extraction_status, semantics,
    color_hex, rgb, lab, color_confidence, association_confidence, share, dispersion. texts: image_id, text_id,
    text_type, normalized_text. records: image_id, record_id, sku, color_text.
    """
    linked = entities.linked_codes(regions, texts.withColumn("normalized_text", text.nfkc("normalized_text")))
    tokens = F.array_distinct(F.flatten(F.transform("linked_texts", lambda t: text.shade_tokens(t, ascii_only=True))))
    rows = linked.withColumn("tokens", F.when(F.size("linked_texts") > 0, tokens))
    direct = text.shade_tokens(F.col("shade_code_text"))
    rows = rows.withColumns({"code": F.when(F.size("tokens") == 1, F.get("tokens", F.lit(0))), "direct": direct})
    c = F.col
    problem = color.color_payload_problem(c("color_hex"), c("rgb"), c("lab"), options.lab_tolerance)
    reasons = entities.exclusion_reasons(c("links_broken"), c("tokens"), c("direct"), problem, c("extraction_status"), c("semantics"), c("region_type"), c("color_confidence"), c("association_confidence"))
    known = entities.resolve_codes(rows.where("code IS NOT NULL").select("image_id", "code").distinct(), records)
    rows = rows.join(known, ["image_id", "code"], "left")
    local = ids.stable_id("shade_local", NAMESPACE, F.lit(options.snapshot), c("image_id"), c("code"))
    shade = F.when(c("identity_status") == "business_resolved", ids.stable_id("shade_sku", NAMESPACE, F.lit(options.snapshot), c("sku"))).when(c("code").isNotNull(), local)
    lab = lambda k: F.get("lab", F.lit(k))
    return rows.select("image_id", "region_id", ids.stable_id("obs", NAMESPACE, c("image_id"), c("region_id")).alias("observation_id"), c("code").alias("shade_code"), F.coalesce("identity_status", F.lit("excluded")).alias("identity_status"), shade.alias("shade_id"), F.lit(options.representation).alias("representation"), color.normalized_hex(c("color_hex")).alias("color_hex"), lab(0).alias("l"), lab(1).alias("a"), lab(2).alias("b"), F.when(c("color_confidence") == "high", "high").otherwise("medium").alias("quality_tier"), "share", "dispersion", reasons.alias("reasons"), (F.size(reasons) == 0).alias("formal"))


def profiles(observed: DataFrame) -> DataFrame:
    return similarity.profiles(observed.where("formal"))


def pairs(profile_rows: DataFrame) -> DataFrame:
    return similarity.pairs(profile_rows, "representation", "shade_id")


def topk(pair_rows: DataFrame, options: Options = Options()) -> DataFrame:
    return similarity.with_score(similarity.ranked(pair_rows, "representation", options.top_k, options.max_delta_e00))


def summary(regions: DataFrame, observed: DataFrame, profile_rows: DataFrame, pair_rows: DataFrame, options: Options = Options()) -> DataFrame:
    """One row of counts, without writing anything (A-9, A-27)."""
    plan = similarity.plan_counts(pair_rows, "representation", options.top_k, options.max_delta_e00)
    seen = observed.agg(F.count_distinct("image_id").alias("images"), F.count(F.lit(1)).alias("regions"), F.count_if("formal").alias("formal"))
    made = profile_rows.agg(F.count(F.lit(1)).alias("profiles"), F.count_if(F.array_contains("identity_statuses", "business_resolved")).alias("resolved"))
    # Each side is one row.
    return seen.withColumn("_k", F.lit(1)).join(made.withColumn("_k", F.lit(1)), "_k").join(plan.withColumn("_k", F.lit(1)), "_k").drop("_k")


def reasons(observed: DataFrame) -> DataFrame:
    """How many observations each reason excludes."""
    return relational.tag_counts(observed, "reasons", "reason")
