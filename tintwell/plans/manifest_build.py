"""The lineage pipeline: catalogue rows, their image references and the files found, matched and rolled up."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.functions import ids, text
from tintwell.operators import checks, relational
from tintwell.sources import readers

NAMESPACE = ids.NAMESPACE


def build(spark: SparkSession, catalog_path: str, image_root: str, snapshot: str) -> dict[str, DataFrame]:
    """Lineage tables by name. A reference's expected path is brand/product/file name; files are matched to it by path.

    source_records, source_image_refs, image_occurrences, image_contents, source_ref_occurrences, folder_groups,
    brand_alias_candidates.
    """
    rows = readers.catalog(spark, catalog_path)
    records = rows.withColumns({
        "source_record_id": ids.stable_id("rec", NAMESPACE, F.lit(snapshot), F.col("row_number")),
        "folder": F.concat_ws("/", text.safe_component(F.col("brand_name"), "unknown_brand"), text.safe_component(F.col("goods_id"), "unknown_product")),
    })
    refs = readers.image_refs(rows).join(records.select("row_number", "source_record_id", "folder"), "row_number")
    refs = refs.withColumn("expected_path", F.concat_ws("/", "folder", text.output_filename(F.col("field_name"), F.col("position"), F.col("url"))))
    refs = refs.withColumn("source_ref_id", ids.stable_id("ref", NAMESPACE, F.col("source_record_id"), F.col("field_name"), F.col("position")))
    found = readers.files(spark, image_root).withColumn("occurrence_id", ids.stable_id("occ", NAMESPACE, F.lit(snapshot), F.col("relative_path")))
    contents = found.groupBy(F.col("sha256").alias("image_id")).agg(F.count(F.lit(1)).alias("occurrence_count"), F.min("relative_path").alias("first_path"), F.max("size_bytes").alias("size_bytes"), F.max("format").alias("format"))
    matched = relational.exact_then_folded(refs.select("source_ref_id", "expected_path"), found, "expected_path", "relative_path", "occurrence_id")
    links = matched.where("matched_id IS NOT NULL").select("source_ref_id", F.col("matched_id").alias("occurrence_id"), "match_method", "match_confidence")
    files = found.withColumn("folder", F.regexp_replace("relative_path", "/[^/]*$", ""))
    return {
        "source_records": records,
        "source_image_refs": refs,
        "image_occurrences": found,
        "image_contents": contents,
        "source_ref_occurrences": links,
        "folder_groups": relational.rollup_status(files, records, "folder"),
        "brand_alias_candidates": relational.alias_groups(records, "brand_id", "brand_name"),
    }


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """Integrity rules of the lineage tables, one row each (PIPE-2, PIPE-3)."""
    t = tables
    return checks.report(
        checks.unique(t["source_records"], "source_record_id", "source_record_id"),
        checks.unique(t["source_image_refs"], "source_ref_id", "source_ref_id"),
        checks.unique(t["image_occurrences"], "occurrence_id", "occurrence_id"),
        checks.foreign_key(t["source_image_refs"], t["source_records"], "ref_has_record", "source_record_id", "source_record_id"),
        checks.foreign_key(t["source_ref_occurrences"], t["image_occurrences"], "link_has_occurrence", "occurrence_id", "occurrence_id"),
        checks.foreign_key(t["image_occurrences"], t["image_contents"], "occurrence_has_content", "sha256", "image_id"),
        checks.holds(t["source_ref_occurrences"], "confidence_range", F.col("match_confidence").between(0, 1)),
    )
