"""Sources: catalogues, file inventories, manifests, images. Each gives a DataFrame; checks are columns or small queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tintwell.functions.ids import stable_id
from tintwell.functions.text import IMAGE_SUFFIXES, image_urls, json_urls, relative_path
from tintwell.operators.images import image_format

CATALOG_COLUMNS = ("asset_id", "sku_id", "goods_id", "brand_id", "brand_name", "sku_name", "sku_concat_name", "sku_color_no", "pic_list", "show_pic")
MANIFEST = "schema_version string, manifest_version string, sequence int, image_id string, sha256 string, source_quick_run_id string, selection_reason string"
PAIR_COLUMNS = "pair_type string, group_id string, path_a string, path_b string, sha256_a string, sha256_b string, phash_a string, phash_b string, phash_distance int, dhash_a string, dhash_b string, dhash_distance int"


def catalog(spark: SparkSession, path: str, required: tuple[str, ...] = CATALOG_COLUMNS, max_rows: int | None = None) -> DataFrame:
    """CSV rows with row_number, the record's number in its file counted from 2; every value is text (SRC-1 to SRC-3).

    A byte order mark is dropped and quoted line breaks are kept. Records are numbered per file in the order of reading.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", maxCharsPerColumn=-1)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    # A multi-line file is one task, in which ids ascend in the order of reading.
    tagged = df.withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    place = F.row_number().over(Window.partitionBy("_file").orderBy("_at")) + 1
    out = tagged.withColumn("row_number", place).drop("_file", "_at")
    return out.where(F.col("row_number") <= max_rows + 1) if max_rows is not None else out


def image_refs(records: DataFrame, fields: tuple[str, ...] = ("pic_list", "show_pic"), python_lists: bool = True) -> DataFrame:
    """One row for each URL of each list field: row_number, field_name, position from 1, url (ST-11)."""
    read = (lambda c: F.coalesce(json_urls(c), image_urls(c))) if python_lists else json_urls
    lists = F.array(*(F.struct(F.lit(f).alias("field_name"), read(F.col(f)).alias("urls")) for f in fields))
    each = records.select("row_number", F.explode(lists).alias("f"))
    urls = each.select("row_number", "f.field_name", F.posexplode("f.urls").alias("position", "url")).withColumns({"url": F.trim("url"), "position": F.col("position") + 1})
    return urls.where("url <> ''")


def files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, only: bool = True) -> DataFrame:
    """Files below a folder with path relative to it, size, SHA-256 and format by first bytes (SRC-4 to SRC-7, SRC-15).

    only leaves out files of other suffixes; else is_image tells them apart. Contents are hashed where they are read.
    """
    base = root.rstrip("/") + "/"
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # Spark gives a full address; what follows the folder's own path is the relative one.
    at = F.locate(base, F.col("path"))
    rel = relative_path(F.substring(F.col("path"), at + len(base), F.length("path")), True)
    suffix = F.lower(F.regexp_extract(rel, r"\.([A-Za-z0-9]+)$", 1))
    out = df.withColumns({"relative_path": rel, "is_image": suffix.isin(*suffixes)})
    if only:
        out = out.where("is_image")
    return out.select("relative_path", "is_image", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), F.sha2("content", 256).alias("sha256"), image_format(F.col("content")).alias("format"))


def images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images: path, pixels (BGR rows), width, height, channels, decoded; corrupt files are rows that are not decoded (SRC-16)."""
    df = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    return df.select(F.col("image.origin").alias("path"), F.col("image.data").alias("pixels"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), (F.col("image.height") > 0).alias("decoded"))


def jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One object a line; a line that is none fails the read (SRC-9, SRC-10)."""
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def legacy_metadata(spark: SparkSession, path: str) -> DataFrame:
    """relative_path, image_id, sha256 by normalised path, equal rows once; a path with different ones is an error (SRC-8)."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"').select(relative_path(F.col("relative_path"), True).alias("relative_path"), "image_id", "sha256").distinct()
    clash = df.groupBy("relative_path").count().where("count > 1").limit(1).collect()
    if clash:
        raise ValueError(f"conflicting rows for {clash[0][0]}")
    return df


def legacy_features(spark: SparkSession, path: str) -> DataFrame:
    """Features by content: flags hold if any of its files has them (SRC-11)."""
    df = jsonl(spark, path, "sha256 string, decode_success boolean, has_alpha boolean, width int, height int")
    long = (F.greatest("width", "height") >= 3000) & (F.greatest("width", "height") >= 4 * F.least("width", "height"))
    return df.groupBy("sha256").agg(F.coalesce(F.max("decode_success"), F.lit(False)).alias("decode_success"), F.coalesce(F.max("has_alpha"), F.lit(False)).alias("has_alpha"), F.coalesce(F.max(long), F.lit(False)).alias("is_long"), F.max("width").alias("width"), F.max("height").alias("height"))


def similarity_manifest(spark: SparkSession, path: str, schema_version: str) -> DataFrame:
    """The manifest's rows in sequence; the first rule that is broken is raised (SRC-12, SRC-13)."""
    df = jsonl(spark, path, MANIFEST)
    n = df.count()
    row = df.agg(
        F.coalesce(F.every(F.col("schema_version") == schema_version), F.lit(False)).alias("schema version"),
        (F.count_distinct("manifest_version") == 1).alias("one manifest version"),
        F.every(F.col("sequence") > 0).alias("positive sequence"),
        (F.count_distinct("sequence") == n).alias("unique sequence"),
        (F.max("sequence") == n).alias("contiguous sequence"),
        F.every(F.col("image_id").rlike("^[0-9a-f]{64}$")).alias("image id"),
        F.every(F.col("image_id").eqNullSafe(F.col("sha256"))).alias("image id is the digest"),
        (F.count_distinct("image_id") == n).alias("unique image"),
        F.every(F.trim("source_quick_run_id") != "").alias("source run"),
        F.every(F.trim("selection_reason") != "").alias("selection reason"),
    ).first()
    if not n:
        raise ValueError("empty manifest")
    for rule, holds in row.asDict().items():
        if not holds:
            raise ValueError(f"manifest breaks the rule: {rule}")
    return df.orderBy("sequence")


def duplicate_pairs(spark: SparkSession, path: str, contents: DataFrame | None = None) -> DataFrame:
    """Near-duplicate pairs of contents, ends in order, the file's first row of each pair; exact and self pairs are left out (SRC-14)."""
    df = spark.read.csv(path, header=True, schema=PAIR_COLUMNS).withColumn("_at", F.monotonically_increasing_id())
    near = df.where("pair_type <> 'exact' AND sha256_a <> sha256_b")
    ends = near.select(F.least("sha256_a", "sha256_b").alias("left_id"), F.greatest("sha256_a", "sha256_b").alias("right_id"), "phash_distance", "dhash_distance", "_at")
    return ends.groupBy("left_id", "right_id").agg(F.min_by("phash_distance", "_at").alias("phash_distance"), F.min_by("dhash_distance", "_at").alias("dhash_distance"))


def lineage(records: DataFrame, refs: DataFrame, occurrences: DataFrame, namespace) -> dict[str, DataFrame]:
    """Lineage tables from catalogue rows, their URLs and the files found: contents, occurrences and links with stable ids."""
    keyed = refs.withColumn("ref_id", stable_id("ref", namespace, F.col("row_number"), F.col("field_name"), F.col("position")))
    found = occurrences.withColumn("occurrence_id", stable_id("occ", namespace, F.col("relative_path")))
    contents = found.groupBy(F.col("sha256").alias("image_id")).agg(F.count(F.lit(1)).alias("occurrence_count"), F.min("relative_path").alias("first_path"), F.max("size_bytes").alias("size_bytes"))
    return {"source_records": records, "source_image_refs": keyed, "image_occurrences": found, "image_contents": contents}


__all__ = ["catalog", "duplicate_pairs", "files", "image_refs", "images", "jsonl", "legacy_features", "legacy_metadata", "lineage", "similarity_manifest"]
