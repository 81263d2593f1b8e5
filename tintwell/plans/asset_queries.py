"""Queries over layouts, flags and units; documents stand for images, their sizes for edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.functions import geometry
from tintwell.operators import assets
from tintwell.plans.registry import query, table

_IMAGES = "SELECT doc_id, (200 + doc_id * 7 % 1500)::INT AS width, (100 + n_chars)::INT AS height FROM documents"


def _images(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", (F.col("doc_id") * 7 % 1500 + 200).cast("int").alias("width"), (F.col("n_chars") + 100).cast("int").alias("height"))


@query(f"SELECT doc_id, round_even(width / height::DOUBLE, 6) AS aspect_ratio, round_even(width::DOUBLE * height / 1e6, 6) AS megapixels, CASE WHEN width > height THEN 'landscape' WHEN width < height THEN 'portrait' ELSE 'square' END AS orientation FROM ({_IMAGES})")
def size_facts(spark: SparkSession, d: str) -> DataFrame:
    """M-14."""
    f = assets.size_facts(F.col("width"), F.col("height"), 6)
    return _images(spark, d).select("doc_id", f.alias("f")).select("doc_id", "f.*")


@query(f"""
WITH i AS (SELECT *, greatest(width, height)::BIGINT AS n, height >= width AS tall FROM ({_IMAGES})),
 t AS (SELECT *, unnest(CASE WHEN n <= 2048 THEN [0::BIGINT] ELSE list_sort(list_distinct(list_concat(range(0, n - 2048 + 1, 1536), [n - 2048]))) END) AS a FROM i),
 e AS (SELECT *, least(a + 2048, n) AS z, row_number() OVER w - 1 AS k, lag(a) OVER w AS p, lead(a) OVER w AS q FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY a))
SELECT doc_id, k::INT AS tile_index, CASE WHEN tall THEN 0 ELSE a END AS x0, CASE WHEN tall THEN a ELSE 0 END AS y0, CASE WHEN tall THEN width::BIGINT ELSE z END AS x1, CASE WHEN tall THEN z ELSE height::BIGINT END AS y1,
 coalesce(p + 2048 - a, 0) AS overlap_before, coalesce(z - q, 0) AS overlap_after FROM e""")
def layout_tiles(spark: SparkSession, d: str) -> DataFrame:
    """G-6, G-7: tiles along the longer side of each image."""
    return assets.tile_rows(_images(spark, d), "doc_id", "width", "height")


@query("""
WITH f AS (SELECT doc_id, unnest(list_filter(list_concat(string_split(CASE WHEN doc_id % 3 = 0 THEN 'low_resolution;possibly_blurry' WHEN doc_id % 3 = 1 THEN 'long' ELSE '' END, ';'), [CASE WHEN n_chars > 5000 THEN 'long' END, CASE WHEN lang = 'en' THEN 'mismatch' END]), lambda x: x <> '')) AS flag FROM documents)
SELECT DISTINCT doc_id, flag FROM f""")
def quality_flag_rows(spark: SparkSession, d: str) -> DataFrame:
    """G-18: flags of a list column and of conditions, one row each."""
    k = F.col("doc_id") % 3
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars", F.when(k == 0, "low_resolution;possibly_blurry").when(k == 1, "long").otherwise("").alias("listed"))
    return assets.flag_rows(docs, "doc_id", "listed", long=F.col("n_chars") > 5000, mismatch=F.col("lang") == "en")


@query("SELECT sha256(text) AS sha, count(DISTINCT lang) AS lang, count(DISTINCT source) AS source FROM documents GROUP BY 1 HAVING count(DISTINCT lang) > 1 OR count(DISTINCT source) > 1")
def hash_consistency(spark: SparkSession, d: str) -> DataFrame:
    """A-30: contents whose occurrences disagree."""
    docs = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "lang", "source")
    return assets.inconsistent(docs, "sha", "lang", "source")


@query("""
SELECT l_orderkey AS item, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS relation, min(l_discount) AS confidence, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'several_relations' END AS problem FROM lineitem GROUP BY 1""")
def context_population(spark: SparkSession, d: str) -> DataFrame:
    """A-26: items with exactly one relation, and those without."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), "l_returnflag", "l_discount")
    return assets.one_relation_each(lines, "item", "l_returnflag", "l_discount")


@query(f"""
WITH i AS (SELECT doc_id, width, height, 10.0 AS x, 20.0 AS y, doc_id % 9 AS o FROM ({_IMAGES}))
SELECT doc_id, CASE WHEN o IN (2, 3) THEN width - x WHEN o IN (5, 8) THEN y WHEN o IN (6, 7) THEN height - y ELSE x END::DOUBLE AS x, CASE WHEN o IN (3, 4) THEN height - y WHEN o IN (5, 6) THEN x WHEN o IN (7, 8) THEN width - x ELSE y END::DOUBLE AS y FROM i""")
def oriented_points(spark: SparkSession, d: str) -> DataFrame:
    """G-4, G-5: a point of each image as it is shown."""
    p = geometry.oriented(F.col("doc_id") % 9, F.lit(10.0), F.lit(20.0), F.col("width"), F.col("height"))
    return _images(spark, d).select("doc_id", p.alias("p")).select("doc_id", "p.x", "p.y")


@query(f"""
WITH i AS (SELECT *, least(1.0, 1024.0 / greatest(width, height))::DOUBLE AS s FROM ({_IMAGES})), r AS (SELECT *, greatest(1, round_even(width * s, 0))::INT AS w, greatest(1, round_even(height * s, 0))::INT AS h FROM i)
SELECT doc_id, w AS width, h AS height, greatest(w, 11) AS padded_width, greatest(h, 11) AS padded_height, round(width::DOUBLE / w, 9) AS scale_x, round(height::DOUBLE / h, 9) AS scale_y FROM r""")
def preview_geometry(spark: SparkSession, d: str) -> DataFrame:
    """G-8: sizes of previews and the scale back."""
    p = geometry.preview(F.col("width"), F.col("height"), 1024)
    rows = _images(spark, d).select("doc_id", p.alias("p")).select("doc_id", "p.*")
    return rows.withColumns({"scale_x": F.round("scale_x", 9), "scale_y": F.round("scale_y", 9)})


@query(f"""
WITH i AS (SELECT *, 5.0 AS x0, 8.0 AS y0, least(width, 150.5)::DOUBLE AS x1, least(height, 99.25)::DOUBLE AS y1 FROM ({_IMAGES})), d AS (SELECT *, (x1 - x0) * 0.03 AS dx, (y1 - y0) * 0.03 AS dy FROM i)
SELECT doc_id, floor(x0 + dx)::BIGINT AS x0, floor(y0 + dy)::BIGINT AS y0, ceil(x1 - dx)::BIGINT AS x1, ceil(y1 - dy)::BIGINT AS y1 FROM d""")
def shrunken_boxes(spark: SparkSession, d: str) -> DataFrame:
    """G-9: boxes with their edges cut off."""
    b = geometry.box(F.lit(5.0), F.lit(8.0), F.least(F.col("width"), F.lit(150.5)), F.least(F.col("height"), F.lit(99.25)))
    return _images(spark, d).select("doc_id", geometry.shrunken(b, F.col("width"), F.col("height"), 0.03).alias("b")).select("doc_id", "b.*")


@query(f"""
WITH i AS (SELECT *, least(width, height) < 16 OR width * height < 1024 AS bad, greatest(width, height) AS edge, least(width, height) AS short FROM ({_IMAGES})),
 l AS (SELECT *, NOT bad AND edge / short >= 4 AND edge >= 3000 AND short >= 64 AS long FROM i)
SELECT long, count(*) AS images, sum(CASE WHEN NOT long THEN 1 ELSE 1 + (CASE WHEN edge <= 2048 THEN 1 ELSE len(list_distinct(list_concat(range(0, edge - 2048 + 1, 1536), [(edge - 2048)::BIGINT]))) END) END)::BIGINT AS units FROM l GROUP BY 1""")
def unit_plan(spark: SparkSession, d: str) -> DataFrame:
    """PIPE-6: units of ordinary and of long images."""
    images = _images(spark, d).withColumn("long", geometry.image_flags(F.col("width"), F.col("height"))["long"])
    units = assets.planned_units(images, "doc_id", "width", "height", "long")
    counts = units.groupBy((F.col("scope") != "image").alias("long")).agg(F.count_distinct("doc_id").alias("images"), F.count(F.lit(1)).alias("units"))
    return counts.select("long", "images", "units")
