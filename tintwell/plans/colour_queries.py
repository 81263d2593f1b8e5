"""Colour, geometry, sampling, text and extraction queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tintwell.functions import color, geometry, ids, text
from tintwell.operators import duplicates, entities, extraction, merge, sampling, similarity
from tintwell.plans.registry import query, table

SEED = "260"

# The published test pairs of the CIEDE2000 formula (Sharma, Wu and Dalal 2005): L, a, b twice and the difference.
CIEDE2000_PAIRS = (
    (50.0000, 2.6772, -79.7751, 50.0000, 0.0000, -82.7485, 2.0425), (50.0000, 3.1571, -77.2803, 50.0000, 0.0000, -82.7485, 2.8615),
    (50.0000, 2.8361, -74.0200, 50.0000, 0.0000, -82.7485, 3.4412), (50.0000, -1.3802, -84.2814, 50.0000, 0.0000, -82.7485, 1.0000),
    (50.0000, -1.1848, -84.8006, 50.0000, 0.0000, -82.7485, 1.0000), (50.0000, -0.9009, -85.5211, 50.0000, 0.0000, -82.7485, 1.0000),
    (50.0000, 0.0000, 0.0000, 50.0000, -1.0000, 2.0000, 2.3669), (50.0000, -1.0000, 2.0000, 50.0000, 0.0000, 0.0000, 2.3669),
    (50.0000, 2.4900, -0.0010, 50.0000, -2.4900, 0.0009, 7.1792), (50.0000, 2.4900, -0.0010, 50.0000, -2.4900, 0.0010, 7.1792),
    (50.0000, 2.4900, -0.0010, 50.0000, -2.4900, 0.0011, 7.2195), (50.0000, 2.4900, -0.0010, 50.0000, -2.4900, 0.0012, 7.2195),
    (50.0000, -0.0010, 2.4900, 50.0000, 0.0009, -2.4900, 4.8045), (50.0000, -0.0010, 2.4900, 50.0000, 0.0010, -2.4900, 4.8045),
    (50.0000, -0.0010, 2.4900, 50.0000, 0.0011, -2.4900, 4.7461), (50.0000, 2.5000, 0.0000, 50.0000, 0.0000, -2.5000, 4.3065),
    (50.0000, 2.5000, 0.0000, 73.0000, 25.0000, -18.0000, 27.1492), (50.0000, 2.5000, 0.0000, 61.0000, -5.0000, 29.0000, 22.8977),
    (50.0000, 2.5000, 0.0000, 56.0000, -27.0000, -3.0000, 31.9030), (50.0000, 2.5000, 0.0000, 58.0000, 24.0000, 15.0000, 19.4535),
    (50.0000, 2.5000, 0.0000, 50.0000, 3.1736, 0.5854, 1.0000), (50.0000, 2.5000, 0.0000, 50.0000, 3.2972, 0.0000, 1.0000),
    (50.0000, 2.5000, 0.0000, 50.0000, 1.8634, 0.5757, 1.0000), (50.0000, 2.5000, 0.0000, 50.0000, 3.2592, 0.3350, 1.0000),
    (60.2574, -34.0099, 36.2677, 60.4626, -34.1751, 39.4387, 1.2644), (63.0109, -31.0961, -5.8663, 62.8187, -29.7946, -4.0864, 1.2630),
    (61.2901, 3.7196, -5.3901, 61.4292, 2.2480, -4.9620, 1.8731), (35.0831, -44.1164, 3.7933, 35.0232, -40.0716, 1.5901, 1.8645),
    (22.7233, 20.0904, -46.6940, 23.0331, 14.9730, -42.5619, 2.0373), (36.4612, 47.8580, 18.3852, 36.2715, 50.5065, 21.2231, 1.4146),
    (90.8027, -2.0831, 1.4410, 91.1528, -1.6435, 0.0447, 1.4441), (90.9257, -0.5406, -0.9208, 88.6381, -0.8985, -0.7239, 1.5381),
    (6.7747, -0.2908, -2.4247, 5.8714, -0.0985, -2.2286, 0.6377), (2.0776, 0.0795, -1.1350, 0.9033, -0.0636, -0.5514, 0.9082),
)


def lab_vectors(spark: SparkSession, d: str) -> DataFrame:
    """vec_id, label and a Lab colour from the first three dimensions of each vector."""
    e = lambda k: F.get("embedding", F.lit(k)).cast("double")
    return table(spark, d, "embeddings").select("vec_id", "label", (e(0) * 100.0 + 50.0).alias("l"), (e(1) * 200.0).alias("a"), (e(2) * 200.0).alias("b"))


_LAB = "SELECT vec_id, label, embedding[1]::DOUBLE * 100.0 + 50.0 AS l, embedding[2]::DOUBLE * 200.0 AS a, embedding[3]::DOUBLE * 200.0 AS b FROM embeddings"
_JOINED = f"SELECT x.label, x.vec_id AS left_id, y.vec_id AS right_id, x.l AS l1, x.a AS a1, x.b AS b1, y.l AS l2, y.a AS a2, y.b AS b2 FROM ({_LAB}) x JOIN ({_LAB}) y ON x.label = y.label AND x.vec_id < y.vec_id"
_HUE = "CASE WHEN atan2({b}, {a}) < 0 THEN degrees(atan2({b}, {a})) + 360.0 ELSE degrees(atan2({b}, {a})) END"
_H1, _H2 = _HUE.format(a="a1", b="b1"), _HUE.format(a="a2", b="b2")
_KEEP = f"label, left_id, right_id, abs(l1 - l2) AS delta_l, abs(sqrt(a1 * a1 + b1 * b1) - sqrt(a2 * a2 + b2 * b2)) AS delta_c, least(abs(({_H1}) - ({_H2})), 360.0 - abs(({_H1}) - ({_H2}))) AS delta_h"
_PAIRS = color.ciede2000_sql("l1", "a1", "b1", "l2", "a2", "b2", _JOINED, _KEEP)
_BAND = "CASE WHEN delta_e00 <= 2 THEN 'de00_le_2' WHEN delta_e00 <= 5 THEN 'de00_gt_2_le_5' WHEN delta_e00 <= 10 THEN 'de00_gt_5_le_10' WHEN delta_e00 <= 20 THEN 'de00_gt_10_le_20' ELSE 'de00_gt_20' END"


@query(f"""
WITH p AS ({_PAIRS}), b AS (SELECT label, left_id AS query_id, right_id AS candidate_id, delta_e00, delta_l, delta_c, delta_h FROM p UNION ALL SELECT label, right_id, left_id, delta_e00, delta_l, delta_c, delta_h FROM p)
SELECT label, query_id, candidate_id, round(delta_e00, 6) AS delta_e00, round(100.0 / ((delta_e00 / 10.0) * (delta_e00 / 10.0) + 1.0), 6) AS similarity, {_BAND} AS band,
       row_number() OVER (PARTITION BY label, query_id ORDER BY round(delta_e00, 9), round(delta_l, 9), round(delta_c, 9), candidate_id)::INT AS rank FROM b QUALIFY rank <= 10""")
def profile_ranked_topk(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: the ten nearest colours of each within its class (J-16, M-4, U-A, W-1)."""
    found = similarity.with_score(similarity.nearest(lab_vectors(spark, d), "label", "vec_id", 10))
    return found.select("label", "query_id", "candidate_id", F.round("delta_e00", 6).alias("delta_e00"), F.round("similarity", 6).alias("similarity"), "band", "rank")


@query(f"SELECT label, left_id, right_id, round(delta_e00, 6) AS delta_e00, round(delta_l, 6) AS delta_l, round(delta_c, 6) AS delta_c, round(delta_h, 6) AS delta_h FROM ({_PAIRS})")
def profile_pairs(spark: SparkSession, d: str) -> DataFrame:
    """J-16, M-9: every pair of a class once."""
    return similarity.pairs(lab_vectors(spark, d), "label", "vec_id", places=6)


@query(f"SELECT label, {_BAND} AS band, count(*) AS n FROM ({_PAIRS}) GROUP BY 1, 2")
def pair_bands(spark: SparkSession, d: str) -> DataFrame:
    """M-8."""
    return similarity.band_counts(lab_vectors(spark, d), "label", "vec_id")


@query(f"""
WITH p AS ({_PAIRS}), b AS (SELECT label, left_id AS vec_id, delta_e00 FROM p UNION ALL SELECT label, right_id, delta_e00 FROM p), s AS (SELECT label, vec_id, round(sum(delta_e00), 9) AS s FROM b GROUP BY 1, 2)
SELECT v.label, count(*) AS observation_count, arg_min(v.vec_id, (coalesce(s, 0.0), -(v.vec_id % 2), -(v.vec_id % 5), v.vec_id % 3, v.vec_id)) AS medoid_id FROM ({_LAB}) v LEFT JOIN s ON v.label = s.label AND v.vec_id = s.vec_id GROUP BY 1""")
def profile_medoid(spark: SparkSession, d: str) -> DataFrame:
    """A-16: the member nearest to all others of each class, with quality, share and dispersion as tie-breakers."""
    rows = lab_vectors(spark, d).withColumns({"q": F.col("vec_id") % 2, "s": F.col("vec_id") % 5, "disp": F.col("vec_id") % 3})
    return similarity.medoids(rows, "label", "vec_id", "q", "s", "disp").select("label", "observation_count", "medoid_id")


@query(f"SELECT label, count(*) AS pair_count, round(median(delta_e00), 6) AS p50_delta_e00, round(max(delta_e00), 6) AS max_delta_e00 FROM ({_PAIRS}) GROUP BY 1")
def profile_stats(spark: SparkSession, d: str) -> DataFrame:
    """A-17, M-13."""
    found = similarity.spread(lab_vectors(spark, d), "label", "vec_id")
    return found.select("label", "pair_count", F.round("p50_delta_e00", 6).alias("p50_delta_e00"), F.round("max_delta_e00", 6).alias("max_delta_e00"))


@query(f"""
WITH p AS (SELECT * FROM ({_PAIRS}) WHERE delta_e00 <= 20), e AS (SELECT label, left_id AS q FROM p UNION ALL SELECT label, right_id FROM p), c AS (SELECT label, q, count(*) AS n FROM e GROUP BY 1, 2)
SELECT (sum(n) // 2)::BIGINT AS pair_count, count(*) AS query_count, sum(least(10, n))::BIGINT AS topk_rows FROM c""")
def plan_counts(spark: SparkSession, d: str) -> DataFrame:
    """A-27, P-6: what a run with a cutoff of 20 would give."""
    return similarity.planned(lab_vectors(spark, d), "label", "vec_id", 10, 20.0)


_VALUES = ", ".join(f"({k}, {', '.join(f'{v}::DOUBLE' for v in row)})" for k, row in enumerate(CIEDE2000_PAIRS, 1))


@query("SELECT pair, round(delta_e00, 9) AS delta_e00, abs(delta_e00 - expected) <= 0.0001 AS agrees FROM (" + color.ciede2000_sql("l1", "a1", "b1", "l2", "a2", "b2", f"SELECT * FROM (VALUES {_VALUES}) t(pair, l1, a1, b1, l2, a2, b2, expected)", "pair, expected") + ")")
def ciede2000_sharma(spark: SparkSession, d: str) -> DataFrame:
    """M-4 on the 34 published pairs."""
    rows = spark.createDataFrame([(k, *r) for k, r in enumerate(CIEDE2000_PAIRS, 1)], "pair int, l1 double, a1 double, b1 double, l2 double, a2 double, b2 double, expected double")
    found = color.with_ciede2000(rows, "l1", "a1", "b1", "l2", "a2", "b2")
    return found.select("pair", F.round("delta_e00", 9).alias("delta_e00"), (F.abs(F.col("delta_e00") - F.col("expected")) <= 0.0001).alias("agrees"))


_RGB = "SELECT p_partkey, (p_partkey * 37 % 256)::INT AS r, (p_partkey * 91 % 256)::INT AS g, (p_partkey * 53 % 256)::INT AS b FROM part"
_LIN = "CASE WHEN {c} / 255.0::DOUBLE <= 0.04045 THEN {c} / 255.0::DOUBLE / 12.92 ELSE pow(({c} / 255.0::DOUBLE + 0.055) / 1.055, 2.4) END"


def _xyz_sql() -> str:
    rows = []
    for name, row, white in zip("xyz", color.MATRIX, color.WHITE, strict=True):
        rows.append(f"(lr * {row[0]}::DOUBLE + lg * {row[1]}::DOUBLE + lb * {row[2]}::DOUBLE) / {white}::DOUBLE AS {name}")
    return ", ".join(rows)


_F = "CASE WHEN {t} > 216.0::DOUBLE / 24389 THEN cbrt({t}) ELSE ({t} * (24389.0::DOUBLE / 27) + 16.0) / 116.0 END"


@query(f"""
WITH c AS (SELECT *, {_LIN.format(c='r')} AS lr, {_LIN.format(c='g')} AS lg, {_LIN.format(c='b')} AS lb FROM ({_RGB})), t AS (SELECT *, {_xyz_sql()} FROM c),
 f AS (SELECT *, {_F.format(t='x')} AS fx, {_F.format(t='y')} AS fy, {_F.format(t='z')} AS fz FROM t), l AS (SELECT *, fy * 116.0 - 16.0 AS ll, (fx - fy) * 500.0 AS aa, (fy - fz) * 200.0 AS bb FROM f)
SELECT p_partkey, printf('#%02X%02X%02X', r, g, b) AS color_hex, round(ll, 6) AS l, round(aa, 6) AS a, round(bb, 6) AS b, round(sqrt(aa * aa + bb * bb), 6) AS chroma, sqrt(aa * aa + bb * bb) >= 15 AS vivid FROM l""")
def srgb_lab_lch(spark: SparkSession, d: str) -> DataFrame:
    """M-2, M-3, ST-20: colours from key arithmetic as hex, Lab and chroma."""
    k = F.col("p_partkey")
    rgb = [(k * m % 256).cast("int") for m in (37, 91, 53)]
    lab = table(spark, d, "part").select("p_partkey", color.rgb_hex(*rgb).alias("color_hex"), color.srgb_to_lab(*rgb).alias("lab"))
    c = color.chroma(F.col("lab.a"), F.col("lab.b"))
    return lab.select("p_partkey", "color_hex", *(F.round(f"lab.{x}", 6).alias(x) for x in "lab"), F.round(c, 6).alias("chroma"), (c >= 15).alias("vivid"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'missing_color_payload' WHEN p_partkey % 7 = 0 OR p_partkey % 13 = 0 THEN 'invalid_color_payload' END AS problem FROM part""")
def color_integrity(spark: SparkSession, d: str) -> DataFrame:
    """M-11: stored colours with planted faults."""
    k = F.col("p_partkey")
    rgb = [(k * m % 256).cast("int") for m in (37, 91, 53)]
    lab = color.srgb_to_lab(*rgb)
    stored = F.array(lab["l"] + F.when(k % 7 == 0, 0.001).otherwise(0.0), lab["a"], lab["b"])
    shown = F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, "#12345G").otherwise(color.rgb_hex(*rgb))
    return table(spark, d, "part").select("p_partkey", color.color_payload_problem(shown, F.array(*rgb), stored).alias("problem"))


_NEAR = """WITH h AS MATERIALIZED (SELECT doc_id, xor(xor(CAST('0x' || substr(sha256((doc_id // 6)::VARCHAR), 1, 15) AS BIGINT), 1::BIGINT << (doc_id % 3 * 7)), 1::BIGINT << (doc_id % 5 * 11 + 2)) AS bits FROM documents)
SELECT a.doc_id AS left_id, b.doc_id AS right_id, bit_count(xor(a.bits, b.bits))::INT AS distance FROM h a JOIN h b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.bits, b.bits)) <= 8"""


def _near_hashes(spark: SparkSession, d: str) -> DataFrame:
    """A 60-bit hash for each document: that of its block of six ids, with one or two bits turned."""
    k = F.col("doc_id")
    base = F.conv(F.substring(F.sha2(F.floor(k / 6).cast("string").cast("binary"), 256), 1, 15), 16, 10).cast("bigint")
    turn = lambda n: F.expr(f"shiftleft(1L, cast({n} AS int))")
    return table(spark, d, "documents").select("doc_id", base.bitwiseXOR(turn("doc_id % 3 * 7")).bitwiseXOR(turn("doc_id % 5 * 11 + 2")).alias("bits"))


@query(f"SELECT *, CASE WHEN distance <= 4 THEN 'high' WHEN distance <= 8 THEN 'possible' ELSE 'outside_current_threshold' END AS duplicate_class FROM ({_NEAR})")
def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    """J-17, M-12: hashes that differ in at most 8 bits."""
    found = duplicates.hamming_pairs(_near_hashes(spark, d), "doc_id", "bits", 8)
    return found.withColumn("duplicate_class", duplicates.duplicate_class(F.col("distance")))


@query(f"""
WITH RECURSIVE n AS MATERIALIZED ({_NEAR}), e AS MATERIALIZED (SELECT left_id AS u, right_id AS v FROM n WHERE distance <= 3 UNION SELECT right_id, left_id FROM n WHERE distance <= 3),
 r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.doc_id WHERE r.root < e.v)
SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1""")
def dup_components(spark: SparkSession, d: str) -> DataFrame:
    """A-15: components over the closest pairs, in chains."""
    near = duplicates.hamming_edges(_near_hashes(spark, d), "doc_id", "bits", 3)
    return duplicates.content_groups(table(spark, d, "documents"), "doc_id", near)


_BOXES = "SELECT conv_id, turn, role, (turn * 40 + length(text) % 30)::DOUBLE AS x0, (length(text) % 50)::DOUBLE AS y0, (turn * 40 + length(text) % 30 + 60 + length(text) % 40)::DOUBLE AS x1, (length(text) % 50 + 80)::DOUBLE AS y1 FROM conversations"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    n, t = F.length("text"), F.col("turn")
    x0 = t * 40 + n % 30
    return table(spark, d, "conversations").select("conv_id", "turn", "role", geometry.box(x0, n % 50, x0 + 60 + n % 40, n % 50 + 80).alias("box"), n.alias("n"))


@query(f"""
WITH p AS (SELECT a.conv_id, a.turn AS left_id, b.turn AS right_id, greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0) AS i,
  (a.x1 - a.x0) * (a.y1 - a.y0) AS s, (b.x1 - b.x0) * (b.y1 - b.y0) AS t FROM ({_BOXES}) a JOIN ({_BOXES}) b ON a.conv_id = b.conv_id AND a.turn < b.turn)
SELECT conv_id, left_id, right_id, round(i / (s + t - i), 9) AS iou FROM p WHERE i / (s + t - i) >= 0.2""")
def iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    """G-1, J-18: overlapping boxes of one image."""
    found = merge.overlapping(_boxes(spark, d).withColumnRenamed("turn", "key"), ["conv_id"], "key", 0.2)
    return found.withColumn("iou", F.round("iou", 9))


@query()
def greedy_merge(spark: SparkSession, d: str) -> DataFrame:
    """A-14: turns of one conversation as tile observations of one image, merged in order."""
    boxes = _boxes(spark, d)
    rows = boxes.select(F.col("conv_id").cast("string").alias("image_id"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("unit_id"), F.col("turn").cast("string").alias("item_id"), F.col("role").alias("raw_text"), F.lit("other").alias("text_type"), "box", (F.col("n") % 97 / 97.0).alias("confidence"))
    found = merge.merge_texts(rows, 0.3, ascii_only=True)
    return found.select("image_id", "position", "normalized_text", F.round("confidence", 9).alias("confidence"), F.size("sources").alias("source_count"))


_TILES = "SELECT doc_id, n_chars, CASE WHEN n_chars <= 2048 THEN [0::BIGINT] ELSE list_distinct(list_concat(range(0, n_chars - 2048 + 1, 1536), [n_chars - 2048])) END AS starts FROM documents"


@query(f"SELECT doc_id, s AS tile_start, least(s + 2048, n_chars) AS tile_end FROM (SELECT doc_id, n_chars, unnest(starts) AS s FROM ({_TILES}))")
def tile_expand(spark: SparkSession, d: str) -> DataFrame:
    """G-6: tiles of 2048 with an overlap of 512 over every length."""
    rows = table(spark, d, "documents").select("doc_id", "n_chars", F.explode(geometry.tile_starts(F.col("n_chars"), 2048, 512)).alias("tile_start"))
    return rows.select("doc_id", "tile_start", F.least(F.col("tile_start") + 2048, F.col("n_chars")).alias("tile_end"))


@query(f"""
WITH t AS (SELECT doc_id, s, least(s + 2048, n_chars) AS e FROM (SELECT doc_id, n_chars, unnest(starts) AS s FROM ({_TILES})))
SELECT doc_id, s AS tile_start, coalesce(lag(e) OVER w - s, 0) AS overlap_before, coalesce(e - lead(s) OVER w, 0) AS overlap_after FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY s)""")
def tile_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """W-6, G-7: how far each tile reaches into its neighbours, from the tiles of the document itself."""
    # A document's tiles come from one row, so their neighbours are found within its array instead of over a window.
    rows = table(spark, d, "documents").select("doc_id", "n_chars", F.array_sort(geometry.tile_starts(F.col("n_chars"), 2048, 512)).alias("s"))
    each = rows.select("doc_id", "n_chars", "s", F.posexplode("s").alias("k", "tile_start"))
    before, after = F.get("s", F.col("k") - 1), F.get("s", F.col("k") + 1)
    return each.select("doc_id", "tile_start", F.coalesce(before + 2048 - F.col("tile_start"), F.lit(0)).alias("overlap_before"), F.coalesce(F.least(F.col("tile_start") + 2048, F.col("n_chars")) - after, F.lit(0)).alias("overlap_after"))


_B = "SELECT l_orderkey, l_linenumber, l_partkey, (l_partkey % 90)::DOUBLE AS x0, (l_suppkey % 50)::DOUBLE AS y0, (l_partkey % 90 + l_quantity * (1 + l_linenumber % 3))::DOUBLE AS x1, (l_suppkey % 50 + l_quantity * 20)::DOUBLE AS y1 FROM lineitem"


@query(f"""
WITH b AS ({_B}), a AS (SELECT *, CASE WHEN x0 >= x1 OR y0 >= y1 OR least(x0, y0) < 0 THEN 'unchanged' WHEN greatest(x0, y0, x1, y1) <= 1 THEN 'none' WHEN x1 <= 200 AND y1 <= 600 THEN 'pixels'
  WHEN greatest(x0, y0, x1, y1) <= 1000 THEN 'millesimal' ELSE 'unchanged' END AS action FROM b)
SELECT action, count(*) AS n, round(sum(CASE action WHEN 'pixels' THEN x1 / 200 WHEN 'millesimal' THEN x1 / 1000 ELSE 0 END), 4) AS x1_sum FROM a GROUP BY 1""")
def bbox_repair(spark: SparkSession, d: str) -> DataFrame:
    """JS-3: boxes in one of three conventions, repaired where only one reading fits."""
    c = F.col
    box = geometry.box(c("l_partkey") % 90, c("l_suppkey") % 50, c("l_partkey") % 90 + c("l_quantity") * (c("l_linenumber") % 3 + 1), c("l_suppkey") % 50 + c("l_quantity") * 20)
    rows = table(spark, d, "lineitem").select(geometry.repaired_box(box, F.lit(200), F.lit(600)).alias("r"))
    x1 = F.when(c("r.action").isin("pixels", "millesimal"), c("r.box.x1")).otherwise(0.0)
    return rows.groupBy(c("r.action").alias("action")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(x1), 4).alias("x1_sum"))


@query(f"""
WITH b AS (SELECT *, least(greatest(x0 * 2.5 + 10, 0), 400) AS a0, least(greatest(y0 * 0.5 - 5, 0), 300) AS b0, least(greatest(x1 * 2.5 + 10, 0), 400) AS a1, least(greatest(y1 * 0.5 - 5, 0), 300) AS b1 FROM ({_B}))
SELECT l_linenumber, count(*) AS n, count(*) FILTER (a0 < a1 AND b0 < b1) AS kept, round(sum((a1 - a0) * (b1 - b0)) FILTER (a0 < a1 AND b0 < b1), 2) AS area FROM b GROUP BY 1""")
def bbox_map(spark: SparkSession, d: str) -> DataFrame:
    """G-2, G-3: boxes mapped by scale and shift and clamped."""
    c = F.col
    box = geometry.box(c("l_partkey") % 90, c("l_suppkey") % 50, c("l_partkey") % 90 + c("l_quantity") * (c("l_linenumber") % 3 + 1), c("l_suppkey") % 50 + c("l_quantity") * 20)
    rows = table(spark, d, "lineitem").select("l_linenumber", geometry.to_image(box, F.lit(2.5), F.lit(0.5), F.lit(10), F.lit(-5), F.lit(400), F.lit(300)).alias("m"))
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count("m").alias("kept"), F.round(F.sum((c("m.x1") - c("m.x0")) * (c("m.y1") - c("m.y0"))), 2).alias("area"))


_RANK = "sha256('260' || chr(0) || {label} || chr(0) || doc_id)"


@query(f"SELECT doc_id, lang FROM documents ORDER BY {_RANK.format(label=chr(39) + 'pilot' + chr(39))}, doc_id LIMIT 64")
def stable_rank_sample(spark: SparkSession, d: str) -> DataFrame:
    """O-4, O-3: the first 64 in hash order."""
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return docs.orderBy(ids.stable_rank(SEED, "pilot", F.col("doc_id")), "doc_id").limit(64)


@query(f"SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_RANK.format(label=chr(39) + 'quota' + chr(39))}, doc_id) <= CASE lang WHEN 'en' THEN 15 WHEN 'fr' THEN 10 WHEN 'de' THEN 8 ELSE 7 END")
def quota_sample(spark: SparkSession, d: str) -> DataFrame:
    """O-5, O-7: 15, 10, 8 and 7 of four strata in hash order."""
    return sampling.by_quota(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang", {"en": 15, "fr": 10, "de": 8, "es": 7}, SEED, "quota")


def _rank_sql(label: str) -> str:
    return f"sha256('{SEED}' || chr(0) || '{label}' || chr(0) || doc_id)"


def _capped_sql(strata: dict[str, int], caps: dict[str, int]) -> str:
    pct = f"CAST('0x' || substr(sha256('{SEED}' || chr(0) || doc_id), 1, 8) AS BIGINT) % 100"
    ctes = [f"d AS (SELECT doc_id, lang, source, CASE WHEN {pct} < 60 THEN 'train' WHEN {pct} < 80 THEN 'validation' ELSE 'test' END AS split FROM documents)"]
    done: list[str] = []
    for name, quota in strata.items():
        used = " UNION ALL ".join(f"SELECT split FROM {t}" for t in done) or "SELECT NULL AS split WHERE false"
        cap = "CASE split " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in caps.items()) + " END"
        left = f"{cap} - (SELECT count(*) FROM ({used}) u WHERE u.split = r.split)"
        ctes.append(f"r_{name} AS (SELECT *, {_rank_sql(name)} AS h, row_number() OVER (PARTITION BY split ORDER BY {_rank_sql(name)}, doc_id) AS k FROM d WHERE lang = '{name}')")
        ctes.append(f"t_{name} AS (SELECT doc_id, lang, source, split FROM r_{name} r WHERE k <= {left} ORDER BY h, doc_id LIMIT {quota})")
        done.append(f"t_{name}")
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT * FROM {t}" for t in done)


def _sequential_sql(quotas: dict[str, int], target: int) -> str:
    ctes = ["d AS (SELECT doc_id, [lang, CASE WHEN n_chars > 8000 THEN 'long' END] AS tags FROM documents)"]
    done: list[str] = []
    for name, quota in quotas.items():
        used = " UNION ALL ".join(f"SELECT doc_id FROM t_{t}" for t in done) or "SELECT NULL AS doc_id WHERE false"
        ctes.append(f"t_{name} AS (SELECT doc_id, '{name}' AS stratum FROM d WHERE list_contains(tags, '{name}') AND NOT EXISTS (SELECT 1 FROM ({used}) u WHERE u.doc_id = d.doc_id) ORDER BY {_rank_sql(name)}, doc_id LIMIT {quota})")
        done.append(name)
    every = " UNION ALL ".join(f"SELECT * FROM t_{t}" for t in done)
    fill = f"SELECT doc_id, 'fill' AS stratum FROM d WHERE doc_id NOT IN (SELECT doc_id FROM s) ORDER BY {_rank_sql('fill')}, doc_id LIMIT greatest(0, {target} - (SELECT count(*) FROM s))"
    return "WITH " + ", ".join(ctes) + f", s AS ({every}) SELECT * FROM s UNION ALL SELECT * FROM ({fill})"


@query(_capped_sql({"en": 40, "fr": 20, "de": 20}, {"train": 48, "validation": 16, "test": 16}))
def quota_split_sample(spark: SparkSession, d: str) -> DataFrame:
    """O-6: quotas by language with caps by split over all of them."""
    docs = sampling.with_split(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", SEED)
    return sampling.with_split_caps(docs, "doc_id", {"en": 40, "fr": 20, "de": 20}, "lang", {"train": 48, "validation": 16, "test": 16}, "split", SEED)


@query(_sequential_sql({"long": 12, "es": 8, "de": 8, "fr": 8, "en": 16}, 64))
def sequential_quota_sample(spark: SparkSession, d: str) -> DataFrame:
    """O-5: tags in order, each row once, filled up to 64."""
    docs = table(spark, d, "documents").select("doc_id", F.array_compact(F.array("lang", F.when(F.col("n_chars") > 8000, "long"))).alias("tags"))
    return sampling.sequential_quota(docs, "doc_id", "tags", {"long": 12, "es": 8, "de": 8, "fr": 8, "en": 16}, 64, SEED).select("doc_id", "stratum")


_PCT = "CAST('0x' || substr(sha256('260' || chr(0) || source), 1, 8) AS BIGINT) % 100"


@query(f"SELECT doc_id, source, CASE WHEN {_PCT} < 60 THEN 'train' WHEN {_PCT} < 80 THEN 'validation' ELSE 'test' END AS split FROM documents")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    """O-10: a split that is the same for all rows of a source."""
    return sampling.with_split(table(spark, d, "documents").select("doc_id", "source"), "source", SEED)


@query("SELECT sha AS text_sha, count(DISTINCT split) AS split_count FROM (SELECT sha256(text) AS sha, CASE WHEN doc_id % 10 < 6 THEN 'train' ELSE 'test' END AS split FROM documents) GROUP BY 1 HAVING count(DISTINCT split) > 1")
def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    """A-23: texts that a split by id would let leak."""
    docs = table(spark, d, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha"), F.when(F.col("doc_id") % 10 < 6, "train").otherwise("test").alias("split"))
    return sampling.leaking_groups(docs, "text_sha")


@query("""
WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders), k AS (SELECT DISTINCT CAST(round_even(j * (n - 1) / 99.0, 0) AS BIGINT) AS i FROM (SELECT unnest(range(100)) AS j), (SELECT count(*) AS n FROM orders))
SELECT o_orderkey FROM n JOIN k USING (i)""")
def even_sample(spark: SparkSession, d: str) -> DataFrame:
    """O-9: 100 references at equal distances."""
    return sampling.evenly(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 100)


_UUID = "sha1(unhex('01b2a690e5b74a3ca5b13d57437da9ec') || encode(doc_id || chr(31) || source))"


@query(f"SELECT doc_id, 'doc_' || substr(h, 1, 12) || '5' || substr(h, 14, 3) || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INT) % 4 + 1, 1) || substr(h, 18, 15) AS stable_id FROM (SELECT doc_id, {_UUID} AS h FROM documents)")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    """ST-1."""
    return table(spark, d, "documents").select("doc_id", ids.stable_id("doc", ids.NAMESPACE, F.col("doc_id"), F.col("source")).alias("stable_id"))


@query("""SELECT conv_id, sha256('{"role":"' || role || '","turn":' || turn || '}') AS cache_key, count(*) AS n FROM conversations GROUP BY 1, 2""")
def cache_keys(spark: SparkSession, d: str) -> DataFrame:
    """ST-2, ST-19: digests of canonical JSON."""
    return table(spark, d, "conversations").groupBy("conv_id", ids.cache_key(turn=F.col("turn"), role=F.col("role")).alias("cache_key")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey, regexp_extract(p_brand, '#([0-9]+)', 1) AS token, 1 AS token_count FROM part")
def shade_tokens(spark: SparkSession, d: str) -> DataFrame:
    """ST-6: codes in brand labels like 'Brand#17'; the '#' is no letter, so the number stands alone."""
    tokens = text.shade_tokens(F.regexp_replace("p_brand", "#", " #"), ascii_only=True)
    return table(spark, d, "part").select("p_partkey", F.get(tokens, F.lit(0)).alias("token"), F.size(tokens).alias("token_count"))


@query("""
WITH c AS (SELECT DISTINCT l_suppkey % 50 AS image_id, CAST(l_quantity AS INT)::VARCHAR AS code FROM lineitem WHERE l_linenumber = 1),
 r AS (SELECT p_partkey % 50 AS image_id, p_partkey AS record_id, 'sku' || (p_partkey % 3) AS sku, regexp_extract(p_brand, '#([0-9]+)', 1) AS code FROM part),
 f AS (SELECT image_id, code, count(DISTINCT sku) AS n, min(sku) AS sku, min(record_id) AS record_id FROM r GROUP BY 1, 2)
SELECT c.image_id, c.code, CASE WHEN n = 1 THEN 'business_resolved' WHEN n > 1 THEN 'image_local_ambiguous' ELSE 'image_local_unmatched' END AS identity_status, CASE WHEN n = 1 THEN f.sku END AS sku, CASE WHEN n = 1 THEN f.record_id END AS record_id
FROM c LEFT JOIN f ON c.image_id = f.image_id AND c.code = f.code""")
def token_entity_resolve(spark: SparkSession, d: str) -> DataFrame:
    """J-20: codes of images against the colour labels of their products."""
    codes = table(spark, d, "lineitem").where("l_linenumber = 1").select((F.col("l_suppkey") % 50).alias("image_id"), F.col("l_quantity").cast("int").cast("string").alias("code")).distinct()
    k = F.col("p_partkey")
    records = table(spark, d, "part").select((k % 50).alias("image_id"), k.alias("record_id"), F.concat(F.lit("sku"), (k % 3).cast("string")).alias("sku"), F.regexp_replace("p_brand", "Brand", "shade ").alias("color_text"))
    return entities.resolve_codes(codes, records, ascii_only=True)


@query("""
WITH c AS (SELECT DISTINCT l_suppkey % 50 AS image_id, CAST(l_quantity AS INT)::VARCHAR AS code FROM lineitem),
 r AS (SELECT p_partkey % 50 AS image_id, p_partkey AS record_id, 'sku' || (p_partkey % 3) AS sku, regexp_extract(p_brand, '#([0-9]+)', 1) AS code FROM part),
 f AS (SELECT image_id, code, count(DISTINCT sku) AS n, min(sku) AS sku, min(record_id) AS record_id FROM r GROUP BY 1, 2)
SELECT c.image_id, c.code, CASE WHEN n = 1 THEN 'business_resolved' WHEN n > 1 THEN 'image_local_ambiguous' ELSE 'image_local_unmatched' END AS identity_status, CASE WHEN n = 1 THEN f.sku END AS sku, CASE WHEN n = 1 THEN f.record_id END AS record_id
FROM c LEFT JOIN f ON c.image_id = f.image_id AND c.code = f.code""")
def token_entity_resolve_all(spark: SparkSession, d: str) -> DataFrame:
    """J-20 on all lines: codes of images against the colour labels of their products."""
    codes = table(spark, d, "lineitem").select((F.col("l_suppkey") % 50).alias("image_id"), F.col("l_quantity").cast("int").cast("string").alias("code")).distinct()
    k = F.col("p_partkey")
    records = table(spark, d, "part").select((k % 50).alias("image_id"), k.alias("record_id"), F.concat(F.lit("sku"), (k % 3).cast("string")).alias("sku"), F.regexp_replace("p_brand", "Brand", "shade ").alias("color_text"))
    return entities.resolve_codes(codes, records, ascii_only=True)


@query("""
WITH a AS (SELECT l_orderkey AS image_id, list(DISTINCT (l_partkey % 12)::VARCHAR) AS context, list(DISTINCT (l_suppkey % 12)::VARCHAR) FILTER (l_quantity > 25) AS depicted, max(l_quantity) < 49 AS role_valid, count(*) > 4 AS multi FROM lineitem WHERE l_partkey % 9 <> 0 GROUP BY 1),
 s AS (SELECT image_id, context, coalesce(depicted, []) AS depicted, role_valid, multi, len(list_intersect(context, coalesce(depicted, []))) AS overlap FROM a)
SELECT image_id, CASE WHEN NOT role_valid THEN 'unrelated' WHEN len(context) = 0 THEN 'insufficient_evidence' WHEN len(depicted) = 0 THEN 'same_product_unspecified_shade' WHEN overlap > 0 AND (multi OR len(depicted) > 1) THEN 'contains_context_shade' WHEN overlap > 0 THEN 'exact_shade_match' ELSE 'shade_conflict' END AS relation,
 CASE WHEN NOT role_valid THEN 0.75 WHEN len(context) = 0 THEN 0.35 WHEN len(depicted) = 0 THEN 0.55 WHEN overlap > 0 AND (multi OR len(depicted) > 1) THEN 0.85 WHEN overlap > 0 THEN 0.9 ELSE 0.65 END::DOUBLE AS confidence,
 role_valid AND (len(context) = 0 OR (len(depicted) > 0 AND overlap = 0)) AS conflict, overlap::INT AS overlap_count FROM s""")
def context_relation(spark: SparkSession, d: str) -> DataFrame:
    """P-13, J-21, ST-8: shades of an image against those of its product."""
    c = F.col
    rows = table(spark, d, "lineitem").where("l_partkey % 9 <> 0").groupBy(c("l_orderkey").alias("image_id")).agg(F.collect_set((c("l_partkey") % 12).cast("string")).alias("context"), F.collect_set(F.when(c("l_quantity") > 25, (c("l_suppkey") % 12).cast("string"))).alias("depicted"), (F.max("l_quantity") < 49).alias("ok"), (F.count(F.lit(1)) > 4).alias("multi"))
    r = entities.context_relation(c("ok"), c("context"), c("depicted"), c("multi"))
    return rows.select("image_id", r.alias("r")).select("image_id", "r.relation", "r.confidence", "r.conflict", F.size("r.overlap").alias("overlap_count"))


@query("SELECT conv_id, turn, trim(regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '\\s+', ' ', 'g')) AS normalized FROM conversations WHERE regexp_full_match(text, '[\\x00-\\x7F]*')")
def text_normalize(spark: SparkSession, d: str) -> DataFrame:
    """ST-4 on the turns that are ASCII, where it needs no Unicode tables."""
    rows = table(spark, d, "conversations").where(F.col("text").rlike(r"^[\x00-\x7F]*\z"))
    return rows.select("conv_id", "turn", text.visible_text(F.col("text"), ascii_only=True).alias("normalized"))


@query()
def text_normalize_all(spark: SparkSession, d: str) -> DataFrame:
    """ST-4 on all turns, with NFKC, which SQL has not."""
    return table(spark, d, "conversations").select("conv_id", "turn", text.visible_text(F.col("text")).alias("normalized"))


@query("""SELECT page_id, 'page_' || lpad((page_id % 1000)::VARCHAR, 3, '0') || '_' || substr(sha1(url), 1, 12) || '.' || coalesce(nullif(regexp_extract(lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)), '[^/.][^/]*\\.([a-z0-9]{1,8})$', 1), ''), 'jpg') AS file_name FROM pages""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    """ST-12: file names of URLs."""
    return table(spark, d, "pages").select("page_id", text.output_filename(F.lit("page"), F.col("page_id") % 1000, F.col("url")).alias("file_name"))


_GENERIC = """(?i)\\b(?:api[_-]?key|access[_-]?key|secret|token|authorization)\\b\\s*[:=]\\s*["'']([A-Za-z0-9_./+=:-]{20,})["'']"""


@query(f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_number FROM documents)
SELECT doc_id, line_number::INT AS line_number, CASE WHEN regexp_matches(line, '\\bsk-(?:ws-)?[A-Za-z0-9_-]{{20,}}\\b') THEN 'dashscope_api_key' WHEN regexp_matches(line, '\\bLTAI[A-Za-z0-9]{{12,}}\\b') THEN 'alibaba_access_key_id' ELSE 'generic_secret_assignment' END AS rule
FROM l WHERE regexp_matches(line, '\\bsk-(?:ws-)?[A-Za-z0-9_-]{{20,}}\\b') OR regexp_matches(line, '\\bLTAI[A-Za-z0-9]{{12,}}\\b') OR regexp_matches(line, '{_GENERIC}')""")
def secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """ST-14: lines with secrets and the rule that found each; values are not returned."""
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    return lines.select("doc_id", (F.col("k") + 1).alias("line_number"), text.secret_rule(F.col("line")).alias("rule")).where("rule IS NOT NULL")


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2 ORDER BY source, n DESC, lang")
def ordered_report(spark: SparkSession, d: str) -> DataFrame:
    """O-1, O-2."""
    return table(spark, d, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.lower("source"), F.desc("n"), "lang")


@query("""
SELECT page_id, CASE page_id % 5 WHEN 2 THEN 'repaired' WHEN 3 THEN 'schema_failed' WHEN 4 THEN 'schema_failed' ELSE 'succeeded' END AS status,
 CASE page_id % 5 WHEN 2 THEN 'text_items[0]:millesimal_to_normalized' ELSE '' END AS actions, CASE page_id % 5 WHEN 3 THEN 'role' WHEN 4 THEN 'not_json' ELSE '' END AS problems FROM pages""")
def response_contract(spark: SparkSession, d: str) -> DataFrame:
    """JS-1 to JS-7: responses with planted faults, read strictly or after a narrow repair."""
    k = F.col("page_id")
    bbox = F.when(k % 5 == 2, F.lit("[10, 20, 900, 950]")).otherwise(F.lit("[0.1, 0.2, 0.9, 0.95]"))
    head = f'{{"schema_version":"{extraction.SCHEMA_VERSION}","scope":"image","input_context_policy":"{extraction.CONTEXT_POLICY}","primary_role":"'
    middle = '","role_confidence":0.9,"layout_type":"grid","layout_summary":"","representative_color_eligible":true,"eligibility_confidence":0.5,"summary":"s","text_items":[{"text_item_id":"t1","text":"12","text_type":"shade_code","bbox_norm":'
    body = F.concat(F.lit(head), F.when(k % 5 == 3, "poster").otherwise("single_swatch"), F.lit(middle), bbox, F.lit(',"confidence":0.8}],"color_regions":[]}'))
    raw = F.when(k % 5 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k % 5 == 4, "no answer").otherwise(body)
    rows = table(spark, d, "pages").select("page_id", raw.alias("raw"), F.lit(100).alias("width"), F.lit(80).alias("height"))
    done = extraction.strict_or_repaired(rows, "raw", "width", "height")
    return done.select("page_id", "status", F.array_join("repair_actions", ",").alias("actions"), F.array_join("problems", ",").alias("problems"))
