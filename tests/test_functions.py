import hashlib
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tintwell.functions import color, geometry, ids, text
from tintwell.plans.colour_queries import CIEDE2000_PAIRS


def test_ciede2000_is_symmetric_and_zero_on_itself(spark):
    rng = random.Random(5)
    rows = [tuple(rng.uniform(0, 100) if k % 3 == 0 else rng.uniform(-90, 90) for k in range(6)) for _ in range(200)]
    df = spark.createDataFrame(rows, "l1 double, a1 double, b1 double, l2 double, a2 double, b2 double")
    there = color.with_ciede2000(df, "l1", "a1", "b1", "l2", "a2", "b2", "x")
    both = color.with_ciede2000(there, "l2", "a2", "b2", "l1", "a1", "b1", "y")
    same = color.with_ciede2000(both, "l1", "a1", "b1", "l1", "a1", "b1", "z")
    for r in same.collect():
        assert abs(r.x - r.y) < 1e-9 and r.z == 0


def test_published_pairs(spark):
    df = spark.createDataFrame(CIEDE2000_PAIRS, "l1 double, a1 double, b1 double, l2 double, a2 double, b2 double, want double")
    got = color.with_ciede2000(df, "l1", "a1", "b1", "l2", "a2", "b2").collect()
    assert len(got) == 34 and all(abs(r.delta_e00 - r.want) <= 1e-4 for r in got)


def test_hex_and_bands(spark):
    r = spark.range(1).select(color.normalized_hex(F.lit(" #c81e46 ")).alias("h"), color.normalized_hex(F.lit("12345")).alias("bad"), *(color.distance_band(F.lit(v)).alias(f"b{i}") for i, v in enumerate((2.0, 2.1, 10.0, 20.0, 20.1)))).first()
    assert r.h == "#C81E46" and r.bad is None
    assert [r[f"b{i}"] for i in range(5)] == ["de00_le_2", "de00_gt_2_le_5", "de00_gt_5_le_10", "de00_gt_10_le_20", "de00_gt_20"]


def test_stable_id_is_uuid5(spark):
    ns = uuid.NAMESPACE_URL
    rows = [(i, f"n{i}", None if i % 3 else "é") for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b string, c string").select("a", "b", "c", ids.stable_id("x", ns, F.col("a"), F.col("b"), F.col("c")).alias("id"))
    for r in df.collect():
        assert r.id == "x_" + uuid.uuid5(ns, "\x1f".join(map(str, (r.a, r.b, r.c)))).hex


def test_rank_and_split(spark):
    r = spark.createDataFrame([("g1",), ("g2",)], "g string").select("g", ids.stable_rank(7, "lab", F.col("g")).alias("r"), ids.hash_percent(7, F.col("g")).alias("p")).collect()
    for x in r:
        assert x.r == hashlib.sha256(f"7\0lab\0{x.g}".encode()).hexdigest()
        assert x.p == int(hashlib.sha256(f"7\0{x.g}".encode()).hexdigest()[:8], 16) % 100


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_visible_text(spark):
    assert _one(spark, text.visible_text(F.lit(" ａｂｃ\t é  Ⅻ "))) == "ABC é XII"
    assert _one(spark, text.ocr_text(F.lit("Straße - 12_A"))) == "strasse12a"


def test_shade_tokens(spark):
    assert _one(spark, text.shade_tokens(F.lit("#12 A07-b rose 12"))) == ["12", "A07-B"]
    assert _one(spark, text.shade_tokens(F.lit(None).cast("string"))) == []


def test_context_shades_dedup(spark):
    got = _one(spark, text.context_shades(F.lit("30ml"), F.lit("M 12"), F.lit("m-12"), F.lit("x" * 30 + " 405")))
    assert got[0] == "M 12" and "m-12" not in got and got[-1] == "405" and "30ml" not in got


def test_components_and_urls(spark):
    assert _one(spark, text.safe_component(F.lit(' a<b>:c  d. '), "none")) == "a_b__c d"
    assert _one(spark, text.safe_component(F.lit("con.txt"), "none")) == "_con.txt"
    assert _one(spark, text.safe_component(F.lit("..."), "none")) == "none"
    long = "x" * 300
    assert _one(spark, text.safe_component(F.lit(long), "none")) == "x" * 109 + "_" + hashlib.sha1(long.encode()).hexdigest()[:10]
    df = spark.createDataFrame([('["u1", " u2 "]',), ("['a', None]",), ('[{"url": "x"}, {"src": "y"}]',), ("null",), ('"one"',), ("oops(",)], "raw string")
    assert [r.v for r in df.select(text.image_urls("raw").alias("v")).collect()] == [["u1", "u2"], ["a"], ["x", "y"], [], ["one"], None]
    assert _one(spark, text.url_extension(F.lit("https://h/x/Y.PNG?q=1.gif"))) == "png"
    assert _one(spark, text.url_extension(F.lit("https://h/x/y"))) == "jpg"
    assert _one(spark, text.url_extension(F.lit("https://h/x/.png"))) == "jpg"
    assert _one(spark, text.url_extension(F.lit("https://h/x.d/y.WebP2"))) == "webp2"


def test_secrets(spark):
    key = "Z" * 24
    lines = [f'token = "{key}"', 'token = "your_example_placeholder_key"', "sk-" + "a" * 30, "nothing"]
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    assert [r.v for r in df.select(text.secret_rule(F.col("line")).alias("v")).collect()] == ["generic_secret_assignment", None, "dashscope_api_key", None]
    assert key not in _one(spark, text.redacted(F.lit(lines[0])))


def test_code_fence(spark):
    assert _one(spark, text.without_code_fence(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert _one(spark, text.without_code_fence(F.lit(" {} "))) == "{}"


def _box(*v):
    return F.struct(*(F.lit(float(x)).alias(k) for x, k in zip(v, ("x0", "y0", "x1", "y1"), strict=True)))


def test_iou(spark):
    assert _one(spark, geometry.iou(_box(0, 0, 10, 10), _box(5, 0, 15, 10))) == pytest.approx(1 / 3)
    assert _one(spark, geometry.iou(_box(0, 0, 0, 0), _box(0, 0, 0, 0))) == 0


@pytest.mark.parametrize(("length", "starts"), [(320, [0, 96, 192]), (128, [0]), (60, [0]), (225, [0, 96, 97])])
def test_tiles(spark, length, starts):
    assert _one(spark, geometry.tile_starts(F.lit(length), 128, 32)) == starts


def test_repair(spark):
    assert _one(spark, geometry.repaired_box(_box(10, 20, 900, 950), F.lit(100), F.lit(80))).action == "millesimal"
    assert _one(spark, geometry.repaired_box(_box(10, 20, 1900, 1950), F.lit(2000), F.lit(2000))).action == "pixels"
    assert _one(spark, geometry.repaired_box(_box(10, 20, 90, 70), F.lit(100), F.lit(80))).action == "pixels"
    assert _one(spark, geometry.repaired_box(_box(0.1, 0.2, 0.3, 0.4), F.lit(100), F.lit(80))).action == "none"


def test_orientation_keeps_corners_inside(spark):
    for code in range(1, 9):
        p = _one(spark, geometry.oriented(F.lit(code), F.lit(0), F.lit(0), F.lit(40), F.lit(20)))
        w, h = (40, 20) if code <= 4 else (20, 40)
        assert p.x in (0, w if code <= 4 else 20, 40, 20) and p.y in (0, h, 20, 40)
    assert tuple(_one(spark, geometry.oriented(F.lit(6), F.lit(0), F.lit(0), F.lit(40), F.lit(20)))) == (20, 0)


def test_shrunken_and_preview(spark):
    b = _one(spark, geometry.shrunken(_box(0, 0, 80, 80), F.lit(80), F.lit(80), 0.03))
    assert tuple(b) == (math.floor(2.4), math.floor(2.4), math.ceil(77.6), math.ceil(77.6))
    assert _one(spark, geometry.shrunken(_box(90, 0, 100, 80), F.lit(80), F.lit(80), 0.03)) is None
    p = _one(spark, geometry.preview(F.lit(60), F.lit(1), 2048))
    assert (p.padded_width, p.padded_height) == (60, 11)
