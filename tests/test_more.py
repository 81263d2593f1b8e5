import datetime
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tintwell.functions import color, geometry, ids, text
from tintwell.operators import entities, evaluation, relational
from tintwell.sources import readers


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_paths(spark):
    assert one(spark, text.relative_path(F.lit("\\a\\b/c.jpg/"))) == "a/b/c.jpg"
    assert one(spark, text.path_brand(F.lit("a/b/c.jpg"))) == "a" and one(spark, text.path_product(F.lit("a/b/c.jpg"))) == "b"
    assert one(spark, text.path_brand(F.lit("b/c.jpg"))) is None
    assert one(spark, text.repo_uri(F.lit("/data/x/y.png"), "/data")) == "repo://x/y.png"
    assert one(spark, text.resolve_uri(F.lit("repo://x/y.png"), "/data/")) == "/data/x/y.png"
    sha = "f" * 64
    assert one(spark, ids.path_image_id(F.lit(sha), F.lit("a/b"))) == "f" * 16 + "-" + hashlib.sha1(b"a/b").hexdigest()[:10]


def test_shapes(spark):
    points = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (5, 0), (5, 5))))
    assert one(spark, geometry.polygon_is_valid(points, F.lit(5), F.lit(5))) and not one(spark, geometry.polygon_is_valid(points, F.lit(4), F.lit(5)))
    box = F.struct(*(F.lit(v).alias(k) for k, v in (("x0", 0.1), ("y0", 0.1), ("x1", 0.2), ("y1", 0.2))))
    assert one(spark, geometry.box_is_valid(box))
    p = one(spark, geometry.affine(F.array(*(F.array(*map(F.lit, row)) for row in ((2.0, 0.0, 1.0), (0.0, 3.0, -1.0), (0.0, 0.0, 1.0)))), F.lit(4.0), F.lit(5.0)))
    assert tuple(p) == (9.0, 14.0)
    flags = one(spark, geometry.image_flags(F.lit(700), F.lit(3000)))
    assert (flags.invalid, flags.long, flags.extreme, flags.too_large) == (False, True, False, False)


def test_tiers_and_hue(spark):
    assert one(spark, color.lower_quality(F.lit("high"), F.lit("medium"))) == "medium"
    assert one(spark, color.hue_difference(F.lit(350.0), F.lit(20.0))) == 30.0
    assert one(spark, color.similarity_score(F.lit(10.0))) == 50.0


def test_preferred_assets(spark):
    rows = [("i", "image", None, "preview", 2, "a"), ("i", "image", None, "padded_preview", 1, "b"), ("i", "tile", 0, "preview", 1, "c"), ("i", "tile", 0, "preview", 3, "d")]
    df = spark.createDataFrame(rows, "image_id string, scope string, tile_index int, asset_type string, created_at int, asset_id string")
    assert sorted(r.asset_id for r in entities.preferred_assets(df).collect()) == ["b", "d"]


def test_agreement_and_macro(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "b")], "x string, y string")
    r = evaluation.agreement(df, "x", "y").first()
    assert (r.total, r.equal, r.cells) == (3, 2, {"a|a": 1, "a|b": 1, "b|b": 1})
    macro = evaluation.macro_f1(evaluation.class_metrics(evaluation.confusion(df.where("x IS NOT NULL"), "x", "y"))).first()
    assert macro.class_count == 2 and macro.macro_f1 == pytest.approx(2 / 3)


def test_legacy_readers(spark, tmp_path):
    (tmp_path / "m.csv").write_text("relative_path,image_id,sha256\na\\b.jpg,i,s\na/b.jpg,i,s\n")
    assert [tuple(r) for r in readers.legacy_metadata(spark, str(tmp_path / "m.csv")).collect()] == [("a/b.jpg", "i", "s")]
    (tmp_path / "bad.csv").write_text("relative_path,image_id,sha256\na/b.jpg,i,s\na/b.jpg,j,s\n")
    with pytest.raises(ValueError, match="conflicting"):
        readers.legacy_metadata(spark, str(tmp_path / "bad.csv"))
    rows = [{"sha256": "s", "decode_success": True, "has_alpha": False, "width": 700, "height": 3000}, {"sha256": "s", "decode_success": False, "has_alpha": True, "width": 700, "height": 3000}]
    (tmp_path / "f.jsonl").write_text("\n".join(map(json.dumps, rows)))
    r = readers.legacy_features(spark, str(tmp_path / "f.jsonl")).first()
    assert (r.decode_success, r.has_alpha, r.is_long) == (True, True, True)


def test_upserts(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "d"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, relational.insert_if_absent(old, new, ["k"], ["v"]).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(map(tuple, relational.replace_by_key(old, new, ["k"]).collect())) == [(1, "a"), (2, "z"), (3, "c"), (3, "d")]
    matched = relational.exact_then_folded(spark.createDataFrame([("A/b",), ("a/B",), ("x",)], "p string"), spark.createDataFrame([("A/b", "1"), ("c", "2")], "path string, id string"), "p", "path", "id")
    assert {r.p: (r.matched_id, r.match_confidence) for r in matched.collect()} == {"A/b": ("1", 1.0), "a/B": ("1", 0.99), "x": (None, None)}


def test_exactly_one_selector(spark):
    df = spark.createDataFrame([(1, "a/x"), (2, "b/y")], "k int, p string")
    for how in ({}, {"one": 1, "limit": 2}):
        with pytest.raises(ValueError, match="exactly one"):
            relational.selected(df, "k", "p", **how)
    assert [r.k for r in relational.selected(df, "k", "p", folder="b").collect()] == [2]


def test_utc_now(spark):
    seen = datetime.datetime.fromisoformat(spark.range(1).select(ids.utc_now()).first()[0])
    assert abs((datetime.datetime.now(datetime.UTC) - seen).total_seconds()) < 120


def test_a_repeated_path_matches_once(spark):
    left = spark.createDataFrame([("A/b",)], "p string")
    right = spark.createDataFrame([("A/b", "2"), ("A/b", "1")], "path string, id string")
    assert [tuple(r) for r in relational.exact_then_folded(left, right, "p", "path", "id").collect()] == [("A/b", "1", "downloader_exact_path", 1.0)]
