import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tintwell.operators import checks, duplicates, entities, evaluation, extraction, graph, images, merge, ranking, relational, sampling
from tintwell.plans import similarity_run

TEXTS = "image_id string, unit_id string, item_id string, raw_text string, text_type string, box struct<x0:double,y0:double,x1:double,y1:double>, confidence double"


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(1000, k) for k in range(1001, 1100)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_few_arcs_take_no_round(spark, monkeypatch):
    """A chain is contracted where it lies: one table of arcs is written, not one for each doubling."""
    seen, plain = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, label: seen.append(label) or plain(df, label))
    edges = [(f"n{k:04d}", f"n{k + 1:04d}") for k in range(500)] + [("x", "x"), (None, "y")]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u string, v string").coalesce(1)).collect()}
    assert got == {f"n{k:04d}": "n0000" for k in range(501)} and len(seen) <= 2


def test_few_arcs_over_many_partitions_take_no_round(spark, monkeypatch):
    written, write = [], graph.staged
    monkeypatch.setattr(graph, "staged", lambda df, label: written.append(1) or write(df, label))
    edges = [(k, k + 1) for k in range(300)] + [(k, 1000 + k % 3) for k in range(400, 500)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long").repartition(8, "u")).collect()}
    assert got == dict.fromkeys(range(301), 0) | {n: 400 + (n - 1) % 3 for n in range(400, 500)} | {1000 + r: 400 + (r - 1) % 3 for r in range(3)}
    assert len(written) == 2


def test_components_of_parts_of_a_partition(spark, monkeypatch):
    """Arcs that are contracted a few at a time still end as one star for each component."""
    plain = graph._contracted
    monkeypatch.setattr(graph, "_contracted", lambda arcs: plain(arcs, 3))
    monkeypatch.setattr(graph, "SALTS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        edges = [(k, k + 1) for k in range(40)] + [(100 + k % 7, 110 + k) for k in range(30)] + [(-5, -9), (-9, -7)]
        rows = graph.components(spark.createDataFrame(edges, "u int, v int")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {k: 0 for k in range(41)} | {110 + k: 100 + k % 7 for k in range(30)} | {100 + k: 100 + k for k in range(7)} | dict.fromkeys((-5, -9, -7), -9)
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)


def test_hamming_pairs_equal_brute_force(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(63) for _ in range(12)]
    rows = [(k, base[k % 12] ^ sum(1 << rng.randrange(63) for _ in range(k % 5))) for k in range(120)]
    got = {(r.left_id, r.right_id, r.distance) for r in duplicates.hamming_pairs(spark.createDataFrame(rows, "id long, v long"), "id", "v", 8).collect()}
    assert got == {(a, b, (x ^ y).bit_count()) for (a, x), (b, y) in itertools.combinations(rows, 2) if (x ^ y).bit_count() <= 8}


def test_numbered(spark):
    keys = random.Random(2).sample(range(10_000), 500)
    got = ranking.numbered(spark.createDataFrame([(k,) for k in keys], "k int").repartition(7), ["k"]).collect()
    assert {r.k: r.number for r in got} == {k: n for n, k in enumerate(sorted(keys), 1)}


def _merge_loop(rows, threshold):
    done = []
    for o in sorted(rows, key=lambda r: (r[1], r[2])):
        best, at = -1.0, None
        for k, c in enumerate(done):
            if c["text"] == o[3].upper() and c["box"] and o[5]:
                a, b = c["box"], o[5]
                w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
                union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
                iou = w * h / union if union > 0 else 0.0
                if iou >= threshold and iou >= best:
                    best, at = iou, k
        if at is None:
            done.append({"text": o[3].upper(), "box": o[5], "conf": o[6], "n": 1})
        else:
            done[at]["n"] += 1
            if o[6] > done[at]["conf"]:
                done[at] |= {"conf": o[6], "box": o[5]}
    return [(d["text"], d["conf"], d["n"]) for d in done]


def test_merge_texts_equals_loop(spark):
    rng = random.Random(9)
    rows = []
    for image in range(40):
        for k in range(rng.randrange(1, 9)):
            x, y = rng.randrange(4) * 5.0, rng.randrange(3) * 5.0
            box = None if rng.random() < 0.1 else (x, y, x + 20, y + 20)
            rows.append((f"i{image}", f"u{rng.randrange(3)}", f"t{k}", rng.choice("ab"), "other", box, rng.choice((0.3, 0.5, 0.9))))
    got = {}
    for r in merge.merge_texts(spark.createDataFrame(rows, TEXTS), 0.5).orderBy("image_id", "position").collect():
        got.setdefault(r.image_id, []).append((r.normalized_text, r.confidence, len(r.sources)))
    assert got == {i: _merge_loop([r for r in rows if r[0] == i], 0.5) for i in {r[0] for r in rows}}


def test_merge_regions_three_to_two(spark):
    kind = "image_id string, unit_id string, item_id string, region_type string, shade_code string, box struct<x0:double,y0:double,x1:double,y1:double>, confidence double, linked_ids array<string>, risks array<string>"
    rows = [("i", "u1", "r1", "swatch", "12", (0.0, 0.0, 10.0, 10.0), 0.5, ["b"], ["blur"]), ("i", "u2", "r1", "swatch", None, (0.0, 0.0, 10.0, 9.0), 0.8, ["a"], []), ("i", "u2", "r2", "swatch", "13", (0.0, 0.0, 10.0, 10.0), 0.9, [], [])]
    got = merge.merge_regions(spark.createDataFrame(rows, kind)).orderBy("position").collect()
    assert [(r.shade_code, r.confidence, r.linked_ids, r.risks, len(r.sources)) for r in got] == [("12", 0.8, ["a", "b"], ["blur"], 2), ("13", 0.9, [], [], 1)]


def test_quota_with_carried_rows(spark):
    rows = [(k, "abcd"[k % 4]) for k in range(183)]
    df = spark.createDataFrame(rows, "k long, s string")
    carried = df.where("k IN (0, 4, 5)")
    got = sampling.by_quota(df, "k", "s", {"a": 15, "b": 10, "c": 8, "d": 7}, 260, "x", carried).collect()
    counts = {s: sum(r.s == s for r in got) for s in "abcd"}
    assert counts == {"a": 15, "b": 10, "c": 8, "d": 7} and {0, 4, 5} <= {r.k for r in got} and len({r.k for r in got}) == 40


def test_split_caps_equal_loop(spark):
    df = sampling.with_split(spark.createDataFrame([(k, "ab"[k % 2]) for k in range(200)], "k long, s string"), "k", 1)
    caps, strata = {"train": 20, "validation": 6, "test": 6}, {"a": 18, "b": 18}
    got = {r.k for r in sampling.with_split_caps(df, "k", strata, "s", caps, "split", 1).collect()}
    import hashlib

    left, want = dict(caps), set()
    for name, quota in strata.items():
        n = 0
        for r in sorted((r for r in df.collect() if r.s == name), key=lambda r: (hashlib.sha256(f"1\0{name}\0{r.k}".encode()).hexdigest(), r.k)):
            if n < quota and left[r.split] > 0:
                left[r.split] -= 1
                n += 1
                want.add(r.k)
    assert got == want


def test_resolved_truth(spark):
    rows = [("e1", "i1", "ann", "label", "x", 1, None), ("e2", "i1", "ann", "label", "y", 2, None), ("e3", "i1", None, "revoke", None, 3, "e2"), ("e4", "i2", "ann", "label", "x", 1, None), ("e5", "i2", "bob", "label", "x", 2, None), ("e6", "i3", "ann", "label", "x", 1, None), ("e7", "i3", "bob", "label", "y", 1, None), ("e8", "i3", "eve", "adjudication", "z", 4, None), ("e9", "i4", "ann", "label", "x", 1, None)]
    events = spark.createDataFrame(rows, "event_id string, item_id string, annotator_id string, kind string, value string, created_at int, revokes_event_id string")
    items = spark.createDataFrame([("i1", False), ("i2", True), ("i3", True), ("i4", True)], "item_id string, blind boolean")
    got = {r.item_id: (r.truth, r.resolution) for r in evaluation.resolved_truth(events, items).collect()}
    assert got == {"i1": ("x", "latest"), "i2": ("x", "agreed"), "i3": ("z", "adjudicated"), "i4": (None, "unresolved")}


def test_metrics_on_empty(spark):
    empty = spark.createDataFrame([], "t boolean, p boolean")
    r = evaluation.binary_metrics(empty, F.col("t"), F.col("p")).first()
    assert (r.tp, r.precision, r.recall, r.f1) == (0, 0.0, 0.0, 0.0)


def test_image_status(spark):
    rows = [("a", "u1", "image", "succeeded", "swatch", 0.9, []), ("b", "u1", "global_thumbnail", "cache_hit", "lip", 0.5, ["r"]), ("b", "u2", "tile", "failed", None, None, []), ("c", "u1", "image", "skipped", None, None, []), ("d", "u1", "image", "failed", None, None, [])]
    df = spark.createDataFrame(rows, "image_id string, unit_id string, scope string, status string, role string, confidence double, risks array<string>")
    got = {r.image_id: (r.role, r.status) for r in entities.image_roles(df).collect()}
    assert got == {"a": ("swatch", "success"), "b": ("lip", "partial"), "c": (None, "skipped"), "d": (None, "failed")}


RESPONSE = {
    "schema_version": "quick-image-extraction-1.0", "scope": "image", "input_context_policy": "image_only", "primary_role": "single_swatch", "role_confidence": 0.9, "layout_type": "grid", "layout_summary": "", "representative_color_eligible": True,
    "eligibility_confidence": 0.8, "summary": "s", "text_items": [{"text_item_id": "t", "text": "12", "text_type": "shade_code", "bbox_norm": [0, 0, 1, 1], "confidence": 1}],
    "color_regions": [{"region_id": "r", "region_type": "swatch", "bbox_norm": [0.1, 0.1, 0.5, 0.5], "confidence": 0.7, "linked_text_item_ids": ["t"], "association_confidence": 0.6}],
}


def _region(**more):
    return {"color_regions": [RESPONSE["color_regions"][0] | more]}


@pytest.mark.parametrize(
    ("change", "problem"),
    [({}, None), ({"extra": 1}, "unknown_keys"), ({"primary_role": "x"}, "role"), ({"secondary_roles": ["single_swatch"]}, "role"), ({"role_confidence": 2}, "confidence"), ({"scope": "global_thumbnail"}, "global_items"), ({"schema_version": "2"}, "literal"),
     (_region(linked_text_item_ids=["no"]), "broken_link"), (_region(association_confidence=None), "link_confidence"), (_region(bbox_norm=[0.5, 0.1, 0.4, 0.5]), "bbox"), (_region(region_type="x"), "item_type")],
)
def test_response_rules(spark, change, problem):
    r = extraction.parsed(spark.createDataFrame([(json.dumps(RESPONSE | change),)], "raw string"), "raw").first()
    assert r.problems == ([problem] if problem else [])


def test_missing_keys(spark):
    short = {k: v for k, v in RESPONSE.items() if k != "summary"}
    assert extraction.parsed(spark.createDataFrame([(json.dumps(short),)], "raw string"), "raw").first().problems == ["missing_keys"]


def test_narrow_repairs(spark):
    body = json.dumps(RESPONSE)
    pixels = json.dumps(RESPONSE | _region(bbox_norm=[10, 10, 50, 40]))
    mille = json.dumps(RESPONSE | _region(bbox_norm=[100, 100, 500, 900]))
    rows = [(1, body), (2, f"```json\n{body}\n```"), (3, pixels), (4, mille), (5, json.dumps(RESPONSE | {"primary_role": "x"})), (6, "no answer")]
    df = spark.createDataFrame([(k, t, 100, 80) for k, t in rows], "k int, raw string, width int, height int")
    got = {r.k: r for r in extraction.strict_or_repaired(df, "raw", "width", "height").collect()}
    assert [got[k].status for k in range(1, 7)] == ["succeeded", "succeeded", "repaired", "repaired", "schema_failed", "schema_failed"]
    assert got[3].repair_actions == ["color_regions[0]:pixels_to_normalized"] and got[3].response.color_regions[0].bbox_norm == [0.1, 0.125, 0.5, 0.5]
    assert got[4].repair_actions == ["color_regions[0]:millesimal_to_normalized"] and got[4].response.color_regions[0].bbox_norm == [0.1, 0.1, 0.5, 0.9]
    assert got[5].problems == ["role"] and got[6].problems == ["not_json"] and got[6].response is None


def test_attempts(spark):
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "cache_key string")
    got = {r.cache_key: r.status for r in extraction.attempts(keys("a", "b", "c"), keys("a", "b"), keys("a")).collect()}
    assert got == {"a": "succeeded", "b": "schema_failed", "c": "interrupted"}


def test_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, -1)], "k int, v int")
    got = {r.rule: r.violations for r in checks.report(checks.unique(df, "u", "k"), checks.holds(df, "c", F.col("v") > 0), checks.foreign_key(df, df.where("k = 1"), "f", "k", "k")).collect()}
    assert got == {"u": 1, "c": 1, "f": 1}
    assert checks.forbidden_columns(df, {"K"}) == {"k"}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "done"), (2, "open")], "k int, s string")
    new = spark.createDataFrame([(1, "new"), (2, "new"), (3, "new")], "k int, s string")
    got = {r.k: r.s for r in relational.upsert_keeping(old, new, ["k"], F.col("s") == "done").collect()}
    assert got == {1: "done", 2: "new", 3: "new"}


def test_observed_color():
    flat = np.tile(np.array([200, 30, 70], np.uint8), (6400, 1))
    assert images.observed_color(flat, "swatch")["color_hex"] == "#C81E46"
    two = np.vstack([np.tile(np.array([120, 110, 105], np.uint8), (5120, 1)), np.tile(np.array([200, 30, 70], np.uint8), (1280, 1))])
    assert images.observed_color(two, "lip")["color_hex"] == "#C81E46"
    assert images.observed_color(two, "swatch")["color_hex"] == "#786E69"
    assert images.observed_color(two, "lip") == images.observed_color(two, "lip")
    masked = np.hstack([flat, np.zeros((6400, 1), np.uint8)])
    masked[:1600, 3] = 255
    assert images.observed_color(masked, "swatch")["valid_pixel_ratio"] == 0.25
    assert images.observed_color(np.full((6400, 3), 250, np.uint8), "swatch")["status"] == "insufficient_pixels"


def test_hashes_and_quality():
    ramp = np.repeat(np.tile(np.arange(0, 250, 2, dtype=np.uint8), (90, 1))[..., None], 3, 2)
    assert images.dhash(ramp) == "f" * 16
    assert bin(int(images.phash(ramp), 16) ^ int(images.phash(ramp[::1].copy()), 16)).count("1") == 0
    q = images.quality(ramp)
    assert "low_resolution" in q["flags"] and q["dark_pixel_ratio"] > 0


def test_similarity_run_counts(spark):
    sem = "image_observed_color_candidate"
    from tintwell.operators.images import lab_of

    def region(image, key, rgb, links, kind="swatch", conf="high"):
        lab = lab_of(np.array([rgb], np.uint8))[0].tolist()
        return (image, key, kind, None, links, False, "succeeded", sem, "#%02X%02X%02X" % rgb, list(rgb), lab, conf, 0.9, 0.8, 2.0)

    regions = [region("i1", "r1", (130, 52, 92), ["t1"]), region("i2", "r1", (132, 52, 92), ["t1"]), region("i2", "r2", (200, 30, 70), ["t2"]), region("i3", "r1", (90, 60, 60), ["t1"]), region("i3", "r2", (90, 60, 60), ["t1"], "lip")]
    kind = "image_id string, region_id string, region_type string, shade_code_text string, linked_ids array<string>, links_broken boolean, extraction_status string, semantics string, color_hex string, rgb array<int>, lab array<double>, color_confidence string, association_confidence double, share double, dispersion double"
    texts = [("i1", "t1", "shade_code", "12"), ("i2", "t1", "shade_code", "12"), ("i2", "t2", "shade_code", "20"), ("i3", "t1", "shade_code", "99")]
    records = [("i1", "p1", "sku12", "#12 rose"), ("i2", "p1", "sku12", "12"), ("i2", "p2", "sku20", "20")]
    seen = similarity_run.observations(spark.createDataFrame(regions, kind), spark.createDataFrame(texts, "image_id string, text_id string, text_type string, normalized_text string"), spark.createDataFrame(records, "image_id string, record_id string, sku string, color_text string"))
    seen.cache()
    made = similarity_run.profiles(seen)
    made.cache()
    found = similarity_run.pairs(made)
    r = similarity_run.summary(None, seen, made, found).first()
    assert (r.images, r.regions, r.formal, r.profiles, r.resolved, r.pair_count, r.topk_rows) == (3, 5, 4, 3, 2, 3, 6)
    assert {x.reason: x.row_count for x in similarity_run.reasons(seen).collect()} == {"region_type_not_formal": 1}
    assert similarity_run.topk(found).count() == 6


def test_resizing():
    rng = np.random.default_rng(2)
    flat = np.full((300, 170, 3), 77, np.uint8)
    assert (images.resized(flat, 32, 32) == 77).all() and images.resized(flat, 300, 170).tolist() == flat.tolist()
    wide = rng.integers(0, 256, (64, 64), np.uint8)
    weights = images._lanczos(64, 8)
    assert weights.shape == (8, 64) and (abs(weights.sum(1) - 2**22) <= 64).all() and (weights < 0).any()
    plain = np.clip(np.round(np.clip(np.round(wide @ (weights.T / 2**22)), 0, 255).T @ (weights.T / 2**22)).T, 0, 255)
    assert abs(images.resized(wide, 8, 8).astype(int) - plain).max() <= 1
    large = np.concatenate([np.full((600, 300, 3), (200, 30, 70), np.uint8), np.full((600, 300, 3), 250, np.uint8)], 1)
    found = images.observed_color(large, "swatch")
    assert found["status"] == "success" and found["color_hex"] == "#C81E46" and found["valid_pixel_count"] < 256 * 256


def _broadcasts(df):
    return "BroadcastExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_hamming_joins_are_never_broadcast(spark):
    rows = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    assert not _broadcasts(duplicates.hamming_pairs(rows, "id", "v", 3)) and not _broadcasts(duplicates.hamming_edges(rows, "id", "v", 3))


@pytest.mark.parametrize("records", ["7", "10000"])
def test_hamming_links_of_full_bands(spark, records):
    rng = random.Random(3)
    values = list({k for k in range(90)} | {-1 - k for k in range(80)} | {rng.getrandbits(64) - (1 << 63) for _ in range(50)} | {(1 << 62) + (k << 50) for k in range(70)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    try:
        got = [tuple(r) for r in duplicates.hamming_links(spark.createDataFrame([(v,) for v in [*values, values[0], None]], "v long"), "v", 5).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    bits = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count()
    assert sorted(got) == sorted((a, b, bits(a, b)) for a, b in itertools.combinations(sorted(values), 2) if bits(a, b) <= 5)
