import hashlib
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tintwell.operators import images
from tintwell.plans import manifest_build
from tintwell.sources import readers, writers
from tintwell.streaming import events

HEADER = "asset_id,sku_id,goods_id,brand_id,brand_name,sku_name,sku_concat_name,sku_color_no,pic_list,show_pic"


def png(width, height, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * width for _ in range(height))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


@pytest.fixture
def workspace(tmp_path):
    urls = [f"https://h/img/{k}.jpg" for k in range(5)]
    rows = [("1", "s1", "g1", "b1", "Brand A", [urls[0], urls[1]], []), ("2", "s1", "g1", "b1", "Brand A", [urls[2]], []), ("3", "s3", "g3", "b1", "Brand Á", [urls[3]], []), ("4", "s4", "g4", "b2", 'Brand "B"\nnew', [], [urls[4]])]
    quote = lambda v: '"' + v.replace('"', '""') + '"'
    lines = [HEADER] + [",".join(quote(c) for c in (a, s, g, b, n, "x", "x", "c", json.dumps(p), json.dumps(q))) for a, s, g, b, n, p, q in rows]
    (tmp_path / "catalog.csv").write_bytes(b"\xef\xbb\xbf" + "\n".join(lines).encode())
    contents = [b"\xff\xd8\xff1", b"\xff\xd8\xff1", b"\xff\xd8\xff2", png(4, 3, (1, 2, 3)), b"\xff\xd8\xff3"]
    folders = ["Brand A/g1", "Brand A/g1", "Brand A/g1", "Brand Á/g3", "Brand _B__new/g4"]
    fields = [("pic_list", 1), ("pic_list", 2), ("pic_list", 1), ("pic_list", 1), ("show_pic", 1)]
    root = tmp_path / "images"
    for url, content, folder, (field, n) in zip(urls, contents, folders, fields, strict=True):
        (root / folder).mkdir(parents=True, exist_ok=True)
        (root / folder / f"{field}_{n:03d}_{hashlib.sha1(url.encode()).hexdigest()[:12]}.jpg").write_bytes(content)
    (root / "note.txt").write_text("no image")
    return tmp_path


def test_lineage_counts(spark, workspace):
    t = manifest_build.build(spark, str(workspace / "catalog.csv"), str(workspace / "images"), "snap")
    assert {k: t[k].count() for k in ("source_records", "source_image_refs", "image_occurrences", "image_contents", "source_ref_occurrences", "brand_alias_candidates")} == {"source_records": 4, "source_image_refs": 5, "image_occurrences": 5, "image_contents": 4, "source_ref_occurrences": 5, "brand_alias_candidates": 1}
    assert sorted(r.row_number for r in t["source_records"].collect()) == [2, 3, 4, 5]
    assert {r.folder: r.status for r in t["folder_groups"].collect()}["Brand A/g1"] == "multi_source_record"
    assert {r.rule: r.violations for r in manifest_build.validate(t).collect()} == dict.fromkeys(("source_record_id", "source_ref_id", "occurrence_id", "ref_has_record", "link_has_occurrence", "occurrence_has_content", "confidence_range"), 0)
    again = manifest_build.build(spark, str(workspace / "catalog.csv"), str(workspace / "images"), "snap")
    assert {r[0] for r in t["source_image_refs"].select("source_ref_id").collect()} == {r[0] for r in again["source_image_refs"].select("source_ref_id").collect()}
    assert {r.format for r in t["image_occurrences"].collect()} == {"JPEG", "PNG"}


def test_missing_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.catalog(spark, str(tmp_path / "c.csv"))


def test_images_and_corrupt_files(spark, tmp_path):
    (tmp_path / "good.png").write_bytes(png(80, 80, (200, 30, 70)))
    (tmp_path / "bad.png").write_bytes(b"\x89PNG broken")
    df = readers.images(spark, str(tmp_path))
    assert sorted((r.path.rsplit("/", 1)[1], r.decoded) for r in df.collect()) == [("bad.png", False), ("good.png", True)]
    q = df.select(images.image_quality("pixels", "width", "height").alias("q"), images.image_hashes("pixels", "width", "height").alias("h"), "decoded").collect()
    assert {r.decoded: r.q.error is None for r in q} == {True: True, False: False}
    box = F.struct(F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.lit(80).alias("x1"), F.lit(80).alias("y1"))
    c = df.where("decoded").select(images.region_color("pixels", "width", "height", box, F.lit("swatch")).alias("c")).first().c
    assert c.status == "success" and c.color_hex == "#461EC8"  # the source gives BGR


def test_manifest_rules(spark, tmp_path):
    row = lambda k: {"schema_version": "v1", "manifest_version": "m", "sequence": k, "image_id": f"{k:064x}", "sha256": f"{k:064x}", "source_quick_run_id": "r", "selection_reason": "x"}

    def read(rows):
        path = tmp_path / f"m{len(list(tmp_path.iterdir()))}.jsonl"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        return readers.similarity_manifest(spark, str(path), "v1")

    assert [r.sequence for r in read([row(2), row(1)]).collect()] == [1, 2]
    for bad in ([row(1), row(3)], [row(1), row(1)], [row(1) | {"schema_version": "v0"}], [row(1) | {"image_id": "zz"}], [row(1) | {"selection_reason": " "}]):
        with pytest.raises(ValueError, match="manifest"):
            read(bad)


def test_duplicate_pairs(spark, tmp_path):
    head = "pair_type,group_id,path_a,path_b,sha256_a,sha256_b,phash_a,phash_b,phash_distance,dhash_a,dhash_b,dhash_distance"
    rows = ["near,g,p,q,b,a,0,0,3,0,0,4", "near,g,p,r,a,b,0,0,9,0,0,9", "exact,g,p,q,c,c,0,0,0,0,0,0", "near,g,p,q,c,c,0,0,0,0,0,0"]
    (tmp_path / "d.csv").write_text("\n".join([head, *rows]))
    assert [tuple(r) for r in readers.duplicate_pairs(spark, str(tmp_path / "d.csv")).collect()] == [("a", "b", 3, 4)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, "b", None), (1, "a", [1, 2])], "k int, s string, v array<int>")
    r = writers.json_lines(df, str(tmp_path / "j"), ["k"]).first()
    back = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "j")).collect()]
    assert r.row_count == 2 and sorted(b["k"] for b in back) == [1, 2] and back[0].keys() == {"k", "s", "v"}
    assert writers.json_lines(df.repartition(2), str(tmp_path / "j2"), ["k"]).first().digest == r.digest
    writers.csv(df, str(tmp_path / "c"), ["k", "v"], ["k"])
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    runs = df.withColumn("run_id", F.col("s"))
    writers.append(runs, str(tmp_path / "t"))
    writers.replace_run(runs.where("k = 1").withColumn("k", F.lit(9)), str(tmp_path / "t"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [2, 9]
    with pytest.raises(Exception, match="exist"):
        writers.once(df, str(tmp_path / "t"))
    assert writers.manifest(spark, str(tmp_path / "c")).count() >= 1


def test_stream_of_revisions(spark, tmp_path):
    schema = "event_id string, item_id string, kind string, value string, created_at timestamp, revokes_event_id string"
    batches = [[("e1", "i", "role", "x", "2024-01-01 00:00:00", None)], [("e2", "i", "role", "y", "2024-01-02 00:00:00", None)], [("r", "i", "role", None, "2024-01-03 00:00:00", "e2")]]
    (tmp_path / "in").mkdir()
    rows = []
    query = events.latest_live(spark.readStream.schema(schema).json(str(tmp_path / "in"))).writeStream.outputMode("update").foreachBatch(lambda df, n: rows.extend(r.value for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).start()
    names = ("event_id", "item_id", "kind", "value", "created_at", "revokes_event_id")
    for n, batch in enumerate(batches):
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps(dict(zip(names, e, strict=True))) for e in batch))
        query.processAllAvailable()
    query.stop()
    assert rows == ["x", "y", "x"]


def test_stream_takes_back_before_and_after_in_spark_itself(spark, tmp_path):
    schema = "event_id string, item_id string, kind string, value string, created_at timestamp, revokes_event_id string"
    rows = [("r", "i", "k", None, "2024-01-09 00:00:00", "e3"), ("e1", "i", "k", "x", "2024-01-01 00:00:00", None), ("e3", "i", "k", "z", "2024-01-03 00:00:00", None), ("e2", "i", "k", "y", "2024-01-02 00:00:00", None), ("e2", "i", "k", "y", "2024-01-02 00:00:00", None), ("e4", "j", "k", "w", "2024-01-01 00:00:00", None), ("s", "j", "k", None, "2024-01-01 00:00:00", "e4")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("\n".join(json.dumps(dict(zip(("event_id", "item_id", "kind", "value", "created_at", "revokes_event_id"), r, strict=True))) for r in rows))
    live = events.latest_live(spark.readStream.schema(schema).json(str(tmp_path / "in")))
    assert "Python" not in live._jdf.queryExecution().analyzed().toString() and "Pandas" not in live._jdf.queryExecution().analyzed().toString()
    got = []
    live.writeStream.outputMode("update").foreachBatch(lambda df, n: got.extend((r.item_id, r.event_id, r.value) for r in df.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(got) == [("i", "e2", "y"), ("j", None, None)]
