import json

import pytest

from tests.test_sources import workspace  # noqa: F401  a fixture
from tintwell import cli
from tintwell.plans.runs import Run, Workspace


def test_query_list(capsys):
    assert cli.main(["query", "list"]) == 0
    assert "profile_ranked_topk" in json.loads(capsys.readouterr().out)["queries"]


def test_manifest_build(spark, workspace, capsys):  # noqa: F811
    args = ["manifest", "build", "--workspace", str(workspace / "ws"), "--run-id", "r1", "--catalog", str(workspace / "catalog.csv"), "--images", str(workspace / "images"), "--snapshot", "s"]
    assert cli.main(args) == 0
    out = json.loads(capsys.readouterr().out)
    assert out["violations"] == {} and out["counts"]["image_contents"] == 4
    assert cli.main(args) == 1 and "FileExistsError" in capsys.readouterr().err
    assert Workspace(spark, str(workspace / "ws")).finished("r1")["status"] == "completed"


def test_similarity_commands(spark, tmp_path, capsys):
    sem, rgb = "image_observed_color_candidate", [(130, 52, 92), (200, 30, 70)]
    import numpy as np

    from tintwell.operators.images import lab_of

    rows = [(f"i{k}", "r", "swatch", None, ["t"], False, "succeeded", sem, "#%02X%02X%02X" % c, list(c), lab_of(np.array([c], np.uint8))[0].tolist(), "high", 0.9, 0.8, 2.0) for k, c in enumerate(rgb)]
    kind = "image_id string, region_id string, region_type string, shade_code_text string, linked_ids array<string>, links_broken boolean, extraction_status string, semantics string, color_hex string, rgb array<int>, lab array<double>, color_confidence string, association_confidence double, share double, dispersion double"
    spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / "regions"))
    spark.createDataFrame([("i0", "t", "shade_code", "12"), ("i1", "t", "shade_code", "13")], "image_id string, text_id string, text_type string, normalized_text string").write.parquet(str(tmp_path / "texts"))
    spark.createDataFrame([], "image_id string, record_id string, sku string, color_text string").write.parquet(str(tmp_path / "records"))
    data = [x for n in ("regions", "texts", "records") for x in (f"--{n}", str(tmp_path / n))]
    assert cli.main(["shade-similarity", "plan", *data]) == 0
    assert json.loads(capsys.readouterr().out)["pair_count"] == 1
    run = ["shade-similarity", "run", *data, "--workspace", str(tmp_path / "ws"), "--run-id", "r"]
    assert cli.main(run) == 0 and json.loads(capsys.readouterr().out)["topk"] == 2
    assert cli.main([*run, "--resume"]) == 0 and json.loads(capsys.readouterr().out)["status"] == "completed"
    assert cli.main([*run, "--resume", "--top-k", "3"]) == 1 and "ValueError" in capsys.readouterr().err
    assert cli.main(["shade-similarity", "export", "--workspace", str(tmp_path / "ws"), "--run-id", "r", "--output", str(tmp_path / "out")]) == 0
    assert len(json.loads(capsys.readouterr().out)["files"]) >= 3


def test_fingerprint_follows_the_configuration():
    assert Run("r", "s", {"a": 1}).fingerprint == Run("other", "s", {"a": 1}).fingerprint != Run("r", "s", {"a": 2}).fingerprint


def test_options_are_checked():
    with pytest.raises(ValueError, match="top_k"):
        cli.similarity_run.Options(top_k=0)
