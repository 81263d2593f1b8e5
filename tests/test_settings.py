import json

import pytest

from tintwell import settings


def test_overlay(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"similarity": {"top_k": 3}}))
    got = settings.load(str(tmp_path / "s.json"))
    assert got["similarity"]["top_k"] == 3 and got["similarity"]["display_score_scale"] == 10.0
    assert settings.DEFAULTS["similarity"]["top_k"] == 10


@pytest.mark.parametrize("bad", [{"tiling": {"overlap": 4096}}, {"similarity": {"top_k": 0}}, {"sampling": {"split": [1, 1, 1]}}])
def test_rules(tmp_path, bad):
    (tmp_path / "s.json").write_text(json.dumps(bad))
    with pytest.raises(ValueError):
        settings.load(str(tmp_path / "s.json"))


def test_unknown(tmp_path):
    (tmp_path / "s.json").write_text('{"x": 1}')
    with pytest.raises(KeyError):
        settings.load(str(tmp_path / "s.json"))
