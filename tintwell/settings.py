"""Settings of the pipelines: defaults, overlaid by a YAML or JSON file, and checked."""

from __future__ import annotations

import json
from collections.abc import Mapping
from copy import deepcopy
from pathlib import Path
from typing import Any

# The defaults that results depend on.
DEFAULTS: dict[str, Any] = {
    "tiling": {"tile": 2048, "overlap": 512},
    "merge": {"text_iou": 0.5, "region_iou": 0.6},
    "duplicates": {"high": 4, "possible": 8},
    "color": {"seed": 260, "max_clusters": 3, "iterations": 15, "shrink_fraction": 0.03, "minimum_valid_pixels": 300, "minimum_valid_ratio": 0.05},
    "similarity": {"top_k": 10, "max_delta_e00": None, "lab_integrity_tolerance": 1e-6, "display_score_scale": 10.0, "formal_region_types": ["swatch"], "accepted_color_confidence": ["medium", "high"]},
    "sampling": {"seed": "260", "context_quotas": [15, 10, 8, 7], "split": [60, 20, 20]},
}


def merged(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """base with the values of over, section by section; an unknown key is an error."""
    out = deepcopy(dict(base))
    for key, value in over.items():
        if key not in out:
            raise KeyError(f"unknown setting {key}")
        out[key] = merged(out[key], value) if isinstance(out[key], dict) and isinstance(value, Mapping) else value
    return out


def checked(values: Mapping[str, Any]) -> dict[str, Any]:
    s, t, c = values["similarity"], values["tiling"], values["color"]
    rules = {
        "tile must exceed overlap": t["tile"] > t["overlap"] >= 0,
        "top_k must be positive": s["top_k"] > 0,
        "max_delta_e00 must not be negative": s["max_delta_e00"] is None or s["max_delta_e00"] >= 0,
        "display_score_scale must be positive": s["display_score_scale"] > 0,
        "thresholds of overlap lie between 0 and 1": all(0 < v <= 1 for v in values["merge"].values()),
        "possible duplicates reach beyond high ones": 0 <= values["duplicates"]["high"] <= values["duplicates"]["possible"],
        "shrink_fraction lies below one half": 0 <= c["shrink_fraction"] < 0.5,
        "splits add up to 100": sum(values["sampling"]["split"]) == 100,
    }
    for rule, holds in rules.items():
        if not holds:
            raise ValueError(rule)
    return dict(values)


def load(path: str | None = None) -> dict[str, Any]:
    if path is None:
        return checked(deepcopy(DEFAULTS))
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        over = json.loads(text)
    else:
        import yaml

        over = yaml.safe_load(text) or {}
    return checked(merged(DEFAULTS, over))
