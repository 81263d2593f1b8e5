"""Boxes, tiles and coordinate transforms as Column expressions. A box is struct(x0, y0, x1, y1), half open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# x' = a x + b y + c and y' = d x + e y + f for the eight image orientations, c and f in units of width and height.
ORIENTATIONS = {
    1: ((1, 0, (0, 0)), (0, 1, (0, 0))),
    2: ((-1, 0, (1, 0)), (0, 1, (0, 0))),
    3: ((-1, 0, (1, 0)), (0, -1, (0, 1))),
    4: ((1, 0, (0, 0)), (0, -1, (0, 1))),
    5: ((0, 1, (0, 0)), (1, 0, (0, 0))),
    6: ((0, -1, (0, 1)), (1, 0, (0, 0))),
    7: ((0, -1, (0, 1)), (-1, 0, (1, 0))),
    8: ((0, 1, (0, 0)), (-1, 0, (1, 0))),
}


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty, null where a box is null."""
    w = F.greatest(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), F.lit(0.0))
    h = F.greatest(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), F.lit(0.0))
    area = lambda r: F.greatest(r["x1"] - r["x0"], F.lit(0.0)) * F.greatest(r["y1"] - r["y0"], F.lit(0.0))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).when(union <= 0, 0.0)


def box_is_valid(b: Column) -> Column:
    """Finite coordinates from 0 to 1 with a positive area."""
    inside = F.lit(True)
    for k in ("x0", "y0", "x1", "y1"):
        inside = inside & ~F.isnan(b[k]) & b[k].between(0.0, 1.0)
    return F.coalesce(inside & (b["x0"] < b["x1"]) & (b["y0"] < b["y1"]), F.lit(False))


def polygon_is_valid(points: Column, width: Column, height: Column) -> Column:
    """At least three points, an array of (x, y), all within the image."""
    return F.coalesce((F.size(points) >= 3) & F.forall(points, lambda p: p["x"].between(0, width) & p["y"].between(0, height)), F.lit(False))


def to_image(b: Column, scale_x: Column, scale_y: Column, shift_x: Column, shift_y: Column, width: Column, height: Column) -> Column:
    """A box in asset pixels mapped to the image and clamped to it; null where nothing is left."""
    clamp = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), top.cast("double"))
    out = box(clamp(b["x0"] * scale_x + shift_x, width), clamp(b["y0"] * scale_y + shift_y, height), clamp(b["x1"] * scale_x + shift_x, width), clamp(b["y1"] * scale_y + shift_y, height))
    return F.when((out["x0"] < out["x1"]) & (out["y0"] < out["y1"]), out)


def repaired_box(b: Column, width: Column, height: Column) -> Column:
    """struct(box, action): a box in any of three conventions as fractions, where one of them fits it.

    Values up to 1 are fractions; values within the image are its pixels; values up to 1000 that leave the image are
    thousandths. A box without positive area, or of no convention, is left as it is.
    """
    top = F.greatest(b["x0"], b["y0"], b["x1"], b["y1"])
    proper = (b["x0"] >= 0) & (b["y0"] >= 0) & (b["x0"] < b["x1"]) & (b["y0"] < b["y1"])
    pixels = (b["x1"] <= width) & (b["y1"] <= height)
    by = lambda x, y: box(b["x0"] / x, b["y0"] / y, b["x1"] / x, b["y1"] / y)
    thousand = F.lit(1000.0)
    action = F.when(~F.coalesce(proper, F.lit(False)), "unchanged").when(top <= 1, "none").when(pixels, "pixels").when(top <= 1000, "millesimal").otherwise("unchanged")
    value = F.when(action == "pixels", by(width.cast("double"), height.cast("double"))).when(action == "millesimal", by(thousand, thousand)).otherwise(b)
    return F.struct(value.alias("box"), action.alias("action"))


def tile_starts(length: Column, tile: int, overlap: int) -> Column:
    """Starts of tiles that cover a length, each `overlap` into the one before, the last flush with the end."""
    length = length.cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(length - tile, F.lit(0)), F.lit(tile - overlap).cast("bigint"))
    return F.when(length <= tile, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_distinct(F.concat(starts, F.array(length - tile))))


def oriented(orientation: Column, x: Column, y: Column, width: Column, height: Column) -> Column:
    """struct(x, y): a point of the stored image in the image that is shown; unknown orientations change nothing."""
    out = None
    for code, rows in ORIENTATIONS.items():
        nx, ny = (x * a + y * b + width * c[0] + height * c[1] for a, b, c in rows)
        value = F.struct(nx.cast("double").alias("x"), ny.cast("double").alias("y"))
        out = F.when(orientation == code, value) if out is None else out.when(orientation == code, value)
    return out.otherwise(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))


def affine(m: Column, x: Column, y: Column) -> Column:
    """A point under a 3x3 matrix given as an array of rows."""
    at = lambda r, c: F.get(F.get(m, F.lit(r)), F.lit(c))
    return F.struct((at(0, 0) * x + at(0, 1) * y + at(0, 2)).alias("x"), (at(1, 0) * x + at(1, 1) * y + at(1, 2)).alias("y"))


def shrunken(b: Column, width: Column, height: Column, fraction: float) -> Column:
    """A box with a fraction of its sides cut off, in whole pixels, at least one pixel large; null outside the image."""
    x0, y0 = F.greatest(b["x0"], F.lit(0.0)), F.greatest(b["y0"], F.lit(0.0))
    x1, y1 = F.least(b["x1"], width.cast("double")), F.least(b["y1"], height.cast("double"))
    dx, dy = (x1 - x0) * fraction, (y1 - y0) * fraction
    left = F.greatest(F.lit(0), F.least(width - 1, F.floor(x0 + dx)))
    top = F.greatest(F.lit(0), F.least(height - 1, F.floor(y0 + dy)))
    right = F.greatest(left + 1, F.least(width.cast("bigint"), F.ceil(x1 - dx)))
    bottom = F.greatest(top + 1, F.least(height.cast("bigint"), F.ceil(y1 - dy)))
    out = F.struct(left.alias("x0"), top.alias("y0"), right.alias("x1"), bottom.alias("y1"))
    return F.when((x0 < x1) & (y0 < y1), out)


def preview(width: Column, height: Column, max_edge: int, least_edge: int = 11) -> Column:
    """Size of a preview that fits max_edge and is padded to least_edge, with the scale back to the image."""
    scale = F.least(F.lit(1.0), F.lit(float(max_edge)) / F.greatest(width, height))
    w, h = F.greatest(F.lit(1), F.bround(width * scale).cast("int")), F.greatest(F.lit(1), F.bround(height * scale).cast("int"))
    return F.struct(w.alias("width"), h.alias("height"), F.greatest(w, F.lit(least_edge)).alias("padded_width"), F.greatest(h, F.lit(least_edge)).alias("padded_height"), (width / w).alias("scale_x"), (height / h).alias("scale_y"))


def image_flags(width: Column, height: Column) -> Column:
    """struct(invalid, long, extreme, too_large) of an image's size."""
    short, edge = F.least(width, height), F.greatest(width, height)
    invalid = (short < 16) | (width * height < 1024)
    ratio = edge / F.greatest(short, F.lit(1))
    return F.struct(invalid.alias("invalid"), (~invalid & (ratio >= 4) & (edge >= 3000) & (short >= 64)).alias("long"), (ratio >= 10).alias("extreme"), (width.cast("bigint") * height >= 100_000_000).alias("too_large"))
