"""Text rules: normal forms, tokens of shade codes, paths, addresses and secrets."""

from __future__ import annotations

import ast
import contextlib
import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The regular expressions and word lists that define results.
SHADE_CODE = r"(?<![A-Z0-9])#?\s*([A-Z]*\d+[A-Z0-9-]*)"
CONTEXT_TOKEN = r"(?<![A-Za-z0-9])([A-Za-z]{0,3}[- ]?\d{1,4}[A-Za-z]?)(?![A-Za-z0-9])"
CAPACITY = r"(?i)^\d+(?:\.\d+)?(?:g|ml)$"
SECRET_RULES = (
    ("dashscope_api_key", r"\bsk-(?:ws-)?[A-Za-z0-9_-]{20,}\b", 0),
    ("alibaba_access_key_id", r"\bLTAI[A-Za-z0-9]{12,}\b", 0),
    ("generic_secret_assignment", r"""(?i)\b(?:api[_-]?key|access[_-]?key|secret|token|authorization)\b\s*[:=]\s*["']([A-Za-z0-9_./+=:-]{20,})["']""", 1),
)
PLACEHOLDERS = ("example", "placeholder", "replace_me", "replace-me", "your_", "your-", "dummy", "redacted", "<", ">", "${")
RESERVED_NAMES = r"(?i)^(CON|PRN|AUX|NUL|COM[1-9]|LPT[1-9])$"
ILLEGAL_IN_NAMES = r'[<>:"/\\|?*\x00-\x1F]'
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "gif", "webp", "bmp", "tif", "tiff", "avif", "heic", "heif")


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def nfkc_casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


@F.pandas_udf(StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFC", t))


def _folded(value: Column, form, ascii_only: bool) -> Column:
    return value if ascii_only else form(value)


def visible_text(value: Column, ascii_only: bool = False) -> Column:
    """NFKC, runs of white space as one space, ends trimmed, a-z alone in capitals; ascii_only leaves the UDF out."""
    folded = F.regexp_replace(_folded(value, nfkc, ascii_only), r"(?U)\s+", " ")
    return F.translate(F.trim(folded), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def ocr_text(value: Column) -> Column:
    """NFKC and case-folded, without white space, hyphens and underscores."""
    return F.regexp_replace(nfkc_casefold(value), r"(?U)[\s\-_]+", "")


def shade_tokens(value: Column, ascii_only: bool = False) -> Column:
    """Distinct shade codes of a label, in order; an empty array for null."""
    upper = F.upper(_folded(F.coalesce(value, F.lit("")), nfkc, ascii_only))
    return F.array_distinct(F.regexp_extract_all(upper, F.lit(SHADE_CODE), F.lit(1)))


def shade_key(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"(?U)[\s\-_]+", ""))


def context_shades(*values: Column) -> Column:
    """Candidate shades of product texts: short texts and code-like tokens, one for each key, first spelling first.

    Texts longer than 20 characters give only their tokens; capacities like 5g or 30ml are left out.
    """
    parts = []
    for value in values:
        v = F.trim(F.coalesce(value, F.lit("")))
        whole = F.when((v != "") & ~v.rlike(CAPACITY) & (F.length(v) <= 20), F.array(v)).otherwise(F.array().cast("array<string>"))
        parts += [whole, F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(CONTEXT_TOKEN), F.lit(1))]
    found = F.transform(F.concat(*parts), lambda c: F.struct(c.alias("shade"), shade_key(c).alias("key")))
    found = F.filter(found, lambda s: (s["key"] != "") & ~s["key"].rlike(CAPACITY))
    first = F.filter(found, lambda s, i: F.array_position(F.transform(found, lambda o: o["key"]), s["key"]) == i + 1)
    return F.transform(first, lambda s: s["shade"])


def codes_conflict(left: Column, right: Column, ascii_only: bool = False) -> Column:
    """Both are there and differ after normalisation."""
    both = (F.coalesce(left, F.lit("")) != "") & (F.coalesce(right, F.lit("")) != "")
    return both & (visible_text(left, ascii_only) != visible_text(right, ascii_only))


def safe_component(value: Column, fallback: str, max_length: int = 120, ascii_only: bool = False) -> Column:
    """A name that every common file system takes as one path component; long names end in a digest of the original."""
    original = _folded(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)^\s+|\s+$", ""), nfc, ascii_only)
    clean = F.regexp_replace(F.regexp_replace(original, ILLEGAL_IN_NAMES, "_"), r"(?U)\s+", " ")
    clean = F.regexp_replace(clean, r"[ .]+$", "")
    clean = F.when(clean == "", fallback).otherwise(clean)
    clean = F.when(F.element_at(F.split(clean, r"\."), 1).rlike(RESERVED_NAMES), F.concat(F.lit("_"), clean)).otherwise(clean)
    short = F.concat(F.rtrim(F.substring(clean, 1, max_length - 11)), F.lit("_"), F.substring(F.sha1(original.cast("binary")), 1, 10))
    return F.when(F.length(clean) > max_length, short).otherwise(clean)


@F.pandas_udf(StringType())
def _literal_as_json(raw: pd.Series) -> pd.Series:
    """Python literals as JSON; null for what is neither."""

    def convert(text: str | None) -> str | None:
        with contextlib.suppress(ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
            return None if text is None else json.dumps(ast.literal_eval(text), default=str)
        return None

    return raw.map(convert)


def _address(item: Column) -> Column:
    """What an item of a list says: a text or number as it is; an object's url, or its src where that is missing or empty."""
    said = lambda path: F.try_variant_get(item, path, "string")
    return F.trim(F.coalesce(F.nullif(said("$.url"), F.lit("")), said("$.src"), said("$")))


def _addresses(value: Column) -> Column:
    """Of a variant: those of a list, or of a lone text; null for anything else."""
    items = F.when(F.schema_of_variant(value) == "STRING", F.array(value)).otherwise(F.try_variant_get(value, "$", "array<variant>"))
    return F.filter(F.transform(items, _address), lambda u: F.length(u) > 0)


def image_urls(raw: Column | str) -> Column:
    """URLs of a JSON or Python list, of objects with url or src, or of a single value; null where it is none of these.

    JSON stays in the JVM. Only what is no JSON goes to Python, which reads its literals.
    """
    text = F.trim(F.coalesce(F.col(raw) if isinstance(raw, str) else raw, F.lit("")))
    none = F.lower(text).isin("", "null", "none", "nan")
    json_value = F.try_parse_json(F.when(~none, text))
    literal = F.try_parse_json(_literal_as_json(F.when(~none & json_value.isNull(), text)))
    return F.when(none, F.array().cast("array<string>")).otherwise(_addresses(F.coalesce(json_value, literal)))


def json_urls(raw: Column) -> Column:
    """The native case of image_urls: a JSON array of texts; null otherwise."""
    return F.from_json(raw, "array<string>")


def url_extension(url: Column) -> Column:
    """The suffix, of at most eight letters and digits, of the last part of a URL's path, else jpg."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    found = F.regexp_extract(path, r"[^/.][^/]*\.([a-z0-9]{1,8})$", 1)
    return F.when(found != "", found).otherwise("jpg")


def output_filename(field: Column, index: Column, url: Column) -> Column:
    """<field>_<index in three digits>_<first 12 digits of the URL's SHA-1>.<suffix>"""
    return F.concat(field, F.lit("_"), F.lpad(index.cast("string"), 3, "0"), F.lit("_"), F.substring(F.sha1(url.cast("binary")), 1, 12), F.lit("."), url_extension(url))


def relative_path(path: Column, ascii_only: bool = False) -> Column:
    return _folded(F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "^/+|/+$", ""), nfc, ascii_only)


def path_brand(path: Column) -> Column:
    """First of at least three path components, else null."""
    parts = F.split(relative_path(path, True), "/")
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(0)))


def path_product(path: Column) -> Column:
    parts = F.split(relative_path(path, True), "/")
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(1)))


def without_code_fence(text: Column) -> Column:
    """The inside of a text that is one fenced block, else the trimmed text."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    inside = F.regexp_extract(trimmed, r"(?is)^```(?:json)?\s*(.*?)\s*```$", 1)
    return F.when(inside != "", inside).otherwise(trimmed)


def secret_rule(line: Column) -> Column:
    """Name of the first rule with a match in the line that is no placeholder; null without one. Values are never returned."""
    out = None
    for name, pattern, group in SECRET_RULES:
        hits = F.filter(F.regexp_extract_all(line, F.lit(pattern), F.lit(group)), lambda v: ~_placeholder(v))
        out = F.when(F.size(hits) > 0, name) if out is None else out.when(F.size(hits) > 0, name)
    return out


def _placeholder(value: Column) -> Column:
    low = F.lower(value)
    found = F.lit(False)
    for marker in PLACEHOLDERS:
        found = found | F.contains(low, F.lit(marker))
    return found


def redacted(text: Column) -> Column:
    """The text with every secret replaced by a mark."""
    for _, pattern, group in SECRET_RULES:
        text = F.regexp_replace(text, pattern, "[REDACTED]" if not group else "[REDACTED_ASSIGNMENT]")
    return text


def repo_uri(path: Column, root: str, alias: str = "repo") -> Column:
    """A path below root as alias://..., any other path as it is."""
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.concat(F.lit(f"{alias}://"), F.substring(path, len(base) + 1, 100_000))).otherwise(path)


def resolve_uri(uri: Column, root: str, alias: str = "repo") -> Column:
    mark = f"{alias}://"
    return F.when(F.startswith(uri, F.lit(mark)), F.concat(F.lit(root.rstrip("/") + "/"), F.substring(uri, len(mark) + 1, 100_000))).otherwise(uri)
