"""Identifiers, digests and repeatable random ranks as Column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of all stable ids.
NAMESPACE = uuid.UUID("01b2a690-e5b7-4a3c-a5b1-3d57437da9ec")


def uuid5_hex(namespace: uuid.UUID, name: Column) -> Column:
    """The 32 hex digits of the version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8))), -1, 1)
    return F.concat(F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), variant, F.substring(digest, 18, 15))


def stable_id(prefix: str, namespace: uuid.UUID, *parts: Column) -> Column:
    """prefix_ and the version 5 UUID of the parts as text, joined by U+001F; a null part is the text None."""
    texts = [F.coalesce(p.cast("string"), F.lit("None")) for p in parts]
    return F.concat(F.lit(prefix + "_"), uuid5_hex(namespace, F.concat_ws("\x1f", *texts)))


def stable_rank(seed: int | str, label: str, key: Column) -> Column:
    """SHA-256 hex of seed, label and key with zero bytes between: an order that a rerun repeats."""
    zero = F.decode(F.unhex(F.lit("00")), "UTF-8")
    return F.sha2(F.concat(F.lit(str(seed)), zero, F.lit(label), zero, key.cast("string")).cast("binary"), 256)


def hash_percent(seed: int | str, key: Column) -> Column:
    """A number from 0 to 99 from the first 8 hex digits of the SHA-256 of seed, a zero byte and key."""
    zero = F.decode(F.unhex(F.lit("00")), "UTF-8")
    digest = F.sha2(F.concat(F.lit(str(seed)), zero, key.cast("string")).cast("binary"), 256)
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100).cast("int")


def split_name(percent: Column, train: int = 60, dev: int = 20) -> Column:
    return F.when(percent < train, "train").when(percent < train + dev, "validation").otherwise("test")


def canonical_json(**fields: Column) -> Column:
    """JSON with sorted keys, no spaces and explicit nulls; for text, whole numbers, booleans and arrays of them."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def cache_key(**fields: Column) -> Column:
    """SHA-256 of the canonical JSON of what makes a request the same request."""
    return F.sha2(canonical_json(**fields).cast("binary"), 256)


def path_image_id(sha256: Column, path: Column) -> Column:
    """The first 16 digits of the content's digest and the first 10 of its path's SHA-1."""
    return F.concat_ws("-", F.substring(sha256, 1, 16), F.substring(F.sha1(path.cast("binary")), 1, 10))


def utc_now() -> Column:
    """The time at which the query began, in UTC, as 2024-01-02T03:04:05.678901+00:00 (M-1)."""
    return F.concat(F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
