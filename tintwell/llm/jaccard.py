"""Near copies by the Jaccard similarity of word shingles: MinHash bands propose pairs, whole shingle sets decide.

Only components are asked for, so a pair that is connected already is never compared. A band that few texts share is
joined with itself. In a crowded band every text is first compared with one pivot, the text with the most crowded company.
What neither that nor the small bands have connected is then compared, in blocks, with all texts that it shares crowded
bands with; each block tells one link to a component at most. So all links between components are found, and rows do not
grow with the square of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintwell.operators.graph import components
from tintwell.operators.scratch import bounded_batches, drop, staged

#: A pair of similarity s shares a band with probability 1 - (1 - s^ROWS)^BANDS: 0.99997 at 0.8.
BANDS, ROWS, SEED = 20, 4, 43
_rng = np.random.default_rng(SEED)
_TIMES, _PLUS = (_rng.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64) for _ in range(2))
_TIMES |= np.uint64(1)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text, words as in simhash; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    parts = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in parts], np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit key a band, from the smallest of each permutation over all shingles."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[None, at : at + 2048] * _TIMES + _PLUS).min(1), out=least)
    raw = least.astype("<u8").tobytes()
    size = 8 * ROWS
    return [int.from_bytes(xxhash.xxh64_digest(raw[k * size : (k + 1) * size], k), "big", signed=True) for k in range(BANDS)]


def _mark(hashes: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh64_digest(hashes.tobytes(), SEED), "big", signed=True)


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int, whole: bool) -> DataFrame:
    """(id, mark, keys) of every row with words: a digest of the shingle set, and its bands or, with whole, the set itself.

    The set is one of 32-bit hashes: of n shingles about n * n / 2**33 fall on another one, too few to move a similarity.
    """
    kind_of = pa.int32() if whole else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), width) for t in batch.column(1)]
            keys = [np.unique(s >> np.uint64(32)).astype(np.uint32).view(np.int32) if whole else bands(s) if len(s) else [] for s in sets]
            marks = pa.array([_mark(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), marks, pa.array(keys, pa.list_(kind_of))], names=[id_col, "mark", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return bounded_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, mark bigint, keys array<{'int' if whole else 'bigint'}>").where("mark is not null")


def _paired(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Pairs (u, v) of marks that share a value of ``on`` and are in different components."""
    side = lambda rows, k: rows.select(on, F.col("mark").alias(k), F.col("root").alias(f"root_{k}"))
    return side(a, "u").join(side(b, "v"), on).where("u > v and root_u <> root_v").select("u", "v").distinct()


def _verified(pairs: DataFrame, full: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) of marks whose whole shingle sets are similar."""
    side = lambda k: full.select(F.col("mark").alias(k), F.col("keys").alias(f"keys_{k}"))
    shared = F.size(F.array_intersect("keys_u", "keys_v"))
    near = pairs.join(side("u"), "u").join(side("v"), "v").withColumn("shared", shared)
    return near.where(F.col("shared") >= F.lit(least) * (F.size("keys_u") + F.size("keys_v") - F.col("shared")) - 1e-9).select("u", "v")


def _rooted(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """rows with the component of each mark by the edges."""
    roots = components(edges).withColumnRenamed("node", "mark")
    return rows.join(roots, "mark", "left").withColumn("root", F.coalesce("root", "mark"))


def compare_blocks(asked: list[dict], held: list[dict], least: float) -> list[tuple[int, int]]:
    """(u, v): for each mark asked and each other component among those held, the first mark that is similar, if any."""
    sizes = np.array([len(h["keys"]) for h in held])
    flat = np.concatenate([np.array(h["keys"], np.int64) for h in held])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(held)), sizes)[order]
    marks, roots = np.array([h["mark"] for h in held]), np.array([h["root"] for h in held])
    out = []
    for a in asked:
        keys = np.array(a["keys"], np.int64)
        first, end = np.searchsorted(flat, keys, "left"), np.searchsorted(flat, keys, "right")
        n = end - first
        met = owner[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        shared = np.bincount(met, minlength=len(held))
        near = np.flatnonzero((roots != a["root"]) & (shared >= least * (sizes + len(keys) - shared) - 1e-9))
        out += [(a["mark"], int(marks[near[k]])) for k in np.unique(roots[near], return_index=True)[1]]
    return out


def _blocks(crowd: DataFrame, full: DataFrame, least: float, asked: int = 100_000, held: int = 400_000) -> DataFrame:
    """Links (u, v) from each mark of crowd (group, mark, root) outside its group's largest component to the other components.

    Blocks hold about ``asked`` shingles of such marks, and about ``held`` of all marks of the group.
    """
    rows = staged(crowd.join(full, "mark").select("group", "mark", "root", "keys"), "crowds")
    per = rows.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("keys")).alias("size"))
    top = per.groupBy("group").agg(F.max(F.struct("n", "size", "root")).alias("top"), F.sum("n").alias("n"), F.sum("size").alias("size")).where("n > top.n")
    n_asked, n_held = F.ceil((F.col("size") - F.col("top.size")) / asked), F.ceil(F.col("size") / held)
    top = staged(top.select("group", F.col("top.root").alias("largest"), n_asked.alias("n_asked"), n_held.alias("n_held")), "open-crowds")
    open_rows = rows.join(top, "group")

    def dealt(some: DataFrame, into: str, name: str) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit(into), "mark"), F.col(into))
        return some.groupBy("group", at.alias("at")).agg(F.collect_list(F.struct("mark", "root", "keys")).alias(name)).drop("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = compare_blocks(row["asked"], row["held"], least)
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    both = dealt(open_rows.where("root <> largest"), "n_asked", "asked").join(dealt(open_rows, "n_held", "held"), "group").select("asked", "held")
    return bounded_batches(both).mapInArrow(run, "u bigint, v bigint")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, bucket: int = 32) -> DataFrame:
    """Edges (u, v) of ids whose texts have a Jaccard similarity of at least ``least`` of their whole shingle sets.

    They connect all that the pairs of texts which share a band and are so similar connect; of two texts that are connected
    without it, the link may be missing. Rows with equal sets are one node, named by its smallest id and linked to it. Rows
    without an id or words have no links. ``bucket`` says which bands are crowded; it changes no component.
    """
    rows = staged(_sketches(docs, id_col, text_col, width, False).where(F.col(id_col).isNotNull()), "sketches")
    each = staged(rows.groupBy("mark").agg(F.min(id_col).alias("id"), F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n")), "sets")
    same = rows.select(id_col, "mark").join(each.where("n > 1").select("mark", "id"), "mark").where(F.col(id_col) != F.col("id"))
    equal = staged(same.select(F.col(id_col).alias("u"), F.col("id").alias("v")), "equal")
    drop(rows)
    dealt = each.select("mark", F.explode("keys").alias("key"))
    shared = staged(dealt.join(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key"), "bands")
    wanted = staged(shared.select("mark").distinct().join(each.select("mark", "id"), "mark"), "wanted")
    drop(each)
    texts = docs.select(F.col(id_col).alias("id"), text_col).join(wanted.select("id"), "id", "left_semi")
    full = _sketches(texts, "id", text_col, width, True).join(wanted, ["id", "mark"]).groupBy("mark").agg(F.first("keys").alias("keys"))
    full = staged(full, "shingles")
    crowd = shared.where(f"n > {bucket}")
    company = crowd.groupBy("mark").agg(F.sum("n").alias("company"))
    pivots = crowd.join(company, "mark").groupBy("key").agg(F.max(F.struct("company", "mark"))["mark"].alias("pivot"))
    starred = staged(crowd.join(pivots, "key").where("mark <> pivot").select("mark", "pivot").distinct(), "pivots")
    near = staged(_verified(starred.select(F.col("mark").alias("u"), F.col("pivot").alias("v")), full, least), "near-pivots")
    few = staged(_rooted(shared.where(f"n <= {bucket}").select("mark", "key"), near), "small-bands")
    drop(shared)
    mixed = few.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    few = few.join(mixed, "key")
    near = staged(near.unionByName(_verified(_paired(few, few, "key"), full, least)), "near")
    # Marks that share crowded bands, directly or over others, are one group.
    groups = components(starred.select(F.col("mark").alias("u"), F.col("pivot").alias("v"))).select(F.col("node").alias("mark"), F.col("root").alias("group"))
    near = staged(near.unionByName(_blocks(_rooted(groups, near), full, least)), "all-near")
    drop(full)
    ids = wanted
    named = near.join(ids.withColumnRenamed("mark", "u").withColumnRenamed("id", "id_u"), "u").join(ids.withColumnRenamed("mark", "v").withColumnRenamed("id", "id_v"), "v")
    return named.select(F.col("id_u").alias("u"), F.col("id_v").alias("v")).unionByName(equal)
