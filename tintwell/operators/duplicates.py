"""Exact duplicate groups, Hamming pairs of 64-bit hashes and their components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tintwell.operators.graph import components
from tintwell.operators.ranking import numbered
from tintwell.operators.scratch import ship


def exact_groups(df: DataFrame, key: str, member: str, runs: int = 64) -> DataFrame:
    """Members of keys with at least two of them: group number in key order, anchor and position (A-13).

    A key may hold a large part of all rows. Its rows are dealt over `runs` by a hash of the member, summed up run by run,
    and meet their group's values on (key, run), so no task sees all of them.
    """
    dealt = df.withColumn("_run", F.pmod(F.xxhash64(F.lit("run"), F.col(member)), F.lit(runs)).cast("int"))
    low = dealt.groupBy(key, "_run").agg(F.count(F.lit(1)).alias("_n"), F.min(member).alias("_least"))
    top = low.groupBy(key).agg(F.sum("_n").alias("group_size"), F.min("_least").alias("anchor")).where("group_size > 1")
    named = numbered(top, [key], "group_number")
    spread = low.select(key, "_run").join(named, key)
    return dealt.join(spread, [key, "_run"]).select("group_number", key, member, "group_size", "anchor", (F.col(member) == F.col("anchor")).alias("is_anchor"))


def star_pairs(groups: DataFrame, member: str) -> DataFrame:
    """(anchor, member) for every member but the anchor."""
    return groups.where(~F.col("is_anchor")).select(F.col("anchor").alias("left_id"), F.col(member).alias("right_id"))


def hash_long(hex16: Column) -> Column:
    """A signed long of 16 hex digits."""
    return F.conv(hex16, 16, -10).cast("bigint")


def hamming_links(values: DataFrame, value: str, within: int, agree: int = 2) -> DataFrame:
    """(a, b, distance) for distinct 64-bit values a < b that differ in 1 to `within` bits (J-17).

    The bits are cut into within + agree bands, so such a pair has at least `agree` whole bands in common: values are
    dealt by each choice of `agree` bands together and compared, in blocks, with those that share it. A pair is given
    where its first common bands are the chosen ones, so it is given once.
    """
    bands = within + agree
    edges = [64 * k // bands for k in range(bands + 1)]
    masks = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(bands)]
    choices = list(combinations(range(bands), agree))
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    distinct = values.select(F.col(value).cast("bigint").alias("_v")).where("_v IS NOT NULL").distinct()
    keys = F.array(*(F.struct(F.lit(n).alias("_k"), F.col("_v").bitwiseAND(F.lit(signed(sum(masks[k] for k in chosen))).cast("bigint")).alias("_part")) for n, chosen in enumerate(choices)))
    dealt = distinct.select("_v", F.inline(keys)).select("_k", "_part", "_v")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, v, lengths in _runs(batches):
            for a, b in _close(v, lengths, within):
                bits = v[a] ^ v[b]
                common = np.zeros(len(a), np.int64)
                for n, mask in enumerate(masks):  # of the bands up to the last chosen one, the chosen ones alone are common
                    common += (bits & np.uint64(mask) == 0) & (n <= last[k[a]])
                a, b, bits = (x[common == agree] for x in (v[a].view(np.int64), v[b].view(np.int64), bits))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(np.bitwise_count(bits).astype(np.int32))], names=["a", "b", "distance"])

    last = np.array([chosen[-1] for chosen in choices])
    ship(values.sparkSession)
    return dealt.repartition("_k", "_part").sortWithinPartitions("_k", "_part").mapInArrow(near, "a bigint, b bigint, distance int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Choices, values and lengths of whole runs of one (_k, _part), of rows sorted by them."""
    held: list[np.ndarray] = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    parts: list[list[np.ndarray]] = []
    lengths = lambda k, p: np.diff(np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (p[1:] != p[:-1]), [True]])))
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if len(held[0]) and (held[0][-1], held[1][-1]) == (now[0][-1], now[1][-1]) and held[0][0] == held[0][-1] and held[1][0] == held[1][-1]:
            parts.append(now)  # all of one long run
            continue
        k, p, v = (np.concatenate([h, *(x[n] for x in parts), now[n]]) for n, h in enumerate(held))
        parts = []
        cut = len(k) - lengths(k, p)[-1]
        if cut:
            yield k[:cut], v[:cut].view(np.uint64), lengths(k[:cut], p[:cut])
        held = [k[cut:], p[cut:], v[cut:]]
    k, p, v = (np.concatenate([h, *(x[n] for x in parts)]) for n, h in enumerate(held))
    if len(k):
        yield k, v.view(np.uint64), lengths(k, p)


def _close(v: np.ndarray, lengths: np.ndarray, within: int, long: int = 64, block: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of one run whose values differ in at most `within` bits, about `block` comparisons at a time."""
    starts = np.cumsum(lengths) - lengths
    for at, n in zip(starts[lengths > long], lengths[lengths > long], strict=True):
        for right in range(0, n, 4096):
            far = v[at + right : at + min(n, right + 4096)]
            rows = max(1, block // len(far))
            for left in range(0, right + len(far), rows):
                near = v[at + left : at + min(left + rows, right + len(far))]
                a, b = np.nonzero(np.bitwise_count(near[:, None] ^ far[None, :]) <= within)
                a, b = a + left, b + right
                yield at + a[a < b], at + b[a < b]
    short = lengths <= long
    ends = np.repeat((starts + lengths)[short], lengths[short])
    place = np.flatnonzero(np.repeat(short, lengths))
    for d in range(1, long):
        keep = place + d < ends
        place, ends = place[keep], ends[keep]
        if not len(place):
            break
        a = place[np.bitwise_count(v[place] ^ v[place + d]) <= within]
        yield a, a + d


def hamming_pairs(df: DataFrame, key: str, value: str, within: int) -> DataFrame:
    """Every pair of rows left_id < right_id whose values differ in at most `within` bits.

    Rows of one value are all paired with each other, so this is for values that few rows share; hamming_edges keeps
    such groups as stars. No side is broadcast: all grow with the rows.
    """
    ids = df.select(F.col(key).alias("_id"), F.col(value).alias("_v")).where("_v IS NOT NULL")
    near = hamming_links(df, value, within)
    near = near.unionByName(ids.select(F.col("_v").alias("a"), F.col("_v").alias("b"), F.lit(0).alias("distance")).distinct())
    pairs = near.join(ids.toDF("_l", "a").hint("merge"), "a").join(ids.toDF("_r", "b").hint("merge"), "b").where("a <> b OR _l < _r")
    return pairs.select(F.least("_l", "_r").alias("left_id"), F.greatest("_l", "_r").alias("right_id"), "distance")


def hamming_edges(df: DataFrame, key: str, value: str, within: int) -> DataFrame:
    """Edges (left_id, right_id) that join the same rows as hamming_pairs: each row to the first of its value, and those of close values."""
    ids = df.select(F.col(key).alias("right_id"), F.col(value).alias("_v")).where("_v IS NOT NULL")
    first = ids.groupBy("_v").agg(F.min("right_id").alias("left_id"))
    stars = ids.join(first.hint("merge"), "_v").where("left_id <> right_id").select("left_id", "right_id")
    near = hamming_links(df, value, within).join(first.toDF("a", "_l").hint("merge"), "a").join(first.toDF("b", "_r").hint("merge"), "b")
    return stars.unionByName(near.select(F.least("_l", "_r").alias("left_id"), F.greatest("_l", "_r").alias("right_id")))


def duplicate_class(distance: Column) -> Column:
    return F.when(distance <= 4, "high").when(distance <= 8, "possible").otherwise("outside_current_threshold")


def content_groups(nodes: DataFrame, key: str, *edges: DataFrame) -> DataFrame:
    """Every node with the smallest node it reaches over all edges (left_id, right_id) (A-15)."""
    every = edges[0].select("left_id", "right_id")
    for more in edges[1:]:
        every = every.unionByName(more.select("left_id", "right_id"))
    roots = components(every.select(F.col("left_id").alias("u"), F.col("right_id").alias("v")))
    return nodes.select(key).join(roots.withColumnRenamed("node", key).hint("merge"), key, "left").select(key, F.coalesce("root", key).alias("component_id"))
