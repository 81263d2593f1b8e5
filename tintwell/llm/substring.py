"""Repeated word windows found by level-wise doubling, and the text that is left without them.

The shortest windows are looked up at a part of all places: each window of the final length has one place in it, the
least by hash among its shortest windows (its anchor), that it shares with every copy of itself. Anchors whose shortest
window occurs once in the corpus cannot lie in a repeated window. The others are extended to twice the length, again and
again, until none survives or the final length is reached, where every window of a surviving anchor is compared by a
128-bit hash and all but its first occurrence are marked. Texts are dealt by id once and stay where they are; what
survives is sent to them, and nothing is compared pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintwell.llm import units
from tintwell.operators.scratch import bounded_batches, bucketed, drop, staged

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_HALF = 2**32


def words_of(text: str | None) -> list[bytes]:
    """Words between runs of ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` words from each place on; two windows of half the length make one, so size is c * 2**k."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    if size % 2 == 0:
        half = windows(h, size // 2)
        return _mix(half[: len(half) - size // 2] * _A + (half[size // 2 :] ^ _C))
    x = _mix(h * _C + np.uint64(1))
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = _mix(out * _A + x[k : k + len(out)])
    return out


def anchors(short: np.ndarray, per_window: int) -> np.ndarray:
    """For each final window, the place of the least of its per_window shortest windows, the first among equals."""
    if len(short) < per_window:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(short, per_window)
    return np.concatenate([view[at : at + 65536].argmin(1) for at in range(0, len(view), 65536)]) + np.arange(len(view))


class _Words:
    """The words of some texts, one text behind the other: two independent 64-bit hashes each, and the text of each."""

    def __init__(self, texts: pa.Array):
        self.known, self.numbers, self.cuts = units.words(texts)
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.known)), ">u8").astype(np.uint64).reshape(-1, 2)
        self.one, self.two = both[self.numbers, 0], both[self.numbers, 1]
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.cuts))
        self.end = self.cuts[1:][self.text]

    def places(self, lists: pa.Array) -> np.ndarray:
        """Where the places, given as a list for each text, are among all words."""
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(self.cuts[:-1], n)

    def anchored(self, base: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, anchor) of every window that lies within one text."""
        if len(self.one) < window:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.flatnonzero(self.end[: len(self.one) - window + 1] >= np.arange(window, len(self.one) + 1))
        return first, anchors(windows(self.one, base), window - base + 1)[first]


def _single(keys: np.ndarray) -> np.ndarray:
    """1 for keys that stand alone; of others, 2 for the first, which stands for all in a count, and 3 for the rest."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.r_[True, k[1:] != k[:-1]][: len(k)]
    several = ~new | ~np.r_[new[1:], True][: len(k)]
    out = np.empty(len(k), np.int8)
    out[order] = np.where(several, np.where(new, 2, 3), 1)
    return out


def _looked_up(texts: DataFrame, id_type: str, find: Callable[[_Words, pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]], label: str) -> DataFrame:
    """(id, place) of what find tells, as (keys, texts, places), where its key occurs more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(k, t + at, p) for at, some in units.parts(batch.column(1)) for k, t, p in [find(_Words(some), batch.slice(at, len(some)))]]
            keys, texts, places = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.int64),) * 3
            met, ids = _single(keys), batch.column(0)
            for at in range(0, len(keys), 50_000):
                s = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[s].view(np.int64)), ids.take(pa.array(texts[s])), pa.array(places[s].astype(np.int32)), pa.array(met[s])], names=["h", "id", "place", "n"])

    found = staged(bounded_batches(texts).mapInArrow(run, f"h bigint, id {id_type}, place int, n tinyint"), label)
    total = F.count(F.lit(1)).over(Window.partitionBy("h"))
    met = found.where("n < 3").withColumn("all", total).where("all > 1 or n = 2").select("id", "place")
    kept = staged(met.unionByName(found.where("n = 3").select("id", "place")), f"repeated-{label}")
    drop(found)
    return kept


def _beside(texts: DataFrame, marks: DataFrame, how: str = "inner") -> DataFrame:
    """texts with what belongs to each id; texts stay where they are, and the other side is small beside them."""
    return texts.join(marks.hint("shuffle_hash"), "id", how)


def _by_document(kept: DataFrame) -> DataFrame:
    return kept.groupBy("id").agg(F.collect_set("place").alias("places"))  # no more than a document has words


def repeated_windows(texts: DataFrame, window: int = 20, base: int = 5) -> DataFrame:
    """(id, place, n) for texts (id, text): n windows in a row, from word `place` on, that also start earlier in the corpus.

    Earlier is a smaller id, or an earlier place in the same document. window is base times a power of two. No id is null.
    Rows that share an id do not count against each other at the same place.
    """
    if base < 2 or window % base or (window // base) & (window // base - 1):
        raise ValueError("window must be base times a power of two")
    kind = texts.schema["id"].dataType.simpleString()

    def shortest(words: _Words, _: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.unique(words.anchored(base, window)[1])
        return windows(words.one, base)[at], words.text[at], at - words.cuts[words.text[at]]

    def extended(words: _Words, batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both windows of `size` words that an anchor begins or ends, where they lie within its text."""
        at, h = words.places(batch.column(2)), windows(words.one, size)
        firsts, places = np.concatenate([at, at - (size - base)]), np.concatenate([at, at])
        text = words.text[places]
        fits = (firsts >= words.cuts[text]) & (firsts + size <= words.cuts[text + 1])
        return h[firsts[fits]], text[fits], (places - words.cuts[text])[fits]

    kept, size = _looked_up(texts.select("id", "text"), kind, shortest, "anchors"), 2 * base
    while size < window:
        longer = _looked_up(_beside(texts, _by_document(kept)).select("id", "text", "places"), kind, lambda w, b, size=size: extended(w, b, size), f"of-{size}")
        drop(kept)
        kept, size = longer, 2 * size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            rank = pc.rank(ids, tiebreaker="dense").to_numpy().astype(np.int64)
            parts = []
            for at, some in units.parts(batch.column(1)):
                words = _Words(some)
                own = np.zeros(len(words.one) + 1, bool)
                own[words.places(batch.column(2).slice(at, len(some)))] = True
                first, anchor = words.anchored(base, window)
                p = first[own[anchor]]
                parts.append((windows(words.one, window)[p], windows(words.two, window)[p], words.text[p] + at, p - words.cuts[words.text[p]]))
            h, g, text, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            if not len(h):
                continue
            where = rank[text] * _HALF + place
            order = np.lexsort((where, g, h))
            new = np.r_[True, (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])]
            least = where[order][np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
            first = np.zeros(len(h), bool)
            first[order] = where[order] == least
            n = np.zeros(len(h), np.int32)
            again = np.flatnonzero(~first)  # an earlier one is here, whatever else the corpus holds
            if len(again):
                start = np.r_[True, (text[again][1:] != text[again][:-1]) | (place[again][1:] != place[again][:-1] + 1)]
                n[again[start]] = np.diff(np.r_[np.flatnonzero(start), len(again)])
                first[again[start]] = True
            show = np.flatnonzero(first)
            for at in range(0, len(show), 50_000):
                s = show[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(h[s].view(np.int64)), pa.array(g[s].view(np.int64)), ids.take(pa.array(text[s])), pa.array(place[s].astype(np.int32)), pa.array(n[s])], names=["h", "g", "id", "place", "n"])

    found = staged(bounded_batches(_beside(texts, _by_document(kept)).select("id", "text", "places")).mapInArrow(run, f"h bigint, g bigint, id {kind}, place int, n int"), "windows")
    drop(kept)
    earlier = F.rank().over(Window.partitionBy("h", "g").orderBy("id", "place"))
    later = found.where("n = 0").withColumn("r", earlier).where("r > 1").select("id", "place", F.lit(1).alias("n"))
    marks = staged(later.unionByName(found.where("n > 0").select("id", "place", "n")), "marks")
    drop(found)
    return marks


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, base: int = 5) -> DataFrame:
    """(id, n_words, n_removed, kept_text) of every row: its text without words in a window that also starts earlier.

    Windows are judged on the input. Kept words are joined by one space. A null text has no words and an empty kept text.
    A row with a null id keeps all its words, and they count against no other. Ids are of any type that can be ordered.
    Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = bucketed(rows.where("id is not null"), "id", "texts")
    marks = repeated_windows(texts, window, base).groupBy("id").agg(F.collect_list(F.struct("place", "n")).alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, some in units.parts(batch.column(1)):
                words, marks = _Words(some), batch.column(2).slice(at, len(some))
                flat = marks.flatten()
                per = pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False)
                first = flat.field("place").to_numpy().astype(np.int64) + np.repeat(words.cuts[:-1], per)
                end = first + flat.field("n").to_numpy() + window - 1
                edge = np.bincount(first, minlength=len(words.one) + 1).astype(np.int64) - np.bincount(end, minlength=len(words.one) + 1)
                kept = np.cumsum(edge)[:-1] == 0
                left = np.append(0, np.cumsum(kept))[words.cuts]
                values = pa.array(words.known, pa.binary()).take(pa.array(words.numbers[kept]))
                text = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), values), b" ")
                total = np.diff(words.cuts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), pa.array(total), pa.array(total - np.diff(left)), text], names=[id_col, "n_words", "n_removed", "kept_text"])

    kind = docs.schema[id_col].dataType.simpleString()
    made = f"`{id_col}` {kind}, n_words bigint, n_removed bigint, kept_text binary"
    whole = rows.where("id is null").withColumn("marks", F.lit(None).cast("array<struct<place: int, n: int>>"))
    some = bounded_batches(_beside(texts, marks, "left").select("id", "text", "marks")).mapInArrow(run, made).unionByName(bounded_batches(whole).mapInArrow(run, made))
    return some.withColumn("kept_text", F.col("kept_text").cast("string"))


def digests(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return rows.select(id_col, "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: dict[int, str | None], window: int = 20) -> dict[int, tuple[int, int, str]]:
    """The same by definition, for small inputs: id -> (n_words, n_removed, kept_sha256)."""
    seen: set[tuple[bytes, ...]] = set()
    out = {}
    for doc in sorted(texts):
        words = words_of(texts[doc])
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = [w for i, w in enumerate(words) if i not in gone]
        out[doc] = (len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out
