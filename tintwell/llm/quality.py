"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of word shapes, hashed words and bands of a few ratios. A truncated SVD of the weighted counts of a
bounded sample of labelled texts gives the latent space. The sample's vectors are broadcast; each document is compared
with all of them by blocked matrix products, and the labels of its nearest ones are averaged by their cosine.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tintwell.llm.sampling import bounded, held_out
from tintwell.llm.units import REMEMBERED
from tintwell.operators.scratch import bounded_batches

SHAPES, WORDS, BANDS = 768, 768, 64
FEATURES, MEMO = SHAPES + WORDS + BANDS, 150_000


class _Memo(dict):
    """word -> 1 << 32 if its core is letters alone | shape id << 16 | word id."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        shape, before = [], ""
        for c in word:
            kind = "a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "x" if c.isalpha() else c
            if kind != before:
                shape.append(kind)
            before = kind
        core = word.strip(".,;:!?\"'()").lower()
        found = (core.isalpha() << 32) | zlib.crc32("".join(shape).encode("utf-8", "surrogatepass")) % SHAPES << 16 | zlib.crc32(core.encode("utf-8", "surrogatepass")) % WORDS
        if len(word) <= REMEMBERED:
            self[word] = found
        return found


_memo = _Memo()


def features(text: str | None) -> np.ndarray:
    """Feature counts of a whole text, as logarithms; bands are filled for every text, the empty one included."""
    text = text or ""
    words = text.split()
    n = len(words)
    both = np.fromiter(map(_memo.__getitem__, words), np.int64, n)
    cores = both & 0xFFFF
    out = np.zeros(FEATURES, np.float32)
    out[:SHAPES] = np.bincount(both >> 16 & 0xFFFF, minlength=SHAPES)
    out[SHAPES : SHAPES + WORDS] = np.bincount(cores, minlength=WORDS)
    np.log1p(out, out=out)
    ids = np.unique(both)
    again = float((cores[1:] == cores[:-1]).mean()) if n > 1 else 0.0
    lines = text.split("\n")
    letters = float((both >> 32).mean()) if n else 0.0
    ratios = (again**0.5, (1 - len(set(lines)) / len(lines)) ** 0.5, 1 - len(ids) / n ** 0.9 if n else 1.0, letters, min(1.0, len(text) / max(1, n) / 20))
    bands = out[SHAPES + WORDS :]
    for k, r in enumerate(ratios):
        bands[8 * k + min(7, max(0, int(8 * r)))] = 2.0
    bands[40 + min(20, n.bit_length())] = 1.0
    return out


@dataclass
class Voter:
    """idf: weight of each feature; basis: features x rank; vectors: sample x rank, of length 1; labels: 0.0 or 1.0."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        z = x @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray, block: int = 256) -> np.ndarray:
        """Between 0 and 1; 0.5 where nothing was learned or no neighbour is at a positive cosine.

        Labelled texts at the cosine of the last neighbour have an equal share in the places that are left, so the order
        of the sample decides nothing.
        """
        out = np.full(len(counts), 0.5)
        n = len(self.labels)
        k = min(self.neighbours, n)
        for at in range(0, len(counts) if k else 0, block):
            cos = self.latent(counts[at : at + block]) @ self.vectors.T
            last = np.partition(cos, n - k, axis=1)[:, n - k, None]
            nearer, equal = cos > last, cos == last
            weight = np.where(nearer, np.maximum(cos, 0), 0).astype(np.float64)
            rest = (k - nearer.sum(1)) * np.maximum(last[:, 0], 0)  # places that those at the last one's cosine share
            total, vote = weight.sum(1) + rest, weight @ self.labels + rest * (equal @ self.labels) / equal.sum(1)
            out[at : at + block] = np.where(total > 0, np.clip(vote / np.maximum(total, 1e-12), 0, 1), 0.5)
        return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 1500, rank: int = 48, neighbours: int = 25) -> Voter:
    """Learn from at most about 2 * per_class labelled rows of each label outside the held-out fold.

    Rows of labels with a null id or label are left out; of repeated ones the mean label counts, from 0.5 on as 1. Of
    documents that share an id, the least text counts. Without any labelled text every score is 0.5.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
    sample = F.broadcast(bounded(known, "_label", id_col, per_class))  # its rows are bounded by per_class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [features(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["label", "f"])

    texts = docs.select(id_col, text_col).join(sample, id_col).groupBy(id_col).agg(F.first("_label").alias("_label"), F.min(text_col).alias(text_col))
    got = bounded_batches(texts.select("_label", text_col)).mapInArrow(run, "label int, f binary").collect()  # no more rows than the sample
    y = np.array([r["label"] for r in got], np.float64)
    x = np.frombuffer(b"".join(bytes(r["f"]) for r in got), np.float32).reshape(len(got), FEATURES)
    if not len(y):
        empty = np.zeros((0, 1), np.float32)
        return Voter(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), empty, y, neighbours)
    order = sorted(range(len(y)), key=lambda i: (x[i].tobytes(), y[i]))  # rows arrive in any order
    x, y = x[order], y[order]
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    w = x * idf
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
    values, vectors = np.linalg.eigh((w.T @ w).astype(np.float64))
    basis = vectors[:, ::-1][:, :rank].astype(np.float32)
    voter = Voter(idf, basis, np.zeros((0, rank), np.float32), y, neighbours)
    voter.vectors = voter.latent(x)
    return voter


def score(docs: DataFrame, voter: Voter, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns of docs with score and predicted added; predicted is 1 if score >= threshold, else 0.

    Only the text is an input; a null text counts as empty. The voter, whose size its sample bounds, is broadcast. Columns
    of docs named score or predicted are replaced; repeated rows get equal scores.
    """
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ("score", "predicted")))
    shared = docs.sparkSession.sparkContext.broadcast(voter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [features(t) for t in part.column(text_col).to_pylist()]
                s = shared.value.scores(np.stack(rows))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=[*part.schema.names, "score", "predicted"])

    return bounded_batches(docs).mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))
