"""SentencePiece (merge type) encoding with seeded merge-dropout, and decoding.

Pairs of neighbouring symbols whose join is a piece form an agenda, best score first, leftmost among equals. The t-th
candidate that comes up is skipped for good when a keyed hash of t falls below the dropout rate. The key takes the seed,
the document and the place of the unit of text in it, so that every occurrence of a word is drawn anew and a run can be
repeated anywhere. What a unit becomes depends on which candidates were skipped alone; that is remembered as a tree, and
all occurrences in a batch walk down it together. With rate 0 the result is the library's own encoding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tintwell.llm import units
from tintwell.llm.tables import mix
from tintwell.llm.token_counts import LITERAL, SPACE, PieceModel, piece_model
from tintwell.operators.scratch import bounded_batches

NODES, LONG = 400_000, 48
_ALL = 2**64 - 1
_TURN = np.uint64(0x9E3779B97F4A7C15)
_codecs: dict[tuple, Codec] = {}


class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.size = np.zeros(4096, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.held):
            wider = np.zeros(max(2 * len(self.held), self.size + len(more)), self.held.dtype)
            wider[: self.size] = self.held[: self.size]
            self.held = wider
        self.held[self.size : self.size + len(more)] = more
        self.size += len(more)


class Codec:
    """Encoder and decoder for one model, dropout rate and seed."""

    def __init__(self, path: str, dropout: float, seed: int):
        self.model: PieceModel = piece_model(path)
        self.dropout, self.seed = dropout, seed
        self.limit = np.uint64(min(2**64 - 1, int(dropout * 2.0**64)))
        spelt = [p.replace(SPACE, " ").encode("utf-8") for p in self.model.pieces]
        for b, i in enumerate(self.model.byte_ids):
            spelt[i] = bytes([b])
        self.spelt = pa.array(spelt, pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        """Node k is a unit and the turns at which it lost a candidate. Its child for turn t is at child_at[k] + t; -1: not made yet."""
        self.roots: dict[bytes, int] = {}
        self.seen: set[bytes] = set()
        self.nodes: list[tuple[str, tuple[int, ...]]] = []
        self.pool, self.child = _Grown(np.int32), _Grown(np.int32)
        self.starts, self.sizes, self.turns, self.child_at = _Grown(np.int64), _Grown(np.int64), _Grown(np.int16), _Grown(np.int64)

    def keys(self, documents: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The key of each unit, by its document's number and its place there; cuts: the first unit of each document, with the end."""
        own = mix((documents.astype(np.int64).view(np.uint64) ^ np.uint64(self.seed * 0x9E3779B97F4A7C15 & _ALL)) + np.uint64(1))
        n = np.diff(cuts)
        place = np.arange(len(n) and cuts[-1]) - np.repeat(cuts[:-1], n)
        return mix(np.repeat(own, n) ^ mix(place.astype(np.uint64) + np.uint64(1)))

    def skipped(self, key: np.ndarray, first: int, n: int) -> np.ndarray:
        """Whether a unit under the key loses its candidate at each of n turns."""
        return mix(key ^ mix(np.arange(first + 1, first + n + 1, dtype=np.uint64) * _TURN)) < self.limit

    def _loses(self, keys: np.ndarray, turn: int) -> np.ndarray:
        """Whether units lose their candidate at a turn."""
        return mix(keys ^ mix(np.array([turn + 1], np.uint64) * _TURN)) < self.limit

    def alone(self, unit: str, key: int) -> np.ndarray:
        """Ids of one unit of any length, by a heap."""
        return self.model.merger.one(unit, lambda first, n: self.skipped(np.uint64(key), first, n))

    def _add(self, nodes: list[tuple[str, tuple[int, ...]]]) -> None:
        flat, sizes, turns = self.model.merger.many([u for u, _ in nodes], [t for _, t in nodes])
        self.starts.add(self.pool.size + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.pool.add(flat)
        self.turns.add(turns)
        wide = turns.astype(np.int64)
        self.child_at.add(self.child.size + np.cumsum(wide) - wide)
        self.child.add(np.full(int(wide.sum()), -1, np.int32))
        self.nodes += nodes

    def pieces(self, known: list[bytes], numbers: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all occurrences, how many each has); occurrence k is the unit known[numbers[k]] under keys[k]."""
        if len(self.nodes) > NODES:
            self._forget()
        if len(self.seen) > NODES:
            self.seen.clear()
        text = lambda u: u.decode("utf-8", "surrogatepass").replace(" ", SPACE)
        found = list(map(self.roots.get, known))
        root, several = np.array([-1 if k is None else k for k in found], np.int64).reshape(len(known)), np.bincount(numbers, minlength=len(known)) > 1
        for k in np.flatnonzero(root == -1).tolist():
            u = known[k]
            if len(u) > LONG and (len(u) > 4 * LONG or len(text(u)) > LONG):
                root[k] = -3
            elif not several[k] and u not in self.seen:  # it may never come again
                self.seen.add(u)
                root[k] = -2
        new = np.flatnonzero(root == -1)
        root[new] = np.arange(len(self.nodes), len(self.nodes) + len(new))
        self.roots.update((known[k], int(root[k])) for k in new.tolist())
        self._add([(text(known[k]), ()) for k in new.tolist()])
        node = root[numbers]
        live, turn, direct = np.flatnonzero(node >= 0) if self.limit else np.zeros(0, np.int64), 0, [np.flatnonzero(node == -2)]
        while True:
            live = live[self.turns.held[node[live]] > turn]
            if not len(live):
                break
            hit = live[self._loses(keys[live], turn)]
            place = self.child_at.held[node[hit]] + turn
            after = self.child.held[place]
            if (after < 0).any():
                missing, at, times = np.unique(place[after < 0], return_index=True, return_counts=True)
                parents, more = node[hit[after < 0][at]], times > 1
                first = len(self.nodes)
                self._add([(u, (*ts, turn)) for u, ts in map(self.nodes.__getitem__, parents[more].tolist())])
                self.child.held[missing[more]] = np.arange(first, len(self.nodes))
                after = self.child.held[place]
                direct.append(hit[after < 0])
            node[hit] = after
            turn += 1
            live = live[node[live] >= 0]
        # What is met once is worked under its own key, without a node.
        alone, long = np.concatenate(direct), np.flatnonzero(root[numbers] == -3)
        lost = (lambda rows, turn: self._loses(keys[alone[rows]], turn)) if self.limit else None
        flat, n, _ = self.model.merger.many([text(known[k]) for k in numbers[alone].tolist()], lost=lost)
        made = [self.alone(text(known[numbers[k]]), int(keys[k])) for k in long.tolist()]
        node[alone], node[long] = 0, 0
        starts, sizes = self.starts.held[node], self.sizes.held[node]
        sizes[alone], sizes[long] = n, [len(m) for m in made]
        for some in (alone, long):
            starts[some] = np.cumsum(sizes[some]) - sizes[some] + (self.pool.size if some is alone else self.pool.size + len(flat))
        return units.spread(np.concatenate([self.pool.held[: self.pool.size], flat, *made]), starts, sizes), sizes

    def encode(self, texts: pa.Array, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where those of each begin, with the end), each text under its document's number; a null or empty text has none."""
        whole = pc.replace_substring(pc.fill_null(texts.cast(pa.binary()), b""), SPACE.encode(), LITERAL.encode("utf-8", "surrogatepass"))
        known, numbers, cuts = units.spaced_units(whole)
        ids, sizes = self.pieces(known, numbers, self.keys(documents, cuts))
        return ids, np.append(0, np.cumsum(sizes))[cuts]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> list[memoryview]:
        """The UTF-8 text of each encoding."""
        taken = self.spelt.take(pa.array(ids))
        ends, data = np.frombuffer(taken.buffers()[1], np.int64)[cuts].tolist(), memoryview(taken.buffers()[2] or b"")
        return [data[a + 1 : b] if b > a else data[:0] for a, b in zip(ends, ends[1:], strict=False)]  # without the space in front


def codec(path: str, dropout: float, seed: int) -> Codec:
    key = (path, dropout, seed)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode(docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", verify: bool = False) -> DataFrame:
    """(id, n_tokens, piece_ids) of every row, from its whole text.

    Candidates are skipped by seed, id and place in the text, so that equal words are encoded anew at each occurrence; rows
    without an id take their text for it.
    With verify, decoded_sha256 is the digest of what the pieces decode to, found in the same pass. A null or empty text
    has no pieces and decodes to the empty text. Repeated rows are encoded alike; null ids are returned as they come. Other columns
    are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path, dropout, seed)
        for batch in batches:
            for at, texts in units.parts(batch.column(1)):
                ids, cuts = c.encode(texts, batch.column(2).slice(at, len(texts)).to_numpy())
                columns, names = [batch.column(0).slice(at, len(texts)), pa.array(np.diff(cuts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))], [id_col, "n_tokens", "piece_ids"]
                if verify:
                    columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in c.decode(ids, cuts)], pa.string()))
                    names.append("decoded_sha256")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    number = F.xxhash64(F.lit(seed), F.when(F.col(id_col).isNull(), F.col(text_col).cast("string")), F.col(id_col)).alias("_number")
    return bounded_batches(docs.select(id_col, text_col, number)).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, piece_ids array<int>" + ", decoded_sha256 string" * verify)


def decode(rows: DataFrame, model_path: str, ids_col: str = "piece_ids", to: str = "text") -> DataFrame:
    """All columns of rows and the decoded text; null ids decode to null. A column named like the new one is replaced."""
    rows = rows.drop(*(c for c in rows.columns if c.lower() == to.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path, 0.0, 0)
        for batch in batches:
            lists = batch.column(ids_col)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = c.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.append(0, np.cumsum(n)))
            found = [None if gone else str(t, "utf-8", "surrogatepass") for t, gone in zip(texts, lists.is_null().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, to])

    return bounded_batches(rows).mapInArrow(run, StructType([*rows.schema.fields, StructField(to, StringType())]))
