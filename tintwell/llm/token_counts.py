"""Exact SentencePiece (merge type) token counts of every prefix, by dynamic programming over prefixes.

The encoding of a text is fixed by its last token and the encoding of what stands before it: a token may follow another
exactly if the two, encoded together, stay the two. So one pass gives, for every prefix, its last token and its number
of tokens, and each question about truncation or budget is a lookup. Units that no token crosses are worked once for all
places where they stand in a batch, and the counts of whole texts are put together from theirs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tintwell.llm import units
from tintwell.llm.merging import Merger
from tintwell.llm.tables import Table
from tintwell.operators.scratch import bounded_batches

SPACE, LITERAL, MEMO = "▁", "\udfff", 300_000
_UNITS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
_models: dict[str, PieceModel] = {}


class PieceModel:
    """Vocabulary of a merge-type SentencePiece model with byte fallback, and its merge rule.

    A text is cut into units that no piece crosses: a run of spaces with the word behind it, or a line break. That holds
    for vocabularies whose pieces have spaces at their start alone and no line breaks, which is checked here.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in normal}
        self.score = {self.pieces[i]: model.get_score(i) for i in normal}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids) or model.encode("  a b ", out_type=str) != model.encode(f"{SPACE}{SPACE}a{SPACE}b{SPACE}", out_type=str):
            raise ValueError("a piece crosses words or lines, or the model changes white space; units are not independent")
        # A piece that merging does not give back from its own text is never part of an encoding.
        every = Merger(self.ids, self.score, self.byte_ids, {})
        names = list(self.ids)
        _, n, _ = every.many(names)
        self.ids = {p: self.ids[p] for p, k in zip(names, n.tolist(), strict=True) if k == 1}
        #: A literal U+2581 in a text, which would be read as a space, is the lone surrogate LITERAL here.
        self.merger = Merger(self.ids, self.score, self.byte_ids, {LITERAL: SPACE.encode()})
        self.merger.parted(self.ids)
        #: The pieces read backwards, as a tree: (node << 21 | character) leads to a node, and a node may be a piece.
        steps: dict[int, int] = {}
        ends = {0: -1}
        for p, i in self.ids.items():
            node = 0
            for c in reversed(p):
                node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
            ends[node] = i
        self.steps = Table(len(steps))
        self.steps.put(np.fromiter(steps, np.int64, len(steps)), np.fromiter(steps.values(), np.int32, len(steps)))
        self.piece_at = np.full(len(steps) + 1, -1, np.int32)
        self.piece_at[list(ends)] = list(ends.values())
        self.longest = max(map(len, self.ids))
        self._follows = Table()
        self._counts: dict[bytes, bytes] = {}

    def follows(self, keys: np.ndarray) -> np.ndarray:
        """For keys left << 32 | right: whether the two pieces, encoded together, stay the two."""
        known = self._follows.get(keys)
        if (known < 0).any():
            new = np.unique(keys[known < 0])
            if self._follows.used > 8 * MEMO:
                self._follows = Table()
                new = np.unique(keys)
            self._follows.put(new, self.merger.stays(new >> 32, new & 0xFFFFFFFF).astype(np.int32))
            known = self._follows.get(keys)
        return known > 0

    def prefix_counts(self, some: list[str]) -> list[np.ndarray]:
        """For each unit: item i is the number of tokens of its first i + 1 characters."""
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        order = np.argsort(-sizes, kind="stable")
        code = np.frombuffer("".join([some[i] for i in order.tolist()]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = sizes[order]
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(code)) - np.repeat(starts, sizes)  # within the unit
        # All pieces that end at each character, shortest first.
        node, live, found = np.zeros(len(code), np.int64), np.arange(len(code)), []
        for size in range(1, self.longest + 1):
            live = live[place[live] >= size - 1]
            node[live] = self.steps.get(node[live] << 21 | code[live - size + 1])
            live = live[node[live] > 0]
            if not len(live):
                break
            pieces = np.full(len(code), -1, np.int32)
            pieces[live] = self.piece_at[node[live]]
            found.append(pieces)
        # Of a character outside the vocabulary each byte is a token, and nothing merges with it.
        unknown = found[0] < 0 if found else np.ones(len(code), bool)
        n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        counts, last = np.zeros(len(code), np.int32), np.full(len(code), -1, np.int64)
        for k in range(int(sizes[0]) if len(sizes) else 0):
            at = starts[: int(np.searchsorted(-sizes, -k, side="left"))] + k
            odd = at[unknown[at]]
            counts[odd] = n_bytes[odd] + (counts[odd - 1] if k else 0)
            at, settled = at[~unknown[at]], []
            for size in range(1, min(k + 1, len(found)) + 1):
                piece = found[size - 1][at]
                here = np.flatnonzero(piece >= 0)
                if not len(here):
                    continue
                own, piece = at[here], piece[here].astype(np.int64)
                if size == k + 1:
                    counts[own], last[own] = 1, piece
                    settled.append(here)
                    continue
                before = last[own - size]
                good = before < 0
                asked = np.flatnonzero(~good)
                good[asked] = self.follows(before[asked] << 32 | piece[asked])
                own, piece = own[good], piece[good]
                counts[own], last[own] = counts[own - size] + 1, piece
                settled.append(here[good])
            if len(np.unique(np.concatenate([np.zeros(0, np.int64), *settled]))) < len(at):
                raise AssertionError("a prefix has no encoding")
        ends = starts + sizes
        out: list[np.ndarray] = [counts] * len(some)
        for i, a, b in zip(order.tolist(), starts.tolist(), ends.tolist(), strict=True):
            out[i] = counts[a:b]
        return out

    @staticmethod
    def units(text: str) -> list[str]:
        """Units of a text; their concatenation is the text with its dummy space in front."""
        return _UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def _of_units(self, some: list[bytes]) -> list[bytes]:
        """prefix_counts of each unit, as 32-bit numbers."""
        own = [self._counts.get(u) for u in some]
        new = [k for k, v in enumerate(own) if v is None]
        if len(self._counts) + len(new) > MEMO:
            self._counts.clear()
        texts = [some[k].decode("utf-8", "surrogatepass").replace(" ", SPACE) for k in new]
        for k, counts in zip(new, self.prefix_counts(texts), strict=True):
            own[k] = got = counts.tobytes() if some[k] != b"\n" else b"\x01\0\0\0"
            if len(some[k]) <= units.REMEMBERED:
                self._counts[some[k]] = got
        return own

    def prefixes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(counts, edges): counts[edges[k] + i] is the exact number of tokens of the first i characters of text k."""
        known, numbers, cuts = units.spaced_units(pc.replace_substring(pc.fill_null(texts.cast(pa.string()), ""), SPACE, " "))
        own = self._of_units(known)
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        pool = np.frombuffer(b"".join(own), "<i4")
        starts = np.cumsum(sizes) - sizes
        totals = pool[starts + sizes - 1] if len(own) else pool
        so_far = np.append(0, np.cumsum(totals[numbers], dtype=np.int64))
        first = np.repeat(cuts[:-1], np.diff(cuts))  # the first unit of a unit's text
        before = (so_far[:-1] - so_far[first]).astype(np.int32)
        n = sizes[numbers]
        counts = units.spread(pool, starts[numbers], n) + np.repeat(before, n)
        # The first place of a text is the space in front of it alone, which stands for the empty prefix; empty texts have none.
        edges = np.append(0, np.cumsum(n))[cuts]
        counts[edges[:-1][np.diff(edges) > 0]] = 0
        empty = np.flatnonzero(np.diff(edges) == 0)
        return np.insert(counts, edges[empty], 0), edges + np.append(np.searchsorted(empty, np.arange(len(edges) - 1)), len(empty))

    def count(self, text: str | None) -> int:
        return self.text_prefix_counts(text)[-1]

    def text_prefix_counts(self, text: str | None) -> list[int]:
        """Item i: the exact number of tokens of text[:i], for i from 0 to the length of the text."""
        return self.prefixes(pa.array([text], pa.string()))[0].tolist()


def piece_model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def truncate(counts: list[int], limit: int) -> int:
    """Characters of the longest prefix with at most limit tokens, given its prefix counts (which need not ascend)."""
    return max((i for i, n in enumerate(counts) if n <= limit), default=0)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, prefixes: bool = False) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, chars_in_limit) of every row; with prefixes also prefix_tokens, the count of each prefix.

    Counts are those of the library for a merge-type model, for whole texts, without begin, end or added special tokens;
    special strings are ordinary text. chars_in_limit is the length in characters of the longest prefix with at most limit
    tokens, read from the counts of all prefixes. A null text counts as empty: 0 bytes and 0 tokens. Repeated rows and
    null ids are returned as they come; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for batch in batches:
            for at, texts in units.parts(batch.column(1)):
                counts, edges = model.prefixes(texts)
                n_tokens = counts[edges[1:] - 1]
                fits = np.where(counts <= limit, np.arange(len(counts)), -1)
                columns = [
                    batch.column(0).slice(at, len(texts)),
                    pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array(n_tokens > limit),
                    pa.array(np.maximum(np.maximum.reduceat(fits, edges[:-1]) - edges[:-1], 0), pa.int64()),
                ]
                if prefixes:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(counts, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "n_bytes", "n_tokens", "over_limit", "chars_in_limit", *["prefix_tokens"] * prefixes]
    kind = docs.schema[id_col].dataType.simpleString()
    more = ", prefix_tokens array<int>" if prefixes else ""
    return bounded_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, chars_in_limit bigint{more}")
