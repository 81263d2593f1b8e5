"""Language of texts and of the spans within them.

Scripts narrow the languages that a word can have. Among those, each word has a score by language from its character
n-grams, and a Viterbi pass with a penalty for each switch labels the words, so that a passage in another language
becomes a span of its own and a stray word does not.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tintwell.llm.sampling import bounded, held_out
from tintwell.llm.units import REMEMBERED
from tintwell.operators.scratch import bounded_batches

# First and last code point of common scripts, from the Unicode block list.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x9FFF),),
}
NAMES = [*SCRIPTS, "other"]
MEMO = 300_000


def script(word: str) -> int:
    """Place in NAMES of the script of the first letter."""
    c = ord(word[0])
    for k, ranges in enumerate(SCRIPTS.values()):
        if any(a <= c <= b for a, b in ranges):
            return k
    return len(SCRIPTS)


def grams(word: str) -> list[str]:
    """Character n-grams of two and three of a word with marks at its ends."""
    w = f"<{word}>"
    return [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)]


def core(word: str) -> str:
    """The letters of a word in lower case, joined."""
    return "".join(filter(str.isalpha, word)).lower()


@dataclass
class LanguageModel:
    """langs: in order; ids: place of each n-gram in weights; weights: log probabilities, the last row for unseen ones; scripts: languages that each script can have."""

    langs: list[str]
    ids: dict[str, int]
    weights: np.ndarray
    scripts: np.ndarray
    penalty: float = 8.0
    clip: float = 12.0
    _row: dict[str, int] = field(default_factory=dict)
    _table: np.ndarray | None = None
    _letters: np.ndarray | None = None

    def learn_rows(self, words: dict[str, str]) -> None:
        """Score rows of words, by their keys, that have none yet: relative to the best candidate, no lower than -clip; zero without letters."""
        if self._table is None or len(self._row) + len(words) > MEMO:
            self._row = {}
            self._table, self._letters = np.zeros((0, len(self.langs)), np.float32), np.zeros(0, np.int32)
        new = [w for w in words if w not in self._row]
        if not new:
            return
        flat, starts, letters, kinds, unseen, get = [], [], [], [], len(self.ids), self.ids.get
        for w in new:
            c = core(words[w])
            starts.append(len(flat))
            letters.append(len(c))
            kinds.append(script(c) if c else -1)
            flat += [get(g, unseen) for g in grams(c)] if c else [unseen]
        rows = np.add.reduceat(self.weights[np.array(flat)], np.array(starts), axis=0)
        kinds_a, letters_a = np.array(kinds), np.array(letters, np.int32)
        allowed = self.scripts[np.maximum(kinds_a, 0)]
        allowed |= ~allowed.any(1, keepdims=True)
        rows = np.where(allowed, rows, -np.inf)
        rows = np.maximum(rows - rows.max(1, keepdims=True), -self.clip)
        rows[letters_a == 0] = 0
        base = len(self._row)
        self._row.update(zip(new, range(base, base + len(new)), strict=True))
        if base + len(new) > len(self._table):  # room for the rest of the batch and more, so that few copies are made
            grown = max(2 * len(self._table), base + len(new), 4096)
            table, counts = np.zeros((grown, len(self.langs)), np.float32), np.zeros(grown, np.int32)
            table[:base], counts[:base] = self._table[:base], self._letters[:base]
            self._table, self._letters = table, counts
        self._table[base : base + len(new)], self._letters[base : base + len(new)] = rows, letters_a

    def paths(self, scores: list[np.ndarray], group: int = 128) -> list[np.ndarray]:
        """The best label sequence of each array of word scores; ties go to staying, then to the first language."""
        out: list[np.ndarray] = [np.zeros(0, np.int16)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
        at = 0
        while at < len(order):
            longest = len(scores[order[at]])
            some = order[at : at + (max(1, min(group, 4_000_000 // max(1, longest * len(self.langs)))))]
            at += len(some)
            s = np.zeros((longest, len(some), len(self.langs)), np.float32)
            for g, i in enumerate(some):
                s[: len(scores[i]), g] = scores[i]
            rows = np.arange(len(some))
            best = np.zeros((len(some), len(self.langs)), np.float32)
            moved, source = np.zeros(s.shape, bool), np.zeros((longest, len(some)), np.int16)
            for t in range(longest):
                if t:
                    top = best.argmax(1)
                    other = best[rows, top][:, None] - self.penalty
                    source[t] = top
                    np.greater(other, best, out=moved[t])
                    np.maximum(best, other, out=best)
                best += s[t]
            now = best.argmax(1)
            path = np.zeros((longest, len(some)), np.int16)
            for t in range(longest - 1, -1, -1):
                path[t] = now
                now = np.where(moved[t, rows, now], source[t], now)
            for g, i in enumerate(some):
                out[i] = path[: len(scores[i]), g].copy()
        return out

    def label(self, texts: list[str | None]) -> list[list[tuple[int, int, str, int]]]:
        """Spans (first word, end, language, letters) of each text, words being parted by white space; none without letters."""
        split = [(t or "").split() for t in texts]
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for words in split:
            keys = words
            if max(map(len, words), default=0) > REMEMBERED:  # long words are remembered by a digest
                keys = [w if len(w) <= REMEMBERED else hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest() for w in words]
            try:
                rows = np.fromiter(map(self._row.__getitem__, keys), np.int64, len(words))
            except KeyError:
                if len(words) > MEMO:  # a text with more words than are remembered is scored piece by piece
                    parts = []
                    for k in range(0, len(words), MEMO):
                        piece = keys[k : k + MEMO]
                        self.learn_rows(dict(zip(piece, words[k : k + MEMO], strict=True)))
                        r = np.fromiter(map(self._row.__getitem__, piece), np.int64, len(piece))
                        parts.append((self._table[r], self._letters[r]))
                    held.append(np.concatenate([p[0] for p in parts]))
                    counts.append(np.concatenate([p[1] for p in parts]))
                    continue
                self.learn_rows(dict(zip(keys, words, strict=True)))
                rows = np.fromiter(map(self._row.__getitem__, keys), np.int64, len(words))
            if self._table is None:
                self.learn_rows({})
            held.append(self._table[rows])
            counts.append(self._letters[rows])
        out = []
        for path, letters in zip(self.paths(held), counts, strict=True):
            spans = []
            if letters.sum():
                cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
                spans = [(a, b, self.langs[path[a]], int(letters[a:b].sum())) for a, b in zip(cuts, cuts[1:], strict=False)]
            out.append(spans)
        return out


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 400, max_grams: int = 60_000, max_langs: int = 256, penalty: float = 8.0) -> LanguageModel | None:
    """Learn n-gram weights from at most about 2 * per_lang whole texts of each language outside the held-out fold.

    N-grams are counted on the executors; max_grams reach the driver, the most frequent of each language. None if there is nothing to learn.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(id_col, text_col, F.col(lang_col).cast("string").alias("_lang"))
    sample = bounded(rows, "_lang", id_col, per_lang, max_langs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, str, int]] = Counter()
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in Counter(filter(None, map(core, text.split()))).items():
                    kind = script(word)
                    for g in grams(word):
                        found[lang, g, kind] += n
        keys = list(found)
        for at in range(0, len(keys), 10_000):
            part = keys[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in part]), pa.array([k[1] for k in part]), pa.array([k[2] for k in part], pa.int32()), pa.array([found[k] for k in part], pa.int64())], names=["lang", "gram", "kind", "n"])

    counted = bounded_batches(sample.select(text_col, "_lang")).mapInArrow(run, "lang string, gram string, kind int, n bigint").groupBy("lang", "gram", "kind").agg(F.sum("n").alias("n"))
    # Languages take turns, so that none loses its place to one with more n-grams.
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram", "kind"))
    got = counted.withColumn("turn", turn).orderBy("turn", F.desc("n"), "lang").limit(max_grams).collect()
    if not got:
        return None
    langs = sorted({r["lang"] for r in got})
    ids = {g: i for i, g in enumerate(sorted({r["gram"] for r in got}))}
    counts, scripts = np.zeros((len(ids) + 1, len(langs))), np.zeros((len(NAMES), len(langs)))
    place = {lang: k for k, lang in enumerate(langs)}
    for r in got:
        counts[ids[r["gram"]], place[r["lang"]]] += r["n"]
        scripts[r["kind"], place[r["lang"]]] += r["n"]
    weights = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * len(counts))).astype(np.float32)
    return LanguageModel(langs, ids, weights, scripts >= 0.01 * np.maximum(1, scripts.sum(0)), penalty)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, spans) of every row: the language with most letters, its share of them, and all spans.

    A text that is null or has no letter is `und` with score 0 and no spans, as is every text if model is None. Ties go
    to the language first in order. Only the text is an input; repeated rows get equal results, null ids are returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = model.label(part.column(1).to_pylist()) if model else [[]] * part.num_rows
                preds, scores = [], []
                for spans in found:
                    letters: Counter[str] = Counter()
                    for _, _, lang, n in spans:
                        letters[lang] += n
                    best = min(letters, key=lambda k: (-letters[k], k), default="und")
                    preds.append(best)
                    scores.append(letters[best] / sum(letters.values()) if letters else 0.0)
                spans_a = pa.array([[{"first": a, "end": b, "lang": c, "letters": n} for a, b, c, n in s] for s in found], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("letters", pa.int32())])))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64()), spans_a], names=[id_col, "lang_pred", "score", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return bounded_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, spans array<struct<first: int, end: int, lang: string, letters: int>>")
