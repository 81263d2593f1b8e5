"""Cost-balanced packing of documents into training sequences.

Documents are packed where they lie, in blocks of about ``block_tokens`` tokens, so nothing is shuffled. A document's
cost is estimated as linear * n + quadratic * n * n, the quadratic part standing for attention within it. Whole
sequences' worth of a document is cut off first; what remains is assigned in descending order of length to the sequence
with the lowest cost so far that has room, and is cut only where no sequence has room for all of it. A block has exactly
as many sequences as its tokens fill: full ones, then one for each power of two in the remainder, which needs no padding.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintwell.llm.units import REMEMBERED
from tintwell.operators.scratch import bounded_batches

MEMO = 800_000
_WORDS = re.compile(r"[\x20\x09-\x0D]+")
# The pattern of the vocabulary file, and the same classes for text below U+0180 in lower case.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS, _NUMBERS, _BLANKS = "a-zªµºß-öø-ſ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}{_BLANKS}]+")
_OTHER = re.compile("[^\x00-\u017f]|<\\|")
_encoders: dict[str, WordEncoder] = {}


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


class WordEncoder:
    """Ids of whole texts by a tokenizers file that drops white space; parts of texts that were met before are looked up.

    Texts of Western letters are parted by the file's own pattern and each part is merged by the file's model alone. Texts
    with other letters or special strings are parted at white space and each word goes through the whole tokenizer, which
    must treat words apart from each other; that is checked on a few texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        file = json.loads(self.tokenizer.to_str())
        self.western = PATTERN in json.dumps(file["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\") and [n["type"] for n in file["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        for probe in ("a b", "it 's\n\tx  1 2", "don't . , é ʼn", "<|endoftext|> a<|endoftext|>b", "Ça ½ İx_y\x1c\xa0² 'LLo''s"):
            whole = np.array(self.tokenizer.encode(probe, add_special_tokens=False).ids, "<u4").tobytes()
            if whole != b"".join(map(self._word, _WORDS.split(probe))):
                raise ValueError("this tokenizer does not treat words apart from each other")
            self.western = self.western and ("<|" in probe or "ʼ" in probe or whole == self._western(probe))

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= MEMO:
                self.words = {"": b""}
            found = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            if len(word) <= REMEMBERED:
                self.words[word] = found
        return found

    def _western(self, text: str) -> bytes:
        parts = _PARTS.findall(text.lower())
        known = self.parts
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            if len(known) >= MEMO:
                known.clear()
            tokenize, letters, long = self.tokenizer.model.tokenize, self.letters, {}
            for part in parts:
                if part not in known and part not in long:
                    (known if len(part) <= REMEMBERED else long)[part] = array("I", [t.id for t in tokenize(part.encode().decode("latin-1").translate(letters))]).tobytes()
            return b"".join([known[p] if p in known else long[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return [self._western(t) if self.western and not _OTHER.search(t) else b"".join(map(self._word, _WORDS.split(t))) for t in texts]


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pack_block(lengths: list[int], capacity: int = 4096, linear: float = 1.0, quadratic: float = 1 / 4096) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the given lengths; ties go to the first."""
    total = sum(lengths)
    room = [capacity] * (total // capacity)
    rest = total % capacity
    room += [1 << b for b in range(capacity.bit_length(), -1, -1) if rest >> b & 1]
    left, cost, used = np.array(room, np.int64), np.zeros(len(room)), np.zeros(len(room), np.int64)
    pieces = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, int(used[seq])))
        used[seq] += n
        left[seq] -= n
        cost[seq] += linear * n + quadratic * n * n

    remainders = []
    full = 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for k in range(whole):
            put(doc, k * capacity, capacity, full)
            full += 1
        if n % capacity:
            remainders.append((n % capacity, doc, whole * capacity))
    for n, doc, start in sorted(remainders, key=lambda r: (-r[0], r[1])):
        while n:
            fits = left >= n
            seq = int(np.where(fits if fits.any() else left > 0, cost, np.inf).argmin())
            take = min(n, int(left[seq]))
            put(doc, start, take, seq)
            n, start = n - take, start + take
    return pieces


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 2, block_tokens: int = 1 << 20, linear: float = 1.0, quadratic: float = 1 / 4096) -> DataFrame:
    """Pieces (id, start, length, doc_tokens, sequence_id, offset, token_ids) of all documents; token_ids is binary <u4.

    A null or empty text is the end id alone. Every token of every row lies in exactly one piece; repeated rows and rows
    with a null id are packed each for itself. A sequence holds pieces of one block; sequence_id is the task's number
    times 2**32 plus a running number, so a task that is run again gives the same rows. Other columns are not read. An
    empty table gives no piece. A document longer than a block makes a block of its own.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer_path)
        first = TaskContext.get().partitionId() << 32
        ids, held, tokens = [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal first, tokens
            lengths = [len(h) // 4 for h in held]
            rows = pack_block(lengths, capacity, linear, quadratic)
            for at in range(0, len(rows), 4096):
                part = rows[at : at + 4096]
                columns = [
                    pa.array([ids[d] for d, *_ in part], kind_arrow),
                    pa.array([s for _, s, *_ in part], pa.int64()),
                    pa.array([n for _, _, n, _, _ in part], pa.int64()),
                    pa.array([lengths[d] for d, *_ in part], pa.int64()),
                    pa.array([first + q for *_, q, _ in part], pa.int64()),
                    pa.array([o for *_, o in part], pa.int64()),
                    pa.array([held[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in part], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            first += 1 + max((q for *_, q, _ in rows), default=-1)
            ids.clear()
            held.clear()
            tokens = 0

        kind_arrow = None
        for batch in batches:
            kind_arrow = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, got in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    got += end
                    if tokens and tokens + len(got) // 4 > block_tokens:
                        yield from close()
                    ids.append(doc)
                    held.append(got)
                    tokens += len(got) // 4
        if held:
            yield from close()

    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "token_ids"]
    kind = docs.schema[id_col].dataType.simpleString()
    return bounded_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, token_ids binary")


def digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(id_col, "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
