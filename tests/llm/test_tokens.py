import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tintwell.llm import packing, piece_codec, queries, token_counts

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  two  spaces ", "line\nbreaks\r\n", "<s> </s> <unk> <|endoftext|>", "漢字 😀 ▁ é ǆ", "x" * 5000, "a\x00b", "1234 5,6", "İSTANBUL Σς ½²", "the&&& don't ''s"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()] + ODD


def docs(spark, texts):
    return spark.createDataFrame([(k if k != 3 else None, t, "clash", 1) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens string, variant int")


def test_counts_equal_the_library(spark, texts, library):
    got = token_counts.token_counts(docs(spark, texts), PIECE, limit=100).collect()
    want = [len(library.encode(t or "")) for t in texts]
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((len((t or "").encode()), n, n > 100) for t, n in zip(texts, want, strict=True))


def test_query_covers_all_documents(spark, sf_dir, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op7_token_counts(spark, sf_dir).collect()}
    assert got == {i: len(library.encode(t)) for i, t in rows.items()}


def test_every_prefix(spark, library):
    rng = random.Random(4)
    some = ["".join(rng.choice("abth er\n é漢▁  1") for _ in range(rng.randrange(40))) for _ in range(60)]
    rows = token_counts.token_counts(docs(spark, some), PIECE, prefixes=True).collect()
    counts = {tuple(r.prefix_tokens) for r in rows}
    for t in some:
        want = tuple(len(library.encode(t[:i])) for i in range(len(t) + 1))
        assert want in counts
    for t in some:
        c = token_counts.piece_model(PIECE).text_prefix_counts(t)
        cut = token_counts.truncate(c, 5)
        assert len(library.encode(t[:cut])) <= 5 and all(len(library.encode(t[:k])) > 5 for k in range(cut + 1, len(t) + 1))


def test_without_dropout_it_is_the_librarys_encoding(spark, texts, library):
    plain = [t for t in texts if t and "▁" not in t]
    got = {tuple(r.piece_ids) for r in piece_codec.encode(docs(spark, plain), PIECE, dropout=0.0).collect()}
    assert got == {tuple(library.encode(t)) for t in plain}


def test_dropout_is_lossless_repeatable_and_varied(spark, texts):
    df = docs(spark, texts)
    one = piece_codec.encode(df, PIECE, dropout=0.3, seed=1, verify=True)
    back = piece_codec.decode(one, PIECE).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for t in texts)
    assert sorted(r.decoded_sha256 for r in back) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for t in texts)
    key = lambda rows: sorted((str(r.doc_id), r.piece_ids) for r in rows)
    assert key(back) == key(piece_codec.encode(df.repartition(3), PIECE, dropout=0.3, seed=1).collect())
    other = piece_codec.encode(df, PIECE, dropout=0.3, seed=2).collect()
    assert key(back) != key(other)
    whole = piece_codec.encode(df, PIECE, dropout=1.0).collect()
    assert sum(r.n_tokens for r in whole) > sum(r.n_tokens for r in back) > sum(r.n_tokens for r in piece_codec.encode(df, PIECE, dropout=0.0).collect())


def test_groups_agree_with_the_heap(texts):
    c = piece_codec.codec(PIECE, 0.25, 9)
    units = list({u for t in texts if t for u in c.model.units(t.replace("▁", "\udfff"))})
    keys = np.arange(len(units), dtype=np.uint64) * np.uint64(77)
    flat, n, _ = c.model.merger.many(units, lost=lambda rows, turn: c._loses(keys[rows], turn))
    ends = np.cumsum(n)
    assert [flat[b - k : b].tolist() for b, k in zip(ends, n, strict=True)] == [c.alone(u, int(k)).tolist() for u, k in zip(units, keys, strict=True)]


def _agenda(model, unit, lost):
    """By the definition, one candidate after the other; lost(t): whether the t-th is skipped."""
    parts, never, turn = list(unit), set(), 0
    while True:
        found = [(-model.score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in model.ids and (i, a, b, len("".join(parts[:i]))) not in never and a in model.ids and b in model.ids]
        if not found:
            return parts
        _, i = min(found)
        turn += 1
        if lost(turn - 1):
            never.add((i, parts[i], parts[i + 1], len("".join(parts[:i]))))
            never = {(j, a, b, at) for _, a, b, at in never for j in range(len(parts))}
            continue
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_the_query_equals_brute_force(spark, sf_dir):
    """Whole texts by the definition of the agenda, under the keys of their documents."""
    c = piece_codec.codec(PIECE, 0.1, 0)
    got = {r.doc_id: r for r in queries.op10_piece_codec(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "xxhash64(0, cast(null as string), doc_id) n").collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows:
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    for r in [r for r in rows if len(r.text) < 1500][:40]:
        units = c.model.units(r.text)
        want = []
        for u, k in zip(units, c.keys(np.array([r.n]), np.array([0, len(units)])), strict=True):
            drawn = c.skipped(k, 0, 400)
            for p in _agenda(c.model, u, lambda t, drawn=drawn: drawn[t]):
                want += [c.model.ids[p]] if p in c.model.ids else [c.model.byte_ids[b] for b in p.encode()]
        assert got[r.doc_id].piece_ids == want and got[r.doc_id].n_tokens == len(want)


def _check_packing(pieces, encoded):
    cover, seqs = {}, {}
    for p in pieces:
        cover.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
        ids = np.array(encoded[p.doc_id][p.start : p.start + p.length], "<u4")
        assert p.length > 0 and zlib.crc32(ids.tobytes()) == p.ids_crc32
    for doc, ids in encoded.items():
        at = 0
        for start, n, total in sorted(cover[doc]):
            assert start == at and total == len(ids)
            at += n
        assert at == len(ids)
    padding = 0
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_packing_query(spark, sf_dir):
    library = Tokenizer.from_file(WORD)
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    encoded = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in rows.items()}
    assert _check_packing(queries.op3_packing(spark, sf_dir).collect(), encoded) == 0


def test_packing_edge_cases(spark):
    library = Tokenizer.from_file(WORD)
    some = [*ODD, "word " * 20_000]
    rows = [(k, t, 1) for k, t in enumerate(some)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(2)
    encoded = {k: library.encode(t or "", add_special_tokens=False).ids + [2] for k, t, _ in rows}
    _check_packing(packing.digests(packing.pack(df, WORD, block_tokens=5000)).collect(), encoded)
    twice = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string"), WORD).collect()
    assert sorted((str(r.doc_id), r.length) for r in twice) == [("1", 1), ("1", 2), ("None", 2)] or sum(r.length for r in twice) == 8
    assert packing.pack(df.limit(0), WORD).count() == 0


def test_block_is_balanced_and_full():
    rng = random.Random(8)
    lengths = [rng.randrange(1, 6000) for _ in range(300)]
    pieces = packing.pack_block(lengths)
    filled, cost = {}, {}
    for _, _, n, q, offset in pieces:
        assert offset == filled.get(q, 0)
        filled[q] = offset + n
        cost[q] = cost.get(q, 0) + n + n * n / 4096
    assert sum(filled.values()) == sum(lengths) and all(n & (n - 1) == 0 for n in filled.values())
    assert sum(n == 4096 for n in filled.values()) == sum(lengths) // 4096


def test_empty_tables(spark):
    empty = docs(spark, []).limit(0)
    assert token_counts.token_counts(empty, PIECE).count() == 0
    assert piece_codec.encode(empty, PIECE).count() == 0


def test_each_occurrence_is_drawn_anew(spark):
    word = " extraordinarily"
    rows = piece_codec.encode(spark.createDataFrame([(k, word * 100) for k in range(8)], "doc_id long, text string"), PIECE, dropout=0.3, seed=1).collect()
    c = piece_codec.codec(PIECE, 0.3, 1)
    seen = set()
    for r in rows:
        texts = [c.model.pieces[i] for i in r.piece_ids]
        cuts = "|".join(texts).replace("|▁", "\n").split("\n")
        assert len(set(cuts)) > 10
        seen |= set(cuts)
    assert len(seen) > 40 and len({tuple(r.piece_ids) for r in rows}) == len(rows)


def test_the_tree_agrees_with_the_heap(texts):
    c = piece_codec.codec(PIECE, 0.25, 9)
    for number, text in enumerate(t for t in texts[:40] if t and "▁" not in t):
        us = c.model.units(text)
        for _ in range(3):  # met for the first time, for the second, and remembered
            ids, cuts = c.encode(pa.array([text, "", text]), np.array([number, 5, number]))
            want = [i for u, k in zip(us, c.keys(np.array([number]), np.array([0, len(us)])), strict=True) for i in c.alone(u, int(k)).tolist()]
            assert ids.tolist() == want + want and cuts.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_pairs_are_decided_as_by_encoding(library):
    m = token_counts.piece_model(PIECE)
    rng = np.random.default_rng(5)
    a, b = (rng.choice(np.array(list(m.ids.values())), 20_000) for _ in range(2))
    ids, n, _ = m.merger.many([m.pieces[x] + m.pieces[y] for x, y in zip(a, b, strict=True)])
    first = np.cumsum(n) - n
    want = [k == 2 and ids[at] == x and ids[at + 1] == y for at, k, x, y in zip(first, n, a, b, strict=True)]
    assert m.merger.stays(a, b).tolist() == want


def test_very_long_units():
    """Neither a text without any space nor many lines of another script take memory beyond their own size."""
    c, m = piece_codec.codec(PIECE, 0.1, 0), token_counts.piece_model(PIECE)
    long = "abcde" * 1_000_000
    ids, cuts = c.encode(pa.array([long]), np.array([1]))
    assert bytes(c.decode(ids, cuts)[0]) == long.encode()
    lines = pa.array(["漢字仮名交じり" * 3 + str(k) for k in range(20_000)])
    before = len(m._counts)
    m.prefixes(lines)
    assert len(m._counts) - before <= 300_000 and all(len(u) <= 64 for u in m._counts)
    counts, edges = m.prefixes(pa.array([long[:200_000], None, "a"]))
    assert edges.tolist()[1:3] == [200_001, 200_002] and counts[200_001] == 0


def test_chars_in_limit(spark, library):
    some = ["", "a b c d e", None, "漢字" * 9, "word " * 9]
    rows = {r.doc_id: r.chars_in_limit for r in token_counts.token_counts(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), PIECE, limit=4).collect()}
    for k, t in enumerate(some):
        assert rows[k] == max(i for i in range(len(t or "") + 1) if len(library.encode((t or "")[:i])) <= 4)
