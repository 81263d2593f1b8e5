import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tintwell.llm import packing, pii, piece_codec, substring, token_counts

PIECE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE)
TEXT = st.text(st.characters(exclude_categories=("Cs",)), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_counts_of_any_text(text):
    counts = token_counts.piece_model(PIECE).text_prefix_counts(text)
    assert counts[-1] == len(LIBRARY.encode(text)) and len(counts) == len(text) + 1


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(0, 3), st.sampled_from((0.0, 0.2, 1.0)))
def test_any_text_round_trips(text, variant, dropout):
    c = piece_codec.codec(PIECE, dropout, 5)
    ids, cuts = c.encode(pa.array([None, text, ""]), np.array([9, variant, 9]))
    assert [bytes(t).decode() for t in c.decode(ids, cuts)] == ["", text, ""]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_blocks_are_full(lengths):
    used, cover = {}, {}
    for doc, start, n, seq, offset in packing.pack_block(lengths):
        assert offset == used.get(seq, 0) and start == cover.get(doc, 0)
        used[seq] = used.get(seq, 0) + n
        cover[doc] = cover.get(doc, 0) + n
    assert cover == dict(enumerate(lengths)) and all(n <= 4096 and n & (n - 1) == 0 for n in used.values())


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 10**18), st.data())
def test_pseudonyms_go_back(n, data):
    x = data.draw(st.integers(0, n - 1))
    by = pii.Permuter(b"k")
    y = by.permute("x", x, n)
    assert y != x and 0 <= y < n and by.permute("x", y, n, back=True) == x


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.sampled_from([(5, 20), (10, 20), (20, 20), (3, 12)]))
def test_every_window_has_an_anchor_in_it(words, sizes):
    base, window = sizes
    h = substring._Words(pa.array([b" ".join(words).decode()])).one
    at = substring.anchors(substring.windows(h, base), window - base + 1)
    assert len(at) == max(0, len(words) - window + 1) and all(p <= a <= p + window - base for p, a in enumerate(at))
    seen = {}
    for p, a in enumerate(at):
        assert seen.setdefault(tuple(words[p : p + window]), a - p) == a - p
