import datetime
import random
import re
import zlib

import numpy as np
import pytest

from tintwell.llm import ann, langid, pii, quality, queries


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def larger(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


def test_quality_on_held_out_labels(spark, larger):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{larger}/labels.parquet").collect()}
    got = queries.op1_quality(spark, larger).collect()
    assert len(got) == spark.read.parquet(f"{larger}/documents.parquet").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    judged = [(labels[r.doc_id], r.score) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for y, s in judged if y == 1], [s for y, s in judged if y == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate([None, "", "fine words here", "fine words here", "### $$$ &&&", "w " * 30_000])], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, None), (None, 1), (4, 0), (6, 1), (99, 1)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got) and got[2].score == got[3].score
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).count() == 0


def test_voting_is_exact():
    rng = np.random.default_rng(0)
    x = rng.random((40, quality.FEATURES)).astype(np.float32)
    voter = quality.Voter(np.ones(quality.FEATURES, np.float32), rng.normal(size=(quality.FEATURES, 8)).astype(np.float32), np.zeros((0, 8), np.float32), (rng.random(40) > 0.5).astype(float), 5)
    voter.vectors = voter.latent(x)
    q = rng.random((7, quality.FEATURES)).astype(np.float32)
    z = voter.latent(q)
    for s, v in zip(voter.scores(q, block=3), z, strict=True):
        cos = voter.vectors @ v
        near = np.argsort(-cos)[:5]
        w = np.maximum(cos[near], 0)
        assert s == pytest.approx((w * voter.labels[near]).sum() / w.sum(), abs=1e-5)


def test_language_on_held_out_rows(spark, larger):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    got = queries.op9_language(spark, larger).collect()
    assert len(got) == len(lang)
    judged = [lang[r.doc_id] == r.lang_pred for r in got if r.held_out]
    assert np.mean(judged) > 0.97 and all(0 <= r.score <= 1 for r in got)


@pytest.fixture(scope="module")
def model(spark):
    words = {"aa": "anna banana panama casa lana mana rana", "zz": "zizzy fizz whizz jazz buzz quiz fuzz", "ru": "привет мир как дела снова друг"}
    rng = random.Random(0)
    rows = [(k, " ".join(rng.choices(words[g].split(), k=30)), g) for k in range(120) for g in [list(words)[k % 3]]]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=30)


def test_spans_of_mixed_text(model):
    text = "banana casa lana rana mana panama fizz buzz jazz whizz quiz fuzz anna lana casa banana mana rana привет мир как дела"
    (spans,) = model.label([text])
    assert [(a, b, g) for a, b, g, _ in spans] == [(0, 6, "aa"), (6, 12, "zz"), (12, 18, "aa"), (18, 22, "ru")]
    (spans,) = model.label(["banana casa lana jazz rana mana panama"])
    assert len(spans) == 1  # a stray word is no switch


def test_scripts_narrow_the_candidates(model):
    assert model.label(["неведомый"])[0][0][2] == "ru"
    assert model.label(["zxqw"])[0][0][2] != "ru"


def test_viterbi_equals_brute_force(model):
    from itertools import product

    rng = np.random.default_rng(1)
    scores = [rng.normal(0, 6, (n, 3)).astype(np.float32) for n in (1, 5, 3, 6, 0)]
    for s, path in zip(scores, model.paths(scores, group=2), strict=True):
        best = max((sum(s[i, p[i]] for i in range(len(s))) - model.penalty * sum(a != b for a, b in zip(p, p[1:], strict=False)) for p in product(range(3), repeat=len(s))), default=0)
        got = sum(s[i, path[i]] for i in range(len(s))) - model.penalty * int((np.diff(path) != 0).sum())
        assert got == pytest.approx(best, abs=1e-4)


def test_language_edge_cases(spark, model):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "123 --- ! ² ½"), (None, "banana"), (4, "fizz " * 40_000), (4, "fizz " * 40_000)], "doc_id long, text string")
    got = langid.identify(docs, model).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "aa", "zz", "zz"] and got[0].score == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None
    assert langid.identify(docs.limit(0), model).count() == 0


def test_permutations_are_one_to_one_without_fixed_points():
    p = pii.Permuter(b"k")
    for n in (2, 3, 10, 97, 1000):
        out = [p.permute("x", v, n) for v in range(n)]
        assert sorted(out) == list(range(n)) and all(a != b for a, b in enumerate(out))
        assert [p.permute("x", v, n, back=True) for v in out] == list(range(n))
    even = [p.permute("x", v, 100, lambda v: v % 2 == 0) for v in range(0, 100, 2)]
    assert sorted(even) == list(range(0, 100, 2))


VALUES = {
    "email": ["a.b1@x.org", "34@mail7.example.com", "First.Last+tag@sub.domain.co"],
    "card": ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "378282246310005"],
    "phone": ["+1 (017) 555-7713", "(030) 123-4567", "+49 30 1234 5678", "+4930123456789"],
    "ip": ["97.51.17.173", "10.0.0.1"],
    "date": ["2023-05-06", "31/12/1999", "02/03/2001", "01.02.1990"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
}


@pytest.mark.parametrize("kind", VALUES)
def test_pseudonyms_keep_their_format(kind):
    by = pii.Pseudonymiser(b"secret")
    for v in VALUES[kind]:
        new, spans = by.text(f"see {v}, and {v}.")
        assert [s[0] for s in spans] == [kind, kind] and v not in new
        a, b = (new[x:y] for _, x, y in spans)
        assert a == b and by.value(kind, a, back=True) == v
        if kind not in ("ip",):
            assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", a))) == re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", v)))
        assert by.text(f"see {a}")[1], "a pseudonym is a valid value of its kind"
    assert pii.Pseudonymiser(b"other").value(kind, VALUES[kind][0]) != by.value(kind, VALUES[kind][0])


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "9807915762804490", "999.1.1.1", "000-12-3456", "2023-13-45", "DE00 3704 0044 0532 0130 00", "version 3.0 of CC BY 4.0", "1234", "a@b", "12 345", ""])
def test_what_is_not_valid_stays(text):
    assert pii.Pseudonymiser(b"secret").text(text) == (text, [])


def test_dates_stay_dates():
    by = pii.Pseudonymiser(b"secret")
    for k in range(400):
        day = datetime.date(1990, 1, 1) + datetime.timedelta(days=31 * k)
        datetime.date.fromisoformat(by.value("date", day.isoformat()))


def test_pii_frame(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "clean text", "x"), (4, "at 10.0.0.1 now", "x"), (4, "at 10.0.0.1 now", "x"), (None, "w " * 50_000 + "10.0.0.1", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = pii.pseudonymise(df, b"k").collect()
    assert [r.text for r in got[:3]] == [None, "", "clean text"]
    assert got[3].text == got[4].text and "10.0.0.1" not in got[3].text
    assert [[s.kind for s in r.pii] for r in got[2:]] == [[], ["ip"], ["ip"], ["ip"]]
    s = got[3].pii[0]
    assert got[5].text.endswith(got[3].text[s.start : s.end])
    assert pii.pseudonymise(df.limit(0), b"k").count() == 0


def test_pii_query_leaves_clean_documents_alone(spark, sf_dir):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op4_pii(spark, sf_dir).collect()
    assert len(got) == len(before) and all((r.text == before[r.doc_id]) == (r.n_values == 0) for r in got)


def _exact(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    return [(int(ids[i]), d[i]) for i in np.lexsort((ids, d)) if i != q][:k]


def test_neighbours_recall(spark, larger):
    rows = spark.read.parquet(f"{larger}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in queries.op2_neighbours(spark, larger).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        place = int(np.flatnonzero(ids == q)[0])
        assert [r.rank for r in found] == list(range(1, 11)) and [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        assert all(r.score == pytest.approx(float(np.sqrt(((x[ids == r.vec_id][0] - x[place]) ** 2).sum())), rel=1e-12) for r in found)
        hits += len({r.vec_id for r in found} & {i for i, _ in _exact(ids, x, place)})
    assert hits / (10 * len(got)) >= 0.95


def test_recall_over_several_shards(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)) + rng.normal(size=(20, 24))[rng.integers(0, 20, 3000)] * 2
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    graphs = ann.index(df, shard_rows=500)
    assert graphs.count() == 6
    got = {}
    for r in ann.search(graphs, df, df.vec_id % 100 == 0, block=8).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[q] & {i for i, _ in _exact(np.arange(3000), x, q)}) / 10 for q in got]) >= 0.95 and len(got) == 30


def test_neighbours_edge_cases(spark):
    same = [1.0, 0.0]
    rows = [(k, same) for k in range(0, 40)] + [(200, [0.0, 1.0]), (200, [0.0, 1.0]), (300, None), (400, [0.0, 0.0]), (500, [float("nan"), 1.0]), (600, [None, 1.0]), (700, [float("inf"), 1.0]), (800, []), (900, [1.0, 2.0, 3.0]), (None, same)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = {}
    for r in ann.search(ann.index(df, shard_rows=8), df, df.vec_id % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(k, 0.0) for k in range(1, 11)], 200: [(k, pytest.approx(2**0.5)) for k in range(10)]}
    empty = df.limit(0)
    assert ann.search(ann.index(empty), empty, empty.vec_id % 100 == 0).count() == 0
    few = df.where("vec_id IN (0, 1, 200)")
    assert ann.search(ann.index(few), few, few.vec_id % 100 == 0).count() == 4


def test_neighbours_of_all_lengths_sizes_and_repeated_ids(spark):
    """Vectors of another length, of squares beyond any float, and rows that share an id are all candidates."""
    rows = [(100, [1e200, 0.0]), (1, [1e200, 3e199]), (2, [0.0, 1e-300]), (3, [5.0, 5.0]), (3, [6.0, 5.0]), (3, [6.0, 5.0]), (200, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 5.0]), (300, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(ann.index(df), df, df.vec_id % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {100: [(1, pytest.approx(3e199)), (2, 1e200), (3, 1e200), (3, 1e200)], 200: [(4, 2.0)]}


def test_ties_at_the_last_neighbour_are_shared():
    """Which of the texts at the same cosine come first in the sample decides nothing."""
    vectors = np.array([[1.0, 0.0], [0.6, 0.8], [0.6, 0.8], [0.6, 0.8]], np.float32)
    basis = np.zeros((quality.FEATURES, 2), np.float32)
    basis[0, 0] = 1
    counts = np.zeros((1, quality.FEATURES), np.float32)
    counts[0, 0] = 1
    for labels in ([1.0, 1.0, 0.0, 0.0], [1.0, 0.0, 1.0, 0.0], [1.0, 0.0, 0.0, 1.0]):
        voter = quality.Voter(np.ones(quality.FEATURES, np.float32), basis, vectors, np.array(labels), 2)
        assert voter.scores(counts)[0] == pytest.approx((1 + 0.6 / 3) / 1.6)


def test_the_quality_query_equals_plain_votes(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    voter = quality.fit(docs, labels)
    got = {r.doc_id: r for r in queries.op1_quality(spark, sf_dir).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows[:60]:
        z = voter.latent(quality.features(r.text)[None, :])[0]
        near = sorted(((float(z @ v), y) for v, y in zip(voter.vectors, voter.labels, strict=True)), reverse=True)[: voter.neighbours]
        total = sum(max(c, 0) for c, _ in near)
        assert got[r.doc_id].score == pytest.approx(sum(max(c, 0) * y for c, y in near) / total, abs=0.02)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)
