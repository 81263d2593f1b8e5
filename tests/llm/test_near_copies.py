import random

import corpus_pipeline
from tintwell.llm import jaccard


def _similarity(a, b, width=5):
    one, two = ({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or {tuple(w)} for w in (a.lower().split(), b.lower().split()))
    return len(one & two) / len(one | two)


def _texts():
    """Texts of 300 words, and copies of some of them with 4 words changed."""
    rng = random.Random(3)
    texts = {k: " ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for k in range(60)}
    for k in range(0, 40):
        words = texts[k].split()
        for at in rng.sample(range(300), 4):
            words[at] = f"changed{at}"
        texts[100 + k] = " ".join(words)
    return texts


def test_planted_near_copies_go(spark):
    texts = _texts()
    near = {b for b in texts if any(a < b and _similarity(texts[a], texts[b]) >= 0.8 for a in texts)}
    assert near == set(range(100, 140))
    docs = spark.createDataFrame([(k, t, "en") for k, t in texts.items()], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()}
    assert kept == set(texts) - near


def _roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in pairs:
        root[max(find(u), find(v))] = min(find(u), find(v))
    return {n: find(n) for n in nodes}


def _brute(rows, least=0.8):
    sets = {i: set(jaccard.shingles(t).tolist()) for i, t in rows}
    return [(i, j) for i in sets for j in sets if i < j and sets[i] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]


def test_links_equal_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = [(r.u, r.v) for r in jaccard.links(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = _brute(rows)
    ids = [i for i, _ in rows]
    assert {frozenset(p) for p in found} <= {frozenset(p) for p in want} and _roots(ids, found) == _roots(ids, want)


def test_a_large_group_of_unlike_copies(spark):
    """Copies of one text that differ so much that many are far from it and near to some other copy only."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(150)]
    texts = [base]
    while len(texts) < 260:
        words = list(rng.choice(texts[:40] if rng.random() < 0.7 else texts))
        for _ in range(rng.choice((1, 1, 2, 3, 5))):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(words)
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    want = _roots(range(260), _brute(rows))
    for bucket in (4, 32):
        found = [(r.u, r.v) for r in jaccard.links(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket).collect()]
        assert _roots(range(260), found) == want and len(found) < 260 * 12


def test_blocks_tell_one_link_to_a_component():
    row = lambda mark, root, keys: {"mark": mark, "root": root, "keys": keys}
    held = [row(1, 1, [*range(10)]), row(2, 1, [*range(10)]), row(3, 3, [*range(9), 50]), row(4, 4, [*range(40, 50)]), row(5, 9, [*range(10)])]
    assert jaccard.compare_blocks([row(9, 9, [*range(10)])], held, 0.8) == [(9, 1), (9, 3)]


def test_links_of_crowded_bands(spark):
    base = [f"b{k}" for k in range(400)]
    rows = [(k, " ".join([*base, f"end{k}"])) for k in range(300)] + [(1000, "ONE two"), (1001, "one  two"), (1002, None), (None, "one two"), (1003, "")]
    edges = jaccard.links(spark.createDataFrame(rows, "doc_id long, text string"), bucket=4).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for r in edges:
        root[max(find(r.u), find(r.v))] = min(find(r.u), find(r.v))
    assert {find(k) for k in range(300)} == {0} and find(1001) == 1000
    assert not {1002, 1003, None} & {i for r in edges for i in (r.u, r.v)} and len(edges) < 300 * 100
