import re

import public_tokenizers
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tintwell.llm import pii, queries, simhash


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {q.split("_")[0] + "_" for q in names if q.startswith("op")} and "pipeline" in names


def _shingles(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [" ".join(words)] * bool(words)


def _fingerprint(text):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in _shingles(text, 3)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _smallest_of_components(texts):
    """Ids that are the smallest of their component; linked are fingerprints within 2 bits and sets of shingles at 0.8."""
    fps, sets, root = {i: _fingerprint(t) for i, t in texts.items()}, {i: set(_shingles(t, 5)) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            shared = len(sets[i] & sets[j])
            if (fps[i] ^ fps[j]).bit_count() <= 2 or (shared and shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared)):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i for i in ids if find(i) == i}


def test_stages_against_plain_versions(spark, sf_dir):
    """Each stage on what the one before kept; nothing here is computed by the library but the quality vote and the pseudonyms."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, first, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns
        seen.append({r.doc_id: r.text for r in rows})
    scores = {r.doc_id: r.predicted for r in queries.op1_quality(spark, sf_dir).collect()}
    assert seen[0] == {i: t for i, t in first.items() if scores[i]}
    least = {}
    for i, t in sorted(seen[0].items()):
        least.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert seen[1] == {i: seen[0][i] for i in least.values()}
    assert seen[2] == {i: seen[1][i] for i in _smallest_of_components(seen[1])}
    by = pii.Pseudonymiser(queries.pii_key(spark))
    assert seen[3] == {i: by.text(t)[0] for i, t in seen[2].items()}
    library, pieces, filled = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE)), {}, {}
    for p in corpus_pipeline.packed(spark, docs, sf_dir).collect():
        pieces.setdefault(p.doc_id, []).append((p.start, bytes(p.token_ids)))
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, t in seen[3].items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert b"".join(b for _, b in sorted(pieces.pop(i))) == b"".join(n.to_bytes(4, "little") for n in ids)
    assert not pieces
    for parts in filled.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096


def test_users_columns_stay(spark, sf_dir):
    """Columns that are named like what an operator adds come through all stages as they were."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = texts.selectExpr("*", "concat('s', doc_id) score", "'k' kept", "'p' pii", "array(1) keep_id", "true predicted", "'d' text_sha256")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and dict(kept.dtypes)["score"] == "string"
        assert all(r.score == f"s{r.doc_id}" and (r.kept, r.pii, r.keep_id, r.text_sha256) == ("k", "p", [1], "d") for r in kept.collect())


def test_an_empty_table_passes_all_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_null_rows_pass_the_near_stage(spark):
    docs = spark.createDataFrame([(None, "a b c d", None), (1, "a b c d", "en"), (2, "a b c d", "en")], "doc_id long, text string, lang string")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.without_near_copies(spark, docs, "").collect()) == ["1", "None"]
    assert simhash.simhash_groups(docs).count() == 3
