import hashlib
import re

from pyspark.sql import functions as F

from tests.oracle import connection, differing
from tintwell.llm import exact_dedup, queries, simhash, substring
from tintwell.llm.simhash import fingerprint

SCHEMA = "doc_id long, text string, keep_id string, _run int, lang string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 7, None) for i, t in rows], SCHEMA)


def test_exact_query_agrees_with_sql(spark, sf_dir, tmp_path):
    assert differing(connection(sf_dir), queries.op5_exact_dedup(spark, sf_dir), queries.ORACLE_SQL["op5_exact_dedup"], tmp_path) == []


def test_exact_edge_cases(spark):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (4, None), (8, ""), (6, " \n"), (7, " "), (3, "a\tb"), (None, "q"), (None, "q"), (None, "z"), (1, "z"), (2, "a\x1cb"), (10, "y" * 200_000)]
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        same = [(i, t) for i, t in rows if re.sub(r"[\x20\x09-\x0D]+", " ", t or "") == norm]
        assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
        assert r.group_size == len(same) and r.keep_id == min((i for i, _ in same if i is not None), default=None)
        assert r._run == 7
    for digest in {r.text_sha256 for r in got}:
        assert sum(r.kept for r in got if r.text_sha256 == digest) == 1


def test_exact_hot_group(spark):
    rows = [(k, "same" if k % 2 else f"t{k}") for k in range(4000)]
    got = exact_dedup.exact_dedup(frame(spark, rows), runs=16)
    kept = got.where("kept").select("doc_id").collect()
    assert {r.doc_id for r in kept} == {1, *range(0, 4000, 2)}
    assert got.where("text = 'same'").select("group_size").distinct().first()[0] == 2000


def test_exact_plan_is_native_and_merges_sorted_runs(spark):
    docs = frame(spark, [(1, "a")])
    plan = exact_dedup.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
    merge = exact_dedup.merged_runs(exact_dedup._with_key(docs, "doc_id", "text", 16), 16)._jdf.queryExecution().executedPlan().toString()
    # Ids, then runs, then four rounds: each sorted before its exchange and after it.
    assert merge.count("SortAggregate") == 12 and merge.count("Exchange") == 6 and "HashAggregate" not in merge


def test_exact_hot_ids(spark):
    """One row repeated over a third of the table, and null ids on another third."""
    rows = [(7, "same") if k % 3 == 0 else (None, "null's") if k % 3 == 1 else (100 + k, f"t{k}") for k in range(3000)]
    for runs in (1, 2, 256):
        got = exact_dedup.exact_dedup(frame(spark, rows), runs=runs)
        assert got.count() == 3000
        seen = {(r.doc_id, r.text, r.keep_id, r.group_size): r.n for r in got.where("kept and text in ('same', \"null's\")").groupBy("doc_id", "text", "keep_id", "group_size").agg(F.count("*").alias("n")).collect()}
        assert seen == {(7, "same", 7, 1000): 1, (None, "null's", None, 1000): 1}


def test_exact_leaves_lone_rows_where_they_lie(spark):
    """Only rows that may be in a group are dealt out; how many more the bitmap lets through decides nothing."""
    rows = [(k, f"t{k % 1900}" if k % 2 else f"u{k}") for k in range(2000)]
    copies = {k for k, t in rows if [u for _, u in rows].count(t) > 1}
    keyed = exact_dedup._with_key(frame(spark, rows), "doc_id", "text", 4)
    groups = exact_dedup.merged_runs(keyed, 4).where("n > 1").select("_check")
    may = {r._id for r in exact_dedup._looked_up(keyed, groups, 1 << 24).where("_may").select("_id").collect()}
    assert copies and copies <= may and len(may) < len(copies) + 10
    assert "Union" in exact_dedup.exact_dedup(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    got = [{tuple(r) for r in exact_dedup.exact_dedup(frame(spark, rows), bits=n).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()} for n in (64, 128, 1 << 24)]
    assert len(got[0]) == 2000 and got[0] == got[1] == got[2]


def test_exact_all_null(spark):
    got = exact_dedup.exact_dedup(frame(spark, [(None, None)] * 5)).collect()
    assert [r.kept for r in got].count(True) == 1 and all(r.group_size == 5 and r.keep_id is None for r in got)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert simhash.simhash_groups(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0


def _groups(rows):
    fp = [(i, fingerprint(t) & (2**64 - 1)) for i, t in rows]
    words = sorted({f for _, f in fp})
    root = {w: w for w in words}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(words):
        for b in words[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for i, f in fp:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in fp]


def test_simhash_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in queries.op6_simhash(spark, sf_dir).collect()]
    assert sorted(got) == sorted(_groups(rows))


def test_simhash_edge_cases(spark):
    rows = [(4, None), (2, ""), (9, " \t"), (7, "one"), (7, "one"), (5, "ONE"), (6, "one two"), (None, "one"), (8, "Ünë two three four"), (11, "w " * 50_000)]
    got = simhash.simhash_groups(frame(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _groups(rows)))


def test_simhash_deals_out_linked_fingerprints_alone(spark, monkeypatch):
    """Where no text has a near copy, no fingerprint is copied to every salt."""
    words = [" ".join(f"w{k}.{j}" for j in range(12)) for k in range(300)]
    rows = [*enumerate(words), (900, words[7]), (901, words[8]), (None, "own"), (None, words[9])]
    frames, plain = {}, simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, label: plain(frames.setdefault(label, df), label))
    got = simhash.simhash_groups(frame(spark, rows)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _groups(rows)))

    def generated(node):
        below = [node.children().apply(k) for k in range(node.children().size())]
        return [node] * (node.nodeName() == "Generate") + [g for x in below for g in generated(x)]

    rows_of = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    salted = generated(frames["components"]._jdf.queryExecution().optimizedPlan())
    assert salted and all(rows_of(spark._jsparkSession, g).count() < 301 for g in salted)


def test_simhash_links_of_crowded_buckets(spark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(0, 63, 3) for b in range(0, 63, 5)} | {0, 3, 12, 15})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for bucket in (2, 1000):
        root = {f: f for f in fps}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for r in simhash.links(df, bucket=bucket).collect():
            assert (r.u ^ r.v).bit_count() <= 2
            a, b = find(r.u), find(r.v)
            root[max(a, b)] = min(a, b)
        parts = {}
        for f in fps:
            parts.setdefault(find(f), set()).add(f)
        # Two parts have no link between them, and every link is within one.
        for p in parts.values():
            for q in parts.values():
                assert p is q or all((x ^ y).bit_count() > 2 for x in p for y in q)


def _repeat_rows():
    passage = " ".join(f"p{k}" for k in range(37))
    other = " ".join(f"o{k}" for k in range(25))
    return [(1, f"start here {passage} end"), (2, f"{other} middle {passage} {other}"), (3, passage), (4, " ".join(["x"] * 60)), (5, None), (6, ""), (7, passage + "\x1c"), (8, other.replace(" ", "\n\t")), (9, "short text"), (10, " ".join(f"q{k % 7}" for k in range(50)))]


def test_repeats_equal_brute_force(spark):
    rows = _repeat_rows()
    for base in (5, 10, 20):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digests(substring.remove_repeats(frame(spark, rows), base=base)).collect()}
        assert got == substring.brute_force(dict(rows))


def test_repeats_of_text_ids_and_clashing_columns(spark):
    rows = [(f"k{i:02d}", t) for i, t in _repeat_rows()]
    df = spark.createDataFrame([(i, t, 1, [2], "x") for i, t in rows], "doc_id string, text string, place int, marks array<int>, id string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digests(substring.remove_repeats(df)).collect()}
    assert got == substring.brute_force(dict(rows))


def test_levels_are_doubled(spark, monkeypatch):
    """Candidates of 5 words that no longer window shares are gone after the next level."""
    seen = []
    plain = substring._looked_up

    def looked_up(texts, kind, find, label):
        kept = plain(texts, kind, find, label)
        seen.append((label, kept.count()))
        return kept

    monkeypatch.setattr(substring, "_looked_up", looked_up)
    common = " ".join(f"c{k}" for k in range(8))
    rows = [(k, " ".join([*(f"a{k}.{j}" for j in range(30)), common, *(f"b{k}.{j}" for j in range(30))])) for k in range(60)]
    left = substring.remove_repeats(frame(spark, rows)).collect()
    assert [label for label, _ in seen] == ["anchors", "of-10"] and seen[0][1] > 0 == seen[1][1] and not any(r.n_removed for r in left)


def test_repeats_query_equals_brute_force(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op8_substring_dedup(spark, sf_dir).collect()}
    assert got == substring.brute_force(rows)


def test_repeats_of_null_and_equal_ids(spark):
    passage = " ".join(f"p{k}" for k in range(30))
    got = substring.remove_repeats(frame(spark, [(None, passage), (1, passage), (1, passage), (2, passage)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 0), ("1", 0), ("2", 30), ("None", 0)]


def test_long_text(spark):
    text = " ".join(f"w{k}" for k in range(150_000))
    got = substring.remove_repeats(frame(spark, [(1, text), (2, "z " + text)])).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == {1: (150_000, 0), 2: (150_001, 150_000)}
