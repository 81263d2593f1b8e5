import numpy as np

from tintwell.llm import langid, sampling


def test_a_language_with_few_ngrams_stays(spark):
    rows = [(k, " ".join(f"{a}{b}{k % 7}abcdefgh" for a in "abcdefgh" for b in "klmnopqr"), "big") for k in range(1, 60)]
    rows += [(100 + k, "zu zu", "small") for k in range(10)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_grams=20)
    assert model.langs == ["big", "small"]


def test_the_most_frequent_classes_are_kept(spark):
    rows = [(k, f"l{k % 40:02d}") for k in range(400)] + [(1000 + k, "zz") for k in range(50)]
    got = sampling.bounded(spark.createDataFrame(rows, "doc_id long, lang string"), "lang", "doc_id", 100, max_classes=1)
    assert {r.lang for r in got.collect()} == {"zz"}


def test_paths_reach_beyond_128_languages():
    n = 200
    model = langid.LanguageModel([f"l{k:03d}" for k in range(n)], {}, np.zeros((1, n), np.float32), np.ones((len(langid.NAMES), n), bool), 8.0)
    scores = np.zeros((30, n), np.float32)
    scores[:15, 170], scores[15:, 190] = 5, 5
    assert model.paths([scores])[0].tolist() == [170] * 15 + [190] * 15
