import re
import unicodedata

from tintwell.plans import catalog


def _visible(text):
    folded = re.sub(r"[^\S\x1c-\x1f]+", " ", unicodedata.normalize("NFKC", text)).strip(" ")
    return re.sub("[a-z]", lambda m: m[0].upper(), folded)


def test_all_turns_are_normalised(spark, sf_dir, tmp_path):
    odd = [(1, 1, "Ｓｈａｄｅ　１７"), (1, 2, "ﬁne  ½ é é"), (1, 3, " plain  text "), (1, 4, None)]
    spark.createDataFrame(odd, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for folder in (str(tmp_path), sf_dir):
        texts = {(r.conv_id, r.turn): r.text for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()}
        got = {(r.conv_id, r.turn): r.normalized for r in catalog.QUERIES["text_normalize_all"](spark, folder).collect()}
        assert got == {k: None if t is None else _visible(t) for k, t in texts.items()}
