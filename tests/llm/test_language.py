"""Code lengths against a plain implementation, and held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockpulse.llm import language as lang
from dockpulse.llm.common import held_out, is_held_out, table

SF = "/root/testdata/sf0.01"


def plain_length(sample, text):
    counts = [defaultdict(Counter) for _ in range(lang.ORDER + 1)]
    for body in sample:
        data = b"\0" * lang.ORDER + body
        for i in range(lang.ORDER, len(data)):
            for k in range(lang.ORDER + 1):
                counts[k][data[i - k : i]][data[i]] += 1
    data, bits = b"\0" * lang.ORDER + text, 0.0
    for i in range(lang.ORDER, len(data)):
        for k in range(lang.ORDER, -1, -1):
            seen = counts[k].get(data[i - k : i])
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths(monkeypatch):
    samples = {
        "x": [b"the cat sat on the mat", b"a cat", "é".encode()],
        "y": [b"der hund und die katze", b"und"],
    }
    trees = lang.ContextTrees(samples)
    texts = [b"the katze sat", b"zzz\xff", b"a", "éé und".encode(), b"cat and " * 30]
    wanted = [[plain_length(samples[n], t) for n in ("x", "y")] for t in texts]
    assert np.allclose(trees.lengths(texts), wanted, rtol=1e-5)
    monkeypatch.setattr(lang, "SCORE_BYTES", 16)
    assert np.allclose(trees.lengths(texts), wanted, rtol=1e-5)


def test_gram_table():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000, dtype=np.uint64))
    found = lang.GramTable(keys)
    assert (found.find(keys) == np.arange(len(keys))).all()
    assert (found.find(keys + np.uint64(1 << 41)) == -1).all()


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    sample = lang.training_sample(docs, ~held_out())
    found = lang.predict_language(docs.where(held_out()), sample).collect()
    right = sum(r["lang"] == r["language"]["lang_pred"] for r in found)
    assert right / len(found) > 0.98
    assert all(is_held_out(r["doc_id"]) and 0 <= r["language"]["score"] <= 1 for r in found)


@pytest.mark.parametrize("learned", [True, False])
def test_odd_rows(spark, learned):
    rows = [(1, "the cat and the dog", "en", 1), (None, "der hund", "de", 2), (3, None, "en", 3)]
    rows += [(4, "", None, 4), (5, "123 !?", "en", 5), (5, "123 !?", "en", 5), (6, "the " * 50_000, "en", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    usable = ~held_out("doc_id") if learned else held_out("doc_id") & ~held_out("doc_id")
    sample = lang.training_sample(df, usable)
    found = {r["lang_pred"]: r["language"] for r in lang.predict_language(df, sample).collect()}
    for i in (3, 4, 5):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[2]["lang_pred"] == ("de" if learned else "und")
    assert lang.predict_language(df.limit(0), sample).count() == 0
    assert lang.training_sample(df.limit(0), usable) == {}


def test_long_labelled_texts_are_learned(spark):
    long = ["der hund und die katze " * 1_000, "das haus und der garten " * 1_000]
    assert min(map(len, long)) > lang.TRAIN_DOC_CHARS
    rows = [(i, t, "de") for i, t in enumerate(long)] + [(i, f"the cat and dog {i}", "en") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = lang.training_sample(df, F.lit(True))
    assert sample["de"] == sorted(t[: lang.TRAIN_DOC_CHARS].encode() for t in long)
    asked = spark.createDataFrame([("der garten und die katze",)], "text string")
    assert lang.predict_language(asked, sample).first()["language"]["lang_pred"] == "de"


def test_numerals_are_no_letters(spark):
    rows = [(1, "the cat and the dog"), (2, "½ ①②③ ² Ⅷ 12"), (3, "ª"), (4, "漢"), (5, "ʰ")]
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")
    sample = lang.training_sample(docs.where("doc_id = 1"), lang.F.lit(True))
    found = {r["doc_id"]: r["language"]["lang_pred"] for r in lang.predict_language(docs, sample).collect()}
    assert found == {1: "en", 2: "und", 3: "en", 4: "en", 5: "en"}


def test_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lang, "MOST_LANGUAGES", 2)
    rows = [("a b", "en")] * 5 + [("c d", "de")] * 4 + [("e f", f"junk{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(lang.training_sample(docs, lang.F.lit(True))) == ["de", "en"]
