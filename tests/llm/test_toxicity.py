"""Restored words, held-out accuracy, and odd tables."""

import numpy as np
import pytest

from dockpulse.llm import toxicity as tx
from dockpulse.llm.common import held_out, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model():
    text = "you are an idiot and a moron that stupid pathetic trash is so worthless to all of us " * 50
    joined = np.array([tx.CODES[min(ord(c), 0x180)] for c in "  " + text])
    grams = (joined[:-2] * tx.CLASSES + joined[1:-1]) * tx.CLASSES + joined[2:]
    ids, counts = np.unique(grams, return_counts=True)
    return tx.CharModel(ids, counts)


@pytest.mark.parametrize(
    "hidden, word",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"), ("stuuuuupid", "stupid"),
     ("st*pid", "stupid"), ("p@thet1c", "pathetic"), ("tr4sh", "trash"), ("i-d-1-0-t", "idiot"),
     ("stuupid", "stupid"), ("idioot", "idiot"), ("youareanidi0tandastup1dperson", "youareanidiotandastupidperson"),
     ("trash", "trash"), ("all", "all"), ("", "")],
)
def test_restored(model, hidden, word):
    assert model.restore(hidden).strip() == word


def test_viterbi_finds_the_best_of_all_readings(model):
    def score(trail):
        a = b = tx.EDGE
        total = 0.0
        for k, cost, _ in trail:
            total += cost
            if k is not None:
                total += model.log[a, b, k]
                a, b = b, k
        return total + model.log[a, b, tx.EDGE]

    for token in ("1d10t", "4.l|", "s$0"):
        paths = [[]]
        for c in token:
            paths = [[*p, o] for p in paths for o in tx.readings(c, False, False)]
        best = max(paths, key=score)
        assert model.restore(token) == "".join(x for k, _, x in best if k is not None)


def test_reader_handles_codes_and_long_texts(model):
    reader = tx.Reader(model)
    assert reader.of_text(None) == reader.of_text("") == set()
    same = reader.of_text("you idiot")
    assert tx.feature("idiot$") in same & reader.of_text("you 1d10t") & reader.of_text("you i d i o t !")
    for spelling in ("i  d  i  o  t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "i/d/i/o/t", "you i.d.i.o.t, yes", "1 d 1 0 t"):
        assert tx.feature("idiot$") in reader.of_text(spelling)
    assert tx.feature("idiot$") not in reader.of_text("i. d. - - and 1, 2")
    assert len(tx.SizedCache.LONGEST * "x") == 256 and not any(len(k) > 256 for k in reader.known)
    assert reader.of_text("0a1b" * 20_000) is not None
    assert reader.of_text("a " * 50_000) is not None


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    fitted = tx.fit_toxicity(docs, labels, ~held_out())
    scored = tx.score_toxicity(docs.where(held_out()), fitted, keep=["doc_id"])
    rows = scored.join(labels, "doc_id").select("toxicity.score", "toxic").collect()
    found = [r for r in rows if r["score"] >= 0.3]
    right = sum(r["toxic"] for r in found)
    assert right / len(found) > 0.9
    assert right / sum(r["toxic"] for r in rows) > 0.85


def test_counts_of_characters_over_pieces(spark, monkeypatch):
    texts = ["You are an idiot", None, "", "x" * 3000, "é½漢 " * 200]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    ids, n = tx.char_counts(docs)
    joined = "  " + "".join(t.lower() + "  " for t in texts if t) + " "
    k = [int(tx.CODES[min(ord(c), 0x180)]) for c in joined]
    expected = {}
    for a, b, c in zip(k, k[1:], k[2:]):
        g = (a * tx.CLASSES + b) * tx.CLASSES + c
        expected[g] = expected.get(g, 0) + 1
    assert dict(zip(ids.tolist(), n.astype(int).tolist(), strict=True)) == expected


def test_the_sample_has_one_row_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(3000)] + [(3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    sample = tx.training_sample(docs, labels, tx.F.lit(True)).collect()
    assert len(sample) == 2 and {r["label"] for r in sample} == {0, 1}


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "you idiot", 0), (2, None, 1), (None, "you", 1), (4, "", 0), (1, "you idiot", 0)],
        "doc_id long, text string, label int",
    )
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (None, 1, 1), (2, 1, None), (9, 1, 1)], "doc_id long, quality int, toxic int"
    )
    for given in (labels, labels.limit(0), labels.where("toxic = 0")):
        fitted = tx.fit_toxicity(docs, given, ~held_out())
        scores = [r["toxicity"]["score"] for r in tx.score_toxicity(docs, fitted).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
        assert tx.score_toxicity(docs.limit(0), fitted).count() == 0


def test_weights_minimise_the_loss():
    rng = np.random.default_rng(2)
    rows = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(400)]
    labels = np.array([float(0 in r or rng.random() < 0.1) for r in rows])
    w = tx.fit_weights(rows, labels, 6)

    def loss(w):
        margin = np.array([sum(w[i] for i in r) + w[-1] for r in rows])
        return np.logaddexp(0, margin).sum() - margin @ labels + tx.RIDGE / 2 * (w[:-1] ** 2).sum()

    assert all(loss(w) <= loss(w + d) + 1e-4 for d in rng.normal(0, 0.05, (200, 7)))
