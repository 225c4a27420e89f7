"""Each stage's decision against its operator by brute force, and odd tables through all stages."""

import corpus_pipeline
import pytest
from test_neardup import brute

from dockpulse.llm import language, toxicity
from dockpulse.llm.common import held_out, importable, table
from dockpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_what_their_operators_say(spark):
    importable(spark)
    docs = table(spark, SF, "documents").cache()
    steps = dict(corpus_pipeline.STAGES)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    sample = language.training_sample(docs, ~held_out())
    known = language.predict_language(docs, sample).where("language.lang_pred <> 'und'")
    assert ids(steps["language_id"](spark, docs, SF)) == ids(known)
    fitted = toxicity.fit_toxicity(docs, table(spark, SF, "labels"), ~held_out())
    scored = toxicity.score_toxicity(docs, fitted)
    kept = steps["toxicity"](spark, docs, SF)
    assert kept.columns == COLUMNS and ids(kept) == ids(scored.where("toxicity.score < 0.3"))
    kept = steps["near_duplicates"](spark, docs, SF)
    assert kept.columns == COLUMNS
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, _, c in brute(rows, 5) if k == c)
    hit = QUERIES["op3_decontaminate"](spark, SF).where("contaminated")
    kept = steps["decontamination"](spark, docs, SF)
    assert kept.columns == COLUMNS and ids(kept) == ids(docs) - ids(hit)
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_go_through(spark, empty):
    rows = [(1, "The cat and the dog sat there today.", "en", None, 1, "x", "y", 2)]
    rows += [(2, rows[0][1], None, None, None, "x", "y", 2), (3, None, "en", "a", 0, "x", "y", 2)]
    rows += [(None, "A null id, and the dog.", "en", "a", 9, "x", "y", 2), rows[0]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, language string, hits string, toxicity int"
    docs = spark.createDataFrame([] if empty else rows, schema)
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs.columns, step(spark, docs, SF)
        if name != "byte_bpe":
            assert docs.columns == before
    assert sorted((r["doc_id"] or 0) for r in docs.collect()) == ([] if empty else [0, 1])


def test_names_with_dots_and_a_long_text_go_through(spark):
    long = "the cat and the dog sat there and " * 40_000
    rows = [(1, long, "en", None, 1, "x"), (2, "Another text of its own, and short.", "en", None, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` string")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF)
        assert docs.columns == [*COLUMNS, "a.b"]
    assert sorted(r["a.b"] for r in docs.collect()) == ["x", "y"]


def test_short_clean_texts_are_kept(spark):
    docs = table(spark, SF, "documents")
    short = ["A.", "OK", "Zoë", "Xylophone", "NASA JPL", "int x = 7;", "Мир и дом", "123 !?", "", None]
    rows = [(10**6 + i, t, None, "a", 1) for i, t in enumerate(short)]
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, both, SF).where("doc_id >= 1000000")
    assert sorted(r["doc_id"] - 10**6 for r in kept.collect()) == list(range(7))
