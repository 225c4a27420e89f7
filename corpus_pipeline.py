"""From raw documents to tokens: five stages, each a Spark job over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.llm import bpe, decontaminate, language, neardup, toxicity
from dockpulse.llm.common import fresh, held_out, importable, quoted, table
from dockpulse.session import stage

TOXIC_FROM = 0.3
WORDS, PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are given a learned language. Only texts that are ``und`` go: those without a
    letter, and all if nothing can be learned. There is no limit on the code length, as short clean
    texts take more than eight bits a byte."""
    importable(spark)
    into = fresh(docs, "language")
    sample = language.training_sample(docs, ~held_out("doc_id"))
    found = language.predict_language(docs, sample, into=into)
    return found.where(F.col(into)["lang_pred"] != "und").drop(into)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    importable(spark)
    into = fresh(docs, "toxicity")
    fitted = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    found = toxicity.score_toxicity(docs, fitted, into=into)
    return found.where(F.col(into)["score"] < TOXIC_FROM).drop(into)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the least id. Rows that repeat id and
    text are one document; rows without an id belong to no group and stay."""
    importable(spark)
    found = neardup.near_duplicates(docs, words=WORDS, percent=PERCENT)
    n = fresh(docs, "rows_of_id")
    kept = found.where("kept and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(n))
    rows = docs.join(kept, "doc_id").select(*map(quoted, docs.columns), n)
    alone = rows.where(F.col(n) == 1).drop(n)
    again = rows.where(F.col(n) > 1).drop(n).dropDuplicates(["doc_id", "text"])
    return alone.unionByName(again).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in the benchmark."""
    importable(spark)
    into = fresh(docs, "hits")
    found = decontaminate.find_windows(docs, table(spark, sf_dir, "benchmark"), into=into)
    return found.where(~decontaminate.contaminated(into)).drop(into)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of what is left, through encoding and decoding."""
    importable(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe.bpe_round_trip(docs, path, public_tokenizers.PATTERN, keep=["doc_id"])
    return found.select("doc_id", "bpe.*")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

ORACLE_SQL = None  # language, toxicity and tokens are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
