"""Queries over the corpus tables by name, and the SQL beside those that SQL can express."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.llm import (
    alignment,
    bpe,
    codes,
    collocations,
    decontaminate,
    language,
    licenses,
    neardup,
    token_shards,
    toxicity,
    transcripts,
    vectors,
    warc,
)
from dockpulse.llm.common import held_out, importable, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        @wraps(run)
        def started(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = started
        if sql is not None:
            ORACLES[run.__name__] = sql
        return started

    return register


@query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, through the tree reduction both ways."""
    found = bpe.bpe_round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        keep=["doc_id"],
    )
    return found.select("doc_id", "bpe.*")


@query()
def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as binary token shards, read back through their perfect hash index."""
    manifest = token_shards.write_token_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_shards.read_token_shards(manifest)


@query(decontaminate.SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of the benchmark, and which are contaminated."""
    found = decontaminate.find_windows(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    sample = language.training_sample(docs, ~held_out("doc_id"))
    found = language.predict_language(docs, sample, keep=["doc_id"])
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "language.lang_pred", "language.score"
    )


@query(warc.SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of a packaged archive, read back from the archives."""
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, with_payload=False).drop("url")


@query()
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document over two-word shingles, and which document of it stays."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


TOXIC_FROM = 0.3


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    fitted = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    found = toxicity.score_toxicity(docs, fitted, keep=["doc_id"])
    score = F.col("toxicity.score")
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        score.alias("score"),
        (score >= TOXIC_FROM).cast("int").alias("predicted"),
    )


@query(licenses.SQL)
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document, with the highest Dice coefficient."""
    found = licenses.scan_licences(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id",
        F.concat_ws(",", "licence.licences").alias("licences"),
        F.size("licence.licences").cast("long").alias("n_licences"),
        F.array_max("licence.scores").alias("best"),
    )


@query()
def op7_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a plain transcript, its roles recovered and its turns rendered."""
    turns = table(spark, sf_dir, "conversations")
    model = transcripts.fit_turns(turns, ~held_out("conv_id"))
    plain = transcripts.plain_transcripts(turns)
    found = transcripts.format_chats(plain, model, keep=["conv_id", "part", "piece", "roles"])
    return found.select(
        "conv_id",
        "part",
        "piece",
        held_out("conv_id").alias("held_out"),
        "chat.n_turns",
        F.col("chat.roles").alias("roles"),
        (F.col("chat.roles") == F.col("roles")).alias("as_given"),
        "chat.rendered_sha256",
    )


@query(codes.SQL)
def op10_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest codes of every hundredth vector among all vectors, ties by id."""
    found = table(spark, sf_dir, "embeddings")
    return codes.nearest_codes(found, found.where("vec_id % 100 = 0"), k=10)


@query(collocations.SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language that occur most above what their parts would give."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query(vectors.SQL)
def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of every vector at a cosine of 0.95, and its component."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers overlap in every document."""
    return alignment.token_alignment(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )
