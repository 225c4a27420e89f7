"""Shards against the tokenizer library, and the index against a dictionary."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dockpulse.llm import token_shards as ts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True
OWN = ts.WordEncoder(open(PATH, encoding="utf-8").read())


@settings(max_examples=500, deadline=None)
@given(
    st.text(st.sampled_from("aB s'tre\n\t\x1c\x85 1.,éÉİ́中Σß🙂\xa0 <|>"), max_size=50)
    | st.text(max_size=30)
)
def test_encoder_gives_the_ids_of_the_library(text):
    ids = np.frombuffer(OWN.encode(text), OWN.dtype).tolist()
    assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


def test_encoder_with_full_caches(monkeypatch):
    monkeypatch.setattr(ts, "CACHED_CHUNKS", 3)
    monkeypatch.setattr(ts, "CACHED_WORDS", 2)
    own = ts.WordEncoder(open(PATH, encoding="utf-8").read())
    for text in ["one two three four five", "two six, one seven!", "one"]:
        ids = np.frombuffer(own.encode(text), own.dtype).tolist()
        assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


UNCHANGED = Tokenizer.from_file(PATH)


@settings(max_examples=500, deadline=None)
@given(
    st.lists(
        st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<|"])
        | st.text(st.sampled_from("aB's \n\x85é中Σ1.|<>"), max_size=4),
        max_size=8,
    ).map("".join)
)
def test_added_tokens_get_their_own_ids(text):
    ids = np.frombuffer(OWN.encode(text), OWN.dtype).tolist()
    assert ids == UNCHANGED.encode(text, add_special_tokens=False).ids


def test_added_tokens_in_shards(spark):
    rows = [(1, "a<|endoftext|>b"), (2, "<|startoftext|> It's\n<|endoftext|>"), (3, "plain")]
    manifest = ts.write_token_shards(spark.createDataFrame(rows, "doc_id long, text string"), PATH, end_id=2)
    start = 0
    for r, (key, text) in zip(ts.read_token_shards(manifest).orderBy("start").collect(), rows, strict=True):
        ids = UNCHANGED.encode(text, add_special_tokens=False).ids + [2]
        assert tuple(r) == (key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_perfect_hash_is_minimal():
    keys = ts.mix64(np.arange(20_000, dtype=np.uint64), 7)
    hashed = ts.PerfectHash.build(keys)
    assert sorted(hashed.slots(keys).tolist()) == list(range(20_000))


def test_round_trip(spark):
    rows = [(i * 7 % 101 - 50, f"Document {i} says 'hi' {i * i}", "w") for i in range(300)]
    rows += [(None, "no id", None), (None, None, None), (5, "", "x"), (5, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    manifest = ts.write_token_shards(df, PATH, end_id=2)
    found = ts.read_token_shards(manifest).orderBy("start").collect()
    by_id = {}
    for key, text, _ in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
        by_id.setdefault(key, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    start, seen = 0, {}
    for r in found:
        assert r["start"] == start
        start += r["n_tokens"]
        seen.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in by_id.items()}
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    shard = ts.TokenShard(manifest.where("coalesce(first_id, -99) <= 5 and last_id >= 5").first()["path"])
    assert shard.get(5, 1).tolist()[-1] == 2
    assert shard.get(10**9) is None


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    manifest = ts.write_token_shards(df, PATH, end_id=2)
    assert manifest.count() == 0
    assert ts.read_token_shards(manifest).count() == 0
