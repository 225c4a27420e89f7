"""Tree reduction against the tokenizer library, and exact round trips."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from dockpulse.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
OWN = bpe.Codec(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "library",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))
    },
    special_tokens={},
)
TEXT = st.text(st.sampled_from("ab sre't\n\t 12.,!é中\xa0🙂ÀX'"), max_size=80) | st.text(max_size=40)


@settings(max_examples=400, deadline=None)
@given(TEXT, st.sampled_from([1, 2, 5, 16]))
def test_tree_gives_the_tokens_of_the_whole_text(text, leaf):
    ids = OWN.encode(text, leaf)
    assert ids == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids, 3) == text.encode()


@pytest.mark.parametrize(
    "text",
    ["a" * 30_000, " " * 20_000, "中文" * 9_000, "it's 'll " * 4_000, "x\n\n" * 8_000 + "'", "12 " * 9_000],
)
def test_long_texts_of_all_shapes(text):
    ids = OWN.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (None, "Hello world", "z"), (2, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.bpe_round_trip(df, RANKS, public_tokenizers.PATTERN, into="bpe").collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [r["doc_id"] for r in found] == [1, 2, None, 2]
    assert [tuple(r["bpe"]) for r in found][:2] == [(0, empty, empty)] * 2
    assert found[2]["bpe"]["n_tokens"] == 2
    assert found[2]["bpe"]["decoded_sha256"] == hashlib.sha256(b"Hello world").hexdigest()
    coded = bpe.bpe_encode(df, RANKS, public_tokenizers.PATTERN, into="coded")
    coded = coded.select("doc_id", "text", "coded.ids")
    back = bpe.bpe_decode(coded, RANKS, public_tokenizers.PATTERN, "ids", "body").collect()
    assert [bytes(r["body"]).decode() for r in back] == ["", "", "Hello world", ""]


def test_a_column_of_the_same_name_gives_way(spark):
    df = spark.createDataFrame([(1, "a b", "old")], "doc_id long, text string, IDS string")
    coded = bpe.bpe_encode(df, RANKS, public_tokenizers.PATTERN, into="ids")
    assert coded.columns == ["doc_id", "text", "ids"]
    own = coded.select("text", "ids.ids")
    back = bpe.bpe_decode(own, RANKS, public_tokenizers.PATTERN, "ids", "text")
    assert back.columns == ["ids", "text"] and bytes(back.first()["text"]) == b"a b"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.bpe_round_trip(df, RANKS, public_tokenizers.PATTERN).count() == 0
