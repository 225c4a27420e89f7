"""Byte-level BPE by monoid tree reduction.

A text is halved until its parts are short, each part is encoded by itself, and neighbours are
joined upwards. A join re-encodes a window around the seam. The window grows to both sides until it
ends at a safe cut: a place where, whatever stands before or after, the splitting pattern ends a
match (a visible ASCII character before white space, or a letter before an ASCII sign). Merges never
cross matches, so the tokens outside the window are those of the whole text. Where a side has no
safe cut the window is that whole side, which is exact as well. Decoding concatenates the bytes of
the tokens up the same kind of tree.

Null and empty texts give no tokens. A text is one row, so memory is bounded by the longest row.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import cache

import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dockpulse.llm.common import annotate

LEAF_CHARS = 4096
LEAF_IDS = 4096
FIRST_WINDOW = 64

SAFE_CUT = re.compile(
    r"[!-~](?=[ \n\t])|[A-Za-zÀ-ÖØ-öЀ-ҁ一-鿋](?=[ \n\t!-@\[-`{-~])"
)


class Codec:
    """Tokens of a rank file, with the tree reduction over them."""

    def __init__(self, ranks: bytes, pattern: str):
        lines = (line.split() for line in ranks.splitlines() if line.strip())
        merges = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in merges.items()}
        self.length_of = {rank: len(token) for token, rank in merges.items()}
        self.digits_of = {rank: str(rank) for rank in self.bytes_of}
        self.leaf = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={}
        ).encode_ordinary

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> list[int]:
        if len(text) <= max(leaf_chars, 1):
            return self.leaf(text)
        middle = len(text) // 2
        left = self.encode(text[:middle], leaf_chars)
        right = self.encode(text[middle:], leaf_chars)
        return self.join(text, middle, left, right)

    def join(self, text: str, seam: int, left: list[int], right: list[int]) -> list[int]:
        start, end = window_start(text, seam), window_end(text, seam)
        drop = self.count(reversed(left), len(text[start:seam].encode()))
        skip = self.count(right, len(text[seam:end].encode()))
        return left[: len(left) - drop] + self.leaf(text[start:end]) + right[skip:]

    def count(self, ids, size: int) -> int:
        """How many of the next tokens make up ``size`` bytes."""
        n = 0
        for token in ids:
            if size <= 0:
                break
            size -= self.length_of[token]
            n += 1
        if size:
            raise AssertionError("a token crosses a safe cut")
        return n

    def decode(self, ids: list[int], leaf_ids: int = LEAF_IDS) -> bytes:
        if len(ids) <= max(leaf_ids, 1):
            return b"".join([self.bytes_of[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf_ids) + self.decode(ids[middle:], leaf_ids)

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(" ".join([self.digits_of[i] for i in ids]).encode()).hexdigest()


def window_start(text: str, seam: int) -> int:
    """The nearest safe cut left of the seam, sought in growing windows; 0 without one."""
    width = FIRST_WINDOW
    while True:
        low = max(0, seam - width)
        cut = 0
        for found in SAFE_CUT.finditer(text, low, seam):
            cut = found.end()  # the character after the cut is left of the seam too
        if cut or low == 0:
            return cut
        width *= 2


def window_end(text: str, seam: int) -> int:
    """The nearest safe cut right of the seam; the end of the text without one."""
    found = SAFE_CUT.search(text, seam)
    return found.end() if found else len(text)


@cache
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def shipped_codec(df: DataFrame, ranks_path: str, pattern: str):
    """The rank file, read on the driver (its size is that of a vocabulary), for use in tasks."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    return lambda: codec(ranks.value, pattern)


def bpe_encode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "ids", keep=None
) -> DataFrame:
    """Append ``into``: a struct with the token ``ids`` of each text."""
    get = shipped_codec(df, ranks_path, pattern)

    def make():
        encode = get().encode
        return lambda texts: [[encode(t or "") for t in texts]]

    fields = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return annotate(df, into, fields, make, text, keep)


def bpe_decode(df: DataFrame, ranks_path: str, pattern: str, ids: str, into: str) -> DataFrame:
    """Append the bytes of an array column of ids as the binary column ``into`` (null: empty)."""
    get = shipped_codec(df, ranks_path, pattern)
    kept = [c for c in df.columns if c.lower() != into.lower()]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(into, T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        decode = get().decode
        for batch in batches:
            names = batch.schema.names
            lists = batch.column(names.index(ids)).to_pylist()
            made = pa.array([decode(x or []) for x in lists], pa.binary())
            others = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*others, made], names=[*kept, into])

    return df.mapInArrow(run, schema)


ROUND_TRIP = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def bpe_round_trip(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "bpe", keep=None
) -> DataFrame:
    """Encode, decode the ids again, and append the count and both digests as a struct.

    The ids never leave the task, so nothing of their size is sent or shuffled.
    """
    get = shipped_codec(df, ranks_path, pattern)

    def make():
        own = get()

        def work(texts):
            n, of_ids, of_bytes = [], [], []
            for t in texts:
                ids = own.encode(t or "")
                n.append(len(ids))
                of_ids.append(own.digest(ids))
                of_bytes.append(hashlib.sha256(own.decode(ids)).hexdigest())
            return n, of_ids, of_bytes

        return work

    return annotate(df, into, ROUND_TRIP, make, text, keep)
