"""Token ids in binary shards with a minimal perfect hash index.

``write_token_shards`` deals documents into ranges of ``doc_id``; each task sorts its range, encodes
it and writes one shard. ``read_token_shards`` reads every document back through the index, and
``TokenShard.get`` gives one document by its key in constant time.

A shard, all numbers little-endian::

    magic "DPTOKS01" | ids, 2 bytes each (4 where the vocabulary needs it) | sections | footer

Sections: the keys in order (8 bytes, then a null mark and the number among equal ids), the words
and ranks of the perfect hash, and per hash slot the fingerprint of its key, the place of its first
id and its number of ids. The footer is a JSON text with the place of every section, then its length
in 8 bytes and the magic again, so a reader starts from the end of the file.

The hash maps n keys to 0..n-1: each level holds a bit per cell; a key alone in its cell sets the
bit, the others go on to the next level; the slot is the number of bits set before. Repeated ids
are told apart by their number among equal ids, ordered by text. A null id is a key as well and
comes first. Null and empty texts hold the end id only. An empty table gives no shard.

Attempts of a task write files of different names; the manifest, a table, names those that count.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from dockpulse.llm.common import pieces
from dockpulse.llm.files import attempt_path, locate, mix64, shared_folder
from dockpulse.session import stage

MAGIC = b"DPTOKS01"
LEVELS = 64
READ_DOCS = 4096
CACHED_CHUNKS = 400_000
CACHED_WORDS = 500_000


class WordEncoder:
    """The tokenizer of a file, with its work kept for words that come again.

    White space always separates tokens here, so a text is the sum of its chunks. Chunks of ASCII
    and precomposed Latin letters are split by the tokenizer's own pattern and go to its model;
    every other chunk, and one that may hold an added token such as ``<|endoftext|>``, goes through
    the whole tokenizer, which gives added tokens their own ids.
    """

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ɏ]*")

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.split = None
        kinds = json.loads(spec)
        steps = [kinds["normalizer"], kinds["pre_tokenizer"]]
        if [s and s["type"] for s in steps] == ["Sequence", "Sequence"]:
            normal, pre = steps[0]["normalizers"], steps[1]["pretokenizers"]
            if [n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"] and [
                p["type"] for p in pre
            ] == ["Split", "ByteLevel"]:
                self.split = regex.compile(pre[0]["pattern"]["Regex"]).findall
        if self.split is None:
            raise ValueError("the tokenizer must lower-case, split by a pattern and use bytes")
        added = kinds.get("added_tokens") or []
        if any(re.search(r"\s", t["content"]) for t in added):
            raise ValueError("added tokens must hold no white space")
        contents = [plain_form(t["content"]) for t in added if t["content"]]
        self.added = re.compile("|".join(map(re.escape, contents)) or r"(?!)")
        self.signs = byte_signs()

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            signs = word if word.isascii() else word.encode().decode("latin-1").translate(self.signs)
            found = self.words[word] = self.pack([t.id for t in self.model.tokenize(signs)])
        return found

    def chunk(self, chunk: str) -> bytes:
        if self.PLAIN.fullmatch(chunk):
            plain = plain_form(chunk)
            if not self.added.search(plain):  # in lower case, so a superset of what the library matches
                return b"".join([self.word(w) for w in self.split(plain)])
        return self.pack(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        known = self.chunks
        parts = text.replace("\n", " ").split(" ")
        for c in parts:
            if c not in known:
                if len(known) >= CACHED_CHUNKS:
                    known.clear()
                    return b"".join([self.chunk(c) for c in parts])
                known[c] = self.chunk(c)
        return b"".join([known[c] for c in parts])


def plain_form(text: str) -> str:
    return unicodedata.normalize("NFC", text).lower()


def byte_signs() -> dict[int, str]:
    """The visible sign that byte-level vocabularies use for each byte, by code point."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in visible}
    for n, b in enumerate(b for b in range(256) if b not in signs):
        signs[b] = chr(256 + n)
    return signs


@cache
def encoder(spec: str) -> WordEncoder:
    return WordEncoder(spec)


class PerfectHash:
    """Level bits as 64-bit words, with the number of bits before each word."""

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [np.zeros(0, np.uint64)], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(64, -(-2 * len(left) // 64) * 64)
            cell = (mix64(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cell, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[cell]]
        bits = np.concatenate(words)
        counts = np.bitwise_count(bits).astype(np.int64)
        return cls(sizes, bits, np.cumsum(counts) - counts)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that were not there (see the fingerprints)."""
        found = np.full(len(keys), -1, np.int64)
        rest, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            cell = mix64(keys[rest], level) % np.uint64(size)
            at = (cell >> np.uint64(6)).astype(np.int64) + base
            bit = np.uint64(1) << (cell & np.uint64(63))
            hit = (self.words[at] & bit) != 0
            below = np.bitwise_count(self.words[at[hit]] & (bit[hit] - np.uint64(1)))
            found[rest[hit]] = self.ranks[at[hit]] + below
            rest, base = rest[~hit], base + size // 64
            if not len(rest):
                break
        return found


def key_hash(ids: np.ndarray, nulls: np.ndarray, nth: np.ndarray) -> np.ndarray:
    marks = (nth.astype(np.uint64) << np.uint64(1)) | nulls.astype(np.uint64)
    return mix64(ids.astype(np.int64).view(np.uint64) ^ mix64(marks, 101), 102)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 103) >> np.uint64(32)).astype("<u4")


def nth_of_equal(ids: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """The number of each row among neighbours with an equal key."""
    if not len(ids):
        return np.zeros(0, np.int64)
    new = np.r_[True, (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])]
    place = np.arange(len(ids))
    return place - np.maximum.accumulate(np.where(new, place, 0))


class ShardWriter:
    """Writes ids as documents come; only keys and places are held until the end."""

    def __init__(self, path: str, dtype: np.dtype):
        system, inside = locate(path)
        self.out, self.dtype = system.open_output_stream(inside), dtype
        self.out.write(MAGIC)
        self.keys: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, key: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.keys.append(key)
        self.sizes.append(len(ids) // self.dtype.itemsize)

    def close(self) -> int:
        nulls = np.array([k is None for k in self.keys], np.uint8)
        ids = np.array([k or 0 for k in self.keys], np.int64)
        nth = nth_of_equal(ids, nulls)
        sizes = np.array(self.sizes, np.int64)
        starts = np.cumsum(sizes) - sizes
        keys = key_hash(ids, nulls, nth)
        hashed = PerfectHash.build(keys)
        order = np.argsort(hashed.slots(keys))
        sections = {
            "ids": ids.astype("<i8"),
            "nulls": nulls,
            "nth": nth.astype("<i8"),
            "words": hashed.words.astype("<u8"),
            "ranks": hashed.ranks.astype("<i8"),
            "fingerprints": fingerprints(keys)[order],
            "starts": starts[order].astype("<i8"),
            "sizes": sizes[order].astype("<i8"),
        }
        footer = {"levels": hashed.sizes, "ids": self.dtype.str, "n_ids": int(sizes.sum())}
        place = len(MAGIC) + int(sizes.sum()) * self.dtype.itemsize
        footer["sections"] = {}
        for name, values in sections.items():
            data = values.tobytes()
            footer["sections"][name] = [place, len(data), values.dtype.str]
            place += len(data)
            self.out.write(data)
        tail = json.dumps(footer).encode()
        self.out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return int(sizes.sum())


class TokenShard:
    """A shard opened for range reads."""

    def __init__(self, path: str):
        system, inside = locate(path)
        self.file = system.open_input_file(inside)
        size = self.file.size()
        end = self.file.read_at(16, size - 16)
        if end[8:] != MAGIC:
            raise ValueError(f"{path} is no token shard")
        length = int.from_bytes(end[:8], "little")
        self.footer = json.loads(self.file.read_at(length, size - 16 - length))
        part = {n: self.section(n) for n in self.footer["sections"]}
        self.ids, self.nulls, self.nth = part["ids"], part["nulls"], part["nth"]
        self.hash = PerfectHash(self.footer["levels"], part["words"], part["ranks"])
        self.fingerprints, self.starts, self.sizes = (
            part[n] for n in ("fingerprints", "starts", "sizes")
        )
        self.dtype = np.dtype(self.footer["ids"])

    def section(self, name: str) -> np.ndarray:
        place, length, kind = self.footer["sections"][name]
        return np.frombuffer(self.file.read_at(length, place), kind)

    def find(self, ids, nulls, nth) -> np.ndarray:
        """The slot of each key, -1 where it is not in the shard by its fingerprint."""
        keys = key_hash(ids, nulls, nth)
        slots = self.hash.slots(keys)
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == fingerprints(keys[known])
        return np.where(known, slots, -1)

    def read(self, start: int, size: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at(size * width, len(MAGIC) + start * width), self.dtype)

    def get(self, doc_id: int | None, nth: int = 0) -> np.ndarray | None:
        """The ids of one document, or None."""
        key = [np.array([v]) for v in (doc_id or 0, int(doc_id is None), nth)]
        slot = int(self.find(*key)[0])
        return None if slot < 0 else self.read(int(self.starts[slot]), int(self.sizes[slot]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Every document in order, found by its key and read in blocks."""
        for low in range(0, len(self.ids), READ_DOCS):
            part = slice(low, low + READ_DOCS)
            slots = self.find(self.ids[part], self.nulls[part], self.nth[part])
            if (slots < 0).any():
                raise ValueError("a key of the shard is not in its index")
            starts, sizes = self.starts[slots], self.sizes[slots]
            first = int(starts[0])
            block = self.read(first, int(starts[-1] + sizes[-1]) - first)
            keys = zip(self.ids[part].tolist(), self.nulls[part].tolist(), strict=True)
            for (key, null), start, size in zip(keys, starts.tolist(), sizes.tolist(), strict=True):
                yield None if null else key, start, block[start - first : start - first + size]


MANIFEST = "shard int, path string, first_id long, last_id long, n_docs long, n_ids long"


def write_token_shards(
    df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write the shards below the shared folder and return their manifest, one row per shard.

    One range exchange of ids and texts, which sorts within its partitions; its sizes follow the
    shuffle settings, and a repeated id stays in one shard.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:  # as large as a vocabulary
        spec = spark.sparkContext.broadcast(file.read())
    folder = shared_folder(spark, "token-shards")

    def run(batches):
        own, writer, path, first, last = encoder(spec.value), None, None, None, None
        end = own.pack([end_id])
        number = TaskContext.get().partitionId()
        for batch in batches:
            for part in pieces(batch, "text"):
                if writer is None:
                    path = attempt_path(folder, number, ".tokens")
                    writer = ShardWriter(path, own.dtype)
                    first = part.column(0)[0].as_py()
                rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                for last, body in rows:
                    writer.add(last, own.encode(body or "") + end)
        if writer is not None:
            n_ids = writer.close()
            row = [number, path, first, last, len(writer.keys), n_ids]
            names = [c.split()[0] for c in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.string(), *[pa.int64()] * 4]
            arrays = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    ordered = (
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    return stage(ordered.mapInArrow(run, MANIFEST), "token-manifest")


READ_BACK = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: its id, the ids before it, its number of ids, their crc32.

    The manifest has a row per shard, so the running total over it is a small window.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    shards = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            paths = batch.column(names.index("path")).to_pylist()
            bases = batch.column(names.index("base")).to_pylist()
            for path, base in zip(paths, bases, strict=True):
                rows = []
                for key, start, ids in TokenShard(path).documents():
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((key, base + start, len(ids), crc))
                columns = zip(*rows, strict=True)
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, names=READ_BACK.fieldNames())

    return placed.repartition(shards, "shard").mapInArrow(run, READ_BACK)
