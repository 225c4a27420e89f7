"""Alignment of two tokenizers over the same texts, and how usual each link between their tokens is.

Tokenizer A is a byte-level BPE that reads a space and the text; tokenizer B is a piece BPE that adds the
space itself. Both cut the same bytes, so the tokens of each side tile the text.

1. Each batch of texts becomes two tables (document, start, token). ``pandas.merge_asof``, keyed by
   document, finds for each token start the token of the other side that covers it. Two tokens
   overlap if and only if the later start lies in the other token, so both directions together give
   every overlap, and those with equal starts are found twice. Equal ends close a group.
2. A block is a run of rows of about ``BLOCK_BYTES`` of text. It keeps its different id pairs once, and
   for every document the places of its pairs in that list. Blocks are written to the shared folder.
3. An id pair's count is the number of documents that hold it linked: blocks give sums, which Spark adds
   by pair. The highest count of every A id marks its best pairs.
4. The pairs of a block are joined with the counts, and each block gets back its own list only: no
   table of all pairs is broadcast, a very common pair has one row a block (Spark can split those),
   and no document's links are gathered anywhere but in their block.

Texts beyond ``SEGMENT`` characters are cut at a single space between letters or digits, where both sides
must end a token (checked against B's pieces); a text without such a place stays whole. Null and empty
texts have no tokens, and so have texts that a side does not give back byte by byte (characters
that B normalizes, U+2581 itself): their numbers are 0 and their digest is ''. Rows are judged one
by one: a repeated id gives a row each time and counts as another document. A null id is kept. An empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from dockpulse.llm.common import annotate
from dockpulse.session import stage

BLOCK_BYTES = 2 << 20
SEGMENT = 1 << 18
CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
SPACE = "▁"  # stands for a space in pieces
LONG_GAP = re.compile(r"\s{200}")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, by their rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteSide:
    """Tokenizer A, from a ``tokenizers`` file. If each merge makes the next id, ids are ranks and the same
    tokens come from tiktoken, three times as fast."""

    def __init__(self, path: str, pattern: str):
        with open(path) as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        vocab, merges = model["vocab"], model["merges"]
        special = {c for c in vocab if not set(c) <= letters.keys() or c.startswith("<|")}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        ranked = all(vocab.get(m) == 256 + i for i, m in enumerate(made))
        ranks = {b: i for i, b in enumerate(self.bytes) if i < 256 + len(made)}
        self.quick = None
        if ranked and len(ranks) == 256 + len(made):
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.quick is None or LONG_GAP.search(text):  # long gaps overflow the regex engine
            return self.library.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


class PieceSide:
    """Tokenizer B, from a sentencepiece model."""

    def __init__(self, path: str):
        self.library = SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.separable = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)


class Aligned(NamedTuple):
    """Tokens and overlaps of a batch; positions are bytes from the start of the batch."""

    doc: np.ndarray  # documents that have tokens, as numbers of the batch
    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_group: np.ndarray  # groups are numbered through the batch
    b_group: np.ndarray
    link_a: np.ndarray  # places in a and b
    link_b: np.ndarray


class Aligner:
    def __init__(self, a_path: str, b_path: str, pattern: str):
        self.a, self.b = ByteSide(a_path, pattern), PieceSide(b_path)
        self.a_size = np.array([len(x) for x in self.a.bytes])
        self.b_size = np.array([len(x) for x in self.b.bytes])
        self.a_text, self.b_text = (
            {end: np.array([b"%d%b" % (i, end) for i in range(len(side.bytes))], object) for end in (b",", last)}
            for side, last in ((self.a, b"|"), (self.b, b";"))
        )

    def segments(self, text: str) -> Iterator[str]:
        """Parts whose tokens do not depend on each other; each starts with the space that A reads."""
        text, start = " " + text, 0
        while self.b.separable and len(text) - start > SEGMENT:
            cut = CUT.search(text, start + SEGMENT)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def tokens(self, segment: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, if both give back the text."""
        whole = segment.encode()
        a, b = self.a.encode(segment), self.b.encode(segment[1:])
        if b"".join(map(self.a.bytes.__getitem__, a)) != whole:
            return None
        if b"".join(map(self.b.bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def align(self, docs: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
        """``found`` holds the tokens of the documents ``docs``, in the same order."""
        a, b = (np.concatenate([x[s] for x in found]) for s in (0, 1))
        doc = np.array(docs, np.int64)
        a_doc, b_doc = (np.repeat(doc, [len(x[s]) for x in found]) for s in (0, 1))
        a_end, b_end = self.a_size[a].cumsum(), self.b_size[b].cumsum()
        a_rows = pd.DataFrame({"start": a_end - self.a_size[a], "doc": a_doc, "a": np.arange(len(a))})
        b_rows = pd.DataFrame({"start": b_end - self.b_size[b], "doc": b_doc, "b": np.arange(len(b))})
        ahead = pd.merge_asof(a_rows, b_rows, on="start", by="doc")
        back = pd.merge_asof(b_rows, a_rows, on="start", by="doc")
        covers = back["a"].to_numpy(np.int64)
        later = a_rows["start"].to_numpy()[covers] < b_rows["start"].to_numpy()  # else found already
        link_a = np.concatenate([a_rows["a"].to_numpy(), covers[later]])
        link_b = np.concatenate([ahead["b"].to_numpy(np.int64), b_rows["b"].to_numpy()[later]])
        a_shut, b_shut = is_in(a_end, b_end), is_in(b_end, a_end)
        a_group, b_group = a_shut.cumsum() - a_shut, b_shut.cumsum() - b_shut
        return Aligned(doc, a, b, a_doc, b_doc, a_end, b_end, a_group, b_group, link_a, link_b)

    def group_text(self, x: Aligned) -> tuple[list[bytes], np.ndarray]:
        """Tokens as ``a1,a2|b1;``, and the document of each; group by group."""
        n = int(x.a_group[-1]) + 1 if len(x.a_group) else 0
        in_a, in_b = np.bincount(x.a_group, minlength=n), np.bincount(x.b_group, minlength=n)
        out = np.empty(len(x.a) + len(x.b), object)
        doc = np.empty(len(out), np.int64)
        sides = (
            (self.a_text, b"|", x.a, x.a_group, x.a_doc, in_b.cumsum() - in_b),
            (self.b_text, b";", x.b, x.b_group, x.b_doc, in_a.cumsum()),
        )
        for text, last, ids, group, docs, before in sides:
            place = np.arange(len(ids)) + before[group]
            out[place] = text[b","][ids]
            ends = np.flatnonzero(np.append(group[1:] != group[:-1], True)) if len(ids) else []
            out[place[ends]] = text[last][ids[ends]]
            doc[place] = docs
        return out.tolist(), doc


def is_in(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which numbers of the rising ``x`` the rising ``y`` holds."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x if len(y) else np.zeros(len(x), bool)


@lru_cache(1)
def aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    """Once in a worker."""
    return Aligner(a_path, b_path, pattern)


class Block:
    """Documents of a block: their numbers, and their id pairs with occurrences."""

    def __init__(self, tool: Aligner):
        self.tool, self.ids = tool, []
        self.size = self.waiting = 0
        self.open = -1  # the document of the last digest
        self.numbers: list[list[int]] = []  # n_a, n_b, n_groups, n_links
        self.digests: list = []
        self.parts: list[tuple] = []
        self.docs: list[int] = []
        self.found: list = []

    def add(self, doc_id: object, text: str | None) -> None:
        me = len(self.ids)
        self.ids.append(doc_id)
        self.numbers.append([0, 0, 0, 0])
        self.digests.append(None)
        self.size += len(text) if text else 0
        parts = len(self.parts)
        for segment in self.tool.segments(text) if text else ():
            tokens = self.tool.tokens(segment)
            if tokens is None:
                self.drop(me, parts)
                return
            self.docs.append(me)
            self.found.append(tokens)
            self.waiting += len(segment)
            if self.waiting >= 2 * SEGMENT:
                self.work()

    def drop(self, me: int, parts: int) -> None:
        """A document that a later segment turns out to be without tokens."""
        keep = [i for i, d in enumerate(self.docs) if d != me]
        self.docs, self.found = [self.docs[i] for i in keep], [self.found[i] for i in keep]
        self.numbers[me], self.digests[me] = [0, 0, 0, 0], None
        self.parts[parts:] = [tuple(c[p[0] != me] for c in p) for p in self.parts[parts:]]

    def work(self) -> None:
        if not self.docs:
            return
        x = self.tool.align(self.docs, self.found)
        self.docs, self.found, self.waiting = [], [], 0
        most = len(self.ids)
        link_doc = x.a_doc[x.link_a]
        last = np.append(x.a_group[1:] != x.a_group[:-1], True)
        counts = [np.bincount(d, minlength=most) for d in (x.a_doc, x.b_doc, x.a_doc[last], link_doc)]
        text, docs = self.tool.group_text(x)
        starts = np.flatnonzero(np.append(True, docs[1:] != docs[:-1])).tolist()
        for low, high in zip(starts, [*starts[1:], len(text)], strict=True):
            me = int(docs[low])
            self.numbers[me] = [n + int(c[me]) for n, c in zip(self.numbers[me], counts, strict=True)]
            self.digests[me] = self.digests[me] or hashlib.sha256()
            part = b"".join(text[low:high])
            # the last sign of a document is no separator; a later segment puts it back
            self.digests[me].update((b";" if self.open == me else b"") + part[:-1])
            self.open = me
        pair, names = pd.factorize((x.a[x.link_a] << 20) | x.b[x.link_b])
        both, n = np.unique(link_doc * len(names) + pair, return_counts=True)
        self.parts.append((both // max(len(names), 1), names[both % max(len(names), 1)], n))

    def row(self, number: int) -> dict:
        self.work()
        doc, pair, n = (np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else [np.zeros(0, np.int64)] * 3
        place, names = pd.factorize(pair)
        both, back = np.unique(doc * max(len(names), 1) + place, return_inverse=True)
        n = np.bincount(back, n, len(both)).astype(np.int64)
        place = both % max(len(names), 1)
        doc = both // max(len(names), 1)
        digests = [d.hexdigest() if d else "" for d in self.digests]
        docs = [
            dict(zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), (i, *m, d), strict=True))
            for i, m, d in zip(self.ids, self.numbers, digests, strict=True)
        ]
        packed = [np.bincount(doc, minlength=len(docs)).astype(np.int32), place.astype(np.int32), n.astype(np.int32)]
        return {
            "block": number,
            "docs": docs,
            "pairs": pack(names.astype(np.int64), np.bincount(place, minlength=len(names)).astype(np.int64)),
            "links": pack(*packed),
        }


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as a compressed table of one row."""
    columns = [pa.array([x]) for x in arrays]
    batch = pa.record_batch(columns, names=[str(i) for i in range(len(arrays))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> list[np.ndarray]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return [c.values.to_numpy(zero_copy_only=False) for c in batch.columns]


DOC_FIELDS = [
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()),
]
DIGEST = T.StructField("groups_sha256", T.StringType())


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, pattern: str, doc_id: str, text: str) -> DataFrame:
    """Blocks (block, docs, pairs, links), staged."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("docs", T.ArrayType(T.StructType([rows.schema["doc_id"], *DOC_FIELDS, DIGEST]))),
            T.StructField("pairs", T.BinaryType()),
            T.StructField("links", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        block = Block(aligner(a_path, b_path, pattern))
        for batch in batches:
            for i in range(batch.num_rows):
                block.add(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if block.size >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist([block.row(number)], arrow)
                    number += 1
                    block = Block(block.tool)
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row(number)], arrow)

    return stage(rows.mapInArrow(run, schema), "aligned")


def pair_rows(blocks: DataFrame) -> DataFrame:
    """``block, place, a, b, n``: the id pairs of each block, and how many of its documents hold them."""

    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pair, n = unpack(data)
                columns = [np.full(len(pair), block), np.arange(len(pair)), pair >> 20, pair & ((1 << 20) - 1), n]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                arrays = [pa.array(c).cast(k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "place", "a", "b", "n"])

    return blocks.select("block", "pairs").mapInArrow(run, "block long, place int, a int, b int, n long")


def link_counts(blocks: DataFrame) -> DataFrame:
    """``a, b, n_docs, best``: every linked id pair, in how many documents, and whether that is the A id's most."""
    counts = pair_rows(blocks).groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    counts = stage(counts, "link-counts")
    most = stage(counts.groupBy("a").agg(F.max("n_docs").alias("most")), "link-most")
    joined = counts.join(most, "a")
    return stage(joined.select("a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")), "link-table")


def token_alignment(
    docs: DataFrame, a_path: str, b_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row."""
    blocks = aligned_blocks(docs, a_path, b_path, pattern, doc_id, text)
    counts = link_counts(blocks)
    known = pair_rows(blocks).drop("n").join(counts, ["a", "b"])
    known = known.select("block", "place", "n_docs", F.col("best").cast("int").alias("best"))
    key = blocks.schema["docs"].dataType.elementType["doc_id"]
    sums = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]
    schema = T.StructType([key, *DOC_FIELDS, *sums, DIGEST])
    arrow = to_arrow_schema(schema)

    def finish(left, right):
        place = right.column("place").to_numpy()
        n_docs, best = np.zeros((2, len(place)), np.int64)
        n_docs[place] = right.column("n_docs").to_numpy()
        best[place] = right.column("best").to_numpy()
        rows = left.column("docs")[0].as_py()
        held, links, n = unpack(left.column("links")[0].as_py())
        doc = np.repeat(np.arange(len(rows)), held)
        for name, each in (("n_best", best), ("count_sum", n_docs)):
            sums = np.zeros(len(rows), np.int64)
            np.add.at(sums, doc, each[links] * n)
            for row, value in zip(rows, sums.tolist(), strict=True):
                row[name] = value
        return pa.Table.from_pylist(rows, arrow)

    left = blocks.select("block", "docs", "links").groupBy("block")
    return left.cogroup(known.groupBy("block")).applyInArrow(finish, schema)


ALIGNMENT = T.StructType(
    [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("a_ids", "b_ids", "a_ends", "b_ends", "link_a", "link_b")]
    + [T.StructField("groups", T.StringType())]
)


def token_links(docs: DataFrame, a_path: str, b_path: str, pattern: str, text: str = "text", into: str = "alignment") -> DataFrame:
    """Append the alignment of every text: ids and byte ends of both sides (the added space is byte 0),
    the overlaps as places in them, and the groups as ``a1,a2|b1;a3|b2``. Null where it has no tokens."""

    def make():
        tool = aligner(a_path, b_path, pattern)

        def one(value):
            found = [tool.tokens(s) for s in tool.segments(value)] if value else [None]
            if None in found:
                return [None] * len(ALIGNMENT)
            x = tool.align([0] * len(found), found)
            columns = (x.a, x.b, x.a_end, x.b_end, x.link_a, x.link_b)
            return [*columns, b"".join(tool.group_text(x)[0])[:-1].decode()]

        return lambda texts: list(zip(*map(one, texts), strict=True))

    return annotate(docs, into, ALIGNMENT, make, text)
