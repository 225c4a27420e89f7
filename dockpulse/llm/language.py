"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ``ORDER`` bytes is counted once and then frozen.
A byte costs -log2 p(byte | longest context of the tree); a context that has not seen the byte first
pays its escape (method C: distinct bytes / (count + distinct bytes)) and hands over to the context
that is one byte shorter; below the empty context all 256 bytes are equally likely. The language
with the shortest code for the whole text wins, and the score is its posterior, 2^-own length over
the sum over languages.

The trees are fitted on a documented sample: of every language the ``TRAIN_DOCS`` labelled documents
that come first by a hash of their text (copies count once), of each the first ``TRAIN_DOC_CHARS``
characters, together under ``TRAIN_CHARS`` for all languages. Only text and language are read
there. Scoring reads every byte of every text.

A text that is null or has no letter is ``und`` with score 0. If nothing can be learned every text
is ``und``. Equal code lengths go to the language that is first by name.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dockpulse.llm.common import SHARES, annotate, hash_cutoff, hash_place

ORDER = 4
TRAIN_DOCS = 400
TRAIN_DOC_CHARS = 20_000
TRAIN_CHARS = 64_000_000
MOST_LANGUAGES = 200
SCORE_BYTES = 1 << 20  # bytes of text that are scored together
HASH = np.uint64(0x9E3779B97F4A7C15)

LETTER = regex.compile(r"\p{L}")  # numerals such as ½ or Ⅷ are none


class GramTable:
    """Distinct numbers below 2^40 to their rows, by hashing with linear probing."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.rows = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        self.probes = 0
        left = np.arange(len(keys), dtype=np.int32)
        slot = self.slot(keys)
        while len(left):
            self.probes += 1
            free = self.rows[slot] < 0
            self.rows[slot[free]] = left[free]  # of several in one slot the last one stays
            lost = self.rows[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        slot = self.slot(keys)
        found = self.rows[slot]
        wrong = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        for _ in range(self.probes):
            if not len(wrong):
                break
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            found[wrong] = self.rows[slot[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.keys[found[wrong]] != keys[wrong])]
        found[wrong] = -1  # not among as many cells as any key was moved by
        return found


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes that end at each byte, as one number; zeros stand before the start."""
    data = data.astype(np.uint64)
    out = data.copy()
    for back in range(1, size):
        out[back:] |= data[:-back] << np.uint64(8 * back)
    return out


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts behind one another with ``ORDER`` zeros before each, and whether a byte is text."""
    gap = b"\0" * ORDER
    joined = np.frombuffer(gap + gap.join(texts), np.uint8)
    real = np.ones(len(joined), bool)
    place = 0
    for t in texts:
        real[place : place + ORDER] = False
        place += ORDER + len(t)
    return joined, real


class ContextTrees:
    """Frozen statistics of all languages.

    For every string of up to ``ORDER`` + 1 bytes that some language has seen, its last byte's full
    cost per language; for every context, the escape per language. Costs hold the whole way down.
    """

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(samples)
        n = len(self.languages)
        counted: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for name in self.languages:
            data, real = padded(samples[name])
            counted.append(
                [np.unique(grams(data, k)[real], return_counts=True) for k in range(1, ORDER + 2)]
            )
        self.tables, self.costs, self.contexts, self.escapes = [], [], [], []
        for k in range(ORDER + 1):  # contexts of k bytes
            keys = np.unique(np.concatenate([c[k][0] for c in counted]))
            prefixes = np.unique(keys >> np.uint64(8))
            escapes = np.zeros((len(prefixes), n), np.float32)
            if k:
                shorter = keys & np.uint64((1 << 8 * k) - 1)
                below = self.costs[k - 1][self.tables[k - 1].find(shorter)].astype(np.float64)
            else:
                below = np.full((len(keys), n), 8.0)
            costs = below
            for j, (own, count) in enumerate(c[k] for c in counted):
                at = np.searchsorted(prefixes, own >> np.uint64(8))
                total = np.bincount(at, count, len(prefixes))
                distinct = np.bincount(at, minlength=len(prefixes))
                seen = total > 0
                escapes[seen, j] = -np.log2(distinct[seen] / (total[seen] + distinct[seen]))
                costs[:, j] += escapes[np.searchsorted(prefixes, keys >> np.uint64(8)), j]
                costs[np.searchsorted(keys, own), j] = -np.log2(
                    count / (total[at] + distinct[at])
                )
            self.tables.append(GramTable(keys))
            self.costs.append(costs.astype(np.float32))
            self.contexts.append(GramTable(prefixes))
            self.escapes.append(escapes)

    def byte_costs(self, data: np.ndarray) -> np.ndarray:
        """Cost in bits of each byte per language."""
        keys = grams(data, ORDER + 1)
        row = self.tables[ORDER].find(keys)
        out = self.costs[ORDER][row]
        rest = np.flatnonzero(row < 0)
        out[rest] = 0
        for k in range(ORDER, -1, -1):
            if not len(rest):
                return out
            if k < ORDER:
                row = self.tables[k].find(keys[rest] & np.uint64((1 << 8 * (k + 1)) - 1))
                known = row >= 0
                out[rest[known]] += self.costs[k][row[known]]
                rest = rest[~known]
            context = (keys[rest] & np.uint64((1 << 8 * (k + 1)) - 1)) >> np.uint64(8)
            row = self.contexts[k].find(context)
            known = row >= 0
            out[rest[known]] += self.escapes[k][row[known]]
        out[rest] += 8
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text per language; long texts are summed over pieces."""
        total = np.zeros((len(texts), len(self.languages)))
        group: list[int] = []
        size = 0

        def flush():
            data, real = padded([texts[i] for i in group])
            costs = self.byte_costs(data)
            costs[~real] = 0
            starts = np.cumsum([0, *[ORDER + len(texts[i]) for i in group[:-1]]])
            total[group] = np.add.reduceat(costs, starts, axis=0, dtype=np.float64)

        for i, t in enumerate(texts):
            if len(t) > SCORE_BYTES:
                data = np.frombuffer(b"\0" * ORDER + t, np.uint8)
                for low in range(ORDER, len(data), SCORE_BYTES):
                    part = self.byte_costs(data[low - ORDER : low + SCORE_BYTES])
                    total[i] += part[ORDER:].sum(0, dtype=np.float64)
                continue
            if group and size + len(t) > SCORE_BYTES:
                flush()
                group, size = [], 0
            group.append(i)
            size += len(t)
        if group:
            flush()
        return total


def training_sample(
    docs: DataFrame,
    usable: Column,
    text: str = "text",
    lang: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> dict[str, list[bytes]]:
    """The documented sample, per language, of the ``MOST_LANGUAGES`` with the most usable rows."""
    rows = docs.where(usable & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.substring(F.col(text), 1, TRAIN_DOC_CHARS).alias("body")
    )
    rows = rows.where(F.length("body") > 0)
    usual = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = dict(tuple(r) for r in usual.collect())
    rows = rows.where(F.col("lang").isin(*counts))
    each = max(1, min(train_docs, TRAIN_CHARS // (TRAIN_DOC_CHARS * max(1, len(counts)))))
    place, limit = hash_place("body"), F.lit(SHARES)
    for name, n in counts.items():
        limit = F.when(F.col("lang") == name, hash_cutoff(n, 2 * each)).otherwise(limit)
    first = rows.where(place < limit).groupBy("lang", place.alias("place"))
    first = first.agg(F.min("body").alias("body"))  # copies are gone before the shuffle
    order = Window.partitionBy("lang").orderBy("place")
    sample: dict[str, list[bytes]] = {}
    for r in first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).collect():
        sample.setdefault(r["lang"], []).append(r["body"].encode())
    return {name: sorted(bodies) for name, bodies in sample.items()}


LANGUAGE = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def scorer(trees: ContextTrees | None) -> Callable[[list], tuple]:
    def work(texts):
        n = len(texts)
        names, scores, rates = ["und"] * n, [0.0] * n, [8.0] * n
        lettered = [i for i, t in enumerate(texts) if trees and t and LETTER.search(t)]
        if lettered:
            coded = [texts[i].encode() for i in lettered]
            lengths = trees.lengths(coded)
            best = lengths.argmin(1)
            least = lengths[np.arange(len(best)), best]
            shares = 1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(1)
            for i, b, s, bits, t in zip(lettered, best, shares, least, coded, strict=True):
                names[i], scores[i], rates[i] = trees.languages[b], float(s), float(bits) / len(t)
        return names, scores, rates

    return work


def predict_language(
    docs: DataFrame,
    sample: dict[str, list[bytes]],
    text: str = "text",
    into: str = "language",
    keep=None,
) -> DataFrame:
    """Append ``lang_pred``, its posterior ``score``, and the code length in ``bits_per_byte``."""
    trees = ContextTrees(sample) if sample else None
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by TRAIN_CHARS
    return annotate(docs, into, LANGUAGE, lambda: scorer(shared.value), text, keep)
