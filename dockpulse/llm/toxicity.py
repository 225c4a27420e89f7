"""Toxicity through a noisy channel.

Writers hide words behind signs (``1d10t``), spaces or dots (``i d i o t``) and repeated letters
(``idiooot``). Each odd-looking token, and each run of single characters, becomes a lattice of what
its characters may stand for, and Viterbi finds the likeliest letters under a character model (trigrams
over the Latin letters, counted over every document). The restored text is then scored by logistic
regression over the beginnings of its words and its short words. Single characters are joined over any run
of gaps and white space, and any letter that stands twice may have been meant once; tokens of any length go
through the lattice.

Only the regression reads labels. It is fitted on a documented sample: the ``TRAIN_DOCS`` usable labelled
documents that come first by a hash of their id. From them the word beginnings that stand out among
toxic documents are chosen (``LEAST_TOXIC`` toxic documents, ``LEAST_Z`` deviations above chance, at
most ``MOST_FEATURES``) and weighed. Scoring reads every whole text, and nothing but the text.

An id that stands at several texts lends the sample one of them, that which is first by hash, so the sample
has one row an id; each row is scored by its own text. Without documents there is no sample and no score.
Null and empty texts have no features; their score is the bias. Labels that are null, or stand at no
document, are left out; an id with several labels is toxic if one is. Without labels all scores are 0.
"""

from __future__ import annotations

import math
import re
from functools import cache, cached_property
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.llm.common import SizedCache, annotate, hash_cutoff, hash_place, release_memory
from dockpulse.session import stage

TRAIN_DOCS = 30_000
MOST_FEATURES = 4_000
LEAST_TOXIC, LEAST_Z = 3, 4.0
FEATURE_BITS = 20
RIDGE = 0.3
STEPS = 400
KNOWN_BYTES = 48 << 20
COUNTED = 1 << 20  # characters that are counted together

LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
EDGE, OTHER = 0, 1
CLASS_OF = {c: i + 2 for i, c in enumerate(LETTERS)}
CLASSES = len(LETTERS) + 2
PAIRS, START = CLASSES**2, EDGE * CLASSES + EDGE
CODES = np.full(0x181, OTHER, np.int32)  # by code point; the last cell stands for all beyond
for _c, _i in CLASS_OF.items():
    CODES[ord(_c)] = _i
for _c in " \t\n\r\f\v\x85\xa0":
    CODES[ord(_c)] = EDGE

# What a sign may stand for. Fixed values.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
GAPS = " .-_*~'/"
SIGN_COST, GAP_COST, REPEAT_COST = -3.0, -1.5, -0.7
WILD_COST = -1.0 - math.log(26)

WORD = re.compile(r"[^\W\d_]+")
LONE, GAP = r"[^\W_]|[@$!|+(€£]", r"[\s.\-_*~'/]"
SPACED = re.compile(rf"(?<![^\W_@$!|+(€£])(?:{LONE})(?:{GAP}+(?:{LONE})){{2,}}(?![^\W_@$!|+(€£])")
GAP_RUN = re.compile(rf"{GAP}+")
SIGN_INSIDE = re.compile(r"[0-9@$!|+(€£*._~\-][^\W\d_]|[^\W\d_][0-9@$|+€£*]")
REPEATED = re.compile(r"([^\W\d_])\1")


class CharModel:
    """Smoothed trigram log probabilities of character classes."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        n = np.zeros(CLASSES**3)
        n[grams] = counts
        n = n.reshape(CLASSES, CLASSES, CLASSES)
        one = (n.sum((0, 1)) + 1) / (n.sum() + CLASSES)
        two = n.sum(0)
        two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
        self.log = np.log((n + 5 * two[None]) / (n.sum(2, keepdims=True) + 5))

    @cached_property
    def rows(self) -> list:
        return self.log.ravel().tolist()  # plain numbers are much faster to look up one by one

    def restore(self, token: str) -> str:
        """The likeliest reading of a lower-case token; what is no letter becomes a space.

        A state is the last two classes, as one number.
        """
        log = self.rows
        states = {START: (0.0, None)}
        before = ""
        for i, c in enumerate(token):
            again, before = c == before, c
            hidden = c == "*" and i > 0 and token[i - 1].isalpha() and token[i + 1 : i + 2].isalpha()
            options = readings(c, again, hidden)
            if len(options) == len(states) == 1:  # a plain letter after plain letters
                ((pair, (score, trail)),) = states.items()
                ((k, cost, letter),) = options
                value = score + cost + log[pair * CLASSES + k]
                states = {pair * CLASSES % PAIRS + k: (value, (trail, letter))}
                continue
            reached: dict[int, tuple] = {}
            for pair, (score, trail) in states.items():
                past = pair * CLASSES
                for k, cost, letter in options:
                    if k is None:
                        state, value, made = pair, score + cost, trail
                    else:
                        state = past % PAIRS + k
                        value = score + cost + log[past + k]
                        made = (trail, letter)
                    held = reached.get(state)
                    if held is None or value > held[0]:
                        reached[state] = (value, made)
            states = reached
        _, trail = max(((s + log[p * CLASSES + EDGE], t) for p, (s, t) in states.items()), key=first)
        letters = []
        while trail is not None:
            trail, letter = trail
            letters.append(letter)
        return "".join(reversed(letters))


first = itemgetter(0)


@cache
def readings(c: str, repeated: bool, hidden: bool) -> list[tuple[int | None, float, str]]:
    """What a character may stand for: class, log cost and letter; class None is nothing."""
    own = EDGE if c in GAPS else CLASS_OF.get(c, OTHER)
    out: list[tuple[int | None, float, str]] = [(own, 0.0, c if c.isalpha() else " ")]
    out += [(CLASS_OF[x], SIGN_COST, x) for x in SIGNS.get(c, "")]
    if c in GAPS:
        out.append((None, GAP_COST, ""))
    if hidden:
        out += [(CLASS_OF[x], WILD_COST, x) for x in LETTERS[:26]]
    if repeated:
        out.append((None, REPEAT_COST, ""))
    return out


def feature(part: str) -> int:
    return xxhash.xxh32_intdigest(part) & ((1 << FEATURE_BITS) - 1)


class Reader:
    """Features of texts, with the work kept for tokens that come again."""

    def __init__(self, model: CharModel, chosen: dict[int, int] | None = None):
        self.model, self.chosen = model, chosen
        self.known = SizedCache(KNOWN_BYTES)

    def words(self, token: str) -> set[str]:
        words = set(WORD.findall(token))
        if SIGN_INSIDE.search(token) or REPEATED.search(token) or " " in token:
            words.update(WORD.findall(self.model.restore(token)))
        return words

    def of_token(self, token: str) -> tuple[int, ...]:
        found = self.known.get(token)
        if found is None:
            parts = set()
            for w in self.words(token):
                parts.update(feature(w[:n]) for n in range(3, min(len(w), 6) + 1))
                if len(w) <= 10:
                    parts.add(feature(w + "$"))
            if self.chosen is not None:
                parts = {self.chosen[p] for p in parts if p in self.chosen}
            found = tuple(parts)
            self.known.keep(token, found, 24 * len(found))
        return found

    def of_text(self, text: str | None) -> set[int]:
        if not text:
            return set()
        low = text.lower()
        tokens = set(low.split())
        tokens.update(GAP_RUN.sub(" ", run) for run in SPACED.findall(low))
        out: set[int] = set()
        for t in tokens:
            found = self.of_token(t)
            if found:
                out.update(found)
        return out


def char_counts(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of character classes over all texts; at most CLASSES ** 3 rows whatever the input."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        held, size, tail = [], 0, " " * 2

        def count(last=False):
            joined = "".join([tail, *held, " " if last else ""])
            for low in range(0, len(joined) - 2, COUNTED):
                codes = np.frombuffer(joined[low : low + COUNTED + 2].encode("utf-32-le"), np.uint32)
                classes = CODES[np.minimum(codes, len(CODES) - 1)]
                grams = classes[:-2] * CLASSES
                grams += classes[1:-1]
                grams *= CLASSES
                grams += classes[2:]
                np.add(total, np.bincount(grams, minlength=len(total)), out=total)
            return joined[-2:]

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if text:
                    held += [text.lower(), "  "]
                    size += len(text)
                if size >= COUNTED:
                    tail, held, size = count(), [], 0
        count(last=True)
        release_memory()
        grams = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams, pa.int64()), pa.array(total[grams], pa.int64())], names=["gram", "n"]
        )

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "gram long, n long")
    rows = counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)


def training_sample(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", train_docs: int = TRAIN_DOCS
) -> DataFrame:
    """Text and label of the documented sample. Its ids are few, so the texts need no shuffle."""
    marked = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    place = hash_place("doc_id")
    marked = marked.where(place < hash_cutoff(marked.count(), train_docs))
    marked = marked.orderBy(place, "doc_id").limit(train_docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label")
    one = found.agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    return stage(one.select("text", "label"), "labelled")


def sample_features(sample: DataFrame, model) -> DataFrame:
    """The features of each text of the sample, read once for choosing and for fitting."""

    def run(batches):
        reader = Reader(model.value)
        for batch in batches:
            found = [list(reader.of_text(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "label"]
            )
        del reader
        release_memory()

    return stage(sample.mapInArrow(run, "found array<int>, label int"), "features")


def choose_features(sample: DataFrame, most: int = MOST_FEATURES) -> list[int]:
    """Word beginnings that stand in more toxic documents than chance would have it."""

    def run(batches):
        counts = np.zeros((2, 1 << FEATURE_BITS), np.int64)
        for batch in batches:
            lists, labels = batch.column(0), batch.column(1).to_numpy()
            found = lists.flatten().to_numpy()
            marks = np.repeat(labels, lists.value_lengths().to_numpy()) == 1
            np.add(counts[0], np.bincount(found, minlength=1 << FEATURE_BITS), out=counts[0])
            np.add(counts[1], np.bincount(found[marks], minlength=1 << FEATURE_BITS), out=counts[1])
        ids = np.flatnonzero(counts[0])
        values = [ids, counts[0, ids], counts[1, ids]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, pa.int64()) for v in values], names=["feature", "n", "toxic"]
        )

    totals = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("t")).first()
    if not totals["t"] or totals["t"] == totals["n"]:
        return []
    rate = totals["t"] / totals["n"]
    counted = sample.mapInArrow(run, "feature long, n long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    z = (F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate)))
    good = counted.withColumn("z", z).where((F.col("toxic") >= LEAST_TOXIC) & (F.col("z") >= LEAST_Z))
    return [r[0] for r in good.orderBy(F.desc("z"), "feature").limit(most).collect()]


def fit_weights(rows: list[list[int]], labels: np.ndarray, n: int) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; the last weight is the bias."""
    sizes = np.array([len(r) for r in rows])
    doc = np.repeat(np.arange(len(rows)), sizes)
    col = np.concatenate([np.array(r, np.int64) for r in rows] + [np.zeros(0, np.int64)])
    rate = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    weights = np.zeros(n + 1)
    weights[n] = math.log(rate / (1 - rate))
    ahead, old = weights.copy(), weights.copy()
    # A step that is safe per weight: documents with the feature, times the features beside it.
    reach = np.bincount(col, sizes[doc] + 1.0, n)
    bound = 0.25 * np.append(reach, (sizes + 1).sum()) + RIDGE
    ridge = np.append(np.full(n, RIDGE), 0.0)
    for step in range(STEPS):
        margin = np.bincount(doc, ahead[col], len(rows)) + ahead[n]
        error = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels
        slope = np.append(np.bincount(col, error[doc], n), error.sum()) + ridge * ahead
        old, weights = weights, ahead - slope / bound
        ahead = weights + step / (step + 3) * (weights - old)
    return weights


class ToxicityModel:
    def __init__(self, model: CharModel, features: list[int], weights: np.ndarray | None):
        self.model, self.weights = model, weights
        self.chosen = {f: i for i, f in enumerate(features)}


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column) -> ToxicityModel:
    """``usable`` says of a row of ``labels`` whether it may be learned from."""
    spark = docs.sparkSession
    model = CharModel(*char_counts(docs))
    shared = spark.sparkContext.broadcast(model)
    sample = sample_features(training_sample(docs, labels, usable), shared)
    features = choose_features(sample)
    places = np.full(1 << FEATURE_BITS, -1, np.int32)
    places[features] = np.arange(len(features), dtype=np.int32)

    def run(batches):
        for batch in batches:
            found = [np.sort(places[np.array(r, np.int64)]) for r in batch.column(0).to_pylist()]
            found = [r[r >= 0] for r in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)], names=["found", "label"]
            )

    rows = sample.mapInArrow(run, "found array<int>, label int").collect()  # at most TRAIN_DOCS, one an id
    if not rows:
        return ToxicityModel(model, [], None)
    marks = np.array([r["label"] for r in rows], float)
    return ToxicityModel(model, features, fit_weights([r["found"] for r in rows], marks, len(features)))


SCORE = T.StructType([T.StructField("score", T.DoubleType())])


def score_toxicity(
    docs: DataFrame, fitted: ToxicityModel, text: str = "text", into: str = "toxicity", keep=None
) -> DataFrame:
    """Append ``score``, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def make():
        own = shared.value
        reader = Reader(own.model, own.chosen)

        def one(t):
            if own.weights is None:
                return 0.0
            margin = own.weights[-1] + sum(own.weights[i] for i in reader.of_text(t))
            return 1 / (1 + math.exp(-min(max(margin, -50.0), 50.0)))

        return lambda texts: [[one(t) for t in texts]]

    return annotate(docs, into, SCORE, make, text, keep)
