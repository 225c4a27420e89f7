"""Phrases that occur more often than their parts would have it, from weighted acyclic automata.

A count transducer is a minimal acyclic automaton over words: a path is a phrase, the weight of the state
where it ends is its count. It is built from the tree of sorted phrases, from the leaves up: states of one height
with equal weights and arcs are one.

1. Screen. Tasks cut texts into pieces and words. Over about ``SHARD_WORDS`` words they count the hashes of words and
   of pairs (``CODE_BITS`` bits, never the texts), which Spark adds by range of the hash. What reaches the least
   count sets a bit in a table of ``FILTER_BITS`` bits, whatever the input. A bit set by chance costs a phrase that
   step 3 drops, so counts stay exact.
2. Shards. Screened words and pairs, and phrases of three to five words whose pairs are screened, are counted again by
   their texts. The shard's phrases are sorted, cut by prefix range, and one transducer is built for each range
   and language. A range is a part of the hash space of a phrase's first three words, so phrases that start
   alike are together, and a frequent word does not make a range large.
3. Union. The phrases of a range's transducers are read as tables and sorted together, weights of equal phrases
   are added, and ``UNION`` of them at a time become one, however many shards there are. Phrases
   with the least count go on.
4. Parts. Every cut of a candidate asks for its two parts. Asks go to the prefix range of the part, in shares of
   bounded size, sorted, and are composed with the range's transducer: both are walked together, and
   the state where an ask ends is its count. A phrase whose count equals that of a candidate one
   word longer around it is dropped (a longer one with the same count implies such a one).

The score of a cut is floor(1000 * a * n / (l * r)) in whole numbers of any size. Null and empty texts have no
words, a null language counts as ``und``. Repeated rows count each time. An empty table gives no rows. Texts of any
length are counted whole, in windows that overlap by the longest phrase. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockpulse.llm.common import release_memory
from dockpulse.llm.files import mix64
from dockpulse.session import stage

LONGEST = 5
PREFIX = 3
SHARD_WORDS = 2_000_000
WINDOW_BYTES = 4 << 20
RANGE_BYTES = 16 << 20  # of text for each prefix range
FILTER_BITS, CODE_BITS = 27, 40
CODES = 8_000_000  # hashes that a task adds up together
UNION = 64
ASKS = 200_000
TABLE_ROWS = 200_000  # phrases whose transducers are built together, and those of a range that is larger

# What ends a piece, and upper case.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
END = b"."
FOLD = bytes.maketrans(SEPARATORS + bytes(range(65, 91)), END * len(SEPARATORS) + bytes(range(97, 123)))

Phrase = tuple[bytes, ...]


class Transducer:
    """States are numbered from the leaves to the root, which is the last."""

    def __init__(self, labels: list[bytes], finals, first, words, to):
        self.labels, self.finals, self.first, self.words, self.to = labels, finals, first, words, to

    @classmethod
    def build(cls, phrases: Iterable[tuple[Phrase, int]]) -> Transducer:
        """From phrases in rising order, each once."""
        phrases = list(phrases)
        names = sorted({w for p, _ in phrases for w in p})
        numbers = {w: i for i, w in enumerate(names)}
        rows = np.full((len(phrases), max((len(p) for p, _ in phrases), default=0)), -1)
        for i, (p, _) in enumerate(phrases):
            rows[i, : len(p)] = [numbers[w] for w in p]
        return cls.of_table(names, rows, np.array([n for _, n in phrases], np.int64))

    @classmethod
    def of_table(cls, names: list[bytes], rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """From rows of places in ``names``, which rise, filled up with -1; rows rise, each is there once."""
        for _, built in cls.of_tables(names, rows, counts, np.zeros(len(rows), np.int64)):
            return built
        return cls([], *(np.array(x, np.int64) for x in ([0], [0, 0], [], [])))

    @classmethod
    def of_tables(cls, names, rows, counts, key) -> Iterator[tuple[int, Transducer]]:
        """As ``of_table``, one for each value of ``key``, which rises."""
        if not len(rows):
            return
        sizes = (rows >= 0).sum(1)
        same = key[1:] == key[:-1]
        opens = np.append(True, ~same)
        table = opens.cumsum() - 1
        # the states of the trees in order, each before those behind it; a root's depth is 0
        shared = np.zeros(len(rows), np.int64)
        for column in rows.T:
            same = same & (column[1:] == column[:-1]) & (column[1:] >= 0)
            shared[1:] += same
        top = np.where(opens, 0, shared + 1)
        row, depth = spread(sizes - top + 1)
        depth += top[row]
        weight = np.where((depth == sizes[row]) & (depth > 0), counts[row], 0)
        word, of = np.where(depth > 0, rows[row, depth - 1], 0), table[row]
        parent, height = np.zeros((2, len(depth)), np.int64)
        levels = [np.flatnonzero(depth == d) for d in range(rows.shape[1] + 1)]
        for upper, lower in zip(levels, levels[1:], strict=False):
            parent[lower] = upper[np.searchsorted(upper, lower) - 1]
        for lower in levels[:0:-1]:
            np.maximum.at(height, parent[lower], height[lower] + 1)
        # arcs by the state they leave, in the order of their words
        arcs = np.flatnonzero(depth)
        arcs = arcs[np.argsort(parent[arcs], kind="stable")]
        fan = np.bincount(parent[arcs], minlength=len(depth))
        begin = fan.cumsum() - fan
        # states of a table are equal if their weights, and the words and ends of their arcs, are
        number, kept = np.zeros(len(depth), np.int64), []
        known = 0
        for h in range(int(height.max()) + 1):
            own = np.flatnonzero(height == h)
            lane, place = spread(fan[own])
            arc = arcs[begin[own][lane] + place]
            code = mix64(weight[own].astype(np.uint64) ^ mix64(of[own].astype(np.uint64), 5), 1)
            if len(arc):
                link = mix64(mix64(word[arc].astype(np.uint64), 2) ^ number[arc].astype(np.uint64), 3)
                code += np.add.reduceat(mix64(link ^ place.astype(np.uint64), 4), fan[own].cumsum() - fan[own])
            _, one, group = np.unique(code, return_index=True, return_inverse=True)
            like = own[one[group]]
            equal = all((v[own] == v[like]).all() for v in (weight, of, fan))
            if equal and len(arc):
                twin = arcs[begin[like][lane] + place]
                equal = (word[arc] == word[twin]).all() and (number[arc] == number[twin]).all()
            if not equal:  # two codes are the same by chance
                group, one = own_groups(np.stack([of[own], weight[own]], 1), fan[own], word[arc], number[arc])
            number[own] = known + group
            known += len(one)
            kept.append(own[one])
        # states by table, still from the leaves to the root
        state = np.concatenate(kept)
        order = np.argsort(of[state], kind="stable")
        state = state[order]
        ends = np.append(0, np.bincount(of[state]).cumsum())
        place = np.empty(len(state), np.int64)
        place[order] = np.arange(len(state)) - ends[of[state]]
        lane, at = spread(fan[state])
        arc = arcs[begin[state][lane] + at]
        first = np.append(0, fan[state].cumsum())
        labels, words = np.unique(of[arc] * len(names) + word[arc], return_inverse=True)
        split = np.searchsorted(labels, np.arange(len(ends)) * len(names))
        words, to, labels = words - split[of[arc]], place[number[arc]], (labels % max(1, len(names))).tolist()
        for t, value in enumerate(key[opens].tolist()):
            low, high = ends[t], ends[t + 1]
            span = slice(first[low], first[high])
            known = [names[w] for w in labels[split[t] : split[t + 1]]]
            yield value, cls(known, weight[state[low:high]], first[low : high + 1] - first[low], words[span], to[span])

    def to_bytes(self) -> bytes:
        """Little-endian numbers, then the labels with their lengths."""
        sizes = np.array([len(x) for x in self.labels], "<u4")
        parts = [np.array(x, "<u4") for x in (self.first, self.words, self.to)]
        head = np.array([len(self.finals), len(self.words), len(self.labels)], "<u8")
        arrays = [head, np.array(self.finals, "<u8"), *parts, sizes]
        return b"".join([x.tobytes() for x in arrays] + self.labels)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        states, arcs, labels = map(int, np.frombuffer(data, "<u8", 3))
        at, out = 24, []
        for kind, n in (("<u8", states), ("<u4", states + 1), ("<u4", arcs), ("<u4", arcs), ("<u4", labels)):
            out.append(np.frombuffer(data, kind, n, at).astype(np.int64))
            at += n * int(kind[-1])
        finals, first, words, to, sizes = out
        names = []
        for size in sizes.tolist():
            names.append(data[at : at + size])
            at += size
        return cls(names, finals, first, words, to)

    def lists(self) -> Iterator[list[int]]:
        return (np.asarray(x).tolist() for x in (self.finals, self.first, self.words, self.to))

    def phrases(self) -> Iterator[tuple[Phrase, int]]:
        """In the order they were built from."""
        labels, (finals, first, words, to) = self.labels, self.lists()
        todo: list[tuple[int, Phrase]] = [(len(finals) - 1, ())]
        while todo:
            state, phrase = todo.pop()
            if finals[state]:
                yield phrase, finals[state]
            for k in range(first[state + 1] - 1, first[state] - 1, -1):
                todo.append((to[k], (*phrase, labels[words[k]])))

    def compose(self, asks: Iterable[Phrase]) -> Iterator[int]:
        """Weight of each ask, 0 where it leads nowhere. Sorted asks are walked on from where they part."""
        numbers = {w: i for i, w in enumerate(self.labels)}
        finals, first, words, to = self.lists()
        arcs: dict[int, dict[int, int]] = {}
        states: list[int | None] = [len(finals) - 1]
        before: Phrase = ()
        for ask in asks:
            shared = 0
            for x, y in zip(before, ask):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :]
            for word in ask[shared:]:
                state = states[-1]
                if state is not None:
                    if state not in arcs:
                        span = slice(first[state], first[state + 1])
                        arcs[state] = dict(zip(words[span], to[span], strict=True))
                    state = arcs[state].get(numbers.get(word, -1))
                states.append(state)
            before = ask
            yield 0 if states[-1] is None else finals[states[-1]]


def spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place of ``sizes`` as often as it says, and the numbers from 0 beside it."""
    lane = np.repeat(np.arange(len(sizes)), sizes)
    return lane, np.arange(len(lane)) - np.repeat(sizes.cumsum() - sizes, sizes)


def own_groups(held, many, word, number) -> tuple[np.ndarray, np.ndarray]:
    """The group of each state by what it holds, and the first state of each group."""
    found: dict[tuple, int] = {}
    keys = [
        (*h, *word[end - n : end].tolist(), *number[end - n : end].tolist())
        for h, n, end in zip(held.tolist(), many.tolist(), many.cumsum().tolist(), strict=True)
    ]
    group = np.array([found.setdefault(k, len(found)) for k in keys], np.int64)
    return group, np.unique(group, return_index=True)[1]


def united(automata: list[Transducer]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words that rise, and phrases of all automata as rising rows of places in them, weights added."""
    labels = [w for a in automata for w in a.labels]
    names = sorted(set(labels))
    numbers = {w: i for i, w in enumerate(names)}
    rank = np.fromiter(map(numbers.__getitem__, labels), np.int64, len(labels))
    # all automata as one with many roots
    low = np.cumsum([(0, 0, 0), *((len(a.finals), len(a.words), len(a.labels)) for a in automata)], 0)
    finals = np.concatenate([a.finals for a in automata])
    first = np.concatenate([a.first[:-1] + at for a, at in zip(automata, low[:, 1].tolist(), strict=False)])
    many = np.concatenate([np.diff(a.first) for a in automata])
    word = rank[np.concatenate([a.words + at for a, at in zip(automata, low[:, 2].tolist(), strict=False)])]
    to = np.concatenate([a.to + at for a, at in zip(automata, low[:, 0].tolist(), strict=False)])
    state, path = low[1:, 0] - 1, np.zeros((len(automata), 0), np.int64)
    parts, counts = [], []
    while len(state):
        there = finals[state] > 0
        parts.append(path[there])
        counts.append(finals[state[there]])
        lane, place = spread(many[state])
        arc = first[state][lane] + place
        state, path = to[arc], np.concatenate([path[lane], word[arc, None]], 1)
    rows = np.full((sum(map(len, parts)), max(0, path.shape[1] - 1)), -1)
    at = 0
    for part in parts:
        rows[at : at + len(part), : part.shape[1]] = part
        at += len(part)
    counts = np.concatenate(counts)
    if not len(rows):
        return names, rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    starts = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1)))
    return names, rows[starts], np.add.reduceat(counts, starts)


def phrases_of(names: list[bytes], rows: np.ndarray) -> Iterator[Phrase]:
    sizes = (rows >= 0).sum(1).tolist()
    return (tuple([names[w] for w in r[:n]]) for r, n in zip(rows.tolist(), sizes, strict=True))


def union(automata: list[Transducer]) -> Iterator[tuple[Phrase, int]]:
    """Phrases of all automata in order, weights added."""
    names, rows, counts = united(automata)
    return zip(phrases_of(names, rows), counts.tolist(), strict=True)


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def phrase_hashes(columns: list[np.ndarray], lang: str) -> np.ndarray:
    out = mix64(np.full(len(columns[0]), word_hash(lang.encode()), np.uint64), len(columns))
    for i, c in enumerate(columns):
        out = mix64(out ^ c, 10 + i)
    return out


def range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def code_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - CODE_BITS)


def summed_codes(codes: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, rising, with its count; counts beyond ``least`` are all the same."""
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    sums = np.add.reduceat(counts, starts) if len(codes) else counts
    return codes[starts], np.minimum(sums, least)


def pack_codes(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Columns of numbers: 8 high bits of all codes, 32 low bits, counts."""
    n = np.array([len(codes)], "<u8")
    return b"".join([n.tobytes(), (codes >> np.uint64(32)).astype("u1").tobytes(), codes.astype("<u4").tobytes(), counts.astype("<u4" if counts.max() > 255 else "u1").tobytes()])


def unpack_codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    high, low = np.frombuffer(data, "u1", n, 8).astype(np.uint64), np.frombuffer(data, "<u4", n, 8 + n)
    counts = np.frombuffer(data, "u1" if len(data) == 8 + 6 * n else "<u4", n, 8 + 5 * n)
    return high << np.uint64(32) | low, counts.astype(np.int64)


class HashFilter:
    """Bits of hashes that may be frequent."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0


class Shard:
    """Words of a part of the corpus, as numbers."""

    def __init__(self, ranges: int, keep: HashFilter | None = None):
        self.ranges, self.keep = ranges, keep
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {END: 0}
        self.held: dict[str, list[tuple[np.ndarray, int]]] = {}  # numbers, and how many were counted before
        self.size = self.vocabulary = 0

    def add(self, lang: str, words: list[bytes], old: int = 0) -> None:
        numbers, at = self.numbers, len(self.numbers)
        for w in set(words).difference(numbers):
            numbers[w] = at
            at += 1
            self.vocabulary += len(w)
        ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        self.held.setdefault(lang, []).append((ids, old))
        self.size += len(words)

    def full(self) -> bool:
        return self.size >= SHARD_WORDS or self.vocabulary >= 8 * SHARD_WORDS

    def of_languages(self, rank: np.ndarray) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """``lang``, its words (``rank[0]`` ends a piece), and which of them were counted before."""
        for lang, parts in self.held.items():
            ids = np.concatenate([x for p, _ in parts for x in (p, np.zeros(1, np.int32))])
            old = np.concatenate([np.arange(len(p) + 1) < o for p, o in parts])
            yield lang, rank[ids], old

    def screened(self, least: int) -> tuple[dict[str, int], list[tuple[int, bytes]]]:
        """Words of each language, and by range the codes and counts of words and pairs; then it is empty."""
        hashes = np.fromiter(map(word_hash, self.numbers), np.uint64, len(self.numbers))
        totals, codes, counts = {}, [], []
        for lang, words, old in self.of_languages(np.arange(len(hashes))):
            n = np.bincount(words[(words != 0) & ~old], minlength=len(hashes))
            totals[lang] = int(n.sum())
            codes.append(code_of(phrase_hashes([hashes], lang))[n > 0])
            counts.append(n[n > 0])
            at = np.flatnonzero((words[:-1] != 0) & (words[1:] != 0) & ~old[1:])
            pair = code_of(phrase_hashes([hashes[words[at]], hashes[words[at + 1]]], lang))
            pair, n = np.unique(pair, return_counts=True)
            codes.append(pair)
            counts.append(n)
        self.clear()
        if not codes:
            return totals, []
        code, count = summed_codes(np.concatenate(codes), np.concatenate(counts), least)
        place = (code * np.uint64(self.ranges)) >> np.uint64(CODE_BITS)
        edges = np.searchsorted(place, np.arange(self.ranges + 1, dtype=np.uint64)).tolist()
        parts = [(i, low, high) for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)) if low < high]
        return totals, [(i, pack_codes(code[low:high], count[low:high])) for i, low, high in parts]

    def transducers(self) -> Iterator[tuple[str, int, bytes]]:
        """``lang, range, automaton`` of what was added; the shard is empty afterwards."""
        names = sorted(self.numbers)
        order = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))
        rank = np.empty(len(names), np.int64)  # numbers in the order of the words
        rank[order] = np.arange(len(names))
        hashes = np.fromiter(map(word_hash, names), np.uint64, len(names))
        for lang, words, old in self.of_languages(rank):
            found = self.counted(words, words == rank[0], old, hashes, lang)
            yield from self.cut(found, names, hashes, lang)
        self.clear()

    def counted(self, words, ends, old, hashes, lang) -> list[tuple[np.ndarray, np.ndarray]]:
        """Tables of phrases (one row each) with counts, by length."""
        n = np.bincount(words[~ends & ~old], minlength=len(hashes))
        there = np.flatnonzero((n > 0) & self.keep(phrase_hashes([hashes], lang)))
        out = [(there[:, None], n[there])]
        may = ~ends[:-1] & ~ends[1:]
        at = np.flatnonzero(may)
        may[at] = self.keep(phrase_hashes([hashes[words[at]], hashes[words[at + 1]]], lang))
        at = np.flatnonzero(may)
        code = words[at]
        for n in range(2, LONGEST + 1):
            if n > 2:  # the phrase of n - 1 words here, and the pair at its end
                on = np.flatnonzero(may[np.minimum(at + n - 2, len(may) - 1)] & (at + n - 2 < len(may)))
                at, code = at[on], code[on]
            code = code * len(hashes) + words[at + n - 1]
            _, first, code = np.unique(code, return_index=True, return_inverse=True)
            count = np.bincount(code[~old[at + n - 1]], minlength=len(first))
            starts = at[first[count > 0]]
            out.append((np.stack([words[starts + i] for i in range(n)], 1), count[count > 0]))
        return out

    def cut(self, found, names, hashes, lang) -> Iterator[tuple[str, int, bytes]]:
        wide = np.full((sum(len(x) for x, _ in found), LONGEST), -1)
        count = np.concatenate([n for _, n in found])
        place = np.zeros(len(wide), np.int64)
        low = 0
        for table, _ in found:
            high = low + len(table)
            wide[low:high, : table.shape[1]] = table
            head = [hashes[table[:, i]] for i in range(min(PREFIX, table.shape[1]))]
            place[low:high] = range_of(phrase_hashes(head, lang), self.ranges)
            low = high
        order = np.lexsort([*(wide[:, i] for i in range(LONGEST - 1, -1, -1)), place])
        place = place[order]
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        starts = starts[np.append(True, np.diff(starts // TABLE_ROWS) > 0)] if len(starts) else starts
        for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(place)], strict=False):
            own = order[low:high]
            for value, built in Transducer.of_tables(names, wide[own], count[own], place[low:high]):
                yield lang, value, built.to_bytes()


def windows(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, piece ends among them, in windows; with each, how many words it repeats."""
    start, tail = 0, []
    while True:
        stop = start + WINDOW_BYTES
        if stop < len(text):
            blank = re.compile(rb"[ \t]").search(text, stop)
            stop = blank.start() if blank else len(text)
        words = text[start:stop].translate(FOLD).replace(b"\t", b" ").replace(END, b" . ").split(b" ")
        words = list(filter(None, words))
        yield tail + words, len(tail)
        if stop >= len(text):
            return
        tail = (tail + words)[-(LONGEST - 1) :]
        start = stop


def shards_of(batches: Iterable[pa.RecordBatch], shard: Shard) -> Iterator[Shard]:
    """The shard, each time it is full and at the end, from batches of (text, lang)."""
    for batch in batches:
        langs = batch.column(1)
        for i, text in enumerate(batch.column(0).cast(pa.binary())):
            if text.is_valid:
                for words, old in windows(text.as_py()):
                    shard.add(langs[i].as_py(), words, old)
                    if shard.full():
                        yield shard
    yield shard


def in_batches(rows: Iterable[tuple], names: list[str], kinds: list, data: int) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; ``data`` is the column of bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[data] or b"")
        if size > WINDOW_BYTES:
            yield batch_of(held, names, kinds)
            held, size = [], 0
    if held:
        yield batch_of(held, names, kinds)


def batch_of(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def screen(docs: DataFrame, least: int, ranges: int) -> tuple[DataFrame, object]:
    """Words of each language (``lang, total``), and the broadcast table of what may be frequent."""
    names, kinds = ["lang", "total", "range", "codes"], [pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def count(batches):
        def rows():
            for shard in shards_of(batches, Shard(ranges)):
                totals, parts = shard.screened(least)
                yield from ((lang, n, None, None) for lang, n in totals.items())
                yield from ((None, None, place, data) for place, data in parts)

        yield from in_batches(rows(), names, kinds, 3)
        release_memory()

    counted = docs.mapInArrow(count, "lang string, total long, range long, codes binary")
    dealt = counted.repartition("range").sortWithinPartitions("range")

    def add(batches):
        key, held, size = None, [], 0
        totals: dict[str, int] = {}

        def finish():
            codes, counts = summed_codes(*(np.concatenate(c) for c in zip(*held, strict=True)), least)
            bit = (codes[counts >= least] >> np.uint64(CODE_BITS - FILTER_BITS)).astype(np.int64)
            word, bits = bit >> 6, np.left_shift(np.int64(1), bit & 63)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
            bits = np.bitwise_or.reduceat(bits, starts) if len(word) else bits
            return batch_of_columns(pa.nulls(len(starts), pa.string()), pa.array(word[starts]), pa.array(bits))

        for batch in batches:
            for lang, total, place, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place is None:
                    totals[lang] = totals.get(lang, 0) + total
                    continue
                if key != place and held:
                    yield finish()
                    held, size = [], 0
                key = place
                held.append(unpack_codes(data))
                size += len(held[-1][0])
                if size > CODES:
                    held = [summed_codes(*(np.concatenate(c) for c in zip(*held, strict=True)), least)]
                    size = 0
        if held:
            yield finish()
        if totals:
            values = pa.array(totals.values(), pa.int64())
            yield batch_of_columns(pa.array(totals, pa.string()), values, pa.nulls(len(totals), pa.int64()))
        release_memory()

    def batch_of_columns(*columns):
        return pa.RecordBatch.from_arrays(list(columns), names=["lang", "value", "bits"])

    # What is written is small, and the texts are counted once for both results.
    added = stage(dealt.mapInArrow(add, "lang string, value long, bits long"), "screened")
    totals = added.where("lang is not null").groupBy("lang").agg(F.sum("value").alias("total"))
    bits = added.where("lang is null").groupBy(F.col("value").alias("word")).agg(F.bit_or("bits").alias("bits"))
    rows = bits.toPandas()  # 2 ** 21 rows at most
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return totals, docs.sparkSession.sparkContext.broadcast(table)


def shard_transducers(docs: DataFrame, ranges: int, keep) -> DataFrame:
    """``lang, range, automaton`` of every shard. ``docs`` has (text, lang); ``keep`` is the broadcast table."""

    def run(batches):
        shards = shards_of(batches, Shard(ranges, HashFilter(keep.value)))
        rows = (row for shard in shards for row in shard.transducers())
        yield from in_batches(rows, ["lang", "range", "automaton"], [pa.string(), pa.int64(), pa.binary()], 2)
        release_memory()

    return docs.mapInArrow(run, "lang string, range long, automaton binary")


FREQUENT = "lang string, range long, phrase string, words int, n long, automaton binary"


def summed(shards: DataFrame, least: int) -> DataFrame:
    """The union of all shards' transducers by range: a row per phrase with at least ``least``
    occurrences, and a row (``phrase`` null) with the range's transducer."""
    ranged = shards.repartition("lang", "range").sortWithinPartitions("lang", "range")

    def run(batches):
        def finish(key, held):
            names, rows, counts = united(held)
            rows, counts = rows[counts >= least], counts[counts >= least]
            for p, n in zip(phrases_of(names, rows), counts.tolist(), strict=True):
                yield (*key, b" ".join(p).decode(), len(p), n, None)
            yield (*key, None, 0, 0, Transducer.of_table(names, rows, counts).to_bytes())

        def rows():
            key, held = None, []
            for batch in batches:
                for lang, place, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if key != (lang, place):
                        if held:
                            yield from finish(key, held)
                        key, held = (lang, place), []
                    held.append(Transducer.from_bytes(data))
                    if len(held) >= UNION:
                        held = [Transducer.of_table(*united(held))]
            if held:
                yield from finish(key, held)

        names = ["lang", "range", "phrase", "words", "n", "automaton"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        yield from in_batches(rows(), names, kinds, 5)

    return ranged.mapInArrow(run, FREQUENT)


def part_counts(candidates: DataFrame, automata: DataFrame, ranges: int) -> DataFrame:
    """``lang, phrase, a, cut, side, part, n``: the count of both parts of every cut of every candidate."""

    def cuts(batches):
        for batch in batches:
            out: list[tuple] = []
            heads: dict[tuple[str, int], list[tuple]] = {}  # asks by language and words of the prefix
            for lang, phrase, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = phrase.encode().split(b" ")
                hashes = tuple(map(word_hash, words))
                for k in range(1, len(words)):
                    for side, part, head in ((0, words[:k], hashes[:k]), (1, words[k:], hashes[k:])):
                        head = head[:PREFIX]
                        heads.setdefault((lang, len(head)), []).append((len(out), *head))
                        out.append((lang, phrase, a, k, side, b" ".join(part).decode()))
            place = np.zeros(len(out), np.int64)
            for (lang, _), asked in heads.items():
                own, *head = np.array(asked, np.uint64).T
                place[own.astype(np.int64)] = range_of(phrase_hashes(head, lang), ranges)
            columns = [list(c) for c in zip(*out, strict=True)] or [[]] * 6
            columns.insert(1, place)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = ["lang", "range", "phrase", "a", "cut", "side", "part"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    ddl = "lang string, range long, phrase string, a long, cut int, side int, part string"
    asks = stage(candidates.select("lang", "phrase", "a").mapInArrow(cuts, ddl), "asks")
    # a range that many asks want is lent to several shares of them
    shares = asks.groupBy("lang", "range").agg(F.ceil(F.count("*") / ASKS).cast("int").alias("shares"))
    shares = stage(shares, "ask-shares")
    lent = automata.join(shares, ["lang", "range"]).select(
        "lang", "range", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "automaton"
    )
    sent = asks.join(shares, ["lang", "range"]).withColumn(
        "share", F.pmod(F.xxhash64("phrase", "cut", "side"), F.col("shares")).cast("int")
    )
    both = sent.drop("shares").unionByName(lent, allowMissingColumns=True)
    keys = ["lang", "range", "share"]
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, F.col("automaton").isNull(), "part")

    def answer(batches):
        key, held = None, []  # the range's automaton
        for batch in batches:
            columns = {c: batch.column(batch.schema.names.index(c)).to_pylist() for c in (*keys, "part", "automaton")}
            places = list(zip(*(columns[c] for c in keys), strict=True))
            found = np.zeros(batch.num_rows, np.int64)
            for here, rows in groupby(range(batch.num_rows), places.__getitem__):
                if here != key:
                    key, held = here, []
                asked = []
                for i in rows:
                    if columns["automaton"][i] is None:
                        asked.append(i)
                    else:
                        held.append(Transducer.from_bytes(columns["automaton"][i]))
                parts = [tuple(columns["part"][i].encode().split(b" ")) for i in asked]
                for automaton in held:
                    found[asked] += np.fromiter(automaton.compose(parts), np.int64, len(parts))
            answers = batch.select(["lang", "phrase", "a", "cut", "side", "part"]).append_column("n", pa.array(found))
            yield answers.filter(batch.column(batch.schema.names.index("automaton")).is_null())

    return dealt.mapInArrow(answer, "lang string, phrase string, a long, cut int, side int, part string, n long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of every language by score, count
    (both falling) and phrase; ``l`` and ``r`` are the counts of the parts at the lowest-scoring cut."""
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(F.col(text).alias("text"), named)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 + size // RANGE_BYTES
    totals, keep = screen(rows, least, ranges)
    found = stage(summed(shard_transducers(rows, ranges, keep), least), "phrases")
    candidates = found.where("words > 1").select("lang", "phrase", F.col("n").alias("a"))
    automata = found.where("automaton is not null").select("lang", "range", "automaton")
    parts = stage(part_counts(candidates, automata, ranges), "parts")

    words = F.size(F.split("phrase", " "))
    inside = ((F.col("side") == 0) & (F.col("cut") == words - 1)) | ((F.col("side") == 1) & (F.col("cut") == 1))
    covered = parts.where(inside & (F.col("n") == F.col("a"))).select("lang", F.col("part").alias("phrase")).distinct()
    cuts = parts.groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r")
    )
    wide = [F.col(c).cast("decimal(18,0)") for c in ("a", "total", "l", "r")]
    cuts = cuts.join(totals, "lang").withColumns(
        {"_over": F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], "_under": wide[2] * wide[3]}
    )
    scored = cuts.withColumn("score", F.expr("_over div _under"))  # whole numbers of up to 38 digits
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "total")).alias("best"))
    left = best.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "best.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
    lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS total FROM w GROUP BY lang),
c AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.n AS l, r.n AS r, t.total,
    CAST((1000::HUGEINT * c.a * t.total) // (l.n::HUGEINT * r.n) AS BIGINT) AS score
  FROM c JOIN t ON t.lang = c.lang
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
b AS (
  SELECT lang, phrase, a, l, r, total, score FROM s
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT x.lang, x.phrase FROM f AS y
  JOIN f AS x ON x.lang = y.lang AND x.k > 1 AND x.k < y.k AND 100 * y.n >= 100 * x.n
    AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
o AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, total AS n, score
  FROM b WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM inside))
SELECT * FROM o WHERE rank <= 2000"""
