"""Benchmark decontamination by Wu-Manber search over words.

A window is 13 consecutive words of a benchmark item, or the whole of a shorter item. All windows of
one length are searched together. The shift table tells for each block of two words how far the
search may move, since no window could end sooner; a block that ends some window (shift 0) selects
the bucket of windows with that suffix, and the words are compared. Clean text is crossed in steps
of up to twelve words.

Words are runs of digits, ASCII letters (lower-cased) and characters beyond ASCII. A document word in
any occurrence of a window is hit. Null, empty and wordless texts have no words and no hits; a null
or wordless item has no windows. Items with equal ids count once; a null item id is the text "null".

The benchmark is a stated query set. It is searched in blocks of ``BLOCK_BYTES`` of its distinct
rows, so what is broadcast at a time is bounded; every block sees every document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.llm.common import annotate, fresh, quoted
from dockpulse.session import stage

WINDOW = 13
BLOCK_BYTES = 2 << 20  # of items: about 250 MB of tables in a worker

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_LOWER = {b: b + 32 for b in range(0x41, 0x5B)}
FOLD = bytes(_LOWER.get(b, b if b in _KEPT else 0x20) for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class WuManber:
    """Windows of one length in words, with the items that hold them."""

    def __init__(self, length: int, windows: dict[tuple, set[str]]):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shifts: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set[str]]] = defaultdict(dict)
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block : end]
                self.shifts[block] = min(length - end, self.shifts.get(block, self.default))
            self.buckets[window[length - self.block :]][window] = items

    def search(self, words: list[bytes], spans: list, items: set[str]) -> None:
        length, block, default = self.length, self.block, self.default
        shift, buckets = self.shifts.get, self.buckets
        end, last = length, len(words)
        while end <= last:
            suffix = tuple(words[end - block : end])
            step = shift(suffix, default)
            if step:
                end += step
                continue
            found = buckets[suffix].get(tuple(words[end - length : end]))
            if found is not None:
                spans.append((end - length, end))
                items |= found
            end += 1


def searchers(rows: list[tuple[str, str]]) -> list[WuManber]:
    windows: dict[int, dict[tuple, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        words = words_of(text)
        length = min(WINDOW, len(words))
        for start in range(len(words) - length + 1 if length else 0):
            windows[length][tuple(words[start : start + length])].add(item)
    return [WuManber(length, dict(found)) for length, found in sorted(windows.items())]


HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list]:
    """The distinct items, in blocks that each fit a broadcast; one at a time on the driver."""
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.col(text).alias("body"),
    ).where(F.length("body") > 0)
    items = items.distinct()
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item", "body"), F.lit(n))
    for i in range(n):
        yield [tuple(r) for r in items.where(block == i).collect()]


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    into: str = "hits",
    item_id: str = "item_id",
    item_text: str = "text",
    keep=None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Append a struct: ``n_words``, ``n_hit``, ``spans`` of hit words, ``items`` sorted as text.

    Spans are merged: they do not touch each other, start inclusive, end exclusive, in words.
    """
    keep = list(docs.columns if keep is None else keep)
    found, parts = docs, []
    for rows in blocks_of(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def make(shared=shared):
            tables = searchers(shared.value)

            def work(texts):
                out = [[], [], [], []]
                for t in texts:
                    words, spans, items = words_of(t), [], set()
                    for one in tables:
                        one.search(words, spans, items)
                    spans = merged(spans)
                    row = (len(words), [s for s, _ in spans], [e for _, e in spans], sorted(items))
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                return out

            return work

        if parts:  # one block's tables in a task at a time
            found = stage(found, "searched")
        parts.append(fresh(found, f"{into}_part{len(parts)}"))
        found = annotate(found, parts[-1], HITS, make, text, [*dict.fromkeys([*keep, text]), *parts[:-1]])
    starts, ends, items = (
        F.flatten(F.array(*[F.col(p)[name] for p in parts])) for name in ("starts", "ends", "items")
    )
    spans = F.array_sort(F.arrays_zip(starts.alias("start"), ends.alias("end")))
    if len(parts) > 1:
        spans = merged_column(spans)
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    struct = F.struct(
        F.col(parts[0])["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        spans.alias("spans"),
        F.array_sort(F.array_distinct(items)).alias("items"),
    )
    return found.select(*map(quoted, keep), struct.alias(into))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def merged_column(spans):
    """The same over sorted spans of several blocks, as an expression."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(done, span):
        last = F.element_at(done, -1)
        grown = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))
        fits = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(fits, joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, step)


def contaminated(hits: str = "hits"):
    """At least one word hit, and at least one word in twenty."""
    n_hit, n_words = F.col(hits)["n_hit"], F.col(hits)["n_words"]
    return (n_hit > 0) & (20 * n_hit >= n_words)


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bl AS (SELECT item, ws, least(13, len(ws)) AS n FROM bw WHERE len(ws) > 0),
win AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM bl)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM dw, lens WHERE len(ws) >= n)),
occ AS (SELECT doc_id, i, win.n, item FROM dwin JOIN win ON dwin.n = win.n AND dwin.w = win.w),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(DISTINCT item) AS n_items,
         string_agg(DISTINCT item, ',' ORDER BY item) AS joined FROM occ GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
