"""Window search against a plain scan of every position."""

import random
import re

from dockpulse.llm import decontaminate as dc


def plain(text, items):
    def words(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    own, hit, found = words(text), set(), set()
    for item, body in items:
        other = words(body)
        n = min(13, len(other))
        for i in range(len(other) - n + 1 if n else 0):
            for at in range(len(own) - n + 1):
                if own[at : at + n] == other[i : i + n]:
                    hit.update(range(at, at + n))
                    found.add("null" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def cases():
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 5, 14, 20])))) for i in range(12)]
    items += [(None, "Straße, ÉCOLE! 12"), (3, "x y z"), (20, None), (21, ""), (22, "..."), (0, items[0][1])]
    long = " ".join(f"q{i}" for i in range(40))
    items.append((30, long))
    docs = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    docs += ["straße école 12", "straße École 12 x-Y-z", None, "", "?!", long.upper(), "q0 " * 3 + long + " end " + long]
    return docs, items


def test_hits_items_and_blocks(spark):
    docs, items = cases()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").selectExpr("*", "1 AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 60):
        found = dc.find_windows(df, bench, block_bytes=size).collect()
        assert len(found) == len(docs)
        for r in found:
            h = r["hits"]
            assert (h["n_words"], h["n_hit"], h["items"]) == plain(r["text"], items), r
            assert sum(s["end"] - s["start"] for s in h["spans"]) == h["n_hit"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = dc.find_windows(docs, none).select("hits.n_words", "hits.n_hit", dc.contaminated().alias("c"))
    assert sorted(map(tuple, found.collect())) == [(0, 0, False), (2, 0, False)]
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.find_windows(docs.limit(0), bench).count() == 0
