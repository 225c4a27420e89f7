"""Phrases against brute force, and the automata against plain tables of counts."""

import random
import re
import sys
from collections import Counter, defaultdict

from dockpulse.llm import collocations as c

SCHEMA = "text string, lang string, phrase string, range int, n long"


def pieces_of(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", low)]


def counts(rows):
    found = defaultdict(Counter)
    totals = Counter()
    for text, lang in rows:
        lang = lang or "und"
        for words in pieces_of(text):
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    found[lang][tuple(words[i : i + k])] += 1
    return found, totals


def brute(rows, least, top):
    found, totals = counts(rows)
    out = []
    for lang, f in found.items():
        scored = []
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in kept.items():
            longer = (q for q in kept if len(q) > len(p) and kept[q] == a)
            if any(p == q[i : i + len(p)] for q in longer for i in range(len(q))):
                continue
            cuts = []
            for k in range(1, len(p)):
                left, right = f[p[:k]], f[p[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["a", "B", "c\x01", "ü", "dd", "e", "\x00f", "g"]
    stock = [" ".join(rng.choices(words, k=6)) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = [rng.choice([*stock, *words, ", ", "\t", "\n", "x. y"]) for _ in range(rng.randrange(12))]
        rows.append((" ".join(parts), rng.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", None), ("... ,", "fr"), *rows[:5], (" ".join(["long words"] * 300), "en")]


def got(spark, rows, least, top):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    out = c.collocations(df, least=least, top=top)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert dict(out.dtypes) == {k: "string" if k in ("lang", "phrase") else "bigint" for k in out.columns}
    return sorted(tuple(r) for r in out.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(c, "RANGE_BYTES", 3000)  # several ranges
    monkeypatch.setattr(c, "ASKS", 10)  # and several shares of asks
    rows = corpus(1, 250)
    assert got(spark, rows, 4, 2000) == brute(rows, 4, 2000)
    assert got(spark, rows, 6, 3) == brute(rows, 6, 3)


def test_empty_table_and_nothing_frequent(spark):
    assert got(spark, [], 2, 5) == []
    assert got(spark, [("a b c", "en"), (None, None)], 2, 5) == []


def test_hot_language(spark):
    rows = [("new york is new york", "en")] * 300 + [("a b", f"l{i}") for i in range(100)]
    assert got(spark, rows, 100, 2000) == brute(rows, 100, 2000)


def table_of(automaton):
    return dict(automaton.phrases())


def test_transducer_is_minimal_ordered_and_composable():
    rng = random.Random(3)
    table = {tuple(rng.choices([b"a", b"ab", b"b\x00", b"c"], k=rng.randrange(1, 5))): rng.randrange(1, 4) for _ in range(150)}
    built = c.Transducer.build(sorted(table.items()))
    again = c.Transducer.from_bytes(built.to_bytes())
    assert list(again.phrases()) == sorted(table.items())
    states = {(built.finals[s], *built.words[built.first[s] : built.first[s + 1]], *built.to[built.first[s] : built.first[s + 1]]) for s in range(len(built.finals))}
    assert len(states) == len(built.finals) < len(table)
    asks = sorted([*table, (b"a", b"zz"), (b"zz",), (b"a",) * 7])
    assert list(again.compose(asks)) == [table.get(a, 0) for a in asks]
    assert table_of(c.Transducer.build([])) == {}


def test_union_adds_weights():
    rng = random.Random(4)
    tables = [Counter(tuple(rng.choices([b"x", b"y", b"z"], k=2)) for _ in range(20)) for _ in range(9)]
    automata = [c.Transducer.build(sorted(t.items())) for t in tables]
    assert dict(c.union(automata)) == sum(tables, Counter())


class Everything:
    def __call__(self, hashes):
        return hashes == hashes


def test_windows_and_shards_count_each_phrase_once(monkeypatch):
    monkeypatch.setattr(c, "WINDOW_BYTES", 40)
    monkeypatch.setattr(c, "SHARD_WORDS", 25)
    rows = [(t, "en") for t, _ in corpus(5, 60) if t]
    found, _ = counts(rows)
    shard, total = c.Shard(3, Everything()), Counter()
    screen, codes = c.Shard(3), Counter()
    flushed = 0
    for text, lang in rows:
        for words, old in c.windows(text.encode()):
            shard.add(lang, words, old)
            screen.add(lang, words, old)
            if shard.full():
                flushed += 1
                for *_, data in shard.transducers():
                    total.update(table_of(c.Transducer.from_bytes(data)))
                for _, data in screen.screened(10**6)[1]:
                    codes.update(dict(zip(*(x.tolist() for x in c.unpack_codes(data)), strict=True)))
    for *_, data in shard.transducers():
        total.update(table_of(c.Transducer.from_bytes(data)))
    for _, data in screen.screened(10**6)[1]:
        codes.update(dict(zip(*(x.tolist() for x in c.unpack_codes(data)), strict=True)))
    expected = {tuple(w.encode() for w in p): n for p, n in found["en"].items()}
    assert flushed > 3 and dict(total) == expected
    short = Counter()
    for p, n in expected.items():
        if len(p) <= 2:
            hashes = [c.np.array([c.word_hash(w)], c.np.uint64) for w in p]
            short[int(c.code_of(c.phrase_hashes(hashes, "en"))[0])] += n
    assert codes == short


def test_screen_writes_no_counts_to_the_shared_folder(spark, monkeypatch):
    """Only what may be frequent and the totals are written; counts of all pairs go through one shuffle."""
    rows = corpus(7, 300)
    docs = spark.createDataFrame([(t, g or "und") for t, g in rows], "text string, lang string").repartition(6)
    written, stage = [], c.stage

    def seen(df, name):
        written.append((name, df.columns))
        return stage(df, name)

    monkeypatch.setattr(c, "stage", seen)
    least = 4
    totals, keep = c.screen(docs, least, 5)
    assert written == [("screened", ["lang", "value", "bits"])]
    found, expected = counts(rows)
    for text, lang in rows:
        expected[lang or "und"] += 0
    assert {r["lang"]: r["total"] for r in totals.collect() if r["total"]} == {k: n for k, n in expected.items() if n}
    may = c.HashFilter(keep.value)
    for lang, f in found.items():
        for phrase, n in f.items():
            if len(phrase) < 3 and n >= least:
                hashes = [c.np.array([c.word_hash(w.encode())], c.np.uint64) for w in phrase]
                assert may(c.phrase_hashes(hashes, lang))[0]
    frequent = sum(1 for f in found.values() for p, n in f.items() if len(p) < 3 and n >= least)
    assert 0 < sum(int(w).bit_count() for w in keep.value) <= frequent


def test_screen_of_no_rows(spark):
    totals, keep = c.screen(spark.createDataFrame([], "text string, lang string"), 100, 1)
    assert totals.isEmpty() and not keep.value.any()


def calls_in(work):
    """The result, and how many calls of Python functions and generators it took."""
    n = 0

    def seen(frame, event, arg):
        nonlocal n
        n += event == "call"

    sys.setprofile(seen)
    try:
        out = work()
    finally:
        sys.setprofile(None)
    return out, n


def test_automata_are_not_built_and_united_phrase_by_phrase():
    rng = random.Random(8)
    words = [f"w{i}".encode() for i in range(60)]
    shard, found = c.Shard(40, Everything()), []
    for _ in range(6):
        shard.add("en", rng.choices(words, k=4000))
        made, calls = calls_in(lambda: list(shard.transducers()))
        phrases = sum(len(table_of(c.Transducer.from_bytes(d))) for *_, d in made)
        assert phrases > 12_000 and calls < phrases / 4
        found.append([c.Transducer.from_bytes(d) for _, place, d in made if place == 7])
    automata = [a for part in found for a in part]
    assert len(automata) == 6
    (names, rows, counts), calls = calls_in(lambda: c.united(automata))
    total = sum((Counter(table_of(a)) for a in automata), Counter())
    assert dict(zip(c.phrases_of(names, rows), counts.tolist(), strict=True)) == total and calls < len(total) / 2


def test_states_with_one_code_by_chance_stay_apart(monkeypatch):
    rng = random.Random(9)
    table = {tuple(rng.choices([b"a", b"b", b"c"], k=rng.randrange(1, 6))): rng.randrange(1, 4) for _ in range(120)}
    built = c.Transducer.build(sorted(table.items()))
    monkeypatch.setattr(c, "mix64", lambda x, seed: x ^ x)
    again = c.Transducer.build(sorted(table.items()))
    assert table_of(again) == table and len(again.finals) == len(built.finals)


def test_tables_of_several_ranges():
    names = [b"a", b"b", b"c"]
    rows = c.np.array([[0, -1], [0, 1], [1, 1], [0, -1], [2, 0], [0, 1]])
    built = dict(c.Transducer.of_tables(names, rows, c.np.array([1, 2, 3, 4, 5, 6]), c.np.array([2, 2, 2, 5, 5, 9])))
    assert {k: table_of(c.Transducer.from_bytes(a.to_bytes())) for k, a in built.items()} == {
        2: {(b"a",): 1, (b"a", b"b"): 2, (b"b", b"b"): 3}, 5: {(b"a",): 4, (b"c", b"a"): 5}, 9: {(b"a", b"b"): 6}
    }
