"""Licences, chats and code search against brute force."""

import random

from pyspark.sql import functions as F

from dockpulse.llm import codes, licenses, transcripts
from dockpulse.llm.common import held_out, table

SF = "/root/testdata/sf0.01"


def plain_scan(text, templates, least):
    def pairs(t):
        return licenses.bigrams(t.encode().translate(licenses.FOLD).split())

    blocks, block = [], []
    for line in [*(text or "").split("\n"), ""]:
        if line.strip(" \t\r"):
            block.append(line)
        else:
            blocks.append("\n".join(block))
            block = []
    out = {}
    for unit in [*(text or "").split("\n"), *blocks]:
        a, best = pairs(unit), None
        for name in sorted(templates):
            b = pairs(templates[name])
            if a and b and 200 * len(a & b) >= least * (len(a) + len(b)):
                dice = 2 * len(a & b) / (len(a) + len(b))
                best = max(best or (0, ""), (dice, name), key=lambda x: x[0])
        if best:
            out[best[1]] = max(best[0], out.get(best[1], 0))
    return sorted(out.items())


def test_licences_against_all_templates(spark):
    rng = random.Random(4)
    texts = [None, "", "\n\n", "MIT", "Released under the mit licence.\n \nx", "\n".join(["a b"] * 9)]
    for name, body in licenses.TEMPLATES.items():
        words = body.split()
        for _ in range(4):
            own = [w for w in words if rng.random() > 0.06]
            at = rng.randrange(len(own) + 1)
            texts.append("before it all\n" + " ".join(own[:at]) + "\n" + " ".join(own[at:]) + "\n\n" + name)
    texts.append("word " * 60_000 + "\nAll rights reserved.")
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, scores int")
    for least in (80, 50):
        for r in licenses.scan_licences(df, least=least).collect():
            found = list(zip(r["licence"]["licences"], r["licence"]["scores"], strict=True))
            assert found == plain_scan(r["text"], licenses.TEMPLATES, least)
    assert licenses.scan_licences(df.limit(0)).count() == 0
    assert licenses.scan_licences(df, {}).where("size(licence.licences) > 0").isEmpty()


def test_licence_headers_and_texts():
    scanner = licenses.LicenceScanner(licenses.TEMPLATES)
    gpl = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior
written permission."""
    for text, names in (
        (gpl, ["GPL-2.0-header"]),
        (gpl.replace("version 2", "version 3").replace(";", ":", 1), ["GPL-3.0-header"]),
        (bsd, ["BSD-3-Clause-text", "BSD-text"]),
        ("// SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause-spdx"]),
        ("/* SPDX-License-Identifier: MIT */", ["MIT-spdx"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
         ["CC-BY-SA-4.0-deed"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense-text"]),
    ):
        assert sorted(scanner.scan(text)) == names


def test_roles_are_recovered(spark):
    turns = table(spark, SF, "conversations")
    model = transcripts.fit_turns(turns, ~held_out("conv_id"))
    found = transcripts.format_chats(transcripts.plain_transcripts(turns), model).where(held_out("conv_id"))
    right = found.agg(F.avg((F.col("chat.roles") == F.col("roles")).cast("int"))).first()[0]
    assert right > 0.9


def test_roles_of_long_conversations(spark):
    model = transcripts.fit_turns(table(spark, SF, "conversations"), ~held_out("conv_id"))
    given = table(spark, SF, "conversations").where("role <> 'system'").orderBy("conv_id", "turn").collect()
    texts = {k: [r["text"] for r in given if r["role"] == k] for k in ("user", "assistant")}
    rows = []
    for c in range(24):  # turn 64 is the assistant's
        rows += [(c, 0, "system", "Answer briefly.")]
        for t in range(1, 300):
            role = "user" if t % 2 else "assistant"
            rows.append((c, t, role, texts[role][(c * 300 + t) % len(texts[role])]))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = transcripts.format_chats(transcripts.plain_transcripts(df), model).collect()
    style = lambda t: next((i for i, m in enumerate(("User: ", "Q: ", "### ")) if m in t), 3)
    assert {style(r["transcript"]) for r in found} == {0, 1, 2, 3}
    for k in range(4):
        own = [r for r in found if style(r["transcript"]) == k]
        pairs = [p for r in own for p in zip(r["roles"].split(","), r["chat"]["roles"].split(","), strict=False)]
        assert sum(a == b for a, b in pairs) / len(pairs) > 0.9
    styles = transcripts.plain_transcripts(table(spark, SF, "conversations")).where(held_out("conv_id"))
    assert {style(r["transcript"]) for r in styles.collect()} == {0, 1, 2, 3}


def test_large_parts_go_in_pieces_of_bounded_rows(spark):
    rows = [(None, None, "user", f"no id {i}") for i in range(150)]
    rows += [(None, None, "user", "the same")] * 500 + [(1, i % 3, "user", "again") for i in range(200)]
    rows += [(2, i, "user", f"line {i}") for i in range(130)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    found = transcripts.plain_transcripts(df).collect()
    bodies = {}
    for r in sorted(found, key=lambda r: (r["part"], r["piece"])):
        turns = r["transcript"].split("\n\n")
        assert len(turns) == len(r["roles"].split(",")) <= transcripts.PART_TURNS
        bodies.setdefault(r["conv_id"], []).extend(t.split("\n")[-1].split(": ")[-1] for t in turns)
    wanted = {}
    for c, _, _, text in rows:
        wanted.setdefault(c, []).append(text)
    assert {c: sorted(b) for c, b in bodies.items()} == {c: sorted(w) for c, w in wanted.items()}
    assert bodies[2] == wanted[2]
    assert {(r["part"], r["piece"]) for r in found if r["conv_id"] is None} == {(0, i) for i in range(11)}
    assert {(r["part"], r["piece"]) for r in found if r["conv_id"] == 2} == {(0, 0), (1, 0), (2, 0)}


def test_odd_transcripts(spark):
    turns = table(spark, SF, "conversations")
    model = transcripts.fit_turns(turns, ~held_out("conv_id"))
    assert model.parse(None) == model.parse("") == model.parse(" \n\n") == []
    assert model.parse("User: hi\n\nAssistant: <|user|> yes\nand more\n\nuser: bye") == [
        ("user", "hi"), ("assistant", "<|user|> yes\nand more"), ("user", "bye"),
    ]
    text = transcripts.render([("assistant", "<|user|>")])
    assert text == "<|assistant|>\n< |user|>\n<|end|>\n"
    rows = [(1, 0, None, None, 1), (None, None, "user", "x", 1), (1, 0, None, None, 1), (2, 0, "bot", "", 1)]
    rows += [(3, i, "user", "again " * 500, 1) for i in range(200)]
    odd = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    plain = transcripts.plain_transcripts(odd)
    found = transcripts.format_chats(plain, transcripts.fit_turns(odd, F.lit(True)))
    assert {(r["conv_id"], r["part"]) for r in found.collect()} == {
        (None, 0), (1, 0), (2, 0), (3, 0), (3, 1), (3, 2), (3, 3),
    }
    assert transcripts.plain_transcripts(odd.limit(0)).count() == 0


def test_nearest_codes(spark):
    rng = random.Random(8)
    vectors = [[rng.choice([-1.0, 1.0]) for _ in range(24)] for _ in range(150)]
    vectors += [vectors[0]] * 80 + [[-x for x in vectors[0]], [0.5, None, -1.0], [], [float("nan")] * 24]
    rows = [(i, v, "x", 1) for i, v in enumerate(vectors)]
    rows += [(None, vectors[1], "x", 1), (900, None, "x", 1), (7, vectors[7], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string, distance int")
    bits = [[int(x is not None and not x <= 0) for x in v] + [0] * (24 - len(v)) for v in vectors]
    for k, width in ((3, None), (10, 5), (400, 8)):
        asked = df.where("vec_id % 50 = 0 or vec_id > 225")
        found = codes.nearest_codes(df, asked, k=k, width=width).collect()
        got = {}
        for r in found:
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["distance"], r["vec_id"])
        assert set(got) == {i for i in range(len(bits)) if i % 50 == 0 or i > 225}
        for q, ranks in got.items():
            wanted = sorted((sum(a != b for a, b in zip(bits[q], v, strict=True)), i) for i, v in enumerate(bits))
            assert [ranks[i + 1] for i in range(len(ranks))] == wanted[:k]


def test_no_codes(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert codes.nearest_codes(df, df).count() == 0
