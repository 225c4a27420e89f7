"""Chat transcripts to turns: roles by a hidden Markov model, then canonical rendering.

Each line of a transcript is in one of six states: it begins, or continues, a turn of the system, the user
or the assistant. A line shows whether a speaker marker stands on it (``User:``, ``### Assistant``,
``Q:``), whether a blank line or the start stands before it, and its length. Viterbi finds the likeliest
states; markers are taken off, and turns are rendered as ``<|role|>`` blocks, with such signs in
the text broken by a space.

Start and change of roles, lines per turn and line lengths are counted over the usable turns of a table;
how often markers and blank lines are right is set below. Long conversations are parsed in parts of
``PART_TURNS`` turn numbers, and a part of more rows (repeated turns, rows without an id) in pieces of
``PART_TURNS`` rows, so no row holds an unbounded group; all but the first may start with any role.

Null and empty texts have no turns. Equal paths go to the state that is first in ``STATES``.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dockpulse.llm.common import annotate
from dockpulse.session import stage

ROLES = ("system", "user", "assistant")
STATES = [(role, begin) for role in ROLES for begin in (True, False)]
PART_TURNS = 64
LENGTHS = 14  # line lengths count by powers of two
MARKED, WRONG_MARK, STRAY_MARK = 0.5, 0.01, 0.002
GAP_BEFORE, GAP_INSIDE = 0.97, 0.03

SPEAKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "a"),
}
ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names}
_NAMES = "|".join(sorted(ROLE_OF, key=len, reverse=True))
MARKER = re.compile(
    rf"\s*(?:#{{1,6}}\s*({_NAMES})\s*(?::|$)|\*{{1,2}}({_NAMES})\s*:?\*{{1,2}}\s*:?"
    rf"|[\[<]\|?({_NAMES})\|?[\]>]\s*:?|({_NAMES})\s*:)\s*",
    re.IGNORECASE,
)


def length_class(size: int) -> int:
    return min(LENGTHS - 1, (size + 1).bit_length() - 1)


class TurnModel:
    """Log probabilities from counts, with one added to each."""

    def __init__(self, starts: dict, changes: dict, lines: dict, lengths: dict):
        def share(counts, key, keys):
            total = sum(counts.get(k, 0) + 1 for k in keys)
            return math.log((counts.get(key, 0) + 1) / total)

        firsts = {r: share(starts, r, ROLES) for r in ROLES}
        evenly = {r: -math.log(len(ROLES)) for r in ROLES}
        self.start = {True: firsts, False: evenly}
        self.step = {}
        for role in ROLES:
            turns, n = lines.get(role, (1, 2))
            more = min(max((n - turns + 1) / (n + 2), 1e-6), 1 - 1e-6)
            pairs = [(role, r) for r in ROLES]
            for begin in (True, False):
                self.step[(role, begin), (role, False)] = math.log(more)
                for other in ROLES:
                    self.step[(role, begin), (other, True)] = math.log(1 - more) + share(
                        changes, (role, other), pairs
                    )
        self.length = {
            (r, c): share(lengths, (r, c), [(r, i) for i in range(LENGTHS)])
            for r in ROLES
            for c in range(LENGTHS)
        }

    def shows(self, state: tuple[str, bool], marker: str | None, gap: bool, size: int) -> float:
        role, begin = state
        if begin:
            right = MARKED if marker == role else WRONG_MARK
            mark = right if marker else 1 - MARKED - 2 * WRONG_MARK
        else:
            mark = STRAY_MARK if marker else 1 - 3 * STRAY_MARK
        blank = GAP_BEFORE if begin else GAP_INSIDE
        return math.log(mark) + math.log(blank if gap else 1 - blank) + self.length[role, length_class(size)]

    def parse(self, text: str | None, from_start: bool = True) -> list[tuple[str, str]]:
        """The turns of a transcript as (role, text)."""
        lines, gap = [], True
        for line in (text or "").split("\n"):
            if not line.strip():
                gap = True
                continue
            found = MARKER.match(line)
            name = next(g for g in found.groups() if g) if found else None
            body = line[found.end() :] if found else line
            lines.append((ROLE_OF[name.lower()] if name else None, gap, body, line))
            gap = False
        if not lines:
            return []
        scores, back = {}, []
        for i, (marker, gap, body, _) in enumerate(lines):
            reached, came = {}, {}
            for state in STATES:
                if i == 0:
                    before, score = None, self.start[from_start][state[0]] if state[1] else -math.inf
                else:
                    steps = ((scores[s] + self.step[s, state], s) for s in STATES if (s, state) in self.step)
                    score, before = max(steps, key=lambda x: x[0])
                reached[state] = score + self.shows(state, marker, gap, len(body))
                came[state] = before
            scores = reached
            back.append(came)
        state = max(STATES, key=lambda s: scores[s])
        path = []
        for came in reversed(back):
            path.append(state)
            state = came[state]
        turns: list[tuple[str, list[str]]] = []
        for (role, begin), (_, _, body, line) in zip(reversed(path), lines, strict=True):
            if begin:
                turns.append((role, [body] if body else []))
            else:
                turns[-1][1].append(line)
        return [(role, "\n".join(parts)) for role, parts in turns]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{body.replace('<|', '< |')}\n<|end|>\n" for role, body in turns)


def fit_turns(
    conversations: DataFrame, usable: Column, conv_id="conv_id", turn="turn", role="role", text="text"
) -> TurnModel:
    """Counts over all usable turns; a few dozen numbers come to the driver."""
    rows = conversations.where(usable & F.col(role).isin(*ROLES)).select(
        F.col(conv_id).alias("c"), F.col(turn).alias("t"), F.col(role).alias("r"), F.col(text).alias("body")
    )
    starts = rows.where("t = 0").groupBy("r").count().collect()
    # repeated turns are counted before they meet, so a place has one row a role
    at = stage(rows.groupBy("c", "t", "r").agg(F.count("*").alias("n")), "turn-roles")
    after = at.select("c", (F.col("t") - 1).alias("t"), F.col("r").alias("next"), F.col("n").alias("m"))
    changes = at.join(after, ["c", "t"]).groupBy("r", "next")
    changes = changes.agg(F.sum(F.col("n") * F.col("m")).alias("n")).collect()
    lines = rows.select("r", F.explode(F.split(F.coalesce("body", F.lit("")), "\n")).alias("line"))
    size = F.floor(F.log2(F.length("line") + 1)).cast("int")
    lengths = lines.groupBy("r", F.least(size, F.lit(LENGTHS - 1)).alias("k")).count().collect()
    turns = rows.groupBy("r").count().collect()
    n_turns = {r[0]: r[1] for r in turns}
    n_lines: dict[str, int] = {}
    for r in lengths:
        n_lines[r[0]] = n_lines.get(r[0], 0) + r[2]
    return TurnModel(
        {r[0]: r[1] for r in starts},
        {(r[0], r[1]): r[2] for r in changes},
        {r: (n_turns[r], n_lines.get(r, 0)) for r in n_turns},
        {(r[0], r[1]): r[2] for r in lengths},
    )


def with_pieces(rows: DataFrame) -> DataFrame:
    """Append ``piece``: the number of a row in its part, in order, divided by ``PART_TURNS``.

    If a part has more rows than that, all rows are dealt by range over order and place, so that a large
    part, even of equal rows, spreads over tasks; numbers run within a task, and the counts of the tasks
    before are added. Rows of one turn and role go by a hash of their text.
    """
    sizes = rows.groupBy("conv_id", "part").count()
    if sizes.where(F.col("count") > PART_TURNS).isEmpty():
        return rows.withColumn("piece", F.lit(0).cast("long"))
    order = ["conv_id", "part", "one.turn", "one.role", "mixed", "place"]
    dealt = rows.withColumn("mixed", F.xxhash64("one.text"))
    dealt = dealt.withColumn("place", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("mixed", "place")
    dealt = dealt.withColumn("seq", F.monotonically_increasing_id())
    dealt = stage(dealt, "turns-in-order").withColumn("task", F.shiftright("seq", 33))
    runs = dealt.groupBy("conv_id", "part", "task").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "part").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first"))
    runs = runs.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("task").alias("k"), "base")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("task") == F.col("k"))
    numbered = dealt.join(runs, same)
    piece = F.floor((F.col("seq") + F.col("base")) / PART_TURNS).cast("long")
    return numbered.select("conv_id", "part", "one", piece.alias("piece"))


def plain_transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, piece, transcript, roles``: turns in order, as people write them down.

    The style follows a hash of the id that does not depend on the one that holds ids out: names, questions and answers, headings, or no marker at all; a blank line
    stands between turns. ``roles`` are the true ones, to compare with.
    """
    part = F.floor(F.coalesce(F.col("turn"), F.lit(0)) / PART_TURNS).cast("long")
    rows = conversations.select(
        "conv_id", part.alias("part"), F.struct("turn", "role", "text").alias("one")
    )
    rows = with_pieces(rows)
    grouped = rows.groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    style = F.pmod(F.xxhash64(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))), F.lit(4))

    def marked(t):
        role = F.coalesce(t["role"], F.lit(""))
        by_letter = F.when(role == "user", "Q: ").when(role == "assistant", "A: ")
        name = F.concat(F.initcap(role), F.lit(": "))
        head = F.concat(F.lit("### "), F.initcap(role), F.lit("\n"))
        mark = F.when(role == "", "").when(style == 0, name).when(style == 1, F.coalesce(by_letter, name))
        return F.concat(mark.when(style == 2, head).otherwise(""), F.coalesce(t["text"], F.lit("")))

    return grouped.select(
        "conv_id",
        "part",
        "piece",
        F.concat_ws("\n\n", F.transform("turns", marked)).alias("transcript"),
        F.concat_ws(",", F.transform("turns", lambda t: F.coalesce(t["role"], F.lit("")))).alias("roles"),
    )


TURNS = T.StructType(
    [
        T.StructField("n_turns", T.LongType()),
        T.StructField("roles", T.StringType()),
        T.StructField("rendered", T.StringType()),
        T.StructField("rendered_sha256", T.StringType()),
    ]
)


def format_chats(
    transcripts: DataFrame,
    model: TurnModel,
    text: str = "transcript",
    into: str = "chat",
    keep=None,
    part: str = "part",
    piece: str = "piece",
) -> DataFrame:
    """Append the number of turns, their roles joined by commas, and the rendered text.

    Where ``part`` or ``piece`` is not 0 a transcript goes on with a conversation and may start with any
    role.
    """

    def work(texts, *places):
        found = [model.parse(t, not any(place)) for t, *place in zip(texts, *places, strict=True)]
        bodies = [render(f) for f in found]
        digests = [hashlib.sha256(b.encode()).hexdigest() for b in bodies]
        return [len(f) for f in found], [",".join(r for r, _ in f) for f in found], bodies, digests

    return annotate(transcripts, into, TURNS, lambda: work, text, keep, [part, piece])
