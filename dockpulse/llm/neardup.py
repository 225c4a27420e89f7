"""Near-duplicate documents by SuperMinHash, banding, verification on full sets, and union-find.

A document's set holds its distinct shingles of ``words`` words; shorter texts with words are one
shingle. Two documents are linked if their sets share at least ``percent`` percent of their union.

1. Signatures. Each shingle deals one rank to every slot of the signature, in the order of a random
   permutation of its own, and a slot keeps the least rank plus fraction that it was dealt. The
   ranks of all shingles advance together; a document stops as soon as no later rank can win.
2. Texts with equal sets become one class. ``BANDS`` bands of ``ROWS`` slots put classes into buckets; a
   pair at the least similarity of 0.8 misses them all with probability 1.3e-7.
3. In each bucket the class that meets most others is the hub, and only hub and member are
   compared, on their full sets. So a bucket of n classes makes n - 1 pairs, not n * n / 2.
4. Links that a hub does not have, in buckets of three or more: every member is known by what
   it lacks of the hub and has beside it (its delta). Two members whose deltas share s shingles have
   |x and y| = |hub| - lacks - lacks + s, so they are linked only if s reaches a bound; if both
   are linked with the hub they are in one group already. For all others a prefix index over the
   deltas, rarest shingles first, gives exactly the pairs that can reach the bound, and the bound
   itself confirms them. No pair is dropped, and members that share nothing beside the hub never meet.
   Where many share a shingle, the far member whose delta is the smallest is a second hub: all others are compared
   with it first, and two that are both linked with it are in one group and do not meet again.
5. Union-find over the links within each task, then rounds of star contraction between tasks.

Sums by bucket, hub or node are staged before they are joined back. Joined directly they would share
the layout of the sum, in which all rows of a hot key stand in one task; this way Spark can split them.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. Null, empty and wordless
texts have an empty set and no links. A row with a null id is not linked; its component is null and
it is kept. Rows are judged by their text: if an id comes more than once, each row has the result of
its own text. Shingles and classes are known by 64 bits and classes also by another 64; two of n
different texts get mixed up with a probability of about n * n / 2**65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dockpulse.llm.common import SizedCache, annotate, release_memory
from dockpulse.llm.files import mix64
from dockpulse.session import stage

BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
CHUNK = 1 << 15  # shingles whose permutations are held together
KNOWN_BYTES = 32 << 20


class WordHashes(SizedCache):
    def __init__(self):
        super().__init__(KNOWN_BYTES)

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        self.keep(word, found, 40)
        return found


def shingle_set(text: str | None, words: int, known: WordHashes) -> np.ndarray:
    """The set as sorted 64-bit numbers."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    if len(parts) < words:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), len(parts))], np.uint64)
    out = np.zeros(len(parts) - words + 1, np.uint64)
    for i in range(words):
        out = mix64(out ^ hashes[i : len(parts) - words + 1 + i], i)
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures of non-empty sets, one row each. A value is rank << 53 | fraction."""
    signatures = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    group, held = [], 0
    for i, s in enumerate(sets):
        for low in range(0, len(s), CHUNK):
            part = s[low : low + CHUNK]
            if held + len(part) > CHUNK:
                deal_ranks(group, signatures)
                group, held = [], 0
            group.append((i, part))
            held += len(part)
    if group:
        deal_ranks(group, signatures)
    return signatures


def deal_ranks(group: list[tuple[int, np.ndarray]], signatures: np.ndarray) -> None:
    slots = signatures.shape[1]
    flat = signatures.reshape(-1)
    shingles = np.concatenate([s for _, s in group])
    owner = np.repeat(np.array([i for i, _ in group]), [len(s) for _, s in group])
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(shingles), 1))  # the permutations
    for rank in range(slots):
        draw = mix64(shingles, rank)
        pick = (((draw >> np.uint64(32)) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
        pick += rank
        at = np.arange(len(shingles))
        slot = order[at, pick].astype(np.int64)
        order[at, pick] = order[:, rank]
        value = (mix64(draw, 77) >> np.uint64(11)) | np.uint64(rank << 53)
        np.minimum.at(flat, owner * slots + slot, value)
        owners = np.unique(owner)
        done = signatures[owners].max(1) < np.uint64((rank + 1) << 53)
        if done.all():
            return
        if done.any():
            finished = np.zeros(len(signatures), bool)
            finished[owners[done]] = True
            left = ~finished[owner]
            shingles, owner, order = shingles[left], owner[left], order[left]


def band_hashes(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        out = mix64(out ^ parts[:, :, i], 200 + i)
    return out.view(np.int64)


MARKS = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("check", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), 1) - (1 << 63)


def marker(words: int):
    known = WordHashes()

    def work(texts):
        sets = [shingle_set(t, words, known) for t in texts]
        full = [i for i, s in enumerate(sets) if len(s)]
        hashes = band_hashes(super_minhash([sets[i] for i in full]))
        bands: list = [[]] * len(sets)
        for i, row in zip(full, hashes, strict=True):
            bands[i] = row
        checks = [xxhash.xxh3_64_intdigest(s.tobytes(), 2) - (1 << 63) for s in sets]
        return [len(s) for s in sets], [node_of(s) for s in sets], checks, bands

    return work


PAIRS = T.StructType(
    [
        T.StructField("hub", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("cost", T.LongType()),
        T.StructField("delta", T.ArrayType(T.LongType())),
    ]
)


def compared(pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """For rows (hub, node, flagged, hub_text, text): the hub's size, and the cost of the member.

    With lacks = |hub - x| and beside = |x - hub| the pair is linked if and only if
    100 * lacks + percent * beside <= (100 - percent) * |hub|. Flagged pairs carry their delta.
    """

    def run(batches):
        known = WordHashes()
        last: tuple = (None, None)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            out: list[list] = [[], [], [], [], []]
            for hub, node, flagged, hub_text, text in zip(*columns, strict=True):
                if last[0] != (hub, hub_text):
                    last = ((hub, hub_text), shingle_set(hub_text, words, known))
                a, b = last[1], shingle_set(text, words, known)
                if node_of(a) != hub or node_of(b) != node:
                    continue  # another text under the same id
                at = np.minimum(np.searchsorted(a, b), len(a) - 1)
                common = a[at] == b
                lacks = np.ones(len(a), bool)
                lacks[at[common]] = False
                cost = 100 * int(lacks.sum()) + percent * int((~common).sum())
                delta = np.concatenate([a[lacks], b[~common]]).view(np.int64) if flagged else []
                for column, value in zip(out, (hub, node, len(a), cost, delta), strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=PAIRS.fieldNames())
        del known, last
        release_memory()

    return pairs.select("hub", "node", "flagged", "hub_text", "text").mapInArrow(run, PAIRS)


def bucket_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (hub, node, flagged) of all buckets; flagged where a bucket has three or more classes."""
    places = classes.select("node", F.explode("bands").alias("bucket"))
    sizes = places.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")
    )
    sizes = stage(sizes.where("n > 1"), "buckets")
    twos = sizes.where("n = 2").select(
        F.col("low").alias("hub"), F.col("high").alias("node"), F.lit(False).alias("flagged")
    )
    crowd = stage(
        places.join(sizes.where("n > 2").select("bucket", "n"), "bucket"), "crowded-buckets"
    )
    meets = crowd.groupBy("node").agg(F.sum("n").alias("meets"))
    hubs = (
        crowd.join(meets, "node")
        .groupBy("bucket")
        .agg(F.max_by("node", F.struct("meets", "node")).alias("hub"))
    )
    stars = crowd.join(stage(hubs, "hubs"), "bucket").select("hub", "node", F.lit(True).alias("flagged"))
    both = twos.unionByName(stars).where("hub <> node")
    return both.groupBy("hub", "node").agg(F.max("flagged").alias("flagged"))


def links_beside_hubs(found: DataFrame, direct: DataFrame, percent: int) -> DataFrame:
    """Edges with the components of all links: the ``direct`` ones of hubs, and those between members of one
    hub of whom at least one is not linked with it."""
    gap, step = 100 - percent, 100 + percent
    slack = F.col("cost") - gap * F.col("size")  # above 0: not linked with the hub
    members = found.where(F.size("delta") > 0).dropDuplicates(["hub", "node"])
    members = members.withColumn("far", slack > 0)
    far_hubs = stage(members.where("far").select("hub").distinct(), "far-hubs")
    members = stage(members.join(far_hubs, "hub", "left_semi"), "deltas")
    # The least overlap that a link needs: of any member with a far one, and of a far one with any.
    n = F.size("delta")
    needs = F.greatest(F.lit(1), F.ceil((F.col("cost") + 1) / F.lit(step)))
    far_needs = F.greatest(F.lit(1), F.ceil(slack / F.lit(100)))
    entries = members.select(
        "hub", "node", "far", n.alias("n"), (n - needs + 1).alias("prefix"),
        (n - far_needs + 1).alias("far_prefix"), F.explode("delta").alias("shingle"),
    )
    common = entries.groupBy("hub", "shingle").agg(F.count("*").alias("often"))
    common = stage(common.where("often > 1"), "common-shingles")
    own = Window.partitionBy("hub", "node")
    ranked = entries.join(common, ["hub", "shingle"]).withColumn(
        "rank",
        F.col("n") - F.count("*").over(own)  # those that nobody shares come first
        + F.row_number().over(own.orderBy("often", "shingle")),
    )
    ranked = stage(ranked.where("rank <= prefix or (far and rank <= far_prefix)"), "prefixes")
    def side(name):
        return members.select(
            "hub", "size", F.col("node").alias(name),
            F.col("cost").alias(f"cost_{name}"), F.col("delta").alias(f"delta_{name}"),
        )

    def linked(met):
        shared = F.size(F.array_intersect("delta_x", "delta_y"))
        return (
            met.join(side("x"), ["hub", "x"])
            .join(side("y").drop("size"), ["hub", "y"])
            .where(gap * F.col("size") + step * shared >= F.col("cost_x") + F.col("cost_y"))
            .select("hub", "x", "y")
        )

    place = ["hub", "shingle"]
    seconds = ranked.where("far and rank <= far_prefix").groupBy(*place)
    seconds = stage(seconds.agg(F.min_by("node", F.struct("n", "node")).alias("x")), "second-hubs")
    stars = seconds.join(ranked.select(*place, F.col("node").alias("y")), place).where("x <> y")
    near = stage(linked(stars.select("hub", "x", "y").distinct()), "second-links")
    # Two members of one group need not meet any more, and a shingle of a single group is done.
    groups = components(direct.unionByName(near.select(F.col("x").alias("a"), F.col("y").alias("b"))))
    ranked = ranked.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ranked = stage(ranked, "grouped-prefixes")
    several = ranked.groupBy(*place).agg(F.min("root").alias("low"), F.max("root").alias("high"))
    ranked = ranked.join(several.where("low <> high").select(*place), place, "left_semi")
    left = ranked.where("far and rank <= far_prefix")
    left = left.select(*place, F.col("node").alias("x"), F.col("root").alias("root_x"))
    right = ranked.where("rank <= prefix")
    right = right.select(*place, F.col("node").alias("y"), F.col("root").alias("root_y"))
    rest = left.join(right, place).where("root_x <> root_y").select("hub", "x", "y").distinct()
    beside = linked(rest).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return beside.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b")))


def forest(edges: DataFrame) -> DataFrame:
    """Union-find over the links of each task: every node with the least node of its tree."""

    def run(batches):
        parent: dict[int, int] = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        for low in range(0, len(nodes), 50_000):
            part = nodes[low : low + 50_000]
            arrays = [pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node of its component, for every node that has an edge.

    Rounds of large and small stars: each node hangs its larger neighbours, then itself and its
    smaller neighbours, below the least of them, until nothing changes. A node's neighbours are only
    aggregated and joined, never gathered.
    """
    edges = stage(forest(edges), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-stars")
        # now a > b: the smaller neighbours of a are its b
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = stage(small.where("a <> b").distinct(), "small-stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row: the least id of the group, and whether
    the row is that one."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = annotate(rows, "mark", MARKS, lambda: marker(words), "text", ["doc_id"])
    marks = stage(marked.select("doc_id", "mark.*"), "marks")
    classes = (
        marks.where("n_shingles > 0 and doc_id is not null")
        .groupBy("node", "check")
        .agg(F.min("doc_id").alias("first_id"), F.any_value("bands").alias("bands"))
    )
    classes = stage(classes, "classes")
    pairs = stage(bucket_pairs(classes.select("node", "bands")), "pairs")
    ends = pairs.select("node").unionByName(pairs.select(F.col("hub").alias("node"))).distinct()
    wanted = classes.select("node", "first_id").join(ends, "node")
    bodies = rows.join(wanted, F.col("doc_id") == F.col("first_id")).select("node", "text")
    with_text = pairs.join(bodies, "node").join(
        bodies.select(F.col("node").alias("hub"), F.col("text").alias("hub_text")), "hub"
    )
    found = stage(compared(with_text, words, percent), "compared")
    direct = found.where(F.col("cost") <= (100 - percent) * F.col("size"))
    edges = direct.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    roots = components(links_beside_hubs(found, edges, percent))
    groups = classes.select("node", "check", "first_id").join(roots, "node", "left")
    groups = groups.withColumn("root", F.coalesce("root", "node"))
    firsts = stage(groups.groupBy("root").agg(F.min("first_id").alias("component_id")), "firsts")
    groups = groups.join(firsts, "root").select("node", "check", "component_id")
    return (
        marks.select("doc_id", "n_shingles", "node", "check")
        .join(groups, ["node", "check"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id")
            ).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
