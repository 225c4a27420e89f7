"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit per number: 1 where it is above 0. Codes are cut into segments; every
segment value has a bucket. In round r each open query probes, for every segment, the buckets at
Hamming distance r from its own segment. After it all codes within segments * (r + 1) - 1 bits have
been seen, as a nearer code has a segment at r or less. A query is closed once its k-th verified
distance is within that bound; its result is then exact. The bound so far also cuts what the join lets
through, and a pair is taken at the segment where it can be met first, so it is met once.

Equal codes are one entry with its ``k`` smallest ids, so a vector that is very common costs as much as
a rare one. Ties go to the smaller id. Segments have about log2(codes) bits, so buckets stay small
as the table grows. A null vector has no code and is left out, and so are rows without an id; a null
number counts as 0, and a vector shorter than the longest is filled with 0. Repeated rows with one
id count once.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockpulse.session import stage


def segment_codes(df: DataFrame, vec_id: str, vector: str, bits: int, width: int) -> DataFrame:
    """``vec_id`` and ``code``: the segments as numbers, ``width`` bits each."""
    parts = []
    for low in range(0, bits, width):
        part = F.slice(vector, low + 1, min(width, bits - low))
        marks = F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1), i)).otherwise(0))
        parts.append(F.aggregate(marks, F.lit(0), lambda a, b: a.bitwiseOR(b)))
    rows = df.where(F.col(vector).isNotNull() & F.col(vec_id).isNotNull())
    return rows.select(F.col(vec_id).alias("vec_id"), F.array(*parts).alias("code"))


def masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)]


def hamming(a: str, b: str, segments: int) -> list[Column]:
    """The distance of each segment."""
    return [F.bit_count(F.col(a)[j].bitwiseXOR(F.col(b)[j])).cast("int") for j in range(segments)]


def nearest_codes(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, distance`` of the ``k`` nearest codes of each query."""
    spark = vectors.sparkSession
    lengths = F.max(F.size(F.coalesce(F.col(vector), F.array())))
    n, bits = vectors.agg(F.count("*"), lengths).first()
    bits = max(bits or 0, queries.agg(lengths).first()[0] or 0, 1)
    width = min(bits, width or min(20, max(8, round(math.log2(n + 2)))))
    segments = -(-bits // width)
    widths = [min(width, bits - j * width) for j in range(segments)]

    first = Window.partitionBy("code").orderBy("vec_id")
    rows = segment_codes(vectors, vec_id, vector, bits, width).distinct()
    rows = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k)
    codes = rows.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))  # k at most
    codes = stage(codes.withColumn("first_id", F.col("ids")[0]), "codes")
    index = codes.select("first_id", "code", F.posexplode("code").alias("segment", "value"))
    index = stage(index, "code-index")
    asked = segment_codes(queries, vec_id, vector, bits, width).dropDuplicates(["vec_id"])
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("asked"))
    asked = stage(asked, "code-queries")
    open_queries = asked.withColumn("bound", F.lit(bits))
    best = spark.createDataFrame([], "query_id long, first_id long, distance int")
    for radius in range(max(widths) + 1):
        flips = F.lit(0)
        for j in range(segments - 1, -1, -1):
            flips_j = F.array(*[F.lit(m) for m in masks(widths[j], radius)]).cast("array<int>")
            flips = flips_j if j == segments - 1 else F.when(F.col("segment") == j, flips_j).otherwise(flips)
        probes = (
            open_queries.select("*", F.posexplode("asked").alias("segment", "own"))
            .select("*", F.explode(flips).alias("flip"))
            .select("query_id", "asked", "bound", "segment", F.col("own").bitwiseXOR(F.col("flip")).alias("value"))
        )
        far = hamming("asked", "code", segments)
        distance = sum(far[1:], far[0])
        # First met: no segment is nearer, and none before this one is as near.
        nearer = F.lit(False)
        for j, d in enumerate(far):
            nearer = nearer | (d < radius) | ((d == radius) & (F.col("segment") > j))
        # Spark takes the probes for as small as the queries they come from, and would broadcast them.
        met = probes.join(index.hint("merge"), ["segment", "value"]).where(~nearer & (distance <= F.col("bound")))
        met = met.select("query_id", "first_id", distance.alias("distance"))
        order = Window.partitionBy("query_id").orderBy("distance", "first_id")
        ranked = best.unionByName(met).withColumn("n", F.row_number().over(order))
        best = stage(ranked.where(F.col("n") <= k).drop("n"), "nearest")
        bounds = best.groupBy("query_id").agg(F.count("*").alias("n"), F.max("distance").alias("worst"))
        bounds = bounds.where(F.col("n") == k).select("query_id", "worst")
        covered = segments * (radius + 1) - 1
        left = asked.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("worst", F.lit(bits)))
        left = stage(left.where(F.col("bound") > covered).drop("worst"), "open-queries")
        if covered >= bits or left.isEmpty():
            break
        open_queries = left
    all_ids = best.join(codes.select("first_id", "ids"), "first_id")
    all_ids = all_ids.select("query_id", "distance", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    ranked = all_ids.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long").alias("rank"), "vec_id", F.col("distance").cast("long").alias("distance"))


SQL = """
WITH c AS (
  SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0, FALSE)) AS code FROM embeddings
  WHERE embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(c.code) + 1),
      lambda i: CAST(c.code[i] <> q.code[i] AS INT))) AS BIGINT) AS distance
  FROM c AS q, c WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10"""
