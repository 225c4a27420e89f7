"""Search in names by an index of their three-letter parts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.operators.serving import search_by_name

GRAM = 3
BUCKETS = 64


def grams(name: Column) -> Column:
    """Distinct parts of ``GRAM`` characters, in lower case; none for a shorter name, null for null."""
    low = F.lower(name)
    last = F.length(low) - F.lit(GRAM - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).when(last < 1, F.array())
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM))))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


class NameIndex:
    """Rows found by a text inside their name, in any case, as ``search_by_name`` finds them.

    The folder holds the rows themselves, a list of rows for each part, and how many rows each part has. A search counts
    the parts of its text, opens only the bucket of the rarest one, and verifies each row there by the whole text. A text
    of fewer than three characters, or whose rarest part stands in more than half of the rows, reads the rows themselves.
    Lists hold the rows' columns, so no join follows. A list is cut by range, so the part that most names
    share is spread over many files. Rows without a name are kept, and found by the empty text only.
    """

    def __init__(self, spark: SparkSession, path: str, col: str = "station_name"):
        self.spark, self.path, self.col = spark, path.rstrip("/"), col

    @cached_property
    def layout(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/rows").schema

    @cached_property
    def size(self) -> int:
        return self.rows().count()

    @classmethod
    def build(cls, df: DataFrame, path: str, keys: Sequence[str], col: str = "station_name") -> NameIndex:
        """Write the index of ``df``; ``keys`` order the rows of a list, and other columns go along."""
        index = cls(df.sparkSession, path, col)
        df.write.parquet(f"{index.path}/rows")
        lists = index.rows().select(F.explode(grams(F.col(col))).alias("gram"), F.struct("*").alias("row"))
        placed = lists.withColumn("bucket", _bucket(F.col("gram")))
        order = ["bucket", "gram", *(F.col("row")[k] for k in keys)]
        dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
        dealt.write.partitionBy("bucket").parquet(f"{index.path}/lists")
        counts = index._lists().groupBy("bucket", "gram").agg(F.count("*").alias("n"))
        counts.repartition("bucket").write.partitionBy("bucket").parquet(f"{index.path}/counts")
        return index

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.layout).parquet(f"{self.path}/rows")

    def _lists(self) -> DataFrame:
        layout = T.StructType([
            T.StructField("gram", T.StringType()),
            T.StructField("row", self.layout),
            T.StructField("bucket", T.IntegerType()),
        ])
        return self.spark.read.schema(layout).parquet(f"{self.path}/lists")

    def rarest(self, text: str) -> tuple[int, str, int] | None:
        """Bucket, part and number of rows of the part of ``text`` with the fewest rows; none if there is no part."""
        one = self.spark.range(1).select(F.explode(grams(F.lit(text))).alias("gram"))
        asked = [tuple(r) for r in one.select(_bucket(F.col("gram")), "gram").collect()]
        if not asked:
            return None
        counts = self.spark.read.schema("gram string, n long, bucket int").parquet(f"{self.path}/counts")
        wanted = F.col("bucket").isin({b for b, _ in asked}) & F.col("gram").isin([g for _, g in asked])
        known = {r["gram"]: r["n"] for r in counts.where(wanted).collect()}  # at most a row a part of the text
        return min(((b, g, known.get(g, 0)) for b, g in asked), key=lambda p: (p[2], p[1]))

    def search(self, text: str) -> DataFrame:
        rows, part = self.rows(), self.rarest(text)
        if part is None or part[2] * 2 > self.size:
            return search_by_name(rows, text, self.col)
        bucket, gram, _ = part
        found = self._lists().where((F.col("bucket") == bucket) & (F.col("gram") == gram))
        return search_by_name(found.select("row.*"), text, self.col)
