"""Search by an index of name parts, against a scan."""

import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dockpulse.operators.names import NameIndex
from dockpulse.operators.serving import search_by_name
from dockpulse.session import using

NAMES = [
    "Seoul Station", "seoul forest", "SEOUL", "서울역 1번출구", "서울숲역", "ab", "", None, "aaaa", "aaab",
    "Straße 5", "İstanbul", "a%b_c", "Seoul Station", "tab\there", "x" * 5000 + "end",
]
TEXTS = [
    "", "s", "SE", "seo", "Seoul", "station", "서울", "서울역", "번출구", "aaa", "aab", "aaaaa", "STRASSE", "straße", "İST",
    "%b_", "_", "nowhere", "seoul station and more", "xend", "\t", "ab\th",
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(enumerate(NAMES)), "station_id int, station_name string")


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    return NameIndex.build(table, f"{tmp_path_factory.mktemp('names')}/index", ["station_id"])


def test_search_finds_what_a_scan_finds(table, index):
    for text in TEXTS:
        assert rows(index.search(text)) == rows(search_by_name(table, text)), text


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_rare_part_opens_one_bucket_and_no_rows(index):
    text = plan(index.search("forest"))
    assert text.count("FileScan") == 1 and "EqualTo(gram," in text
    assert re.search(r"PartitionFilters: \[isnotnull\(bucket#\d+\), \(bucket#\d+ = \d+\)\]", text)
    assert all("/lists/" in f for f in index.search("forest").inputFiles())
    assert all("/rows/" in f for f in index.search("se").inputFiles())


def test_a_part_of_most_names_is_read_from_the_rows_and_its_list_is_cut(spark, tmp_path):
    many = spark.range(20_000).select(
        F.col("id").alias("station_id"), F.concat(F.lit("Dock "), F.col("id")).alias("station_name")
    )
    with using(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}):
        index = NameIndex.build(many, f"{tmp_path}/index", ["station_id"])
    assert all("/rows/" in f for f in index.search("dock").inputFiles())
    assert rows(index.search("DOCK 1999"), "station_id") == [(1999,), *[(i,) for i in range(19990, 20000)]]
    lists = index._lists().where("gram = 'doc'")
    assert lists.select(F.input_file_name()).distinct().count() > 1
    assert lists.count() == 20_000


def test_clashing_columns_and_repeated_rows(spark, tmp_path):
    odd = spark.createDataFrame(
        [(1, "North Gate", 5, "x", 7)] * 2 + [(2, "South Gate", 6, "y", 8), (3, "East", 6, "y", 8)],
        "bucket int, gram string, row int, n string, `a.b` int",
    )
    index = NameIndex.build(odd, f"{tmp_path}/index", ["bucket"], col="gram")
    for text in ("north", "gate", "east", "e"):
        assert rows(index.search(text)) == rows(search_by_name(odd, text, "gram"))


def test_an_empty_table_and_one_of_null_names(spark, table, tmp_path):
    for i, some in enumerate((table.where("false"), table.where("station_name IS NULL"))):
        index = NameIndex.build(some, f"{tmp_path}/{i}", ["station_id"])
        assert index.search("seoul").isEmpty() and index.search("s").isEmpty()
        assert index.search("").count() == some.count()
