"""Small tables with results worked out by hand."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from dockpulse.operators.serving import usage_rate


@pytest.fixture(scope="module")
def crew(spark):
    data = [
        ("Red", "Ida", 34, 181, "lead guitar"),
        ("Red", "Jo", 45, 158, "drums"),
        ("Red", "Kit", 19, 177, "bass guitar"),
        ("Blue", "Lu", 27, 169, "keys"),
        ("Blue", "Max", 31, 190, "guitar tech"),
        ("Green", "Noa", 52, 164, "manager"),
        ("Green", "Oli", 40, 172, "sound"),
        ("Green", "Pia", 23, 155, "drums and sound"),
    ]
    return spark.createDataFrame(data, ["team", "name", "age", "height", "role"])


@pytest.fixture(scope="module")
def docks(spark):
    data = [("Fir", 12, 9), ("Ash", 30, 6), ("Elm", 16, 4), ("Fir", 12, 3), ("Bay", 8, 1), ("Elm", 16, 16)]
    return spark.createDataFrame(data, ["stationName", "rackTotCnt", "parkingBikeTotCnt"])


def test_inferred_integers_are_long(crew):
    assert dict(crew.dtypes)["age"] == "bigint"


@pytest.mark.parametrize(
    "condition, names",
    [
        ("age <= 30", {"Kit", "Lu", "Pia"}),
        ("age >= 30 AND age <= 40", {"Ida", "Max", "Oli"}),
        ("age BETWEEN 30 AND 40", {"Ida", "Max", "Oli"}),
        ("contains(role, 'guitar')", {"Ida", "Kit", "Max"}),
        ("role LIKE '%sound%'", {"Oli", "Pia"}),
        ("team = 'Blue'", {"Lu", "Max"}),
    ],
)
def test_filters(crew, condition, names):
    assert {r["name"] for r in crew.where(condition).collect()} == names


def test_grouped_means(crew):
    means = [F.round(F.avg(c), 4).alias(c) for c in ("age", "height")]
    assert rows(crew.groupBy("team").agg(*means, F.count("*").alias("n"))) == [
        ("Blue", 29.0, 179.5, 2),
        ("Green", 38.3333, 163.6667, 3),
        ("Red", 32.6667, 172.0, 3),
    ]


def test_flag_and_order(crew):
    flagged = crew.withColumn("long_reach", F.col("height") >= 175)
    assert {r["name"] for r in flagged.where("long_reach").collect()} == {"Ida", "Kit", "Max"}
    names = [r["name"] for r in crew.orderBy(F.desc("height")).collect()]
    assert names == ["Max", "Ida", "Kit", "Oli", "Lu", "Noa", "Jo", "Pia"]


def test_sql_over_a_view(spark, crew):
    crew.createOrReplaceTempView("crew_rows")
    assert rows(spark.sql("SELECT team, count(*) AS n FROM crew_rows GROUP BY team")) == [
        ("Blue", 2),
        ("Green", 3),
        ("Red", 3),
    ]


def test_station_sums(docks):
    bikes = F.col("parkingBikeTotCnt")
    out = docks.groupBy("stationName").agg(F.avg(bikes), F.sum(bikes), F.count(bikes))
    assert rows(out) == [("Ash", 6.0, 6, 1), ("Bay", 1.0, 1, 1), ("Elm", 10.0, 20, 2), ("Fir", 6.0, 12, 2)]


def test_usage_is_a_mean_of_ratios_highest_first(docks):
    out = usage_rate(docks, "stationName", "parkingBikeTotCnt", "rackTotCnt").collect()
    assert [tuple(r) for r in out] == [("Elm", 62.5), ("Fir", 50.0), ("Ash", 20.0), ("Bay", 12.5)]


def test_usage_without_racks_is_null(spark):
    df = spark.createDataFrame([("x", 3, 0), ("y", 1, 2)], "s string, v int, t int")
    assert [tuple(r) for r in usage_rate(df, "s", "v", "t").collect()] == [("y", 50.0), ("x", None)]
