import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith

from tidecast.sources.listing_pages import COLUMNS, PageReader, saved_listing, write_pages


@pytest.fixture(scope="module")
def trades(spark):
    rows = [(i, None if i % 11 == 0 else f"T{i % 3}", None if i % 50 == 7 else 1000 + i // 4) for i in range(500)]
    return spark.createDataFrame(rows, "trade_id long, ticker string, ts long").repartition(3)


@pytest.fixture(scope="module")
def path(trades, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("listing") / "pages")
    write_pages(trades, folder, limit=7, pages_of_range=6)
    return folder


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pages_joined_are_the_listing(spark, trades, path):
    back = saved_listing(spark, path)
    assert back.columns == list(COLUMNS)
    assert rows_of(back.select("trade_id", "ticker", "ts")) == rows_of(trades)
    sizes = back.groupBy("page").agg(F.count("*").alias("n"), F.max("place").alias("last")).orderBy("page").collect()
    assert [r["page"] for r in sizes] == list(range(72))
    assert {(r["n"], r["last"]) for r in sizes} == {(7, 6), (3, 2)}
    order = back.where("ts IS NOT NULL").orderBy("page", "place").collect()
    assert [(r["ts"], r["trade_id"]) for r in order] == sorted((r["ts"], r["trade_id"]) for r in order)


FILTERS = [
    "ticker = 'T1'",
    "ts >= 1040 AND ts < 1060",
    "ts > 1040 AND ts <= 1060 AND ticker IN ('T0', 'T2', NULL)",
    "ts IN (1001, 1100, 5000)",
    "ticker IS NULL OR ts = 1003",
    "ticker IS NULL",
    "startswith(ticker, 'T') AND trade_id < 100",
    "ts IS NULL",
    "ts = 9",
    "NOT ticker = 'T1'",
    "ticker <=> 'T1'",
    "ts % 2 = 0 AND ticker = 'T2'",
    "page > 3 AND place = 2",
]


@pytest.mark.parametrize("wanted", FILTERS)
def test_filters_give_what_spark_gives(spark, path, wanted):
    """Against the same rows in a table, where Spark decides all filters."""
    rows = saved_listing(spark, path)
    assert rows_of(rows.where(wanted)) == rows_of(spark.createDataFrame(rows.collect(), rows.schema).where(wanted))


def test_filters_reach_the_source(spark, path):
    rows = saved_listing(spark, path, ["ts", "ticker"]).where((F.col("ts") >= 1100) & (F.col("ticker") == "T1"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    assert rows.columns == ["ts", "ticker"]


def test_ranges_are_left_out_by_name(path):
    def ranges(*filters):
        reader = PageReader(path, list(COLUMNS))
        left = list(reader.pushFilters(list(filters)))
        return len(reader.partitions()), left

    everything, _ = ranges()
    assert everything == 12
    assert ranges(GreaterThanOrEqual(("ts",), 1100))[0] < 4
    assert ranges(LessThan(("ts",), 1000))[0] == 1  # a partition without a folder
    assert ranges(EqualTo(("ts",), 1050), IsNotNull(("ts",)))[0] <= 2
    assert ranges(In(("ts",), (1001, 1124)))[0] <= 4
    assert ranges(GreaterThan(("ts",), 1010), LessThanOrEqual(("ts",), 1012))[0] <= 2
    begins = StringStartsWith(("ticker",), "T")
    assert ranges(begins) == (everything, [begins])


def test_a_choice_of_columns(spark, path):
    assert saved_listing(spark, path, ["page"]).distinct().count() == 72
    with pytest.raises(Exception, match="columns must be some of"):
        saved_listing(spark, path, ["price"]).collect()


def test_an_empty_listing(spark, trades, tmp_path):
    write_pages(trades.limit(0), str(tmp_path / "none"), limit=5)
    assert saved_listing(spark, str(tmp_path / "none")).collect() == []


def test_a_hot_ticker_and_repeated_trades_keep_pages_even(spark, tmp_path):
    rows = spark.range(1000).select(F.lit(1).cast("long").alias("trade_id"), F.lit("hot").alias("ticker"), F.lit(5).cast("long").alias("ts"))
    write_pages(rows, str(tmp_path / "hot"), limit=10, pages_of_range=10)
    assert sorted(r["count"] for r in saved_listing(spark, str(tmp_path / "hot")).groupBy("page").count().collect()) == [10] * 100
