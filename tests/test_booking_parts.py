"""Parts of the booking join and of what follows it grow with the bookings."""

import pytest
from pyspark.sql import functions as F

from staylytics.operators import cleaning, marts, warehouse
from staylytics.plans import jobs
from staylytics.session import scratch_path
from staylytics.sources import bookings as source
from staylytics.sources.lake import Lake


@pytest.fixture
def root(spark, tmp_path):
    """Orders with up to three lines, some of them without a key or twice."""
    n = F.col("id")
    day = F.timestamp_seconds(F.lit(800_000_000) + n * 86_400 * 7)
    spark.range(1).select(F.lit(1).alias("n_nationkey"), F.lit("FRANCE").alias("n_name")).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(9).select(n.alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(120).select(
        F.when(n % 40 != 39, n).alias("o_orderkey"), (n % 9).alias("o_custkey"), F.element_at(F.array(F.lit("F"), F.lit("O")), (n % 2 + 1).cast("int")).alias("o_orderstatus"),
        day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(300).select(
        F.when(n % 50 != 49, n % 120).alias("l_orderkey"), (n % 211).alias("l_partkey"), (n % 13).alias("l_suppkey"), (n % 4 + 1).cast("int").alias("l_linenumber"),
        (n % 9 + 1).cast("double").alias("l_quantity"), (n * 10.5 + 900).alias("l_extendedprice"), F.element_at(F.array(*map(F.lit, "RAN")), (n % 3 + 1).cast("int")).alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
    )
    lines.unionByName(lines.where("l_partkey < 30")).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def _rows(df):
    return sorted(map(repr, df.collect()))


def _width(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_nights_are_dealt_over_more_tasks(spark, root, monkeypatch):
    def found():
        lake = Lake(spark, root)
        return marts.rooms_by_rate(warehouse.fact_rows(source.bookings(lake)), source.booking_parts(lake))

    few = found()
    assert source.booking_parts(Lake(spark, root)) is None
    monkeypatch.setattr(source, "TASK_BOOKINGS", 10)
    many = found()
    assert many.rdd.getNumPartitions() > _width(spark)
    assert _rows(few) == _rows(many) and few.count() > 100


def test_copies_are_found_by_more_tasks(spark, root, monkeypatch):
    seen = []
    settle = cleaning.settle
    monkeypatch.setattr(cleaning, "settle", lambda df: seen.append(df.rdd.getNumPartitions()) or settle(df))
    few = _rows(jobs.clean_job(Lake(spark, root), scratch_path(spark, "clean")))
    monkeypatch.setattr(source, "TASK_BOOKINGS", 10)
    width = _width(spark)
    with cleaning.options(spark, spark__sql__adaptive__enabled="false"):
        many = _rows(jobs.clean_job(Lake(spark, root), scratch_path(spark, "clean")))
    assert seen[1] == source.booking_parts(Lake(spark, root)) > width == _width(spark)
    assert few == many and len(few) > 100


def test_dates_put_together_are_those_parsed(spark):
    """What is cast or put together against the parser alone, on texts that it takes or refuses."""
    years = [2015, 999, 1000, 9999, 10000, -5, 0, None]
    days = [1, 9, 28, 29, 30, 31, 32, 0, -1, None]
    months = ["July", "july", "February", "Feb", "April", " July", "July ", "", "7", None]
    parts = spark.createDataFrame([(y, m, d) for y in years for m in months for d in days], "arrival_date_year long, arrival_date_month string, arrival_date_day_of_month long")
    texts = [*((str(y), "July", d) for y in (2015, " 2015", "02015", "+2015", "2015.0", "x", "") for d in ("5", "05", " 5", "5 ", "28", "31", "x", None)), ("2015", "May", "1")]
    text = spark.createDataFrame(texts, "arrival_date_year string, arrival_date_month string, arrival_date_day_of_month string")
    for df in (parts, text):
        parsed = F.try_to_date(F.concat_ws("-", *df.columns), "yyyy-MMMM-d")
        wrong = cleaning.build_arrival_date(df).where(~F.col("arrival_date").eqNullSafe(parsed)).collect()
        assert wrong == []
        assert cleaning.build_arrival_date(df).where("arrival_date IS NOT NULL").count() > 0
    days = ["2015-07-01", "2015-7-1", "2015-02-29", "2016-02-29", "2015-13-01", "2015-07-01 ", " 2015-07-01", "2015-07-01\n", "2015-07-01T", "2015-07-01 10:00:00", "0000-01-01",
            "0999-12-31", "1500-02-29", "1582-10-10", "9999-12-31", "10000-01-01", "+2015-07-01", "-2015-07-01", "2015", "2015-07", "unknown", "", "٢٠١٥-٠٧-٠١", None]
    found = spark.createDataFrame([(d,) for d in days], "reservation_status_date string").select("reservation_status_date", cleaning._status_date().alias("day"))
    assert found.where(~F.col("day").eqNullSafe(F.try_to_date("reservation_status_date", "yyyy-MM-dd"))).collect() == []


def test_month_names_and_dates_are_those_formatted(spark):
    days = spark.range(0, 800).select(F.when(F.col("id") % 9 != 8, F.timestamp_seconds(F.lit(-90_000_000_000) + F.col("id") * 250_000_000)).alias("l_shipdate"), F.lit(2).alias("l_linenumber"), F.lit(4.0).alias("l_quantity"))
    for name, want in (("arrival_date_month", "date_format(l_shipdate, 'MMMM')"), ("reservation_status_date", "date_format(date_add(cast(l_shipdate as date), 6), 'yyyy-MM-dd')")):
        found = days.select(F.expr(source._BOOKING_COLUMNS[name]).alias("found"), F.expr(want).alias("want"))
        assert found.where("NOT found <=> want").collect() == []
        assert found.where("found IS NULL").count() == 88
