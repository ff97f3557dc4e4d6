"""Keys, cleaning steps, night expansion and integrity checks on small frames."""

import hashlib

import pytest
from conftest import values
from pyspark.sql import functions as F

from staylytics.functions import keys
from staylytics.operators import cleaning, marts, warehouse

PROBES = ["", "a", "PRT|Direct|TA/TO|Transient|0|None|None", "ü|é", "x" * 300]


def test_hash_matches_the_byte_formula(spark):
    got = {r["s"]: r["h"] for r in spark.createDataFrame([(p,) for p in PROBES], "s string").withColumn("h", keys.hash63(F.col("s"))).collect()}
    for p in PROBES:
        assert got[p] == int.from_bytes(hashlib.sha256(p.encode()).digest()[:8], "big") & (2**63 - 1)


def test_lookups(spark):
    df = spark.createDataFrame([(" a ",), ("H",), ("Z",), (None,)], "c string")
    assert [r[0] for r in df.select(keys.room_tier(F.col("c"))).collect()] == [1, 3, 0, 0]
    with pytest.raises(Exception, match="unknown hotel"):
        spark.createDataFrame([("Motel",)], "h string").select(keys.hotel_key(F.col("h"))).collect()


def test_dates_and_rates(spark):
    df = spark.createDataFrame([(2016, "April", 31, -5), (2016, "July", 1, 10), (2016, "February", 29, 20)],
                               "arrival_date_year long, arrival_date_month string, arrival_date_day_of_month long, adr_cents long")
    out = cleaning.build_arrival_date(df)
    assert [str(r[0]) for r in out.select("arrival_date").collect()] == ["None", "2016-07-01", "2016-02-29"]
    assert cleaning.drop_negative_rates(df).count() == 2


def test_winsorize_caps_only_the_top(spark):
    df = spark.createDataFrame([(100,)] * 199 + [(10_000_000,)], "adr_cents long")
    out = cleaning.winsorize_rates(df).agg(F.max("adr"), F.min("adr"), F.count("*")).first()
    assert out[0] < 100_000 and out[1] == 1.0 and out[2] == 200


def test_mismatch_treats_null_as_not_canceled(spark):
    df = spark.createDataFrame([("Canceled", 1), ("Canceled", 0), (None, 1), (None, None), ("Check-Out", 0)], "reservation_status string, is_canceled int")
    assert [r[0] for r in df.select(cleaning.cancellation_mismatch()).collect()] == [False, True, True, False, False]


def _fact(spark, rows):
    return spark.createDataFrame(rows, "reservation_status string, branch_key int, hotel string, arrival_date string, nights int, adr_cents long").withColumn("arrival_date", F.to_date("arrival_date"))


def test_night_expansion_edges(spark):
    fact = _fact(spark, [
        ("Check-Out", 1, "Resort Hotel", "2016-02-28", 3, 100), ("Check-Out", 1, "Resort Hotel", "2016-02-29", 1, 300),
        ("Canceled", 1, "Resort Hotel", "2016-02-28", 2, 900), ("No-Show", 1, "Resort Hotel", "2016-02-28", 2, 900),
        ("Check-Out", 1, "Resort Hotel", "2016-02-28", 0, 900), (None, 2, "City Hotel", "2016-02-28", 1, 50),
    ])
    nights = values(marts.nightly_totals(fact).withColumn("stay_date", F.col("stay_date").cast("string")), "branch_key", "stay_date", "occupied_rooms", "revenue_cents")
    assert nights == [(1, "2016-02-28", 1, 100), (1, "2016-02-29", 2, 400), (1, "2016-03-01", 1, 100), (2, "2016-02-28", 1, 50)]
    assert marts.occupied_nights(fact).count() == 5


def test_occupancy_is_clipped_and_trailing_means_start_with_the_current_value(spark):
    fact = _fact(spark, [("Check-Out", 1, "Resort Hotel", f"2016-01-0{d}", 1, 100) for d in (1, 2) for _ in range(250 * d)])
    rows = marts.daily_occupancy(fact).orderBy("occupancy_date").collect()
    assert [r["occupancy_pct"] for r in rows] == [100.0, 100.0]
    assert [r["revenue_7day_avg"] for r in rows] == [250.0, 250.0]


def test_integrity_checks_find_injected_faults(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    child = spark.createDataFrame([(1,), (9,), (8,), (9,), (None,)], "k int")
    assert values(warehouse.foreign_key_check("x", child, "k", parent, "k")) == [("x", 2, "8,9")]
    assert values(warehouse.key_check("p", parent, "k", ["k"])) == [("p", 3, False, 0)]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert values(warehouse.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]
    assert values(warehouse.upsert(old.select("k"), new.select("k"), ["k"])) == [(1,), (2,), (3,)]
