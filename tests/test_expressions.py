from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyhouse.functions import expressions as X
from tallyhouse.labels import TENURE_EDGES, TENURE_LABELS, TIER_EDGES, TIER_LABELS
from tallyhouse.operators import warehouse as W


def test_bins_are_right_closed(spark):
    ages = [0.0, 12.0, 12.5, 24.0, 60.0, 999.0, 1000.0, None]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, a double")
    out = rows.select(
        "i",
        X.bin_right_closed(F.col("a"), TENURE_EDGES, TENURE_LABELS).alias("band"),
        X.bin_index(F.col("a"), TENURE_EDGES).alias("at"),
    ).orderBy("i")
    got = [(r.band, r.at) for r in out.collect()]
    assert got == [
        (None, None), ("0-12m", 0), ("13-24m", 1), ("13-24m", 1), ("37-60m", 3), ("60m+", 4), (None, None), (None, None),
    ]


def test_score_tiers(spark):
    rows = spark.createDataFrame([(0.0,), (0.25,), (0.2500001,), (0.5,), (0.75,), (1.0,)], "s double")
    got = [r[0] for r in rows.select(X.bin_right_closed(F.col("s"), TIER_EDGES, TIER_LABELS)).collect()]
    assert got == [None, "low", "medium", "medium", "high", "critical"]
    assert rows.where("s = 0").select(X.text_or(X.bin_right_closed(F.col("s"), TIER_EDGES, TIER_LABELS))).first()[0] == "nan"


def test_only_exact_yes_is_one(spark):
    rows = spark.createDataFrame([("Yes",), ("No",), ("yes",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(X.flag_from_text(F.col("t"))).collect()] == [1, 0, 0, 0, 0]


def test_missing_tokens(spark):
    rows = spark.createDataFrame([("NA",), ("null",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in rows.select(X.blank_missing(F.col("t"))).collect()] == [None, None, "x", None, None]


def test_calendar_matches_python(spark):
    start = dt.datetime(2015, 12, 20, 5)
    moments = [start + dt.timedelta(days=i, hours=i % 7) for i in range(1600)]
    moments += [dt.datetime(2017, 1, 1), dt.datetime(2018, 1, 3), dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 29)]
    moments += [dt.datetime(2024, 2, 29, 23, 59)]
    rows = spark.createDataFrame([(m,) for m in moments], "at timestamp_ntz")
    got = {r["full_date"]: r for r in W.date_dimension(rows, "at").collect()}
    assert set(got) == {m.date() for m in moments}
    for day, r in got.items():
        assert r["date_id"] == int(day.strftime("%Y%m%d"))
        assert r["quarter"] == (day.month - 1) // 3 + 1
        assert r["week_of_year"] == int(day.strftime("%W"))
        assert r["day_of_week"] == day.isoweekday()
        assert r["month_name"] == day.strftime("%B") and r["day_name"] == day.strftime("%A")
        assert r["is_weekend"] == int(day.weekday() >= 5)


def test_percentages_survive_zero(spark):
    row = spark.range(1).select(
        X.percent(F.lit(1), F.lit(0)).alias("a"), X.percent_change(F.lit(0.0), F.lit(2.0)).alias("b"),
        X.percent_change(F.lit(2.0), F.lit(3.0)).alias("c"),
    ).first()
    assert (row.a, row.b, row.c) == (None, None, 50.0)


def test_cents_are_exact(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (1234567.89,)], "v double")
    assert rows.agg(X.from_cents(F.sum(X.cents(F.col("v"))))).first()[0] == 1234568.19


def test_hash_key_is_exact_as_double(spark):
    row = spark.range(1000).select(F.max(X.hash_key(F.col("id"), 1)), F.max(X.hash_unit(F.col("id"), 1))).first()
    assert row[0] < 2**52 and row[1] < 1.0
