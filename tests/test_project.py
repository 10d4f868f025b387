import time
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import epoch_seconds, epoch_seconds_utc, rounded, run_stamp
from millrace.operators import (
    default_time,
    fill_defaults,
    rename,
    require_not_null,
    select_columns,
    stamp,
    to_target,
    with_ones,
)


def test_fill_covers_null_and_nan(spark):
    df = spark.createDataFrame([(1.5,), (None,), (float("nan"),)], "amount double")
    assert [r[0] for r in fill_defaults(df, {"amount": 0.0}).collect()] == [1.5, 0.0, 0.0]


def test_fill_keeps_decimals(spark):
    df = spark.createDataFrame([(Decimal("1.25"),), (None,)], "amount decimal(10,2)")
    out = fill_defaults(df, {"amount": 0.0})
    assert out.dtypes == [("amount", "decimal(10,2)")]
    assert [r[0] for r in out.collect()] == [Decimal("1.25"), Decimal("0.00")]


def test_fill_takes_the_default_as_it_is(spark):
    df = spark.createDataFrame([(None,) * 4], "d decimal(5,2), n int, f float, b boolean")
    out = fill_defaults(df, {"d": Decimal("0.55"), "n": 7.0, "f": 1, "b": True})
    assert out.dtypes == df.dtypes
    assert tuple(out.first()) == (Decimal("0.55"), 7, 1.0, True)


@pytest.mark.parametrize(
    "default",
    [
        {"name": 0.0},
        {"amount": "none"},
        {"amount": True},
        {"n": 0.5},
        {"n": Decimal("0.5")},
        {"n": 2**31},
        {"n": float("nan")},
        {"d": Decimal("0.555")},
        {"d": 1000},
        {"d": 0.125},
    ],
)
def test_fill_refuses_what_the_type_cannot_hold(spark, default):
    df = spark.createDataFrame([], "name string, amount double, n int, d decimal(5,2)")
    with pytest.raises(TypeError):
        fill_defaults(df, default)


def test_fill_refuses_a_missing_column(spark):
    with pytest.raises(ValueError):
        fill_defaults(spark.range(1), {"amount": 0.0})


def test_rename_ignores_missing_names(spark):
    df = spark.createDataFrame([(1, 2)], "JAN int, `1958` int")
    assert rename(df, {"JAN": "January", "FEB": "February"}).columns == ["January", "1958"]


def test_not_null_filter_on_an_odd_name(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None), ("c", "")], "m string, `1958` string")
    assert [r["m"] for r in require_not_null(df, ["1958"]).collect()] == ["a", "c"]
    assert select_columns(df, ["1958"]).columns == ["1958"]


def test_stamp_is_one_time_for_all_rows(spark):
    run_ts = datetime(2024, 5, 6, 7, 8, 9)
    df = stamp(spark.range(0, 100, 1, 5), run_ts=run_ts)
    assert {r[1] for r in df.collect()} == {run_ts}
    now = stamp(spark.range(0, 100, 1, 5))
    assert now.select("processed_timestamp").distinct().count() == 1
    assert df.select(run_stamp(F.col("processed_timestamp"))).first()[0] == "20240506_070809"


def test_a_run_time_without_zone_is_in_the_zone_of_the_session(spark, monkeypatch):
    monkeypatch.setenv("TZ", "Asia/Tokyo")
    time.tzset()
    try:
        naive = stamp(spark.range(1), run_ts=datetime(2024, 5, 6, 7, 8, 9, 10))
        aware = stamp(spark.range(1), run_ts=datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc))
        texts = [df.selectExpr("cast(processed_timestamp as string)").first()[0] for df in (naive, aware)]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert texts == ["2024-05-06 07:08:09.00001", "2024-05-06 07:08:09"]


def test_default_time_only_fills(spark):
    given = datetime(2020, 1, 1)
    df = spark.createDataFrame([(given,), (None,)], "join_date timestamp")
    first, second = [r[0] for r in default_time(df, "join_date").collect()]
    assert first == given and second > given


def test_to_target_rounds_half_up(spark):
    df = spark.createDataFrame(
        [(1, 2, 2.675, datetime(2024, 1, 1), "extra"), (1, 2, 0.125, datetime(2024, 1, 1), "x")],
        "order_id long, customer_id long, amount double, processed_timestamp timestamp, more string",
    )
    out = to_target(df, schemas.ORDERS_TRANSFORMED)
    assert out.schema.simpleString() == schemas.ORDERS_TRANSFORMED.simpleString()
    assert [r["amount"] for r in out.collect()] == [Decimal("2.68"), Decimal("0.13")]


def test_to_target_stops_on_a_value_that_does_not_fit(spark):
    df = stamp(spark.sql("select 3000000000 as order_id, 1 as customer_id, 1.0 as amount"))
    with pytest.raises(PySparkException):
        to_target(df, schemas.ORDERS_TRANSFORMED).collect()


def test_to_target_needs_ansi_and_all_columns(spark):
    with pytest.raises(ValueError, match="lacks"):
        to_target(spark.range(1), schemas.ORDERS_TRANSFORMED)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            to_target(spark.range(1), schemas.ORDERS_TRANSFORMED)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_with_ones(spark):
    assert with_ones(spark.range(3)).agg(F.sum("n")).first()[0] == 3


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_seconds_of_utc_wall_time_in_any_session_zone(spark, zone):
    df = spark.sql(
        "select timestamp_ntz'2024-11-03 01:30:00.999999' as a, timestamp_ntz'1969-12-31 23:59:58' as b"
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = df.select(epoch_seconds_utc(F.col("a")), epoch_seconds_utc(F.col("b"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1730597400, -2)


def test_scalars(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00.9' as ts, 21.005 as v, 20.994D as w")
    row = df.select(epoch_seconds(F.col("ts")), rounded(F.col("w"))).first()
    assert tuple(row) == (1704067200, 20.99)
