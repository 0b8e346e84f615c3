import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelfline.functions import (
    date_key,
    demand_columns,
    exact_avg,
    exact_sum,
    lenient_date,
    lenient_double,
    lenient_int,
    month_boundaries,
    portable_round,
    season_of,
)
from shelfline.operators.dims import CalendarBounds, dim_date, dim_date_of

from .conftest import rows_of


@pytest.mark.parametrize(
    "value, rounded",
    [(1.005, 1.0), (1.255, 1.25), (0.285, 0.28), (2.675, 2.68), (-0.125, -0.13), (0.0, 0.0), (None, None)],
)
def test_portable_round(spark, value, rounded):
    df = spark.createDataFrame([(value,)], "x DOUBLE").select(portable_round(F.col("x")).alias("r"))
    assert df.first().r == rounded


@pytest.mark.parametrize(
    "start, end, months",
    [
        (date(2023, 1, 31), date(2023, 2, 1), 1),
        (date(2023, 1, 1), date(2023, 1, 31), 0),
        (date(2022, 12, 31), date(2024, 1, 1), 13),
        (date(2023, 3, 1), date(2023, 2, 28), -1),
    ],
)
def test_month_boundaries(spark, start, end, months):
    df = spark.createDataFrame([(start, end)], "a DATE, b DATE")
    assert df.select(month_boundaries(F.col("a"), F.col("b")).alias("m")).first().m == months


def test_lenient_casts(spark):
    df = spark.createDataFrame([("23.7",), ("abc",), (" 5 ",), ("-3.9",), (None,), ("2023-02-30",), ("2023-02-28",)], "x STRING")
    x = F.col("x")
    rows = df.select(lenient_int(x), lenient_double(x), lenient_date(x)).collect()
    assert [r[0] for r in rows] == [23, None, 5, -3, None, None, None]
    assert [r[1] for r in rows] == [23.7, None, 5.0, -3.9, None, None, None]
    assert [r[2] for r in rows[5:]] == [None, date(2023, 2, 28)]


def test_lenient_casts_keep_typed_values(spark):
    df = spark.createDataFrame([(date(2023, 5, 1), 7, 1.5)], "d DATE, i INT, x DOUBLE")
    assert tuple(df.select(lenient_date(F.col("d")), lenient_int(F.col("i")), lenient_double(F.col("x"))).first()) == (
        date(2023, 5, 1),
        7,
        1.5,
    )


def test_exact_sum_is_exact_and_does_not_depend_on_order(spark):
    amounts = [0.1] * 1000 + [123456789012.3456, -0.0001, 2.5, None]
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "x DOUBLE").repartition(7)
        assert df.agg(exact_sum("x").alias("s")).first().s == 123456789114.8455


def test_exact_sum_goes_beyond_a_bigint_of_units(spark):
    df = spark.range(1000).select(F.lit(900_000_000_000_000.0).alias("x"))
    assert df.agg(exact_sum("x").alias("s")).first().s == 9e17


def test_exact_sum_of_negative_amounts(spark):
    df = spark.createDataFrame([(-1.25,), (-2.005,), (0.5,)], "x DOUBLE")
    assert df.agg(exact_sum("x").alias("s")).first().s == -2.755


def test_exact_sum_and_avg_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x DOUBLE").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"))
    assert tuple(df.first()) == (None, None)


def test_exact_avg_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1.5,), (None,), (2.0,)], "x DOUBLE")
    assert df.agg(exact_avg("x").alias("a")).first().a == 1.75


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_cut_nothing_and_propagate_what_is_no_number(spark, settings, ansi):
    settings(ansi__enabled=ansi)
    nan, inf = float("nan"), float("inf")

    def of(*amounts):
        df = spark.createDataFrame([(x,) for x in amounts], "x DOUBLE")
        (row,) = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("m")).collect()
        return row.s, row.m

    assert of(*[0.00004] * 1000) == (pytest.approx(0.04), pytest.approx(0.00004))
    assert all(math.isnan(x) for x in of(5.0, nan))
    assert of(5.0, inf) == (inf, inf)
    assert of(1e16, 5.0)[0] == pytest.approx(1e16)
    assert of(*[9e14] * 3) == (2.7e15, 9e14)
    assert of(None, 0.1, 0.2) == (0.3, 0.15)
    assert of(None) == (None, None) and of() == (None, None)


def test_calendar_of_the_sales(spark):
    df = spark.createDataFrame([(date(2023, 3, 5),), (date(2024, 2, 29),), (None,)], "d DATE")
    assert rows_of(dim_date_of(df, "d")) == rows_of(dim_date(spark, CalendarBounds(date(2023, 1, 1), date(2024, 12, 31))))
    assert dim_date_of(df.filter("d IS NULL"), "d").count() == 0


def test_adoption_of_an_unknown_launch_is_unknown(spark):
    df = spark.createDataFrame([(date(2023, 3, 5), None), (date(2023, 3, 5), date(2023, 3, 1))], "day DATE, launch DATE")
    found = demand_columns(df, "day", "launch", 2023).collect()
    assert (found[0].adoption_factor, found[0].demand_index) == (None, None)
    assert found[1].adoption_factor is not None


def test_calendar(spark):
    days = {r.date: r for r in dim_date(spark, CalendarBounds(date(2023, 1, 1), date(2024, 12, 31))).collect()}
    assert len(days) == 731
    sunday, monday = days[date(2023, 1, 1)], days[date(2024, 12, 30)]
    assert (sunday.week, sunday.day_of_week, sunday.day_name, sunday.date_key) == (52, 0, "Sunday", 20230101)
    assert (monday.week, monday.day_of_week, monday.day_name, monday.month_name) == (1, 1, "Monday", "December")
    seasons = [days[date(2023, month, 1)].season for month in range(1, 13)]
    assert seasons == ["Tet Season"] * 2 + ["Regular"] * 2 + ["Summer"] * 4 + ["Regular"] * 2 + ["Year-End"] * 2


def test_default_calendar_has_three_years(spark):
    assert dim_date(spark).count() == 1096


def test_date_key_and_season_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "d DATE").select(date_key(F.col("d")).alias("k"), season_of(F.col("d")).alias("s"))
    assert tuple(df.first()) == (None, "Regular")


def test_demand(spark):
    launch = date(2023, 1, 31)
    rows = [(date(2022, 12, 31), launch), (date(2023, 1, 31), launch), (date(2023, 3, 1), launch), (date(2024, 6, 1), launch)]
    df = demand_columns(spark.createDataFrame(rows, "d DATE, l DATE"), "d", "l", 2023)
    got = [(r.season_factor, r.growth_factor, r.adoption_factor) for r in df.orderBy("d").collect()]
    assert got == [(1.2, 0.6, 0.0), (1.6, 1.0, 0.1), (1.0, 1.0, 0.4), (1.4, 1.4, 1.0)]
    assert df.orderBy("d").collect()[3].demand_index == pytest.approx(1.96)
