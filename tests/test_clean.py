from datetime import date

import pytest

from shelfline.operators import clean
from shelfline.sources.sample_sources import SampleSources

from .conftest import SAMPLE, rows_of


def raw(spark, header, *rows):
    names = header.split(",")
    return spark.createDataFrame(list(rows), ", ".join(f"`{n}` STRING" for n in names))


def test_names_are_normalised(spark):
    df = raw(spark, " Store ID ,STORE NAME", ("a", "b"))
    assert clean.normalize_columns(df).columns == ["store_id", "store_name"]


def test_names_that_collide_are_refused(spark):
    with pytest.raises(ValueError, match="store_id"):
        clean.normalize_columns(raw(spark, "Store ID,store_id", ("a", "b")))


def test_sales_rows(spark):
    df = raw(
        spark,
        "date,store_id,product_id,qty,revenue",
        ("2023-01-01", "S1", "P1", "2", "10.5"),
        ("2023-01-01", "S1", "P1", "2", "10.5"),  # copy
        ("2023-01-01", "S1", "P1", "2.0", "10.50"),  # copy once it is typed
        ("bad-date", "S1", "P1", "2", "10.5"),  # the key turns NULL
        (None, "S1", "P1", "2", "10.5"),
        ("2023-01-01", None, "P1", "2", "10.5"),
        ("2023-01-01", "S1", "P2", "abc", "10.5"),  # quantity turns NULL
        ("2023-01-01", "S1", "P2", None, "10.5"),
        ("2023-01-01", "S1", "P2", "0", "10.5"),
        ("2023-01-01", "S1", "P2", "-1", "10.5"),
        ("2023-01-01", "S1", "P2", "0.9", "10.5"),  # truncated to 0
        ("2023-01-02", "S1", "P2", "3.7", "abc"),  # junk revenue stays as NULL
    )
    assert rows_of(clean.clean_pos_sales(df)) == [
        (date(2023, 1, 1), "S1", "P1", 2, 10.5),
        (date(2023, 1, 2), "S1", "P2", 3, None),
    ]


def test_stock_may_be_negative_or_missing(spark):
    df = raw(spark, "date,product_id,stock_on_hand", ("2023-01-01", "P", "-4"), ("2023-01-01", "P", "x"))
    assert rows_of(clean.clean_inventory(df)) == [(date(2023, 1, 1), "P", -4), (date(2023, 1, 1), "P", None)]


def test_promotions_need_a_range_in_order(spark):
    df = raw(
        spark,
        "promotion_id,product_id,start_date,end_date,promotion_type,discount_percent",
        ("A", "P", "2023-01-01", "2023-01-01", "bundle", "5"),
        ("B", "P", "2023-01-02", "2023-01-01", "bundle", "5"),
        ("C", "P", "junk", "2023-01-01", "bundle", "5"),
        ("D", "P", "2023-01-01", None, "bundle", "5"),
    )
    assert [r[0] for r in rows_of(clean.clean_promotions(df))] == ["A"]


def test_junk_in_a_numeric_key_stays_as_null(spark):
    df = raw(spark, "year,brand,market_share", ("x", "B", "0.5"), (None, "B", "0.5"))
    assert rows_of(clean.clean_market_share(df)) == [(None, "B", 0.5)]


def test_junk_launch_date_stays_as_null(spark):
    columns = "product_id,sku_code,sku_name,brand,category,sub_category,pack_size,launch_date,innovation_flag"
    df = raw(spark, columns, ("P", "S", "n", "b", "c", "s", "1", "soon", "1"), ("P", None, "n", "b", "c", "s", "1", "", "1"))
    assert rows_of(clean.clean_product_master(df)) == [("P", "S", "n", "b", "c", "s", "1", None, 1)]


# Not market_share: a junk year passes the key check of the first run as text, and fails the second as NULL.
@pytest.mark.parametrize("source", [name for name in clean.CLEAN_SPECS if name != "market_share"])
def test_cleaning_twice_changes_nothing(spark, source):
    once = getattr(clean, f"clean_{source}")(SampleSources(spark, SAMPLE).dirty(source))
    assert rows_of(clean.clean_table(once, clean.CLEAN_SPECS[source])) == rows_of(once)
