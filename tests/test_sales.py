from datetime import date

from pyspark.sql import functions as F

from shelfline.operators import cards, facts, sales, views
from shelfline.plans.catalog import QUERIES
from shelfline.sources.sample_sources import SampleSources

from .conftest import SAMPLE, rows_of
from .fixtures import (
    distributors,
    ecommerce,
    natural,
    pos_sales,
    products,
    retailers,
    sellin,
    sellout,
    stores,
)

D = date(2023, 3, 5)


def small_mart(spark, product=None):
    product = product or products(spark, ("P", "BrandA", date(2022, 1, 1), 0))
    dims = natural(spark, product, distributors(spark, "D1"), (stores(spark, "S"), retailers(spark, "R")))
    return sales.sales_mart(
        sellin(spark, (D, "D1", "P", 3, 30.0, 3.0, 27.0), (D, "D9", "P", 1, 1.0, 0.0, 1.0)),
        sellout(spark, (D, "R", "D1", "P", 2, 20.0), (D, "R", "D1", "P9", 1, 1.0)),
        pos_sales(spark, (D, "S", "P", 1, 11.5), (date(2024, 1, 1), "S", "P", 1, 1.0)),
        ecommerce(spark, (D, "Shop", "P", 4, 44.0), (None, "Shop", "P", 4, 44.0)),
        dims,
    )


def test_channels_of_the_mart(spark):
    mart = small_mart(spark).select(
        "channel", "region", "province", "store_type", "qty", "revenue", "gross_sales", "discount"
    )
    # Unknown ids and days outside the calendar are gone.
    assert rows_of(mart) == [
        ("Ecommerce", None, None, "Online", 4, 44.0, 44.0, 0.0),
        ("POS Modern Trade", "North", "Hill", "Modern Trade", 1, 11.5, 11.5, 0.0),
        ("Sell-In", "East", "Lake", None, 3, 27.0, 30.0, 3.0),
        ("Sell-Out GT", "South", "Bay", "Kiosk", 2, 20.0, 20.0, 0.0),
    ]


def test_versions_of_a_product_repeat_its_sales(spark):
    product = products(spark, ("P", "BrandA", date(2022, 1, 1), 0), ("P", "BrandB", date(2022, 1, 1), 0))
    rows = small_mart(spark, product).groupBy("brand").count()
    assert rows_of(rows) == [("BrandA", 4), ("BrandB", 4)]


def test_region_without_name(spark):
    mart = small_mart(spark)
    by_region = {r.region: r for r in views.v_si_vs_so(mart).collect()}
    assert by_region[None].ecom_revenue == 44.0 and by_region[None].pos_revenue == 0.0
    assert None not in {r.region for r in views.v_regional_performance(mart).collect()}
    assert {r.channel for r in views.v_regional_performance(mart).collect()} == {
        "Sell-In",
        "Sell-Out GT",
        "POS Modern Trade",
    }


def test_daily_totals_merge_versions_of_a_product(spark):
    # Two versions that agree in brand and category: their (repeated) sales are one row.
    product = products(spark, ("P", "BrandA", date(2022, 1, 1), 0), ("P", "BrandA", date(2022, 2, 1), 0))
    dims = natural(spark, product)
    daily = sales.daily_totals(
        pos_sales(spark, (D, "S", "P", 1, 10.0), (D, "T", "P", 2, 5.25)), dims, dims.product, "brand", "category"
    )
    found = daily.select("product_id", "brand", "total_qty", sales.revenue_of().alias("revenue"))
    assert rows_of(found) == [("P", "BrandA", 6, 30.5)]


def test_reports_are_sorted(spark):
    rows = cards.card_top_brands(small_mart(spark)).collect()
    assert [tuple(r) for r in rows] == [("BrandA", 102.5)]
    mart = QUERIES["sales_mart"](spark, SAMPLE)
    totals = [r.total_revenue for r in cards.card_top_brands(mart).collect()]
    assert totals == sorted(totals, reverse=True)
    months = [(r.year, r.month, r.channel) for r in cards.card_monthly_revenue_by_channel(mart).collect()]
    assert months == sorted(months)


def test_mart_is_the_same_from_facts_and_from_clean_tables(spark):
    s = SampleSources(spark, SAMPLE)
    d = s.dimensions("product", "distributor", "store")
    from_facts = sales.sales_mart(
        facts.fact_sellin(s.typed("sellin"), d),
        facts.fact_sellout(s.typed("sellout"), d),
        facts.fact_pos_sales(s.typed("pos_sales"), d),
        facts.fact_ecommerce_sales(s.typed("ecommerce_orders"), d),
        d,
    )
    from_clean = QUERIES["sales_mart"](spark, SAMPLE)
    assert from_facts.columns == from_clean.columns
    assert rows_of(from_facts) == rows_of(from_clean)


def test_mart_has_the_revenue_of_the_facts(spark):
    s = SampleSources(spark, SAMPLE)
    d = s.dimensions("product", "store")
    fact = facts.fact_pos_sales(s.typed("pos_sales"), d).agg(F.sum("qty")).first()[0]
    mart = QUERIES["sales_mart"](spark, SAMPLE).filter("channel = 'POS Modern Trade'")
    assert mart.agg(F.sum("qty")).first()[0] == fact
