"""Every query of the library against its SQL in another engine, on the smallest sample."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from shelfline.plans.catalog import QUERIES
from shelfline.plans.oracle import oracle_queries

from .conftest import SAMPLE

# Columns that the rows of a sorted report are in the order of; "-" for descending. NULL is last.
SORTED_BY = {
    "v_monthly_sales": "year month",
    "v_innovation_cohort": "brand sku_name month_since_launch",
    "card_monthly_revenue_by_channel": "year month channel",
    "card_si_vs_so_summary": "year month brand",
    "card_sales_by_region": "year quarter region",
    "card_top_brands": "-total_revenue brand",
    "card_ecommerce_by_platform": "year month platform",
    "card_top_promoted_products": "-avg_uplift product_id promotion_type",
    "card_adoption_curve": "sku_name month_since_launch",
    "card_innovation_by_brand": "brand month_since_launch",
    "card_cohort_revenue": "launch_date sku_name channel",
    "adhoc_si_vs_so_limit": "year month brand region",
    "adhoc_cohort_like": "month_since_launch sku_name brand launch_date",
    "adhoc_promo_ranked": "-avg_uplift_pct promotion_type brand category",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SAMPLE}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle_queries()) and len(QUERIES) == 51
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql()) <= set(queries())


def _in_order(rows, columns):
    for name in reversed(columns):
        # Python's sort is stable, also in reverse, so sorting by the last column first gives the order by all.
        value = name.removeprefix("-")
        known = sorted((r for r in rows if r[value] is not None), key=lambda r: r[value], reverse=name != value)
        rows = known + [r for r in rows if r[value] is None]
    return rows


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, SAMPLE)
    result = engine.execute(oracle_queries()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    order = [list(types).index(column) for column in df.columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    assert expected
    rows = df.collect()
    assert sorted((tuple(row) for row in rows), key=repr) == expected
    if name in SORTED_BY:
        assert rows == _in_order(rows, SORTED_BY[name].split())


def test_entry(spark):
    assert entry(spark).columns == [
        "year",
        "month",
        "brand",
        "region",
        "sellin_revenue",
        "sellout_gt_revenue",
        "pos_revenue",
        "ecom_revenue",
    ]
