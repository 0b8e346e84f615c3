"""Small hand-made tables."""

from datetime import date, timedelta

from shelfline.operators.dims import (
    CalendarBounds,
    Dimensions,
    dim_date,
    distributor_rows,
    product_rows,
    promotion_rows,
    store_rows,
)

BOUNDS = CalendarBounds(date(2023, 1, 1), date(2023, 12, 31))
DAY = timedelta(days=1)


def products(spark, *rows):
    """(product_id, brand, launch_date, innovation_flag)"""
    return spark.createDataFrame(
        [(p, f"SKU-{p}", f"Name {p}", b, "Water", "Still", "250ml", launch, flag) for p, b, launch, flag in rows],
        "product_id STRING, sku_code STRING, sku_name STRING, brand STRING, category STRING, sub_category STRING, "
        "pack_size STRING, launch_date DATE, innovation_flag INT",
    )


def stores(spark, *ids):
    return spark.createDataFrame(
        [(i, f"Store {i}", "ChainA", "North", "Hill") for i in ids],
        "store_id STRING, store_name STRING, chain STRING, region STRING, province STRING",
    )


def retailers(spark, *ids):
    return spark.createDataFrame(
        [(i, f"Shop {i}", "D1", "Kiosk", "South", "Bay") for i in ids],
        "retailer_id STRING, name STRING, distributor_id STRING, store_type STRING, region STRING, province STRING",
    )


def distributors(spark, *ids):
    return spark.createDataFrame(
        [(i, f"Dist {i}", "East", "Lake") for i in ids],
        "distributor_id STRING, name STRING, region STRING, province STRING",
    )


def promotions(spark, *rows):
    """(promotion_id, product_id, start_date, end_date, promotion_type, discount_percent)"""
    return spark.createDataFrame(
        list(rows),
        "promotion_id STRING, product_id STRING, start_date DATE, end_date DATE, promotion_type STRING, "
        "discount_percent DOUBLE",
    )


def pos_sales(spark, *rows):
    return spark.createDataFrame(
        list(rows), "date DATE, store_id STRING, product_id STRING, qty INT, revenue DOUBLE"
    )


def sellout(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "date DATE, retailer_id STRING, distributor_id STRING, product_id STRING, qty INT, revenue DOUBLE",
    )


def sellin(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "date DATE, distributor_id STRING, product_id STRING, qty INT, gross_sales DOUBLE, discount DOUBLE, "
        "net_sales DOUBLE",
    )


def ecommerce(spark, *rows):
    return spark.createDataFrame(
        list(rows), "date DATE, platform STRING, product_id STRING, qty INT, revenue DOUBLE"
    )


def natural(spark, product=None, distributor=None, store=(None, None), promotion=None, bounds=BOUNDS):
    return Dimensions(
        date=dim_date(spark, bounds),
        product=product_rows(product) if product is not None else None,
        distributor=distributor_rows(distributor) if distributor is not None else None,
        store=store_rows(*store) if store[0] is not None else None,
        promotion=promotion_rows(promotion) if promotion is not None else None,
    )
