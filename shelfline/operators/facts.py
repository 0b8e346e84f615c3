"""Fact tables: clean rows whose natural keys are replaced by surrogate keys."""

from pyspark.sql import DataFrame

from .dims import Dimensions
from .star import with_date, with_distributor, with_product, with_store


def fact_sellin(sellin: DataFrame, dims: Dimensions) -> DataFrame:
    rows = with_date(sellin, dims.date, "date_key")
    rows = with_product(rows, dims.product, "product_key")
    rows = with_distributor(rows, dims.distributor, "distributor_key")
    return rows.select(
        "date_key", "product_key", "distributor_key", "qty", "gross_sales", "discount", "net_sales"
    )


def _store_sales(sales: DataFrame, dims: Dimensions) -> DataFrame:
    rows = with_date(sales, dims.date, "date_key")
    rows = with_product(rows, dims.product, "product_key")
    rows = with_store(rows, dims.store, "store_key")
    return rows.select("date_key", "store_key", "product_key", "qty", "revenue")


def fact_sellout(sellout: DataFrame, dims: Dimensions) -> DataFrame:
    return _store_sales(sellout, dims)


def fact_pos_sales(pos_sales: DataFrame, dims: Dimensions) -> DataFrame:
    return _store_sales(pos_sales, dims)


def fact_ecommerce_sales(ecommerce_orders: DataFrame, dims: Dimensions) -> DataFrame:
    rows = with_date(ecommerce_orders, dims.date, "date_key")
    rows = with_product(rows, dims.product, "product_key")
    return rows.select("date_key", "platform", "product_key", "qty", "revenue")


def fact_inventory(inventory: DataFrame, dims: Dimensions) -> DataFrame:
    rows = with_date(inventory, dims.date, "date_key")
    rows = with_product(rows, dims.product, "product_key")
    return rows.select("date_key", "product_key", "stock_on_hand")
