"""The cross-channel sales mart and the daily totals that the other marts start from."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import amount_parts, sum_of_parts
from .dims import Dimensions
from .star import SPREAD, merged, with_date, with_distributor, with_product, with_store


def _described(
    sales: DataFrame, dims: Dimensions, placed: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """``sales`` with the columns of the calendar and the product that the mart shows, and what ``placed`` adds.

    The narrow place comes before the wide product, and the calendar, which moves no rows, last: rows that are
    shuffled for one side do not carry the attributes of the next. Rows that lie in buckets by product meet the
    products first, where they lie.
    """

    def with_products(rows: DataFrame) -> DataFrame:
        products = ("brand", "category", "sub_category", "sku_name", "pack_size")
        return with_product(rows, merged(dims.product), *products)

    rows = placed(with_products(sales)) if SPREAD in sales.columns else with_products(placed(sales))
    # Clean rows have their date already, fact rows get it from the calendar.
    day = ("date",) if "date_key" in sales.columns else ()
    return with_date(rows, dims.date, *day, "year", "quarter", "month", "season")


def _channel(
    rows: DataFrame, name: str, place: tuple[Column, Column, Column], amounts: tuple[Column, Column, Column]
) -> DataFrame:
    """The columns of the mart, with (region, province, store type) and (revenue, gross, discount) given."""
    region, province, store_type = place
    revenue, gross, discount = amounts
    return rows.select(
        "date",
        "year",
        "quarter",
        "month",
        "season",
        F.lit(name).alias("channel"),
        "brand",
        "category",
        "sub_category",
        F.col("sku_name").alias("product_name"),
        "pack_size",
        region.alias("region"),
        province.alias("province"),
        store_type.alias("store_type"),
        "qty",
        revenue.alias("revenue"),
        gross.alias("gross_sales"),
        discount.alias("discount"),
    )


def sales_mart(
    sellin: DataFrame, sellout: DataFrame, pos_sales: DataFrame, ecommerce: DataFrame, dims: Dimensions
) -> DataFrame:
    """All sales of the four channels, one row per fact row, from fact tables or from clean tables."""
    nothing = F.lit(None).cast("string")
    at_store = (F.col("region"), F.col("province"), F.col("store_type"))
    undiscounted = (F.col("revenue"), F.col("revenue"), F.lit(0.0))

    def at_stores(sales: DataFrame, name: str) -> DataFrame:
        rows = _described(
            sales, dims, lambda rows: with_store(rows, merged(dims.store), "region", "province", "store_type")
        )
        return _channel(rows, name, at_store, undiscounted)

    channels = [
        _channel(
            _described(sellin, dims, lambda rows: with_distributor(rows, dims.distributor, "region", "province")),
            fixed.SELL_IN,
            (F.col("region"), F.col("province"), nothing),
            (F.col("net_sales"), F.col("gross_sales"), F.col("discount")),
        ),
        at_stores(sellout, fixed.SELL_OUT_GT),
        at_stores(pos_sales, fixed.POS_MT),
        _channel(
            _described(ecommerce, dims),
            fixed.ECOMMERCE,
            (nothing, nothing, F.lit(fixed.STORE_TYPE_ONLINE)),
            undiscounted,
        ),
    ]
    return reduce(DataFrame.unionByName, channels)


REVENUE_PARTS = ("revenue_high", "revenue_low", "revenue_rest")


def revenue_of(over: Callable[[Column], Column] = lambda part: part) -> Column:
    """The revenue of rows of ``daily_totals``, or of what ``over`` (a sum, say) makes of its parts."""
    return sum_of_parts(*(over(F.col(name)) for name in REVENUE_PARTS))


def daily_totals(sales: DataFrame, dims: Dimensions, products: DataFrame, *attributes: str) -> DataFrame:
    """Per day and product: total_qty and the parts of the revenue (``revenue_of``), with attributes of ``products``.

    Sales are summed per day and product before they meet the product table. Most of that sum happens before
    the shuffle, and a best-seller has afterwards one row per day instead of a large share of all rows, so the
    join cannot be skewed by it. The second sum merges versions of a product that agree in ``attributes``; on natural
    keys it reuses the partitioning of the join.
    """
    day = "date_key" if "date_key" in sales.columns else "date"
    product = "product_key" if "product_key" in sales.columns else "product_id"
    parts = amount_parts("revenue", "revenue")
    daily = sales.groupBy(product, day).agg(
        F.sum("qty").alias("total_qty"), *(F.sum(part).alias(name) for name, part in parts.items())
    )
    daily = with_product(daily, products, "product_id", *attributes)
    daily = with_date(daily, dims.date, *(("date",) if day == "date_key" else ()))
    return daily.groupBy("product_id", "date", *attributes).agg(
        *(F.sum(name).alias(name) for name in ("total_qty", *REVENUE_PARTS))
    )
