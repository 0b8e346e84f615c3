"""Sales of newly launched products by month since launch."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import month_boundaries, portable_round
from .dims import Dimensions
from .sales import daily_totals, revenue_of
from .star import of_products

_PRODUCT = ("brand", "category", "sub_category", "launch_date", "sku_name")


def _daily(pos_sales: DataFrame, sellout: DataFrame, dims: Dimensions) -> DataFrame:
    """Launched products are few, so sales of others go before they are summed, not with the join afterwards."""
    launched = dims.product.filter(F.col("innovation_flag") == 1)

    def channel(sales: DataFrame, name: str) -> DataFrame:
        return daily_totals(of_products(sales, launched), dims, launched, *_PRODUCT).withColumn("channel", F.lit(name))

    return channel(pos_sales, fixed.INNOVATION_POS).unionByName(channel(sellout, fixed.INNOVATION_GT))


def innovation_daily(pos_sales: DataFrame, sellout: DataFrame, dims: Dimensions) -> DataFrame:
    """Daily sales of the products flagged as innovation, in modern trade (POS) and general trade (GT)."""
    return _daily(pos_sales, sellout, dims).select(
        "date",
        "product_id",
        *_PRODUCT,
        F.col("total_qty").alias("qty"),
        revenue_of().alias("revenue"),
        "channel",
    )


def innovation_mart(pos_sales: DataFrame, sellout: DataFrame, dims: Dimensions) -> DataFrame:
    """Sales since launch with running revenue and the share of the best day.

    The running revenue includes sales before the launch month, which are dropped afterwards; the best day is
    taken among the rows that remain. A window holds one product and channel by day, at most the length of the
    calendar.
    """
    series = W.partitionBy("product_id", "channel")
    so_far = series.orderBy("date", *_PRODUCT).rowsBetween(W.unboundedPreceding, W.currentRow)
    revenue = revenue_of()
    return (
        _daily(pos_sales, sellout, dims)
        .withColumn("month_since_launch", month_boundaries(F.col("launch_date"), F.col("date")))
        .withColumn("cumulative_revenue", revenue_of(lambda part: F.sum(part).over(so_far)))
        .filter(F.col("month_since_launch") >= 0)
        .withColumn("_best", F.max(revenue).over(series))
        .select(
            "date",
            "product_id",
            "brand",
            "category",
            "sub_category",
            "sku_name",
            "launch_date",
            "channel",
            "month_since_launch",
            F.col("total_qty").alias("qty"),
            revenue.alias("revenue"),
            "cumulative_revenue",
            portable_round(revenue / F.nullif(F.col("_best"), F.lit(0.0)) * 100).alias("adoption_rate_pct"),
        )
    )
