"""Dashboard queries. Where a report is sorted or cut off, ties are broken by the group columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, exact_sum
from ..functions import fixed_values as fixed
from .dims import Dimensions
from .star import with_date, with_product
from .views import ascending, revenue_in

# Sales


def card_monthly_revenue_by_channel(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.groupBy("year", "month", "channel")
        .agg(exact_sum("revenue").alias("total_revenue"))
        .orderBy(ascending("year", "month", "channel"))
    )


def card_si_vs_so_summary(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.groupBy("year", "month", "brand")
        .agg(
            revenue_in(fixed.SELL_IN).alias("sellin"),
            revenue_in(fixed.SELL_OUT_GT).alias("sellout_gt"),
            revenue_in(fixed.POS_MT).alias("pos_mt"),
        )
        .orderBy(ascending("year", "month", "brand"))
    )


def card_sales_by_region(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.filter(F.col("region").isNotNull())
        .groupBy("year", "quarter", "region")
        .agg(exact_sum("revenue").alias("revenue"))
        .orderBy(ascending("year", "quarter", "region"))
    )


def card_top_brands(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.groupBy("brand")
        .agg(exact_sum("revenue").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc_nulls_last(), *ascending("brand"))
    )


def card_ecommerce_by_platform(ecommerce: DataFrame, dims: Dimensions) -> DataFrame:
    """From the fact table or the clean table of online orders; the sales mart does not keep the platform."""
    return (
        with_product(with_date(ecommerce, dims.date, "year", "month"), dims.product)
        .groupBy("year", "month", "platform")
        .agg(exact_sum("revenue").alias("revenue"))
        .orderBy(ascending("year", "month", "platform"))
    )


# Promotions


def card_promo_uplift_by_type(promotion_mart: DataFrame) -> DataFrame:
    """A type without promoted (or without other) days has NULL revenue there, not 0."""
    return promotion_mart.groupBy("promotion_type").agg(
        exact_avg("uplift_pct").alias("avg_uplift_pct"),
        exact_sum(F.when(F.col("on_promotion") == 1, F.col("revenue"))).alias("promo_revenue"),
        exact_sum(F.when(F.col("on_promotion") == 0, F.col("revenue"))).alias("baseline_revenue"),
    )


def card_promo_vs_nonpromo(promotion_mart: DataFrame) -> DataFrame:
    status = F.when(F.col("on_promotion") == 1, fixed.ON_PROMOTION_STATUS).otherwise(fixed.NO_PROMOTION_TYPE)
    return promotion_mart.groupBy(status.alias("status")).agg(exact_sum("revenue").alias("revenue"))


def card_top_promoted_products(promotion_mart: DataFrame, rows: int = fixed.TOP_PRODUCTS) -> DataFrame:
    """promo_days counts rows: a day under two promotions of one type counts twice."""
    return (
        promotion_mart.filter(F.col("on_promotion") == 1)
        .groupBy("product_id", "promotion_type")
        .agg(
            F.count("*").alias("promo_days"),
            exact_avg("uplift_pct").alias("avg_uplift"),
            exact_sum("revenue").alias("total_promo_revenue"),
        )
        .orderBy(F.col("avg_uplift").desc_nulls_last(), *ascending("product_id", "promotion_type"))
        .limit(rows)
    )


# Launches


def card_adoption_curve(innovation_mart: DataFrame) -> DataFrame:
    return (
        innovation_mart.groupBy("sku_name", "month_since_launch")
        .agg(exact_avg("adoption_rate_pct").alias("avg_adoption_rate"), exact_sum("revenue").alias("revenue"))
        .orderBy(ascending("sku_name", "month_since_launch"))
    )


def card_innovation_by_brand(innovation_mart: DataFrame) -> DataFrame:
    return (
        innovation_mart.groupBy("brand", "month_since_launch")
        .agg(exact_sum("revenue").alias("revenue"))
        .orderBy(ascending("brand", "month_since_launch"))
    )


def card_cohort_revenue(innovation_mart: DataFrame) -> DataFrame:
    """Best day of the first, third, sixth and twelfth month after launch."""
    month = F.col("month_since_launch")
    return (
        innovation_mart.groupBy("sku_name", "launch_date", "channel")
        .agg(*(F.max(F.when(month == m, F.col("revenue"))).alias(f"month_{m}") for m in fixed.COHORT_MONTHS))
        .orderBy(ascending("launch_date", "sku_name", "channel"))
    )
