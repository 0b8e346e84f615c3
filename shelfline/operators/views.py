"""Reporting views on the marts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, exact_sum
from ..functions import fixed_values as fixed
from ..functions.exact import amount_parts, sum_of_parts
from .star import merged, with_product


def ascending(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def revenue_in(channel: str) -> Column:
    """Revenue of one channel, 0 where it has none."""
    return exact_sum(F.when(F.col("channel") == channel, F.col("revenue")).otherwise(0.0))


def v_monthly_sales(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.groupBy("year", "month", "channel", "brand", "category", "region")
        .agg(F.sum("qty").alias("total_qty"), exact_sum("revenue").alias("total_revenue"))
        .orderBy(ascending("year", "month"))
    )


def v_si_vs_so(sales_mart: DataFrame) -> DataFrame:
    """Sell-in beside the three ways of selling out. Online sales have no region and form a group of their own."""
    return sales_mart.groupBy("year", "month", "brand", "region").agg(
        revenue_in(fixed.SELL_IN).alias("sellin_revenue"),
        revenue_in(fixed.SELL_OUT_GT).alias("sellout_gt_revenue"),
        revenue_in(fixed.POS_MT).alias("pos_revenue"),
        revenue_in(fixed.ECOMMERCE).alias("ecom_revenue"),
    )


def cohort_parts(innovation_mart: DataFrame, *more: str) -> DataFrame:
    """What ``cohorts_of`` sums up, by the view's groups and ``more`` columns."""
    return innovation_mart.groupBy("brand", "sku_name", "launch_date", "month_since_launch", *more).agg(
        F.sum("qty").alias("total_qty"), *_sums_of("revenue", "revenue"), *_sums_of("adoption_rate_pct", "adoption"), F.count("adoption_rate_pct").alias("adoption_n")
    )


def cohorts_of(parts: DataFrame) -> DataFrame:
    return (
        parts.groupBy("brand", "sku_name", "launch_date", "month_since_launch")
        .agg(
            F.sum("total_qty").alias("total_qty"),
            _sum_of("revenue").alias("total_revenue"),
            F.try_divide(_sum_of("adoption"), F.sum("adoption_n")).alias("avg_adoption_rate"),
        )
        .orderBy(ascending("brand", "sku_name", "month_since_launch"))
    )


def v_innovation_cohort(innovation_mart: DataFrame) -> DataFrame:
    return (
        innovation_mart.groupBy("brand", "sku_name", "launch_date", "month_since_launch")
        .agg(
            F.sum("qty").alias("total_qty"),
            exact_sum("revenue").alias("total_revenue"),
            exact_avg("adoption_rate_pct").alias("avg_adoption_rate"),
        )
        .orderBy(ascending("brand", "sku_name", "month_since_launch"))
    )


def _sums_of(col: Column | str, prefix: str) -> list[Column]:
    return [F.sum(part).alias(name) for name, part in amount_parts(col, prefix).items()]


def _sum_of(prefix: str) -> Column:
    return sum_of_parts(*(F.sum(f"{prefix}_{part}") for part in ("high", "low", "rest")))


def promotion_parts(promotion_mart: DataFrame, *more: str) -> DataFrame:
    """What ``promotion_effectiveness_of`` sums up, by promotion, its type, product and ``more`` columns."""
    on_promotion, off_promotion = F.col("on_promotion") == 1, F.col("on_promotion") == 0
    return promotion_mart.groupBy("product_id", "promotion_id", "promotion_type", *more).agg(
        *_sums_of("discount_percent", "discount"),
        F.count("discount_percent").alias("discount_n"),
        *_sums_of(F.when(on_promotion, F.col("revenue")).otherwise(0.0), "promo"),
        *_sums_of(F.when(off_promotion, F.col("revenue")).otherwise(0.0), "non_promo"),
        *_sums_of(F.when(on_promotion, F.col("uplift_pct")), "uplift"),
        F.count(F.when(on_promotion, F.col("uplift_pct"))).alias("uplift_n"),
    )


def promotion_effectiveness_of(parts: DataFrame, dim_product: DataFrame) -> DataFrame:
    return (
        with_product(parts, merged(dim_product), "brand", "category")
        .groupBy("promotion_type", "brand", "category")
        .agg(
            F.countDistinct("promotion_id").alias("num_promotions"),
            F.try_divide(_sum_of("discount"), F.sum("discount_n")).alias("avg_discount"),
            _sum_of("promo").alias("promo_revenue"),
            _sum_of("non_promo").alias("non_promo_revenue"),
            F.try_divide(_sum_of("uplift"), F.sum("uplift_n")).alias("avg_uplift_pct"),
        )
    )


def v_promotion_effectiveness(promotion_mart: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Days are summed up by product and promotion, which lie together in the mart, before they meet the products."""
    return promotion_effectiveness_of(promotion_parts(promotion_mart), dim_product)


SKETCH_BITS = 12


def regional_sketches(sales_mart: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """By year, quarter and region a sketch of the products sold, of some ``2**bits`` bytes, which can be merged."""
    known = sales_mart.filter(F.col("region").isNotNull())
    return known.groupBy("year", "quarter", "region").agg(F.hll_sketch_agg("product_name", F.lit(bits)).alias("skus"))


def approx_active_skus(sketches: DataFrame, *by: str) -> DataFrame:
    """About how many products were sold, by any of the sketches' columns, or in all. Two standard errors are 3 % with
    12 bits. An opt-in: counts of products are exact in the views."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("skus")).alias("approx_active_skus"))


def v_regional_performance(sales_mart: DataFrame) -> DataFrame:
    return (
        sales_mart.filter(F.col("region").isNotNull())
        .groupBy("year", "quarter", "region", "channel")
        .agg(
            F.sum("qty").alias("total_qty"),
            exact_sum("revenue").alias("total_revenue"),
            F.countDistinct("product_name").alias("active_skus"),
        )
    )
