"""Promotion days and the promotion mart: sales on and off promotion against a trailing baseline."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import portable_round
from ..sources.staging import stage
from .dims import Dimensions
from .sales import daily_totals, revenue_of
from .star import merged, with_date

_PROMOTION = ("promotion_id", "promotion_type", "discount_percent")


def _clipped(promotions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Add _first and _last, the promotion's range within the calendar; drop promotions without a day in it.

    This keeps an open end such as the year 9999 from being listed, and a range that is empty (or reversed)
    from being counted backwards by ``sequence``.
    """
    opens = dim_date.agg(F.min("date")).scalar()
    closes = dim_date.agg(F.max("date")).scalar()
    known = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    return (
        promotions.filter(known)
        .withColumn("_first", F.greatest("start_date", opens))
        .withColumn("_last", F.least("end_date", closes))
        .filter(F.col("_first") <= F.col("_last"))
    )


def promo_calendar(promotions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per promotion and calendar day on which it is active.

    A range join with the calendar would compare every promotion with every day; listing the days of the
    promotion needs no join. The promotions are spread over all tasks before: their file is small and read by one
    or two, the days are some sixty times as many.
    """
    days = F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))
    columns = ("product_id", *_PROMOTION, "_first", "_last")
    spread = _clipped(promotions, dim_date).select(*columns).repartition(*columns)
    return spread.select("product_id", *_PROMOTION, F.explode(days).alias("date"))


def _promoted_days(daily: DataFrame, dims: Dimensions) -> DataFrame:
    """The rows of ``daily`` once per promotion active on the day, with the promotion as a struct.

    The range join is an equi join on product and month: a promotion is repeated for each month it touches,
    and only the days of that month are compared with it. That shuffles a few rows per promotion instead of
    one per active day, and never compares all days of a product with all its promotions. Spark does not see the
    months in the size of the promotions, and would broadcast millions of rows.
    """
    months = F.sequence(F.trunc("_first", "month"), F.trunc("_last", "month"), F.expr("INTERVAL 1 MONTH"))
    by_month = (
        _clipped(dims.promotion, dims.date)
        .select("product_id", *_PROMOTION, "start_date", "end_date", F.explode(months).alias("_month"))
        .withColumns({"year": F.year("_month"), "month": F.month("_month")})
    )
    # Year and month come from the calendar. Computed from the date, they would add a filter below the daily
    # sums, which then differ from the sums of the other branch and would not be shared with it.
    days = with_date(daily, dims.date, "year", "month")
    return (
        merged(by_month).join(days, ["product_id", "year", "month"])
        .filter(F.col("date").between(F.col("start_date"), F.col("end_date")))
        .select(*daily.columns, F.struct(*_PROMOTION, "start_date", "end_date").alias("_promotion"))
    )


def promotion_mart(pos_sales: DataFrame, dims: Dimensions, frame: int = fixed.BASELINE_ROWS) -> DataFrame:
    """Daily product sales, once per active promotion of the day, with baseline and uplift.

    The baseline is the mean revenue of the ``frame`` rows (not days) of the product before this one, in the order of
    the date and, within a day, of the promotion; a day with k promotions counts as k rows, also where some of
    them are alike in all that is shown.

    A window over all rows of a product would have to sort them in one task, however many promotions overlap.
    All rows of a day have the same revenue, so a frame of 30 rows never sees more than the first 30 rows of a
    day, and a row behind those has only rows of its own day in its frame. So the window runs over at most 30
    rows per day, found by a limit per group that is applied before the shuffle as well, and the other rows
    get their baseline directly.

    The rows are needed for both and are written once, so that the sales are read only once. Each gets a
    number before it is written, which tells promotions apart that are alike.
    """
    daily = daily_totals(pos_sales, dims, merged(dims.product), "brand", "category")
    promoted = _promoted_days(daily, dims)
    unpromoted = daily.withColumn("_promotion", F.lit(None).cast(promoted.schema["_promotion"].dataType))
    numbered = unpromoted.unionByName(promoted).withColumn("_number", F.monotonically_increasing_id())
    rows = stage(numbered, "promotion_mart")

    # The row without promotion comes last in its day and only counts when it is the only one.
    in_day = W.partitionBy("product_id", "date", "brand", "category").orderBy(F.col("_promotion").asc_nulls_last(), "_number")
    placed = rows.withColumn("_place", F.row_number().over(in_day))
    first = placed.filter(
        (F.col("_place") <= frame) & (F.col("_promotion").isNotNull() | (F.col("_place") == 1))
    )
    before = (
        W.partitionBy("product_id").orderBy("date", "brand", "category", "_place").rowsBetween(-frame, -1)
    )
    baseline = F.try_divide(revenue_of(lambda part: F.sum(part).over(before)), F.count("revenue_low").over(before))

    full_days = first.filter(F.col("_place") == frame).select(
        *(F.col(name).alias(f"_full_{name}") for name in ("product_id", "date", "brand", "category")),
        F.struct("_promotion", "_number").alias("_last_placed"),
    )
    # A version of a product may have no brand, and is a version all the same. Day and product are never null under a
    # promotion; compared like the others, they add no filter that would set these rows apart from those of ``first``.
    same = [F.col(name).eqNullSafe(F.col(f"_full_{name}")) for name in ("product_id", "date", "brand", "category")]
    behind = rows.join(merged(full_days), reduce(and_, same)).filter(
        F.col("_promotion").isNotNull() & (F.struct("_promotion", "_number") > F.col("_last_placed"))
    )
    own_day = revenue_of(lambda part: part * frame) / frame

    on_promotion = F.col("_promotion").isNotNull()
    revenue = revenue_of()
    gain = portable_round((revenue - F.col("_baseline")) / F.col("_baseline") * 100)
    with_baseline = first.withColumn("_baseline", baseline).drop("_place")
    with_baseline = with_baseline.unionByName(behind.withColumn("_baseline", own_day).select(with_baseline.columns))
    return with_baseline.select(
        "date",
        "product_id",
        "brand",
        "category",
        F.coalesce("_promotion.promotion_id", F.lit(fixed.NO_PROMOTION_ID)).alias("promotion_id"),
        F.coalesce("_promotion.promotion_type", F.lit(fixed.NO_PROMOTION_TYPE)).alias("promotion_type"),
        F.coalesce("_promotion.discount_percent", F.lit(0.0)).alias("discount_percent"),
        F.when(on_promotion, 1).otherwise(0).alias("on_promotion"),
        F.col("total_qty").alias("qty"),
        revenue.alias("revenue"),
        F.col("_baseline").alias("baseline_revenue_30d"),
        F.when(on_promotion & (F.col("_baseline") > 0), gain).otherwise(0.0).alias("uplift_pct"),
    )
