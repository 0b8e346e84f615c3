"""Dimensions of the star schema: the calendar, and four tables with a dense surrogate key.

``*_rows`` give a dimension without its surrogate key. Reports that only need attributes join those on the
natural key, which saves numbering the table.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key, season_of
from ..functions import fixed_values as fixed
from .keys import dense_key


@dataclass(frozen=True)
class CalendarBounds:
    """First and last day of the calendar, both included. Sales outside it are left out of all facts."""

    start: date = fixed.CALENDAR_START
    end: date = fixed.CALENDAR_END


@dataclass(frozen=True)
class Dimensions:
    """The dimensions an operator needs, with or without surrogate keys. The calendar always has its date_key."""

    date: DataFrame
    product: DataFrame | None = None
    distributor: DataFrame | None = None
    store: DataFrame | None = None
    promotion: DataFrame | None = None


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        date_key(day).alias("date_key"),
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        season_of(day).alias("season"),
    )


_EVERY_DAY = "explode(sequence(_first, _last, INTERVAL 1 DAY)) AS date"


def dim_date(spark: SparkSession, bounds: CalendarBounds = CalendarBounds()) -> DataFrame:
    ends = spark.range(1).select(F.lit(bounds.start).alias("_first"), F.lit(bounds.end).alias("_last"))
    return _calendar(ends.selectExpr(_EVERY_DAY))


def dim_date_of(sales: DataFrame, day: str) -> DataFrame:
    """The calendar of the whole years that the column ``day`` spans; no rows where it has no date."""
    ends = sales.agg(
        F.trunc(F.min(day), "year").alias("_first"),
        F.date_sub(F.add_months(F.trunc(F.max(day), "year"), 12), 1).alias("_last"),
    )
    return _calendar(ends.selectExpr(_EVERY_DAY))


def product_rows(product_master: DataFrame) -> DataFrame:
    return product_master.select(
        "product_id",
        "sku_code",
        "sku_name",
        "brand",
        "category",
        "sub_category",
        "pack_size",
        "launch_date",
        "innovation_flag",
    )


def dim_product(product_master: DataFrame) -> DataFrame:
    return dense_key(product_rows(product_master), ["product_id"], "product_key")


def distributor_rows(distributor_master: DataFrame) -> DataFrame:
    return distributor_master.select("distributor_id", "name", "region", "province")


def dim_distributor(distributor_master: DataFrame) -> DataFrame:
    return dense_key(distributor_rows(distributor_master), ["distributor_id"], "distributor_key")


def _modern_trade(store_master: DataFrame) -> DataFrame:
    return store_master.select(
        "store_id",
        "store_name",
        F.lit(fixed.STORE_TYPE_MODERN).alias("store_type"),
        "chain",
        "region",
        "province",
        F.lit(None).cast("string").alias("distributor_id"),
    )


def _general_trade(retailer_master: DataFrame) -> DataFrame:
    return retailer_master.select(
        F.col("retailer_id").alias("store_id"),
        F.col("name").alias("store_name"),
        "store_type",
        F.lit(None).cast("string").alias("chain"),
        "region",
        "province",
        "distributor_id",
    )


def store_rows(store_master: DataFrame, retailer_master: DataFrame) -> DataFrame:
    return _modern_trade(store_master).unionByName(_general_trade(retailer_master))


def dim_store(store_master: DataFrame, retailer_master: DataFrame) -> DataFrame:
    """Stores first, retailers after them: one numbering in the order (block, id) continues by itself."""
    modern = _modern_trade(store_master).withColumn("_block", F.lit(0))
    general = _general_trade(retailer_master).withColumn("_block", F.lit(1))
    return dense_key(modern.unionByName(general), ["_block", "store_id"], "store_key").drop("_block")


def promotion_rows(promotions: DataFrame) -> DataFrame:
    return promotions.select(
        "promotion_id", "product_id", "promotion_type", "discount_percent", "start_date", "end_date"
    )


def dim_promotion(promotions: DataFrame) -> DataFrame:
    return dense_key(promotion_rows(promotions), ["promotion_id"], "promotion_key")
