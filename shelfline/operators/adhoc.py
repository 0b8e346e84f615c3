"""Documented ad-hoc queries on the views, and the row counts of a build."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from .views import ascending


def adhoc_si_vs_so_limit(v_si_vs_so: DataFrame, rows: int = fixed.SAMPLE_ROWS) -> DataFrame:
    """The first rows in the order of the group columns, so that the result is determined."""
    return v_si_vs_so.orderBy(ascending("year", "month", "brand", "region")).limit(rows)


def adhoc_cohort_like(v_innovation_cohort: DataFrame, part_of_name: str) -> DataFrame:
    return v_innovation_cohort.filter(F.col("sku_name").contains(part_of_name)).orderBy(
        ascending("month_since_launch", "sku_name", "brand", "launch_date")
    )


def adhoc_promo_ranked(v_promotion_effectiveness: DataFrame) -> DataFrame:
    return v_promotion_effectiveness.orderBy(
        F.col("avg_uplift_pct").desc_nulls_last(), *ascending("promotion_type", "brand", "category")
    )


def adhoc_regional_year(v_regional_performance: DataFrame, year: int) -> DataFrame:
    return v_regional_performance.filter(F.col("year") == year)


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
