"""Expected-demand factors: closed-form curves of the calendar day and the launch day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .scalars import month_boundaries


def season_factor(day: Column) -> Column:
    factor = F.lit(fixed.SEASON_FACTOR_OTHERWISE)
    for value, months in fixed.SEASON_FACTORS.items():
        factor = F.when(F.month(day).isin(*months), value).otherwise(factor)
    return factor


def growth_factor(day: Column, base_year: int | Column) -> Column:
    return F.lit(1.0) + F.lit(fixed.YEARLY_GROWTH) * (F.year(day) - base_year)


def adoption_factor(day: Column, launch: Column) -> Column:
    """Share of the launch's full demand; NULL where the day or the launch is unknown (``least`` skips NULL)."""
    months = month_boundaries(launch, day)
    ramp = F.least(F.lit(1.0), F.lit(fixed.ADOPTION_START) + F.lit(fixed.ADOPTION_STEP) * months)
    return F.when(months < 0, 0.0).when(months.isNotNull(), ramp)


def demand_columns(rows: DataFrame, day: str, launch: str, base_year: int | Column) -> DataFrame:
    """Add season_factor, growth_factor, adoption_factor and their product, demand_index."""
    return rows.select(
        "*",
        season_factor(F.col(day)).alias("season_factor"),
        growth_factor(F.col(day), base_year).alias("growth_factor"),
        adoption_factor(F.col(day), F.col(launch)).alias("adoption_factor"),
    ).withColumn("demand_index", F.col("season_factor") * F.col("growth_factor") * F.col("adoption_factor"))
