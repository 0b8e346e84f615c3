"""Stored reports, which are brought up to date by computing the changed years of their mart alone.

A report is kept by year, as what its view sums up: exact parts of amounts, counts, the promotions themselves, sketches.
Reading it sums these up over the years, so it has the rows of the view on the whole mart, and reads far fewer.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import views
from ..sources.lake import read_table, write_table

FOLDER = "reports"
_MARK = "_mark"


@dataclass(frozen=True)
class Report:
    """``parts`` of a mart, by year; ``result`` of the parts of all years, and of the warehouse's other tables.
    ``columns`` are those of the mart that the parts are made of."""

    mart: str
    columns: tuple[str, ...]
    parts: Callable[[DataFrame], DataFrame]
    result: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame]


REPORTS = {
    "v_monthly_sales": Report(
        "sales_mart",
        ("year", "month", "channel", "brand", "category", "region", "qty", "revenue"),
        views.v_monthly_sales,
        lambda parts, _: parts.orderBy(views.ascending("year", "month")),
    ),
    "v_si_vs_so": Report("sales_mart", ("year", "month", "brand", "region", "channel", "revenue"), views.v_si_vs_so, lambda parts, _: parts),
    "v_regional_performance": Report(
        "sales_mart",
        ("year", "quarter", "region", "channel", "qty", "revenue", "product_name"),
        views.v_regional_performance,
        lambda parts, _: parts,
    ),
    "v_innovation_cohort": Report(
        "innovation_mart",
        ("year", "brand", "sku_name", "launch_date", "month_since_launch", "qty", "revenue", "adoption_rate_pct"),
        lambda mart: views.cohort_parts(mart, "year"),
        lambda parts, _: views.cohorts_of(parts),
    ),
    "v_promotion_effectiveness": Report(
        "promotion_mart",
        ("year", "product_id", "promotion_id", "promotion_type", "discount_percent", "on_promotion", "revenue", "uplift_pct"),
        lambda mart: views.promotion_parts(mart, "year"),
        lambda parts, table: views.promotion_effectiveness_of(parts, table("dim_product")),
    ),
    "active_sku_sketches": Report(
        "sales_mart", ("year", "quarter", "region", "product_name"), views.regional_sketches, lambda parts, _: parts
    ),
}


def _marks(mart: DataFrame, columns: tuple[str, ...]) -> dict[int | None, str]:
    """Of every year a mark that its rows, in any order, have: their number and the sum of their hashes."""
    hashes = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    rows = mart.groupBy("year").agg(F.concat_ws(" ", F.count("*").cast("string"), hashes.cast("string")).alias("mark")).collect()
    return {row.year: row.mark for row in rows}


def refresh(spark: SparkSession, base: str, name: str) -> list[int | None]:
    """Bring the stored report up to date with its mart; the years that were computed, none if nothing has changed.

    The mart is read for the marks of its years, with the report's columns alone, and then in the years whose mark is
    not that of the stored report, which is kept with the report's own rows. Years that the mart no longer has go.
    """
    report = REPORTS[name]
    path = f"{base}/{FOLDER}"
    mart = read_table(spark, base, report.mart).select(*report.columns)
    now = _marks(mart, report.columns)
    try:
        stored = read_table(spark, path, name)
        before = {row.year: row[_MARK] for row in stored.select("year", _MARK).distinct().collect()}
    except FileNotFoundError:
        stored, before = None, {}
    changed = [year for year, mark in now.items() if before.get(year) != mark]
    if stored is not None and not changed and set(before) <= set(now):
        return []
    mark = F.lit(None).cast("string")
    for year in changed:
        mark = F.when(F.col("year").eqNullSafe(F.lit(year)), F.lit(now[year])).otherwise(mark)
    parts = report.parts(mart.filter(_in(changed))).withColumn(_MARK, mark)
    kept = [year for year in now if year not in changed]
    if kept:
        parts = parts.unionByName(stored.filter(_in(kept)).select(*parts.columns))
    write_table(parts, f"{path}/{name}", partition_by=["year"])
    return sorted(changed, key=lambda year: (year is None, year))


def _in(years: list[int | None]):
    known = F.col("year").isin([year for year in years if year is not None])
    return known | F.col("year").isNull() if None in years else known


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The report as it was last brought up to date: the rows and columns of its view."""
    report = REPORTS[name]
    parts = read_table(spark, f"{base}/{FOLDER}", name).drop(_MARK)
    # The partition column comes last from the files.
    parts = parts.select(*(["year"] if name in _BY_YEAR else []), *(c for c in parts.columns if c != "year" or name not in _BY_YEAR))
    return report.result(parts, lambda table: read_table(spark, base, table))


#: Reports that have the year in front.
_BY_YEAR = ("v_monthly_sales", "v_si_vs_so", "v_regional_performance", "active_sku_sketches")
