"""The daily batch: raw CSV, clean tables, star schema, marts. Every stage replaces its tables.

    python -m shelfline.plans.batch RAW CLEAN WAREHOUSE [--start 2023-01-01 --end 2025-12-31]

The stages can also be called one by one. Each returns the number of rows it wrote per table.
"""

import argparse
import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.scalars import year_of
from ..operators import cards, dims, facts, innovation, promotion, sales, views
from ..operators.clean import CLEAN_SPECS, clean_table
from ..sources.lake import Buckets, read_clean, read_ordered, read_raw, read_table, split_raw, write_table
from ..sources.schemas import FILE_ORDER, FOLDERS
from ..sources.staging import own_staging

FACTS = {
    "fact_sellin": ("sellin", facts.fact_sellin),
    "fact_sellout": ("sellout", facts.fact_sellout),
    "fact_pos_sales": ("pos_sales", facts.fact_pos_sales),
    "fact_ecommerce_sales": ("ecommerce_orders", facts.fact_ecommerce_sales),
    "fact_inventory": ("inventory", facts.fact_inventory),
}
SALES = ("sellin", "sellout", "pos_sales", "ecommerce_orders")
DIMENSIONS = ("dim_date", "dim_product", "dim_distributor", "dim_store", "dim_promotion")
MARTS = ("sales_mart", "promotion_mart", "innovation_mart")
CARDS = {
    "sales_mart": (
        cards.card_monthly_revenue_by_channel,
        cards.card_si_vs_so_summary,
        cards.card_sales_by_region,
        cards.card_top_brands,
    ),
    "promotion_mart": (
        cards.card_promo_uplift_by_type,
        cards.card_promo_vs_nonpromo,
        cards.card_top_promoted_products,
    ),
    "innovation_mart": (cards.card_adoption_curve, cards.card_innovation_by_brand, cards.card_cohort_revenue),
}


def build_clean(
    spark: SparkSession,
    raw_base: str,
    clean_base: str,
    product_buckets: int | None = None,
    rejected_base: str | None = None,
    tables: Sequence[str] = tuple(CLEAN_SPECS),
) -> dict[str, int]:
    """With ``product_buckets``, the sales of the four channels lie in so many buckets by product, and the joins of
    facts and marts to a product table too large to be broadcast move none of them.

    With ``rejected_base``, malformed lines are not cleaned as far as they can be read, but kept there, by table, with
    the reason; their number is returned as that of ``rejected <table>``.
    """
    buckets = Buckets("product_id", product_buckets) if product_buckets else None
    rows = {}
    for table in tables:
        if rejected_base:
            raw = split_raw(spark, raw_base, table)
            rows[f"rejected {table}"] = write_table(raw.rejected, f"{rejected_base}/{FOLDERS[table]}")
            lines = raw.rows
        else:
            lines = read_raw(spark, raw_base, table)
        cleaned = clean_table(lines, CLEAN_SPECS[table])
        rows[table] = write_table(cleaned, f"{clean_base}/{FOLDERS[table]}", buckets=buckets if table in SALES else None)
    return rows


def read_dimensions(spark: SparkSession, base: str) -> dims.Dimensions:
    return dims.Dimensions(*(read_table(spark, base, name) for name in DIMENSIONS))


def build_warehouse(
    spark: SparkSession, clean_base: str, base: str, bounds: dims.CalendarBounds = dims.CalendarBounds()
) -> dict[str, int]:
    def clean(table: str) -> DataFrame:
        return read_clean(spark, clean_base, table)

    with own_staging(spark, base):
        dimensions = {
            "dim_date": dims.dim_date(spark, bounds),
            "dim_product": dims.dim_product(clean("product_master")),
            "dim_distributor": dims.dim_distributor(clean("distributor_master")),
            "dim_store": dims.dim_store(clean("store_master"), clean("retailer_master")),
            "dim_promotion": dims.dim_promotion(clean("promotions")),
        }
        rows = {name: write_table(df, f"{base}/{name}") for name, df in dimensions.items()}
    written = read_dimensions(spark, base)
    for name, (source, build) in FACTS.items():
        fact = build(clean(source), written).withColumn("year", year_of(F.col("date_key")))
        rows[name] = write_table(fact, f"{base}/{name}", partition_by=["year"], sort_by=FILE_ORDER[name])
    return rows


def build_marts(spark: SparkSession, clean_base: str, base: str) -> dict[str, int]:
    """The sales mart from clean tables, since facts would be joined to the same dimensions a second time.

    The other two marts show no store, but leave out sales at stores that are unknown, as the facts do; so they start
    from the facts, whose daily sums meet few dimensions. Reports choose or group by year, so the marts are kept by
    year, and a report on one year reads only that one.
    """
    sellin, sellout, pos, ecommerce = (
        read_clean(spark, clean_base, name) for name in SALES
    )
    fact_pos, fact_sellout = (read_table(spark, base, name) for name in ("fact_pos_sales", "fact_sellout"))
    d = read_dimensions(spark, base)
    with own_staging(spark, base):
        marts = {
            "sales_mart": sales.sales_mart(sellin, sellout, pos, ecommerce, d),
            "promotion_mart": promotion.promotion_mart(fact_pos, d).withColumn("year", F.year("date")),
            "innovation_mart": innovation.innovation_mart(fact_pos, fact_sellout, d).withColumn("year", F.year("date")),
        }
        return {name: write_table(df, f"{base}/{name}", partition_by=["year"], sort_by=FILE_ORDER[name]) for name, df in marts.items()}


def register_views(spark: SparkSession, base: str) -> None:
    """Make all tables, the five reporting views and the eleven cards known to ``spark.sql``.

    Views are computed when queried. They belong to the session, and any session that can read ``base`` can have
    them: nothing but the tables is needed.
    """
    for name in (*DIMENSIONS, *FACTS, *MARTS):
        read_ordered(spark, base, name).createOrReplaceTempView(name)
    d = read_dimensions(spark, base)
    sales_mart, promotion_mart, innovation_mart = (spark.table(name) for name in MARTS)
    reports = {
        "v_monthly_sales": views.v_monthly_sales(sales_mart),
        "v_si_vs_so": views.v_si_vs_so(sales_mart),
        "v_innovation_cohort": views.v_innovation_cohort(innovation_mart),
        "v_promotion_effectiveness": views.v_promotion_effectiveness(promotion_mart, spark.table("dim_product")),
        "v_regional_performance": views.v_regional_performance(sales_mart),
        "card_ecommerce_by_platform": cards.card_ecommerce_by_platform(spark.table("fact_ecommerce_sales"), d),
        **{card.__name__: card(spark.table(mart)) for mart, of_mart in CARDS.items() for card in of_mart},
    }
    for name, df in reports.items():
        df.createOrReplaceTempView(name)


def main() -> None:
    parser = argparse.ArgumentParser(description="Build the clean layer, the star schema and the marts.")
    parser.add_argument("raw")
    parser.add_argument("clean")
    parser.add_argument("warehouse")
    parser.add_argument("--start", type=date.fromisoformat, default=fixed.CALENDAR_START)
    parser.add_argument("--product-buckets", type=int)
    parser.add_argument("--rejected")
    parser.add_argument("--end", type=date.fromisoformat, default=fixed.CALENDAR_END)
    args = parser.parse_args()
    spark = SparkSession.builder.appName("shelfline-batch").getOrCreate()
    rows = build_clean(spark, args.raw, args.clean, args.product_buckets, args.rejected)
    rows |= build_warehouse(spark, args.clean, args.warehouse, dims.CalendarBounds(args.start, args.end))
    rows |= build_marts(spark, args.clean, args.warehouse)
    print(json.dumps(rows, indent=1))


if __name__ == "__main__":
    main()
