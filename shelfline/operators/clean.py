"""Declarative cleaning of the thirteen source tables.

Order within a row: name normalisation, date casts, key check, numeric casts, row filter; then removal of full
duplicates. A junk date in a key column therefore drops its row, while a junk number stays as NULL unless the
filter refers to it. All but the last step are narrow, and copies collapse in the map-side half of the
aggregation, so a value repeated in a large share of the rows puts no extra load on its reducer.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lenient_date, lenient_double, lenient_int


@dataclass(frozen=True)
class CleanSpec:
    """Rules for one source table. ``keep`` gives the row filter; a NULL result drops the row."""

    keys: tuple[str, ...]
    dates: tuple[str, ...] = ()
    ints: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    keep: Callable[[], Column] | None = None


def _sold_something() -> Column:
    return F.col("qty") > 0


def _range_in_order() -> Column:
    return F.col("start_date") <= F.col("end_date")


CLEAN_SPECS: dict[str, CleanSpec] = {
    "product_master": CleanSpec(keys=("product_id", "sku_code"), dates=("launch_date",), ints=("innovation_flag",)),
    "distributor_master": CleanSpec(keys=("distributor_id",)),
    "sellin": CleanSpec(
        keys=("date", "distributor_id", "product_id"),
        dates=("date",),
        ints=("qty",),
        doubles=("gross_sales", "discount", "net_sales"),
        keep=_sold_something,
    ),
    "retailer_master": CleanSpec(keys=("retailer_id", "distributor_id")),
    "sellout": CleanSpec(
        keys=("date", "retailer_id", "product_id"),
        dates=("date",),
        ints=("qty",),
        doubles=("revenue",),
        keep=_sold_something,
    ),
    "store_master": CleanSpec(keys=("store_id",)),
    "pos_sales": CleanSpec(
        keys=("date", "store_id", "product_id"),
        dates=("date",),
        ints=("qty",),
        doubles=("revenue",),
        keep=_sold_something,
    ),
    "inventory": CleanSpec(keys=("date", "product_id"), dates=("date",), ints=("stock_on_hand",)),
    "promotions": CleanSpec(
        keys=("promotion_id", "product_id"),
        dates=("start_date", "end_date"),
        doubles=("discount_percent",),
        keep=_range_in_order,
    ),
    "innovation_master": CleanSpec(keys=("innovation_id", "product_id"), dates=("launch_date",)),
    "store_visits": CleanSpec(keys=("date", "retailer_id", "sales_rep_id"), dates=("date",)),
    "ecommerce_orders": CleanSpec(
        keys=("date", "platform", "product_id"),
        dates=("date",),
        ints=("qty",),
        doubles=("revenue",),
        keep=_sold_something,
    ),
    "market_share": CleanSpec(keys=("year", "brand"), ints=("year",), doubles=("market_share",)),
}


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case the column names, strip them and put ``_`` for blanks."""
    names = [name.lower().strip().replace(" ", "_") for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns with the same normalised name: {repeated}")
    return df.toDF(*names)


def clean_table(df: DataFrame, spec: CleanSpec) -> DataFrame:
    df = normalize_columns(df)
    df = df.withColumns({name: lenient_date(F.col(name)) for name in spec.dates}) if spec.dates else df
    # One condition per column: unlike dropna(), these reach the scan where a key is taken as it is.
    df = df.filter(reduce(and_, (F.col(name).isNotNull() for name in spec.keys)))
    numbers = {name: lenient_int(F.col(name)) for name in spec.ints}
    numbers |= {name: lenient_double(F.col(name)) for name in spec.doubles}
    df = df.withColumns(numbers) if numbers else df
    df = df.filter(spec.keep()) if spec.keep else df
    return df.dropDuplicates()


def _cleaner(table: str) -> Callable[[DataFrame], DataFrame]:
    def clean(df: DataFrame) -> DataFrame:
        return clean_table(df, CLEAN_SPECS[table])

    clean.__name__ = f"clean_{table}"
    clean.__doc__ = f"Clean the raw rows of {table}."
    return clean


clean_product_master = _cleaner("product_master")
clean_distributor_master = _cleaner("distributor_master")
clean_sellin = _cleaner("sellin")
clean_retailer_master = _cleaner("retailer_master")
clean_sellout = _cleaner("sellout")
clean_store_master = _cleaner("store_master")
clean_pos_sales = _cleaner("pos_sales")
clean_inventory = _cleaner("inventory")
clean_promotions = _cleaner("promotions")
clean_innovation_master = _cleaner("innovation_master")
clean_store_visits = _cleaner("store_visits")
clean_ecommerce_orders = _cleaner("ecommerce_orders")
clean_market_share = _cleaner("market_share")
