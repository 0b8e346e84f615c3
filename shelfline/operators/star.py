"""Inner joins from sales rows to the dimensions.

Rows are joined on the surrogate key where they have one (fact tables) and on the natural key otherwise (clean
tables), so the marts can be built from either. A row without match drops out, and a natural key that occurs
several times in a dimension repeats the row.

Only the calendar is broadcast by hint: it has one row per day of its bounds, however large the sales are. All
other dimensions grow with the business, so the strategy is left to Spark: it broadcasts a side whose size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where AQE splits the partitions
of products or stores that hold much of the rows (``spark.sql.adaptive.skewJoin.enabled``, on by default).

Spark takes the size from the compressed files and knows of no rows that ``explode`` adds, and what it broadcasts
passes through the driver whole. So where many attributes are taken, sides are ``merged``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column of tables that lie in buckets by product, and how many numbers it has; see ``sources.lake.Buckets``.
SPREAD, SPREADS = "_spread", 8


def merged(side: DataFrame) -> DataFrame:
    """``side``, and what is selected from it, is never broadcast in a join."""
    return side.hint("merge")


def with_date(rows: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    """``rows`` with attributes of their day. An equally named column, as the year of a stored fact, is replaced."""
    key = "date_key" if "date_key" in rows.columns else "date"
    rows = rows.drop(*(name for name in attributes if name != key))
    return rows.join(F.broadcast(dim_date.select(key, *attributes)), key)


def _with(rows: DataFrame, dim: DataFrame, surrogate: str, row_id: str, dim_id: str, attributes) -> DataFrame:
    if surrogate in rows.columns:
        side, key = dim.select(surrogate, *attributes), surrogate
    else:
        side, key = dim.select(F.col(dim_id).alias(row_id), *(a for a in attributes if a != row_id)), row_id
    return rows.join(side, key)


def with_product(rows: DataFrame, dim_product: DataFrame, *attributes: str) -> DataFrame:
    """``rows`` that lie in buckets by product stay where they are: each product is repeated for every spread."""
    if SPREAD in rows.columns and "product_key" not in rows.columns:
        side = dim_product.select("product_id", *(a for a in attributes if a != "product_id"))
        side = side.withColumn(SPREAD, F.explode(F.sequence(F.lit(0), F.lit(SPREADS - 1))))
        return rows.join(side, ["product_id", SPREAD]).drop(SPREAD)
    return _with(rows, dim_product, "product_key", "product_id", "product_id", attributes)


def of_products(rows: DataFrame, products: DataFrame) -> DataFrame:
    """The ``rows`` of ``products``, each once, where it is left to Spark whether the keys are broadcast."""
    if "product_key" in rows.columns:
        return rows.join(products.select("product_key"), "product_key", "left_semi")
    return rows.join(products.select("product_id"), "product_id", "left_semi")


def with_distributor(rows: DataFrame, dim_distributor: DataFrame, *attributes: str) -> DataFrame:
    return _with(rows, dim_distributor, "distributor_key", "distributor_id", "distributor_id", attributes)


def with_store(rows: DataFrame, dim_store: DataFrame, *attributes: str) -> DataFrame:
    """``rows`` name the store store_id or retailer_id."""
    row_id = "retailer_id" if "retailer_id" in rows.columns else "store_id"
    return _with(rows, dim_store, "store_key", row_id, "store_id", attributes)
