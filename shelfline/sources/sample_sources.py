"""The thirteen source tables, derived from the sample tables (region, nation, customer, part, orders, ...).

``typed`` gives a source as it is after cleaning. ``dirty`` gives it as raw text: all columns are strings with
noisy names, and a fixed share of the rows (chosen by ``_k``, a number computed from the row's own key) is NULL,
junk, negative, fractional or repeated.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import (
    Dimensions,
    dim_date_of,
    dim_distributor,
    dim_product,
    dim_promotion,
    dim_store,
    distributor_rows,
    product_rows,
    promotion_rows,
    store_rows,
)
from ..operators.star import merged

# Columns used of the sample tables. With the schema given, reading one needs no look into its files.
_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
}

# Customer segments by the channel that they stand for.
_GENERAL_TRADE = "('FURNITURE', 'HOUSEHOLD')"
_MODERN_TRADE = "('AUTOMOBILE', 'BUILDING')"
_ONLINE = "('MACHINERY')"

# Price and discount in hundredths, rounded as DECIMAL(18,2) rounds.
_PRICE = "floor(l_extendedprice * 100 + 0.5D)"
_OFF = "floor(l_discount * 100 + 0.5D)"
_LINE = "l_orderkey * 7 + l_linenumber AS _k"


class SampleSources:
    """Source tables read from the sample tables in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def calendar(self) -> DataFrame:
        """The whole years in which anything was sold."""
        return dim_date_of(self.table("lineitem"), "l_shipdate")

    def typed(self, source: str) -> DataFrame:
        return getattr(self, f"_{source}")().drop("_k")

    def dirty(self, source: str) -> DataFrame:
        return _soiled(getattr(self, f"_{source}")(), _DEFECTS[source])

    def dimensions(self, *names: str) -> Dimensions:
        """The calendar and the named dimensions, with surrogate keys."""
        builders = {
            "product": lambda: dim_product(self.typed("product_master")),
            "distributor": lambda: dim_distributor(self.typed("distributor_master")),
            "store": lambda: dim_store(self.typed("store_master"), self.typed("retailer_master")),
            "promotion": lambda: dim_promotion(self.typed("promotions")),
        }
        return self._dimensions(builders, names)

    def natural_dimensions(self, *names: str) -> Dimensions:
        """The calendar and the named dimensions, without surrogate keys."""
        builders = {
            "product": lambda: product_rows(self.typed("product_master")),
            "distributor": lambda: distributor_rows(self.typed("distributor_master")),
            "store": lambda: store_rows(self.typed("store_master"), self.typed("retailer_master")),
            "promotion": lambda: promotion_rows(self.typed("promotions")),
        }
        return self._dimensions(builders, names)

    def _dimensions(self, builders, names) -> Dimensions:
        return Dimensions(date=self.calendar(), **{name: builders[name]() for name in names})

    # Master data

    def _with_place(self, table: str, nation_key: str) -> DataFrame:
        """Rows of ``table`` with region and province of their nation.

        The 25 nations, a fixed number, are looked up in a map. After a join Spark would take the result to be
        far larger than ``table``, and broadcast the sales instead of this side.
        """
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        nations = self.table("nation").join(region, "n_regionkey")
        places = nations.selectExpr(
            "map_from_entries(collect_list(struct(n_nationkey, struct(r_name AS region, n_name AS province))))"
        ).scalar()
        placed = self.table(table).withColumn("_place", F.try_element_at(places, F.col(nation_key)))
        return placed.filter("_place IS NOT NULL").select("*", "_place.*")

    def _product_master(self) -> DataFrame:
        return self.table("part").selectExpr(
            "concat('PRD', p_partkey) AS product_id",
            "concat('SKU', p_partkey) AS sku_code",
            "concat(p_name, ' ', p_partkey) AS sku_name",
            "p_brand AS brand",
            "p_type AS category",
            "split_part(p_name, ' ', 2) AS sub_category",
            "concat(p_size, 'ml') AS pack_size",
            "date_add(DATE '1995-07-01', CAST(p_partkey % 900 AS INT)) AS launch_date",
            "CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS innovation_flag",
            "p_partkey AS _k",
        )

    def _distributor_master(self) -> DataFrame:
        return self._with_place("supplier", "s_nationkey").selectExpr(
            "concat('DIST', s_suppkey) AS distributor_id",
            "s_name AS name",
            "region",
            "province",
            "s_suppkey AS _k",
        )

    def _retailer_master(self) -> DataFrame:
        customers = self._with_place("customer", "c_nationkey")
        return customers.filter(f"c_mktsegment IN {_GENERAL_TRADE}").selectExpr(
            "concat('RET', c_custkey) AS retailer_id",
            "c_name AS name",
            "concat('DIST', c_custkey % 10) AS distributor_id",
            "c_mktsegment AS store_type",
            "region",
            "province",
            "c_custkey AS _k",
        )

    def _store_master(self) -> DataFrame:
        customers = self._with_place("customer", "c_nationkey")
        return customers.filter(f"c_mktsegment IN {_MODERN_TRADE}").selectExpr(
            "concat('STR', c_custkey) AS store_id",
            "c_name AS store_name",
            "c_mktsegment AS chain",
            "region",
            "province",
            "c_custkey AS _k",
        )

    def _promotions(self) -> DataFrame:
        """Three per product; those of a product divisible by 5 overlap."""
        shift = "(p_partkey * 37 + i * CASE WHEN p_partkey % 5 = 0 THEN 10 ELSE 811 END) % 2400"
        return (
            self.table("part")
            .selectExpr("p_partkey", "explode(array(0, 1, 2)) AS i")
            .selectExpr("*", f"date_add(DATE '1995-01-01', CAST({shift} AS INT)) AS start_date")
            .selectExpr(
                "concat('PROMO', lpad(p_partkey * 3 + i, 9, '0')) AS promotion_id",
                "concat('PRD', p_partkey) AS product_id",
                "start_date",
                "date_add(start_date, CAST(30 + p_partkey % 61 AS INT)) AS end_date",
                "CASE (p_partkey + i) % 3 WHEN 0 THEN 'discount' WHEN 1 THEN 'bundle' ELSE 'display' END"
                " AS promotion_type",
                "CAST(5 + (p_partkey * 7 + i) % 26 AS DOUBLE) AS discount_percent",
                "p_partkey * 3 + i AS _k",
            )
        )

    def _innovation_master(self) -> DataFrame:
        return self._product_master().filter("innovation_flag = 1").selectExpr(
            "concat('INN', _k) AS innovation_id",
            "product_id",
            "launch_date",
            "concat('Campaign_', brand, '_', sub_category) AS campaign_name",
            "_k",
        )

    # Sales

    def _bought_by(self, segments: str) -> DataFrame:
        """Order lines of some customer segments.

        Orders are narrowed to the segments first. The lines are then shuffled by the same key and with the
        same columns whatever the segments, so a plan with several channels shuffles them once. Customers and orders
        are merged, for keys are few compressed bytes: Spark would send hundreds of thousands through the driver.
        """
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS o_orderkey",
            "CAST(l_shipdate AS DATE) AS date",
            "concat('PRD', l_partkey) AS product_id",
            "CAST(l_quantity AS INT) AS qty",
            f"{_PRICE} / 100 AS revenue",
            _LINE,
        )
        customers = self.table("customer").filter(f"c_mktsegment IN {segments}")
        orders = self.table("orders").withColumnRenamed("o_custkey", "c_custkey")
        bought = orders.join(merged(customers), "c_custkey", "left_semi")
        return lines.join(merged(bought).select("o_orderkey", "c_custkey", "o_orderpriority"), "o_orderkey")

    def _sellin(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "CAST(l_shipdate AS DATE) AS date",
            "concat('DIST', l_suppkey) AS distributor_id",
            "concat('PRD', l_partkey) AS product_id",
            "CAST(l_quantity AS INT) AS qty",
            f"{_PRICE} / 100 AS gross_sales",
            f"{_PRICE} * {_OFF} / 10000 AS discount",
            f"{_PRICE} * (100 - {_OFF}) / 10000 AS net_sales",
            _LINE,
        )

    def _sellout(self) -> DataFrame:
        return self._bought_by(_GENERAL_TRADE).selectExpr(
            "date",
            "concat('RET', c_custkey) AS retailer_id",
            "concat('DIST', c_custkey % 10) AS distributor_id",
            "product_id",
            "qty",
            "revenue",
            "_k",
        )

    def _pos_sales(self) -> DataFrame:
        return self._bought_by(_MODERN_TRADE).selectExpr(
            "date", "concat('STR', c_custkey) AS store_id", "product_id", "qty", "revenue", "_k"
        )

    def _ecommerce_orders(self) -> DataFrame:
        return self._bought_by(_ONLINE).selectExpr(
            "date", "o_orderpriority AS platform", "product_id", "qty", "revenue", "_k"
        )

    def _inventory(self) -> DataFrame:
        weeks = self.table("lineitem").selectExpr("trunc(CAST(l_shipdate AS DATE), 'week') AS date", "l_partkey")
        return weeks.distinct().selectExpr(
            "date",
            "concat('PRD', l_partkey) AS product_id",
            "CAST((l_partkey * 13 + day(date)) % 1000 AS INT) AS stock_on_hand",
            "l_partkey * 31 + datediff(date, DATE '1995-01-01') AS _k",
        )

    # Other sources

    def _store_visits(self) -> DataFrame:
        return self.table("events").selectExpr(
            "CAST(ts AS DATE) AS date",
            "concat('RET', user_id) AS retailer_id",
            "concat('REP', user_id % 50) AS sales_rep_id",
            "event_type AS visit_type",
            "event_id AS _k",
        )

    def _market_share(self) -> DataFrame:
        """Share of each brand in the year's sales, both rounded to whole units.

        Lines are summed per year and product before they meet the products; the window has one row per brand.
        """
        lines = self.table("lineitem").selectExpr(
            "l_orderkey AS o_orderkey", "l_partkey AS p_partkey", f"{_PRICE} AS price"
        )
        orders = self.table("orders").selectExpr("o_orderkey", "year(o_orderdate) AS year")
        brands = self.table("part").selectExpr("p_partkey", "p_brand AS brand")
        return (
            lines.join(orders, "o_orderkey")
            .groupBy("year", "p_partkey")
            .agg({"price": "sum"})
            .join(brands, "p_partkey")
            .groupBy("year", "brand")
            .agg({"sum(price)": "sum"})
            .selectExpr("year", "brand", "floor(`sum(sum(price))` / 100 + 0.5D) AS sold")
            .selectExpr(
                "year",
                "brand",
                "sold / sum(sold) OVER (PARTITION BY year) AS market_share",
                "year * 25 + CAST(split_part(brand, '#', 2) AS INT) AS _k",
            )
        )


# Defects of the raw text: what stands in place of the text of a column.
_BAD_DATE = "CASE WHEN _k % 89 = 0 THEN 'bad-date' WHEN _k % 71 = 0 THEN NULL ELSE {text} END"
_MISSING = "CASE WHEN _k % 97 = 0 THEN NULL ELSE {text} END"
_BAD_QUANTITY = (
    "CASE WHEN _k % 83 = 0 THEN 'abc' WHEN _k % 79 = 0 THEN concat('-', {text})"
    " WHEN _k % 73 = 0 THEN concat({text}, '.7') ELSE {text} END"
)
_JUNK_NUMBER = "CASE WHEN _k % 83 = 0 THEN 'abc' ELSE {text} END"
_BAD_END = "CASE WHEN _k % 61 = 0 THEN 'bad-date' WHEN _k % 59 = 0 THEN '1990-01-01' ELSE {text} END"
_BAD_YEAR = "CASE WHEN _k % 13 = 0 THEN 'n/a' ELSE {text} END"
_MISSING_BRAND = "CASE WHEN _k % 17 = 0 THEN NULL ELSE {text} END"

_DEFECTS = {
    "product_master": {"launch_date": _BAD_DATE, "sku_code": _MISSING, "innovation_flag": _BAD_QUANTITY},
    "distributor_master": {"distributor_id": _MISSING},
    "sellin": {"date": _BAD_DATE, "distributor_id": _MISSING, "qty": _BAD_QUANTITY},
    "retailer_master": {"distributor_id": _MISSING},
    "sellout": {"date": _BAD_DATE, "retailer_id": _MISSING, "qty": _BAD_QUANTITY},
    "store_master": {"store_id": _MISSING},
    "pos_sales": {"date": _BAD_DATE, "store_id": _MISSING, "qty": _BAD_QUANTITY},
    "inventory": {"date": _BAD_DATE, "product_id": _MISSING, "stock_on_hand": _BAD_QUANTITY},
    "promotions": {
        "start_date": _BAD_DATE,
        "end_date": _BAD_END,
        "product_id": _MISSING,
        "discount_percent": _JUNK_NUMBER,
    },
    "innovation_master": {"launch_date": _BAD_DATE, "product_id": _MISSING},
    "store_visits": {"date": _BAD_DATE, "retailer_id": _MISSING},
    "ecommerce_orders": {"date": _BAD_DATE, "platform": _MISSING, "qty": _BAD_QUANTITY},
    "market_share": {"year": _BAD_YEAR, "brand": _MISSING_BRAND, "market_share": _JUNK_NUMBER},
}


def _soiled(rows: DataFrame, defects: dict[str, str]) -> DataFrame:
    names = [name for name in rows.columns if name != "_k"]
    texts = [defects.get(name, "{text}").format(text=f"CAST({name} AS STRING)") for name in names]
    copies = "explode(CASE WHEN _k % 50 = 0 THEN array(1, 2) ELSE array(1) END) AS _copy"
    soiled = rows.selectExpr(*(f"{text} AS {name}" for name, text in zip(names, texts)), copies)
    return soiled.drop("_copy").toDF(*(f" {name.replace('_', ' ').title()} " for name in names))
