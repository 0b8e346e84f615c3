"""Columns of the thirteen source tables, by source system. In the raw layer every column is a string.

These names are fixed values: the files of the source systems carry them.
"""

RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "erp/product_master": (
        "product_id", "sku_code", "sku_name", "brand", "category", "sub_category", "pack_size", "launch_date",
        "innovation_flag",
    ),
    "erp/distributor_master": ("distributor_id", "name", "region", "province"),
    "erp/sellin": ("date", "distributor_id", "product_id", "qty", "gross_sales", "discount", "net_sales"),
    "dms/retailer_master": ("retailer_id", "name", "distributor_id", "store_type", "region", "province"),
    "dms/sellout": ("date", "retailer_id", "distributor_id", "product_id", "qty", "revenue"),
    "pos/store_master": ("store_id", "store_name", "chain", "region", "province"),
    "pos/pos_sales": ("date", "store_id", "product_id", "qty", "revenue"),
    "supply_chain/inventory": ("date", "product_id", "stock_on_hand"),
    "marketing/promotions": (
        "promotion_id", "product_id", "start_date", "end_date", "promotion_type", "discount_percent",
    ),
    "innovation/innovation_master": ("innovation_id", "product_id", "launch_date", "campaign_name"),
    "sfa/store_visits": ("date", "retailer_id", "sales_rep_id", "visit_type"),
    "ecommerce/ecommerce_orders": ("date", "platform", "product_id", "qty", "revenue"),
    "external/market_share": ("year", "brand", "market_share"),
}

# Folder of each table: "sellin" is kept under "erp/sellin".
FOLDERS: dict[str, str] = {path.split("/")[1]: path for path in RAW_COLUMNS}

_TYPES = {
    "int": ("innovation_flag", "qty", "stock_on_hand", "year"),
    "double": ("gross_sales", "discount", "net_sales", "revenue", "discount_percent", "market_share"),
    "date": ("date", "launch_date", "start_date", "end_date"),
}

# Types of the columns of each clean table; what is no number and no date is a string.
CLEAN_TYPES: dict[str, dict[str, str]] = {
    table: {name: next((kind for kind, names in _TYPES.items() if name in names), "string") for name in RAW_COLUMNS[path]}
    for table, path in FOLDERS.items()
}

# Columns of tables whose partition column does not stand last. Parquet puts it there.
COLUMN_ORDER: dict[str, tuple[str, ...]] = {
    "sales_mart": (
        "date", "year", "quarter", "month", "season", "channel", "brand", "category", "sub_category", "product_name",
        "pack_size", "region", "province", "store_type", "qty", "revenue", "gross_sales", "discount",
    ),
}

# Order of the rows of tables that have one.
ROW_ORDER: dict[str, tuple[str, ...]] = {"innovation_mart": ("product_id", "channel", "date")}

# Order of the rows within a file: what reports choose by.
FILE_ORDER: dict[str, tuple[str, ...]] = {
    "fact_sellin": ("date_key", "product_key"),
    "fact_sellout": ("date_key", "product_key"),
    "fact_pos_sales": ("date_key", "product_key"),
    "fact_ecommerce_sales": ("date_key", "product_key"),
    "fact_inventory": ("date_key", "product_key"),
    "sales_mart": ("date", "product_name"),
    "promotion_mart": ("date", "product_id"),
    "innovation_mart": ("date", "product_id"),
}
