"""SQL for every registered query, to be run by another engine on the same sample tables.

Written apart from the DataFrame code, in the plainest form: the range join is a BETWEEN, surrogate keys are a
global row_number(), the marts go through fact tables and surrogate keys, every window runs over all its rows.
"""

import re

# Named parts, each a SELECT over sample tables and other parts.
_PARTS: dict[str, str] = {}

# ---------------------------------------------------------------------------------------------------------
# Source tables

_PARTS["places"] = """
    SELECT n_nationkey, r_name AS region, n_name AS province
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""
_PARTS["k_product_master"] = """
    SELECT 'PRD' || p_partkey AS product_id, 'SKU' || p_partkey AS sku_code, p_name || ' ' || p_partkey AS sku_name,
           p_brand AS brand, p_type AS category, split_part(p_name, ' ', 2) AS sub_category,
           p_size || 'ml' AS pack_size, DATE '1995-07-01' + CAST(p_partkey % 900 AS INTEGER) AS launch_date,
           CAST(CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS innovation_flag, p_partkey AS k
    FROM part
"""
_PARTS["k_distributor_master"] = """
    SELECT 'DIST' || s_suppkey AS distributor_id, s_name AS name, region, province, s_suppkey AS k
    FROM supplier JOIN places ON s_nationkey = n_nationkey
"""
_PARTS["k_retailer_master"] = """
    SELECT 'RET' || c_custkey AS retailer_id, c_name AS name, 'DIST' || (c_custkey % 10) AS distributor_id,
           c_mktsegment AS store_type, region, province, c_custkey AS k
    FROM customer JOIN places ON c_nationkey = n_nationkey
    WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')
"""
_PARTS["k_store_master"] = """
    SELECT 'STR' || c_custkey AS store_id, c_name AS store_name, c_mktsegment AS chain, region, province,
           c_custkey AS k
    FROM customer JOIN places ON c_nationkey = n_nationkey
    WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
"""
_PARTS["k_promotions"] = """
    SELECT 'PROMO' || lpad(CAST(p_partkey * 3 + i AS VARCHAR), 9, '0') AS promotion_id,
           'PRD' || p_partkey AS product_id,
           DATE '1995-01-01' + shift AS start_date,
           DATE '1995-01-01' + shift + 30 + CAST(p_partkey % 61 AS INTEGER) AS end_date,
           CASE (p_partkey + i) % 3 WHEN 0 THEN 'discount' WHEN 1 THEN 'bundle' ELSE 'display' END AS promotion_type,
           CAST(5 + (p_partkey * 7 + i) % 26 AS DOUBLE) AS discount_percent,
           p_partkey * 3 + i AS k
    FROM (SELECT p_partkey, i,
                 CAST((p_partkey * 37 + i * (CASE WHEN p_partkey % 5 = 0 THEN 10 ELSE 811 END)) % 2400 AS INTEGER)
                     AS shift
          FROM part, (VALUES (0), (1), (2)) AS three(i)) AS shifted
"""
_PARTS["k_innovation_master"] = """
    SELECT 'INN' || k AS innovation_id, product_id, launch_date,
           'Campaign_' || brand || '_' || sub_category AS campaign_name, k
    FROM k_product_master WHERE innovation_flag = 1
"""
_PARTS["bought"] = """
    SELECT CAST(l_shipdate AS DATE) AS date, c_custkey, c_mktsegment, o_orderpriority,
           'PRD' || l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS qty,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS revenue, l_orderkey * 7 + l_linenumber AS k
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
"""
_PARTS["k_sellin"] = """
    SELECT CAST(l_shipdate AS DATE) AS date, 'DIST' || l_suppkey AS distributor_id, 'PRD' || l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS qty, CAST(price AS DOUBLE) AS gross_sales,
           CAST(price * off AS DOUBLE) AS discount, CAST(price * (1 - off) AS DOUBLE) AS net_sales,
           l_orderkey * 7 + l_linenumber AS k
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(4,2)) AS off
          FROM lineitem) AS priced
"""
_PARTS["k_sellout"] = """
    SELECT date, 'RET' || c_custkey AS retailer_id, 'DIST' || (c_custkey % 10) AS distributor_id, product_id, qty,
           revenue, k
    FROM bought WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')
"""
_PARTS["k_pos_sales"] = """
    SELECT date, 'STR' || c_custkey AS store_id, product_id, qty, revenue, k
    FROM bought WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
"""
_PARTS["k_ecommerce_orders"] = """
    SELECT date, o_orderpriority AS platform, product_id, qty, revenue, k
    FROM bought WHERE c_mktsegment = 'MACHINERY'
"""
_PARTS["k_inventory"] = """
    SELECT week AS date, 'PRD' || l_partkey AS product_id,
           CAST((l_partkey * 13 + day(week)) % 1000 AS INTEGER) AS stock_on_hand,
           l_partkey * 31 + (week - DATE '1995-01-01') AS k
    FROM (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS week, l_partkey FROM lineitem) AS weeks
"""
_PARTS["k_store_visits"] = """
    SELECT CAST(ts AS DATE) AS date, 'RET' || user_id AS retailer_id, 'REP' || (user_id % 50) AS sales_rep_id,
           event_type AS visit_type, event_id AS k
    FROM events
"""
_PARTS["k_market_share"] = """
    SELECT year, brand, CAST(sold AS DOUBLE) / CAST(SUM(sold) OVER (PARTITION BY year) AS DOUBLE) AS market_share,
           year * 25 + CAST(split_part(brand, '#', 2) AS INTEGER) AS k
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, p_brand AS brand,
                 round(SUM(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS sold
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
          GROUP BY ALL) AS yearly
"""

# ---------------------------------------------------------------------------------------------------------
# Raw text with defects, and its cleaning. A column is (name, type) with the defect that it gets.

_BAD_DATE = "CASE WHEN k % 89 = 0 THEN 'bad-date' WHEN k % 71 = 0 THEN NULL ELSE {c} END"
_MISSING = "CASE WHEN k % 97 = 0 THEN NULL ELSE {c} END"
_BAD_QUANTITY = (
    "CASE WHEN k % 83 = 0 THEN 'abc' WHEN k % 79 = 0 THEN '-' || {c} WHEN k % 73 = 0 THEN {c} || '.7' ELSE {c} END"
)
_JUNK_NUMBER = "CASE WHEN k % 83 = 0 THEN 'abc' ELSE {c} END"
_BAD_END = "CASE WHEN k % 61 = 0 THEN 'bad-date' WHEN k % 59 = 0 THEN '1990-01-01' ELSE {c} END"
_BAD_YEAR = "CASE WHEN k % 13 = 0 THEN 'n/a' ELSE {c} END"
_MISSING_BRAND = "CASE WHEN k % 17 = 0 THEN NULL ELSE {c} END"

_TEXT, _DATE, _INT, _DOUBLE = (
    "{c}",
    "TRY_CAST({c} AS DATE)",
    "CAST(TRUNC(TRY_CAST({c} AS DOUBLE)) AS INTEGER)",
    "TRY_CAST({c} AS DOUBLE)",
)

# source -> columns as (name, cast, defect), and the condition on the cast row and its text (t_<name>)
_CLEAN: dict[str, tuple[list[tuple[str, str, str]], str]] = {
    "product_master": (
        [("product_id", _TEXT, "{c}"), ("sku_code", _TEXT, _MISSING), ("sku_name", _TEXT, "{c}"),
         ("brand", _TEXT, "{c}"), ("category", _TEXT, "{c}"), ("sub_category", _TEXT, "{c}"),
         ("pack_size", _TEXT, "{c}"), ("launch_date", _DATE, _BAD_DATE), ("innovation_flag", _INT, _BAD_QUANTITY)],
        "product_id IS NOT NULL AND sku_code IS NOT NULL",
    ),
    "distributor_master": (
        [("distributor_id", _TEXT, _MISSING), ("name", _TEXT, "{c}"), ("region", _TEXT, "{c}"),
         ("province", _TEXT, "{c}")],
        "distributor_id IS NOT NULL",
    ),
    "sellin": (
        [("date", _DATE, _BAD_DATE), ("distributor_id", _TEXT, _MISSING), ("product_id", _TEXT, "{c}"),
         ("qty", _INT, _BAD_QUANTITY), ("gross_sales", _DOUBLE, "{c}"), ("discount", _DOUBLE, "{c}"),
         ("net_sales", _DOUBLE, "{c}")],
        "date IS NOT NULL AND distributor_id IS NOT NULL AND product_id IS NOT NULL AND qty > 0",
    ),
    "retailer_master": (
        [("retailer_id", _TEXT, "{c}"), ("name", _TEXT, "{c}"), ("distributor_id", _TEXT, _MISSING),
         ("store_type", _TEXT, "{c}"), ("region", _TEXT, "{c}"), ("province", _TEXT, "{c}")],
        "retailer_id IS NOT NULL AND distributor_id IS NOT NULL",
    ),
    "sellout": (
        [("date", _DATE, _BAD_DATE), ("retailer_id", _TEXT, _MISSING), ("distributor_id", _TEXT, "{c}"),
         ("product_id", _TEXT, "{c}"), ("qty", _INT, _BAD_QUANTITY), ("revenue", _DOUBLE, "{c}")],
        "date IS NOT NULL AND retailer_id IS NOT NULL AND product_id IS NOT NULL AND qty > 0",
    ),
    "store_master": (
        [("store_id", _TEXT, _MISSING), ("store_name", _TEXT, "{c}"), ("chain", _TEXT, "{c}"),
         ("region", _TEXT, "{c}"), ("province", _TEXT, "{c}")],
        "store_id IS NOT NULL",
    ),
    "pos_sales": (
        [("date", _DATE, _BAD_DATE), ("store_id", _TEXT, _MISSING), ("product_id", _TEXT, "{c}"),
         ("qty", _INT, _BAD_QUANTITY), ("revenue", _DOUBLE, "{c}")],
        "date IS NOT NULL AND store_id IS NOT NULL AND product_id IS NOT NULL AND qty > 0",
    ),
    "inventory": (
        [("date", _DATE, _BAD_DATE), ("product_id", _TEXT, _MISSING), ("stock_on_hand", _INT, _BAD_QUANTITY)],
        "date IS NOT NULL AND product_id IS NOT NULL",
    ),
    "promotions": (
        [("promotion_id", _TEXT, "{c}"), ("product_id", _TEXT, _MISSING), ("start_date", _DATE, _BAD_DATE),
         ("end_date", _DATE, _BAD_END), ("promotion_type", _TEXT, "{c}"),
         ("discount_percent", _DOUBLE, _JUNK_NUMBER)],
        "promotion_id IS NOT NULL AND product_id IS NOT NULL AND start_date <= end_date",
    ),
    "innovation_master": (
        [("innovation_id", _TEXT, "{c}"), ("product_id", _TEXT, _MISSING), ("launch_date", _DATE, _BAD_DATE),
         ("campaign_name", _TEXT, "{c}")],
        "innovation_id IS NOT NULL AND product_id IS NOT NULL",
    ),
    "store_visits": (
        [("date", _DATE, _BAD_DATE), ("retailer_id", _TEXT, _MISSING), ("sales_rep_id", _TEXT, "{c}"),
         ("visit_type", _TEXT, "{c}")],
        "date IS NOT NULL AND retailer_id IS NOT NULL AND sales_rep_id IS NOT NULL",
    ),
    "ecommerce_orders": (
        [("date", _DATE, _BAD_DATE), ("platform", _TEXT, _MISSING), ("product_id", _TEXT, "{c}"),
         ("qty", _INT, _BAD_QUANTITY), ("revenue", _DOUBLE, "{c}")],
        "date IS NOT NULL AND platform IS NOT NULL AND product_id IS NOT NULL AND qty > 0",
    ),
    "market_share": (
        [("year", _INT, _BAD_YEAR), ("brand", _TEXT, _MISSING_BRAND), ("market_share", _DOUBLE, _JUNK_NUMBER)],
        "t_year IS NOT NULL AND brand IS NOT NULL",
    ),
}


def _clean_sql(source: str) -> str:
    columns, condition = _CLEAN[source]
    raw = ", ".join(defect.format(c=f"CAST({name} AS VARCHAR)") + f" AS t_{name}" for name, _, defect in columns)
    cast = ", ".join(kind.format(c=f"t_{name}") + f" AS {name}" for name, kind, _ in columns)
    names = ", ".join(name for name, _, _ in columns)
    soiled = f"SELECT {raw}, k FROM k_{source}"
    repeated = f"SELECT * FROM ({soiled}) AS a UNION ALL SELECT * FROM ({soiled}) AS b WHERE k % 50 = 0"
    return f"""
        SELECT DISTINCT {names}
        FROM (SELECT *, {cast} FROM ({repeated}) AS raw) AS typed
        WHERE {condition}
    """


# ---------------------------------------------------------------------------------------------------------
# Star schema

_PARTS["dim_date"] = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
           CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, CAST(week(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
           CAST(dayofweek(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
           CASE WHEN month(d) <= 2 THEN 'Tet Season' WHEN month(d) BETWEEN 5 AND 8 THEN 'Summer'
                WHEN month(d) >= 11 THEN 'Year-End' ELSE 'Regular' END AS season
    FROM (SELECT CAST(t AS DATE) AS d
          FROM (SELECT unnest(generate_series(make_date(year(min(l_shipdate)), 1, 1), make_date(year(max(l_shipdate)), 12, 31),
                                              INTERVAL 1 DAY)) AS t FROM lineitem) AS s) AS days
"""
_PARTS["dim_product"] = """
    SELECT CAST(row_number() OVER (ORDER BY product_id) AS BIGINT) AS product_key, * EXCLUDE (k) FROM k_product_master
"""
_PARTS["dim_distributor"] = """
    SELECT CAST(row_number() OVER (ORDER BY distributor_id) AS BIGINT) AS distributor_key, * EXCLUDE (k)
    FROM k_distributor_master
"""
_PARTS["dim_store"] = """
    SELECT CAST(row_number() OVER (ORDER BY store_id) AS BIGINT) AS store_key, store_id, store_name,
           'Modern Trade' AS store_type, chain, region, province, CAST(NULL AS VARCHAR) AS distributor_id
    FROM k_store_master
    UNION ALL
    SELECT CAST((SELECT count(*) FROM k_store_master) + row_number() OVER (ORDER BY retailer_id) AS BIGINT),
           retailer_id, name, store_type, NULL, region, province, distributor_id
    FROM k_retailer_master
"""
_PARTS["dim_promotion"] = """
    SELECT CAST(row_number() OVER (ORDER BY promotion_id) AS BIGINT) AS promotion_key, promotion_id, product_id,
           promotion_type, discount_percent, start_date, end_date
    FROM k_promotions
"""
_PARTS["fact_sellin"] = """
    SELECT date_key, product_key, distributor_key, qty, gross_sales, discount, net_sales
    FROM k_sellin JOIN dim_date USING (date) JOIN dim_product USING (product_id)
         JOIN dim_distributor USING (distributor_id)
"""
_PARTS["fact_sellout"] = """
    SELECT date_key, store_key, product_key, qty, revenue
    FROM k_sellout AS s JOIN dim_date USING (date) JOIN dim_product USING (product_id)
         JOIN dim_store ON dim_store.store_id = s.retailer_id
"""
_PARTS["fact_pos_sales"] = """
    SELECT date_key, store_key, product_key, qty, revenue
    FROM k_pos_sales JOIN dim_date USING (date) JOIN dim_product USING (product_id) JOIN dim_store USING (store_id)
"""
_PARTS["fact_ecommerce_sales"] = """
    SELECT date_key, platform, product_key, qty, revenue
    FROM k_ecommerce_orders JOIN dim_date USING (date) JOIN dim_product USING (product_id)
"""
_PARTS["fact_inventory"] = """
    SELECT date_key, product_key, stock_on_hand
    FROM k_inventory JOIN dim_date USING (date) JOIN dim_product USING (product_id)
"""

# ---------------------------------------------------------------------------------------------------------
# Marts

_MART_HEAD = "date, year, quarter, month, season"
_MART_PRODUCT = "brand, category, sub_category, sku_name AS product_name, pack_size"
_PARTS["sales_mart"] = f"""
    SELECT {_MART_HEAD}, 'Sell-In' AS channel, {_MART_PRODUCT}, region, province, CAST(NULL AS VARCHAR) AS store_type,
           qty, net_sales AS revenue, gross_sales, discount
    FROM fact_sellin JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
         JOIN dim_distributor USING (distributor_key)
    UNION ALL
    SELECT {_MART_HEAD}, channel, {_MART_PRODUCT}, region, province, store_type, qty, revenue, revenue,
           CAST(0 AS DOUBLE)
    FROM (SELECT 'Sell-Out GT' AS channel, * FROM fact_sellout
          UNION ALL SELECT 'POS Modern Trade', * FROM fact_pos_sales) AS at_store
         JOIN dim_date USING (date_key) JOIN dim_product USING (product_key) JOIN dim_store USING (store_key)
    UNION ALL
    SELECT {_MART_HEAD}, 'Ecommerce', {_MART_PRODUCT}, NULL, NULL, 'Online', qty, revenue, revenue, CAST(0 AS DOUBLE)
    FROM fact_ecommerce_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
"""
_PARTS["promo_calendar"] = """
    SELECT product_id, promotion_id, promotion_type, discount_percent, date
    FROM dim_promotion JOIN dim_date ON date BETWEEN start_date AND end_date
"""
_PARTS["daily_pos"] = """
    SELECT date, product_id, brand, category, CAST(SUM(qty) AS BIGINT) AS qty,
           SUM(CAST(revenue AS DECIMAL(18,4))) AS amount,
           SUM(revenue - CAST(CAST(revenue AS DECIMAL(18,4)) AS DOUBLE)) AS rest
    FROM fact_pos_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
    GROUP BY ALL
"""
_PARTS["with_baseline"] = """
    SELECT d.*, p.promotion_id, p.promotion_type, p.discount_percent, CAST(d.amount AS DOUBLE) + rest AS revenue,
           (CAST(SUM(d.amount) OVER before AS DOUBLE) + SUM(d.rest) OVER before) / COUNT(d.amount) OVER before AS baseline
    FROM daily_pos AS d LEFT JOIN promo_calendar AS p ON p.product_id = d.product_id AND p.date = d.date
    WINDOW before AS (PARTITION BY d.product_id ORDER BY d.date, p.promotion_id
                      ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
"""
_PARTS["promotion_mart"] = """
    SELECT date, product_id, brand, category, COALESCE(promotion_id, 'NONE') AS promotion_id,
           COALESCE(promotion_type, 'No Promotion') AS promotion_type,
           COALESCE(discount_percent, CAST(0 AS DOUBLE)) AS discount_percent,
           CAST(promotion_id IS NOT NULL AS INTEGER) AS on_promotion, qty, revenue, baseline AS baseline_revenue_30d,
           CASE WHEN promotion_id IS NOT NULL AND baseline > 0
                THEN round((revenue - baseline) / baseline * 100, 2) ELSE CAST(0 AS DOUBLE) END AS uplift_pct
    FROM with_baseline
"""
_PARTS["launched_sales"] = """
    SELECT date, product_id, brand, category, sub_category, launch_date, sku_name, CAST(SUM(qty) AS BIGINT) AS qty,
           SUM(CAST(revenue AS DECIMAL(18,4))) AS amount,
           SUM(revenue - CAST(CAST(revenue AS DECIMAL(18,4)) AS DOUBLE)) AS rest, channel
    FROM (SELECT 'POS' AS channel, * FROM fact_pos_sales UNION ALL SELECT 'GT', * FROM fact_sellout) AS f
         JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
    WHERE innovation_flag = 1
    GROUP BY ALL
"""
_PARTS["innovation_daily"] = """
    SELECT * EXCLUDE (amount, rest), CAST(amount AS DOUBLE) + rest AS revenue FROM launched_sales
"""
_PARTS["since_launch"] = """
    SELECT *, CAST(amount AS DOUBLE) + rest AS revenue,
           CAST(datediff('month', launch_date, date) AS INTEGER) AS month_since_launch,
           CAST(SUM(amount) OVER up_to_day AS DOUBLE) + SUM(rest) OVER up_to_day AS cumulative_revenue
    FROM launched_sales
    WINDOW up_to_day AS (PARTITION BY product_id, channel ORDER BY date ROWS UNBOUNDED PRECEDING)
"""
_PARTS["innovation_mart"] = """
    SELECT date, product_id, brand, category, sub_category, sku_name, launch_date, channel, month_since_launch, qty,
           revenue, cumulative_revenue,
           round(revenue / NULLIF(MAX(revenue) OVER (PARTITION BY product_id, channel), 0) * 100, 2)
               AS adoption_rate_pct
    FROM since_launch WHERE month_since_launch >= 0
"""


def _total(value: str) -> str:
    """Four decimals are summed exactly, what is finer as double: nothing is cut, and no order matters."""
    whole = f"CAST({value} AS DECIMAL(18,4))"
    return f"(CAST(SUM({whole}) AS DOUBLE) + SUM({value} - CAST({whole} AS DOUBLE)))"


def _mean(value: str) -> str:
    return f"{_total(value)} / NULLIF(COUNT({value}), 0)"


def _channel_total(channel: str) -> str:
    return _total(f"CASE WHEN channel = '{channel}' THEN revenue ELSE 0 END")


# ---------------------------------------------------------------------------------------------------------
# Views

_PARTS["v_monthly_sales"] = f"""
    SELECT year, month, channel, brand, category, region, CAST(SUM(qty) AS BIGINT) AS total_qty,
           {_total("revenue")} AS total_revenue
    FROM sales_mart GROUP BY ALL
"""
_PARTS["v_si_vs_so"] = f"""
    SELECT year, month, brand, region, {_channel_total("Sell-In")} AS sellin_revenue,
           {_channel_total("Sell-Out GT")} AS sellout_gt_revenue,
           {_channel_total("POS Modern Trade")} AS pos_revenue, {_channel_total("Ecommerce")} AS ecom_revenue
    FROM sales_mart GROUP BY ALL
"""
_PARTS["v_innovation_cohort"] = f"""
    SELECT brand, sku_name, launch_date, month_since_launch, CAST(SUM(qty) AS BIGINT) AS total_qty,
           {_total("revenue")} AS total_revenue, {_mean("adoption_rate_pct")} AS avg_adoption_rate
    FROM innovation_mart GROUP BY ALL
"""
_PARTS["v_promotion_effectiveness"] = f"""
    SELECT promotion_type, p.brand AS brand, p.category AS category,
           COUNT(DISTINCT promotion_id) AS num_promotions, {_mean("discount_percent")} AS avg_discount,
           {_total("CASE WHEN on_promotion = 1 THEN revenue ELSE 0 END")} AS promo_revenue,
           {_total("CASE WHEN on_promotion = 0 THEN revenue ELSE 0 END")} AS non_promo_revenue,
           {_mean("CASE WHEN on_promotion = 1 THEN uplift_pct END")} AS avg_uplift_pct
    FROM promotion_mart AS m JOIN dim_product AS p ON p.product_id = m.product_id
    GROUP BY ALL
"""
_PARTS["v_regional_performance"] = f"""
    SELECT year, quarter, region, channel, CAST(SUM(qty) AS BIGINT) AS total_qty,
           {_total("revenue")} AS total_revenue, COUNT(DISTINCT product_name) AS active_skus
    FROM sales_mart WHERE region IS NOT NULL GROUP BY ALL
"""

# ---------------------------------------------------------------------------------------------------------
# Registered queries

_CARDS: dict[str, str] = {
    "card_monthly_revenue_by_channel": f"""
        SELECT year, month, channel, {_total("revenue")} AS total_revenue
        FROM sales_mart GROUP BY ALL ORDER BY year, month, channel""",
    "card_si_vs_so_summary": f"""
        SELECT year, month, brand, {_channel_total("Sell-In")} AS sellin,
               {_channel_total("Sell-Out GT")} AS sellout_gt, {_channel_total("POS Modern Trade")} AS pos_mt
        FROM sales_mart GROUP BY ALL ORDER BY year, month, brand""",
    "card_sales_by_region": f"""
        SELECT year, quarter, region, {_total("revenue")} AS revenue
        FROM sales_mart WHERE region IS NOT NULL GROUP BY ALL ORDER BY year, quarter, region""",
    "card_top_brands": f"""
        SELECT brand, {_total("revenue")} AS total_revenue
        FROM sales_mart GROUP BY ALL ORDER BY total_revenue DESC, brand""",
    "card_ecommerce_by_platform": f"""
        SELECT year, month, platform, {_total("revenue")} AS revenue
        FROM fact_ecommerce_sales JOIN dim_date USING (date_key) JOIN dim_product USING (product_key)
        GROUP BY ALL ORDER BY year, month, platform""",
    "card_promo_uplift_by_type": f"""
        SELECT promotion_type, {_mean("uplift_pct")} AS avg_uplift_pct,
               {_total("CASE WHEN on_promotion = 1 THEN revenue END")} AS promo_revenue,
               {_total("CASE WHEN on_promotion = 0 THEN revenue END")} AS baseline_revenue
        FROM promotion_mart GROUP BY ALL""",
    "card_promo_vs_nonpromo": f"""
        SELECT CASE on_promotion WHEN 1 THEN 'On Promotion' ELSE 'No Promotion' END AS status,
               {_total("revenue")} AS revenue
        FROM promotion_mart GROUP BY ALL""",
    "card_top_promoted_products": f"""
        SELECT product_id, promotion_type, COUNT(*) AS promo_days, {_mean("uplift_pct")} AS avg_uplift,
               {_total("revenue")} AS total_promo_revenue
        FROM promotion_mart WHERE on_promotion = 1 GROUP BY ALL
        ORDER BY avg_uplift DESC NULLS LAST, product_id, promotion_type LIMIT 20""",
    "card_adoption_curve": f"""
        SELECT sku_name, month_since_launch, {_mean("adoption_rate_pct")} AS avg_adoption_rate,
               {_total("revenue")} AS revenue
        FROM innovation_mart GROUP BY ALL ORDER BY sku_name, month_since_launch""",
    "card_innovation_by_brand": f"""
        SELECT brand, month_since_launch, {_total("revenue")} AS revenue
        FROM innovation_mart GROUP BY ALL ORDER BY brand, month_since_launch""",
    "card_cohort_revenue": """
        SELECT sku_name, launch_date, channel,
               MAX(revenue) FILTER (WHERE month_since_launch = 1) AS month_1,
               MAX(revenue) FILTER (WHERE month_since_launch = 3) AS month_3,
               MAX(revenue) FILTER (WHERE month_since_launch = 6) AS month_6,
               MAX(revenue) FILTER (WHERE month_since_launch = 12) AS month_12
        FROM innovation_mart GROUP BY ALL ORDER BY launch_date, sku_name, channel""",
}
_OTHERS: dict[str, str] = {
    "adhoc_si_vs_so_limit": "SELECT * FROM v_si_vs_so ORDER BY year, month, brand, region NULLS LAST LIMIT 20",
    "adhoc_cohort_like": "SELECT * FROM v_innovation_cohort WHERE sku_name LIKE '%widget%' ORDER BY month_since_launch",
    "adhoc_promo_ranked": "SELECT * FROM v_promotion_effectiveness ORDER BY avg_uplift_pct DESC NULLS LAST",
    "adhoc_regional_year": "SELECT * FROM v_regional_performance WHERE year = 1998",
    "dense_key_bucketed": """
        SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS part_key, p_partkey, p_name FROM part""",
    "demand_index": """
        SELECT * EXCLUDE (months), season_factor * growth_factor * adoption_factor AS demand_index
        FROM (SELECT *,
                     CAST(CASE WHEN month(date) <= 2 THEN 1.6 WHEN month(date) BETWEEN 5 AND 8 THEN 1.4
                               WHEN month(date) >= 11 THEN 1.2 ELSE 1.0 END AS DOUBLE) AS season_factor,
                     CAST(1 AS DOUBLE) + CAST(0.4 AS DOUBLE) * (year(date) - (SELECT min(year) FROM dim_date)) AS growth_factor,
                     CASE WHEN months < 0 THEN CAST(0 AS DOUBLE)
                          WHEN months IS NOT NULL THEN least(CAST(1 AS DOUBLE), CAST(0.1 AS DOUBLE) + CAST(0.15 AS DOUBLE) * months)
                     END AS adoption_factor
              FROM (SELECT *, datediff('month', launch_date, date) AS months FROM innovation_daily) AS m) AS factors
    """,
}
_COUNTED = (
    "dim_date", "dim_product", "dim_distributor", "dim_store", "dim_promotion", "fact_sellin", "fact_sellout",
    "fact_pos_sales", "fact_ecommerce_sales", "fact_inventory", "sales_mart", "promotion_mart", "innovation_mart",
)
_OTHERS["row_count_audit"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}" for name in _COUNTED
)

_TABLES = (
    "dim_date", "dim_product", "dim_distributor", "dim_store", "dim_promotion", "fact_sellin", "fact_sellout",
    "fact_pos_sales", "fact_ecommerce_sales", "fact_inventory", "sales_mart", "promo_calendar", "promotion_mart",
    "innovation_daily", "innovation_mart", "v_monthly_sales", "v_si_vs_so", "v_innovation_cohort",
    "v_promotion_effectiveness", "v_regional_performance",
)


def _used(sql: str, seen: list[str]) -> list[str]:
    """Parts that ``sql`` names, each after the parts it needs itself."""
    for name in re.findall(r"\w+", sql):
        if name in _PARTS and name not in seen:
            _used(_PARTS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def _complete(sql: str) -> str:
    parts = ",\n".join(f"{name} AS ({_PARTS[name]})" for name in _used(sql, []))
    return f"WITH {parts}\n{sql}" if parts else sql


def oracle_queries() -> dict[str, str]:
    queries = {f"clean_{source}": _clean_sql(source) for source in _CLEAN}
    queries |= {name: f"SELECT * FROM {name}" for name in _TABLES}
    queries |= _CARDS | _OTHERS
    return {name: _complete(sql) for name, sql in queries.items()}
