"""Sales marts against SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cte
from tallyloom.functions.sales import (
    calculated_amount,
    calendar,
    geography_key,
    is_weekend,
    net_revenue,
    segment2,
    segment3,
    value_band,
)
from tallyloom.operators.audits import key_audit, key_summary
from tallyloom.operators.ranking import (
    dense_rank_by,
    lag_growth,
    rank_by,
    share_of_partition,
    share_of_total,
    surrogate_key,
)
from tallyloom.plans import sales
from tallyloom.session import park
from tallyloom.sources import adapters

# The test tables' amounts are far above the reports' defaults of 1000 and 100.
HI, MID = 50000, 10000


def bronze(spark, sf):
    return adapters.bronze_sales(spark, sf)


def silver(spark, sf):
    return sales.silver_sales_fact(bronze(spark, sf), HI, MID)


def wide(spark, sf):
    return sales.gold_wide(silver(spark, sf), HI, MID)


def _without_stamp(df):
    return df.drop("processed_timestamp", "last_updated")


cte(
    "bronze_sales",
    """
SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
  cast(o_orderdate AS date) AS transaction_date,
  cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS int) AS date_id,
  cast(month(o_orderdate) AS int) AS month,
  'Q' || quarter(o_orderdate) AS quarter,
  CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B2B'
       WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'B2C' END AS customer_type,
  c_name AS sold_to_customer_name, c_mktsegment AS end_user, n_name AS country, r_name AS region,
  'S' || (c_custkey % 7) AS state, 'C' || (c_custkey % 13) AS city,
  'SKU-' || p_partkey AS product_sku, p_name AS product_name, p_type AS category,
  p_brand AS brand,
  CASE WHEN l_linenumber = 7 THEN 0 ELSE cast(l_quantity AS int) END AS quantity,
  cast(p_retailprice AS decimal(18,2)) AS unit_price,
  CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 1)
       THEN cast(l_extendedprice AS decimal(18,2)) END AS total_amount,
  'USD' AS currency
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey""",
)
_BAND = f"""CASE WHEN total_amount > {HI} THEN 'High Value'
  WHEN total_amount > {MID} THEN 'Medium Value' ELSE 'Low Value' END"""
_AMOUNT = "cast(cast(quantity AS decimal(10,0)) * unit_price AS decimal(28,2))"
cte(
    "silver_sales",
    f"""
SELECT transaction_id, transaction_date, date_id, month,
  cast(substring(quarter, 2, 1) AS int) AS quarter_num, quarter,
  cast(year(transaction_date) AS int) AS year, customer_type, sold_to_customer_name, end_user,
  CASE customer_type WHEN 'B2B' THEN 'Business' WHEN 'B2C' THEN 'Consumer' ELSE 'Unknown' END
    AS customer_segment,
  country, state, city, region, product_sku, product_name, category, brand, quantity, unit_price,
  total_amount, currency, cast({_AMOUNT} AS decimal(18,2)) AS calculated_amount,
  {_BAND} AS transaction_value_band
FROM bronze_sales
WHERE total_amount IS NOT NULL AND quantity > 0 AND transaction_date IS NOT NULL""",
)
_CALENDAR = """cast(day({0}) AS int) AS day_of_month, cast(dayofweek({0}) + 1 AS int) AS day_of_week_num,
  dayname({0}) AS day_of_week_name, monthname({0}) AS month_name,
  cast(weekofyear({0}) AS int) AS week_of_year,
  CASE WHEN dayofweek({0}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type"""
_SEGMENT2 = "CASE WHEN customer_type = 'B2B' THEN 'Business' ELSE 'Consumer' END"
cte(
    "gold_wide",
    f"""
SELECT transaction_id, transaction_date, date_id, year, month, quarter, quarter_num,
  {_CALENDAR.format("transaction_date")},
  sold_to_customer_name AS customer_name, customer_type, {_SEGMENT2} AS customer_segment, end_user,
  country, state, city, region, product_sku, product_name, category, brand,
  quantity AS units_sold, unit_price, total_amount AS revenue, currency,
  {_AMOUNT} AS calculated_revenue, transaction_value_band
FROM silver_sales""",
)
_MEAN = "cast(sum({0}) AS double) / count({0})"
cte(
    "daily_sales",
    f"""
SELECT transaction_date AS date, year, month, quarter, month_name,
  count(DISTINCT transaction_id) AS total_orders, sum(units_sold) AS total_units_sold,
  sum(revenue) AS total_revenue, {_MEAN.format("revenue")} AS avg_order_value,
  count(DISTINCT customer_name) AS unique_customers,
  sum(CASE WHEN customer_type = 'B2B' THEN revenue ELSE 0 END) AS b2b_revenue,
  sum(CASE WHEN customer_type = 'B2C' THEN revenue ELSE 0 END) AS b2c_revenue
FROM gold_wide GROUP BY ALL""",
)
cte(
    "product_sales",
    f"""
SELECT product_sku, product_name, category, brand, sum(units_sold) AS total_units_sold,
  sum(revenue) AS total_revenue, {_MEAN.format("unit_price")} AS avg_selling_price,
  count(DISTINCT transaction_id) AS total_orders,
  count(DISTINCT customer_name) AS unique_customers,
  count(DISTINCT country) AS countries_sold, count(DISTINCT region) AS regions_sold
FROM gold_wide GROUP BY ALL""",
)
cte(
    "place_sales",
    f"""
SELECT country, region, state, city, sum(revenue) AS total_revenue,
  sum(units_sold) AS total_units_sold, count(DISTINCT transaction_id) AS total_orders,
  count(DISTINCT customer_name) AS unique_customers, {_MEAN.format("revenue")} AS avg_order_value,
  count(DISTINCT product_sku) AS unique_products_sold,
  count(DISTINCT category) AS categories_sold, min(transaction_date) AS first_sale_date,
  max(transaction_date) AS last_sale_date, count(DISTINCT transaction_date) AS days_with_sales,
  sum(CASE WHEN customer_type = 'B2B' THEN 1 ELSE 0 END) AS b2b_customers,
  sum(CASE WHEN customer_type = 'B2C' THEN 1 ELSE 0 END) AS b2c_customers
FROM gold_wide GROUP BY ALL""",
)
cte(
    "product_dim",
    """
SELECT row_number() OVER (ORDER BY p.product_sku NULLS FIRST, p.product_name NULLS FIRST,
    p.category NULLS FIRST, p.brand NULLS FIRST) AS product_key,
  p.product_sku AS sku, p.product_name AS product, p.category, p.brand, s.total_revenue,
  s.total_units_sold, s.total_orders, s.avg_selling_price, s.unique_customers, s.countries_sold,
  s.regions_sold
FROM (SELECT DISTINCT product_sku, product_name, category, brand FROM gold_wide) p
  LEFT JOIN product_sales s ON p.product_sku = s.product_sku""",
)
cte(
    "customer_dim",
    f"""
SELECT row_number() OVER (ORDER BY customer_name NULLS FIRST, customer_type NULLS FIRST,
    end_user NULLS FIRST) AS customer_key,
  customer_name, customer_type AS segment_code, {_SEGMENT2} AS segment_name, end_user,
  count(DISTINCT transaction_id) AS total_transactions, sum(revenue) AS lifetime_revenue,
  {_MEAN.format("revenue")} AS avg_transaction_value, sum(units_sold) AS total_units_purchased,
  count(DISTINCT category) AS categories_purchased, count(DISTINCT country) AS countries_active,
  min(transaction_date) AS first_purchase_date, max(transaction_date) AS last_purchase_date
FROM gold_wide GROUP BY customer_name, customer_type, end_user""",
)
cte(
    "geography_dim",
    """
SELECT row_number() OVER (ORDER BY country NULLS FIRST, state NULLS FIRST, city NULLS FIRST,
    region NULLS FIRST) AS geography_key,
  country, region, state, city, total_revenue, total_units_sold, total_orders, unique_customers,
  avg_order_value, b2b_customers, b2c_customers, days_with_sales
FROM place_sales""",
)


@check("p1_silver_sales_fact", "SELECT * FROM silver_sales")
def _(spark, sf):
    return _without_stamp(silver(spark, sf))


@check(
    "p2_acceptance_filter",
    """SELECT (SELECT count(*) FROM bronze_sales) AS offered, count(*) AS taken FROM silver_sales""",
)
def _(spark, sf):
    kept = (
        F.col("total_amount").isNotNull()
        & (F.col("quantity") > 0)
        & F.col("transaction_date").isNotNull()
    )
    return bronze(spark, sf).agg(F.count(F.lit(1)).alias("offered"), F.count_if(kept).alias("taken"))


@check(
    "p3_segment_three_way",
    "SELECT customer_segment, count(*) AS n FROM silver_sales GROUP BY ALL",
)
def _(spark, sf):
    rows = sales.accepted(bronze(spark, sf)).select(segment3().alias("customer_segment"))
    return rows.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("n"))


@check(
    "p4_segment_two_way",
    "SELECT customer_segment, count(*) AS n FROM gold_wide GROUP BY ALL",
)
def _(spark, sf):
    rows = sales.accepted(bronze(spark, sf)).select(segment2().alias("customer_segment"))
    return rows.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("n"))


@check(
    "p5_value_band",
    f"""SELECT {_BAND} AS band, count(*) AS n, sum(total_amount) AS amount
FROM bronze_sales GROUP BY ALL""",
)
def _(spark, sf):
    band = value_band("total_amount", HI, MID).alias("band")
    return (
        bronze(spark, sf)
        .groupBy(band)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("amount"))
    )


@check(
    "p6_calculated_amount",
    f"SELECT product_sku, sum({_AMOUNT}) AS calculated FROM bronze_sales GROUP BY ALL",
)
def _(spark, sf):
    return (
        bronze(spark, sf)
        .groupBy("product_sku")
        .agg(F.sum(calculated_amount()).alias("calculated"))
    )


@check(
    "p7_net_revenue",
    """SELECT customer_type, sum(CASE WHEN customer_type = 'B2B' THEN revenue * 0.85
  ELSE revenue END) AS net FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    return wide(spark, sf).groupBy("customer_type").agg(F.sum(net_revenue()).alias("net"))


@check("p8_gold_wide", "SELECT * FROM gold_wide")
def _(spark, sf):
    return _without_stamp(wide(spark, sf))


_FACT_HEAD = """SELECT transaction_id, date_id AS date_key, product_sku AS product_key,
  customer_name AS customer_key, country || '-' || state || '-' || city AS geography_key,
  transaction_date AS date, year, quarter, quarter_num, month,"""
_FACT_TAIL = """customer_name, customer_type AS customer_segment_code,
  customer_segment AS customer_segment_name, end_user, country, state, city, region, product_sku,
  product_name, category, brand, units_sold AS quantity, unit_price, revenue AS total_amount,
  revenue AS revenue_usd, currency, CASE WHEN customer_type = 'B2B' THEN revenue * 0.85
  ELSE revenue END AS net_revenue_usd, transaction_value_band"""


@check(
    "p9_semantic_fact",
    f"""{_FACT_HEAD} day_of_month, day_of_week_num, day_of_week_name, month_name, week_of_year,
  day_type, {_FACT_TAIL}, calculated_revenue AS calculated_revenue_usd FROM gold_wide""",
)
def _(spark, sf):
    return _without_stamp(sales.semantic_sales_fact(wide(spark, sf)))


@check(
    "p10_semantic_fact_v2",
    f"""{_FACT_HEAD} month_name, day_of_month, day_of_week_name, day_type, {_FACT_TAIL}
FROM gold_wide""",
)
def _(spark, sf):
    return _without_stamp(sales.semantic_sales_fact_v2(wide(spark, sf)))


@check(
    "p11_geography_key",
    """SELECT country || '-' || CASE WHEN state <> 'S0' THEN state END || '-' || city
  AS geography_key, count(*) AS n FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    known = wide(spark, sf).withColumn("state", F.when(F.col("state") != "S0", F.col("state")))
    return known.groupBy(geography_key("country", "state", "city").alias("geography_key")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check(
    "p16_weekend_membership",
    """SELECT dayofweek(cast(o_orderdate AS date)) IN (0, 6) AS is_weekend, count(*) AS n
FROM orders GROUP BY ALL""",
)
def _(spark, sf):
    orders = adapters.table(spark, sf, "orders")
    return orders.groupBy(is_weekend("o_orderdate").alias("is_weekend")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check(
    "p17_safe_divide",
    """SELECT country, round(sum(CASE WHEN customer_type = 'B2C' THEN units_sold ELSE 0 END)
  / nullif(sum(CASE WHEN customer_type = 'B2B' THEN units_sold ELSE 0 END), 0) * 100, 1) AS pct
FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    def units(kind):
        return F.sum(F.when(F.col("customer_type") == kind, F.col("units_sold")).otherwise(0))

    return wide(spark, sf).groupBy("country").agg(
        F.round(sales.safe_pct(units("B2C"), units("B2B")), 1).alias("pct")
    )


@check(
    "f1_calendar_functions",
    f"""SELECT DISTINCT cast(ts AS date) AS d, cast(year(ts) AS int) AS y,
  {_CALENDAR.format("cast(ts AS date)")} FROM events""",
)
def _(spark, sf):
    days = adapters.table(spark, sf, "events").select(F.col("ts").cast("date").alias("d")).distinct()
    features = calendar("d")
    return days.select("d", F.year("d").alias("y"), *(c.alias(n) for n, c in features.items()))


@check("a1_daily_sales", "SELECT * FROM daily_sales")
def _(spark, sf):
    return _without_stamp(sales.gold_daily_sales_summary(wide(spark, sf)))


@check("a2_product_performance", "SELECT * FROM product_sales")
def _(spark, sf):
    return _without_stamp(sales.gold_product_performance(wide(spark, sf)))


@check("a3_geography_performance", "SELECT * FROM place_sales")
def _(spark, sf):
    return _without_stamp(sales.gold_geography_performance(wide(spark, sf)))


@check("a4_customer_lifetime", "SELECT * EXCLUDE (customer_key) FROM customer_dim")
def _(spark, sf):
    return sales.customer_rows(wide(spark, sf))


_SEGMENTS = f"""SELECT segment_name AS customer_segment, count(*) AS customer_count,
  sum(lifetime_revenue) AS total_revenue_usd,
  round({_MEAN.format("lifetime_revenue")}, 2) AS avg_revenue_per_customer_usd,
  round({_MEAN.format("total_transactions")}, 2) AS avg_transactions_per_customer
FROM customer_dim GROUP BY ALL"""


@check("a5_aggregate_of_aggregate", _SEGMENTS)
def _(spark, sf):
    return sales.customer_segments(sales.customer_rows(wide(spark, sf)))


@check(
    "a6_distinct_counts",
    """SELECT region, count(DISTINCT transaction_id) AS orders,
  count(DISTINCT customer_name) AS customers, count(DISTINCT product_sku) AS products,
  count(DISTINCT category) AS categories, count(DISTINCT transaction_date) AS days
FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    counted = {
        "orders": "transaction_id",
        "customers": "customer_name",
        "products": "product_sku",
        "categories": "category",
        "days": "transaction_date",
    }
    return wide(spark, sf).groupBy("region").agg(
        *(F.count_distinct(column).alias(name) for name, column in counted.items())
    )


@check(
    "a7_conditional_sum",
    """SELECT category, sum(CASE WHEN customer_type = 'B2B' THEN revenue ELSE 0 END) AS b2b,
  sum(CASE WHEN customer_type = 'B2C' THEN revenue ELSE 0 END) AS b2c,
  sum(CASE WHEN customer_type = 'B2B' THEN 1 ELSE 0 END) AS b2b_rows
FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    def of(kind, value):
        return F.sum(F.when(F.col("customer_type") == kind, value).otherwise(0))

    return wide(spark, sf).groupBy("category").agg(
        of("B2B", F.col("revenue")).alias("b2b"),
        of("B2C", F.col("revenue")).alias("b2c"),
        of("B2B", F.lit(1)).alias("b2b_rows"),
    )


@check(
    "a10_plain_aggregates",
    f"""SELECT brand, count(*) AS n, count(customer_type) AS typed, sum(revenue) AS total,
  {_MEAN.format("revenue")} AS average, min(revenue) AS low, max(revenue) AS high
FROM gold_wide GROUP BY ALL""",
)
def _(spark, sf):
    return wide(spark, sf).groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("customer_type").alias("typed"),
        F.sum("revenue").alias("total"),
        sales.mean("revenue").alias("average"),
        F.min("revenue").alias("low"),
        F.max("revenue").alias("high"),
    )


@check(
    "a13_distinct",
    "SELECT DISTINCT product_sku, product_name, category, brand FROM gold_wide",
)
def _(spark, sf):
    return wide(spark, sf).select("product_sku", "product_name", "category", "brand").distinct()


@check(
    "a14_group_by_shadowed_alias",
    "SELECT month_name, month, count(*) AS n, sum(revenue) AS total FROM gold_wide GROUP BY ALL",
)
def _(spark, sf):
    return wide(spark, sf).groupBy("month_name", "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("total")
    )


@check("j3_product_rows", "SELECT * EXCLUDE (product_key) FROM product_dim")
def _(spark, sf):
    used = ["product_sku", "product_name", "category", "brand", "units_sold", "revenue", "unit_price", "transaction_id", "customer_name", "country", "region"]
    rows = park(wide(spark, sf).select(*used), "wide")
    products = rows.select("product_sku", "product_name", "category", "brand").distinct()
    return sales.product_rows(products, sales.gold_product_performance(rows))


@check(
    "w1_surrogate_key",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_key, o_orderkey
FROM orders""",
)
def _(spark, sf):
    orders = adapters.table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return surrogate_key(orders, ["o_orderdate", "o_orderkey"], "order_key").drop("o_orderdate")


_LAG = """lag(total_revenue, 7) OVER (ORDER BY date)"""
_GROWTH = f"round((total_revenue - {_LAG}) / nullif({_LAG}, 0) * 100, 2)"


@check("w2_lag_rows", f"SELECT date, {_LAG} AS revenue_7d_ago FROM daily_sales")
def _(spark, sf):
    daily = sales.gold_daily_sales_summary(wide(spark, sf))
    return lag_growth(daily, "date", "total_revenue", 7, "revenue_7d_ago", "growth").select(
        "date", "revenue_7d_ago"
    )


@check("w3_growth", f"SELECT date, {_GROWTH} AS growth FROM daily_sales")
def _(spark, sf):
    daily = sales.gold_daily_sales_summary(wide(spark, sf))
    return lag_growth(daily, "date", "total_revenue", 7, "before", "growth").select("date", "growth")


@check(
    "w4_dense_rank",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_retailprice DESC NULLS LAST) AS price_rank
FROM part""",
)
def _(spark, sf):
    parts = adapters.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return dense_rank_by(parts, "p_retailprice", "price_rank").drop("p_retailprice")


@check(
    "w5_dense_rank_in_group",
    """SELECT l_orderkey, l_linenumber, dense_rank() OVER (PARTITION BY l_returnflag
  ORDER BY l_quantity DESC NULLS LAST) AS quantity_rank FROM lineitem""",
)
def _(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]
    lines = adapters.table(spark, sf, "lineitem").select(*columns)
    ranked = dense_rank_by(lines, "l_quantity", "quantity_rank", ["l_returnflag"])
    return ranked.select("l_orderkey", "l_linenumber", "quantity_rank")


@check(
    "w6_rank_in_group",
    """SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus
  ORDER BY cast(o_orderdate AS date) DESC NULLS LAST) AS recency FROM orders""",
)
def _(spark, sf):
    orders = adapters.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")
    )
    return rank_by(orders, "day", "recency", ["o_orderstatus"]).select("o_orderkey", "recency")


_UNITS = "SELECT region, country, sum(units_sold) AS units FROM gold_wide GROUP BY ALL"


@check(
    "w7_share_of_partition",
    f"""SELECT *, units / nullif(sum(units) OVER (PARTITION BY region), 0) * 100 AS share
FROM ({_UNITS})""",
)
def _(spark, sf):
    units = wide(spark, sf).groupBy("region", "country").agg(F.sum("units_sold").alias("units"))
    return share_of_partition(park(units), ["region"], "units", "share")


@check(
    "w8_share_of_total",
    f"SELECT *, units / nullif(sum(units) OVER (), 0) * 100 AS share FROM ({_UNITS})",
)
def _(spark, sf):
    units = wide(spark, sf).groupBy("region", "country").agg(F.sum("units_sold").alias("units"))
    return share_of_total(park(units), "units", "share")


@check(
    "k1_revenue_kpi",
    f"""SELECT date, year, quarter, month, month_name, total_revenue AS revenue_usd,
  total_orders AS orders, total_units_sold AS units_sold,
  avg_order_value AS average_order_value_usd, unique_customers AS active_customers, b2b_revenue,
  b2c_revenue, round(b2b_revenue / nullif(total_revenue, 0) * 100, 1) AS b2b_revenue_percent,
  round(b2c_revenue / nullif(total_revenue, 0) * 100, 1) AS b2c_revenue_percent,
  {_LAG} AS revenue_7d_ago, {_GROWTH} AS week_over_week_growth_percent FROM daily_sales""",
)
def revenue_kpi(spark, sf):
    return sales.revenue_kpi(sales.gold_daily_sales_summary(wide(spark, sf)))


@check(
    "k2_product_performance",
    """SELECT sku, product, category, brand, total_revenue AS revenue_usd,
  total_units_sold AS units_sold, total_orders AS orders, avg_selling_price AS average_price_usd,
  unique_customers AS customer_count, countries_sold, regions_sold,
  dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank,
  dense_rank() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST)
    AS category_revenue_rank FROM product_dim""",
)
def _(spark, sf):
    return sales.product_performance(sales.product_measures(wide(spark, sf)))


@check("k3_customer_segments", _SEGMENTS)
def _(spark, sf):
    return sales.customer_segments(sales.customer_dim(wide(spark, sf)))


@check(
    "k4_geography_insights",
    """SELECT country, region, state, city, total_revenue AS revenue_usd,
  total_units_sold AS units_sold, total_orders AS orders, avg_order_value AS avg_order_value_usd,
  unique_customers AS customers, b2b_customers, b2c_customers,
  round(b2b_customers / nullif(unique_customers, 0) * 100, 1) AS b2b_customer_percent,
  days_with_sales FROM geography_dim""",
)
def _(spark, sf):
    return sales.geography_insights(sales.geography_dim(wide(spark, sf)))


@check(
    "k5_date_dim",
    """SELECT DISTINCT date_id AS date_key, transaction_date AS date, year, quarter, quarter_num,
  month, month_name, day_of_month, day_of_week_num, day_of_week_name, week_of_year,
  day_type = 'Weekend' AS is_weekend FROM gold_wide""",
)
def _(spark, sf):
    return sales.date_dim(wide(spark, sf))


@check("k5_product_dim", "SELECT * FROM product_dim")
def _(spark, sf):
    return sales.product_dim(wide(spark, sf))


@check("k5_customer_dim", "SELECT * FROM customer_dim")
def _(spark, sf):
    return sales.customer_dim(wide(spark, sf))


@check("k5_geography_dim", "SELECT * FROM geography_dim")
def _(spark, sf):
    return sales.geography_dim(wide(spark, sf))


@check(
    "d1_key_audit",
    """SELECT transaction_id, count(*) AS n, transaction_id IS NULL AS is_null
FROM bronze_sales GROUP BY transaction_id HAVING count(*) > 1 OR transaction_id IS NULL""",
)
def _(spark, sf):
    return key_audit(bronze(spark, sf), ["transaction_id"])


# The keys that the star schema declares.
_KEYED = {
    "semantic_fact": ("gold_wide", "transaction_id", lambda w: w),
    "date_dim": (
        "(SELECT DISTINCT date_id, transaction_date, year, quarter, month FROM gold_wide)",
        "date_id",
        lambda w: sales.date_dim(w).withColumnRenamed("date_key", "date_id"),
    ),
    "product_dim": ("product_dim", "product_key", sales.product_dim),
    "customer_dim": ("customer_dim", "customer_key", sales.customer_dim),
    "geography_dim": ("geography_dim", "geography_key", sales.geography_dim),
}


def _summary_sql(source: str, key: str) -> str:
    return f"""SELECT cast(coalesce(sum(n), 0) AS bigint) AS key_rows, count(*) AS distinct_keys,
  count(*) FILTER (WHERE n > 1) AS repeated_keys, count(*) FILTER (WHERE {key} IS NULL) AS null_keys
FROM (SELECT {key}, count(*) AS n FROM {source} GROUP BY {key})"""


def _key_check(name, source, key, build):
    @check(f"d1_key_of_{name}", _summary_sql(source, key))
    def _(spark, sf):
        return key_summary(build(wide(spark, sf)), [key])


for _name, (_source, _key, _build) in _KEYED.items():
    _key_check(_name, _source, _key, _build)
