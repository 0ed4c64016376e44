"""Sales marts: raw transactions -> typed facts -> wide gold table -> marts -> star -> KPI views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import mean, safe_pct
from tallyloom.functions.sales import (
    calculated_amount,
    calendar,
    geography_key,
    is_weekend,
    net_revenue,
    quarter_number,
    segment2,
    segment3,
    value_band,
)
from tallyloom.operators.joins import join_null_safe, join_optional
from tallyloom.operators.ranking import lag_growth, revenue_ranks, surrogate_key
from tallyloom.session import park

_GEOGRAPHY = ["country", "state", "city", "region"]
# The order in which the published tables list a place.
_PLACE = ["country", "region", "state", "city"]
_PRODUCT = ["product_sku", "product_name", "category", "brand"]
# The transactions of a product or a place with no more rows than this meet in one task.
CROWDED = 1 << 20


def accepted(bronze: DataFrame) -> DataFrame:
    """Transactions with an amount, a positive quantity and a date, judged before any cast."""
    return bronze.where(
        F.col("total_amount").isNotNull()
        & (F.col("quantity") > 0)
        & F.col("transaction_date").isNotNull()
    )


def silver_sales_fact(bronze: DataFrame, hi: int = 1000, mid: int = 100) -> DataFrame:
    """Accepted transactions, typed. Conditions and products use the raw, uncast columns."""
    money = "decimal(18,2)"
    date = F.col("transaction_date").cast("date")
    return accepted(bronze).select(
        F.col("transaction_id").cast("bigint").alias("transaction_id"),
        date.alias("transaction_date"),
        F.col("date_id").cast("int").alias("date_id"),
        F.col("month").cast("tinyint").alias("month"),
        quarter_number().alias("quarter_num"),
        "quarter",
        F.year(date).alias("year"),
        "customer_type",
        "sold_to_customer_name",
        "end_user",
        segment3().alias("customer_segment"),
        *_GEOGRAPHY,
        *_PRODUCT,
        F.col("quantity").cast("int").alias("quantity"),
        F.col("unit_price").cast(money).alias("unit_price"),
        F.col("total_amount").cast(money).alias("total_amount"),
        "currency",
        calculated_amount().cast(money).alias("calculated_amount"),
        value_band("total_amount", hi, mid).alias("transaction_value_band"),
        F.current_timestamp().alias("processed_timestamp"),
    )


def gold_wide(silver: DataFrame, hi: int = 1000, mid: int = 100) -> DataFrame:
    """Transaction grain with calendar features and business names."""
    features = calendar("transaction_date")
    return silver.select(
        "transaction_id",
        "transaction_date",
        "date_id",
        "year",
        "month",
        "quarter",
        quarter_number().alias("quarter_num"),
        *(column.alias(name) for name, column in features.items()),
        F.col("sold_to_customer_name").alias("customer_name"),
        "customer_type",
        segment2().alias("customer_segment"),
        "end_user",
        *_GEOGRAPHY,
        *_PRODUCT,
        F.col("quantity").alias("units_sold"),
        "unit_price",
        F.col("total_amount").alias("revenue"),
        "currency",
        calculated_amount().alias("calculated_revenue"),
        value_band("total_amount", hi, mid).alias("transaction_value_band"),
        F.current_timestamp().alias("processed_timestamp"),
    )


def _fact_keys() -> list:
    return [
        F.col("date_id").alias("date_key"),
        F.col("product_sku").alias("product_key"),
        F.col("customer_name").alias("customer_key"),
        geography_key("country", "state", "city").alias("geography_key"),
        F.col("transaction_date").alias("date"),
    ]


def _fact_measures() -> list:
    return [
        F.col("units_sold").alias("quantity"),
        "unit_price",
        F.col("revenue").alias("total_amount"),
        F.col("revenue").alias("revenue_usd"),
        "currency",
        net_revenue().alias("net_revenue_usd"),
        "transaction_value_band",
        "processed_timestamp",
    ]


def semantic_sales_fact(wide: DataFrame) -> DataFrame:
    """Denormalised fact, first version: calendar and segment are computed anew."""
    return wide.select(
        "transaction_id",
        *_fact_keys(),
        "year",
        "quarter",
        quarter_number().alias("quarter_num"),
        "month",
        *(column.alias(name) for name, column in calendar("transaction_date").items()),
        "customer_name",
        F.col("customer_type").alias("customer_segment_code"),
        segment2().alias("customer_segment_name"),
        "end_user",
        *_GEOGRAPHY,
        *_PRODUCT,
        *_fact_measures(),
        calculated_amount("units_sold").alias("calculated_revenue_usd"),
    )


def semantic_sales_fact_v2(wide: DataFrame) -> DataFrame:
    """Denormalised fact, second version: the gold table's features pass through."""
    return wide.select(
        "transaction_id",
        *_fact_keys(),
        "year",
        "quarter",
        "quarter_num",
        "month",
        "month_name",
        "day_of_month",
        "day_of_week_name",
        "day_type",
        "customer_name",
        F.col("customer_type").alias("customer_segment_code"),
        F.col("customer_segment").alias("customer_segment_name"),
        "end_user",
        *_PLACE,
        *_PRODUCT,
        *_fact_measures(),
    )


def _revenue_of(kind: str):
    return F.sum(F.when(F.col("customer_type") == kind, F.col("revenue")).otherwise(0))


def _rows_of(kind: str):
    return F.sum(F.when(F.col("customer_type") == kind, 1).otherwise(0))


def gold_daily_sales_summary(wide: DataFrame) -> DataFrame:
    """One row per date. The month name grouped by is the input's own column."""
    return (
        wide.withColumnRenamed("transaction_date", "date")
        .groupBy("date", "year", "month", "quarter", "month_name")
        .agg(
            F.count_distinct("transaction_id").alias("total_orders"),
            F.sum("units_sold").alias("total_units_sold"),
            F.sum("revenue").alias("total_revenue"),
            mean("revenue").alias("avg_order_value"),
            F.count_distinct("customer_name").alias("unique_customers"),
            _revenue_of("B2B").alias("b2b_revenue"),
            _revenue_of("B2C").alias("b2c_revenue"),
        )
        .withColumn("last_updated", F.current_timestamp())
    )


def _product_measures(rows: DataFrame, distinct) -> DataFrame:
    """The mart's columns by product; ``distinct`` gives the number of a column's different values other than NULL."""
    return rows.groupBy(*_PRODUCT).agg(
        F.sum("units_sold").alias("total_units_sold"),
        F.sum("revenue").alias("total_revenue"),
        mean("unit_price").alias("avg_selling_price"),
        distinct("transaction_id").alias("total_orders"),
        distinct("customer_name").alias("unique_customers"),
        distinct("country").alias("countries_sold"),
        distinct("region").alias("regions_sold"),
    )


def _gathered(wide: DataFrame, keys: list[str], columns: list[str], measures) -> DataFrame:
    """``measures(rows, distinct)`` for each group of ``keys``. Eager: groups of more than CROWDED rows are looked for first.

    Several distinct counts in one aggregation take a row for each transaction and count, held by the tasks and twice shuffled. Instead the transactions
    of a group meet in one task, once, and its values are collected as sets of at most CROWDED; the few groups with more rows are spread by their values.
    """
    held = wide.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    crowded = held.where(F.col("_n") > CROWDED).drop("_n").collect()  # one for each CROWDED rows at most
    together = lambda c: F.size(F.collect_set(c)).cast("bigint")
    rows = wide.select(*keys, *columns)
    if crowded:
        apart = F.broadcast(wide.sparkSession.createDataFrame(crowded, wide.select(*keys).schema))
        spread = measures(join_null_safe(rows, apart, keys, "left_semi"), F.count_distinct)
        rows = join_null_safe(rows, apart, keys, "left_anti")
    found = measures(rows.repartition(*keys), together)
    return found.unionByName(spread) if crowded else found


def gold_product_performance(wide: DataFrame) -> DataFrame:
    """One row per product."""
    columns = ["units_sold", "revenue", "unit_price", "transaction_id", "customer_name", "country", "region"]
    return _gathered(wide, _PRODUCT, columns, _product_measures).withColumn("last_updated", F.current_timestamp())


def _place_measures(rows: DataFrame, distinct) -> DataFrame:
    """The mart's columns by place; ``distinct`` gives the number of a column's different values other than NULL."""
    return rows.groupBy(*_PLACE).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units_sold"),
        distinct("transaction_id").alias("total_orders"),
        distinct("customer_name").alias("unique_customers"),
        mean("revenue").alias("avg_order_value"),
        distinct("product_sku").alias("unique_products_sold"),
        distinct("category").alias("categories_sold"),
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
        distinct("transaction_date").alias("days_with_sales"),
        _rows_of("B2B").alias("b2b_customers"),
        _rows_of("B2C").alias("b2c_customers"),
    )


def gold_geography_performance(wide: DataFrame) -> DataFrame:
    """By place. The two customer-type columns count transactions, as their consumers expect."""
    columns = ["revenue", "units_sold", "transaction_id", "customer_name", "product_sku", "category", "transaction_date", "customer_type"]
    return _gathered(wide, _PLACE, columns, _place_measures).withColumn("last_updated", F.current_timestamp())


def date_dim(wide: DataFrame) -> DataFrame:
    """One row per distinct date key; features are computed after the distinct."""
    features = calendar("date")
    return (
        wide.select(
            F.col("date_id").alias("date_key"),
            F.col("transaction_date").alias("date"),
            "year",
            "quarter",
            "month",
        )
        .distinct()
        .select(
            "date_key",
            "date",
            "year",
            "quarter",
            quarter_number().alias("quarter_num"),
            "month",
            *(features[name].alias(name) for name in features if name != "day_type"),
            is_weekend("date").alias("is_weekend"),
        )
    )


def product_rows(products: DataFrame, performance: DataFrame) -> DataFrame:
    """Distinct products with the mart's measures, joined on sku alone.

    A sku with several names therefore meets every mart row of that sku.
    """
    measures = performance.select(
        "product_sku",
        "total_revenue",
        "total_units_sold",
        "total_orders",
        "avg_selling_price",
        "unique_customers",
        "countries_sold",
        "regions_sold",
    )
    return join_optional(products, measures, "product_sku").withColumnsRenamed(
        {"product_sku": "sku", "product_name": "product"}
    )


def product_dim(wide: DataFrame, performance: DataFrame | None = None) -> DataFrame:
    """Products numbered by sku; remaining columns break ties so that keys repeat.

    Without a stored mart, the mart is computed once and its keys, which are the distinct
    products, stand in for a second pass over the transactions.
    """
    if performance is None:
        performance = park(gold_product_performance(wide), "performance")
        products = performance.select(*_PRODUCT)
    else:
        products = wide.select(*_PRODUCT).distinct()
    rows = product_rows(products, performance)
    return surrogate_key(rows, ["sku", *(c for c in rows.columns if c != "sku")], "product_key")


def product_measures(wide: DataFrame) -> DataFrame:
    """What ``product_dim`` holds but for its key: the ranks need none, so nothing is numbered."""
    performance = park(gold_product_performance(wide), "performance")
    return product_rows(performance.select(*_PRODUCT), performance)


def customer_rows(wide: DataFrame) -> DataFrame:
    """Lifetime measures per customer name, type and end user."""
    return (
        wide.groupBy("customer_name", "customer_type", "end_user")
        .agg(
            F.count_distinct("transaction_id").alias("total_transactions"),
            F.sum("revenue").alias("lifetime_revenue"),
            mean("revenue").alias("avg_transaction_value"),
            F.sum("units_sold").alias("total_units_purchased"),
            F.count_distinct("category").alias("categories_purchased"),
            F.count_distinct("country").alias("countries_active"),
            F.min("transaction_date").alias("first_purchase_date"),
            F.max("transaction_date").alias("last_purchase_date"),
        )
        .withColumn("segment_name", segment2())
        .withColumnRenamed("customer_type", "segment_code")
    )


def customer_dim(wide: DataFrame) -> DataFrame:
    order = ["customer_name", "segment_code", "end_user"]
    return surrogate_key(customer_rows(wide), order, "customer_key")


def geography_dim(wide: DataFrame) -> DataFrame:
    rows = gold_geography_performance(wide).select(
        *_PLACE,
        "total_revenue",
        "total_units_sold",
        "total_orders",
        "unique_customers",
        "avg_order_value",
        "b2b_customers",
        "b2c_customers",
        "days_with_sales",
    )
    return surrogate_key(rows, _GEOGRAPHY, "geography_key")


def revenue_kpi(daily: DataFrame) -> DataFrame:
    """Daily revenue with type shares and growth against the row seven rows earlier."""
    lagged = lag_growth(
        daily, "date", "total_revenue", 7, "revenue_7d_ago", "week_over_week_growth_percent"
    )
    total = F.col("total_revenue")
    return lagged.select(
        "date",
        "year",
        "quarter",
        "month",
        "month_name",
        total.alias("revenue_usd"),
        F.col("total_orders").alias("orders"),
        F.col("total_units_sold").alias("units_sold"),
        F.col("avg_order_value").alias("average_order_value_usd"),
        F.col("unique_customers").alias("active_customers"),
        "b2b_revenue",
        "b2c_revenue",
        F.round(safe_pct(F.col("b2b_revenue"), total), 1).alias("b2b_revenue_percent"),
        F.round(safe_pct(F.col("b2c_revenue"), total), 1).alias("b2c_revenue_percent"),
        "revenue_7d_ago",
        "week_over_week_growth_percent",
    )


def product_performance(products: DataFrame) -> DataFrame:
    """Products with their revenue ranks."""
    return revenue_ranks(products).select(
        "sku",
        "product",
        "category",
        "brand",
        F.col("total_revenue").alias("revenue_usd"),
        F.col("total_units_sold").alias("units_sold"),
        F.col("total_orders").alias("orders"),
        F.col("avg_selling_price").alias("average_price_usd"),
        F.col("unique_customers").alias("customer_count"),
        "countries_sold",
        "regions_sold",
        "revenue_rank",
        "category_revenue_rank",
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    return customers.groupBy(F.col("segment_name").alias("customer_segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("lifetime_revenue").alias("total_revenue_usd"),
        F.round(mean("lifetime_revenue"), 2).alias("avg_revenue_per_customer_usd"),
        F.round(mean("total_transactions"), 2).alias("avg_transactions_per_customer"),
    )


def geography_insights(places: DataFrame) -> DataFrame:
    """Places with the share of business transactions per unique customer (may exceed 100)."""
    return places.select(
        *_PLACE,
        F.col("total_revenue").alias("revenue_usd"),
        F.col("total_units_sold").alias("units_sold"),
        F.col("total_orders").alias("orders"),
        F.col("avg_order_value").alias("avg_order_value_usd"),
        F.col("unique_customers").alias("customers"),
        "b2b_customers",
        "b2c_customers",
        F.round(safe_pct(F.col("b2b_customers"), F.col("unique_customers")), 1).alias(
            "b2b_customer_percent"
        ),
        "days_with_sales",
    )
