from datetime import date
from decimal import Decimal as D

import pytest

from pyspark.sql import functions as F

from tallyloom.plans import sales

BRONZE = (
    "transaction_id long, transaction_date string, date_id int, month int, quarter string,"
    "customer_type string, sold_to_customer_name string, end_user string, country string,"
    "state string, city string, region string, product_sku string, product_name string,"
    "category string, brand string, quantity int, unit_price decimal(18,2),"
    "total_amount decimal(18,2), currency string"
)


def row(i, day, kind, customer, city, sku, name, quantity, price, amount):
    y, m, d = (int(x) for x in day.split("-")) if day else (0, 0, 0)
    quarter = f"Q{(m + 2) // 3}" if day else None
    price, amount = (None if x is None else D(x) for x in (price, amount))
    return (
        i, day, y * 10000 + m * 100 + d, m, quarter, kind, customer, "user", "US", "CA", city,
        "West", sku, name, "Tools", "Brand", quantity, price, amount, "USD",
    )


@pytest.fixture(scope="module")
def bronze(spark):
    data = [
        row(1, "2024-01-06", "B2B", "Ann", "LA", "A", "drill", 2, "50.00", "100.00"),
        row(2, "2024-01-07", "B2C", "Bob", "LA", "A", "drill pro", 1, "1000.00", "1000.00"),
        row(3, "2024-01-07", None, "Cid", None, "B", "saw", 1, "1000.01", "1000.01"),
        row(4, "2024-01-09", "B2B", "Ann", "LA", "B", "saw", 4, "0.00", "0.00"),
        row(5, "2024-01-10", "X", "Ann", "SF", "C", "nail", 1, "100.01", "100.01"),
        row(6, "2024-01-10", "B2B", "Ann", "SF", "C", "nail", 0, "9.00", "9.00"),
        row(7, "2024-01-10", "B2B", "Ann", "SF", "C", "nail", 1, "9.00", None),
        row(8, None, "B2B", "Ann", "SF", "C", "nail", 1, "9.00", "9.00"),
    ]
    return spark.createDataFrame(data, BRONZE)


@pytest.fixture(scope="module")
def wide(bronze):
    return sales.gold_wide(sales.silver_sales_fact(bronze)).cache()


def test_silver_filter_segments_and_bands(bronze, rows):
    silver = sales.silver_sales_fact(bronze)
    assert rows(silver, "transaction_id", "customer_segment", "transaction_value_band") == [
        (1, "Business", "Low Value"),
        (2, "Consumer", "Medium Value"),
        (3, "Unknown", "High Value"),
        (4, "Business", "Low Value"),
        (5, "Unknown", "Medium Value"),
    ]
    types = dict(silver.dtypes)
    assert types["total_amount"] == types["calculated_amount"] == "decimal(18,2)"
    assert types["month"] == types["quarter_num"] == "tinyint"


def test_gold_segment_has_no_unknown(wide, rows):
    assert rows(wide.where("transaction_id in (3, 5)"), "customer_segment") == [
        ("Consumer",),
        ("Consumer",),
    ]


def test_calendar_features(wide, rows):
    sunday = wide.where("transaction_id = 2")
    names = ["day_of_month", "day_of_week_num", "week_of_year", "day_of_week_name", "day_type"]
    assert rows(sunday, *names) == [(7, 1, 1, "Sunday", "Weekend")]


def test_geography_key_is_null_if_a_part_is(wide, rows):
    fact = sales.semantic_sales_fact(wide)
    assert rows(fact.where("transaction_id in (1, 3)"), "geography_key") == [
        ("US-CA-LA",),
        (None,),
    ]
    net = rows(fact.where("transaction_id in (1, 2)"), "transaction_id", "net_revenue_usd")
    assert [(i, float(x)) for i, x in net] == [(1, 85.0), (2, 1000.0)]


def test_second_fact_passes_features_through(wide):
    first, second = sales.semantic_sales_fact(wide), sales.semantic_sales_fact_v2(wide)
    assert set(first.columns) - set(second.columns) == {
        "calculated_revenue_usd", "day_of_week_num", "week_of_year",
    }


def test_lag_counts_rows_not_days_and_zero_revenue_divides_safely(spark, rows):
    days = [(date(2024, 1, 1 + 2 * i), D(0 if i == 0 else 100 + i)) for i in range(9)]
    daily = spark.createDataFrame(days, "date date, total_revenue decimal(18,2)")
    from tallyloom.operators.ranking import lag_growth

    grown = lag_growth(daily, "date", "total_revenue", 7, "before", "growth")
    last = rows(grown.where("date >= '2024-01-15'"), "date", "before", "growth")
    assert [(r[0].day, float(r[1]), r[2] if r[2] is None else float(r[2])) for r in last] == [
        (15, 0.0, None),
        (17, 101.0, 6.93),
    ]


def test_sku_with_two_names_fans_out(wide, rows):
    dim = sales.product_dim(wide)
    assert rows(dim.where("sku = 'A'"), "product", "total_orders") == [
        ("drill", 1), ("drill", 1), ("drill pro", 1), ("drill pro", 1),
    ]
    assert rows(dim, "product_key") == [(i,) for i in range(1, 7)]
    stored = sales.product_dim(wide, sales.gold_product_performance(wide))
    assert rows(stored) == rows(dim)


def test_product_mart_shuffles_each_transaction_once_even_with_crowded_products(wide, rows, monkeypatch):
    more = wide.unionByName(wide.where("product_sku = 'A'").withColumn("customer_name", F.lit(None).cast("string")))
    more = more.unionByName(wide.where("product_sku = 'B'").withColumn("product_name", F.lit(None).cast("string")).withColumn("country", F.lit("CA")))
    expected = more.groupBy("product_sku", "product_name", "category", "brand").agg(
        F.sum("units_sold"), F.sum("revenue"), F.count_distinct("transaction_id").alias("o"), F.count_distinct("customer_name").alias("c"),
        F.count_distinct("country").alias("l"), F.count_distinct("region").alias("r"),
    )
    plans = []
    for crowded in (sales.CROWDED, 1):
        monkeypatch.setattr(sales, "CROWDED", crowded)
        mart = sales.gold_product_performance(more)
        plans.append(mart._jdf.queryExecution().optimizedPlan().toString())
        found = mart.drop("avg_selling_price", "last_updated")
        assert rows(found) == rows(expected)
        assert dict(found.dtypes)["total_orders"] == dict(found.dtypes)["regions_sold"] == "bigint"
    assert "Expand" not in plans[0] and "Expand" in plans[1]


def test_place_mart_takes_each_transaction_once_even_with_crowded_places(wide, rows, monkeypatch):
    more = wide.unionByName(wide.withColumn("customer_name", F.lit(None).cast("string")))
    more = more.unionByName(wide.withColumn("country", F.lit(None).cast("string")).withColumn("product_sku", F.lit("other")))
    expected = more.groupBy("country", "region", "state", "city").agg(
        F.sum("revenue"), F.sum("units_sold"), F.count_distinct("transaction_id"), F.count_distinct("customer_name"), F.count_distinct("product_sku"),
        F.count_distinct("category"), F.min("transaction_date"), F.max("transaction_date"), F.count_distinct("transaction_date"),
        F.count_if(F.col("customer_type") == "B2B"), F.count_if(F.col("customer_type") == "B2C"),
    )
    plans = []
    for crowded in (sales.CROWDED, 1):
        monkeypatch.setattr(sales, "CROWDED", crowded)
        mart = sales.gold_geography_performance(more)
        plans.append(mart._jdf.queryExecution().optimizedPlan().toString())
        assert rows(mart.drop("avg_order_value", "last_updated")) == rows(expected)
        assert dict(mart.dtypes)["total_orders"] == dict(mart.dtypes)["days_with_sales"] == "bigint"
    assert "Expand" not in plans[0] and "Expand" in plans[1]


def test_product_ranks_share_on_ties(spark, rows):
    products = spark.createDataFrame(
        [(f"s{i}", f"p{i}", c, "b", D(r), 1, 1, 1.0, 1, 1, 1) for i, (c, r) in enumerate(
            [("x", 5), ("x", 5), ("y", 5), ("y", 3), ("x", 1)]
        )] + [("s9", "p9", "x", "b", None, 1, 1, 1.0, 1, 1, 1)],
        "sku string, product string, category string, brand string, total_revenue decimal(18,2),"
        "total_units_sold int, total_orders int, avg_selling_price double, unique_customers int,"
        "countries_sold int, regions_sold int",
    )
    ranked = sales.product_performance(products)
    assert rows(ranked, "sku", "revenue_rank", "category_revenue_rank") == [
        ("s0", 1, 1), ("s1", 1, 1), ("s2", 1, 1), ("s3", 2, 2), ("s4", 3, 2), ("s9", 4, 3),
    ]


def test_business_percentage_can_exceed_one_hundred(wide, rows):
    insights = sales.geography_insights(sales.geography_dim(wide))
    by_city = dict(rows(insights, "city", "b2b_customer_percent"))
    assert {k: float(x) for k, x in by_city.items()} == {"LA": 100.0, "SF": 0.0, None: 0.0}
    twice = wide.where("transaction_id = 1").union(
        wide.where("transaction_id = 1").withColumn("transaction_id", F.lit(99).cast("bigint"))
    )
    again = sales.geography_insights(sales.geography_dim(twice))
    assert [float(r[0]) for r in rows(again, "b2b_customer_percent")] == [200.0]


def test_customer_segments(wide, rows):
    segments = sales.customer_segments(sales.customer_dim(wide))
    assert [(r[0], r[1], float(r[2]), r[3], r[4]) for r in rows(segments)] == [
        ("Business", 1, 100.0, 100.0, 2.0),
        ("Consumer", 3, 2100.02, 700.01, 1.0),
    ]


def test_date_dim(wide, rows):
    dim = sales.date_dim(wide)
    assert rows(dim, "date_key", "is_weekend") == [
        (20240106, True), (20240107, True), (20240109, False), (20240110, False),
    ]
