"""Readers and writers: what goes out must come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from tallyloom.session import scratch_path
from tallyloom.sources import files
from tallyloom.sources.adapters import table


@check(
    "s1_csv_scan",
    """SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_label, c_nationkey
FROM customer""",
)
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.expr("concat(c_name, ', \"', c_mktsegment, '\"')").alias("c_label"),
        "c_nationkey",
    )
    path = scratch_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@check("s2_table_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, sf):
    files.create_view(table(spark, sf, "nation"), "scanned_nation")
    return files.read_table(spark, "scanned_nation").select("n_nationkey", "n_name", "n_regionkey")


@check("s3_overwrite_table", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    path = scratch_path(spark, "overwritten")
    name = "overwritten_" + path.rsplit("-", 1)[1]
    files.overwrite_table(orders.select("o_orderkey", "o_totalprice"), name, path)
    return files.overwrite_table(orders.select("o_orderkey", "o_orderstatus"), name, path)


@check(
    "s4_create_table_as",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL",
)
def _(spark, sf):
    files.create_view(table(spark, sf, "orders"), "orders_to_count")
    path = scratch_path(spark, "counted")
    query = "SELECT o_orderstatus, count(*) AS n FROM orders_to_count GROUP BY o_orderstatus"
    return files.create_table_as(spark, "counted_" + path.rsplit("-", 1)[1], query, path)


@check(
    "s5_create_view",
    "SELECT l_returnflag, sum(cast(l_quantity AS bigint)) AS units FROM lineitem GROUP BY ALL",
)
def _(spark, sf):
    units = F.sum(F.col("l_quantity").cast("bigint")).alias("units")
    view = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(units)
    return files.create_view(view, "units_by_flag")


@check(
    "s6_ingest_dimension",
    """SELECT user_id AS member_id, event_id, epoch_us(ts) // 1000 + 5 * 3600 * 1000 AS created_ms FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id) = 1""",
)
def _(spark, sf):
    stamped = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" -0500"))
    raw = table(spark, sf, "events").select(
        F.col("user_id").alias("USER_ID"),
        F.col("event_id").alias("EVENT_ID"),
        stamped.alias("CREATED_AT"),
    )
    path = scratch_path(spark, "dimension")
    files.write_csv(raw, path)
    rename = {"USER_ID": "member_id", "EVENT_ID": "event_id", "CREATED_AT": "created_at"}
    dim = files.ingest_dimension(files.read_csv(spark, path, raw.schema), rename, ["member_id"])
    return dim.withColumn("created_ms", F.unix_millis("created_at")).drop("created_at")


@check(
    "s8_row_literals",
    """SELECT c_mktsegment, coalesce(code, 'other') AS code, count(*) AS n FROM customer
LEFT JOIN (VALUES ('MACHINERY', 'B2B'), ('BUILDING', 'B2B'), ('HOUSEHOLD', 'B2C'))
  AS codes(segment, code) ON segment = c_mktsegment GROUP BY ALL""",
)
def _(spark, sf):
    codes = files.rows(
        spark,
        [("MACHINERY", "B2B"), ("BUILDING", "B2B"), ("HOUSEHOLD", "B2C")],
        "c_mktsegment string, code string",
    )
    customers = table(spark, sf, "customer").join(codes, "c_mktsegment", "left")
    return customers.groupBy("c_mktsegment", F.coalesce("code", F.lit("other")).alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("s9_preview", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 5")
def _(spark, sf):
    return files.preview(table(spark, sf, "documents").select("doc_id", "source"), 5, ["doc_id"])


@check("s9_row_count", "SELECT count(*) AS total_rows FROM lineitem")
def _(spark, sf):
    return files.row_count(table(spark, sf, "lineitem"))
