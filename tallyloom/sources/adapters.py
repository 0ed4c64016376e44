"""Inputs of the marts and the metric layer, derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.plans.metrics import Tables
from tallyloom.session import park

_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its schema is read from the file once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales transactions from line items and what they refer to.

    Orders meet their customers before they meet the line items, so the largest table is
    shuffled for orders and parts only. Each right side is a plain scan, whose size Spark knows.
    """
    placed_orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    )
    sales = (
        table(spark, sf_dir, "lineitem")
        .join(placed_orders, F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    )
    return sales.selectExpr(
        "l_orderkey * 10 + l_linenumber AS transaction_id",
        "cast(o_orderdate AS date) AS transaction_date",
        "cast(date_format(o_orderdate, 'yyyyMMdd') AS int) AS date_id",
        "month(o_orderdate) AS month",
        "concat('Q', quarter(o_orderdate)) AS quarter",
        "CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B2B'"
        " WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'B2C' END AS customer_type",
        "c_name AS sold_to_customer_name",
        "c_mktsegment AS end_user",
        "n_name AS country",
        "r_name AS region",
        "concat('S', c_custkey % 7) AS state",
        "concat('C', c_custkey % 13) AS city",
        "concat('SKU-', p_partkey) AS product_sku",
        "p_name AS product_name",
        "p_type AS category",
        "p_brand AS brand",
        "CASE WHEN l_linenumber = 7 THEN 0 ELSE cast(l_quantity AS int) END AS quantity",
        "cast(p_retailprice AS decimal(18,2)) AS unit_price",
        "CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 1)"
        " THEN cast(l_extendedprice AS decimal(18,2)) END AS total_amount",
        "'USD' AS currency",
    )


def _zip(key: str) -> Column:
    return F.expr(f"concat('Z', {key} % 300)")


def _state_of(key: str) -> Column:
    return F.expr(f"concat('N', ({key} % 300) % 25)")


class LazyTables(Mapping):
    """Logical tables by name, each built when first asked for.

    With ``stored`` a fact is also written to the scratch folder, for queries that read one
    derived fact several times, as they would a stored table.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], stored: bool = False):
        self._builders = builders
        self._stored = stored
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._builders[name]()
            parked = self._stored and name.startswith("fact_")
            self._built[name] = park(df, name) if parked else df
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


_CLINICS = """CASE WHEN z % 7 = 0
  THEN array(CASE WHEN z % 10 <> 0 THEN concat('Clinic', z % 100) END,
             concat('Clinic', (z + 25) % 100))
  ELSE array(CASE WHEN z % 10 <> 0 THEN concat('Clinic', z % 100) END) END"""
_LIVES = "sum(enrolled_lives) AS enrolled_lives"


def coverage_tables(spark: SparkSession, sf_dir: str, stored: bool = False) -> Tables:
    """All logical tables of the metric layer."""

    def read(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    def payers() -> DataFrame:
        return read("supplier").selectExpr(
            "s_suppkey AS payer_id",
            "s_name AS payer_name",
            "CASE WHEN s_nationkey % 6 <> 0 THEN s_nationkey END AS parent_payer_id",
        )

    def parents() -> DataFrame:
        return (
            read("nation")
            .where("n_regionkey < 4")
            .selectExpr(
                "n_nationkey AS parent_payer_id", "concat('Parent ', n_name) AS parent_payer_name"
            )
        )

    def zip_numbers() -> DataFrame:
        return read("customer").selectExpr("c_custkey % 300 AS z").distinct()

    def zips() -> DataFrame:
        return zip_numbers().selectExpr(
            "concat('Z', z) AS zip_code",
            "concat('N', z % 25) AS state_code",
            "concat('County', z % 50) AS county_name",
            "concat('MSA', z % 75) AS msa_name",
        )

    def clinic_map() -> DataFrame:
        return zip_numbers().selectExpr(
            "concat('Z', z) AS zip_code",
            "concat('N', z % 25) AS state_code",
            f"explode({_CLINICS}) AS clinic_name",
        )

    def zip_lives() -> DataFrame:
        return (
            read("lineitem")
            .join(read("orders"), F.expr("l_orderkey = o_orderkey"))
            .groupBy(
                _zip("o_custkey").alias("zip_code"),
                F.col("l_suppkey").alias("payer_id"),
                _state_of("o_custkey").alias("state_code"),
            )
            .agg(F.expr("sum(cast(l_quantity AS bigint)) AS enrolled_lives"))
        )

    def lives_by(*place: str) -> DataFrame:
        # Stored lives are read back; the line items need not meet their orders again for each place.
        lives = facts["fact_zip_enrolled_lives"] if stored else zip_lives()
        placed = lives.drop("state_code").join(zips(), "zip_code")
        return placed.groupBy("state_code", *place, "payer_id").agg(F.expr(_LIVES))

    def cases() -> DataFrame:
        return (
            read("events")
            .groupBy(
                _zip("user_id").alias("zip_code"),
                F.expr("event_id % 100").alias("payer_id"),
                _state_of("user_id").alias("state_code"),
            )
            .agg(F.expr("count(*) AS bcab_count"))
        )

    def population() -> DataFrame:
        return (
            read("orders")
            .groupBy(
                _zip("o_custkey").alias("zip_code"),
                F.col("o_orderpriority").alias("age_band"),
                _state_of("o_custkey").alias("state_code"),
            )
            .agg(F.expr("count(*) * 1000 AS population"))
        )

    def policies() -> DataFrame:
        return read("orders").selectExpr(
            "o_orderkey AS policy_id",
            "o_custkey AS insured_id",
            "o_orderkey % 100 AS payer_id",
            "concat('Z', o_custkey % 300) AS zip_code",
            "cast(o_orderdate AS date) AS effective_date",
            "CASE WHEN o_orderstatus <> 'O' THEN date_add(cast(o_orderdate AS date), 365) END"
            " AS term_date",
            "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS inactive",
        )

    facts = LazyTables(
        {
            "dim_state": lambda: read("nation").selectExpr(
                "concat('N', n_nationkey) AS state_code", "n_name AS state_name"
            ),
            "dim_payers": payers,
            "dim_parent_payer": parents,
            "dim_payors_aba": lambda: payers().selectExpr(
                "payer_id AS payor_id", "payer_name AS payor_name"
            ),
            "dim_zip": zips,
            "dim_county": lambda: zips().select("county_name", "state_code").distinct(),
            "dim_msa": lambda: zips().select("msa_name", "state_code").distinct(),
            "dim_clinic": lambda: clinic_map()
            .where("clinic_name IS NOT NULL")
            .select("clinic_name", "state_code")
            .distinct(),
            "map_clinic_to_zip": clinic_map,
            "dim_insured_party": lambda: read("customer").selectExpr(
                "c_custkey AS insured_id",
                "c_name AS last_name",
                "concat('Z', c_custkey % 300) AS zip_code",
                "c_acctbal < 0 AS inactive",
            ),
            "fact_zip_enrolled_lives": zip_lives,
            "fact_county_enrolled_lives": lambda: lives_by("county_name"),
            "fact_msa_enrolled_lives": lambda: lives_by("msa_name"),
            "fact_state_enrolled_lives": lives_by,
            "fact_bcab_counts": cases,
            "fact_zip_pop_by_age": population,
            "fact_insurance_policy": policies,
        },
        stored,
    )
    return facts


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document rows: one per text, typed by parity of its id."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("file_name"),
        F.expr("concat('doc://', doc_id)").alias("source_url"),
        F.expr("CASE WHEN doc_id % 2 = 0 THEN 'product_spec' ELSE 'discount_policy' END").alias(
            "doc_type"
        ),
        F.col("text").alias("raw_content"),
        F.current_timestamp().alias("ingested_at"),
    )


def embedded_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored vectors as chunks, all of them."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"),
        F.expr("concat('file', label)").alias("file_name"),
        F.expr("concat('doc://', vec_id)").alias("source_url"),
        F.expr("CASE WHEN label % 2 = 0 THEN 'product_spec' ELSE 'discount_policy' END").alias(
            "doc_type"
        ),
        F.expr("concat('entry ', vec_id)").alias("chunk_text"),
        "embedding",
    )


# What the last line of each document of the answers' corpus says of a product or a discount, in SQL
# for both engines. None speaks of the tee or of an item without a name.
_PRODUCT = """CASE (doc_id - doc_id % 8) % 48 WHEN 0 THEN 'Laptop 14' WHEN 8 THEN '5G Smartphone'
  WHEN 16 THEN 'Drillmaster Power Drill' WHEN 24 THEN 'Kitchen Set' WHEN 32 THEN 'Classic Jeans'
  ELSE 'Hand Tool Set' END"""
CORPUS_LINE = f"""CASE doc_id % 8
  WHEN 0 THEN concat({_PRODUCT}, ' warranty of ', doc_id % 5 + 1, ' years with support and replacement')
  WHEN 2 THEN concat({_PRODUCT}, ' certifications: meets ISO standard ', doc_id % 50)
  WHEN 4 THEN concat({_PRODUCT}, ' technical specifications: memory of ', doc_id % 64, ' and battery')
  WHEN 6 THEN concat('Notes on ', {_PRODUCT})
  ELSE concat('Category ', doc_id % 9, ' volume discount of ', doc_id % 30,
    ' percent in region Region ', doc_id % 9) END"""


def answer_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the answers: every document, its text followed by a line on a product or a discount."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"),
        F.col("source").alias("file_name"),
        F.expr("concat('doc://', doc_id)").alias("source_url"),
        F.expr("CASE WHEN doc_id % 2 = 0 THEN 'product_spec' ELSE 'discount_policy' END").alias(
            "doc_type"
        ),
        F.concat("text", F.lit("\n"), F.expr(CORPUS_LINE)).alias("chunk_text"),
    )


# Products asked about, by label; further labels ask about a product without markers.
PRODUCTS = [
    "Laptop 14", "5G Smartphone", "Power Drill", "Kitchen Set", "Classic Jeans", "Classic Tee",
    "Hand Tool Set",
]


def label_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per label, with the vector of the label's first entry and all arguments."""
    names = F.array(*(F.lit(name) for name in PRODUCTS))
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.min_by("embedding", "vec_id").alias("qvec"))
        .withColumn(
            "product_keyword",
            F.coalesce(F.get(names, F.col("query_id")), F.expr("concat('Item ', query_id)")),
        )
        .withColumn("query_text", F.expr("concat('about ', query_id)"))
        .withColumn(
            "doc_type", F.expr("elt(query_id % 3 + 1, 'product_spec', 'discount_policy', 'All')")
        )
        .withColumn("category_name", F.expr("concat('Category ', query_id)"))
        .withColumn("region_name", F.expr("concat('Region ', query_id)"))
    )
