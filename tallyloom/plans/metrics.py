"""The metric layer: logical tables, named relationships, metrics and filters as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import mean, safe_pct, scaled_estimate
from tallyloom.operators.ranking import share_of_partition, share_of_total

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Edge:
    """A many-to-one equi-join between two logical tables."""

    left: str
    right: str
    keys: tuple[tuple[str, str], ...]


def _edge(left: str, right: str, *keys: str | tuple[str, str]) -> Edge:
    return Edge(left, right, tuple((k, k) if isinstance(k, str) else k for k in keys))


# The names and key columns of the model's relationships. zip_to_county joins on
# the county's name; the model's own pairing of a zip code with a county name matches nothing.
RELATIONSHIPS: dict[str, Edge] = {
    "zip_to_state": _edge("dim_zip", "dim_state", "state_code"),
    "zip_to_county": _edge("dim_zip", "dim_county", "county_name", "state_code"),
    "zip_to_msa": _edge("dim_zip", "dim_msa", "msa_name", "state_code"),
    "clinic_map_to_zip": _edge("map_clinic_to_zip", "dim_zip", "zip_code"),
    "clinic_map_to_clinic": _edge("map_clinic_to_zip", "dim_clinic", "clinic_name", "state_code"),
    "payers_to_parent": _edge("dim_payers", "dim_parent_payer", "parent_payer_id"),
    "aba_payors_to_payers": _edge("dim_payors_aba", "dim_payers", ("payor_id", "payer_id")),
    "zip_lives_to_dim_zip": _edge("fact_zip_enrolled_lives", "dim_zip", "zip_code"),
    "zip_lives_to_payers": _edge("fact_zip_enrolled_lives", "dim_payers", "payer_id"),
    "zip_lives_to_clinic_map": _edge("fact_zip_enrolled_lives", "map_clinic_to_zip", "zip_code"),
    "county_lives_to_payers": _edge("fact_county_enrolled_lives", "dim_payers", "payer_id"),
    "county_lives_to_county": _edge(
        "fact_county_enrolled_lives", "dim_county", "county_name", "state_code"
    ),
    "msa_lives_to_payers": _edge("fact_msa_enrolled_lives", "dim_payers", "payer_id"),
    "msa_lives_to_msa": _edge("fact_msa_enrolled_lives", "dim_msa", "msa_name", "state_code"),
    "state_lives_to_payers": _edge("fact_state_enrolled_lives", "dim_payers", "payer_id"),
    "state_lives_to_state": _edge("fact_state_enrolled_lives", "dim_state", "state_code"),
    "bcab_to_dim_zip": _edge("fact_bcab_counts", "dim_zip", "zip_code"),
    "bcab_to_payers": _edge("fact_bcab_counts", "dim_payers", "payer_id"),
    "bcab_to_clinic_map": _edge("fact_bcab_counts", "map_clinic_to_zip", "zip_code"),
    "pop_by_age_to_dim_zip": _edge("fact_zip_pop_by_age", "dim_zip", "zip_code"),
    "pop_by_age_to_clinic_map": _edge("fact_zip_pop_by_age", "map_clinic_to_zip", "zip_code"),
    "insurance_policy_to_insured": _edge(
        "fact_insurance_policy", "dim_insured_party", "insured_id"
    ),
    "insurance_policy_to_aba_payors": _edge(
        "fact_insurance_policy", "dim_payors_aba", ("payer_id", "payor_id")
    ),
    "insurance_policy_to_dim_zip": _edge("fact_insurance_policy", "dim_zip", "zip_code"),
    "insured_party_to_dim_zip": _edge("dim_insured_party", "dim_zip", "zip_code"),
}


def active_only() -> Column:
    """Not marked inactive; a missing mark counts as active."""
    return (~F.col("inactive")) | F.col("inactive").isNull()


def in_force(as_of: date | str | Column | None = None) -> Column:
    """Effective by ``as_of`` and not terminated before it; today unless a date is given."""
    day = F.current_date() if as_of is None else as_of
    day = day if isinstance(day, Column) else F.lit(day).cast("date")
    return (F.col("effective_date") <= day) & (
        F.col("term_date").isNull() | (F.col("term_date") >= day)
    )


NAMED_FILTERS: dict[str, Callable[..., Column]] = {
    "active_members": active_only,
    "active_policies_only": active_only,
    "active_policies_today": in_force,
}


@dataclass(frozen=True)
class Metric:
    """An aggregate over one logical table."""

    table: str
    build: Callable[[], Column]


def _opportunity() -> Column:
    estimate = scaled_estimate(F.col("population").cast("decimal(20,0)"))
    return F.sum(F.when(F.col("population") > 0, estimate).otherwise(0))


TABLE_METRICS: dict[str, Metric] = {
    "total_enrolled_lives": Metric("fact_zip_enrolled_lives", lambda: F.sum("enrolled_lives")),
    "avg_enrolled_lives_per_zip": Metric("fact_zip_enrolled_lives", lambda: mean("enrolled_lives")),
    "zip_count_with_enrollment": Metric(
        "fact_zip_enrolled_lives",
        lambda: F.count_distinct(F.when(F.col("enrolled_lives") > 0, F.col("zip_code"))),
    ),
    "total_county_enrolled_lives": Metric(
        "fact_county_enrolled_lives", lambda: F.sum("enrolled_lives")
    ),
    "total_msa_enrolled_lives": Metric("fact_msa_enrolled_lives", lambda: F.sum("enrolled_lives")),
    "total_state_enrolled_lives": Metric(
        "fact_state_enrolled_lives", lambda: F.sum("enrolled_lives")
    ),
    "total_bcab_cases": Metric("fact_bcab_counts", lambda: F.sum("bcab_count")),
    "avg_bcab_per_zip": Metric("fact_bcab_counts", lambda: mean("bcab_count")),
    "total_population": Metric("fact_zip_pop_by_age", lambda: F.sum("population")),
    "estimated_autism_population": Metric(
        "fact_zip_pop_by_age", lambda: scaled_estimate(F.sum("population"))
    ),
    "autism_opportunity_above_national_avg": Metric("fact_zip_pop_by_age", _opportunity),
    "total_policies": Metric("fact_insurance_policy", lambda: F.count("policy_id")),
    "active_policy_count": Metric(
        "fact_insurance_policy", lambda: F.count(F.when(active_only(), F.col("policy_id")))
    ),
}


def relate(tables: Tables, fact: str, edges: Sequence[str], how: str = "left") -> DataFrame:
    """A table joined along named relationships.

    The starting table keeps its column names; a joined table's columns are named
    ``table__column``. An edge may start from the first table or any table joined before it.
    """
    joined = tables[fact]
    reached = {fact: ""}
    for name in edges:
        edge = RELATIONSHIPS[name]
        if edge.left not in reached:
            raise ValueError(f"{name} starts from {edge.left}, which is not joined yet")
        if edge.right in reached:
            raise ValueError(f"{name} leads to {edge.right}, which is joined already")
        prefix = f"{edge.right}__"
        right = tables[edge.right]
        right = right.withColumnsRenamed({c: prefix + c for c in right.columns})
        condition = reduce(
            Column.__and__,
            (F.col(reached[edge.left] + a) == F.col(prefix + b) for a, b in edge.keys),
        )
        joined = joined.join(right, condition, how)
        reached[edge.right] = prefix
    return joined


def metric(
    tables: Tables,
    names: Sequence[str],
    by: Sequence[str] = (),
    edges: Sequence[str] = (),
    filters: Sequence[Column] = (),
    how: str = "left",
) -> DataFrame:
    """Named metrics of one fact, grouped by its columns or by ``table__column`` of joined tables."""
    facts = {TABLE_METRICS[name].table for name in names}
    if len(facts) != 1:
        raise ValueError(f"metrics of one call must share a table, got {sorted(facts)}")
    rows = relate(tables, facts.pop(), edges, how)
    for condition in filters:
        rows = rows.where(condition)
    aggregates = [TABLE_METRICS[name].build().alias(name) for name in names]
    return rows.groupBy(*by).agg(*aggregates) if by else rows.agg(*aggregates)


def payer_market_share_by_state(tables: Tables) -> DataFrame:
    """Each payer's percentage of its state's enrolled lives."""
    name = "total_state_enrolled_lives"
    lives = metric(
        tables, [name], ["state_code", "dim_payers__payer_name"], ["state_lives_to_payers"]
    ).withColumnRenamed("dim_payers__payer_name", "payer_name")
    return share_of_partition(lives, ["state_code"], name, "payer_market_share_by_state")


def clinic_covered_lives_pct(tables: Tables) -> DataFrame:
    """Each clinic territory's percentage of the lives of all territories."""
    name = "total_enrolled_lives"
    lives = metric(
        tables, [name], ["map_clinic_to_zip__clinic_name"], ["zip_lives_to_clinic_map"]
    ).withColumnRenamed("map_clinic_to_zip__clinic_name", "clinic_name")
    return share_of_total(lives, name, "clinic_covered_lives_pct")


def autism_penetration_rate(tables: Tables, by: Sequence[str] = ("state_code",)) -> DataFrame:
    """Enrolled lives as a percentage of the estimate; each fact is aggregated before the join."""
    lives = metric(tables, ["total_enrolled_lives"], by)
    estimate = metric(tables, ["estimated_autism_population"], by)
    share = safe_pct(
        F.col("total_enrolled_lives").cast("double"),
        F.col("estimated_autism_population").cast("double"),
    )
    return lives.join(estimate, list(by)).withColumn("autism_penetration_rate", share)
