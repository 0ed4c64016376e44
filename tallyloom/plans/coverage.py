"""Verified questions over enrolment and population facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import safe_pct, scaled_estimate
from tallyloom.operators.joins import (
    join_aggregates,
    join_dim,
    join_optional,
    territory,
    with_total,
)
from tallyloom.operators.ranking import rank_by, top_n
from tallyloom.session import park


def _lives(name: str = "enrolled_lives") -> Column:
    return F.sum("enrolled_lives").alias(name)


def _population() -> Column:
    return F.sum("population").alias("total_population")


def _rounded_estimate(name: str, rate: str = "0.031") -> Column:
    return F.round(scaled_estimate(F.sum("population"), rate), 0).alias(name)


def _as_double_pct(part: str, whole: str) -> Column:
    return F.round(safe_pct(F.col(part).cast("double"), F.col(whole).cast("double")), 2)


def prevalence_estimate(
    df: DataFrame, keys: Sequence[str], rate: str = "0.031", name: str = "estimated"
) -> DataFrame:
    """Population per key and the unrounded estimate at ``rate``."""
    return df.groupBy(*keys).agg(
        _population(), scaled_estimate(F.sum("population"), rate).alias(name)
    )


def _with_payers(fact: DataFrame, payers: DataFrame, parents: DataFrame) -> DataFrame:
    """Facts with their payer's name and, where there is one, the parent's name."""
    return join_optional(join_dim(fact, payers, "payer_id"), parents, "parent_payer_id")


def covered_lives_by_state(fact_state: DataFrame, dim_state: DataFrame) -> DataFrame:
    return (
        join_dim(fact_state, dim_state, "state_code")
        .groupBy("state_name", "state_code")
        .agg(_lives("total_enrolled_lives"))
        .orderBy(F.desc_nulls_last("total_enrolled_lives"), "state_name")
    )


def covered_lives_by_payer_and_state(
    fact_state: DataFrame, dim_state: DataFrame, payers: DataFrame, parents: DataFrame
) -> DataFrame:
    named = join_dim(fact_state, dim_state, "state_code")
    return (
        _with_payers(named, payers, parents)
        .groupBy("state_name", "payer_name", "parent_payer_name")
        .agg(_lives())
        .orderBy("state_name", F.desc_nulls_last("enrolled_lives"))
    )


def covered_lives_by_clinic(fact_zip: DataFrame, clinic_map: DataFrame) -> DataFrame:
    return (
        territory(fact_zip, clinic_map)
        .groupBy("clinic_name", "state_code")
        .agg(_lives(), F.count_distinct("zip_code").alias("zip_count"))
        .orderBy(F.desc_nulls_last("enrolled_lives"), "clinic_name")
    )


def covered_lives_pct(fact_state: DataFrame, dim_state: DataFrame) -> DataFrame:
    per_state = fact_state.groupBy("state_code").agg(_lives("state_lives"))
    shares = with_total(
        join_dim(per_state, dim_state, "state_code"), fact_state, F.sum("enrolled_lives"), "_total"
    )
    return shares.select(
        "state_name",
        "state_code",
        "state_lives",
        F.round(safe_pct(F.col("state_lives"), F.col("_total")), 2).alias("pct_of_total"),
    ).orderBy(F.desc_nulls_last("pct_of_total"), "state_name")


def covered_lives_by(fact: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Lives by place; ``order`` is the report's order."""
    return fact.groupBy(*keys).agg(_lives()).orderBy(*order)


def covered_lives_by_county(fact_county: DataFrame) -> DataFrame:
    order = ["state_code", F.desc_nulls_last("enrolled_lives")]
    return covered_lives_by(fact_county, ["state_code", "county_name"], order)


def covered_lives_by_msa(fact_msa: DataFrame) -> DataFrame:
    return covered_lives_by(
        fact_msa, ["state_code", "msa_name"], [F.desc_nulls_last("enrolled_lives")]
    )


def _share_of(
    lives: DataFrame, total_from: DataFrame, value: str, name: str = "market_share_pct"
) -> DataFrame:
    """Rounded percentage of all lives in ``total_from``."""
    totalled = with_total(lives, total_from, F.sum("enrolled_lives"), "_total")
    return totalled.withColumn(
        name, F.round(safe_pct(F.col(value), F.col("_total")), 2)
    ).drop("_total")


def payer_market_share(fact_state: DataFrame, payers: DataFrame, parents: DataFrame) -> DataFrame:
    lives = (
        _with_payers(fact_state, payers, parents)
        .groupBy("parent_payer_name", "payer_name")
        .agg(_lives("payer_total"))
    )
    return _share_of(lives, fact_state, "payer_total").orderBy(
        F.desc_nulls_last("market_share_pct"), "payer_name"
    )


def top_payers(
    fact_state: DataFrame, payers: DataFrame, parents: DataFrame, state: str, n: int = 3
) -> DataFrame:
    """The ``n`` payers with most lives in one state and their share of it."""
    local = fact_state.where(F.col("state_code") == state)
    lives = (
        _with_payers(local, payers, parents)
        .groupBy("payer_name", "parent_payer_name")
        .agg(_lives())
    )
    order = [F.desc_nulls_last("enrolled_lives"), "payer_name", "parent_payer_name"]
    return top_n(_share_of(lives, local, "enrolled_lives"), order, n)


def payer_share_ranked(
    fact_state: DataFrame, dim_state: DataFrame, payers: DataFrame, parents: DataFrame
) -> DataFrame:
    """Payers' shares of their state and their rank in it; ties leave gaps."""
    named = join_dim(fact_state, dim_state, "state_code")
    lives = park(
        _with_payers(named, payers, parents)
        .groupBy("state_code", "state_name", "payer_name", "parent_payer_name")
        .agg(_lives("payer_state_lives")),
        "payer-lives",
    )
    totals = fact_state.groupBy("state_code").agg(_lives("_total"))
    ranked = rank_by(lives, "payer_state_lives", "payer_rank", ["state_code"])
    return (
        ranked.join(totals, "state_code")
        .select(
            "state_name",
            "state_code",
            "parent_payer_name",
            "payer_name",
            "payer_state_lives",
            F.round(safe_pct(F.col("payer_state_lives"), F.col("_total")), 2).alias(
                "market_share_pct"
            ),
            "payer_rank",
        )
        .orderBy("state_name", "payer_rank")
    )


def parent_market_share(fact_state: DataFrame, payers: DataFrame, parents: DataFrame) -> DataFrame:
    """Shares by parent; payers without one form a group of their own."""
    lives = (
        _with_payers(fact_state, payers, parents)
        .groupBy("parent_payer_name")
        .agg(_lives("total_lives"))
    )
    return _share_of(lives, fact_state, "total_lives").orderBy(
        F.desc_nulls_last("market_share_pct"), "parent_payer_name"
    )


def estimate_by_state(pop: DataFrame, dim_state: DataFrame) -> DataFrame:
    return (
        join_dim(pop, dim_state, "state_code")
        .groupBy("state_code", "state_name")
        .agg(_population(), _rounded_estimate("estimated_autism_population"))
        .orderBy(F.desc_nulls_last("estimated_autism_population"), "state_code")
    )


def estimate_by_age(pop: DataFrame) -> DataFrame:
    """By age band, in the bands' text order."""
    return (
        pop.groupBy("age_band")
        .agg(_population(), _rounded_estimate("estimated_autism_count"))
        .orderBy("age_band")
    )


def estimate_by_clinic(pop: DataFrame, clinic_map: DataFrame) -> DataFrame:
    return (
        territory(pop, clinic_map)
        .groupBy("clinic_name", "state_code")
        .agg(_population(), _rounded_estimate("estimated_autism_population"))
        .orderBy(F.desc_nulls_last("estimated_autism_population"), "clinic_name")
    )


def estimate_by_age_state(pop: DataFrame, dim_state: DataFrame) -> DataFrame:
    return (
        join_dim(pop, dim_state, "state_code")
        .groupBy("state_name", "state_code", "age_band")
        .agg(_population(), _rounded_estimate("estimated_autism_count"))
        .orderBy("state_name", "age_band")
    )


def coverage_gap(pop: DataFrame, fact_state: DataFrame, dim_state: DataFrame) -> DataFrame:
    """Enrolled lives against the estimate; states missing from either side are left out."""
    both = join_aggregates(
        fact_state, pop, ["state_code"], [_lives()], [_rounded_estimate("estimated_autism_pop")]
    )
    return (
        join_dim(both, dim_state, "state_code")
        .select(
            "state_name",
            "state_code",
            "enrolled_lives",
            "estimated_autism_pop",
            (F.col("estimated_autism_pop") - F.col("enrolled_lives")).alias("coverage_gap"),
            _as_double_pct("enrolled_lives", "estimated_autism_pop").alias("coverage_pct"),
        )
        .orderBy(F.desc_nulls_last("coverage_gap"), "state_code")
    )


def opportunity_by_county(pop: DataFrame, dim_zip: DataFrame, n: int = 25) -> DataFrame:
    """Counties with the highest estimates, by the zip's county and the fact's state."""
    estimates = (
        join_dim(pop, dim_zip.select("zip_code", "county_name"), "zip_code")
        .groupBy("county_name", "state_code")
        .agg(_population(), _rounded_estimate("estimated_autism_pop"))
    )
    order = [F.desc_nulls_last("estimated_autism_pop"), "county_name", "state_code"]
    return top_n(estimates, order, n)


def bcab_ratio(bcab: DataFrame, pop: DataFrame, dim_state: DataFrame) -> DataFrame:
    both = join_aggregates(
        bcab,
        pop,
        ["state_code"],
        [F.sum("bcab_count").alias("total_bcab")],
        [_rounded_estimate("estimated_autism")],
    )
    return (
        join_dim(both, dim_state, "state_code")
        .select(
            "state_name",
            "state_code",
            "total_bcab",
            "estimated_autism",
            _as_double_pct("total_bcab", "estimated_autism").alias("bcab_penetration_pct"),
        )
        .orderBy(F.desc_nulls_last("bcab_penetration_pct"), "state_code")
    )
