"""The verified questions asked by names alone, against the oracles of the written-out plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import metric_checks
from checks.registry import ORACLES, QUERIES
from tallyloom.functions.numeric import safe_pct
from tallyloom.operators.joins import with_total
from tallyloom.operators.ranking import rank_by, top_n
from tallyloom.plans.paths import ask
from tallyloom.session import park

_LIVES, _PEOPLE, _CASES, _ESTIMATE = "total_state_enrolled_lives", "total_population", "total_bcab_cases", "estimated_autism_population"
_GIVEN = {"state_name": F.isnotnull}


def _by_names(key):
    """Register a query over the metric tables under ``m1_names_<key>`` with the oracle of ``key``."""

    def register(query):
        oracle = next(k for k in ORACLES if k.startswith(f"{key}_"))
        QUERIES[f"m1_names_{key}"] = lambda spark, sf: query(metric_checks.stored(spark, sf))
        ORACLES[f"m1_names_{key}"] = ORACLES[oracle]

    return register


def _share(df, value, total=None, name="market_share_pct"):
    totalled = with_total(df, df if total is None else total, F.sum(value), "_total")
    return totalled.withColumn(name, F.round(safe_pct(F.col(value), F.col("_total")), 2)).drop("_total")


def _rounded(df, name, old=_ESTIMATE):
    return df.withColumn(old, F.round(old, 0)).withColumnRenamed(old, name)


@_by_names("n1")
def _(t):
    return ask(t, [_LIVES], ["state_name", "state_code"], _GIVEN).withColumnRenamed(_LIVES, "total_enrolled_lives")


@_by_names("n2")
def _(t):
    by = ["state_name", "payer_name", "parent_payer_name"]
    return ask(t, [_LIVES], by, _GIVEN).withColumnRenamed(_LIVES, "enrolled_lives")


@_by_names("n3")
def _(t):
    by = ["clinic_name", "map_clinic_to_zip.state_code"]
    found = ask(t, ["total_enrolled_lives", "zip_count_with_enrollment"], by, {"clinic_name": F.isnotnull})
    return found.withColumnsRenamed({"total_enrolled_lives": "enrolled_lives", "zip_count_with_enrollment": "zip_count"})


@_by_names("n4")
def _(t):
    lives = ask(t, [_LIVES], ["state_code", "state_name"], _GIVEN).withColumnRenamed(_LIVES, "state_lives")
    total = ask(t, [_LIVES]).withColumnRenamed(_LIVES, "state_lives")
    return _share(lives, "state_lives", total, "pct_of_total")


@_by_names("n5")
def _(t):
    found = ask(t, ["total_county_enrolled_lives"], ["state_code", "county_name"])
    return found.withColumnRenamed("total_county_enrolled_lives", "enrolled_lives")


@_by_names("n6")
def _(t):
    found = ask(t, ["total_msa_enrolled_lives"], ["state_code", "msa_name"])
    return found.withColumnRenamed("total_msa_enrolled_lives", "enrolled_lives")


@_by_names("n7")
def _(t):
    return _share(ask(t, [_LIVES], ["parent_payer_name", "payer_name"]).withColumnRenamed(_LIVES, "payer_total"), "payer_total")


@_by_names("n8")
def _(t):
    mine = {"state_code": lambda c: c == metric_checks.STATE}
    lives = ask(t, [_LIVES], ["payer_name", "parent_payer_name"], mine).withColumnRenamed(_LIVES, "enrolled_lives")
    order = [F.desc_nulls_last("enrolled_lives"), "payer_name", F.asc_nulls_first("parent_payer_name")]
    return top_n(_share(lives, "enrolled_lives"), order, 3)


@_by_names("n9")
def _(t):
    by = ["state_code", "state_name", "payer_name", "parent_payer_name"]
    lives = ask(t, [_LIVES], by, _GIVEN).withColumnRenamed(_LIVES, "payer_state_lives")
    totals = ask(t, [_LIVES], ["state_code"]).withColumnRenamed(_LIVES, "_total")
    shares = lives.join(totals, "state_code").withColumn(
        "market_share_pct", F.round(safe_pct(F.col("payer_state_lives"), F.col("_total")), 2)
    )
    return rank_by(park(shares.drop("_total"), "shares"), "payer_state_lives", "payer_rank", ["state_code"])


@_by_names("n10")
def _(t):
    return _share(ask(t, [_LIVES], ["parent_payer_name"]).withColumnRenamed(_LIVES, "total_lives"), "total_lives")


@_by_names("n11")
def _(t):
    return _rounded(ask(t, [_PEOPLE, _ESTIMATE], ["state_code", "state_name"], _GIVEN), _ESTIMATE)


@_by_names("n12")
def _(t):
    return _rounded(ask(t, [_PEOPLE, _ESTIMATE], ["age_band"]), "estimated_autism_count")


@_by_names("n13")
def _(t):
    by = ["clinic_name", "map_clinic_to_zip.state_code"]
    return _rounded(ask(t, [_PEOPLE, _ESTIMATE], by, {"clinic_name": F.isnotnull}), _ESTIMATE)


@_by_names("n14")
def _(t):
    return _rounded(ask(t, [_PEOPLE, _ESTIMATE], ["state_name", "state_code", "age_band"], _GIVEN), "estimated_autism_count")


def _against_estimate(t, metric, name, estimate, share):
    both = ask(t, [metric, _ESTIMATE], ["state_name", "state_code"], _GIVEN).where(f"{metric} is not null and {_ESTIMATE} is not null")
    both = _rounded(both.withColumnRenamed(metric, name), estimate)
    return both.withColumn(share, F.round(safe_pct(F.col(name).cast("double"), F.col(estimate).cast("double")), 2))


@_by_names("n15")
def _(t):
    both = _against_estimate(t, _LIVES, "enrolled_lives", "estimated_autism_pop", "coverage_pct")
    return both.withColumn("coverage_gap", F.col("estimated_autism_pop") - F.col("enrolled_lives"))


@_by_names("n16")
def _(t):
    found = _rounded(ask(t, [_PEOPLE, _ESTIMATE], ["dim_zip.county_name", "state_code"]), "estimated_autism_pop")
    return top_n(found, [F.desc_nulls_last("estimated_autism_pop"), "county_name", "state_code"], 25)


@_by_names("n17")
def _(t):
    return _against_estimate(t, _CASES, "total_bcab", "estimated_autism", "bcab_penetration_pct")
