"""The metric layer and its verified questions against SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, cte
from tallyloom.operators import joins
from tallyloom.operators.audits import accepted_values, fanout_audit, key_audit, key_summary, orphan_audit
from tallyloom.operators.ranking import top_n
from tallyloom.plans import coverage, metrics, relations
from tallyloom.sources.adapters import coverage_tables

AS_OF = "1998-06-01"
STATE = "N0"

_ZIP = "'Z' || ({0} % 300)"
_STATE = "'N' || (({0} % 300) % 25)"
cte("dim_state", "SELECT 'N' || n_nationkey AS state_code, n_name AS state_name FROM nation")
cte(
    "dim_payers",
    """SELECT s_suppkey AS payer_id, s_name AS payer_name,
  CASE WHEN s_nationkey % 6 <> 0 THEN s_nationkey END AS parent_payer_id FROM supplier""",
)
cte(
    "dim_parent_payer",
    """SELECT n_nationkey AS parent_payer_id, 'Parent ' || n_name AS parent_payer_name
FROM nation WHERE n_regionkey < 4""",
)
cte("dim_payors_aba", "SELECT payer_id AS payor_id, payer_name AS payor_name FROM dim_payers")
cte("zip_numbers", "SELECT DISTINCT c_custkey % 300 AS z FROM customer")
cte(
    "dim_zip",
    """SELECT 'Z' || z AS zip_code, 'N' || (z % 25) AS state_code,
  'County' || (z % 50) AS county_name, 'MSA' || (z % 75) AS msa_name FROM zip_numbers""",
)
cte("dim_county", "SELECT DISTINCT county_name, state_code FROM dim_zip")
cte("dim_msa", "SELECT DISTINCT msa_name, state_code FROM dim_zip")
cte(
    "map_clinic_to_zip",
    """SELECT 'Z' || z AS zip_code, 'N' || (z % 25) AS state_code,
  CASE WHEN z % 10 <> 0 THEN 'Clinic' || (z % 100) END AS clinic_name FROM zip_numbers
UNION ALL SELECT 'Z' || z, 'N' || (z % 25), 'Clinic' || ((z + 25) % 100) FROM zip_numbers
WHERE z % 7 = 0""",
)
cte(
    "dim_clinic",
    """SELECT DISTINCT clinic_name, state_code FROM map_clinic_to_zip
WHERE clinic_name IS NOT NULL""",
)
cte(
    "dim_insured_party",
    f"""SELECT c_custkey AS insured_id, c_name AS last_name, {_ZIP.format("c_custkey")} AS zip_code,
  c_acctbal < 0 AS inactive FROM customer""",
)
cte(
    "fact_zip_enrolled_lives",
    f"""SELECT {_ZIP.format("o_custkey")} AS zip_code, l_suppkey AS payer_id,
  {_STATE.format("o_custkey")} AS state_code, sum(cast(l_quantity AS bigint)) AS enrolled_lives
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""",
)
for _name, _place in (("county", ", county_name"), ("msa", ", msa_name"), ("state", "")):
    cte(
        f"fact_{_name}_enrolled_lives",
        f"""SELECT z.state_code{_place}, payer_id, sum(enrolled_lives) AS enrolled_lives
FROM fact_zip_enrolled_lives f JOIN dim_zip z ON f.zip_code = z.zip_code GROUP BY ALL""",
    )
cte(
    "fact_bcab_counts",
    f"""SELECT {_ZIP.format("user_id")} AS zip_code, event_id % 100 AS payer_id,
  {_STATE.format("user_id")} AS state_code, count(*) AS bcab_count FROM events GROUP BY ALL""",
)
cte(
    "fact_zip_pop_by_age",
    f"""SELECT {_ZIP.format("o_custkey")} AS zip_code, o_orderpriority AS age_band,
  {_STATE.format("o_custkey")} AS state_code, count(*) * 1000 AS population
FROM orders GROUP BY ALL""",
)
cte(
    "fact_insurance_policy",
    f"""SELECT o_orderkey AS policy_id, o_custkey AS insured_id, o_orderkey % 100 AS payer_id,
  {_ZIP.format("o_custkey")} AS zip_code, cast(o_orderdate AS date) AS effective_date,
  CASE WHEN o_orderstatus <> 'O' THEN cast(o_orderdate AS date) + 365 END AS term_date,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS inactive FROM orders""",
)
_ACTIVE = "(inactive = false OR inactive IS NULL)"
_IN_FORCE = (
    f"effective_date <= date '{AS_OF}' AND (term_date IS NULL OR term_date >= date '{AS_OF}')"
)
_ESTIMATE = "cast(sum(population) AS decimal(20,0)) * 0.031"
_WITH_PAYERS = """JOIN dim_payers p ON f.payer_id = p.payer_id
  LEFT JOIN dim_parent_payer pp ON p.parent_payer_id = pp.parent_payer_id"""


def tables(spark, sf):
    return coverage_tables(spark, sf)


def stored(spark, sf):
    return coverage_tables(spark, sf, stored=True)


def _state_fact(t):
    return t["fact_state_enrolled_lives"], t["dim_payers"], t["dim_parent_payer"]


@check(
    "p18_active_filter",
    f"""SELECT 'members' AS kind, count(*) AS n FROM dim_insured_party WHERE {_ACTIVE}
UNION ALL SELECT 'policies', count(*) FROM fact_insurance_policy WHERE {_ACTIVE}""",
)
def _(spark, sf):
    t = tables(spark, sf)

    def active(name, kind):
        rows = t[name].where(metrics.active_only())
        return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))

    return active("dim_insured_party", "members").unionByName(
        active("fact_insurance_policy", "policies")
    )


@check("p19_in_force", f"SELECT * FROM fact_insurance_policy WHERE {_IN_FORCE}")
def _(spark, sf):
    return tables(spark, sf)["fact_insurance_policy"].where(metrics.in_force(AS_OF))


@check(
    "p20_assigned_territory",
    """SELECT state_code, count(*) AS assigned FROM map_clinic_to_zip
WHERE clinic_name IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf):
    assigned = tables(spark, sf)["map_clinic_to_zip"].where(F.col("clinic_name").isNotNull())
    return assigned.groupBy("state_code").agg(F.count(F.lit(1)).alias("assigned"))


@check(
    "j1_inner_join",
    """SELECT f.state_code, state_name, payer_id, enrolled_lives
FROM fact_state_enrolled_lives f JOIN dim_state s ON f.state_code = s.state_code""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return joins.join_dim(t["fact_state_enrolled_lives"], t["dim_state"], "state_code")


@check(
    "j2_optional_parent",
    """SELECT payer_id, payer_name, p.parent_payer_id, parent_payer_name FROM dim_payers p
  LEFT JOIN dim_parent_payer pp ON p.parent_payer_id = pp.parent_payer_id""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return joins.join_optional(t["dim_payers"], t["dim_parent_payer"], "parent_payer_id")


@check(
    "j4_total_on_every_row",
    """SELECT payer_id, enrolled_lives, (SELECT sum(enrolled_lives) FROM fact_state_enrolled_lives)
  AS grand_total FROM fact_state_enrolled_lives""",
)
def _(spark, sf):
    fact = stored(spark, sf)["fact_state_enrolled_lives"]
    return joins.with_total(
        fact.select("payer_id", "enrolled_lives"), fact, F.sum("enrolled_lives"), "grand_total"
    )


@check(
    "j5_two_aggregates",
    """SELECT state_code, lives, cases FROM
  (SELECT state_code, sum(enrolled_lives) AS lives FROM fact_zip_enrolled_lives GROUP BY ALL)
  JOIN (SELECT state_code, sum(bcab_count) AS cases FROM fact_bcab_counts GROUP BY ALL)
  USING (state_code)""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return joins.join_aggregates(
        t["fact_zip_enrolled_lives"],
        t["fact_bcab_counts"],
        ["state_code"],
        [F.sum("enrolled_lives").alias("lives")],
        [F.sum("bcab_count").alias("cases")],
    )


@check(
    "j6_territory",
    """SELECT f.zip_code, m.clinic_name, m.state_code, age_band, population
FROM fact_zip_pop_by_age f JOIN map_clinic_to_zip m ON f.zip_code = m.zip_code
WHERE m.clinic_name IS NOT NULL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return joins.territory(t["fact_zip_pop_by_age"], t["map_clinic_to_zip"])


@check(
    "j7_composite_key",
    """SELECT zip_code, msa_name, state_code FROM dim_zip JOIN dim_msa USING (msa_name, state_code)""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return joins.join_dim(t["dim_zip"], t["dim_msa"], ["msa_name", "state_code"]).select(
        "zip_code", "msa_name", "state_code"
    )


@check(
    "j8_renamed_key",
    """SELECT policy_id, payer_id, payor_name FROM fact_insurance_policy
  LEFT JOIN dim_payors_aba ON payer_id = payor_id""",
)
def _(spark, sf):
    rows = metrics.relate(
        tables(spark, sf), "fact_insurance_policy", ["insurance_policy_to_aba_payors"]
    )
    return rows.select("policy_id", "payer_id", F.col("dim_payors_aba__payor_name").alias("payor_name"))


def _sql_keys(edge, left, right):
    return " AND ".join(f"{left}.{a} = {right}.{b}" for a, b in edge.keys)


# Each starting table with the edges that can be joined in one go from it.
STARS = {
    "fact_zip_enrolled_lives": [
        "zip_lives_to_dim_zip", "zip_to_state", "zip_to_county", "zip_to_msa",
        "zip_lives_to_payers", "payers_to_parent", "zip_lives_to_clinic_map",
        "clinic_map_to_clinic",
    ],
    "fact_county_enrolled_lives": ["county_lives_to_payers", "county_lives_to_county"],
    "fact_msa_enrolled_lives": ["msa_lives_to_payers", "msa_lives_to_msa"],
    "fact_state_enrolled_lives": ["state_lives_to_payers", "state_lives_to_state"],
    "fact_bcab_counts": [
        "bcab_to_clinic_map", "clinic_map_to_zip", "bcab_to_payers",
    ],
    "fact_zip_pop_by_age": ["pop_by_age_to_dim_zip", "pop_by_age_to_clinic_map"],
    "fact_insurance_policy": [
        "insurance_policy_to_insured", "insured_party_to_dim_zip",
        "insurance_policy_to_aba_payors", "aba_payors_to_payers",
    ],
}


# What of a joined table goes into the checksum of its matches.
_SEEN = {
    "dim_zip": ["zip_code", "state_code", "county_name", "msa_name"],
    "dim_state": ["state_code", "state_name"],
    "dim_county": ["county_name", "state_code"],
    "dim_msa": ["msa_name", "state_code"],
    "dim_payers": ["payer_id", "payer_name", "parent_payer_id"],
    "dim_parent_payer": ["parent_payer_id", "parent_payer_name"],
    "dim_clinic": ["clinic_name", "state_code"],
    "map_clinic_to_zip": ["zip_code", "clinic_name"],
    "dim_insured_party": ["insured_id", "last_name", "zip_code"],
    "dim_payors_aba": ["payor_id", "payor_name"],
}


def _star_sql(start: str, edges: list[str]) -> str:
    """Rows of the star and, per joined table, how many found a partner and a checksum of who met whom."""
    found, joined = ["count(*) AS n"], [start]
    for name in edges:
        edge = metrics.RELATIONSHIPS[name]
        met = [f"{edge.left}.{k}" for k, _ in edge.keys] + [f"{edge.right}.{c}" for c in _SEEN[edge.right]]
        checksum = f"sum(('0x' || substr(md5(concat_ws('|', {', '.join(met)})), 1, 8))::bigint)"
        found.append(f"count({edge.right}.{edge.keys[0][1]}) AS {edge.right}")
        found.append(f"cast({checksum} AS bigint) AS {edge.right}_pairs")
        joined.append(f"LEFT JOIN {edge.right} ON {_sql_keys(edge, edge.left, edge.right)}")
    return f"SELECT {', '.join(found)} FROM {' '.join(joined)}"


def _star_query(start: str, edges: list[str]):
    def query(spark, sf):
        rows = metrics.relate(tables(spark, sf), start, edges)
        found = [F.count(F.lit(1)).alias("n")]
        for name in edges:
            edge = metrics.RELATIONSHIPS[name]
            left = "" if edge.left == start else f"{edge.left}__"
            met = [left + k for k, _ in edge.keys] + [f"{edge.right}__{c}" for c in _SEEN[edge.right]]
            number = F.conv(F.substring(F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in met))), 1, 8), 16, 10)
            found.append(F.count(f"{edge.right}__{edge.keys[0][1]}").alias(edge.right))
            found.append(F.sum(number.cast("bigint")).alias(f"{edge.right}_pairs"))
        return rows.agg(*found)

    return query


for _start, _edges in STARS.items():
    check(f"j9_relate_{_start}", _star_sql(_start, _edges))(_star_query(_start, _edges))
# Edges that lead to a table the stars reach another way.
for _name in ("bcab_to_dim_zip", "insurance_policy_to_dim_zip"):
    _edge = metrics.RELATIONSHIPS[_name]
    check(f"j9_relate_{_name}", _star_sql(_edge.left, [_name]))(_star_query(_edge.left, [_name]))


@check(
    "a8_conditional_distinct",
    """SELECT payer_id, count(DISTINCT CASE WHEN enrolled_lives > 0 THEN zip_code END)
  AS zip_count_with_enrollment FROM fact_zip_enrolled_lives GROUP BY ALL""",
)
def _(spark, sf):
    return metrics.metric(tables(spark, sf), ["zip_count_with_enrollment"], ["payer_id"])


@check(
    "a9_conditional_count",
    f"""SELECT payer_id, count(CASE WHEN {_ACTIVE} THEN policy_id END) AS active_policy_count
FROM fact_insurance_policy GROUP BY ALL""",
)
def _(spark, sf):
    return metrics.metric(tables(spark, sf), ["active_policy_count"], ["payer_id"])


@check(
    "a11_grand_total",
    "SELECT sum(enrolled_lives) AS grand_total FROM fact_state_enrolled_lives",
)
def _(spark, sf):
    fact = tables(spark, sf)["fact_state_enrolled_lives"]
    return fact.agg(F.sum("enrolled_lives").alias("grand_total"))


@check(
    "a12_prevalence_estimate",
    f"""SELECT state_code, age_band, sum(population) AS total_population, {_ESTIMATE} AS estimated
FROM fact_zip_pop_by_age GROUP BY ALL""",
)
def _(spark, sf):
    return coverage.prevalence_estimate(
        tables(spark, sf)["fact_zip_pop_by_age"], ["state_code", "age_band"]
    )


def _metric_check(key, names, by, edges, sql, filters=(), how="left"):
    renamed = {c: c.split("__")[-1] for c in by}

    @check(key, sql)
    def _(spark, sf):
        conditions = [f() for f in filters]
        rows = metrics.metric(tables(spark, sf), names, by, edges, conditions, how)
        return rows.withColumnsRenamed(renamed)


_metric_check(
    "m1_metric_by_dimension",
    ["total_enrolled_lives", "avg_enrolled_lives_per_zip"],
    ["dim_zip__msa_name", "dim_payers__payer_name"],
    ["zip_lives_to_dim_zip", "zip_lives_to_payers"],
    """SELECT msa_name, payer_name, sum(enrolled_lives) AS total_enrolled_lives,
  cast(sum(enrolled_lives) AS double) / count(enrolled_lives) AS avg_enrolled_lives_per_zip
FROM fact_zip_enrolled_lives f LEFT JOIN dim_zip z ON f.zip_code = z.zip_code
  LEFT JOIN dim_payers p ON f.payer_id = p.payer_id GROUP BY ALL""",
)
_metric_check(
    "m2_zip_lives_metrics",
    ["total_enrolled_lives", "avg_enrolled_lives_per_zip", "zip_count_with_enrollment"],
    ["state_code"],
    [],
    """SELECT state_code, sum(enrolled_lives) AS total_enrolled_lives,
  cast(sum(enrolled_lives) AS double) / count(enrolled_lives) AS avg_enrolled_lives_per_zip,
  count(DISTINCT CASE WHEN enrolled_lives > 0 THEN zip_code END) AS zip_count_with_enrollment
FROM fact_zip_enrolled_lives GROUP BY ALL""",
)
for _level, _by in (("county", "county_name"), ("msa", "msa_name"), ("state", "state_code")):
    _metric_check(
        f"m2_{_level}_lives_metric",
        [f"total_{_level}_enrolled_lives"],
        [_by],
        [],
        f"""SELECT {_by}, sum(enrolled_lives) AS total_{_level}_enrolled_lives
FROM fact_{_level}_enrolled_lives GROUP BY ALL""",
    )
_metric_check(
    "m2_bcab_metrics",
    ["total_bcab_cases", "avg_bcab_per_zip"],
    ["payer_id"],
    [],
    """SELECT payer_id, sum(bcab_count) AS total_bcab_cases,
  cast(sum(bcab_count) AS double) / count(bcab_count) AS avg_bcab_per_zip
FROM fact_bcab_counts GROUP BY ALL""",
)
_metric_check(
    "m2_population_metrics",
    [
        "total_population",
        "estimated_autism_population",
        "autism_opportunity_above_national_avg",
    ],
    ["age_band"],
    [],
    f"""SELECT age_band, sum(population) AS total_population,
  {_ESTIMATE} AS estimated_autism_population,
  sum(CASE WHEN population > 0 THEN cast(population AS decimal(18,0)) * 0.031 ELSE 0 END)
    AS autism_opportunity_above_national_avg
FROM fact_zip_pop_by_age GROUP BY ALL""",
)
_metric_check(
    "m2_policy_metrics",
    ["total_policies", "active_policy_count"],
    ["dim_zip__state_code"],
    ["insurance_policy_to_dim_zip"],
    f"""SELECT state_code, count(policy_id) AS total_policies,
  count(CASE WHEN {_ACTIVE} THEN policy_id END) AS active_policy_count
FROM fact_insurance_policy f LEFT JOIN dim_zip z ON f.zip_code = z.zip_code GROUP BY ALL""",
)
_metric_check(
    "m4_active_policies_in_force",
    ["total_policies"],
    ["payer_id"],
    [],
    f"""SELECT payer_id, count(policy_id) AS total_policies FROM fact_insurance_policy
WHERE {_ACTIVE} AND {_IN_FORCE} GROUP BY ALL""",
    filters=[
        metrics.NAMED_FILTERS["active_policies_only"],
        lambda: metrics.NAMED_FILTERS["active_policies_today"](AS_OF),
    ],
)


@check(
    "m4_active_members",
    f"SELECT zip_code, count(*) AS members FROM dim_insured_party WHERE {_ACTIVE} GROUP BY ALL",
)
def _(spark, sf):
    members = tables(spark, sf)["dim_insured_party"]
    active = members.where(metrics.NAMED_FILTERS["active_members"]())
    return active.groupBy("zip_code").agg(F.count(F.lit(1)).alias("members"))


@check(
    "m3_payer_market_share_by_state",
    """SELECT state_code, payer_name, sum(enrolled_lives) AS total_state_enrolled_lives,
  sum(enrolled_lives) / nullif(sum(sum(enrolled_lives)) OVER (PARTITION BY state_code), 0) * 100
    AS payer_market_share_by_state
FROM fact_state_enrolled_lives f LEFT JOIN dim_payers p ON f.payer_id = p.payer_id
GROUP BY state_code, payer_name""",
)
def _(spark, sf):
    return metrics.payer_market_share_by_state(stored(spark, sf))


@check(
    "m3_clinic_covered_lives_pct",
    """SELECT clinic_name, sum(enrolled_lives) AS total_enrolled_lives,
  sum(enrolled_lives) / nullif(sum(sum(enrolled_lives)) OVER (), 0) * 100
    AS clinic_covered_lives_pct
FROM fact_zip_enrolled_lives f LEFT JOIN map_clinic_to_zip m ON f.zip_code = m.zip_code
GROUP BY clinic_name""",
)
def _(spark, sf):
    return metrics.clinic_covered_lives_pct(stored(spark, sf))


@check(
    "m3_autism_penetration_rate",
    f"""SELECT state_code, total_enrolled_lives, estimated_autism_population,
  total_enrolled_lives::double / nullif(estimated_autism_population::double, 0) * 100
    AS autism_penetration_rate
FROM (SELECT state_code, sum(enrolled_lives) AS total_enrolled_lives
      FROM fact_zip_enrolled_lives GROUP BY ALL)
JOIN (SELECT state_code, {_ESTIMATE} AS estimated_autism_population
      FROM fact_zip_pop_by_age GROUP BY ALL) USING (state_code)""",
)
def _(spark, sf):
    return metrics.autism_penetration_rate(tables(spark, sf))


@check(
    "n1_covered_lives_by_state",
    """SELECT state_name, f.state_code, sum(enrolled_lives) AS total_enrolled_lives
FROM fact_state_enrolled_lives f JOIN dim_state s ON f.state_code = s.state_code GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.covered_lives_by_state(t["fact_state_enrolled_lives"], t["dim_state"])


@check(
    "n2_covered_lives_by_payer_and_state",
    f"""SELECT state_name, payer_name, parent_payer_name, sum(enrolled_lives) AS enrolled_lives
FROM fact_state_enrolled_lives f JOIN dim_state s ON f.state_code = s.state_code {_WITH_PAYERS}
GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    fact, payers, parents = _state_fact(t)
    return coverage.covered_lives_by_payer_and_state(fact, t["dim_state"], payers, parents)


@check(
    "n3_covered_lives_by_clinic_territory",
    """SELECT m.clinic_name, m.state_code, sum(enrolled_lives) AS enrolled_lives,
  count(DISTINCT f.zip_code) AS zip_count
FROM fact_zip_enrolled_lives f JOIN map_clinic_to_zip m ON f.zip_code = m.zip_code
WHERE m.clinic_name IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.covered_lives_by_clinic(t["fact_zip_enrolled_lives"], t["map_clinic_to_zip"])


@check(
    "n4_covered_lives_pct_by_state",
    """SELECT state_name, state_code, state_lives, round(state_lives
  / (SELECT sum(enrolled_lives) FROM fact_state_enrolled_lives) * 100, 2) AS pct_of_total
FROM (SELECT state_code, sum(enrolled_lives) AS state_lives FROM fact_state_enrolled_lives
      GROUP BY ALL) JOIN dim_state USING (state_code)""",
)
def _(spark, sf):
    t = stored(spark, sf)
    return coverage.covered_lives_pct(t["fact_state_enrolled_lives"], t["dim_state"])


@check(
    "n5_covered_lives_by_county",
    """SELECT state_code, county_name, sum(enrolled_lives) AS enrolled_lives
FROM fact_county_enrolled_lives GROUP BY ALL""",
)
def _(spark, sf):
    return coverage.covered_lives_by_county(tables(spark, sf)["fact_county_enrolled_lives"])


@check(
    "n6_covered_lives_by_msa",
    """SELECT state_code, msa_name, sum(enrolled_lives) AS enrolled_lives
FROM fact_msa_enrolled_lives GROUP BY ALL""",
)
def _(spark, sf):
    return coverage.covered_lives_by_msa(tables(spark, sf)["fact_msa_enrolled_lives"])


_TOTAL = "(SELECT sum(enrolled_lives) FROM fact_state_enrolled_lives)"


@check(
    "n7_payer_market_share",
    f"""SELECT parent_payer_name, payer_name, sum(enrolled_lives) AS payer_total,
  round(sum(enrolled_lives) / {_TOTAL} * 100, 2) AS market_share_pct
FROM fact_state_enrolled_lives f {_WITH_PAYERS} GROUP BY parent_payer_name, payer_name""",
)
def _(spark, sf):
    return coverage.payer_market_share(*_state_fact(stored(spark, sf)))


@check(
    "n8_top_payers_of_state",
    f"""SELECT payer_name, parent_payer_name, sum(enrolled_lives) AS enrolled_lives,
  round(sum(enrolled_lives) / (SELECT sum(enrolled_lives) FROM fact_state_enrolled_lives
    WHERE state_code = '{STATE}') * 100, 2) AS market_share_pct
FROM fact_state_enrolled_lives f {_WITH_PAYERS} WHERE f.state_code = '{STATE}'
GROUP BY payer_name, parent_payer_name
ORDER BY enrolled_lives DESC NULLS LAST, payer_name, parent_payer_name NULLS FIRST LIMIT 3""",
)
def _(spark, sf):
    return coverage.top_payers(*_state_fact(stored(spark, sf)), state=STATE)


@check(
    "n9_payer_share_ranked_in_state",
    f"""SELECT *, round(payer_state_lives / total * 100, 2) AS market_share_pct,
  rank() OVER (PARTITION BY state_code ORDER BY payer_state_lives DESC NULLS LAST) AS payer_rank
FROM (SELECT f.state_code, state_name, payer_name, parent_payer_name,
        sum(enrolled_lives) AS payer_state_lives
      FROM fact_state_enrolled_lives f JOIN dim_state s ON f.state_code = s.state_code
        {_WITH_PAYERS} GROUP BY ALL)
JOIN (SELECT state_code, sum(enrolled_lives) AS total FROM fact_state_enrolled_lives GROUP BY ALL)
  USING (state_code)""".replace("SELECT *, round", "SELECT * EXCLUDE (total), round"),
)
def _(spark, sf):
    t = stored(spark, sf)
    fact, payers, parents = _state_fact(t)
    return coverage.payer_share_ranked(fact, t["dim_state"], payers, parents)


@check(
    "n10_parent_market_share",
    f"""SELECT parent_payer_name, sum(enrolled_lives) AS total_lives,
  round(sum(enrolled_lives) / {_TOTAL} * 100, 2) AS market_share_pct
FROM fact_state_enrolled_lives f {_WITH_PAYERS} GROUP BY parent_payer_name""",
)
def _(spark, sf):
    return coverage.parent_market_share(*_state_fact(stored(spark, sf)))


@check(
    "n11_estimate_by_state",
    f"""SELECT p.state_code, state_name, sum(population) AS total_population,
  round({_ESTIMATE}, 0) AS estimated_autism_population
FROM fact_zip_pop_by_age p JOIN dim_state s ON p.state_code = s.state_code GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.estimate_by_state(t["fact_zip_pop_by_age"], t["dim_state"])


@check(
    "n12_estimate_by_age_band",
    f"""SELECT age_band, sum(population) AS total_population,
  round({_ESTIMATE}, 0) AS estimated_autism_count FROM fact_zip_pop_by_age GROUP BY ALL""",
)
def _(spark, sf):
    return coverage.estimate_by_age(tables(spark, sf)["fact_zip_pop_by_age"])


@check(
    "n13_estimate_by_clinic_territory",
    f"""SELECT clinic_name, m.state_code, sum(population) AS total_population,
  round({_ESTIMATE}, 0) AS estimated_autism_population
FROM fact_zip_pop_by_age p JOIN map_clinic_to_zip m ON p.zip_code = m.zip_code
WHERE clinic_name IS NOT NULL GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.estimate_by_clinic(t["fact_zip_pop_by_age"], t["map_clinic_to_zip"])


@check(
    "n14_estimate_by_age_and_state",
    f"""SELECT state_name, p.state_code, age_band, sum(population) AS total_population,
  round({_ESTIMATE}, 0) AS estimated_autism_count
FROM fact_zip_pop_by_age p JOIN dim_state s ON p.state_code = s.state_code GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.estimate_by_age_state(t["fact_zip_pop_by_age"], t["dim_state"])


_POP = f"""(SELECT state_code, round({_ESTIMATE}, 0) AS estimate FROM fact_zip_pop_by_age
  GROUP BY ALL)"""


@check(
    "n15_coverage_gap_by_state",
    f"""SELECT state_name, state_code, enrolled_lives, estimate AS estimated_autism_pop,
  estimate - enrolled_lives AS coverage_gap,
  round(enrolled_lives::double / nullif(estimate::double, 0) * 100, 2) AS coverage_pct
FROM (SELECT state_code, sum(enrolled_lives) AS enrolled_lives FROM fact_state_enrolled_lives
      GROUP BY ALL) JOIN {_POP} USING (state_code) JOIN dim_state USING (state_code)""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.coverage_gap(
        t["fact_zip_pop_by_age"], t["fact_state_enrolled_lives"], t["dim_state"]
    )


_COUNTIES = f"""SELECT county_name, p.state_code, sum(population) AS total_population,
  round({_ESTIMATE}, 0) AS estimated_autism_pop
FROM fact_zip_pop_by_age p JOIN dim_zip z ON p.zip_code = z.zip_code
GROUP BY county_name, p.state_code
ORDER BY estimated_autism_pop DESC NULLS LAST, county_name, p.state_code LIMIT {{0}}"""


@check("n16_opportunity_by_county", _COUNTIES.format(25))
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.opportunity_by_county(t["fact_zip_pop_by_age"], t["dim_zip"])


@check(
    "n17_bcab_ratio_by_state",
    f"""SELECT state_name, state_code, total_bcab, estimate AS estimated_autism,
  round(total_bcab::double / nullif(estimate::double, 0) * 100, 2) AS bcab_penetration_pct
FROM (SELECT state_code, sum(bcab_count) AS total_bcab FROM fact_bcab_counts GROUP BY ALL)
  JOIN {_POP} USING (state_code) JOIN dim_state USING (state_code)""",
)
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.bcab_ratio(t["fact_bcab_counts"], t["fact_zip_pop_by_age"], t["dim_state"])


@check(
    "o1_total_order",
    """SELECT row_number() OVER (ORDER BY state_code, enrolled_lives DESC NULLS LAST, payer_id)
  AS line, state_code, payer_id, enrolled_lives FROM fact_state_enrolled_lives""",
)
def _(spark, sf):
    from tallyloom.operators.ranking import surrogate_key

    order = ["state_code", F.desc_nulls_last("enrolled_lives"), "payer_id"]
    fact = tables(spark, sf)["fact_state_enrolled_lives"]
    return surrogate_key(fact, order, "line")


@check(
    "o2_top_k_filtered",
    f"""SELECT payer_id, enrolled_lives FROM fact_state_enrolled_lives
WHERE state_code = '{STATE}' ORDER BY enrolled_lives DESC NULLS LAST, payer_id LIMIT 3""",
)
def _(spark, sf):
    fact = tables(spark, sf)["fact_state_enrolled_lives"].where(F.col("state_code") == STATE)
    return top_n(
        fact.select("payer_id", "enrolled_lives"), [F.desc_nulls_last("enrolled_lives"), "payer_id"], 3
    )


@check("o3_top_counties", _COUNTIES.format(10))
def _(spark, sf):
    t = tables(spark, sf)
    return coverage.opportunity_by_county(t["fact_zip_pop_by_age"], t["dim_zip"], 10)


@check(
    "d1_dimension_keys",
    """SELECT zip_code, count(*) AS n, zip_code IS NULL AS is_null FROM map_clinic_to_zip
GROUP BY zip_code HAVING count(*) > 1 OR zip_code IS NULL""",
)
def _(spark, sf):
    return key_audit(tables(spark, sf)["map_clinic_to_zip"], ["zip_code"])


@check(
    "d2_orphans",
    """SELECT clinic_name, state_code, count(*) AS n FROM map_clinic_to_zip m
WHERE NOT EXISTS (SELECT 1 FROM dim_clinic c WHERE c.clinic_name = m.clinic_name
  AND c.state_code = m.state_code) GROUP BY ALL""",
)
def _(spark, sf):
    t = tables(spark, sf)
    keys = metrics.RELATIONSHIPS["clinic_map_to_clinic"].keys
    return orphan_audit(t["map_clinic_to_zip"], t["dim_clinic"], keys)


def _columns(edge, side, alias=""):
    return ", ".join(f"{alias}{pair[side]}" for pair in edge.keys)


def _orphans_sql(name, edge):
    return f"""SELECT '{name}' AS edge, count(*) AS orphan_keys,
  cast(coalesce(sum(n), 0) AS bigint) AS orphan_rows FROM
  (SELECT {_columns(edge, 0)}, count(*) AS n FROM {edge.left} GROUP BY ALL) l
  WHERE NOT EXISTS (SELECT 1 FROM {edge.right} r WHERE {_sql_keys(edge, "l", "r")})"""


def _fanout_sql(name, edge):
    return f"""SELECT '{name}' AS edge, coalesce(max(n), 0) AS max_matches,
  count(*) FILTER (WHERE n > 1) AS keys_with_several FROM
  (SELECT DISTINCT {_columns(edge, 0)} FROM {edge.left}) l
  JOIN (SELECT {_columns(edge, 1)}, count(*) AS n FROM {edge.right} GROUP BY ALL) r
    ON {_sql_keys(edge, "l", "r")}"""


def _every_edge(sql):
    return "\nUNION ALL ".join(sql(name, edge) for name, edge in metrics.RELATIONSHIPS.items())


@check("d2_orphans_by_relationship", _every_edge(_orphans_sql))
def _(spark, sf):
    return relations.orphans_by_edge(stored(spark, sf))


@check(
    "d3_fanout",
    _fanout_sql("zip_lives_to_clinic_map", metrics.RELATIONSHIPS["zip_lives_to_clinic_map"]).replace(
        "'zip_lives_to_clinic_map' AS edge, ", ""
    ),
)
def _(spark, sf):
    t = tables(spark, sf)
    edge = metrics.RELATIONSHIPS["zip_lives_to_clinic_map"]
    return fanout_audit(t[edge.left], t[edge.right], edge.keys)


@check("d3_fanout_by_relationship", _every_edge(_fanout_sql))
def _(spark, sf):
    return relations.fanout_by_edge(stored(spark, sf))


@check(
    "d5_accepted_values",
    """SELECT age_band, count(*) AS n FROM fact_zip_pop_by_age
WHERE age_band NOT IN ('1-URGENT', '2-HIGH') GROUP BY ALL""",
)
def _(spark, sf):
    pop = tables(spark, sf)["fact_zip_pop_by_age"]
    return accepted_values(pop, "age_band", ["1-URGENT", "2-HIGH"])


# Columns that the metric model declares unique.
_UNIQUE = {
    "dim_zip": "zip_code",
    "dim_state": "state_code",
    "dim_payers": "payer_id",
    "dim_parent_payer": "parent_payer_id",
    "dim_insured_party": "insured_id",
    "dim_payors_aba": "payor_id",
    "fact_insurance_policy": "policy_id",
}


def _unique_check(name, key):
    @check(
        f"d1_unique_in_{name}",
        f"""SELECT cast(sum(n) AS bigint) AS key_rows, count(*) AS distinct_keys,
  count(*) FILTER (WHERE n > 1) AS repeated_keys, count(*) FILTER (WHERE {key} IS NULL) AS null_keys
FROM (SELECT {key}, count(*) AS n FROM {name} GROUP BY {key})""",
    )
    def _(spark, sf):
        return key_summary(tables(spark, sf)[name], [key])


for _name, _key in _UNIQUE.items():
    _unique_check(_name, _key)
