from datetime import date

import pytest

from pyspark.sql import functions as F

from tallyloom.plans import coverage, metrics, relations


@pytest.fixture(scope="module")
def tables(spark):
    def frame(data, schema):
        return spark.createDataFrame(data, schema).cache()

    lives = [("GA", 1, 60), ("GA", 2, 60), ("GA", 3, 30), ("FL", 1, 50), ("XX", 1, 100)]
    return {
        "dim_state": frame([("GA", "Georgia"), ("FL", "Florida"), ("TX", "Texas")],
                           "state_code string, state_name string"),
        "dim_payers": frame([(1, "One", 10), (2, "Two", None), (3, "Three", 99)],
                            "payer_id int, payer_name string, parent_payer_id int"),
        "dim_parent_payer": frame([(10, "Ten"), (11, "Eleven")],
                                  "parent_payer_id int, parent_payer_name string"),
        "fact_state_enrolled_lives": frame(lives, "state_code string, payer_id int, enrolled_lives long"),
        "fact_zip_enrolled_lives": frame(
            [("z1", "GA", 1, 60), ("z1", "GA", 2, 0), ("z2", "GA", 1, 40), ("z3", "FL", 1, 7)],
            "zip_code string, state_code string, payer_id int, enrolled_lives long"),
        "map_clinic_to_zip": frame(
            [("z1", "GA", "North"), ("z1", "GA", "South"), ("z2", "GA", "North"), ("z3", "FL", None)],
            "zip_code string, state_code string, clinic_name string"),
        "fact_zip_pop_by_age": frame(
            [("z1", "0-4", "GA", 1000), ("z2", "10-14", "GA", 516), ("z3", "5-9", "FL", 0)],
            "zip_code string, age_band string, state_code string, population long"),
        "dim_zip": frame([("z1", "GA", "Dade"), ("z2", "GA", "Dade"), ("z3", "FL", "Dade")],
                         "zip_code string, state_code string, county_name string"),
        "fact_bcab_counts": frame([("GA", 5), ("GA", 6), ("TX", 1)], "state_code string, bcab_count long"),
        "fact_insurance_policy": frame(
            [(1, True, date(2024, 1, 1), None), (2, False, date(2024, 1, 1), date(2024, 6, 1)),
             (3, None, date(2024, 6, 1), date(2024, 12, 31)), (4, None, date(2024, 6, 2), None)],
            "policy_id int, inactive boolean, effective_date date, term_date date"),
    }


def test_unmatched_states_and_parents(tables, rows):
    t = tables
    by_state = coverage.covered_lives_by_state(t["fact_state_enrolled_lives"], t["dim_state"])
    assert rows(by_state) == [("Florida", "FL", 50), ("Georgia", "GA", 150)]
    parents = coverage.parent_market_share(
        t["fact_state_enrolled_lives"], t["dim_payers"], t["dim_parent_payer"]
    )
    assert rows(parents) == [("Ten", 210, 70.0), (None, 90, 30.0)]


def test_top_payers_break_ties_by_name(tables):
    t = tables
    top = coverage.top_payers(
        t["fact_state_enrolled_lives"], t["dim_payers"], t["dim_parent_payer"], "GA", 2
    )
    assert [tuple(r) for r in top.collect()] == [("One", "Ten", 60, 40.0), ("Two", None, 60, 40.0)]


def test_rank_leaves_a_gap_after_ties(tables, rows):
    t = tables
    ranked = coverage.payer_share_ranked(
        t["fact_state_enrolled_lives"], t["dim_state"], t["dim_payers"], t["dim_parent_payer"]
    )
    assert rows(ranked, "state_code", "payer_name", "market_share_pct", "payer_rank") == [
        ("FL", "One", 100.0, 1),
        ("GA", "One", 40.0, 1),
        ("GA", "Three", 20.0, 3),
        ("GA", "Two", 40.0, 1),
    ]


def test_shared_zips_count_for_every_clinic(tables, rows):
    t = tables
    lives = coverage.covered_lives_by_clinic(t["fact_zip_enrolled_lives"], t["map_clinic_to_zip"])
    assert rows(lives) == [("North", "GA", 100, 2), ("South", "GA", 60, 1)]


def test_estimates_and_gap(tables, rows):
    t = tables
    by_age = coverage.estimate_by_age(t["fact_zip_pop_by_age"])
    assert [(r[0], r[1], int(r[2])) for r in by_age.collect()] == [
        ("0-4", 1000, 31), ("10-14", 516, 16), ("5-9", 0, 0),
    ]
    gap = coverage.coverage_gap(
        t["fact_zip_pop_by_age"], t["fact_state_enrolled_lives"], t["dim_state"]
    )
    found = {r.state_code: (int(r.estimated_autism_pop), int(r.coverage_gap), r.coverage_pct) for r in gap.collect()}
    assert found == {"GA": (47, -103, 319.15), "FL": (0, -50, None)}
    ratio = coverage.bcab_ratio(t["fact_bcab_counts"], t["fact_zip_pop_by_age"], t["dim_state"])
    assert rows(ratio, "state_code", "total_bcab", "bcab_penetration_pct") == [("GA", 11, 23.4)]


def test_metrics_and_filters(tables, rows):
    names = ["total_enrolled_lives", "avg_enrolled_lives_per_zip", "zip_count_with_enrollment"]
    assert rows(metrics.metric(tables, names, ["state_code"])) == [
        ("FL", 7, 7.0, 1), ("GA", 100, 100 / 3, 2),
    ]
    policies = tables["fact_insurance_policy"]
    assert rows(policies.where(metrics.active_only()), "policy_id") == [(2,), (3,), (4,)]
    assert rows(policies.where(metrics.in_force("2024-06-01")), "policy_id") == [(1,), (2,), (3,)]
    assert rows(metrics.metric(tables, ["total_policies", "active_policy_count"])) == [(4, 3)]
    today = metrics.metric(
        tables, ["total_policies"], filters=[metrics.in_force(F.lit(date(2024, 6, 2)))]
    )
    assert rows(today) == [(3,)]


def test_metric_calls_are_checked(tables):
    with pytest.raises(ValueError, match="share a table"):
        metrics.metric(tables, ["total_policies", "total_population"])
    with pytest.raises(ValueError, match="not joined yet"):
        metrics.relate(tables, "fact_zip_enrolled_lives", ["payers_to_parent"])


def test_relate_names_columns_by_table(tables):
    edges = ["zip_lives_to_payers", "payers_to_parent"]
    joined = metrics.relate(tables, "fact_zip_enrolled_lives", edges)
    assert "dim_parent_payer__parent_payer_name" in joined.columns
    assert joined.count() == 4


def test_derived_metrics(tables, rows):
    share = metrics.payer_market_share_by_state(tables)
    assert rows(share.where("state_code = 'GA'"), "payer_name", "payer_market_share_by_state") == [
        ("One", 40.0), ("Three", 20.0), ("Two", 40.0),
    ]
    rate = metrics.autism_penetration_rate(tables)
    found = dict(rows(rate, "state_code", "autism_penetration_rate"))
    assert found["FL"] is None and round(found["GA"], 4) == round(100 / (1516 * 0.031) * 100, 4)
    clinics = metrics.clinic_covered_lives_pct(tables)
    assert {r.clinic_name: round(r.clinic_covered_lives_pct, 2) for r in clinics.collect()} == {
        "North": 59.88, "South": 35.93, None: 4.19,
    }


def test_every_relationship_is_audited():
    assert len(metrics.RELATIONSHIPS) == 25
    assert callable(relations.orphans_by_edge)


def test_lives_of_larger_places_come_from_the_stored_ones(spark, rows, tmp_path, monkeypatch):
    from tallyloom.sources import adapters

    made = {
        "lineitem": ([(1, 7, 2.0), (1, 8, 3.0), (2, 7, 4.0), (None, 7, 5.0)], "l_orderkey long, l_suppkey long, l_quantity double"),
        "orders": ([(1, 5), (2, 305), (3, None)], "o_orderkey long, o_custkey long"),
        "customer": ([(5,), (305,), (55,), (None,)], "c_custkey long"),
    }
    for name, (held, schema) in made.items():
        spark.createDataFrame(held, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    names = ["fact_zip_enrolled_lives", "fact_county_enrolled_lives", "fact_msa_enrolled_lives", "fact_state_enrolled_lives"]
    anew = adapters.coverage_tables(spark, str(tmp_path))
    expected = [rows(anew[name]) for name in names]
    stored = adapters.coverage_tables(spark, str(tmp_path), stored=True)
    assert rows(stored[names[0]]) == expected[0] and len(expected[0]) == 2
    monkeypatch.setattr(adapters, "table", lambda s, d, name, read=adapters.table: {"customer": read}[name](s, d, name))
    assert [rows(stored[name]) for name in names[1:]] == expected[1:]
