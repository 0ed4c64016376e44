"""Join paths found from names, and sums beyond relationships that multiply rows."""

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import paths
from tallyloom.plans.metrics import RELATIONSHIPS, TABLE_METRICS, Edge


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "fact_zip_enrolled_lives": make(
            [("Z1", 1, "N1", 10), ("Z1", 2, "N1", 5), ("Z2", 1, "N1", 7), ("Z3", 1, "N2", 100), ("Z9", 9, None, 1)],
            "zip_code string, payer_id int, state_code string, enrolled_lives long",
        ),
        "fact_zip_pop_by_age": make([("Z1", "0-9", "N1", 1000), ("Z8", "0-9", "N3", 50)], "zip_code string, age_band string, state_code string, population long"),
        "dim_zip": make([("Z1", "N1", "C1", "M1"), ("Z2", "N1", "C2", "M1"), ("Z3", "N2", "C3", "M2")], "zip_code string, state_code string, county_name string, msa_name string"),
        "dim_state": make([("N1", "North"), ("N2", "South")], "state_code string, state_name string"),
        # Z1 names Clinic A twice and Clinic B once; Z2 is unassigned; Z3 is B's in another state.
        "map_clinic_to_zip": make(
            [("Z1", "N1", "A"), ("Z1", "N1", "A"), ("Z1", "N1", "B"), ("Z2", "N1", None), ("Z3", "N2", "B")],
            "zip_code string, state_code string, clinic_name string",
        ),
        "dim_clinic": make([("A", "N1", "Oak"), ("B", "N1", "Elm"), ("B", "N2", "Elm")], "clinic_name string, state_code string, city string"),
        "dim_payers": make([(1, "P1", 7), (2, "P2", None)], "payer_id int, payer_name string, parent_payer_id int"),
        "dim_parent_payer": make([(7, "Parent")], "parent_payer_id int, parent_payer_name string"),
    }


def test_sums_beyond_a_multiplying_edge_count_a_fact_once_for_each_value(tables, rows):
    lives = ["total_enrolled_lives"]
    assert rows(paths.ask(tables, lives, ["clinic_name"])) == [("A", 15), ("B", 115), (None, 8)]
    assert rows(paths.ask(tables, lives, ["clinic_name"], {"clinic_name": F.isnotnull})) == [("A", 15), ("B", 115)]
    assert rows(paths.ask(tables, lives, ["city"])) == [("Elm", 115), ("Oak", 15), (None, 8)]  # two edges on from the map
    by_payer = paths.ask(tables, lives, ["clinic_name", "payer_name"])
    assert rows(by_payer) == [("A", "P1", 10), ("A", "P2", 5), ("B", "P1", 110), ("B", "P2", 5), (None, "P1", 7), (None, None, 1)]


def test_a_filter_beyond_a_multiplying_edge_does_not_count_twice(tables, rows):
    assigned = {"clinic_name": F.isnotnull}
    assert rows(paths.ask(tables, ["total_enrolled_lives"], where=assigned)) == [(115,)]
    assert rows(paths.ask(tables, ["total_enrolled_lives"], ["state_code"], assigned)) == [("N1", 15), ("N2", 100)]


def test_metrics_that_are_no_sums_take_the_same_path(tables, rows):
    names = ["avg_enrolled_lives_per_zip", "zip_count_with_enrollment", "total_enrolled_lives"]
    found = rows(paths.ask(tables, names, ["clinic_name", "state_code"], {"clinic_name": F.isnotnull}))
    assert found == [("A", "N1", 7.5, 1, 15), ("B", "N1", 7.5, 1, 15), ("B", "N2", 100.0, 1, 100)]


def test_metrics_of_several_tables_are_aggregated_apart(tables, rows):
    found = paths.ask(tables, ["total_enrolled_lives", "total_population"], ["state_code"])
    assert rows(found) == [("N1", 22, 1000), ("N2", 100, None), ("N3", None, 50), (None, 1, None)]


def test_paths(tables):
    locate = lambda name: paths.locate(tables, "fact_zip_enrolled_lives", name)
    assert locate("state_code").path == ()
    assert locate("parent_payer_name").path == ("zip_lives_to_payers", "payers_to_parent")
    assert locate("state_name").path == ("zip_lives_to_dim_zip", "zip_to_state")
    assert locate("map_clinic_to_zip.state_code").table == "map_clinic_to_zip"
    with pytest.raises(ValueError, match="no relationship leads"):
        locate("age_band")
    with pytest.raises(ValueError, match="share a column name"):
        paths.ask(tables, ["total_enrolled_lives"], ["state_code", "dim_zip.state_code"])
    with pytest.raises(KeyError):
        paths.ask(tables, ["no such metric"])


def test_ambiguous_names_are_refused(tables, monkeypatch):
    spare = {**tables, "dim_payers": tables["dim_payers"].withColumn("county_name", F.lit("x"))}
    with pytest.raises(paths.AmbiguousPath, match="dim_payers, dim_zip"):
        paths.locate(spare, "fact_zip_enrolled_lives", "county_name")
    assert paths.locate(spare, "fact_zip_enrolled_lives", "dim_zip.county_name").table == "dim_zip"
    monkeypatch.setitem(RELATIONSHIPS, "payers_to_state", Edge("dim_payers", "dim_state", (("state_code", "state_code"),)))
    with pytest.raises(paths.AmbiguousPath, match="zip_to_state or zip_lives_to_payers/payers_to_state"):
        paths.locate(tables, "fact_zip_enrolled_lives", "state_name")


def test_every_metric_is_a_sum_or_named_as_none():
    assert {name for name in TABLE_METRICS if name.startswith("avg") or "count_with" in name} == set(TABLE_METRICS) - paths.ADDITIVE


def test_facts_are_summed_before_a_multiplying_join(tables):
    plan = paths.ask(tables, ["total_enrolled_lives"], ["clinic_name"])._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join")
    assert plan.index("Aggregate") < join and plan.count("Aggregate", join) == 2  # pairs and facts below, the result above
