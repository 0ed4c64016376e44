import pytest

from tallyloom import session
from tallyloom.session import park, scratch_path
from tallyloom.sources import files


def test_dimension_from_csv(spark, rows, tmp_path):
    path = tmp_path / "parents.csv"
    path.write_text(
        "PARENT_NAME,PARENT_ID,CREATED_AT\n"
        '"Acme, Inc.",1,2026-03-02 06:52:55.249 -0500\n'
        '"Acme ""old""",1,2026-03-02 06:52:55.248 -0500\n'
        "Zeta,2,2026-03-02 06:52:55.249 +0100\n"
        "Zeta,2,2026-03-02 06:52:55.249 +0100\n"
        "Nodate,3,\n"
    )
    raw = files.read_csv(spark, str(path), "PARENT_NAME string, PARENT_ID int, CREATED_AT string")
    assert raw.count() == 5
    rename = {"PARENT_NAME": "parent_payer_name", "PARENT_ID": "parent_payer_id", "CREATED_AT": "created_at"}
    dim = files.ingest_dimension(raw, rename, ["parent_payer_id"])
    text = dim.selectExpr(
        "parent_payer_id", "parent_payer_name", "date_format(created_at, 'HH:mm:ss.SSS') AS at"
    )
    assert rows(text) == [
        (1, "Acme, Inc.", "11:52:55.249"), (2, "Zeta", "05:52:55.249"), (3, "Nodate", None),
    ]


def test_places_that_are_no_states_can_be_left_out(spark, rows):
    raw = spark.createDataFrame(
        [(1, "FL"), (2, "HEAD OFFICE"), (3, None)], "CUSTNO int, CLINIC_STATE string"
    )
    dim = files.ingest_dimension(raw, {"CUSTNO": "id"}, ["id"], None, two_letter_state="CLINIC_STATE")
    assert rows(dim) == [(1, "FL")]


def test_a_header_that_differs_from_the_schema_is_an_error(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        files.read_csv(spark, str(path), "a int, c int").collect()


def test_tables_and_views(spark, rows):
    one = files.rows(spark, [(1, "x")], "a int, b string")
    path = scratch_path(spark, "table")
    name = "replaced_" + path.rsplit("-", 1)[1]
    files.overwrite_table(one, name, path)
    replaced = files.create_table_as(spark, name, "SELECT 5 AS c", path)
    assert replaced.columns == ["c"] and rows(files.read_table(spark, name)) == [(5,)]
    files.create_view(one, "seen")
    assert rows(files.create_view(one.selectExpr("a + 1 AS a"), "seen")) == [(2,)]
    assert rows(files.row_count(one)) == [(1,)] and files.preview(one).count() == 1


def test_parked_rows_keep_their_values(spark, rows):
    df = spark.range(100).selectExpr("id", "rand() AS r")
    parked = park(df)
    assert rows(parked) == rows(parked)


def test_scratch_can_be_cleared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    assert park(spark.range(3)).count() == 3
    folder = tmp_path / "tallyloom" / spark.sparkContext.applicationId
    assert len(list(folder.iterdir())) == 1
    session.clear_scratch(spark)
    assert not folder.exists()


def test_scratch_follows_the_cluster_setting(spark, monkeypatch, tmp_path):
    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) + "/" if key == "spark.checkpoint.dir" else default

    class Context:
        master = "spark://somewhere"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    assert session.scratch_root(Session()) == str(tmp_path)
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())
