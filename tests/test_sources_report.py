from __future__ import annotations

import pytest
from pyspark.sql import types as T

import labelstats as ls
from labelstats.__main__ import main
from labelstats.operators import attach
from labelstats.plans.report import describe, judge, reduce_table
from tests.conftest import SENSORS, sensor_frame


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "sensors.csv"
    sensor_frame(60, 60, gap=60.0).to_csv(path, index=False)
    return str(path)


def test_csv_with_inferred_types(spark, csv):
    df = ls.read_csv(spark, csv)
    assert df.columns == ["Status", *SENSORS]
    assert [f.dataType for f in df.schema] == [T.StringType()] + [T.DoubleType()] * 12
    assert df.count() == 120


def test_csv_with_given_schema(spark, csv):
    schema = ls.labelled_schema("Status", SENSORS)
    df = ls.read_csv(spark, csv, schema)
    assert df.schema == schema
    assert df.exceptAll(ls.read_csv(spark, csv)).count() == 0
    swapped = ls.labelled_schema("Status", SENSORS[::-1])
    with pytest.raises(Exception, match="CSV header"):
        ls.read_csv(spark, csv, swapped).collect()


def test_csv_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    """Short, long and unparsable records, quoted fields, empty ones; two files; one scan."""
    good = ["a,1.5,2", '"b, quoted",,3', ",,"]
    bad = ["c,1", "d,1,2,3", "e,one,2", "f,1,2 "]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.csv").write_text("\n".join(["name,x,y y", *good, *bad, ""]))
    (tmp_path / "in" / "two.csv").write_text("\n".join(["name,x,y y", "z,7,8", ""]))
    schema = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("y y", T.IntegerType())]
    )
    found = ls.read_csv_checked(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"))
    assert found.rows.schema.names == ["name", "x", "y y"]
    assert sorted(map(tuple, found.rows.collect()), key=repr) == sorted(
        [("a", 1.5, 2), ("b, quoted", None, 3), (None, None, None), ("z", 7.0, 8)], key=repr
    )
    rejected = {r["record"]: r["file"].rsplit("/")[-1] for r in found.rejected.collect()}
    assert rejected == dict.fromkeys(bad, "one.csv")
    counts = {r["file"].rsplit("/")[-1]: (r["read"], r["rejected"]) for r in found.counts.collect()}
    assert counts == {"one.csv": (7, 4), "two.csv": (1, 0)}
    # A record is rejected whatever columns are used; the files are not read again.
    assert found.rows.select("name").count() == 4
    for frame in (found.rows, found.rejected, found.counts):
        assert "csv" not in frame._jdf.queryExecution().executedPlan().toString().split("Location")[0].lower()
    with pytest.raises(Exception, match="(?i)header"):
        ls.read_csv_checked(spark, str(tmp_path / "in"), T.StructType(schema.fields[::-1]), str(tmp_path / "no"))


def test_csv_without_records(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("name\n")
    schema = T.StructType([T.StructField("name", T.StringType())])
    found = ls.read_csv_checked(spark, str(tmp_path / "empty.csv"), schema, str(tmp_path / "out"))
    assert [f.count() for f in (found.rows, found.rejected, found.counts)] == [0, 0, 0]


def test_report(spark, csv):
    df = ls.read_csv(spark, csv)
    tables = describe(df, "Status")
    assert tables["summary"].count() == 12
    assert tables["boxplot"].count() == 24
    matrix = tables["correlation"].collect()
    assert len(matrix) == 2 * 12 and tables["correlation"].columns == ["Status", "x", *SENSORS]
    assert [r["x"] for r in matrix[:12]] == SENSORS
    assert set(tables["missing_placeholders"].first()) == {0}
    judged = judge(df, "Status", label_order=["Abnormal", "Normal"], mlp_params={"maxIter": 30})
    comparison = {r["model"]: r for r in judged["comparison"].collect()}
    assert set(comparison) == {"mlp", "decision_tree", "linear_svc"}
    assert comparison["decision_tree"]["accuracy"] == 1.0
    assert judged["confusion"].count() == 3
    wrong = judged["misclassified"].collect()
    assert len(wrong) == 6 and sum(r["total"] for r in wrong) == judged["predictions"].count()
    big = reduce_table(df, "Status")
    assert {r["Summary"] for r in big["table"].collect()} == {"Mean", "Min", "Max"}
    assert big["means"].count() == 2


def test_command_line(csv, capsys):
    main([csv, csv, "--label", "Status", "--order", "Abnormal,Normal"])
    lines = capsys.readouterr().out.splitlines()
    sizes, name = {}, None
    for line in lines:
        if "\t" in line:
            sizes[name] = sizes.get(name, -1) + 1  # the first line names the columns
        else:
            name = line
    expected = {
        "missing": 1, "missing_placeholders": 1, "summary": 12, "boxplot": 24, "correlation": 24,
        "comparison": 3, "confusion": 3, "misclassified": 6, "table": 3, "means": 2,
    }
    assert {k: sizes[k] for k in expected} == expected
    assert sizes["predictions"] == 3 * (sizes["predictions"] // 3) > 20


class _Context:
    master = "spark://head:7077"

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    sparkContext = _Context()
    conf = _Conf()


class _Frame:
    sparkSession = _Session()


def test_a_cluster_without_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        attach.settle(_Frame())
