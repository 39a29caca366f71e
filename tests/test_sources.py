from __future__ import annotations

import datetime

import pytest
from conftest import rows

from smogline import session
from smogline.sources import readers, writers

CSV = """City,Date,PM2.5,NO,Note,AQI,AQI_Bucket
Delhi,2020-01-01,1.5,NA,x,10,Good
NA,bad,NaN,,y,,nan
Agra,2020-01-02,7,3,,20.5,Poor
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_scan(spark, csv_file):
    df = readers.read_csv(spark, csv_file)
    assert df.columns == ["City", "Date", "PM2_5", "NO", "Note", "AQI", "AQI_Bucket"]
    assert dict(df.dtypes)["PM2_5"] == "double" and dict(df.dtypes)["Date"] == "date"
    assert rows(df) == [
        ("Delhi", datetime.date(2020, 1, 1), 1.5, None, "x", 10.0, "Good"),
        (None, None, None, None, "y", None, None),
        ("Agra", datetime.date(2020, 1, 2), 7.0, 3.0, None, 20.5, "Poor"),
    ]


def test_csv_sink_uses_file_names(spark, csv_file, tmp_path):
    target = str(tmp_path / "out")
    df = readers.read_csv(spark, csv_file)
    writers.write_csv(df, target)
    assert "PM2.5" in spark.read.option("header", True).csv(target).columns
    assert sorted(map(str, rows(readers.read_csv(spark, target)))) == sorted(map(str, rows(df)))


def test_cleaned_sink_counts_while_writing(spark, csv_file, tmp_path):
    for fmt in ("parquet", "csv"):
        path, facts = str(tmp_path / fmt), str(tmp_path / f"{fmt}-facts")
        assert writers.write_cleaned(readers.read_csv(spark, csv_file), path, facts, fmt) == 3
        assert rows(readers.read_json(spark, facts, "clean_path string, rows long, cols int")) == [(path, 3, 7)]


@pytest.mark.parametrize("url", ["spark://somewhere", "local-cluster[3,2,1024]", "yarn"])
def test_unset_folder_on_a_cluster_is_an_error(url):
    class Context:
        master = url

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_stage_uses_the_shared_folder(spark, table):
    staged = session.stage(table({"x": "long"}, (1,), (2,)), "numbers")
    assert sorted(rows(staged)) == [(1,), (2,)]
    assert session.shared_folder(spark) in staged.inputFiles()[0].replace("file://", "")


def test_dotted_names_in_files(spark, tmp_path):
    from smogline.sources.readers import read_csv, read_table

    rows = spark.createDataFrame([(float("nan"), "x"), (2.0, "NA")], "`PM2.5` double, `Note.1` string")
    rows.write.parquet(str(tmp_path / "p"))
    rows.write.option("header", True).csv(str(tmp_path / "c"))
    found = read_table(spark, str(tmp_path / "p"), nan_is_missing=True)
    assert sorted(r["PM2_5"] or 0.0 for r in found.collect()) == [0.0, 2.0]
    assert sorted(r["Note.1"] or "" for r in read_csv(spark, str(tmp_path / "c")).collect()) == ["", "x"]
