import os

import pytest
from pyspark.errors import PySparkException

from kinmatch.schemas import PAIRS
from kinmatch.session import scratch_path
from kinmatch.sources import files, jdbc


def local(spark, name):
    path = scratch_path(spark, name).removeprefix("file:")
    os.makedirs(path)
    return path


def test_csv_round_trip_with_quotes_and_line_breaks(spark):
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame([(1, 'a "quoted"\nline'), (2, None)], "id bigint, name string")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, "id bigint, name string", multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(1, 'a "quoted"\nline'), (2, None)]
    assert dict(files.read_csv(spark, path, multi_line=True).dtypes)["id"] == "int"


def test_empty_csv_is_an_empty_frame(spark):
    path = local(spark, "empty")
    open(f"{path}/none.csv", "w").close()
    assert files.read_csv(spark, path, PAIRS).count() == 0


def test_pair_text(spark):
    path = local(spark, "pairs")
    with open(f"{path}/p.txt", "w") as f:
        f.write("a\tb\t1\n\nc\td\n")
    rows = sorted(map(tuple, files.read_pair_text(spark, path).collect()))
    assert rows == [("a", "b", 1), ("c", "d", None)]


def test_pair_text_with_odd_lines(spark):
    path = local(spark, "odd")
    with open(f"{path}/p.txt", "w") as f:
        f.write("a\tb\t1\tx\nalone\nc\td\t0\n")
    rows = sorted(map(tuple, files.read_pair_text(spark, path, strict=False).collect()))
    assert rows == [("a", "b", None), ("c", "d", 0)]


@pytest.mark.parametrize("line", ["alone", "a\tb\t1\tx", "a\tb\tyes", "a\tb\t"])
def test_pair_text_refuses_odd_lines(spark, line):
    path = local(spark, "refused")
    with open(f"{path}/p.txt", "w") as f:
        f.write(f"c\td\t0\n\n{line}\n")
    with pytest.raises(PySparkException, match="not 2 columns and a label"):
        files.read_pair_text(spark, path).collect()


def test_split_text_sink(spark):
    path = scratch_path(spark, "split")
    df = spark.createDataFrame([("x", "train"), ("y", "test"), ("z", "train")], "value string, set string")
    files.write_split_text(df, path)
    assert spark.read.text(f"{path}/set=train").count() == 2


def test_generic_table_formats(spark):
    path = scratch_path(spark, "orc")
    files.write_table(spark.range(3), "orc", path)
    files.write_table(spark.range(2), "orc", path)
    assert files.read_table(spark, "orc", path).count() == 5


def test_jdbc_options(monkeypatch):
    plain = jdbc.query_options("SELECT 1", "jdbc:mysql://host/db")
    assert plain["query"] == "SELECT 1" and plain["url"] == "jdbc:mysql://host/db"
    ranged = jdbc.query_options(
        "SELECT * FROM t", "mysql://host/db", partition_column="id", lower=0, upper=100, partitions=4
    )
    assert ranged["dbtable"] == "(SELECT * FROM t) q" and ranged["numPartitions"] == "4"
    assert ranged["url"] == "jdbc:mysql://host/db" and "query" not in ranged
    with pytest.raises(ValueError):
        jdbc.query_options("SELECT 1", "jdbc:x", partition_column="id")
    monkeypatch.delenv(jdbc.ENDPOINT_VARIABLE, raising=False)
    with pytest.raises(ValueError):
        jdbc.endpoint()
    monkeypatch.setenv(jdbc.ENDPOINT_VARIABLE, "mysql://h/d")
    assert jdbc.endpoint() == "jdbc:mysql://h/d"


def test_jdbc_rejects_unknown_modes(spark):
    with pytest.raises(ValueError, match="if_exists"):
        jdbc.save_table(spark.range(1), "t", "jdbc:x", if_exists="merge")
