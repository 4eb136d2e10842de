"""Tables of versions: what a write that dies, a slow reader and a second writer find."""

import pytest
from pyspark.sql import functions as F

from tillmark import storage, versions
from tillmark.sinks import reports
from tillmark.sinks.layers import write_layer
from tillmark.sources.layers import read_layer


def ids(df):
    return sorted(row.id for row in df.collect())


def failing(spark, n):
    return spark.range(n).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))


def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), "layer", root)
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="lost"):
            write_layer(failing(spark, 5), "layer", root, mode=mode)
        assert ids(read_layer(spark, "layer", root)) == [0, 1, 2]
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark, 5), "new", root)
    assert versions.numbers(spark, f"{root}/new") == []


def test_a_write_that_dies_before_its_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    write_layer(spark.range(3), "layer", root)
    monkeypatch.setattr(versions.storage, "create_text", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_layer(spark.range(5), "layer", root)
    monkeypatch.undo()
    assert ids(read_layer(spark, "layer", root)) == [0, 1, 2]
    # Its folder goes with the next writes.
    folders = len(list((tmp_path / "layer").glob("data=*")))
    versions.tidy(spark, f"{root}/layer")
    assert len(list((tmp_path / "layer").glob("data=*"))) == folders - 1


def test_a_reader_of_an_old_version_finishes(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.range(3), "layer", root)
    opened = read_layer(spark, "layer", root)
    for n in range(4, 8):
        write_layer(spark.range(n), "layer", root)
    assert ids(opened) == [0, 1, 2]
    assert ids(read_layer(spark, "layer", root)) == list(range(7))
    # Kept for a day, as a reader may take that long; then the last versions stay.
    assert versions.numbers(spark, f"{root}/layer") == [1, 2, 3, 4, 5]
    versions.tidy(spark, f"{root}/layer", keep=2, seconds=0)
    assert versions.numbers(spark, f"{root}/layer") == [4, 5]
    assert len(list((tmp_path / "layer").glob("data=*"))) == 2


def test_of_two_writers_one_conflicts(spark, tmp_path):
    path = str(tmp_path / "table")
    first = versions.commit(spark, path, {"parts": ["a"]}, versions.latest(spark, path))
    with pytest.raises(versions.VersionConflict):
        versions.commit(spark, path, {"parts": ["b"]}, versions.Version(0, {}))
    assert versions.latest(spark, path) == first
    # A change that is made anew of what the other writer left.
    seen = []

    def change(content, number):
        if not seen:
            versions.commit(spark, path, {"parts": ["a", "c"]}, versions.latest(spark, path))
        seen.append(number)
        return {"parts": [*content["parts"], "d"]}

    assert versions.update(spark, path, change).content == {"parts": ["a", "c", "d"]}
    assert seen == [2, 3]
    assert not [name for name in storage.names(spark, f"{path}/_versions") if name.startswith(".0")]


def test_parts_of_a_folder_are_cleared_one_by_one(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(f"{path}/data=x")
    spark.range(4).write.parquet(f"{path}/data=y")
    versions.commit(spark, path, {"parts": ["data=x/k=1"]}, versions.Version(0, {}))
    assert versions.tidy(spark, path) == ["data=x/k=0", "data=y"]
    assert storage.names(spark, f"{path}/data=x/k=0") == []


def test_a_plain_folder_becomes_a_table(spark, tmp_path):
    root = str(tmp_path)
    spark.range(2).write.parquet(f"{root}/plain")
    write_layer(spark.range(2, 4), "plain", root, mode="append")
    assert ids(read_layer(spark, "plain", root)) == [0, 1, 2, 3]
    write_layer(spark.range(7, 9), "plain", root)
    write_layer(spark.range(9, 10), "plain", root, mode="append")
    assert ids(read_layer(spark, "plain", root)) == [7, 8, 9]


def test_reports_are_replaced_whole(spark, tmp_path, monkeypatch):
    schema = "CustomerID string, InvoiceNo string, StockCode string, Quantity int, median_quantity int"
    rows = spark.createDataFrame([("1", "2", "A", 900, 5)], schema)
    path = str(tmp_path / "outliers.txt")
    reports.write_outlier_report(rows, path)
    bad = rows.withColumn("CustomerID", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        reports.write_outlier_report(bad, path)
    assert spark.read.text(path).count() == 1
    reports.write_outlier_report(rows.unionAll(rows), path)
    assert spark.read.text(path).count() == 2
    assert [entry.name for entry in tmp_path.iterdir()] == ["outliers.txt"]
