from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldomart.sources.csv import IncompleteExport, check_files, export_csv, read_csv, read_csv_landing, read_manifest

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)


def write_text(path, text, encoding="utf-8"):
    path.mkdir()
    (path / "part.csv").write_text(text, encoding=encoding)
    return str(path)


def test_bad_rows_are_kept_aside_whatever_is_selected(spark, tmp_path):
    path = write_text(tmp_path / "in", "id,name,amount\n1,a,1.50\nx,b,2\n3,c,zz\n4,d,4,extra\n5,e\n6,f,6\n")
    good, rejects = read_csv_landing(spark, path, SCHEMA, stage_dir=str(tmp_path / "stage"))
    assert sorted(r["id"] for r in good.select("id").collect()) == [1, 6]
    assert good.count() == 2
    assert sorted(r["raw_row"] for r in rejects.collect()) == ["3,c,zz", "4,d,4,extra", "5,e", "x,b,2"]


def test_header_in_another_order_is_refused(spark, tmp_path):
    path = write_text(tmp_path / "in", "name,id,amount\na,1,1.50\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_landing(spark, path, SCHEMA, stage_dir=str(tmp_path / "stage"))


def test_header_of_every_file_is_checked(spark, tmp_path):
    path = write_text(tmp_path / "in", "id,name,amount\n1,a,1.50\n")
    (tmp_path / "in" / "other.csv").write_text("amount,name,id\n2,b,3\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv_landing(spark, path, SCHEMA, stage_dir=str(tmp_path / "stage"))


def test_separator_is_a_parameter(spark, tmp_path):
    path = write_text(tmp_path / "in", "id;name;amount\n1;Иванов;1.50\n")
    good, _ = read_csv_landing(spark, path, SCHEMA, sep=";", stage_dir=str(tmp_path / "stage"))
    assert good.first() == (1, "Иванов", Decimal("1.50"))


def test_round_trip_keeps_every_text(spark, tmp_path):
    texts = ["plain", "", None, "line\nbreak", "carriage\r\nreturn", 'quo"te', "comma,", ' "x",\n""', " pad ", "\\", "#", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, a string").withColumn(
        "t", F.lit(datetime(2018, 1, 9, 1, 2, 3, 456789))
    )
    path = str(tmp_path / "out")
    assert export_csv(df, path) == len(texts)
    again = read_csv(spark, path, df.schema, multi_line=True)
    assert sorted(again.collect(), key=lambda r: r["id"]) == df.orderBy("id").collect()


def test_text_that_stands_for_null_stops_the_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "\\N")], "id int, a string")
    with pytest.raises(Exception, match="stands for NULL"):
        export_csv(df, str(tmp_path / "out"))


def test_empty_table_has_headings(spark, tmp_path):
    path = tmp_path / "out"
    assert export_csv(spark.range(3).filter("id > 5"), str(path)) == 0
    assert [f.read_text().strip() for f in path.glob("*.csv")] == ["id"]


def test_a_failed_export_keeps_the_earlier_one(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.StringType())])
    export_csv(spark.createDataFrame([(1, "x")], schema), path)
    with pytest.raises(Exception, match="stands for NULL"):
        export_csv(spark.createDataFrame([(2, "\\N")], schema), path)
    assert [tuple(r) for r in read_csv(spark, path, schema).collect()] == [(1, "x")]
    assert [f.name for f in tmp_path.iterdir()] == ["out"]


def test_long_tables_are_many_files(spark, tmp_path):
    path = tmp_path / "out"
    export_csv(spark.range(100).coalesce(1), str(path), max_rows_per_file=30)
    assert len(list(path.glob("*.csv"))) == 4


def test_manifest_names_files_rows_and_an_order_free_digest(spark, tmp_path):
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    rows = [(1, "a", None), (2, None, "b"), (3, "", "")]
    export_csv(spark.createDataFrame(rows, "id int, a string, b string").repartition(3, "id"), one)
    export_csv(spark.createDataFrame(rows[::-1], "id int, a string, b string").coalesce(1), other)
    first, second = read_manifest(spark, one), read_manifest(spark, other)
    assert (first["rows"], first["digest"]) == (3, second["digest"]) and len(second["files"]) == 1
    assert first["files"] == {f.name: f.stat().st_size for f in (tmp_path / "one").glob("*.csv")}
    swapped = [(1, None, "a"), *rows[1:]]
    export_csv(spark.createDataFrame(swapped, "id int, a string, b string"), other)
    assert read_manifest(spark, other)["digest"] != first["digest"]
    assert check_files(spark, one) == first and check_files(spark, [one]) is None


def test_files_that_are_absent_or_changed(spark, tmp_path):
    path = tmp_path / "out"
    export_csv(spark.range(100).repartition(3), str(path))
    files = sorted(path.glob("*.csv"))
    text = files[0].read_text()
    (path / f".{files[0].name}.crc").unlink(missing_ok=True)
    files[0].write_text(text + "1000\n")
    with pytest.raises(IncompleteExport, match="not as it was exported"):
        check_files(spark, str(path))
    assert check_files(spark, str(path), edited=True)["rows"] == 100
    files[1].unlink()
    for edited in (False, True):
        with pytest.raises(IncompleteExport, match=f"lacks {files[1].name}"):
            check_files(spark, str(path), edited)
    (path / "_manifest.json").unlink()
    assert check_files(spark, str(path)) is None
