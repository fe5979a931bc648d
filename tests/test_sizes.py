from pyspark.sql import functions as F

from saldomart.functions.sizes import broadcast_if_small, is_small


def test_rows_and_text_count(spark):
    df = spark.range(1000).withColumn("t", F.repeat(F.lit("x"), 100))
    assert is_small(df)
    assert not is_small(df, max_bytes=100_000)
    assert is_small(df.drop("t"), max_bytes=100_000)
    assert is_small(df.filter("id < 0"), max_bytes=0)


def test_nested_columns_are_not_small(spark):
    assert not is_small(spark.range(1).withColumn("a", F.array("id")))


def test_hint_only_when_small(spark, capsys):
    big, small = spark.range(1000), spark.range(10)
    big.join(broadcast_if_small(small, 10_000), "id").explain("extended")
    assert "strategy=broadcast" in capsys.readouterr().out
    big.join(broadcast_if_small(small, 10), "id").explain("extended")
    assert "strategy=broadcast" not in capsys.readouterr().out
