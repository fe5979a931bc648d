from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from saldomart.operators.duplicates import (
    DuplicateKeys,
    assert_unique,
    find_duplicates,
    first_per_key,
    remove_duplicates,
)

SCHEMA = "a string, b int, payload string, ver int"
ROWS = [
    ("x", 1, "p", 2), ("x", 1, "p", 2), ("x", 1, "p", 2), ("x", 1, "q", 1), ("y", 1, "p", 1),
    (None, 1, "p", 1), (None, 1, "q", 1), (None, None, "p", 1),
]
FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_groups(spark):
    found = find_duplicates(spark.createDataFrame(ROWS, SCHEMA), ["a", "b"])
    assert {tuple(r) for r in found.collect()} == {("x", 1, 4), (None, 1, 2)}


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_kept_and_removed_do_not_depend_on_partitions(spark, partitions):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(partitions)
    kept, removed = remove_duplicates(df, ["a", "b"], [F.desc("ver")])
    assert Counter(map(tuple, kept.collect())) == Counter(
        [("x", 1, "p", 2), ("y", 1, "p", 1), (None, 1, "p", 1), (None, None, "p", 1)]
    )
    assert Counter(map(tuple, removed.collect())) == Counter(
        [("x", 1, "p", 2), ("x", 1, "p", 2), ("x", 1, "q", 1), (None, 1, "q", 1)]
    )


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2), st.sampled_from("pq"), st.just(0))),
       parts=st.integers(1, 4))
def test_kept_plus_removed_is_the_input(spark, rows, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    kept, removed = remove_duplicates(df, ["a"], [F.col("b").asc()])
    kept, removed = [list(map(tuple, d.collect())) for d in (kept, removed)]
    assert Counter(kept) + Counter(removed) == Counter(rows)
    best = {}
    for r in rows:
        best[r[0]] = min(best.get(r[0], r), r, key=lambda t: (t[1], t[2]))
    assert Counter(kept) == Counter(best.values())


def test_only_one_row_per_task_and_key_is_shuffled(spark, capsys):
    first_per_key(spark.createDataFrame(ROWS, SCHEMA), ["a"]).explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_a_hot_key_is_not_ranked_in_one_task(spark):
    hot = spark.range(0, 40000, 1, 8).selectExpr("if(id % 2 = 0, 0, id) as k", "id as v")
    kept, removed = remove_duplicates(hot, ["k"], [F.col("v").asc()])
    assert (kept.count(), removed.count()) == (20001, 19999)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = removed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes[0] < 15000


def test_gate(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(DuplicateKeys, match="2 duplicate keys in a, b"):
        assert_unique(df, ["a", "b"])
    assert_unique(df.distinct(), SCHEMA.replace(" string", "").replace(" int", "").split(", "))
