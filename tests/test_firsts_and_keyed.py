import pytest
from pyspark.sql import functions as F

from tracklane.operators.firsts import first_per_group, nearest_in_group
from tracklane.operators.keyed import (
    append_distinct,
    append_manifest,
    check_columns,
    dedupe_by_key,
    insert_ignore,
    pending,
    upsert_manifest,
)


def test_first_per_group_puts_null_last_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 3), ("a", "x", 2), ("b", None, 9), (None, "y", 4), (None, "y", 5)],
        "g string, t string, n int",
    )
    assert rows(first_per_group(df, ["g"], ["t", "n"])) == [(None, "y", 4), ("a", "x", 2), ("b", None, 9)]
    assert rows(first_per_group(df, ["g"], ["t", "n"], where=F.col("n") > 2)) == [
        (None, "y", 4), ("a", "x", 3), ("b", None, 9),
    ]


def test_large_groups_shrink_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.lit("g").alias("g"), "id").write.parquet(path)
    plan = first_per_group(spark.read.parquet(path), ["g"], ["id"])._jdf.queryExecution()
    lines = plan.executedPlan().toString().splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exchange:])


def test_nearest_in_group(spark, rows):
    left = spark.createDataFrame([("a", 100), ("b", 50), ("c", None)], "g string, at int")
    right = spark.createDataFrame(
        [("a", 97, 1), ("a", 103, 0), ("a", 110, 2), ("b", 90, 1), ("c", 1, 1), ("d", 1, 1)],
        "g string, clock int, n int",
    )
    near = nearest_in_group(left, right, ["g"], "at", "clock", ["g"], ["n"])
    assert rows(near, "g", "clock", "time_diff") == [("a", 103, 3), ("b", 90, 40), ("c", 1, None)]
    near = nearest_in_group(left, right, ["g"], "at", "clock", ["g"], ["n"], tolerance=3)
    assert rows(near, "g", "clock", "time_diff") == [("a", 103, 3)]


def test_small_side_is_counted_before_broadcast(spark, rows, small_groups):
    left = spark.createDataFrame([("a", 100)], "g string, at int")
    right = spark.createDataFrame([("a", 97, 1), ("a", 104, 0)], "g string, clock int, n int")
    near = nearest_in_group(left, right, ["g"], "at", "clock", ["g"], ["n"])
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    assert rows(near, "clock") == [(97,)]


def test_insert_ignore(spark, rows):
    existing = spark.createDataFrame([("a", 1, "old")], "g string, e int, v string")
    new = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", 1, "w")], "g string, e int, v string"
    )
    assert rows(insert_ignore(existing, new, ["g", "e"], ["v"])) == [("a", 2, "y"), ("b", 1, "w")]
    assert rows(dedupe_by_key(new, ["g"], ["e", "v"])) == [("a", 1, "x"), ("b", 1, "w")]


def test_append_distinct_keeps_new_rows_as_they_are(spark, rows):
    one = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    assert rows(append_distinct(one, spark.createDataFrame([("a",), ("a",)], "g string"))) == [
        ("a",), ("a",), ("a",), ("b",),
    ]


MANIFEST = "season string, gameid string, params string, uploadedFLG int, lastuploadDTS string"


def test_manifest(spark, rows):
    manifest = spark.createDataFrame(
        [("s", "1", "p", 0, "2016-02-01"), ("s", "2", "p", 1, "2016-01-01")], MANIFEST
    )
    new = spark.createDataFrame(
        [("s", "1", "q", 1, "2016-01-02"), ("s", "1", "r", 1, "2016-01-03"), ("s", "3", "q", 1, "x")],
        MANIFEST,
    )
    merged = upsert_manifest(manifest, new, ["gameid"], "lastuploadDTS")
    assert merged.columns == manifest.columns
    assert rows(merged, "gameid", "params") == [("1", "r"), ("2", "p"), ("3", "q")]
    source = spark.createDataFrame([("1",), ("2",), ("2",), ("4",)], "gameid string")
    assert rows(pending(source, manifest, "gameid")) == [("4",)]
    assert rows(pending(source, manifest, "gameid", F.col("uploadedFLG") == 1)) == [("1",), ("4",)]
    with pytest.raises(ValueError, match="column order"):
        check_columns(manifest, ["gameid", "season"])
    games = spark.createDataFrame([("e", "f")], "season string, gameid string")
    more = append_manifest(manifest, games, params="p", uploadedFLG=1, lastuploadDTS="now")
    assert rows(more, "season", "uploadedFLG") == [("e", 1), ("s", 0), ("s", 1)]
