import random

from pyspark.sql import functions as F

from tracklane.operators.nearest import entity_closest_flag, entity_distance, entity_distance_rank
from tracklane.operators.skew import hot_keys

SCHEMA = "game string, moment bigint, who bigint, x double, y double"
KEYS, XY = ["game", "moment"], ("x", "y")

MOMENTS = [
    # ball at the origin; 7 and 8 tie, 9 stands on the ball
    ("a", 1, -1, 0.0, 0.0), ("a", 1, 8, 3.0, 4.0), ("a", 1, 7, 4.0, 3.0), ("a", 1, 9, 0.0, 0.0),
    # no ball
    ("a", 2, 5, 1.0, 1.0), ("a", 2, 4, 2.0, 2.0),
    # ball only
    ("a", 3, -1, 1.0, 1.0),
    # a player without position, and one without id
    ("b", 1, -1, 0.0, 0.0), ("b", 1, 3, None, 1.0), ("b", 1, None, 1.0, 0.0), ("b", 1, 2, 5.0, 0.0),
    # no complete key: belongs to no moment
    ("c", None, -1, 0.0, 0.0), ("c", None, 6, 1.0, 0.0),
]


def moments(spark):
    return spark.createDataFrame(MOMENTS, SCHEMA)


def test_rank(spark, rows):
    expected = sorted([
        ("a", 1, -1, 0.0, None), ("a", 1, 9, 0.0, 1), ("a", 1, 7, 25.0, 2), ("a", 1, 8, 25.0, 3),
        ("a", 2, 4, None, 1), ("a", 2, 5, None, 2),
        ("a", 3, -1, 0.0, None),
        ("b", 1, -1, 0.0, None), ("b", 1, 2, 25.0, 1), ("b", 1, 3, None, 2), ("b", 1, None, 1.0, None),
        ("c", None, -1, None, None), ("c", None, 6, None, None),
    ], key=lambda t: tuple((v is not None, v) for v in t))
    for method in ("window", "join"):
        df = entity_distance_rank(moments(spark), KEYS, "who", -1, XY, method=method)
        assert rows(df, "game", "moment", "who", "distance_sq", "rank") == expected, method


def test_closest_flag(spark, rows):
    df = entity_closest_flag(moments(spark), KEYS, "who", -1, XY)
    assert rows(df, "game", "moment", "who", "closest") == [
        ("a", 1, -1, True), ("a", 1, 7, False), ("a", 1, 8, False), ("a", 1, 9, True),
        ("b", 1, None, False), ("b", 1, -1, False), ("b", 1, 2, True), ("b", 1, 3, None),
    ]


def test_join_form_repeats_rows_for_repeated_balls(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, -1, 0.0, 0.0), ("a", 1, -1, 1.0, 0.0), ("a", 1, 5, 3.0, 0.0)], SCHEMA
    )
    join = entity_distance(df, KEYS, "who", -1, XY, method="join")
    assert rows(join.where("who = 5"), "distance_sq") == [(4.0,), (9.0,)]
    window = entity_distance(df, KEYS, "who", -1, XY)
    assert rows(window.where("who = 5"), "distance_sq") == [(9.0,)]


def crowded(spark):
    """One moment with a third of all rows, many equal distances, no ball in another
    large one, and ordinary moments."""
    rng = random.Random(7)
    data = [("hot", 1, -1, 0.0, 0.0)]
    data += [("hot", 1, i, float(rng.choice([1, 2, 2, 2, 50])), 0.0) for i in range(400)]
    data += [("lost", 1, i, 1.0, 1.0) for i in range(150)]
    data += [("hot", 1, 1000 + i, None, 0.0) for i in range(90)]
    for m in range(60):
        data += [("cold", m, i - 1, rng.random(), rng.random()) for i in range(8)]
    return spark.createDataFrame(data, SCHEMA)


def test_large_moments_give_the_same_result(spark, rows, small_groups):
    df = crowded(spark)
    keys = hot_keys(df, KEYS)
    assert rows(keys) == [("hot", 1), ("lost", 1)]
    window = entity_distance_rank(df, KEYS, "who", -1, XY)
    join = entity_distance_rank(df, KEYS, "who", -1, XY, method="join")
    assert rows(window) == rows(join)
    assert rows(entity_distance(df, KEYS, "who", -1, XY)) == rows(
        entity_distance(df, KEYS, "who", -1, XY, method="join")
    )
    flagged = entity_closest_flag(df, KEYS, "who", -1, XY)
    least = join.where("rank = 1 AND game <> 'lost'").select(
        *KEYS, F.col("distance_sq").alias("least")
    )
    expected = join.join(least, KEYS).withColumn("closest", F.col("distance_sq") == F.col("least"))
    assert rows(flagged) == rows(expected, *flagged.columns)


def test_one_exchange(spark, tmp_path):
    path = str(tmp_path / "moments")
    crowded(spark).write.parquet(path)
    ranked = entity_distance_rank(spark.read.parquet(path), KEYS, "who", -1, XY)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
