import random

import pytest

from tracklane.operators.runs import runs
from tracklane.operators.skew import chunked_row_number, ordered_chunks

SCHEMA = "game string, event bigint, at bigint, who bigint"


def expected_runs(data):
    out = []
    for game in sorted({d[0] for d in data if d[0] is not None}):
        seq = sorted(
            (d for d in data if d[0] == game),
            key=lambda d: tuple((v is None, v or 0) for v in d[1:3]),
        )
        number, ids, previous = 0, [], None
        for d in seq:
            if previous is None or (d[3] is not None and d[3] != previous):
                number += 1
            ids.append(number)
            previous = d[3]
        out += [(*d, i, ids.count(i)) for d, i in zip(seq, ids)]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))


def test_hand_worked(spark, rows):
    data = [
        ("a", 1, 1, 5), ("a", 1, 2, 5), ("a", 2, 1, 6), ("a", 2, 2, 5),
        ("b", 1, 1, 5),
        # a NULL continues the run before it; whatever follows it starts a new one
        ("c", 1, 1, 4), ("c", 1, 2, None), ("c", 1, 3, 4), ("c", 1, 4, 4),
        (None, 1, 1, 4),
    ]
    df = runs(spark.createDataFrame(data, SCHEMA), ["game"], ["event", "at"], "who")
    assert rows(df, "game", "event", "at", "run_id", "run_length") == [
        ("a", 1, 1, 1, 2), ("a", 1, 2, 1, 2), ("a", 2, 1, 2, 1), ("a", 2, 2, 3, 1),
        ("b", 1, 1, 1, 1),
        ("c", 1, 1, 1, 2), ("c", 1, 2, 1, 2), ("c", 1, 3, 2, 2), ("c", 1, 4, 2, 2),
    ]


def shaped(kind, seed=3):
    rng = random.Random(seed)
    values = {
        "mixed": lambda i: rng.choice([1, 1, 1, 2, None]),
        "one run": lambda i: 1,
        "alternating": lambda i: i % 2,
        "all null": lambda i: None,
        "long runs": lambda i: i // 97,
    }[kind]
    # event 5 alone is larger than a chunk and has to be cut by time
    events = [rng.choice([1, 2, 5, 5, 5, 5, 9, 1000]) for _ in range(600)]
    hot = [("hot", e, i, values(i)) for i, e in enumerate(events)]
    hot += [("hot", None, i, values(i)) for i in range(120)]
    small = [(f"g{i % 5}", i, i, values(i)) for i in range(60)]
    return hot + small


@pytest.mark.parametrize("kind", ["mixed", "one run", "alternating", "all null", "long runs"])
def test_large_game_is_cut_and_stitched(spark, rows, small_groups, kind):
    data = shaped(kind)
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    assert rows(runs(df, ["game"], ["event", "at"], "who")) == expected_runs(data)


def test_both_paths_agree(spark, rows):
    data = shaped("mixed", seed=11)
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(runs(df, ["game"], ["event", "at"], "who")) == expected_runs(data)


def test_chunks_are_small_and_ordered(spark, small_groups):
    df = spark.createDataFrame(shaped("mixed"), SCHEMA).where("game = 'hot'")
    cut, chunks = ordered_chunks(df, ["game"], ["event", "at"])
    assert chunks
    got = [tuple(r) for r in cut.select(*chunks, "event", "at").collect()]
    n = len(chunks)
    ordered = sorted(got, key=lambda t: tuple((v is None, v or 0) for v in t[n:]))
    assert [t[:n] for t in ordered] == sorted(t[:n] for t in got)
    largest = max([t[:n] for t in got].count(c) for c in {t[:n] for t in got})
    assert largest <= 40


@pytest.mark.parametrize(
    "kind, make",
    [
        ("double", lambda r: r.choice([float("nan"), float("inf"), -float("inf"), r.random(), None])),
        ("string", lambda r: r.choice(["", "a", "ab", "b" * 9, "ä", None]) if r.random() < 0.5
         else str(r.random())),
        ("timestamp_ntz", lambda r: None if r.random() < 0.1 else __import__("datetime").datetime(
            2015, 3, 8, r.randrange(24), r.randrange(60), r.randrange(60), r.randrange(1000000))),
        ("date", lambda r: __import__("datetime").date(2015, r.randrange(1, 13), 1)),
        ("boolean", lambda r: r.choice([True, False, None])),
        ("decimal(10,2)", lambda r: __import__("decimal").Decimal(r.randrange(1000)) / 4),
    ],
)
def test_chunked_row_number_by_type(spark, small_groups, kind, make):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rng = random.Random(5)
    data = [("g", make(rng), i) for i in range(300)]
    df = spark.createDataFrame(data, f"game string, v {kind}, i bigint")
    order = [F.col("v").asc_nulls_last(), F.col("i")]
    plain = F.row_number().over(Window.partitionBy("game").orderBy(*order))
    got = chunked_row_number(df, ["game"], ["v", "i"], "n").select("i", "n").collect()
    want = df.select("i", plain.cast("bigint").alias("n")).collect()
    assert sorted(got) == sorted(want)


def test_text_with_a_common_prefix_is_cut(spark, small_groups):
    rng = random.Random(9)
    names = [f"00215000{rng.randrange(10**6):06d}" for _ in range(400)] + ["0021500"] * 3
    df = spark.createDataFrame([("g", n, i) for i, n in enumerate(names)], "game string, v string, i int")
    cut, chunks = ordered_chunks(df, ["game"], ["v", "i"])
    got = sorted((r["v"], r["i"], tuple(r[c] for c in chunks)) for r in cut.collect())
    assert [t[2] for t in got] == sorted(t[2] for t in got)
    sizes = [sum(1 for t in got if t[2] == c) for c in {t[2] for t in got}]
    assert len(sizes) > 8 and max(sizes) <= 40


def test_common_prefixes_and_uneven_values_are_cut(spark):
    from pyspark.sql import functions as F

    from tracklane.operators import skew

    spark.conf.set(skew.HOT_ROWS_KEY, "1000")
    try:
        text = F.concat(F.lit("x" * 32), F.lpad(F.col("id").cast("string"), 9, "0"))
        same = F.lit(1)
        for order in (text, F.exp(F.col("id") / 400), F.when(F.col("id") < 5, 1), same):
            df = spark.range(60_000).select(F.lit("g").alias("k"), order.alias("v"), "id")
            cut, chunks = ordered_chunks(df, ["k"], ["v"])
            sizes = cut.groupBy(*chunks).agg(
                F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")
            )
            found = sizes.orderBy(*chunks).collect()
            assert max(r.n for r in found) <= 2000 and len(found) >= 60
            ends = [(r.lo, r.hi) for r in found if r.lo is not None]
            assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
    finally:
        spark.conf.unset(skew.HOT_ROWS_KEY)


def test_one_game_with_all_rows(spark, rows, small_groups):
    """No task holds more than some ranges, and rows are exchanged once for both their runs
    and the summaries."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    data = [("only", i // 7, i, rng.choice([1, 1, 1, 2])) for i in range(2000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = runs(df, ["game"], ["event", "at"], "who")
    assert rows(found) == expected_runs(data)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = runs(df, ["game"], ["event", "at"], "who").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in sizes.collect()) < 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_and_small_games_in_one_plan(spark, rows, small_groups):
    data = shaped("mixed", seed=21) + [("one", None, None, None), (None, 1, 1, 1)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = runs(df, ["game"], ["event", "at"], "who")
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found) == expected_runs(data)
