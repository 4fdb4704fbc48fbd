import random

import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.operators import ordering
from tallyworks.operators.ordering import (
    dense_rank_all,
    next_ids,
    number_rows,
    ordered_concat,
    ordered_scan,
    running_total,
)

CUT = {"ranges": 5, "per_range": 8}


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows; key 1 holds half of them, some keys and values are NULL."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = 1 if rnd.random() < 0.5 else rnd.choice([None, 2, 3, 4, 5, 6, 7])
        data.append((i, key, rnd.randrange(40), rnd.choice([None, rnd.randrange(100)]), f"n'{i % 7}\\"))
    return spark.createDataFrame(data, "id int, k int, o int, v int, s string").cache()


def test_keyed_scan_equals_plain_windows(skewed):
    got = ordered_scan(
        skewed,
        ["o", "id"],
        ["k"],
        number="n",
        running={"t": "v"},
        previous={"p": "v"},
        following={"f": "s"},
        fill_down={"d": "v"},
        fill_up={"u": "v"},
        **CUT,
    )
    w = W.partitionBy("k").orderBy("o", "id")
    want = skewed.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("t"),
        F.lag("v").over(w).alias("p"),
        F.lead("s").over(w).alias("f"),
        F.last("v", True).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("d"),
        F.first("v", True).over(w.rowsBetween(0, W.unboundedFollowing)).alias("u"),
    )
    assert got.columns == want.columns
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "id"], ["s", "-id"], ["-s", "o", "id"]])
def test_global_number_and_total(skewed, order):
    got = ordered_scan(skewed, order, number="n", running={"t": "v"}, **CUT)
    cols = [F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in order]
    w = W.partitionBy(F.lit(1)).orderBy(*cols)
    want = skewed.select(
        "*",
        F.row_number().over(w).cast("bigint").alias("n"),
        F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("t"),
    )
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_global_neighbours(skewed):
    got = ordered_scan(skewed, ["o", "id"], previous={"p": "v"}, following={"f": "v"}, **CUT)
    w = W.partitionBy(F.lit(1)).orderBy("o", "id")
    want = skewed.select("*", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("f"))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_small_frame_needs_no_cuts(skewed):
    small = skewed.limit(10)
    assert sorted(r.n for r in number_rows(small, ["id"], "n").collect()) == list(range(1, 11))
    assert running_total(small.filter("false"), ["id"], "v").count() == 0


def test_only_the_summary_is_brought_to_one_task(skewed):
    plan = number_rows(skewed, ["o", "id"], **CUT)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate(keys=[__range" in lines[single[0] + 1]
    assert any("Exchange hashpartitioning(__range" in line for line in lines[: single[0]])


def test_dense_rank_all(skewed):
    got = dense_rank_all(skewed, "v", "r", **CUT)
    w = W.partitionBy(F.lit(1)).orderBy(F.desc("v"))
    want = skewed.select("*", F.dense_rank().over(w).cast("bigint").alias("r"))
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str)


def test_next_ids(spark, skewed):
    existing = spark.createDataFrame([(-40,), (7,)], "id int")
    got = next_ids(skewed.drop("id").withColumnRenamed("o", "x").withColumn("y", F.monotonically_increasing_id()), ["x", "y"], existing, "id", **CUT)
    assert sorted(r.id for r in got.collect()) == list(range(41, 641))
    one = next_ids(spark.range(2).toDF("x"), ["x"], existing.filter("false"), "id", negative=True)
    assert sorted(rows(one)) == [(0, -1), (1, -2)]


def test_ordered_concat_in_ranges(skewed):
    got = {r.k: r.j for r in ordered_concat(skewed, ["k"], {"j": "v"}, ["o", "id"], ";", **CUT).collect()}
    plain = {r.k: r.j for r in ordered_concat(skewed, ["k"], {"j": "v"}, ["o", "id"], ";", ranges=1, per_range=10000).collect()}
    assert got == plain
    data = sorted((r for r in skewed.collect() if r.k == 1), key=lambda r: (r.o, r.id))
    assert got[1] == ";".join(str(r.v) for r in data if r.v is not None)


def test_order_by_other_types(spark, skewed):
    """Timestamps across the hour that clocks repeat, dates, decimals and doubles."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = skewed.select(
            "id",
            F.timestamp_seconds(F.lit(1729990000) + F.col("id") * 37).alias("ts"),
            F.date_add(F.lit("2024-02-27").cast("date"), F.col("o")).alias("d"),
            (F.col("v") / 7).alias("x"),
            F.col("v").cast("decimal(20,4)").alias("m"),
        ).cache()
        for order in (["ts", "id"], ["-ts"], ["-d", "-ts"], ["x", "m", "id"], ["-m", "-x", "-id"]):
            got = number_rows(df, order, "n", **CUT)
            cols = [F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in order]
            want = df.withColumn("n", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*cols)))
            assert {r.id: r.n for r in got.collect()} == {r.id: r.n for r in want.collect()}
        # A timestamp as a large key.
        keyed = df.withColumn("k", F.when(F.col("id") < 400, F.timestamp_seconds(F.lit(1729991000))).otherwise(F.col("ts")))
        got = ordered_scan(keyed, ["id"], ["k"], running={"t": "id"}, **CUT)
        want = keyed.withColumn("t", F.sum("id").over(W.partitionBy("k").orderBy("id")))
        assert {r.id: r.t for r in got.collect()} == {r.id: r.t for r in want.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_cuts_at_many_ranges(spark):
    df = spark.range(3000).withColumn("s", F.concat(F.lit("é'\"\\"), F.col("id") % 50))
    got = number_rows(df, ["s", "id"], "n", ranges=600, per_range=4)
    want = df.withColumn("n", F.row_number().over(W.partitionBy(F.lit(1)).orderBy("s", "id")))
    assert {r.id: r.n for r in got.collect()} == {r.id: r.n for r in want.collect()}


def test_hot_keys_are_cut_and_others_stay_whole(spark):
    """At 200 ranges a key with 1 % of the rows is cut, one with 0.1 % is not, and no (range, key) holds
    more than a range of rows."""
    n, target = 200_000, 1_000
    share = F.col("id") % 1_000
    key = F.when(share < 300, -1).when(share < 310, -2).when(share < 311, -3).otherwise(F.col("id") % 20_000)
    df = spark.range(0, n, 1, 7).withColumn("k", key).withColumn("one", F.lit(1))
    cuts = ordering.split_points(df, ["k", "id"], 200, keys=1)
    cut_keys = {c[0] for c in cuts}
    assert {"-1", "-2"} <= cut_keys and "-3" not in cut_keys and len(cut_keys) == 2
    ranged = ordering.with_range(df, ["k", "id"], cuts)
    sizes = ranged.groupBy("k", ordering.RANGE).count()
    assert sizes.agg(F.max("count")).first()[0] <= target
    assert sizes.filter("k >= -3 and k <> -1 and k <> -2").groupBy("k").count().agg(F.max("count")).first()[0] == 1
    got = ordered_scan(df, ["id"], ["k"], running={"n": "one"}, previous={"p": "id"}, ranges=200)
    assert got.filter("k = -1").agg(F.max("n"), F.count_if(F.col("p").isNull())).first() == (n * 3 // 10, 1)
    joined = ordered_concat(df.filter("k < 0"), ["k"], {"j": "one"}, ["id"], "", ranges=200)
    assert {r.k: len(r.j) for r in joined.collect()} == {-1: 60_000, -2: 2_000, -3: 200}


@pytest.mark.parametrize("guess", [1.0, 20_000.0, 10.0**9])
def test_frames_are_counted_with_the_sample(spark, monkeypatch, guess):
    """One job where the guessed size is about right, a second one where it is far off."""
    df = spark.range(0, 50_000, 1, 5).withColumn("k", F.when(F.col("id") < 45_000, 1).otherwise(F.col("id")))
    seen = []
    inner = ordering._sample_cuts
    monkeypatch.setattr(ordering, "_rows_guessed", lambda df: guess)
    monkeypatch.setattr(ordering, "_sample_cuts", lambda *a: seen.append(inner(*a)) or seen[-1])
    cuts = ordering.split_points(df, ["k"], 4, 16, keys=1)
    assert {c[0] for c in cuts} == {"1"} and len(cuts) >= 6
    assert all(total == 50_000 for total, _, _ in seen) and max(drawn for _, drawn, _ in seen) < 5_000
    assert len(seen) == (1 if guess == 20_000.0 else 2)
    assert ordering.split_points(df.limit(0), ["k"], 4, 16) == [] == ordering.split_points(df.limit(60), ["k"], 4, 16)
    assert len(ordering.split_points(df, ["id"], 4, 16)) == 3


def test_large_frames_get_more_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "RANGE_BYTES", 16_000)
    df = spark.range(20_000)
    cuts = ordering.split_points(df, ["id"], None, 16)
    assert len(cuts) == -(-20_000 * ordering._row_bytes(df) // 16_000) - 1
    got = number_rows(df, ["id"], "n", per_range=16)
    assert got.filter("n = id + 1").count() == 20_000


def test_spread_grows_with_the_input_and_leaves_unknown_sizes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id % 7 as k", "id").write.parquet(path)
    stored = spark.read.parquet(path)
    assert ordering.spread(stored, ["k"]) is stored
    monkeypatch.setattr(ordering, "TASK_BYTES", ordering._input_bytes(stored) // 9)
    assert ordering.spread(stored, ["k"]).rdd.getNumPartitions() == 9
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1, 2)]), "k int, v int")
    assert ordering.spread(unknown, ["k"]) is unknown


def test_large_scans_are_spread_and_equal(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(600).selectExpr("id % 5 as k", "id", "id % 3 as q").write.parquet(path)
    stored = spark.read.parquet(path)
    monkeypatch.setattr(ordering, "TASK_BYTES", max(1, ordering._input_bytes(stored) // 9))
    for cut in ({}, {"ranges": 4, "per_range": 4}):
        scanned = ordering.ordered_scan(stored, ["id"], ["k"], number="n", running={"sum": "q"}, **cut)
        assert "REPARTITION_BY_NUM" in scanned._jdf.queryExecution().toString()
        got = {r.id: (r.n, r["sum"]) for r in scanned.collect()}
        assert got == {i: (i // 5 + 1, sum(j % 3 for j in range(i % 5, i + 1, 5))) for i in range(600)}
