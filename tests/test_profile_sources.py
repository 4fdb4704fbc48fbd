from datetime import date as D

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from tallyworks.operators import profile
from tallyworks.sources import Tables, partitioned_table, read_csv, read_partition, replace_partition, replace_partitions, save_intermediate

CLAIM = "claim_id bigint, motor_category string, unit_code string, car_price double, business_car_flag string, amount double, system_date date"


@pytest.fixture(scope="module")
def claims(spark):
    return table(
        spark, CLAIM,
        (1, "XE", "'001'", None, "N", 2e9, D(2025, 9, 1)), (2, "2B", "'002'", 5.0, None, 1e9, D(2025, 1, 2)), (3, "ZZ", "'001'", 7.0, "N", 4e9, D(2025, 1, 9)),
        (3, "ZZ", "'001'", 7.0, "N", 4e9, D(2025, 1, 9)), (4, None, None, None, "Y", None, None),
    )


def test_profile(spark, claims):
    got = {r.column: (r.type, r.rows, r.missing, r.distinct, r.smallest, r.largest) for r in profile.profile(claims).collect()}
    assert got["claim_id"] == ("bigint", 5, 0, 4, "1", "4")
    assert got["unit_code"] == ("string", 5, 1, 2, "'001'", "'002'")
    assert got["system_date"] == ("date", 5, 1, 3, "2025-01-02", "2025-09-01")
    assert got["car_price"][1:4] == (5, 2, 2)
    empty = {r.column: (r.rows, r.missing, r.smallest) for r in profile.profile(claims.filter("false")).collect()}
    assert empty["claim_id"] == (0, 0, None) and len(empty) == 7
    assert rows(profile.duplicate_rows(claims)) == [(1,)]
    assert rows(profile.duplicate_rows(claims.filter("false"))) == [(0,)]


def test_clean_fills_the_price_itself(spark, claims):
    got = profile.clean(
        claims, {"car_price": 0, "business_car_flag": "Unknown"}, ["unit_code"],
        {"label": ("motor_category", {"XE": "Car", "2B": "Motorbike", "2BL": "Retail motorbike"}, "Car")},
    ).dropDuplicates(["claim_id"]).orderBy("claim_id").collect()
    assert [r.car_price for r in got] == [0.0, 5.0, 7.0, 0.0]
    assert [r.business_car_flag for r in got] == ["N", "Unknown", "N", "Y"]
    assert [r.unit_code for r in got] == ["001", "002", "001", None]
    assert [r.label for r in got] == ["Car", "Motorbike", "Car", "Car"]


def test_shares_and_tops(spark, claims):
    got = {r.motor_category: (r.rows, str(r.percent), r.is_largest) for r in profile.count_share(claims, "motor_category").collect()}
    assert got == {"XE": (1, "20.00", False), "2B": (1, "20.00", False), "ZZ": (2, "40.00", True)}
    top = profile.top_k_by(claims, "unit_code", F.sum("amount"), 1, profile.BILLION)
    assert [(r.unit_code, str(r.total_scaled)) for r in top.collect()] == [("'001'", "10.00")]
    months = profile.monthly_trend(claims, "system_date", "amount").collect()
    assert [(r.month_name, r.rows, r.amount_scaled) for r in months] == [("January", 3, 9.0), ("September", 1, 2.0)]
    means = {r.business_car_flag: r.mean_scaled for r in profile.mean_by(claims, ["business_car_flag"], "amount").collect()}
    assert means == {"N": pytest.approx(10000 / 3), "Y": None}
    wide = profile.pivot_sum(claims, "business_car_flag", "motor_category", "amount").collect()
    assert [(r.business_car_flag, r.XE, r.ZZ) for r in wide] == [("N", 2.0, 8.0)]


def test_csv_has_a_declared_schema(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("a,b\n1,x\n2,\n")
    assert rows(read_csv(spark, str(path), "a int, b string")) == [(1, "x"), (2, None)]
    path.write_text("a,b\nzz,x\n")
    with pytest.raises(Exception):
        read_csv(spark, str(path), "a int, b string").collect()


def test_partition_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "p")
    table(spark, "d string, v int", ("a", 1), ("b", 2)).write.partitionBy("d").parquet(path)
    df = read_partition(spark, path, "d", "b")
    assert rows(df) == [(2, "b")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_filters_and_columns_reach_the_scan(spark, data_dir):
    t = Tables(spark, data_dir)
    df = t.orders.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("date")).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_saved_frame_equals_its_source(spark, data_dir):
    nation = Tables(spark, data_dir).nation
    saved = save_intermediate(nation, "nation")
    assert sorted(rows(saved)) == sorted(rows(nation))
    assert spark.conf.get("spark.checkpoint.dir") in saved.inputFiles()[0]


VALUES = ["a/b", "k=v:w", "100%", " x ", "#?*[0]", "007", "é", None]


def test_partition_values_come_back_equal(spark, tmp_path):
    """Characters that paths cannot have, texts that look like numbers, and NULL."""
    path, values = str(tmp_path / "t"), VALUES
    df = table(spark, "d string, v int", *[(v, i) for i, v in enumerate(values)], ("other", 99))
    replace_partitions(df, path, "d", values[:4])
    replace_partitions(df, path, "d", values[4:])
    got = partitioned_table(spark, path)
    assert {(r.d, r.v) for r in got.collect()} == {(v, i) for i, v in enumerate(values)} and got.schema["d"].dataType.simpleString() == "string"
    # A second run replaces: one value has new rows, one has none, the others stay.
    again = table(spark, "d string, v int", ("a/b", 50), ("a/b", 51))
    replace_partitions(again, path, "d", ["a/b", None])
    want = {(v, i) for i, v in enumerate(values) if v not in ("a/b", None)} | {("a/b", 50), ("a/b", 51)}
    assert {(r.d, r.v) for r in partitioned_table(spark, path).collect()} == want
    for value in values:
        replace_partition(df.filter("v < 0"), path, "d", value)
    assert partitioned_table(spark, path).count() == 0


def test_partitions_of_days_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "t")
    day = D(2025, 1, 2)
    df = table(spark, "day date, v int", (day, 1), (None, 2))
    replace_partitions(df, path, "day", [day, None, D(2025, 1, 3)])
    assert {tuple(r) for r in partitioned_table(spark, path).select("day", "v").collect()} == {(day, 1), (None, 2)}


def test_stored_sketches_merge_to_the_profile_of_the_whole(spark, tmp_path):
    """Two days are written, one of them again: only its partition changes, and the merged sketches give what
    one pass over all rows gives, within the stated errors of the exact values."""
    path = str(tmp_path / "sketches")
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") < 25_000, "d1").otherwise("d2").alias("day"), (F.col("id") % 9_000).alias("k"),
        F.when(F.col("id") % 10 > 0, F.concat(F.lit("t"), F.col("id") % 700)).alias("t"), (F.col("id") * F.lit(0.5)).alias("x"), F.lit(None).cast("int").alias("none"),
    )
    for day in ("d1", "d2"):
        replace_partitions(profile.column_sketches(df.filter(F.col("day") == day), ["day"]), path, "day", [day])
    files = {f for f in spark.read.parquet(path).inputFiles() if "day=d1" in f}
    replace_partitions(profile.column_sketches(df.filter("day = 'd2'"), ["day"]), path, "day", ["d2"])
    assert files == {f for f in spark.read.parquet(path).inputFiles() if "day=d1" in f}
    got = {r.column: r for r in profile.sketch_profile(profile.merge_sketches(partitioned_table(spark, path))).collect()}
    assert {c: (r.rows, r.missing) for c, r in got.items()} == {"k": (40_000, 0), "t": (40_000, 4_000), "x": (40_000, 0), "none": (40_000, 40_000)}
    for column, exact in (("k", 9_000), ("t", 630), ("x", 40_000)):
        assert abs(got[column].distinct_about - exact) <= profile.DISTINCT_ERROR * exact + 1
    assert got["none"].distinct_about == 0 and got["none"].quantiles_about is None and got["t"].quantiles_about is None
    for q, value in zip((0.25, 0.5, 0.75), got["x"].quantiles_about):
        assert abs(value / 20_000 - q) <= 2 * profile.RANK_ERROR


@pytest.mark.parametrize("options", [{}, {"ranges": 4, "per_range": 4}])
def test_exact_quantiles_equal_percentile_without_a_global_list(spark, options):
    data = [(float(i * 37 % 101), i % 3 if i % 4 else None, None) for i in range(150)]
    df = table(spark, "a double, b int, c int", *data)
    quantiles = [0.0, 0.466, 0.5, 0.534, 1.0]
    got = {r.column: r.quantiles for r in profile.exact_quantiles(df, ["a", "b", "c"], quantiles, save=save_intermediate, **options).collect()}
    want = df.select(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(q) for q in quantiles])) for c in df.columns]).first()
    assert got["c"] is None and want[2] is None
    for name, values in (("a", want[0]), ("b", want[1])):
        assert got[name] == pytest.approx(values)
