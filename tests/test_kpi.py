from datetime import date as D
from datetime import datetime as T
from datetime import timedelta
from decimal import Decimal as Dec

import pytest
from conftest import rows, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.operators import kpi, ordering

LONG_AGO = D(3000, 1, 1)


def bands(spark):
    return table(
        spark, "code string, lo int, hi int, level int",
        ("A", 0, 10, 1), ("A", 11, 20, 2), ("B", 0, 100, 3),
    )


def test_band_join_bounds(spark):
    fact = table(spark, "id int, code string, v int", (1, "A", 0), (2, "A", 10), (3, "A", 11), (4, "A", 21), (5, "B", 50), (6, "C", 1), (7, "A", None))
    got = {r.id: r.level for r in kpi.band_join(fact, bands(spark), ["code"], "v", "lo", "hi").collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: None, 5: 3, 6: None, 7: None}


def test_overlapping_bands(spark):
    assert kpi.overlapping_bands(bands(spark), ["code"], "lo", "hi").count() == 0
    bad = bands(spark).unionByName(table(spark, "code string, lo int, hi int, level int", ("A", 10, 12, 9)))
    assert sorted(r.level for r in kpi.overlapping_bands(bad, ["code"], "lo", "hi").collect()) == [2, 9]


def test_claim_slices_on_a_leap_day(spark):
    claims = table(spark, "id int, claim_approved_date date", (1, D(2024, 2, 29)), (2, D(2023, 2, 28)), (3, LONG_AGO), (4, D(2024, 2, 28)), (5, None))
    got = {r.id: r.slice for r in kpi.claim_slices(claims, "2024-02-29").collect()}
    assert got == {1: "settled", 2: "last_year", 3: "open"}


def test_milestones_do_not_inflate_amounts(spark):
    claims = table(spark, "claim_id int", (1,), (2,))
    log = table(
        spark, "claim_id int, action string, created_date timestamp_ntz",
        *[(1, "M_CHUYEN_C", T(2025, 1, d)) for d in (1, 2, 3)], (1, "V_DUYET", T(2025, 1, 9)), (1, "V_DUYET_DG_BL", T(2025, 1, 8)),
    )
    clauses = table(spark, "claim_id int, business_type_code string, compensation_amount int", (1, "X", 5), (1, "Y", 7))
    levels = table(spark, "business_type_code string, amount_from int, amount_to int, level int", ("X", 0, 9, 4), ("Y", 0, 9, 2))
    got = kpi.claim_milestones(log, claims, clauses, levels).collect()
    assert len(got) == 1 and got[0].amount == 12 and got[0].level == 4
    assert (got[0].check_received_at, got[0].validated_at) == (T(2025, 1, 3), T(2025, 1, 9))


def brute_seconds(start, end, holidays=()):
    total, day = 0, start.date()
    while day <= end.date():
        if day.weekday() < 5 and day not in holidays:
            opens = T.combine(day, T.min.time()) + timedelta(hours=8)
            closes = opens + timedelta(hours=9)
            total += max(0, int((min(end, closes) - max(start, opens)).total_seconds()))
        day += timedelta(1)
    return total


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 20 * 86400), st.integers(0, 9 * 86400)), min_size=15, max_size=15))
def test_working_seconds_property(spark, pairs):
    base, holiday = T(2024, 12, 20), D(2025, 1, 1)
    data = [(base + timedelta(seconds=a), base + timedelta(seconds=a + b)) for a, b in pairs]
    df = table(spark, "a timestamp_ntz, b timestamp_ntz", *data)
    calendar = kpi.business_calendar(kpi.day_bounds(spark, "2024-12-01", "2025-02-01"), table(spark, "day date", (holiday,)))
    got = rows(kpi.working_seconds(df, "a", "b", calendar))
    assert all(s == brute_seconds(a, b, {holiday}) for a, b, s in got) and len(got) == len(data)


def test_working_seconds_without_a_start(spark):
    calendar = kpi.business_calendar(kpi.day_bounds(spark, "2025-01-01", "2025-01-31"))
    df = table(spark, "a timestamp_ntz, b timestamp_ntz", (None, T(2025, 1, 6, 9)), (T(2025, 1, 7, 9), T(2025, 1, 6, 9)))
    assert [r.working_seconds for r in kpi.working_seconds(df, "a", "b", calendar).orderBy("a").collect()] == [None, 0]


def test_tier_limits(spark):
    values = [19_999_999, 20_000_000, 50_000_000, 50_000_001, 100_000_000, 100_000_001]
    df = table(spark, "v int", *[(v,) for v in values])
    limit = lambda tiers: [r[0] for r in df.select("v", kpi.tier_limit(F.col("v"), tiers).alias("x")).orderBy("v").select("x").collect()]
    assert limit(kpi.CHECK_LIMITS) == [7200, 14400, 14400, 18000, 18000, 36000]
    assert limit(kpi.VALIDATE_LIMITS) == [7200, 7200, 7200, 10800, 10800, 21600]


def test_period_edges_take_the_newest(spark):
    claims = table(spark, "claim_id int, system_date date, claim_approved_date date", (1, D(2025, 1, 1), LONG_AGO), (2, D(2025, 1, 1), D(2025, 3, 1)), (3, D(2025, 2, 22), LONG_AGO), (4, D(2025, 1, 1), LONG_AGO))
    requests = table(
        spark, "claim_id int, request_amount int, requested_at timestamp_ntz",
        (1, 10, T(2025, 1, 5, 1, 1, 1)), (1, 20, T(2025, 2, 1, 1, 1, 1)), (1, 30, T(2025, 2, 22, 1, 1, 1)), (1, 40, T(2025, 3, 1, 1, 1, 1)),
        (1, 99, T(2025, 3, 5, 1, 1, 0)), (1, 98, T(2025, 3, 20, 1, 1, 1)), (2, 5, T(2025, 1, 5, 1, 1, 1)), (2, 6, T(2025, 3, 1, 1, 1, 1)),
    )
    quotes = table(spark, "claim_id int, approval_amount int, quoted_at timestamp_ntz", (2, 7, T(2025, 1, 2)), (3, 1, T(2025, 1, 1)), (4, 3, T(2025, 3, 1)))
    clauses = table(spark, "claim_id int, compensation_amount int", (1, 100), (2, 200), (2, 1), (4, 4))
    got = kpi.period_edge_estimates(claims, requests, quotes, clauses, "2025-03-20")
    assert sorted((r.claim_id, int(r.opening_value), int(r.closing_value)) for r in got.collect()) == [(1, 20, 40), (2, 7, 201)]


def test_period_edges_are_dealt_over_tasks_that_grow(spark, tmp_path, monkeypatch):
    """Entries of one moment, both sides, repeated and NULL claims, claims without a clause: the same values
    however many tasks the entries are dealt over."""
    data = [(c, k, T(2025, m, d, 1, 1, s), a) for c in (1, 1, 2, 3, None) for k, m, d, s, a in (
        ("q", 1, 5, 0, 7), ("q", 1, 5, 0, 9), ("q", 2, 25, 0, 4), ("r", 1, 9, 1, 50), ("r", 2, 26, 1, 60), ("r", 3, 20, 1, 70), ("r", 3, 1, 0, 80),
    ) if (c, k) != (3, "q")]
    table(spark, "claim_id int, kind string, at timestamp_ntz, amount int", *data).write.parquet(str(tmp_path / "entries"))
    stored = spark.read.parquet(str(tmp_path / "entries"))
    claims = table(spark, "claim_id int, system_date date, claim_approved_date date", *[(c, D(2025, 1, 1), LONG_AGO) for c in (1, 1, 2, 3, 4, None)])
    asked, quoted = (
        stored.filter(F.col("kind") == kind).select("claim_id", F.col("at").alias(at), F.col("amount").alias(amount))
        for kind, at, amount in (("r", "requested_at", "request_amount"), ("q", "quoted_at", "approval_amount"))
    )
    clauses = table(spark, "claim_id int, compensation_amount int", (1, 5), (3, None), (None, 2))

    def found():
        return kpi.period_edge_estimates(claims, asked, quoted, clauses, "2025-03-20")

    whole = sorted(rows(found().select("claim_id", "opening_value", "closing_value")))
    assert whole == [(1, Dec(9), Dec(4)), (1, Dec(9), Dec(4)), (3, Dec(50), Dec(60))]
    monkeypatch.setattr(ordering, "TASK_BYTES", 1)
    monkeypatch.setattr(ordering, "MAX_RANGES", 9)
    monkeypatch.setattr(ordering, "UNKNOWN_BYTES", 1 << 80)
    dealt = found()
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    assert sorted(rows(dealt.select("claim_id", "opening_value", "closing_value"))) == whole


def facts(spark):
    return table(
        spark, "region string, department_code string, employee_code string, id int, v int, level int",
        ("MB", "D1", "E1", 1, 10, 1), ("MB", "D1", "E1", 1, 5, 2), ("MB", "D1", "E2", 2, 7, 1), ("MN", "D2", "E3", 3, -4, 9),
        (None, "D3", "E4", 4, 1, 1),
    )


def test_metric_union_equals_separate_aggregations(spark):
    df = facts(spark)
    specs = [
        kpi.Metric("n", "all"), kpi.Metric("n1", "level 1", F.col("level") == 1), kpi.Metric("s", "sum", None, F.col("v")),
        kpi.Metric("s1", "sum 1", F.col("level") == 1, F.col("v")), kpi.Metric("none", "none", F.lit(False)),
    ]
    got = {(r.employee_code, r.code): r.value for r in kpi.metric_union(df, specs, "id").collect()}
    assert got == {
        ("E1", "n"): 1, ("E1", "n1"): 1, ("E1", "s"): 15, ("E1", "s1"): 10, ("E2", "n"): 1, ("E2", "n1"): 1, ("E2", "s"): 7, ("E2", "s1"): 7,
        ("E3", "n"): 1, ("E3", "s"): -4, ("E4", "n"): 1, ("E4", "n1"): 1, ("E4", "s"): 1, ("E4", "s1"): 1,
    }


def test_folded_facts_equal_separate_aggregations(spark):
    df = facts(spark).withColumn("other", F.concat(F.lit("O"), "id"))
    level = F.col("level")
    own = [
        kpi.Metric("n", "all"), kpi.Metric("s", "sum", None, F.col("v")), kpi.Metric("r", "rated", level == 1, F.col("v") * F.lit(0.5)),
        kpi.Metric("none", "none", F.lit(False)), kpi.Metric("C", "Level ", level.between(1, 8), per=level.cast("string"), suffix="!"),
    ]
    other = [kpi.Metric("o", "others", level == 1)]
    both = kpi.metric_facts(df, {"employee_code": own, "other": other}, "id").unionByName(
        kpi.metric_facts(df.limit(0), {"employee_code": own}, "id")
    )
    got = kpi.fold_facts(both).withColumn("value", kpi.fact_value())
    wanted = kpi.metric_union(df, own[:4], "id").unionByName(kpi.level_counts(df, "id", "C", "Level ", suffix="!"))
    wanted = wanted.unionByName(kpi.metric_union(df.drop("employee_code").withColumnRenamed("other", "employee_code"), other, "id"))
    columns = [*kpi.KEYS, "code", "name", "value"]
    assert sorted(rows(got.select(*columns)), key=str) == sorted(rows(wanted.select(*columns)), key=str)
    total = kpi.group_total(kpi.fold_facts(both), "s", "department_code", "t", "total").withColumn("value", kpi.fact_value())
    want = kpi.broadcast_group_total(df, ["department_code"], F.col("v"), "t", "total")
    assert sorted(rows(total.select(*columns)), key=str) == sorted(rows(want.select(*columns)), key=str)


def test_a_day_of_kpis_is_folded_in_one_aggregation(spark, data_dir):
    from tallyworks.plans.kpi import kpi_sources
    from tallyworks.sources import Tables, save_intermediate

    saved = []
    sources = kpi_sources(Tables(spark, data_dir))
    kpi.kpi_dataset(sources, "1998-06-20", lambda df, name: saved.append((name, df)) or save_intermediate(df, name))
    assert [name for name, _ in saved] == ["claims", "metrics"]
    plan = saved[1][1]._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_day_of_kpis_sorts_and_groups_only_what_the_day_asks(spark, data_dir, monkeypatch):
    """Clauses of the milestones, deductions and calls are those of the day's claims, and the log is dealt."""
    from tallyworks.plans.kpi import kpi_sources
    from tallyworks.sources import Tables, save_intermediate

    sources, seen = kpi_sources(Tables(spark, data_dir)), {}
    monkeypatch.setattr(ordering, "TASK_BYTES", 1 << 12)
    whole = kpi.claim_milestones
    monkeypatch.setattr(kpi, "claim_milestones", lambda *given: seen.update(log=given[0], clauses=given[2]) or whole(*given))
    got = kpi.kpi_dataset(sources, "1998-06-20", save_intermediate)
    on_day = {r[0] for r in sources["log"].filter("to_date(created_date) = '1998-06-20'").select("claim_id").distinct().collect()}
    asked = seen["clauses"].collect()
    assert on_day and {r.claim_id for r in asked} == on_day
    assert len(asked) == sources["clauses"].filter(F.col("claim_id").isin(*on_day)).count() < sources["clauses"].count()
    assert "REPARTITION_BY_NUM" in seen["log"]._jdf.queryExecution().toString()
    monkeypatch.undo()
    assert sorted(rows(got)) == sorted(rows(kpi.kpi_dataset(sources, "1998-06-20", save_intermediate)))


def test_group_total_reaches_every_member(spark):
    got = kpi.broadcast_group_total(facts(spark), ["department_code"], F.col("v"), "t", "total")
    assert {r.employee_code: r.value for r in got.collect()} == {"E1": 22, "E2": 22, "E3": -4, "E4": 1}


def test_level_counts_and_backlog(spark):
    got = {(r.employee_code, r.code): r.value for r in kpi.level_counts(facts(spark), "id", "C", "Level ").collect()}
    assert got == {("E1", "C1"): 1, ("E1", "C2"): 1, ("E2", "C1"): 1, ("E4", "C1"): 1}
    aged = facts(spark).withColumn("opened", F.when(F.col("id") == 1, F.lit(D(2025, 1, 1))).otherwise(F.lit(D(2025, 1, 2))))
    old = kpi.aged_backlog(aged, "2025-02-15", "id", "opened")
    assert sorted((r.employee_code, r.code) for r in old.collect()) == []
    old = kpi.aged_backlog(aged, "2025-02-16", "id", "opened")
    assert sorted((r.employee_code, r.code) for r in old.collect()) == [("E1", "GD_ton_lau_lv1"), ("E1", "GD_ton_lau_lv2")]


def test_head_rollup_counts_people_at_home(spark):
    tall = table(
        spark, "region string, department_code string, employee_code string, code string, name string, value double",
        ("MB", "D1", "head", "x", "X", 1.0), ("MB", "D1", "e1", "x", "X", 2.0), ("MN", "D2", "e1", "x", "X", 4.0), ("MB", "D1", "head", "y", "Y", 8.0), ("MB", "D1", "stranger", "x", "X", 16.0),
    )
    employees = table(spark, "employee_code string, department_code string", ("head", "D1"), ("e1", "D1"))
    heads = table(spark, "employee_code string, department_code string", ("head", "D1"))
    regions = table(spark, "department_code string, region string", ("D1", "MB"))
    got = kpi.head_rollup(tall, employees, heads, regions, ["x"])
    assert sorted((r.employee_code, r.code, r.value) for r in got.collect()) == [
        ("e1", "x", 2.0), ("e1", "x", 4.0), ("head", "x", 7.0), ("head", "y", 8.0), ("stranger", "x", 16.0),
    ]
    shown = kpi.publish(got.unionByName(tall.filter("false")), "2025-03-21")
    assert {(r.report_month, r.region) for r in shown.collect()} == {("2025-04", "Miền Bắc"), ("2025-04", "Miền Nam")}


def test_publish_drops_zero_and_regionless_rows(spark):
    tall = kpi.metric_union(facts(spark), [kpi.Metric("z", "zero", None, F.col("v") * 0), kpi.Metric("n", "rows")], "id")
    got = kpi.publish(tall, "2025-03-20").collect()
    assert {(r.employee_code, r.code) for r in got} == {("E1", "n"), ("E2", "n"), ("E3", "n")}


@pytest.mark.parametrize("day", ["1998-06-20", "1998-06-21", "1998-07-01"])
def test_edge_metrics_only_on_their_days(spark, data_dir, day):
    from tallyworks.plans.kpi import kpi_sources
    from tallyworks.sources import Tables, save_intermediate

    got = kpi.kpi_dataset(kpi_sources(Tables(spark, data_dir)), day, save_intermediate)
    codes = {r.code for r in got.select("code").distinct().collect()}
    assert ("GD_GT_HSBT_ton_dau_ky" in codes) == day.endswith("21")
    assert ("GD_GT_HSBT_ton_cuoi_ky" in codes) == day.endswith("20")
    assert "GD_HSBT_ton_dau_ky" in codes


@pytest.mark.parametrize("how", ["left", "inner"])
def test_band_join_by_bins_equals_the_broadcast_join(spark, how):
    """Overlapping and nested bands, points, empty and NULL bounds, values on bounds and a hot value."""
    import random

    rnd = random.Random(4)
    money = lambda: Dec(rnd.choice([rnd.randrange(-500, 500), rnd.randrange(10**7)])) / 100
    data = []
    for i in range(150):
        low = money()
        data.append((rnd.choice(["a", "b"]), low, low + Dec(rnd.choice([0, 1, 99, 5_000, 10**8])) / 100, i))
    data += [("a", Dec(5), Dec(1), 900), ("a", None, Dec(9), 901), (None, Dec(0), Dec(9), 902), ("c", Dec("-0.01"), Dec("0.01"), 903)]
    bounds = [x for _, low, high, _ in data for x in (low, high) if x is not None]
    facts = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([rnd.choice(bounds), money(), None])) for i in range(400)]
    facts += [(1_000 + i, "a", Dec("1.00")) for i in range(200)]
    fact = table(spark, "id int, code string, v decimal(18,2)", *facts)
    found = table(spark, "code string, lo decimal(18,2), hi decimal(18,2), level int", *data)
    small = kpi.band_join(fact, found, ["code"], "v", "lo", "hi", how)
    binned = kpi.band_join(fact, found, ["code"], "v", "lo", "hi", how, max_bytes=0)
    assert binned.columns == small.columns and sorted(rows(binned), key=str) == sorted(rows(small), key=str)
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "hashpartitioning(code#" in plan
    by_code = [x for x in plan.splitlines() if "Exchange hashpartitioning(code#" in x and x.split("hashpartitioning(")[1].count("#") == 1]
    assert not by_code
    assert kpi.band_join(fact, found.limit(0), ["code"], "v", "lo", "hi", "left", max_bytes=-1).count() == 600


def test_band_lookups_are_few_and_dealt_over_tasks_that_grow(spark, tmp_path, monkeypatch):
    """Bands up to 2^9 wide are three levels, and points one more, not ten; facts and lookups are dealt."""
    widths = [x for n in range(1, 9) for x in (2**n - 1, 2**n, 2**n + 1)] + [0, 512]
    found = table(spark, "code string, lo double, hi double, level int", *[("a", 100.0 - w, 100.0, i) for i, w in enumerate(widths)], ("b", -8.0, 8.0, 90))
    table(spark, "code string, v double", *[(c, float(v)) for c in "ab" for v in range(-450, 120, 3)], ("a", None), (None, 1.0)).write.parquet(str(tmp_path / "facts"))
    fact = spark.read.parquet(str(tmp_path / "facts"))
    small = sorted(rows(kpi.band_join(fact, found, ["code"], "v", "lo", "hi")), key=str)
    monkeypatch.setattr(ordering, "TASK_BYTES", ordering._input_bytes(fact) // 9)
    binned = kpi.band_join(fact, found, ["code"], "v", "lo", "hi", max_bytes=0)
    assert sorted(rows(binned), key=str) == small
    assert binned._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    pairs = fact.select("code", "v").distinct()
    lookups = kpi.band_matches(pairs, found, ["code"], "v", "lo", "hi")._jdf.queryExecution().optimizedPlan().toString()
    listed = [x for x in lookups.splitlines() if "explode(array(" in x and "__level" in x]
    assert listed and all(x.count("__level") <= 5 for x in listed), listed
