from datetime import date, datetime, timedelta
from decimal import Decimal as Dec

from conftest import rows, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks import functions as fn


def test_fiscal_period_edges(spark):
    days = ["2025-03-20", "2025-03-21", "2025-01-05", "2024-12-31", "2024-02-29", "2025-12-21"]
    df = table(spark, "d string", *[(d,) for d in days]).select("d", fn.fiscal_period(F.to_date("d")).alias("p"))
    got = {r.d: (r.p.label, str(r.p.first), str(r.p.last)) for r in df.collect()}
    assert got == {
        "2025-03-20": ("2025-03", "2025-02-21", "2025-03-20"),
        "2025-03-21": ("2025-04", "2025-03-21", "2025-04-20"),
        "2025-01-05": ("2025-01", "2024-12-21", "2025-01-20"),
        "2024-12-31": ("2025-01", "2024-12-21", "2025-01-20"),
        "2024-02-29": ("2024-03", "2024-02-21", "2024-03-20"),
        "2025-12-21": ("2026-01", "2025-12-21", "2026-01-20"),
    }


def brute_gap(start, end):
    """Days minus two per week boundary, with the end corrections of the rule."""
    weeks = ((end - timedelta(end.weekday())) - (start - timedelta(start.weekday()))).days // 7
    off = 1 if end.weekday() == 5 else 1 if start.weekday() == 6 else 0
    return (end - start).days - 2 * weeks - off


def test_weekday_gap_over_new_year(spark):
    # Monday 29 December to Friday 2 January: four weekdays later, week numbers restart between.
    df = table(spark, "a date, b date", (date(2025, 12, 29), date(2026, 1, 2)), (date(2025, 12, 26), date(2026, 1, 5)))
    got = rows(df.select(fn.weekday_gap(F.col("a"), F.col("b"))))
    assert got == [(4,), (6,)]
    back = table(spark, "a date, b date", (date(2026, 1, 5), date(2026, 1, 2)))
    assert rows(back.select(fn.weekday_gap(F.col("a"), F.col("b"), True))) == [(0,)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.dates(date(2019, 1, 1), date(2027, 1, 1)), st.integers(0, 400)), min_size=20, max_size=20))
def test_weekday_gap_property(spark, pairs):
    data = [(a, a + timedelta(n)) for a, n in pairs]
    df = table(spark, "a date, b date", *data)
    got = rows(df.select("a", "b", fn.weekday_gap(F.col("a"), F.col("b"))))
    assert all(gap == brute_gap(a, b) for a, b, gap in got)


def test_assemble_timestamp(spark):
    d = date(2025, 1, 2)
    texts = ["8H30", "8h30", "8:30", "17:05:09", None, "soon", "9H"]
    df = table(spark, "d date, t string", *[(d, t) for t in texts], (None, "8H30"))
    got = [r[0] for r in df.select(fn.assemble_timestamp(F.col("d"), F.col("t"))).collect()]
    at = datetime(2025, 1, 2)
    half_past = at.replace(hour=8, minute=30)
    assert got == [half_past] * 3 + [at.replace(hour=17, minute=5, second=9), at, at, at.replace(hour=9), None]


def test_fingerprint_keeps_null_places_apart(spark):
    df = table(spark, "a string, b string, c string", ("x", None, "y"), ("x", "y", None), ("x|=y", None, None), ("x", "y|~", None), ("x", "~", "~"), ("x", None, None))
    hashes = [r[0] for r in df.select(fn.fingerprint([F.col(c) for c in "abc"])).collect()]
    assert len(set(hashes)) == 6


def test_root_code_and_quotes(spark):
    df = table(spark, "a string, d string", ("090.P1.2", "x"), (None, "MB.TD"), (None, None))
    assert rows(df.select(fn.root_code(F.col("a"), F.col("d")))) == [("090",), ("MB",), (None,)]
    assert rows(table(spark, "q string", ("'0'9'",)).select(fn.without_quotes(F.col("q")))) == [("09",)]


def test_ratios(spark):
    df = table(spark, "a int, b int", (1, 3), (1, 0), (None, 2), (1, 8), (-1, 8))
    got = [str(r[0]) for r in df.select(fn.rounded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == ["0.33", "None", "None", "0.13", "-0.13"]
    assert rows(spark.range(1).select(fn.half_up(F.lit(Dec("2.345"))))) == [(Dec("2.35"),)]


def test_ratio_is_rounded_once(spark):
    df = table(spark, "a bigint, b bigint", (4_999_999_999_999, 10**15), (-1, 8), (1, 0), (1, 200))
    got = [r[0] for r in df.select(fn.rounded_ratio(F.col("a"), F.col("b"))).collect()]
    assert [None if g is None else str(g) for g in got] == ["0.00", "-0.13", None, "0.01"]
