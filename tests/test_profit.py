from datetime import date as D
from decimal import Decimal as Dec

import pytest
from conftest import rows, table
from pyspark.sql import functions as F

from tallyworks.operators import profit

DEF = "stt int, item_code string, item_name string, ma_so string, source string, source_col string, formula string, formula_t2 string, bac int"
VAL = "stt int, item_code string, item_name string, ma_so string, branch_code string, division_code string, amount decimal(38,4)"


def metrics(spark, *formulas):
    return table(spark, DEF, *[(i, f"I{i}", f"n{i}", code, "metrics", None, f, t2, bac) for i, (code, f, t2, bac) in enumerate(formulas)])


def values(spark, *data):
    return table(spark, VAL, *[(0, "i", "n", m, b, d, Dec(v)) for m, b, d, v in data])


def test_formula_terms(spark):
    df = table(spark, "ma_so string, formula string", ("a", " X1 + Y.2 - Z"), ("b", "-Q"), ("c", ""), ("d", None), ("e", "W"))
    assert set(rows(profit.formula_terms(df))) == {("a", "X1", 1), ("a", "Y.2", 1), ("a", "Z", -1), ("b", "Q", -1), ("e", "W", 1)}


def test_formulas_may_refer_to_formulas_in_any_order(spark):
    # R depends on S, which stands after it and depends on T.
    m = metrics(spark, ("R", "S-A", None, None), ("S", "T+B", None, None), ("T", "A+A2", None, None))
    v = values(spark, ("A", "b1", "d1", 10), ("A2", "b1", "d1", 5), ("B", "b1", "d2", 3), ("A", "b2", None, 7))
    got = {(r.ma_so, r.branch_code, r.division_code): int(r.amount) for r in profit.formula_metrics(m, v).collect()}
    assert got == {
        ("R", "b1", "d1"): 5, ("R", "b1", "d2"): 3, ("R", "b2", "KXD"): 0,
        ("S", "b1", "d1"): 15, ("S", "b1", "d2"): 3, ("S", "b2", "KXD"): 7,
        ("T", "b1", "d1"): 15, ("T", "b2", "KXD"): 7,
    }


def test_circular_formula_is_refused(spark):
    with pytest.raises(ValueError):
        profit.expanded_terms(metrics(spark, ("R", "S", None, None), ("S", "R", None, None)))


def test_divisions(spark):
    df = table(spark, "division_code string", ("TREA",), ("SME",), ("?SMEs?",), ("COST CENTER",), (None,), ("KHÁC",), ("CIB",), ("NULL",))
    got = [r[0] for r in profit.normalize_division(df).collect()]
    assert got == ["TREASURY", "SMEs", "SMEs", "NHS", "KXD", "KXD", "CIB", "KXD"]


def test_ledger_totals_take_one_date(spark):
    gl = table(spark, "report_date date, branch_code string, kpi_code string, division_code string, amount int", (D(2025, 7, 27), "001", "K", "CIB", 2), (D(2025, 7, 27), "001", "K", "CIB", 3), (D(2025, 7, 26), "001", "K", "CIB", 9))
    assert [(r[0], r[1], r[2], int(r[3])) for r in profit.ledger_totals(gl, "2025-07-27").collect()] == [("VN0010001", "K", "CIB", 5)]


def test_unpivot_drops_nulls_and_returns_to_the_pivot(spark):
    adj = table(spark, "branch_code string, item_code string, item_name string, ma_so string, INDIV decimal(30,0), FI decimal(30,0)", ("b1", "I1", "n", "m", Dec(5), None), ("b2", "I1", "n", "m", None, Dec(0)))
    defs = table(spark, "stt int, item_code string", (4, "I1"))
    long = profit.unpivot_adjustments(adj, defs, ["INDIV", "FI"])
    assert sorted((r.stt, r.branch_code, r.division_code, int(r.amount)) for r in long.collect()) == [(4, "b1", "INDIV", 5), (4, "b2", "FI", 0)]
    wide = profit.pivot_with_total(long, ["INDIV", "FI"])
    assert sorted((r.branch_code, int(r.total), int(r.INDIV), int(r.FI)) for r in wide.collect()) == [("b1", 5, 5, 0), ("b2", 0, 0, 0)]


def test_pivot_total_is_the_sum_of_its_columns(spark):
    v = values(spark, ("A", "b", "CIB", 1), ("A", "b", "FI", 2), ("A", "b", "XX", 4), ("B", "b", "XX", 8))
    plain = {r.ma_so: (int(r.total), int(r.CIB), int(r.FI)) for r in profit.pivot_with_total(v).collect()}
    assert plain == {"A": (3, 1, 2), "B": (0, 0, 0)}
    other = {r.ma_so: (int(r.total), int(r.OTHER)) for r in profit.pivot_with_total(v, other=True).collect()}
    assert other == {"A": (7, 4), "B": (8, 8)}


def test_zero_fill(spark):
    m = metrics(spark, ("A", None, None, None), ("B", None, None, None))
    branches = table(spark, "branch_code string", ("b1",), ("b2",), ("b1",))
    got = profit.zero_fill(m, branches, values(spark, ("A", "b1", "CIB", 1)))
    assert sorted((r.ma_so, r.branch_code, r.division_code, int(r.amount)) for r in got.collect()) == [
        ("A", "b1", "CIB", 1), ("A", "b2", "INDIV", 0), ("B", "b1", "INDIV", 0), ("B", "b2", "INDIV", 0),
    ]


def test_tables(spark):
    m = table(
        spark, DEF,
        (1, "I1", "n1", "A1", "ledger", "K1, K2", None, "TU_THAN", None), (2, "I2", "n2", "A2", "ledger", None, "K1-K3", "0", None),
        (3, "I3", "n3", "A3", "income", "x", None, "TU_THAN", None), (4, "I4", "n4", "B", "metrics", None, "A1-A2+A3", "A1+A3", 1), (5, "I5", "n5", "C", "metrics", None, "B+A1", "B-A1", 0),
    )
    ledger = table(spark, "branch_code string, kpi_code string, division_code string, amount int", ("b", "K1", "CIB", 10), ("b", "K2", "CIB", 5), ("b", "K3", "CIB", 1))
    income = table(spark, "branch_code string, division_code string, x int, y int", ("b", "CIB", 100, 7), ("b", "FI", None, 1))
    first = profit.first_table(m, ledger, {"income": income})
    got = {(r.ma_so, r.division_code): int(r.amount) for r in first.collect()}
    assert got == {("A1", "CIB"): 15, ("A2", "CIB"): 9, ("A3", "CIB"): 100, ("B", "CIB"): 106, ("C", "CIB"): 121}
    second = profit.second_table(m, first)
    got = {r.ma_so: int(r.amount) for r in second.collect()}
    assert got == {"A1": 15, "A2": 0, "A3": 100, "B": 115, "C": 100}
    both = profit.side_by_side(profit.pivot_with_total(first), profit.pivot_with_total(second)).collect()
    assert [(r.ma_so, int(r.total), int(r.total_t2)) for r in both] == [("A1", 15, 15), ("A2", 9, 0), ("A3", 100, 100), ("B", 106, 115), ("C", 121, 100)]


def test_long_chains_and_many_terms(spark):
    from tallyworks.operators.profit import expanded_terms

    schema = "ma_so string, formula string"
    chain = [(f"M{i}", f"M{i + 1}-X") for i in range(1_500)] + [("M1500", "Y")]
    got = {(r.ma_so, r.term): r.coefficient for r in expanded_terms(table(spark, schema, *chain)).collect()}
    assert got["M0", "Y"] == 1 and got["M0", "X"] == -1_500 and got["M1499", "X"] == -1
    wide = [(f"W{i}", "+".join(f"T{j}" for j in range(6))) for i in range(2_000)]
    assert expanded_terms(table(spark, schema, *wide)).count() == 12_000
    with pytest.raises(ValueError):
        expanded_terms(table(spark, schema, ("A", "B+C"), ("B", "A")))
