import os
from collections import defaultdict
from datetime import date as D
from decimal import Decimal as Dec

import pytest
from conftest import rows, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.operators import documents, stock
from tallyworks.sources import commit_tables, committed_tables, committed_versions, drop_old_versions, rows_to_xml, xml_rows

CUT = {"ranges": 4, "per_range": 4}


def brute_fifo(supply, demand):
    """Walk both lists of a key in order, taking the smaller rest each time."""
    out = {}
    for key in {k for k, _, _ in supply}:
        left = [[i, q] for k, i, q in sorted(supply) if k == key and q > 0]
        need = [[i, q] for k, i, q in sorted(demand) if k == key and q > 0]
        while left and need:
            take = min(left[0][1], need[0][1])
            out[(key, left[0][0], need[0][0])] = take
            left[0][1] -= take
            need[0][1] -= take
            left = left if left[0][1] else left[1:]
            need = need if need[0][1] else need[1:]
    return out


def allocate(spark, supply, demand, **options):
    s = spark.createDataFrame(supply, "k int, s int, q int")
    d = spark.createDataFrame(demand, "k int, d int, q int")
    got = stock.allocate_fifo(s, d, ["k"], "s", "d", ["s"], ["d"], "q", "q", **options)
    return {(r.k, r.s, r.d): int(r.allocated) for r in got.collect()}


part = st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 6)), min_size=1, max_size=25)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(part, part, st.booleans())
def test_allocation_equals_the_walk(spark, supply, demand, cut):
    s = [(k, i, q) for i, (k, q) in enumerate(supply)]
    d = [(k, i, q) for i, (k, q) in enumerate(demand)]
    got = allocate(spark, s, d, **(CUT if cut else {}))
    assert got == brute_fifo(s, d)
    for key in {k for k, _, _ in s}:
        total = lambda side: sum(q for k, _, q in side if k == key)
        assert sum(v for (k, _, _), v in got.items() if k == key) == min(total(s), total(d))
    assert all(v > 0 for v in got.values())


def test_ranges_of_two_sides_that_lie_by_key_meet(spark):
    # Both sides come out of windows by key, so their union seems to be clustered already.
    s = [(1, i, q) for i, q in enumerate([4, 2, 2, 2, 4, 6, 6, 4])]
    d = [(1, i, q) for i, q in enumerate([1, 2, 2, 3, 1, 5, 1, 3])]
    assert allocate(spark, s, d, **CUT) == brute_fifo(s, d)


def test_one_large_item_is_cut_into_ranges(spark):
    s = [(1, i, 1 + i % 3) for i in range(120)] + [(2, 500, 5)]
    d = [(1, i, 2) for i in range(100)] + [(2, 900, 3)]
    assert allocate(spark, s, d, **CUT) == brute_fifo(s, d)


def warehouses(spark):
    return table(spark, "id int, is_factory int, code string, name string, account string", (1, 0, "W1", "one", "151"), (2, 1, "W2", "two", "152"), (3, 0, "W3", "three", "153"))


LINE = "id int, item_id int, warehouse_id int, request_quantity int, quantity9 int, quantity int, is_promotion int, builtin_order int"


def test_open_lines_order_and_flags(spark):
    lines = table(
        spark, LINE,
        (1, 7, 1, 10, None, 0, None, 2), (2, 7, 1, 10, 10, 10, 0, 1), (3, 7, 1, None, 0, 0, 0, 1), (4, 7, 2, 5, 0, 0, 0, 0), (5, 7, None, 5, 0, 0, 0, 0), (6, 7, 3, 5, 1, 1, 1, 0), (7, 8, 1, 5, 9, 9, 0, 0),
    )
    got = {r.id: (r.remaining, r.enough, r.scan_order) for r in stock.open_lines(lines, warehouses(spark)).collect()}
    assert got == {1: (10, 0, 3), 2: (0, 1, 1), 3: (None, 0, 2), 4: (5, 0, 0), 5: (5, 0, 0), 6: (4, 0, 4), 7: (-4, 1, 1)}


def test_available_stock_modes(spark):
    scans = table(spark, "roll_code string, doc_group int, doc_code string", ("in", 1, "TP"), ("out", 2, "XK"), ("si", 2, "SI"), ("none", 2, "XK"))
    place = "warehouse_id int, item_id int, quantity int"
    produced = table(spark, f"row_id string, roll_code string, {place}", ("a", "si", 2, 5, 9), ("b", "si", 2, 5, 8), ("c", "none", 2, 6, 3), ("d", "out", 2, 7, 1))
    consumed = table(spark, "row_id string", ("a",), (None,))
    master = table(spark, "roll_code string, item_id int", ("in", 4), ("out", 7))
    current = table(spark, f"roll_code string, {place}", ("out", 1, 7, 5), ("out", 3, 7, 6), ("si", 1, 5, 1), ("none", 1, 6, 0))
    got = stock.available_stock(scans, produced, consumed, master, current)
    assert sorted(rows(got), key=str) == sorted([("in", None, 4, 0), ("out", 3, 7, 6), ("si", 2, 5, 8), ("none", 2, 6, 3)], key=str)
    ok, refused = stock.reject_scans(scans, table(spark, "roll_code string", ("si",)), got.filter("roll_code != 'none'"))
    assert sorted(r.roll_code for r in ok.collect()) == ["in", "out"]
    assert {r.roll_code: r.reason for r in refused.collect()} == {"si": "already scanned", "none": "no stock left"}


def test_fill_location_skips_factories(spark):
    lines = table(spark, LINE, (1, 7, None, 1, 0, 0, 0, 0), (2, 7, 1, 1, 0, 0, 0, 0), (3, 8, None, 1, 0, 0, 0, 0))
    places = table(spark, "item_id int, warehouse_id int, quantity int", (7, 2, 99), (7, 3, 5), (7, 1, 5), (8, 2, 1))
    got = {r.id: r.warehouse_id for r in stock.fill_location(lines, places, warehouses(spark)).collect()}
    assert got == {1: 1, 2: 1, 3: None}


def test_scan_out_end_to_end(spark):
    lines = table(spark, LINE, (1, 7, 1, 10, 4, 4, 0, 1), (2, 7, 1, 10, 0, 0, 0, 2), (3, 7, 1, 5, 5, 5, 0, 0), (4, 9, 3, 5, 0, 0, 0, 0))
    rolls = table(spark, "roll_code string, warehouse_id int, item_id int, quantity int", ("R1", 1, 7, 9), ("R2", 1, 8, 4))
    pieces = table(
        spark, "id bigint, item_id int, warehouse_id int, roll_code string, quantity9 decimal(28,4), quantity decimal(28,4), parent_id bigint",
        (-5, 7, 1, "old", Dec(4), Dec(4), 1), (-6, 7, 1, "old", Dec(5), Dec(5), 3),
    )
    out, given_pieces = stock.scan_out(rolls, lines, pieces, warehouses(spark))
    # the filled line 3 gets nothing although it stands first
    new = sorted((r.id, r.roll_code, int(r.quantity), r.parent_id) for r in given_pieces.collect() if r.id < -6)
    assert new == [(-9, "R1", 3, 2), (-8, "R1", 6, 1), (-7, "R2", 4, -5)]
    got = {r.id: int(r.quantity9) for r in out.collect()}
    assert got == {1: 10, 2: 3, 3: 5, 4: 0, -5: 4}


PIECE = "id bigint, item_id int, warehouse_id int, roll_code string, quantity9 decimal(28,4), quantity decimal(28,4), parent_id bigint"
CONVERTED = LINE.replace("quantity9 int, quantity int", "quantity9 decimal(28,4), quantity decimal(28,4)") + ", convert_rate9 int"


def packed_case(spark):
    """Item 7 is asked in packs of 4; item 8 is not; item 9 converts, but its packing is not known."""
    lines = table(
        spark, CONVERTED, (1, 7, 1, 2, None, Dec(0), 0, 1, 2), (2, 7, 1, 10, None, Dec(0), 0, 2, 1), (3, 8, 1, 3, None, Dec(0), 0, 1, 1), (4, 9, 1, 3, None, Dec(0), 0, 1, 2),
    )
    items = table(spark, "id int, packing decimal(18,2)", (7, Dec(4)), (8, Dec(5)), (9, None))
    rolls = table(spark, "roll_code string, warehouse_id int, item_id int, quantity int", ("R1", 1, 7, 9), ("R2", 1, 8, 7), ("R3", 1, 9, 5), ("R4", 3, 7, 6))
    return rolls, lines, table(spark, PIECE), items


def pieces_of(df):
    return {(r.roll_code, r.parent_id): (float(r.quantity9), float(r.quantity)) for r in df.collect()}


def test_scan_out_in_packs(spark):
    rolls, lines, pieces, items = packed_case(spark)
    out, given = stock.scan_out(rolls, lines, pieces, warehouses(spark), items)
    # 9 units are 2.25 packs: 2 for the first line, 0.25 for the second, which the table keeps in both units
    assert pieces_of(given) == {("R1", 1): (2, 8), ("R1", 2): (0.25, 1), ("R2", 3): (3, 3), ("R4", -5): (6, 6)}
    assert {r.id: (r.quantity9 and float(r.quantity9), float(r.quantity)) for r in out.collect()} == {
        1: (2, 8), 2: (0.25, 1), 3: (3, 3), 4: (None, 0), -5: (6, 6),
    }
    _, plain = stock.scan_out(rolls, lines, pieces, warehouses(spark), items, doc_code="SI")
    assert pieces_of(plain)["R1", 1] == (2, 2) and pieces_of(plain)["R1", 2] == (7, 7) and pieces_of(plain)["R3", 4] == (3, 3)


def test_a_batch_of_scans_is_committed_once(spark, tmp_path):
    rolls, lines, pieces, items = packed_case(spark)
    root = str(tmp_path / "out")
    commit_tables(spark, root, "opening", {stock.LINES: lines, stock.PIECES: pieces})
    run = lambda name: stock.scan_out_batch(spark, root, name, rolls, warehouses(spark), items)
    first = [sorted(map(tuple, df.collect()), key=str) for df in run("b1")]
    assert committed_versions(spark, root) == [(1, "opening"), (2, "b1")]
    assert [sorted(map(tuple, df.collect()), key=str) for df in run("b1")] == first
    assert committed_versions(spark, root) == [(1, "opening"), (2, "b1")]
    # The next batch goes on from there: the second line still wants 9.75 packs, the first nothing. The
    # line that R4 opened has no request, so it takes no more, and no other one is opened for its place.
    second = pieces_of(run("b2")[1].filter("id < -4"))
    assert second == {("R1", 2): (2.25, 9)}
    assert [sorted(map(tuple, df.collect()), key=str) for df in run("b1")] == first


def test_a_crash_between_the_two_tables_changes_nothing(spark, tmp_path, monkeypatch):
    rolls, lines, pieces, items = packed_case(spark)
    root = str(tmp_path / "out")
    commit_tables(spark, root, "opening", {stock.LINES: lines, stock.PIECES: pieces})
    broken = table(spark, "id int", (1,)).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        commit_tables(spark, root, "b1", {stock.LINES: lines.limit(1), stock.PIECES: broken})
    assert committed_versions(spark, root) == [(1, "opening")]
    assert committed_tables(spark, root, [stock.LINES])[stock.LINES].count() == 4
    _, given = stock.scan_out_batch(spark, root, "b1", rolls, warehouses(spark), items)
    assert given.count() == 4 and committed_versions(spark, root)[-1] == (2, "b1")
    drop_old_versions(spark, root, [stock.LINES, stock.PIECES], keep=1)
    assert sorted(os.listdir(f"{root}/{stock.LINES}")) == ["2"]
    assert committed_versions(spark, root)[0] == (1, "opening") and given.count() == 4


def test_receipts_and_units(spark):
    lines = table(spark, "id int, item_id int, quantity int, convert_rate9 int", (1, 7, 10, 2), (2, 7, 10, 1), (3, 8, 10, 2), (4, 9, 10, 2))
    got = stock.receipt_pieces(lines, table(spark, "item_id int, roll_code string", (7, "R1")))
    assert {(r.parent_id, r.roll_code, int(r.quantity)) for r in got.collect()} == {(1, "R1", 0), (2, "R1", 0), (3, None, 0), (4, None, 0)}
    items = table(spark, "id int, packing decimal(18,2)", (7, Dec(4)), (8, Dec(0)), (9, None))
    assert {r.id: r.quantity9 and float(r.quantity9) for r in stock.convert_unit(lines, items).collect()} == {1: 2.5, 2: 10.0, 3: None, 4: None}


def test_unmatched_supply_modes(spark):
    lines = table(spark, "id int, item_id int, warehouse_id int", (-3, 7, 1), (2, 8, 1))
    supply = table(spark, "item_id int, warehouse_id int, roll_code string, quantity int", (7, 1, "a", 1), (7, 3, "b", 2), (9, 1, "c", 3))
    issue = stock.unmatched_supply(supply, lines)
    assert sorted((r.id, r.roll_code) for r in issue.collect()) == [(-5, "c"), (-4, "b")]
    receipt = stock.unmatched_supply(supply, lines, stock.RECEIPT)
    assert [(r.id, r.roll_code) for r in receipt.collect()] == [(-4, "c")]


RESULT = (
    "row_id string, item_id_delivery int, warehouse_id_delivery int, quantity9 decimal(18,4), item_id_receipt int, warehouse_id_receipt int, "
    "receipt_quantity decimal(18,4), lot_code string, lot_code_t5 string, roll_code string, customer_id int, trans_code string, description string, doc_date date"
)


@pytest.fixture(scope="module")
def results(spark):
    return table(
        spark, RESULT,
        ("r1", 20, 2, Dec(8), 10, 1, Dec(7), "L1", None, "R1", 5, None, None, D(2025, 3, 1)),
        ("r2", 11, None, Dec(3), 12, 3, Dec(3), "L2", "T2", "R2", 6, "X", "text", D(2025, 3, 2)),
    )


@pytest.fixture(scope="module")
def items(spark):
    return table(spark, "id int, code string, name string, unit string, packing decimal(18,2)", (10, "i10", "ten", "kg", None), (20, "i20", "twenty", "kg", Dec(3)), (11, "i11", "eleven", "m", None), (12, "i12", "twelve", "m", Dec(2)))


def test_movement_lines_balance(spark, results, items):
    lines = documents.movement_lines(results, warehouses(spark), items)
    got = {(r.source_row_id, r.doc_group): r for r in lines.collect()}
    assert len(got) == 4
    assert got["r1", 1].item_id == 10 and got["r1", 2].item_id == 20 and got["r1", 2].warehouse_id == 1
    assert all(r.debit_account == r.credit_account == {"r1": "151", "r2": "153"}[k] for (k, _), r in got.items())
    heads = {r.source_row_id: r for r in documents.document_headers(results, {"branch_code": "B"}).collect()}
    assert all(got[k, 1].quantity == heads[k].quantity for k in heads)
    assert {(r.customer_id, r.trans_code, r.description, r.doc_date, r.branch_code) for r in heads.values()} == {(5, "X", "text", D(2025, 3, 1), "B")}
    pieces = documents.piece_rows(lines)
    assert sorted((r.line_id, r.lot_code) for r in pieces.collect()) == [("r1-1", "L1"), ("r1-2", ""), ("r2-1", "L2"), ("r2-2", "T2")]
    counts = {r.source_row_id: (r.total_roll, str(r.barrel_quantity)) for r in documents.child_counts(lines, pieces, items).collect()}
    assert counts == {"r1": (1, "2.67"), "r2": (1, "0.00")}


def test_document_numbers_go_on(spark, results):
    heads = documents.document_headers(results, {})
    none = table(spark, "doc_no string", ("LRB/01/25-000100",))
    fresh = {r.source_row_id: r.doc_no for r in documents.document_numbers(heads, none, "A", 3, 2025).collect()}
    assert fresh == {"r2": "LRA/03/25-000001", "r1": "LRA/03/25-000002"}
    some = table(spark, "doc_no string", ("LRA/01/25-000041",), ("LRA/02/25-000099",))
    later = {r.source_row_id: r.doc_no for r in documents.document_numbers(heads, some, "A", 3, 2025).collect()}
    assert later == {"r2": "LRA/03/25-000100", "r1": "LRA/03/25-000101"}


def test_replace_by_source(spark, results):
    heads = table(spark, "source_row_id string, header_id string, branch_code string, doc_date date", ("r1", "h1", "B", D(2025, 1, 1)), ("r1", "h2", "C", D(2025, 1, 2)), ("r2", "h3", "B", D(2025, 2, 1)), ("zz", "h4", "B", D(2025, 1, 1)))
    pieces = table(spark, "header_id string, n int", ("h1", 1), ("h2", 2), ("h4", 4))
    kept, dependents, span = documents.replace_by_source(heads, {"pieces": pieces}, results, "B")
    assert sorted(r.header_id for r in kept.collect()) == ["h2", "h4"]
    assert sorted(r.n for r in dependents["pieces"].collect()) == [2, 4]
    assert rows(span) == [(D(2025, 1, 1), D(2025, 2, 1), True)]
    assert rows(documents.replace_by_source(heads.filter("false"), {}, results, "B")[2]) == [(None, None, False)]


def test_labels(spark, results, items):
    checks = table(spark, "row_id string, doc_no string", ("r1", "QC1"))
    got = {r.row_id: r for r in documents.result_labels(results, items, warehouses(spark), checks).collect()}
    assert (got["r1"].item_code_delivery, got["r1"].item_name_receipt, got["r1"].warehouse_code_delivery) == ("i20", "ten", "W1")
    assert (got["r1"].source_doc_no, got["r2"].source_doc_no) == ("QC1", None)


def test_xml_round_trip_and_ticks(spark):
    text = '<NewDataSet><Select IsTick="1" RowId="a&amp;b" Quantity9="2.5000"/><Select IsTick="0" RowId="x"/><Select RowId="c"/></NewDataSet>'
    df = table(spark, "doc int, body string", (1, text))
    got = rows(xml_rows(df, "body", "Select", "IsTick int, RowId string, Quantity9 decimal(15,4)", ("doc",)))
    assert got == [(1, 1, "a&b", Dec("2.5000")), (1, None, "c", None)]
    back = rows_to_xml(table(spark, "k int, a string, n int", (1, 'q"<', 2), (1, None, 1)), ["k"], ["a", "n"], ["n"])
    assert rows(back) == [(1, '<root><row n="1"/><row a="q&quot;&lt;" n="2"/></root>')]


def test_null_keys_are_not_allocated(spark):
    from tallyworks.operators.stock import allocate_fifo

    schema = "id bigint, item bigint, quantity decimal(18,2)"
    supply = table(spark, schema, (1, None, Dec(5)), (2, 1, Dec(5)))
    demand = table(spark, schema, (8, None, Dec(5)), (9, 1, Dec(3)))
    got = allocate_fifo(supply, demand.withColumnRenamed("id", "line"), ["item"], "id", "line", ["id"], ["line"], **CUT)
    assert [(r.item, r.id, r.line, int(r.allocated)) for r in got.collect()] == [(1, 2, 9, 3)]


def test_document_numbers_beyond_six_digits(spark):
    from tallyworks.operators.documents import document_numbers

    heads = table(spark, "order_item_id bigint, source_row_id string", *[(i, str(i)) for i in range(11)])
    taken = table(spark, "doc_no string", ("LRX/01/25-999995",), ("LRX/02/25-000100",))
    got = sorted(r.doc_no for r in document_numbers(heads, taken, "X", 1, 2025).collect())
    assert len(set(got)) == 11 and "LRX/01/25-999996" in got and "LRX/01/25-1000006" in got
