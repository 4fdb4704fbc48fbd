"""Profit-and-loss tables on the star schema: nations are branches, segments divisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks.operators import profit
from tallyworks.plans.registry import query
from tallyworks.sources import save_intermediate

AS_OF, FIRST, LAST = "1998-06-01", "1998-02-07", "1998-06-30"
DEFINITION = (
    "stt int, item_code string, item_name string, ma_so string, source string, source_col string, "
    "formula string, formula_t2 string, bac int"
)
METRICS = [
    (1, "I1", "fast orders", "A1", "ledger", "K1,K2", None, "TU_THAN", None),
    (2, "I2", "medium orders", "A2", "ledger", "K3", "", "0", None),
    (3, "I3", "slow difference", "A3", "ledger", None, "K4-K5", "TU_THAN", None),
    (4, "I4", "income", "A4", "customers", "interest_income", None, "TU_THAN", None),
    (5, "I5", "deposits", "A5", "deposits", "deposit_interest", None, "0", None),
    (6, "I6", "lines", "A6", "lines", "net", None, "TU_THAN", None),
    (7, "I7", "first sum", "B1", "metrics", None, "A1 + A2 - A3", "A1+A3", 2),
    (8, "I8", "second sum", "B2", "metrics", None, "B1+A4-A5", "B1-A6", 1),
    (9, "I9", "result", "C1", "metrics", None, "B2-B1+A6", "B2 + B1", 0),
    (10, "I10", "nothing", "Z1", "ledger", "K9", None, "0", None),
]


def definitions(t):
    return t.spark.createDataFrame(METRICS, DEFINITION)


def owned_orders(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


def ledger(t):
    """Order totals as ledger rows of the order month; each segment writes its division its way."""
    segment = F.col("c_mktsegment")
    division = (
        F.when(segment == "FURNITURE", "TREA").when(segment == "MACHINERY", "SME")
        .when(segment == "BUILDING", "INDIV").when(segment == "HOUSEHOLD", "COST CENTER")
    )
    return owned_orders(t).select(
        F.trunc("o_orderdate", "month").alias("report_date"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("branch_code"),
        F.concat(F.lit("K"), F.substring("o_orderpriority", 1, 1)).alias("kpi_code"),
        division.alias("division_code"),
        F.col("o_totalprice").alias("amount"),
    )


def ledger_values(t):
    return profit.normalize_division(profit.ledger_totals(ledger(t), AS_OF))


LEDGER_SQL = """gl AS (SELECT 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch, 'K' || substr(o_orderpriority, 1, 1) AS kpi,
    CASE c_mktsegment WHEN 'FURNITURE' THEN 'TREASURY' WHEN 'MACHINERY' THEN 'SMEs' WHEN 'BUILDING' THEN 'INDIV' WHEN 'HOUSEHOLD' THEN 'NHS' ELSE 'KXD' END AS division,
    sum(o_totalprice) AS amount FROM o JOIN c ON c_custkey = o_custkey WHERE date_trunc('month', o_orderdate) = DATE '1998-06-01' GROUP BY 1, 2, 3)"""


@query(
    "branch_code VARCHAR, kpi_code VARCHAR, division_code VARCHAR, amount DOUBLE",
    """SELECT 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch_code, 'K' || substr(o_orderpriority, 1, 1) AS kpi_code,
      CASE c_mktsegment WHEN 'FURNITURE' THEN 'TREA' WHEN 'MACHINERY' THEN 'SME' WHEN 'BUILDING' THEN 'INDIV' WHEN 'HOUSEHOLD' THEN 'COST CENTER' END AS division_code,
      sum(o_totalprice) AS amount FROM o JOIN c ON c_custkey = o_custkey WHERE date_trunc('month', o_orderdate) = DATE '1998-06-01' GROUP BY 1, 2, 3""",
)
def ledger_totals(t):
    return profit.ledger_totals(ledger(t), AS_OF)


@query(
    "branch_code VARCHAR, kpi_code VARCHAR, division_code VARCHAR, amount DOUBLE",
    f"WITH {LEDGER_SQL} SELECT branch AS branch_code, kpi AS kpi_code, division AS division_code, amount FROM gl",
)
def normalize_division(t):
    return ledger_values(t)


def branch(nation: str = "c_nationkey"):
    return F.concat(F.lit("VN0010"), F.lpad(F.col(nation).cast("string"), 3, "0"))


def customer_income(t):
    division = F.element_at(
        F.create_map(*[F.lit(x) for x in (
            "BUILDING", "INDIV", "AUTOMOBILE", "SME ", "MACHINERY", "CIB", "HOUSEHOLD", "FI", "FURNITURE", "ALM",
        )]),
        F.col("c_mktsegment"),
    )
    income = owned_orders(t).select(
        F.concat(branch(), F.lit(" ")).alias("branch_code"), division.alias("division_code"),
        F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("interest_income"),
        (F.col("o_totalprice") * F.lit("0.25").cast("decimal(4,2)")).alias("funding_cost"),
        F.lit(1).cast("decimal(18,2)").alias("provision"),
    )
    listed = t.customer.filter(F.col("c_acctbal") > 2000).select(F.col("c_custkey").alias("customer"))
    return profit.customer_ftp_totals(income, listed, FIRST, LAST)


INCOME_SQL = f"""inc AS (SELECT 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'INDIV' WHEN 'AUTOMOBILE' THEN 'SMEs' WHEN 'MACHINERY' THEN 'CIB' ELSE 'FI' END AS division,
    sum(o_totalprice) AS interest_income, sum(o_totalprice * 0.25) AS funding_cost, count(*) AS provision
  FROM o JOIN c ON c_custkey = o_custkey WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal > 2000 AND o_orderdate BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY 1, 2)"""


@query(
    "branch_code VARCHAR, division_code VARCHAR, interest_income DOUBLE, funding_cost DOUBLE, provision DOUBLE",
    f"WITH {INCOME_SQL} SELECT branch AS branch_code, division AS division_code, interest_income, funding_cost, provision FROM inc",
)
def customer_ftp_totals(t):
    return customer_income(t)


def deposit_income(t):
    division = F.when(F.col("l_returnflag") == "A", "SME").when(F.col("l_returnflag") == "N", "FI").otherwise("OTHER")
    placed = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        branch("s_nationkey").alias("branch_code"), division.alias("division_code"),
        F.col("l_partkey").alias("account"), F.col("l_shipdate").alias("transaction_date"),
        F.col("l_extendedprice").alias("deposit_interest"), F.col("l_quantity").alias("transfer_interest"),
    )
    listed = t.part.filter(F.col("p_size") > 25).select(F.col("p_partkey").alias("account"))
    return profit.deposit_totals(placed, listed, FIRST, LAST)


DEPOSIT_SQL = f"""dep AS (SELECT 'VN0010' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS branch, CASE l_returnflag WHEN 'A' THEN 'SMEs' ELSE 'FI' END AS division,
    sum(l_extendedprice) AS deposit_interest, sum(l_quantity) AS transfer_interest
  FROM l JOIN s ON s_suppkey = l_suppkey JOIN p ON p_partkey = l_partkey
  WHERE l_returnflag <> 'R' AND p_size > 25 AND l_shipdate BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY 1, 2)"""


@query(
    "branch_code VARCHAR, division_code VARCHAR, deposit_interest DOUBLE, transfer_interest DOUBLE",
    f"WITH {DEPOSIT_SQL} SELECT branch AS branch_code, division AS division_code, deposit_interest, transfer_interest FROM dep",
)
def deposit_totals(t):
    return deposit_income(t)


def line_balances(t):
    lines = F.when(F.col("o_orderstatus") == "F", "704000").when(F.col("o_orderstatus") == "O", "704100").otherwise("703900")
    rows = owned_orders(t).select(
        F.trunc("o_orderdate", "month").alias("transaction_date"), branch().alias("branch_code"),
        F.when(F.col("o_orderpriority") == "5-LOW", "799999").otherwise(lines).alias("line_gl"),
        F.col("o_totalprice").alias("credit"), F.col("c_acctbal").alias("debit"),
    )
    return profit.gl_line_balances(rows, AS_OF)


BALANCE_SQL = """bal AS (SELECT 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch, CASE o_orderstatus WHEN 'F' THEN 'SMEs' WHEN 'O' THEN 'INDIV' ELSE 'CIB' END AS division,
    sum(o_totalprice) AS credit, sum(c_acctbal) AS debit FROM o JOIN c ON c_custkey = o_custkey
  WHERE o_orderpriority <> '5-LOW' AND date_trunc('month', o_orderdate) = DATE '1998-06-01' GROUP BY 1, 2)"""


@query(
    "branch_code VARCHAR, division_code VARCHAR, credit DOUBLE, debit DOUBLE, net DOUBLE",
    f"WITH {BALANCE_SQL} SELECT branch AS branch_code, division AS division_code, credit, debit, credit - debit AS net FROM bal",
)
def gl_line_balances(t):
    return line_balances(t)


@query(
    "ma_so VARCHAR, term VARCHAR, sign BIGINT",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ma_so, 'S' || o_orderstatus AS term, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END AS sign FROM o
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'K' || substr(o_orderpriority, 1, 1), 1 FROM o
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'C' || o_custkey % 10, -1 FROM o""",
)
def formula_terms(t):
    text = F.concat(
        F.when(F.col("o_orderkey") % 3 == 0, " - S").otherwise("S"), "o_orderstatus",
        F.lit(" + K"), F.substring("o_orderpriority", 1, 1), F.lit("-C"), F.col("o_custkey") % 10,
    )
    formulas = t.orders.select(F.col("o_orderkey").cast("string").alias("ma_so"), text.alias("formula"))
    return profit.formula_terms(formulas)


def other_sources(t):
    return {"customers": customer_income(t), "deposits": deposit_income(t), "lines": line_balances(t)}


VALUE = "stt BIGINT, ma_so VARCHAR, branch_code VARCHAR, division_code VARCHAR, amount DOUBLE"
BASE_SQL = f"""{LEDGER_SQL}, {INCOME_SQL}, {DEPOSIT_SQL}, {BALANCE_SQL},
  base AS (SELECT 1 AS stt, 'A1' AS ma_so, branch, division, sum(amount) AS amount FROM gl WHERE kpi IN ('K1', 'K2') GROUP BY 3, 4
    UNION ALL SELECT 2, 'A2', branch, division, amount FROM gl WHERE kpi = 'K3'
    UNION ALL SELECT 4, 'A4', branch, division, interest_income FROM inc
    UNION ALL SELECT 5, 'A5', branch, division, deposit_interest FROM dep
    UNION ALL SELECT 6, 'A6', branch, division, credit - debit FROM bal)"""


@query(
    VALUE,
    f"WITH {BASE_SQL} SELECT stt, ma_so, branch AS branch_code, division AS division_code, amount FROM base",
)
def base_metrics(t):
    return profit.base_metrics(definitions(t), ledger_values(t), other_sources(t))


# Each formula of the first table written out over base metrics.
FORMULA_SQL = """a3 AS (SELECT 3 AS stt, 'A3' AS ma_so, branch, division, sum(CASE WHEN kpi = 'K4' THEN amount ELSE -amount END) AS amount FROM gl WHERE kpi IN ('K4', 'K5') GROUP BY 3, 4),
  known AS (SELECT * FROM base UNION ALL SELECT * FROM adj UNION ALL SELECT * FROM a3),
  coef(stt, m, t, k) AS (VALUES (7, 'B1', 'A1', 1), (7, 'B1', 'A2', 1), (7, 'B1', 'A3', -1),
    (8, 'B2', 'A1', 1), (8, 'B2', 'A2', 1), (8, 'B2', 'A3', -1), (8, 'B2', 'A4', 1), (8, 'B2', 'A5', -1),
    (9, 'C1', 'A1', 0), (9, 'C1', 'A2', 0), (9, 'C1', 'A3', 0), (9, 'C1', 'A4', 1), (9, 'C1', 'A5', -1), (9, 'C1', 'A6', 1)),
  formulas AS (SELECT coef.stt, m AS ma_so, branch, division, sum(k * amount) AS amount FROM known JOIN coef ON t = ma_so GROUP BY 1, 2, 3, 4),
  filled AS (SELECT * FROM known UNION ALL SELECT * FROM formulas),
  defs(stt, m) AS (VALUES (1, 'A1'), (2, 'A2'), (3, 'A3'), (4, 'A4'), (5, 'A5'), (6, 'A6'), (7, 'B1'), (8, 'B2'), (9, 'C1'), (10, 'Z1')),
  t1 AS (SELECT * FROM filled UNION ALL SELECT stt, m, b, 'INDIV', 0 FROM defs, (SELECT DISTINCT branch AS b FROM gl)
    WHERE NOT EXISTS (SELECT 1 FROM filled f WHERE f.ma_so = m AND f.branch = b))"""
# The manual amounts of ``adjustment_rows``, one row for each branch and division.
ADJUSTED_SQL = """SELECT 4 AS stt, 'A4' AS ma_so, 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'INDIV' ELSE 'FI' END AS division, sum(o_totalprice) AS amount
    FROM o JOIN c ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD') GROUP BY 3, 4"""
FIRST_SQL = f"{BASE_SQL}, adj AS (SELECT * FROM base WHERE false), {FORMULA_SQL}"
ADJUSTED_FIRST_SQL = f"{BASE_SQL}, adj AS ({ADJUSTED_SQL}), {FORMULA_SQL}"


@query(
    VALUE,
    f"WITH {FIRST_SQL} SELECT stt, ma_so, branch AS branch_code, division AS division_code, amount FROM formulas",
)
def formula_metrics(t):
    metrics, values = definitions(t), ledger_values(t)
    plain = profit.base_metrics(metrics, values, other_sources(t))
    by_ledger = metrics.filter(F.col("source") == "ledger")
    known = plain.unionByName(
        profit.formula_metrics(by_ledger, values, value_key="kpi_code", nested=False)
    )
    return profit.formula_metrics(metrics.filter(F.col("source") == "metrics"), known)


def adjustment_rows(t):
    """Wide manual amounts per branch: one column per division."""
    return owned_orders(t).groupBy(
        branch().alias("branch_code")
    ).agg(
        F.sum(F.when(F.col("c_mktsegment") == "BUILDING", F.col("o_totalprice"))).alias("INDIV"),
        F.sum(F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("o_totalprice"))).alias("FI"),
        F.sum(F.when(F.col("o_orderpriority") == "none", F.col("o_totalprice"))).alias("SMEs"),
    ).select(
        "branch_code", F.lit("I4").alias("item_code"), F.lit("income").alias("item_name"),
        F.lit("A4").alias("ma_so"), "INDIV", "FI", "SMEs",
    )


@query(
    VALUE,
    """SELECT 4 AS stt, 'A4' AS ma_so, 'VN0010' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS branch_code,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'INDIV' ELSE 'FI' END AS division_code, sum(o_totalprice) AS amount
    FROM o JOIN c ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD') GROUP BY 3, 4""",
)
def unpivot_adjustments(t):
    return profit.unpivot_adjustments(adjustment_rows(t), definitions(t), ["INDIV", "FI", "SMEs"])


def table_one(t, adjustments=None):
    values = save_intermediate(ledger_values(t), "ledger-values")
    return profit.first_table(definitions(t), values, other_sources(t), adjustments, save=save_intermediate)


@query(
    VALUE,
    f"WITH {FIRST_SQL} SELECT stt, ma_so, branch AS branch_code, division AS division_code, amount FROM t1",
)
def zero_fill(t):
    return table_one(t)


WIDE = "stt BIGINT, branch_code VARCHAR, ma_so VARCHAR, total DOUBLE, " + ", ".join(
    f"{d} DOUBLE" for d in profit.DIVISIONS
)


def _pivot_sql(source: str, suffix: str = "") -> str:
    columns = ", ".join(
        f"coalesce(sum(amount) FILTER (division = '{d}'), 0) AS {d}{suffix}" for d in profit.DIVISIONS
    )
    listed = ", ".join(f"'{d}'" for d in profit.DIVISIONS)
    return (
        f"SELECT stt, branch AS branch_code, ma_so, coalesce(sum(amount) FILTER (division IN ({listed})), 0) AS total{suffix}, "
        f"{columns} FROM {source} GROUP BY 1, 2, 3"
    )


@query(WIDE, f"WITH {ADJUSTED_FIRST_SQL} {_pivot_sql('t1')}")
def first_table_adjusted(t):
    """Manual amounts are base values: they enter the formulas and the totals of their branch."""
    metrics = definitions(t)
    added = profit.unpivot_adjustments(adjustment_rows(t), metrics, ["INDIV", "FI", "SMEs"])
    return profit.pivot_with_total(table_one(t, added))


SECOND_SQL = f"""{FIRST_SQL}, b2 AS (SELECT stt, ma_so, branch, division, CASE WHEN stt IN (2, 5, 10) THEN 0 ELSE amount END AS amount FROM t1 WHERE stt IN (1, 2, 3, 4, 5, 6, 10)),
  coef2(stt, m, t, k) AS (VALUES (7, 'B1', 'A1', 1), (7, 'B1', 'A3', 1), (8, 'B2', 'A1', 1), (8, 'B2', 'A3', 1), (8, 'B2', 'A6', -1),
    (9, 'C1', 'A1', 2), (9, 'C1', 'A3', 2), (9, 'C1', 'A6', -1)),
  t2 AS (SELECT * FROM b2 UNION ALL SELECT coef2.stt, m, branch, division, sum(k * amount) FROM b2 JOIN coef2 ON t = ma_so GROUP BY 1, 2, 3, 4)"""


@query(
    VALUE,
    f"WITH {SECOND_SQL} SELECT stt, ma_so, branch AS branch_code, division AS division_code, amount FROM t2",
)
def second_table(t):
    return profit.second_table(definitions(t), table_one(t))


@query(WIDE, f"WITH {FIRST_SQL} {_pivot_sql('t1')}")
def pivot_with_total(t):
    return profit.pivot_with_total(table_one(t))


@query(
    "stt BIGINT, branch_code VARCHAR, ma_so VARCHAR, total DOUBLE, INDIV DOUBLE, SMEs DOUBLE, total_t2 DOUBLE, INDIV_t2 DOUBLE, SMEs_t2 DOUBLE",
    f"WITH {SECOND_SQL} SELECT x.*, y.* EXCLUDE (stt, branch_code, ma_so) FROM ({_pivot_sql('t1')}) x LEFT JOIN ({_pivot_sql('t2', '_t2')}) y "
    "ON y.branch_code = x.branch_code AND y.ma_so = x.ma_so",
)
def side_by_side(t):
    metrics, first = definitions(t), save_intermediate(table_one(t), "first-table")
    second = profit.second_table(metrics, first)
    return profit.side_by_side(profit.pivot_with_total(first), profit.pivot_with_total(second))
