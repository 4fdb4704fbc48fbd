"""Periods, bands, turnaround and tall KPI rows on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks import functions as fn
from tallyworks.operators import kpi
from tallyworks.operators.temporal import OPEN_DATE
from tallyworks.plans.registry import query
from tallyworks.sources import save_intermediate

AS_OF = "1998-06-20"
AT = f"DATE '{AS_OF}'"


@query(
    "o_orderkey BIGINT, label VARCHAR, first VARCHAR, last VARCHAR",
    """WITH m AS (SELECT o_orderkey, date_trunc('month', o_orderdate) - CASE WHEN day(o_orderdate) >= 21 THEN INTERVAL 0 MONTH ELSE INTERVAL 1 MONTH END AS b FROM o)
    SELECT o_orderkey, strftime(b + INTERVAL 1 MONTH, '%Y-%m') AS label, CAST(b + INTERVAL 20 DAY AS DATE) AS first, CAST(b + INTERVAL 1 MONTH + INTERVAL 19 DAY AS DATE) AS last FROM m""",
)
def fiscal_period(t):
    period = fn.fiscal_period(F.col("o_orderdate"))
    return t.orders.select("o_orderkey", period.alias("p")).select("o_orderkey", "p.*")


@query(
    "c_custkey BIGINT, department VARCHAR",
    """SELECT c_custkey, split_part(coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_nationkey || '.P' || c_custkey % 5 END, 'X' || c_mktsegment || '.1.2'), '.', 1) AS department FROM c""",
)
def root_code(t):
    key = F.col("c_custkey")
    area = F.when(key % 3 > 0, F.concat("c_nationkey", F.lit(".P"), key % 5))
    department = F.concat(F.lit("X"), "c_mktsegment", F.lit(".1.2"))
    return t.customer.select("c_custkey", fn.root_code(area, department).alias("department"))


def price_bands(t):
    """Eight amount bands for each order priority."""
    level = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("level")
    bands = t.orders.select("o_orderpriority").distinct().select("o_orderpriority", level)
    step = F.lit(60000).cast("decimal(18,2)")
    return bands.select(
        "o_orderpriority",
        (step * (F.col("level") - 1) + F.lit("0.01").cast("decimal(18,2)")).alias("amount_from"),
        (step * F.col("level")).alias("amount_to"),
        "level",
    )


def levelled_orders(t):
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    placed = owned.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = placed.select(
        F.col("r_name").alias("region"), F.col("n_name").alias("department_code"),
        F.col("c_mktsegment").alias("employee_code"), "o_orderkey", "o_custkey", "o_orderstatus",
        "o_orderpriority", "o_orderdate", "o_totalprice",
    )
    return kpi.band_join(
        named, price_bands(t), ["o_orderpriority"], "o_totalprice", "amount_from", "amount_to"
    )


LEVEL_SQL = """k AS (SELECT r_name AS region, n_name AS department_code, c_mktsegment AS employee_code, o.*,
    CASE WHEN o_totalprice > 0 AND o_totalprice <= 480000 THEN CAST(ceil(o_totalprice / 60000) AS INT) END AS level
  FROM o JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
TALL = "region VARCHAR, department_code VARCHAR, employee_code VARCHAR, code VARCHAR, value DOUBLE"


@query("o_orderkey BIGINT, level BIGINT", f"WITH {LEVEL_SQL} SELECT o_orderkey, level FROM k")
def band_join(t):
    return levelled_orders(t)


@query(
    "l_orderkey BIGINT, l_linenumber BIGINT, band_order BIGINT",
    """SELECT l.l_orderkey, l.l_linenumber, b.l_orderkey AS band_order FROM l LEFT JOIN
      (SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice - l_quantity AS lo, l_extendedprice + l_quantity * l_linenumber AS hi FROM l WHERE l_returnflag = 'A') b
      ON b.l_partkey = l.l_partkey AND l.l_extendedprice BETWEEN lo AND hi""",
)
def band_join_by_bins(t):
    """Lines as bands of prices around their own, of very different widths: as many bands as facts, so
    they are found by bins and not sent to all tasks."""
    price = F.col("l_extendedprice")
    bands = t.lineitem.filter(F.col("l_returnflag") == "A").select(
        "l_partkey", (price - F.col("l_quantity")).alias("lo"), (price + F.col("l_quantity") * F.col("l_linenumber")).alias("hi"),
        F.col("l_orderkey").alias("band_order"),
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return kpi.band_join(lines, bands, ["l_partkey"], "l_extendedprice", "lo", "hi", max_bytes=0)


@query(
    "o_orderpriority VARCHAR, level BIGINT",
    "SELECT DISTINCT o_orderpriority, l AS level FROM o, (VALUES (2), (3), (4), (5), (6), (7), (8)) v(l)",
)
def overlapping_bands(t):
    wide = price_bands(t).withColumn("amount_to", F.col("amount_to") + 1)
    return kpi.overlapping_bands(wide, ["o_orderpriority"], "amount_from", "amount_to")


def order_claims(t):
    """Orders as claims: finished orders are settled after 30 days, the others are open."""
    approved = F.when(F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 30)).otherwise(
        F.lit(OPEN_DATE).cast("date")
    )
    return t.orders.select(
        F.col("o_orderkey").alias("claim_id"), F.col("o_orderdate").alias("system_date"),
        approved.alias("claim_approved_date"), "o_custkey", "o_totalprice",
    )


CLAIMS_SQL = """cl AS (SELECT o_orderkey AS claim_id, o_orderdate AS system_date, o_custkey, o_totalprice,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + 30 ELSE DATE '3000-01-01' END AS approved FROM o)"""


@query(
    "claim_id BIGINT, slice VARCHAR",
    f"""WITH {CLAIMS_SQL} SELECT claim_id, CASE WHEN approved = {AT} THEN 'settled'
      WHEN approved = {AT} - INTERVAL 1 YEAR THEN 'last_year' ELSE 'open' END AS slice FROM cl
    WHERE approved >= {AT} OR approved = {AT} - INTERVAL 1 YEAR""",
)
def claim_slices(t):
    return kpi.claim_slices(order_claims(t), AS_OF)


def line_log(t):
    """Lines as log entries: the line number gives the step, the part the time of day."""
    actions = F.array(*[F.lit(a) for a in (
        "M_CHUYEN_C", "C_HUYNHAN_M", "C_CHUYEN_V", "V_HUYNHAN_C", "V_DUYET", "V_DUYET_DG_BL", "OTHER",
    )])
    moment = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(
        hours=(F.col("l_partkey") % 24).cast("int")
    )
    return t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"),
        F.element_at(actions, F.col("l_linenumber")).alias("action"),
        moment.alias("created_date"),
    )


@query(
    "claim_id BIGINT, check_received_at VARCHAR, checked_at VARCHAR, validated_at VARCHAR, amount DOUBLE, level BIGINT",
    f"""WITH {CLAIMS_SQL}, g AS (SELECT l_orderkey AS id, CAST(l_shipdate AS TIMESTAMP) + to_hours(l_partkey % 24) AS ts, l_linenumber AS n FROM l),
    m AS (SELECT id, max(ts) FILTER (n = 1) AS check_received_at, max(ts) FILTER (n = 3) AS checked_at, max(ts) FILTER (n IN (5, 6)) AS validated_at FROM g GROUP BY 1),
    a AS (SELECT l_orderkey AS id, sum(l_extendedprice) AS amount, max(CASE WHEN l_extendedprice > 0 AND l_extendedprice <= 80000
      THEN CAST(ceil(l_extendedprice / 10000) AS INT) END) AS level FROM l GROUP BY 1)
    SELECT claim_id, check_received_at, checked_at, validated_at, amount, level FROM cl JOIN m ON m.id = claim_id LEFT JOIN a ON a.id = claim_id""",
)
def claim_milestones(t):
    clauses = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"), F.col("l_returnflag").alias("business_type_code"),
        F.col("l_extendedprice").alias("compensation_amount"),
    )
    level = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("level")
    step = F.lit(10000).cast("decimal(18,2)")
    bands = clauses.select("business_type_code").distinct().select("business_type_code", level).select(
        "business_type_code", "level",
        (step * (F.col("level") - 1) + F.lit("0.01").cast("decimal(18,2)")).alias("amount_from"),
        (step * F.col("level")).alias("amount_to"),
    )
    return kpi.claim_milestones(line_log(t), order_claims(t), clauses, bands)


def event_calendar(t):
    bounds = t.events.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    holiday = t.events.select(F.date_add(F.trunc("day", "month"), 9).alias("day")).distinct()
    return kpi.business_calendar(bounds, holiday)


CALENDAR_SQL = """d AS (SELECT CAST(g AS DATE) AS day FROM (SELECT unnest(generate_series((SELECT min(day) FROM e), (SELECT max(day) FROM e), INTERVAL 1 DAY)) AS g)
    WHERE isodow(g) < 6 AND CAST(g AS DATE) NOT IN (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) + 9 FROM e))"""
OVERLAP_SQL = """greatest(0, least(epoch(date_trunc('second', {end})), epoch(CAST(d.day AS TIMESTAMP)) + 61200)
    - greatest(epoch(date_trunc('second', {start})), epoch(CAST(d.day AS TIMESTAMP)) + 28800))"""


@query(
    "event_id BIGINT, seconds BIGINT",
    f"""WITH {CALENDAR_SQL}, pr AS (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM e)
    SELECT event_id, coalesce(sum({OVERLAP_SQL.format(start="before", end="ts")}) FILTER (d.day IS NOT NULL), 0) AS seconds FROM pr
    LEFT JOIN d ON d.day BETWEEN CAST(before AS DATE) AND CAST(ts AS DATE) WHERE before IS NOT NULL GROUP BY 1""",
)
def working_seconds(t):
    pairs = kpi.ordered_scan(
        t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"], ["user_id"],
        previous={"before": "ts"},
    ).filter(F.col("before").isNotNull())
    return kpi.working_seconds(pairs, "before", "ts", event_calendar(t), "seconds")


def event_log(t):
    """Seven events in a row make a claim; the event type is the step."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "view", "M_CHUYEN_C").when(kind == "click", "C_CHUYEN_V")
        .when(kind == "purchase", "V_DUYET").when(kind == "signup", "V_DUYET_DG_BL").otherwise("OTHER")
    )
    return t.events.select(
        F.floor(F.col("event_id") / 7).cast("bigint").alias("claim_id"), action.alias("action"),
        F.col("ts").alias("created_date"), F.col("user_id").alias("sent_user"),
        F.col("event_id").alias("received_user"),
    )


@query(
    "claim_id BIGINT, action VARCHAR, received_user BIGINT, working_seconds BIGINT, check_limit BIGINT, validate_limit BIGINT",
    f"""WITH {CALENDAR_SQL}, g AS (SELECT event_id // 7 AS claim_id, event_id, ts, CASE event_type WHEN 'view' THEN 'M_CHUYEN_C' WHEN 'click' THEN 'C_CHUYEN_V'
        WHEN 'purchase' THEN 'V_DUYET' WHEN 'signup' THEN 'V_DUYET_DG_BL' END AS action FROM e),
    n AS (SELECT * FROM g WHERE action IS NOT NULL QUALIFY row_number() OVER (PARTITION BY claim_id, action ORDER BY ts DESC, event_id DESC) = 1),
    pr AS (SELECT *, lag(ts) OVER (PARTITION BY claim_id ORDER BY ts, action) AS before, (claim_id * 977 % 150) * 1000000 AS amount FROM n)
    SELECT claim_id, action, event_id AS received_user, CASE WHEN before IS NOT NULL THEN coalesce(sum({OVERLAP_SQL.format(start="before", end="ts")}) FILTER (d.day IS NOT NULL), 0) END AS working_seconds,
      CASE WHEN amount < 20000000 THEN 7200 WHEN amount <= 50000000 THEN 14400 WHEN amount <= 100000000 THEN 18000 ELSE 36000 END AS check_limit,
      CASE WHEN amount <= 50000000 THEN 7200 WHEN amount <= 100000000 THEN 10800 ELSE 21600 END AS validate_limit
    FROM pr LEFT JOIN d ON d.day BETWEEN CAST(before AS DATE) AND CAST(ts AS DATE) GROUP BY claim_id, action, event_id, before, amount""",
)
def turnaround(t):
    log = event_log(t)
    amounts = log.select("claim_id").distinct().withColumn(
        "amount", F.col("claim_id") * 977 % 150 * 1000000
    )
    return kpi.turnaround(log, amounts, event_calendar(t))


@query(
    "claim_id BIGINT, opening_value DOUBLE, closing_value DOUBLE",
    f"""WITH {CLAIMS_SQL}, k AS (SELECT * FROM cl WHERE system_date < DATE '1998-05-21' AND approved >= DATE '1998-05-21'),
    q AS (SELECT l_orderkey AS id, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_partkey % 60) AS ts, l_extendedprice AS a, l_returnflag AS f FROM l WHERE l_shipdate < {AT}),
    u AS (SELECT id, ts, sum(a) AS a, 1 AS src FROM q WHERE f <> 'R' AND second(ts) <> 0 GROUP BY 1, 2 UNION ALL SELECT id, ts, a, 0 FROM q WHERE f = 'R'),
    r AS (SELECT *, ts < TIMESTAMP '1998-05-21' AS opening FROM u QUALIFY row_number() OVER (PARTITION BY id, ts < TIMESTAMP '1998-05-21' ORDER BY src, ts DESC, a DESC) = 1),
    t AS (SELECT l_orderkey AS id, sum(l_extendedprice) AS a FROM l GROUP BY 1)
    SELECT claim_id, x.a AS opening_value, CASE WHEN approved = DATE '3000-01-01' THEN coalesce(y.a, t.a) ELSE t.a END AS closing_value
    FROM k JOIN r x ON x.id = claim_id AND x.opening JOIN t ON t.id = claim_id LEFT JOIN r y ON y.id = claim_id AND NOT y.opening""",
)
def period_edge_estimates(t):
    moment = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.col("l_partkey") % 60).cast("int")
    )
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"), moment.alias("at"), "l_extendedprice", "l_returnflag"
    )
    requests = lines.filter(F.col("l_returnflag") != "R").select(
        "claim_id", F.col("at").alias("requested_at"), F.col("l_extendedprice").alias("request_amount")
    )
    quotes = lines.filter(F.col("l_returnflag") == "R").select(
        "claim_id", F.col("at").alias("quoted_at"), F.col("l_extendedprice").alias("approval_amount")
    )
    clauses = lines.select("claim_id", F.col("l_extendedprice").alias("compensation_amount"))
    return kpi.period_edge_estimates(order_claims(t), requests, quotes, clauses, AS_OF)


def order_metrics():
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    year = F.year("o_orderdate")
    return [
        kpi.Metric("orders", "orders"),
        kpi.Metric("finished", "finished orders", status == "F"),
        kpi.Metric("open", "open orders", status == "O"),
        kpi.Metric("urgent", "urgent orders", F.col("o_orderpriority") == "1-URGENT"),
        kpi.Metric("large", "orders of level 7 or 8", F.col("level") >= 7),
        kpi.Metric("orders_1997", "orders of 1997", year == 1997),
        kpi.Metric("orders_1998", "orders of 1998", year == 1998),
        kpi.Metric("amount", "amount", None, price),
        kpi.Metric("finished_amount", "finished amount", status == "F", price),
        kpi.Metric("amount_1997", "amount of 1997", year == 1997, price),
        kpi.Metric("amount_1998", "amount of 1998", year == 1998, price),
        kpi.Metric("never", "no such order", year == 1900),
    ]


METRIC_SQL = [
    ("orders", "count(*)", "true"), ("finished", "count(*)", "o_orderstatus = 'F'"), ("open", "count(*)", "o_orderstatus = 'O'"),
    ("urgent", "count(*)", "o_orderpriority = '1-URGENT'"), ("large", "count(*)", "level >= 7"),
    ("orders_1997", "count(*)", "year(o_orderdate) = 1997"), ("orders_1998", "count(*)", "year(o_orderdate) = 1998"),
    ("amount", "sum(o_totalprice)", "true"), ("finished_amount", "sum(o_totalprice)", "o_orderstatus = 'F'"),
    ("amount_1997", "sum(o_totalprice)", "year(o_orderdate) = 1997"), ("amount_1998", "sum(o_totalprice)", "year(o_orderdate) = 1998"),
]
METRICS_SQL = " UNION ALL ".join(
    f"SELECT region, department_code, employee_code, '{code}' AS code, CAST({value} AS DOUBLE) AS value FROM k WHERE {where} GROUP BY 1, 2, 3"
    for code, value, where in METRIC_SQL
)


@query(TALL, f"WITH {LEVEL_SQL} {METRICS_SQL}")
def metric_union(t):
    return kpi.metric_union(levelled_orders(t), order_metrics(), "o_orderkey")


@query(
    TALL,
    f"""WITH {LEVEL_SQL} SELECT m.*, 'department_total' AS code, v AS value FROM (SELECT DISTINCT region, department_code, employee_code FROM k) m
    JOIN (SELECT department_code AS d, sum(o_totalprice) AS v FROM k GROUP BY 1) ON d = department_code""",
)
def broadcast_group_total(t):
    return kpi.broadcast_group_total(
        levelled_orders(t), ["department_code"], F.col("o_totalprice"), "department_total", "total"
    )


@query(
    TALL,
    f"""WITH {LEVEL_SQL} SELECT region, department_code, employee_code, 'buyers_C' || level AS code, count(DISTINCT o_custkey) AS value
    FROM k WHERE level IS NOT NULL AND o_orderdate >= DATE '1997-01-01' GROUP BY region, department_code, employee_code, level""",
)
def level_counts(t):
    since = F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")
    return kpi.level_counts(levelled_orders(t), "o_custkey", "buyers_C", "Buyers C", since)


@query(
    TALL,
    f"""WITH {LEVEL_SQL} SELECT region, department_code, employee_code, 'GD_ton_lau_lv' || level AS code, count(*) AS value FROM k
    WHERE o_orderstatus = 'O' AND level IS NOT NULL AND {AT} - o_orderdate > CASE WHEN level <= 2 THEN 45 WHEN level <= 4 THEN 60 ELSE 90 END
    GROUP BY region, department_code, employee_code, level""",
)
def aged_backlog(t):
    waiting = levelled_orders(t).filter(F.col("o_orderstatus") == "O")
    return kpi.aged_backlog(waiting, AS_OF, "o_orderkey", "o_orderdate")


@query(
    "o_orderdate VARCHAR, l_shipdate VARCHAR, gap BIGINT, floored BIGINT",
    """WITH g AS (SELECT DISTINCT o_orderdate, l_shipdate FROM l JOIN o ON o_orderkey = l_orderkey),
    w AS (SELECT *, l_shipdate - o_orderdate - 2 * CAST(floor((CAST(date_trunc('week', l_shipdate) AS DATE) - CAST(date_trunc('week', o_orderdate) AS DATE)) / 7) AS BIGINT)
      - CASE WHEN isodow(l_shipdate) = 6 THEN 1 WHEN isodow(o_orderdate) = 7 THEN 1 ELSE 0 END AS gap FROM g)
    SELECT *, greatest(gap, 0) AS floored FROM w""",
)
def weekday_gap(t):
    start, end = F.col("o_orderdate"), F.col("l_shipdate")
    dates = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(start, end).distinct()
    return dates.select(
        start, end, fn.weekday_gap(start, end).alias("gap"), fn.weekday_gap(start, end, True).alias("floored")
    )


def department_people(t):
    """Every customer is an employee of its nation; the lowest key of a nation is its head."""
    employees = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("employee_code"), F.col("n_name").alias("department_code"), "n_regionkey"
    )
    heads = employees.groupBy("department_code").agg(F.min("employee_code").alias("employee_code"))
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("department_code"), F.col("r_name").alias("region")
    )
    return employees, heads, regions


def employee_metrics(t):
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    placed = owned.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = placed.select(
        F.col("r_name").alias("region"), F.col("n_name").alias("department_code"),
        F.col("c_name").alias("employee_code"), "o_orderkey", "o_totalprice",
    )
    return kpi.metric_union(
        rows,
        [kpi.Metric("orders", "orders"), kpi.Metric("amount", "amount", None, F.col("o_totalprice"))],
        "o_orderkey",
    )


HEAD_SQL = """b AS (SELECT r_name AS region, n_name AS department_code, c_name AS employee_code, o_totalprice
      FROM o JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
    tall AS (SELECT region, department_code, employee_code, 'orders' AS code, CAST(count(*) AS DOUBLE) AS value FROM b GROUP BY 1, 2, 3
      UNION ALL SELECT region, department_code, employee_code, 'amount', CAST(sum(o_totalprice) AS DOUBLE) FROM b GROUP BY 1, 2, 3),
    heads AS (SELECT n_name AS d, min(c_name) AS h FROM c JOIN nation ON n_nationkey = c_nationkey GROUP BY 1),
    rolled AS (SELECT * FROM tall WHERE NOT (code = 'orders' AND employee_code IN (SELECT h FROM heads))
      UNION ALL SELECT region, department_code, h, 'orders', sum(value) FROM tall JOIN heads ON d = department_code WHERE code = 'orders' GROUP BY 1, 2, 3)"""


@query(TALL, f"WITH {HEAD_SQL} SELECT * FROM rolled")
def head_rollup(t):
    employees, heads, regions = department_people(t)
    return kpi.head_rollup(employee_metrics(t), employees, heads, regions, ["orders"])


@query(
    "day VARCHAR, report_month VARCHAR, " + TALL,
    f"""WITH {HEAD_SQL} SELECT {AT} AS day, '1998-06' AS report_month, CASE region WHEN 'ASIA' THEN 'Miền Nam' WHEN 'EUROPE' THEN 'Miền Bắc' END AS region,
      department_code, employee_code, code, value FROM tall WHERE value <> 0""",
)
def publish(t):
    names = {"Miền Nam": ["ASIA"], "Miền Bắc": ["EUROPE"]}
    return kpi.publish(employee_metrics(t), AS_OF, names)


def kpi_sources(t) -> dict:
    """All KPI sources made from the star schema; see ``kpi.kpi_dataset``."""
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    claims = owned.select(
        key.alias("claim_id"),
        F.concat(F.lit("U"), nation).alias("manage_unit_code"),
        F.when(key % 7 > 0, F.concat(F.lit("D"), nation, F.lit(".P"), key % 3)).alias("area_code"),
        F.concat(F.lit("D"), nation).alias("department_code"),
        F.when(key % 11 == 0, "2B").when(key % 2 == 0, "XE").otherwise("XEL").alias("motor_category"),
        F.lit("XE").alias("product_type"),
        F.when(key % 13 > 0, key % 13).cast("int").alias("claim_detail_status"),
        (key % 300).alias("call_center_id"),
        F.concat(F.lit("E"), nation, F.lit("-"), key % 4).alias("user"),
        F.when(key % 5 > 0, F.concat(F.lit("K"), nation, F.lit("-"), key % 3)).alias("tier1_checker_user"),
        F.concat(F.lit("V"), nation).alias("validate_user"),
        F.lit(1).alias("valid"),
        F.col("o_orderdate").alias("system_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 30))
        .otherwise(F.lit(OPEN_DATE).cast("date")).alias("claim_approved_date"),
    )
    line = F.col("l_linenumber")
    code = F.when(line == 1, "XO.4.1.1").when(line == 7, "XM.1").otherwise(F.concat(F.lit("XO."), line))
    claim_key = F.col("l_orderkey").alias("claim_id")
    price = F.col("l_extendedprice") * 200
    clauses = t.lineitem.select(
        claim_key, code.alias("business_type_code"), price.alias("compensation_amount"),
        F.col("l_shipdate").alias("system_date"),
    )
    level = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("level")
    step = F.lit(2_500_000).cast("decimal(18,2)")
    # The codes are found once, not in each of the joins that read the bands.
    known = save_intermediate(clauses.select("business_type_code").distinct(), "business-types")
    bands = known.select("business_type_code", level).select(
        "business_type_code", "level",
        (step * (F.col("level") - 1) + F.lit("0.01").cast("decimal(18,2)")).alias("amount_from"),
        (step * F.col("level")).alias("amount_to"),
    )
    actions = F.array(*[F.lit(a) for a in (
        "M_CHUYEN_C", "C_HUYNHAN_M", "C_CHUYEN_V", "V_HUYNHAN_C", "V_DUYET", "V_DUYET_DG_BL", "OTHER",
    )])
    moment = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(
        hours=(F.col("l_partkey") % 24).cast("int"), secs=(F.col("l_partkey") % 60).cast("int")
    )
    log = t.lineitem.select(
        claim_key, F.element_at(actions, line).alias("action"), moment.alias("created_date"),
        F.concat(F.lit("S"), F.col("l_suppkey") % 10).alias("sent_user"),
        F.concat(F.lit("R"), F.col("l_partkey") % 10).alias("received_user"),
    )
    departments = t.nation.select(
        F.concat(F.lit("D"), "n_nationkey").alias("department_code"),
        F.when(F.col("n_regionkey") <= 1, "MB").when(F.col("n_regionkey") <= 3, "MN").alias("region"),
    )
    employees = owned.select(
        F.concat(F.lit("E"), nation, F.lit("-"), key % 4).alias("employee_code"),
        F.concat(F.lit("D"), nation).alias("department_code"),
    ).distinct()
    bounds = save_intermediate(t.lineitem.agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")), "day-bounds")
    return {
        "claims": claims,
        "regions": departments.filter(F.col("region").isNotNull()),
        "clauses": clauses,
        "bands": bands,
        "rates": t.nation.select(
            F.concat(F.lit("U"), "n_nationkey").alias("unit_code"), F.explode(F.array(F.lit("1998-06"), F.lit("1998-07"))).alias("report_month"),
            (F.col("n_nationkey") / 10).alias("claim_rate"),
        ),
        "log": log,
        "requests": t.lineitem.filter(F.col("l_returnflag") != "R").select(
            claim_key, price.alias("request_amount"), moment.alias("requested_at")
        ),
        "quotes": t.lineitem.filter(F.col("l_returnflag") == "R").select(
            claim_key, price.alias("approval_amount"), moment.alias("quoted_at")
        ),
        "approved_prices": t.orders.select(key.alias("claim_id"), (key % 3).alias("deductible_quantity")),
        "calls": owned.select(
            (key % 300).alias("call_id"), F.concat(F.lit("U"), nation).alias("unit_code"),
            F.date_sub("o_orderdate", 5).alias("system_date"), F.lit(1).alias("valid"),
        ),
        "employees": employees,
        "heads": t.nation.select(
            F.concat(F.lit("E"), "n_nationkey", F.lit("-0")).alias("employee_code"),
            F.concat(F.lit("D"), "n_nationkey").alias("department_code"),
        ),
        "calendar": kpi.business_calendar(bounds),
    }


def _tall(code: str, value: str, source: str, employee: str = "employee", by: str = "") -> str:
    return (
        f"SELECT region, dept, {employee} AS employee, {code} AS code, CAST({value} AS DOUBLE) AS value "
        f"FROM {source} GROUP BY region, dept, {employee}{by}"
    )


def _kpi_sql(as_of: str, label: str, first: str, last: str) -> str:
    """The dataset of a day in the fiscal month from ``first`` to ``last``."""
    at = f"DATE '{as_of}'"
    settled, year_ago, still = ("(SELECT * FROM det WHERE slice = '%s')" % s for s in ("settled", "last_year", "open"))
    levelled = "amount > 0 AND level BETWEEN 1 AND 8"
    parts = [
        f"SELECT DISTINCT region, dept, employee, 'GD_TLBT_TU' AS code, CAST(sum(amount * rate) OVER (PARTITION BY dept) AS DOUBLE) AS value FROM {settled}",
        f"SELECT DISTINCT region, dept, employee, 'GD_TLBT_MAU', CAST(sum(amount) OVER (PARTITION BY dept) AS DOUBLE) FROM {settled}",
        f"SELECT DISTINCT region, dept, employee, 'TD_TLBT_MAU', CAST(sum(amount) OVER (PARTITION BY region) AS DOUBLE) FROM {settled}",
        _tall("'TD_TLBT_TU'", "sum(amount * rate)", settled),
        _tall("'GD_HSBT_dgq'", "count(DISTINCT id)", f"{settled} WHERE {levelled}"),
        _tall("'GD_C' || level", "count(DISTINCT id)", f"{settled} WHERE {levelled}", by=", level"),
        _tall("'GD_ton_lau_lv' || level", "count(DISTINCT id)",
              f"{still} WHERE {levelled} AND {at} - opened > CASE WHEN level <= 2 THEN 45 WHEN level <= 4 THEN 60 ELSE 90 END", by=", level"),
    ]
    for source, suffix in ((settled, ""), (year_ago, "_NT")):
        for prefix, bound in (("GD", 10_000_000), ("TD", 20_000_000)):
            where = f"{source} WHERE amount > 0 AND amount < {bound} AND code = 'XO.4.1.1' AND deductions > 0"
            parts.append(_tall(f"'{prefix}_CPBQ_TU{suffix}'", "sum(amount)", where))
            parts.append(_tall(f"'{prefix}_CPBQ_MAU{suffix}'", "sum(deductions)", where))
    for code, employee, done in (("TD_check_C", "checker", "checked"), ("TD_validate_C", "validator", "validated")):
        parts.append(_tall(f"'{code}' || level", "count(DISTINCT id)", f"steps WHERE {levelled} AND CAST({done} AS DATE) = {at}", employee, ", level"))
    cut = f"TIMESTAMP '{as_of} 17:00:00'"
    for code, employee, arrived, returned, done in (
        ("TD_Check_chua_duyet", "checker", "received", "check_back", "checked"),
        ("TD_validate_chua_duyet", "validator", "checked", "validate_back", "validated"),
    ):
        parts.append(_tall(
            f"'{code}'", "count(DISTINCT id)",
            f"steps WHERE {employee} IS NOT NULL AND {arrived} <= {cut} AND coalesce({returned} > {cut}, true) AND coalesce({done} > {cut}, true)", employee,
        ))
    pending, today = f"opened < {at} AND approved >= {at}", f"opened = {at}"
    for code, value, where in (
        ("GD_HSBT_ton_dau_ky", "count(*)", pending), ("GD_HSBT_ton_dau_ky_vizualize", "count(*)", pending),
        ("GD_HSBT_phat_sinh", "count(*)", today), ("GD_HSBT_phat_sinh_vizualize", "count(*)", today),
        ("GD_mo_sau_2_ngay", "count(*)", f"{today} AND gap > 2"), ("GD_so_ngay_mo_hs_sau_call", "sum(greatest(coalesce(gap, 0), 0))", today),
    ):
        parts.append(_tall(f"'{code}'", value, f"called WHERE {where}"))
    validated = "action IN ('V_DUYET', 'V_DUYET_DG_BL')"
    for code, employee, where in (
        ("TD_check_nhan_moi", "receiver", "action = 'M_CHUYEN_C'"), ("TD_validate_nhan_moi", "receiver", "action = 'C_CHUYEN_V'"),
        ("TD_check_hoan_thanh", "sender", "action = 'C_CHUYEN_V'"), ("TD_check_dung_han", "sender", "action = 'C_CHUYEN_V' AND seconds <= check_limit"),
        ("TD_validate_hoan_thanh", "sender", validated), ("TD_validate_dung_han", "sender", f"{validated} AND seconds <= validate_limit"),
    ):
        parts.append(_tall(f"'{code}'", "count(DISTINCT id)", f"timed WHERE {where}", employee))
    edge, value = {"20": ("GD_GT_HSBT_ton_cuoi_ky", "closing"), "21": ("GD_GT_HSBT_ton_dau_ky", "opening")}[as_of[8:]]
    parts.append(_tall(f"'{edge}'", f"sum({value})", "edges WHERE region IS NOT NULL"))
    head_codes = ", ".join(f"'{c}'" for c in kpi.HEAD_CODES)
    return f"""WITH li AS (SELECT l_orderkey AS id, l_linenumber AS n, CASE l_linenumber WHEN 1 THEN 'XO.4.1.1' WHEN 7 THEN 'XM.1' ELSE 'XO.' || l_linenumber END AS code,
      l_extendedprice * 200 AS amount, l_shipdate, l_returnflag, CAST(l_shipdate AS TIMESTAMP) + to_hours(l_partkey % 24) + to_seconds(l_partkey % 60) AS ts,
      CASE WHEN l_extendedprice > 0 AND l_extendedprice <= 100000 THEN CAST(ceil(l_extendedprice / 12500) AS INT) END AS level,
      'S' || l_suppkey % 10 AS sender, 'R' || l_partkey % 10 AS receiver FROM l),
    base AS (SELECT o_orderkey AS id, o_orderdate AS opened, c_nationkey AS n, 'D' || c_nationkey AS dept,
      CASE WHEN n_regionkey <= 1 THEN 'MB' WHEN n_regionkey <= 3 THEN 'MN' END AS region, 'E' || c_nationkey || '-' || o_orderkey % 4 AS employee,
      CASE WHEN o_orderkey % 5 > 0 THEN 'K' || c_nationkey || '-' || o_orderkey % 3 END AS checker, 'V' || c_nationkey AS validator,
      CASE WHEN o_orderstatus = 'F' THEN o_orderdate + 30 ELSE DATE '3000-01-01' END AS approved
      FROM o JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey % 11 > 0 AND o_orderkey % 13 <> 1),
    det AS (SELECT base.*, CASE WHEN approved = {at} THEN 'settled' WHEN approved = {at} - INTERVAL 1 YEAR THEN 'last_year' WHEN approved > {at} THEN 'open' END AS slice,
      code, amount, level, base.n / 10 AS rate, CASE WHEN base.id % 3 > 0 THEN base.id % 3 END AS deductions
      FROM base JOIN li ON li.id = base.id WHERE l_shipdate >= {at} - INTERVAL 2 YEAR AND code NOT LIKE 'XM%'),
    steps AS (SELECT base.*, m.* EXCLUDE (id) FROM base JOIN (SELECT id, max(ts) FILTER (n = 1) AS received, max(ts) FILTER (n = 2) AS check_back, max(ts) FILTER (n = 3) AS checked,
      max(ts) FILTER (n = 4) AS validate_back, max(ts) FILTER (n IN (5, 6)) AS validated, sum(amount) AS amount, max(level) AS level FROM li GROUP BY 1) m ON m.id = base.id),
    calls AS (SELECT o_orderkey % 300 AS call, c_nationkey AS n, max(o_orderdate) - 5 AS d FROM o JOIN c ON c_custkey = o_custkey GROUP BY 1, 2),
    called AS (SELECT base.*, opened - d - 2 * CAST(floor((CAST(date_trunc('week', opened) AS DATE) - CAST(date_trunc('week', d) AS DATE)) / 7) AS BIGINT)
      - CASE WHEN isodow(opened) = 6 THEN 1 WHEN isodow(d) = 7 THEN 1 ELSE 0 END AS gap FROM base JOIN calls ON call = id % 300 AND calls.n = base.n),
    newest AS (SELECT id, n, ts, sender, receiver, CASE n WHEN 1 THEN 'M_CHUYEN_C' WHEN 3 THEN 'C_CHUYEN_V' WHEN 5 THEN 'V_DUYET' ELSE 'V_DUYET_DG_BL' END AS action FROM li WHERE n IN (1, 3, 5, 6)
      QUALIFY row_number() OVER (PARTITION BY id, n ORDER BY ts DESC, sender DESC, receiver DESC) = 1),
    laid AS (SELECT *, lag(ts) OVER (PARTITION BY id ORDER BY ts, action) AS before FROM newest),
    main AS (SELECT id, sum(amount) AS amount FROM li WHERE n = 1 GROUP BY 1),
    days AS (SELECT CAST(g AS DATE) AS day FROM (SELECT unnest(generate_series((SELECT min(l_shipdate) FROM l), (SELECT max(l_shipdate) FROM l), INTERVAL 1 DAY)) AS g) WHERE isodow(g) < 6),
    timed AS (SELECT base.*, action, sender, receiver, coalesce((SELECT sum({OVERLAP_SQL.replace("d.day", "day").format(start="before", end="ts")}) FROM days
        WHERE day BETWEEN CAST(before AS DATE) AND CAST(ts AS DATE)), 0) AS seconds,
      CASE WHEN amount < 20000000 THEN 7200 WHEN amount <= 50000000 THEN 14400 WHEN amount <= 100000000 THEN 18000 ELSE 36000 END AS check_limit,
      CASE WHEN amount <= 50000000 THEN 7200 WHEN amount <= 100000000 THEN 10800 ELSE 21600 END AS validate_limit
      FROM laid JOIN base ON base.id = laid.id JOIN main ON main.id = laid.id WHERE CAST(ts AS DATE) = {at}),
    asked AS (SELECT id, ts, sum(amount) AS a, 1 AS src FROM li WHERE l_returnflag <> 'R' AND second(ts) <> 0 AND l_shipdate < DATE '{last}' GROUP BY 1, 2
      UNION ALL SELECT id, ts, amount, 0 FROM li WHERE l_returnflag = 'R' AND l_shipdate < DATE '{last}'),
    picked AS (SELECT *, ts < TIMESTAMP '{first}' AS opening FROM asked
      QUALIFY row_number() OVER (PARTITION BY id, ts < TIMESTAMP '{first}' ORDER BY src, ts DESC, a DESC) = 1),
    edges AS (SELECT base.*, x.a AS opening, CASE WHEN approved = DATE '3000-01-01' THEN coalesce(y.a, w.a) ELSE w.a END AS closing FROM base JOIN picked x ON x.id = base.id AND x.opening
      JOIN (SELECT id, sum(amount) AS a FROM li GROUP BY 1) w ON w.id = base.id LEFT JOIN picked y ON y.id = base.id AND NOT y.opening
      WHERE base.opened < DATE '{first}' AND approved >= DATE '{first}'),
    tall AS ({" UNION ALL ".join(parts)}),
    people AS (SELECT DISTINCT 'E' || c_nationkey || '-' || o_orderkey % 4 AS e, 'D' || c_nationkey AS d FROM o JOIN c ON c_custkey = o_custkey),
    rolled AS (SELECT * FROM tall WHERE NOT (code IN ({head_codes}) AND employee LIKE 'E%-0')
      UNION ALL SELECT CASE WHEN n_regionkey <= 1 THEN 'MB' WHEN n_regionkey <= 3 THEN 'MN' END, d, 'E' || n_nationkey || '-0', code, sum(value)
      FROM tall JOIN people ON e = employee JOIN nation ON d = 'D' || n_nationkey WHERE code IN ({head_codes}) GROUP BY 1, 2, 3, 4)
    SELECT {at} AS day, '{label}' AS report_month, CASE region WHEN 'MN' THEN 'Miền Nam' ELSE 'Miền Bắc' END AS region, dept AS department_code, employee AS employee_code, code, round(value, 2) AS value
    FROM rolled WHERE value <> 0 AND region IS NOT NULL"""


DATASET = "day VARCHAR, report_month VARCHAR, " + TALL


@query(DATASET, _kpi_sql(AS_OF, "1998-06", "1998-05-21", "1998-06-20"))
def kpi_dataset(t):
    """The last day of a fiscal month, with the closing estimates."""
    return kpi.kpi_dataset(kpi_sources(t), AS_OF, save_intermediate).withColumn("value", F.round("value", 2))


FIRST_DAY = "1998-06-21"


@query(DATASET, _kpi_sql(FIRST_DAY, "1998-07", FIRST_DAY, "1998-07-20"))
def kpi_dataset_opening(t):
    """The first day of a fiscal month, with the opening estimates."""
    return kpi.kpi_dataset(kpi_sources(t), FIRST_DAY, save_intermediate).withColumn("value", F.round("value", 2))
