"""Ranking, rate, sequence, pair and tree questions on the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks.operators import graph, ranking, rates, sequences
from tallyworks.operators.ordering import dense_rank_all, spread
from tallyworks.plans.registry import query, ratio_sql


@query(
    "o_custkey BIGINT",
    """SELECT o_custkey FROM o GROUP BY o_custkey
    HAVING count(DISTINCT o_orderpriority) = (SELECT count(DISTINCT o_orderpriority) FROM o)""",
)
def covers_all(t):
    return rates.covers_all(t.orders, "o_custkey", "o_orderpriority", t.orders)


@query(
    "l_partkey BIGINT, first_year BIGINT, l_orderkey BIGINT, l_linenumber BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    """SELECT l_partkey, year(l_shipdate) AS first_year, l_orderkey, l_linenumber, l_quantity, l_extendedprice
    FROM l JOIN (SELECT l_partkey AS pk, min(year(l_shipdate)) AS y FROM l GROUP BY 1) m
      ON m.pk = l_partkey AND m.y = year(l_shipdate)""",
)
def first_period_rows(t):
    lines = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    return ranking.first_period_rows(lines, "l_partkey", "ship_year", "first_year")


@query(
    "fraction DOUBLE",
    f"""WITH f AS (SELECT user_id, min(day) AS d FROM e GROUP BY 1),
    b AS (SELECT count(*) AS n FROM f WHERE EXISTS
      (SELECT 1 FROM e WHERE e.user_id = f.user_id AND e.day = f.d + 1))
    SELECT {ratio_sql("(SELECT n FROM b)", "(SELECT count(*) FROM f)", 4)} AS fraction""",
)
def next_day_return_rate(t):
    return rates.next_day_return_rate(t.events, "user_id", "day", digits=4)


@query(
    "o_custkey BIGINT, price DOUBLE",
    """SELECT k.o_custkey, coalesce(v.o_totalprice, 0) AS price
    FROM (SELECT DISTINCT o_custkey FROM o) k LEFT JOIN (
      SELECT o_custkey, o_totalprice FROM o WHERE o_orderdate <= DATE '1996-06-30'
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    ) v ON v.o_custkey = k.o_custkey""",
)
def value_as_of(t):
    return ranking.value_as_of(
        t.orders, "o_custkey", "o_totalprice", "o_orderdate", "1996-06-30", 0, "o_orderkey", "price"
    )


@query(
    "percentage DOUBLE",
    f"""WITH f AS (SELECT o_orderstatus FROM o
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
    SELECT {ratio_sql("sum(CASE WHEN o_orderstatus = 'F' THEN 100 ELSE 0 END)", "count(*)", 2)} AS percentage FROM f""",
)
def first_row_match_rate(t):
    return rates.first_row_match_rate(
        t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F"
    )


@query(
    "order_month VARCHAR, n_name VARCHAR, order_count BIGINT, finished_count BIGINT, total_amount DOUBLE, finished_amount DOUBLE",
    """SELECT strftime(o_orderdate, '%Y-%m') AS order_month, n_name, count(*) AS order_count,
      count(*) FILTER (o_orderstatus = 'F') AS finished_count, sum(o_totalprice) AS total_amount,
      coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0) AS finished_amount
    FROM o JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""",
)
def conditional_summary(t):
    located = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rates.conditional_summary(
        located.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM")),
        ["order_month", "n_name"],
        F.col("o_orderstatus") == "F",
        "o_totalprice",
        ["order_count", "finished_count", "total_amount", "finished_amount"],
    )


@query(
    "o_orderkey BIGINT, o_orderdate VARCHAR, running_total DOUBLE",
    """SELECT o_orderkey, o_orderdate, running_total FROM (
      SELECT o_orderkey, o_orderdate, sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS running_total
      FROM o) WHERE running_total <= 1000000000 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
)
def last_within_cap(t):
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return ranking.last_within_cap(rows, ["o_orderdate", "o_orderkey"], "o_totalprice", 1000000000)


@query(
    "results VARCHAR",
    """SELECT results FROM (SELECT c_name AS results FROM o JOIN c ON c_custkey = o_custkey GROUP BY c_name ORDER BY count(*) DESC, c_name LIMIT 1)
    UNION ALL
    SELECT results FROM (SELECT p_name || ' ' || p_partkey AS results FROM l JOIN p ON p_partkey = l_partkey
      WHERE l_shipdate >= DATE '1998-02-01' AND l_shipdate < DATE '1998-03-01'
      GROUP BY 1 ORDER BY sum(l_quantity) DESC, 1 LIMIT 1)""",
)
def leaders_union(t):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    busiest = per_customer.join(t.customer, "c_custkey")
    per_part = (
        t.lineitem.filter(F.col("l_shipdate").between("1998-02-01", "1998-02-28"))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.sum("l_quantity").alias("n"))
    )
    best = per_part.join(t.part, "p_partkey").withColumn(
        "title", F.concat_ws(" ", "p_name", "p_partkey")
    )
    return ranking.leaders_union([(busiest, "c_name", "n"), (best, "title", "n")])


@query(
    "l_partkey BIGINT, net_price DOUBLE",
    """SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END) AS net_price
    FROM l GROUP BY 1""",
)
def signed_sum(t):
    return rates.signed_sum(
        t.lineitem, ["l_partkey"], "l_extendedprice", F.col("l_returnflag") == "R", "net_price"
    )


@query(
    "c_name VARCHAR, total DOUBLE",
    """SELECT c_name, coalesce(t.total, 0) AS total FROM c LEFT JOIN
    (SELECT o_custkey, sum(o_totalprice) AS total FROM o GROUP BY 1) t
    ON o_custkey = c_custkey""",
)
def total_with_zero(t):
    return rates.total_with_zero(t.customer, t.orders, "c_custkey", "o_custkey", "o_totalprice")


@query(
    "second_highest DOUBLE",
    "SELECT (SELECT DISTINCT c_acctbal FROM c ORDER BY c_acctbal DESC LIMIT 1 OFFSET 1) AS second_highest",
)
def nth_distinct(t):
    return ranking.nth_distinct(t.customer, "c_acctbal", 2, "second_highest")


@query(
    "p_partkey BIGINT, p_size BIGINT, rank BIGINT",
    "SELECT p_partkey, p_size, dense_rank() OVER (ORDER BY p_size DESC) AS rank FROM p",
)
def dense_rank_rows(t):
    return dense_rank_all(t.part.select("p_partkey", "p_size"), "p_size")


@query(
    "o_orderkey BIGINT, o_totalprice DOUBLE, rank BIGINT",
    "SELECT o_orderkey, o_totalprice, dense_rank() OVER (ORDER BY o_totalprice DESC) AS rank FROM o",
)
def dense_rank_many_values(t):
    return dense_rank_all(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


@query(
    "c_nationkey BIGINT, c_name VARCHAR, c_acctbal DOUBLE, dense_rank BIGINT",
    """SELECT * FROM (SELECT c_nationkey, c_name, c_acctbal,
      dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS dense_rank FROM c) WHERE dense_rank <= 3""",
)
def top_n_dense(t):
    return ranking.top_n_dense(t.customer, "c_nationkey", "c_acctbal", 3)


@query(
    "c_custkey BIGINT, rate DOUBLE",
    f"""SELECT c_custkey, coalesce(r, 0) AS rate FROM c LEFT JOIN (SELECT o_custkey,
      {ratio_sql("count(*) FILTER (o_orderstatus = 'F')", "count(*)", 4)} AS r FROM o GROUP BY 1) ON o_custkey = c_custkey""",
)
def conditional_rate(t):
    return rates.conditional_rate(
        t.customer, t.orders, "c_custkey", "o_custkey", F.col("o_orderstatus") == "F", digits=4
    )


@query(
    "l_shipdate VARCHAR, rate DOUBLE",
    f"""SELECT l_shipdate, {ratio_sql("count(*) FILTER (l_returnflag = 'R')", "count(*)", 2)} AS rate
    FROM l JOIN o ON o_orderkey = l_orderkey JOIN c ON c_custkey = o_custkey JOIN s ON s_suppkey = l_suppkey
    WHERE l_shipdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
      AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)
      AND s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0) GROUP BY 1""",
)
def rate_with_role_filters(t):
    placed = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_shipdate", "l_returnflag", "c_nationkey", "s_nationkey")
    )
    return rates.rate_with_role_filters(
        placed, t.nation, "n_nationkey", ["c_nationkey", "s_nationkey"],
        F.col("n_regionkey") != 0, F.col("l_returnflag") == "R",
        "l_shipdate", "1997-01-01", "1997-12-31",
    )


@query(
    "ship_month VARCHAR, odd_sum BIGINT, even_sum BIGINT",
    """SELECT strftime(l_shipdate, '%Y-%m') AS ship_month,
      sum(CASE WHEN l_linenumber % 2 <> 0 THEN l_linenumber ELSE 0 END) AS odd_sum,
      sum(CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber ELSE 0 END) AS even_sum FROM l GROUP BY 1""",
)
def parity_sums(t):
    lines = t.lineitem.withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    return rates.parity_sums(lines, ["ship_month"], "l_linenumber")


@query(
    "o_custkey BIGINT, o_orderpriority VARCHAR, first_value DOUBLE, latest_value DOUBLE",
    """SELECT o_custkey, o_orderpriority, first_value, latest_value FROM (
      SELECT o_custkey, o_orderpriority, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_value,
        arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS latest_value, count(DISTINCT o_orderdate) AS n
      FROM o GROUP BY 1, 2) WHERE n > 1 AND latest_value > first_value""",
)
def first_last_improved(t):
    return sequences.first_last_improved(
        t.orders, ["o_custkey", "o_orderpriority"], "o_orderdate", "o_totalprice", "o_orderkey"
    )


@query(
    "user_id BIGINT, view_avg DOUBLE, purchase_avg DOUBLE",
    f"""SELECT user_id,
      {ratio_sql("100 * sum(value) FILTER (event_type = 'view')", "100 * count(*) FILTER (event_type = 'view')", 2)} AS view_avg,
      {ratio_sql("100 * sum(value) FILTER (event_type = 'purchase')", "100 * count(*) FILTER (event_type = 'purchase')", 2)} AS purchase_avg
    FROM e GROUP BY 1 HAVING count(*) FILTER (event_type = 'view') > 0 AND count(*) FILTER (event_type = 'purchase') > 0""",
)
def two_phase_average(t):
    return rates.two_phase_average(
        t.events, "user_id", "event_type", "value", "view", "purchase", ["view_avg", "purchase_avg"]
    )


@query(
    "category1 VARCHAR, category2 VARCHAR, entity_count BIGINT",
    """WITH h AS (SELECT DISTINCT o_custkey, p_type || ' ' || p_size % 10 AS kind
      FROM l JOIN o ON o_orderkey = l_orderkey JOIN p ON p_partkey = l_partkey)
    SELECT a.kind AS category1, b.kind AS category2, count(*) AS entity_count
    FROM h a JOIN h b ON a.o_custkey = b.o_custkey AND a.kind < b.kind GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def category_pairs(t):
    kinds = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.concat_ws(" ", "p_type", F.col("p_size") % 10).alias("kind"),
    )
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    bought = t.lineitem.join(owners, "l_orderkey").join(kinds, "l_partkey")
    return graph.category_pairs(bought, "o_custkey", "kind", 3)


@query(
    "season VARCHAR, p_type VARCHAR, total_quantity DOUBLE, total_revenue DOUBLE",
    """WITH g AS (SELECT CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'Winter' WHEN month(l_shipdate) <= 5 THEN 'Spring'
        WHEN month(l_shipdate) <= 8 THEN 'Summer' ELSE 'Fall' END AS season, p_type,
        sum(l_quantity) AS total_quantity, sum(l_extendedprice) AS total_revenue
      FROM l JOIN p ON p_partkey = l_partkey GROUP BY 1, 2)
    SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY season ORDER BY total_quantity DESC, total_revenue DESC, p_type) = 1""",
)
def season_leader(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return ranking.season_leader(sold, "l_shipdate", "p_type", "l_quantity", F.col("l_extendedprice"))


@query(
    "o_custkey BIGINT, gain DOUBLE",
    """WITH r AS (SELECT o_custkey, o_totalprice, row_number() OVER w AS rn, lead(o_totalprice) OVER w AS before FROM o
      WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
    SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_totalprice END) - max(CASE WHEN rn = 3 THEN o_totalprice END) AS gain
    FROM r WHERE rn <= 3 GROUP BY 1
    HAVING count(*) = 3 AND count(*) FILTER (rn < 3 AND o_totalprice > before) = 2""",
)
def last_n_increasing(t):
    return sequences.last_n_increasing(
        t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 3
    )


@query(
    "user_id BIGINT, days BIGINT",
    """WITH f AS (SELECT user_id, min(day) AS d FROM e WHERE event_type = 'error' GROUP BY 1)
    SELECT e.user_id, min(e.day - f.d) AS days FROM e JOIN f ON f.user_id = e.user_id
    WHERE event_type = 'purchase' AND e.day > f.d GROUP BY 1""",
)
def recovery_time(t):
    return sequences.recovery_time(t.events, "user_id", "day", "event_type", "error", "purchase")


@query(
    "l_suppkey BIGINT, first_half_avg DOUBLE, second_half_avg DOUBLE, improvement DOUBLE",
    """WITH h AS (SELECT l_suppkey, month(l_shipdate) <= 6 AS first, CAST(l_extendedprice AS DOUBLE) / CAST(l_quantity AS DOUBLE) AS r FROM l),
    m AS (SELECT l_suppkey, avg(r) FILTER (first) AS a, avg(r) FILTER (NOT first) AS b FROM h GROUP BY 1)
    SELECT l_suppkey, round(a, 2) AS first_half_avg, round(b, 2) AS second_half_avg, round(b - a, 2) AS improvement FROM m WHERE b > a""",
)
def half_year_delta(t):
    return rates.half_year_delta(
        t.lineitem, "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"
    )


@query(
    "block BIGINT, cycle_length BIGINT, total_amount DOUBLE",
    """WITH d AS (SELECT event_id // 12 AS block, event_id, day, value,
        CASE WHEN (event_id // 12) % 2 = 0 THEN CAST(event_id % (3 + (event_id // 12) % 3) AS VARCHAR) ELSE event_type END AS member FROM e),
    n AS (SELECT block, count(DISTINCT member) AS k, count(*) AS rows, sum(value) AS amount FROM d GROUP BY 1),
    q AS (SELECT d.block, n.k, n.rows, n.amount, member, row_number() OVER w AS pos, day - lag(day) OVER w AS gap
      FROM d JOIN n ON n.block = d.block WINDOW w AS (PARTITION BY d.block ORDER BY event_id)),
    z AS (SELECT block, k, rows, amount, pos % k AS r, count(DISTINCT member) AS m, max(gap) AS gap FROM q GROUP BY 1, 2, 3, 4, 5)
    SELECT block, k AS cycle_length, amount AS total_amount FROM z WHERE k >= 3 AND rows >= 2 * k
    GROUP BY 1, 2, 3 HAVING max(m) = 1 AND max(gap) <= 2""",
)
def cyclic_sequence(t):
    block = F.floor(F.col("event_id") / 12).cast("bigint")
    cycle = (F.col("event_id") % (F.lit(3) + block % 3)).cast("string")
    marked = t.events.select(
        block.alias("block"), "event_id", "day", "value",
        F.when(block % 2 == 0, cycle).otherwise(F.col("event_type")).alias("member"),
    )
    return sequences.cyclic_sequence(marked, "block", ["event_id"], "day", "member", "value")


@query(
    "l_suppkey BIGINT, dearest_item BIGINT, cheapest_item BIGINT, ratio DOUBLE",
    f"""WITH i AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q, max(p_retailprice) AS price
      FROM l JOIN p ON p_partkey = l_partkey GROUP BY 1, 2),
    x AS (SELECT l_suppkey, count(*) AS n, arg_min(l_partkey, (-price, l_partkey)) AS dearest_item, arg_min(q, (-price, l_partkey)) AS dq,
      arg_min(l_partkey, (price, l_partkey)) AS cheapest_item, arg_min(q, (price, l_partkey)) AS cq FROM i GROUP BY 1)
    SELECT l_suppkey, dearest_item, cheapest_item, {ratio_sql("100 * cq", "100 * dq", 2)} AS ratio
    FROM x WHERE n >= 3 AND dq < cq""",
)
def extreme_pair_ratio(t):
    priced = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    # Dealt by part once, for the sums and the join.
    stock = (
        spread(t.lineitem.select("l_suppkey", "l_partkey", "l_quantity"), ["l_partkey"])
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"))
        .join(priced, "l_partkey")
    )
    return rates.extreme_pair_ratio(stock, "l_suppkey", "l_partkey", "p_retailprice", "quantity")


@query(
    "l_suppkey BIGINT",
    """SELECT l_suppkey FROM l GROUP BY 1 HAVING count(*) FILTER (l_returnflag <> 'R') >= 3
      AND max(l_shipdate) - min(l_shipdate) >= 30 AND count(*) FILTER (l_returnflag = 'R') * 100 < count(*) * 33""",
)
def loyal_entities(t):
    refund = F.col("l_returnflag") == "R"
    return rates.loyal_entities(t.lineitem, "l_suppkey", "l_shipdate", ~refund, refund, max_refund_share="0.33")


@query(
    "session VARCHAR, user_id BIGINT, session_duration_minutes BIGINT, scroll_count BIGINT",
    """SELECT user_id || '/' || day AS session, user_id, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) // 60000000 AS session_duration_minutes,
      count(*) FILTER (event_type = 'view') AS scroll_count FROM e GROUP BY user_id, day
    HAVING CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) // 60000000 > 30 AND count(*) FILTER (event_type = 'view') >= 2
      AND count(*) FILTER (event_type = 'click') * 10 < count(*) FILTER (event_type = 'view') * 6
      AND count(*) FILTER (event_type = 'purchase') = 0""",
)
def idle_sessions(t):
    kind = F.col("event_type")
    sessions = t.events.withColumn("session", F.concat_ws("/", "user_id", "day"))
    return rates.idle_sessions(
        sessions, "session", "user_id", "ts", kind == "view", kind == "click", kind == "purchase",
        30, 2, "0.6",
    )


@query(
    "first_item VARCHAR, second_item VARCHAR, transition_count BIGINT",
    """WITH g AS (SELECT user_id FROM e GROUP BY 1 HAVING count(*) >= 5 AND avg(value) >= 10),
    m AS (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b
      FROM e WHERE user_id IN (SELECT user_id FROM g))
    SELECT a AS first_item, b AS second_item, count(*) AS transition_count FROM m WHERE b IS NOT NULL GROUP BY 1, 2""",
)
def transition_counts(t):
    return sequences.transition_counts(
        t.events, "user_id", ["ts", "event_id"], "event_type", "value", 5, 10
    )


@query(
    "o_custkey BIGINT, dominant_category VARCHAR, share DOUBLE",
    f"""WITH n AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM o GROUP BY 1, 2),
    x AS (SELECT o_custkey, sum(n) AS total, max(n) AS top, arg_min(p, (-n, p)) AS dominant_category FROM n GROUP BY 1)
    SELECT o_custkey, dominant_category, {ratio_sql("top", "total", 2)} AS share FROM x
    WHERE total >= 5 AND top * 10 >= total * 4""",
)
def dominant_share(t):
    return rates.dominant_share(t.orders, "o_custkey", "o_orderkey", "o_orderpriority", 5, "0.4")


@query(
    "n_name VARCHAR, child_count BIGINT",
    """SELECT n_name, count(*) AS child_count FROM c JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
    HAVING count(*) >= 60""",
)
def fan_in_at_least(t):
    return graph.fan_in_at_least(t.nation, "n_nationkey", t.customer, "c_nationkey", 60)


@query(
    "o_orderkey BIGINT, o_totalprice DOUBLE",
    """WITH k AS (SELECT o_orderkey, o_totalprice, o_orderkey - row_number() OVER (ORDER BY o_orderkey) AS run FROM o WHERE o_totalprice >= 250000)
    SELECT o_orderkey, o_totalprice FROM k WHERE run IN (SELECT run FROM k GROUP BY 1 HAVING count(*) >= 3)""",
)
def consecutive_runs(t):
    return sequences.consecutive_runs(
        t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", F.col("o_totalprice") >= 250000, 3
    )


@query(
    "id VARCHAR, num BIGINT",
    """WITH x AS (SELECT 'customer ' || o_custkey AS id FROM l JOIN o ON o_orderkey = l_orderkey UNION ALL SELECT 'part ' || l_partkey FROM l),
    d AS (SELECT id, count(*) AS num FROM x GROUP BY 1) SELECT id, num FROM d WHERE num = (SELECT max(num) FROM d)""",
)
def top_degree(t):
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = spread(t.lineitem.select("l_orderkey", "l_partkey"), ["l_orderkey"])
    edges = lines.join(owners, "l_orderkey").select(
        F.concat_ws(" ", F.lit("customer"), "o_custkey").alias("buyer"),
        F.concat_ws(" ", F.lit("part"), "l_partkey").alias("item"),
    )
    return graph.top_degree(edges, "buyer", "item")


@query(
    "id BIGINT, type VARCHAR",
    """WITH n AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN (c_custkey - 1) // 4 END AS parent FROM c)
    SELECT id, CASE WHEN parent IS NULL THEN 'Root' WHEN id IN (SELECT parent FROM n WHERE parent IS NOT NULL) THEN 'Inner' ELSE 'Leaf' END AS type FROM n""",
)
def tree_node_type(t):
    key = F.col("c_custkey")
    nodes = t.customer.select(
        key.alias("id"), F.when(key > 0, F.floor((key - 1) / 4).cast("bigint")).alias("parent")
    )
    return graph.tree_node_type(nodes, "id", "parent")


@query(
    "id BIGINT, c_name VARCHAR",
    """SELECT CASE WHEN id % 2 = 1 AND id = (SELECT max(c_custkey) + 1 FROM c) THEN id WHEN id % 2 = 1 THEN id + 1 ELSE id - 1 END AS id, c_name
    FROM (SELECT c_custkey + 1 AS id, c_name FROM c)""",
)
def swap_neighbours(t):
    seats = t.customer.select((F.col("c_custkey") + 1).alias("id"), "c_name")
    return graph.swap_neighbours(seats, "id")
