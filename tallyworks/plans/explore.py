"""Profiling, cleaning and exploration on the star-schema tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tallyworks.operators import profile as explore
from tallyworks.plans.registry import query, ratio_sql
from tallyworks.sources import partitioned_table, replace_partitions, save_intermediate, scratch_dir


def _profile_sql(columns: list[tuple[str, str, str]]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS rows, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS \"distinct\", "
        f"CAST(min({c}) AS VARCHAR) AS smallest, CAST(max({c}) AS VARCHAR) AS largest FROM {table}"
        for c, kind, table in columns
    ]
    return " UNION ALL ".join(parts)


@query(
    "column VARCHAR, type VARCHAR, rows BIGINT, missing BIGINT, distinct BIGINT, smallest VARCHAR, largest VARCHAR",
    _profile_sql([
        ("o_orderkey", "bigint", "o"), ("o_custkey", "bigint", "o"),
        ("CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END", "string", "o"),
        ("o_totalprice", "decimal(18,2)", "o"), ("o_orderdate", "date", "o"), ("o_orderpriority", "string", "o"),
    ]).replace("'CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END' AS", "'o_orderstatus' AS"),
)
def profile(t):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return explore.profile(t.orders.withColumn("o_orderstatus", known))


@query(
    "column VARCHAR, rows BIGINT, missing BIGINT, distinct_fits BIGINT, median_fits BIGINT",
    """SELECT c AS "column", n AS rows, missing, 1 AS distinct_fits, 1 AS median_fits FROM (SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS p FROM o),
      LATERAL (VALUES ('o_orderkey', 0), ('o_custkey', 0), ('o_orderstatus', p), ('o_totalprice', 0), ('o_orderdate', 0), ('o_orderpriority', 0)) v(c, missing)""",
)
def profile_sketches(t):
    """Sketches of every year of orders, stored per year and merged, held against exact values: whether
    the distinct count and the rank of the median are within the stated errors."""
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = t.orders.withColumn("o_orderstatus", known)
    yearly = save_intermediate(explore.column_sketches(orders.withColumn("order_year", F.year("o_orderdate")), ["order_year"]), "year-sketches")
    path = os.path.join(scratch_dir(t.spark), f"sketches-{uuid.uuid4().hex}")
    years = sorted(r[0] for r in yearly.select("order_year").distinct().collect())
    replace_partitions(yearly, path, "order_year", years)
    about = explore.sketch_profile(explore.merge_sketches(partitioned_table(t.spark, path)), (0.5,))
    exact = explore.profile(orders).select("column", "distinct")
    edges = [0.5 - 2 * explore.RANK_ERROR, 0.5 + 2 * explore.RANK_ERROR]
    numbers = ["o_orderkey", "o_custkey", "o_totalprice"]
    bounds = explore.exact_quantiles(orders, numbers, edges, save=save_intermediate).withColumnRenamed("quantiles", "bounds")
    median = F.col("quantiles_about")[0]
    fits = F.abs(F.col("distinct_about") - F.col("distinct")) <= F.col("distinct") * (2 * explore.DISTINCT_ERROR)
    inside = F.coalesce(median.between(F.col("bounds")[0], F.col("bounds")[1]), F.col("bounds").isNull() & median.isNull())
    return about.join(exact, "column").join(bounds, "column", "left").select(
        "column", "rows", "missing", fits.cast("int").alias("distinct_fits"), inside.cast("int").alias("median_fits")
    )


@query(
    "duplicates BIGINT",
    """SELECT sum(n - 1) AS duplicates FROM (SELECT count(*) AS n FROM l GROUP BY l_partkey, l_linenumber, l_returnflag, l_quantity)""",
)
def duplicate_rows(t):
    return explore.duplicate_rows(t.lineitem.select("l_partkey", "l_linenumber", "l_returnflag", "l_quantity"))


@query(
    "c_custkey BIGINT, c_name VARCHAR, segment VARCHAR, c_mktsegment VARCHAR",
    """SELECT c_custkey, c_name, CASE c_mktsegment WHEN 'BUILDING' THEN 'Car' WHEN 'MACHINERY' THEN 'Motorbike' ELSE 'Other' END AS segment,
      coalesce(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END, 'Unknown') AS c_mktsegment FROM c""",
)
def clean(t):
    raw = t.customer.withColumns({
        "c_name": F.concat(F.lit("'"), "c_name", F.lit("'")),
        "c_mktsegment": F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")),
    })
    return explore.clean(
        raw, {"c_mktsegment": "Unknown"}, ["c_name"],
        {"segment": ("c_mktsegment", {"BUILDING": "Car", "MACHINERY": "Motorbike"}, "Other")},
    )


@query(
    "o_orderpriority VARCHAR, rows BIGINT, percent DOUBLE, is_largest VARCHAR",
    f"""WITH n AS (SELECT o_orderpriority, count(*) AS rows FROM o GROUP BY 1)
    SELECT *, {ratio_sql("rows * 100", "(SELECT sum(rows) FROM n)", 2)} AS percent, rows = (SELECT max(rows) FROM n) AS is_largest FROM n""",
)
def count_share(t):
    return explore.count_share(t.orders, "o_orderpriority")


@query(
    "p_brand VARCHAR, total DOUBLE, total_scaled DOUBLE",
    """SELECT p_brand, sum(l_extendedprice) AS total, CAST((CAST(sum(l_extendedprice) * 100 AS HUGEINT) + 5000) // 10000 AS DOUBLE) / 100 AS total_scaled
    FROM l JOIN p ON p_partkey = l_partkey GROUP BY 1 ORDER BY total DESC, p_brand LIMIT 10""",
)
def top_k_by(t):
    sold = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return explore.top_k_by(sold, "p_brand", F.sum("l_extendedprice"), 10, 10_000)


@query(
    "month VARCHAR, month_name VARCHAR, rows BIGINT, amount DOUBLE",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, monthname(o_orderdate) AS month_name, count(*) AS rows, sum(o_totalprice) AS amount FROM o GROUP BY 1, 2""",
)
def monthly_trend(t):
    return explore.monthly_trend(t.orders, "o_orderdate", "o_totalprice")


@query(
    "c_mktsegment VARCHAR, o_orderpriority VARCHAR, mean_scaled DOUBLE",
    """SELECT c_mktsegment, o_orderpriority, round(CAST(sum(o_totalprice) AS DOUBLE) / count(*) / 1000000, 6) AS mean_scaled
    FROM o JOIN c ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def mean_by(t):
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    means = explore.mean_by(owned, ["c_mktsegment", "o_orderpriority"], "o_totalprice")
    return means.withColumn("mean_scaled", F.round("mean_scaled", 6))


@query(
    "c_mktsegment VARCHAR, F DOUBLE, O DOUBLE, P DOUBLE",
    """SELECT c_mktsegment, round(CAST(sum(o_totalprice) FILTER (o_orderstatus = 'F') AS DOUBLE) / 1e9, 6) AS "F",
      round(CAST(sum(o_totalprice) FILTER (o_orderstatus = 'O') AS DOUBLE) / 1e9, 6) AS "O", round(CAST(sum(o_totalprice) FILTER (o_orderstatus = 'P') AS DOUBLE) / 1e9, 6) AS "P"
    FROM o JOIN c ON c_custkey = o_custkey GROUP BY 1""",
)
def pivot_sum(t):
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    wide = explore.pivot_sum(owned, "c_mktsegment", "o_orderstatus", "o_totalprice")
    return wide.select("c_mktsegment", *[F.round(c, 6).alias(c) for c in wide.columns[1:]])
