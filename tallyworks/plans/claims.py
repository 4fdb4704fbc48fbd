"""Dimension versions, change history and the wide claim record on the star-schema tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tallyworks.functions import assemble_timestamp, fingerprint
from tallyworks.operators import change_log, claims, temporal
from tallyworks.operators.ordering import ordered_concat as join_in_order
from tallyworks.operators.ordering import ordered_scan
from tallyworks.plans.registry import query
from tallyworks.sources import replace_partition as write_partition
from tallyworks.sources import save_intermediate, scratch_dir

AS_OF = "1998-12-31"

VERSIONS_SQL = """versions AS (
  SELECT o_custkey, o_orderdate AS eff_date, o_orderkey AS version_key, o_orderpriority AS version_priority,
    coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) - 1, DATE '3000-01-01') AS end_date
  FROM (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1))"""


def order_versions(t):
    """Orders of a customer as versions: each is valid until the day before the next."""
    newest = t.orders.groupBy("o_custkey", F.col("o_orderdate").alias("eff_date")).agg(
        F.max("o_orderkey").alias("version_key"),
        F.max_by("o_orderpriority", "o_orderkey").alias("version_priority"),
    )
    ordered = ordered_scan(newest, ["eff_date"], ["o_custkey"], following={"next_date": "eff_date"})
    end = F.coalesce(F.date_sub("next_date", 1), F.lit(temporal.OPEN_DATE).cast("date"))
    return ordered.withColumn("end_date", end).drop("next_date")


@query(
    "c_custkey BIGINT, version_key BIGINT, version_priority VARCHAR",
    f"""WITH {VERSIONS_SQL} SELECT c_custkey, version_key, version_priority FROM c
    LEFT JOIN versions ON o_custkey = c_custkey AND DATE '{AS_OF}' BETWEEN eff_date AND end_date""",
)
def asof_dim_join(t):
    versions = order_versions(t).withColumnRenamed("o_custkey", "c_custkey")
    return temporal.asof_dim_join(t.customer, versions, ["c_custkey"], AS_OF)


@query(
    "l_orderkey BIGINT, l_linenumber BIGINT, l_shipdate VARCHAR, o_custkey BIGINT, version_key BIGINT",
    f"""WITH {VERSIONS_SQL} SELECT l_orderkey, l_linenumber, l_shipdate, o.o_custkey, version_key
    FROM l JOIN o ON o_orderkey = l_orderkey LEFT JOIN versions v
      ON v.o_custkey = o.o_custkey AND l_shipdate BETWEEN eff_date AND end_date""",
)
def asof_row_join(t):
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(owners, "l_orderkey")
    return temporal.asof_row_join(lines, order_versions(t), ["o_custkey"], "l_shipdate")


@query(
    "user_id BIGINT, day VARCHAR, kinds VARCHAR",
    "SELECT user_id, day, string_agg(event_type, ',' ORDER BY ts, event_id) AS kinds FROM e GROUP BY 1, 2",
)
def ordered_concat(t):
    return join_in_order(t.events, ["user_id", "day"], {"kinds": "event_type"}, ["ts", "event_id"])


@query(
    "o_orderkey BIGINT, label VARCHAR",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast'
      WHEN o_orderpriority = '5-LOW' THEN 'slow' ELSE 'normal' END AS label FROM o""",
)
def map_codes(t):
    labels = {"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}
    return temporal.map_codes(t.orders, "o_orderpriority", labels, "normal", "label")


@query(
    "claim_id BIGINT, change_date VARCHAR, estimated_amount VARCHAR",
    f"""WITH a AS (SELECT l_orderkey AS claim_id, l_shipdate AS d, 0 AS src,
        string_agg(CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR), ',' ORDER BY l_linenumber, round(l_extendedprice)) AS v
      FROM l WHERE l_returnflag = 'N' AND l_shipdate <= DATE '{AS_OF}' GROUP BY 1, 2
      UNION ALL SELECT l_orderkey, o_orderdate + 400, 1,
        string_agg(CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR), ',' ORDER BY l_linenumber, round(l_extendedprice))
      FROM l JOIN o ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT claim_id, d AS change_date, v AS estimated_amount FROM a
    QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY d DESC, src DESC) = 1""",
)
def estimate_history(t):
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"),
        F.col("l_linenumber").alias("code"),
        F.col("l_extendedprice").alias("amount"),
        "l_returnflag",
        "l_shipdate",
    )
    asked = lines.filter(F.col("l_returnflag") == "N").withColumnRenamed("l_shipdate", "requested_at")
    approved_at = F.when(
        F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 400)
    ).otherwise(F.lit(temporal.OPEN_DATE).cast("date"))
    approvals = lines.join(
        t.orders.select(F.col("o_orderkey").alias("claim_id"), approved_at.alias("approved_at")),
        "claim_id",
    )
    return temporal.estimate_history(
        asked, approvals, ["claim_id"], "code", "amount", "requested_at", "approved_at", AS_OF
    )


@query(
    "c_custkey BIGINT, c_acctbal DOUBLE, last_price DOUBLE",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN b.o_totalprice ELSE c_acctbal END AS c_acctbal, last_price
    FROM c LEFT JOIN (SELECT o_custkey, o_totalprice, o_totalprice AS last_price FROM o
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1) b ON o_custkey = c_custkey""",
)
def patch_from(t):
    newest = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey",
        F.col("o_totalprice").alias("c_acctbal"), F.col("o_totalprice").alias("last_price"),
    )
    building = F.col("c_mktsegment") == "BUILDING"
    some = temporal.patch_from(
        t.customer, newest, ["c_custkey"], ["c_acctbal"], "o_orderkey", when=building
    )
    return temporal.patch_from(some, newest, ["c_custkey"], ["last_price"], "o_orderkey", mode="fill")


@query(
    "user_id BIGINT, last_view VARCHAR, last_purchase VARCHAR, last_money VARCHAR",
    """SELECT user_id, date_trunc('second', max(ts) FILTER (event_type = 'view')) AS last_view,
      date_trunc('second', max(ts) FILTER (event_type = 'purchase')) AS last_purchase,
      date_trunc('second', max(ts) FILTER (event_type IN ('purchase', 'signup'))) AS last_money
    FROM e WHERE day <= DATE '2024-01-20' GROUP BY 1""",
)
def milestones(t):
    kind = F.col("event_type")
    spec = {
        "last_view": kind == "view",
        "last_purchase": kind == "purchase",
        "last_money": kind.isin("purchase", "signup"),
    }
    found = temporal.milestones(t.events, ["user_id"], "ts", spec, "2024-01-20")
    return found.select("user_id", *[F.date_trunc("second", c).alias(c) for c in spec])


@query(
    "o_orderkey BIGINT, starts_at VARCHAR",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 510 MINUTE
      WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) + to_minutes(60 * (o_orderkey % 24) + 5) WHEN 2 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 17 HOUR
      ELSE CAST(o_orderdate AS TIMESTAMP) END AS starts_at FROM o""",
)
def assembled_timestamp(t):
    turn = F.col("o_orderkey") % 4
    clock = (
        F.when(turn == 0, "8H30")
        .when(turn == 1, F.concat(F.col("o_orderkey") % 24, F.lit("h05")))
        .when(turn == 2, "17:00")
    )
    return t.orders.select("o_orderkey", assemble_timestamp(F.col("o_orderdate"), clock).alias("starts_at"))


HASH_SQL = """md5('=' || o_orderkey || '|' || coalesce('=' || replace(replace(o_orderpriority, '\\', '\\\\'), '|', '\\p'), '~')
  || '|' || coalesce('=' || nullif(o_orderstatus, 'O'), '~') || '|=' || o_totalprice || '|=' || o_orderdate)"""


@query(
    "o_orderkey BIGINT, row_hash VARCHAR", f"SELECT o_orderkey, {HASH_SQL} AS row_hash FROM o"
)
def row_fingerprint(t):
    status = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    columns = [F.col("o_orderkey"), F.col("o_orderpriority"), status, F.col("o_totalprice"), F.col("o_orderdate")]
    return t.orders.select("o_orderkey", fingerprint(columns).alias("row_hash"))


def customer_state(t, day: str):
    """Order count, total and last day of every customer on a date, with its fingerprint."""
    state = (
        t.orders.filter(F.col("o_orderdate") <= F.lit(day).cast("date"))
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("o_totalprice").alias("total"),
            F.max("o_orderdate").alias("last_day"),
        )
    )
    hashed = change_log.with_fingerprint(state, ["o_custkey", "order_count", "total", "last_day"])
    return hashed.withColumn("fk_date", F.lit(day).cast("date"))


def state_sql(day: str) -> str:
    return f"""(SELECT *, DATE '{day}' AS fk_date, md5('=' || o_custkey || '|=' || order_count || '|=' || total || '|=' || last_day) AS row_hash
      FROM (SELECT o_custkey, count(*) AS order_count, sum(o_totalprice) AS total, max(o_orderdate) AS last_day
        FROM o WHERE o_orderdate <= DATE '{day}' GROUP BY 1))"""


LOG_DAYS = ("1997-01-01", "1997-03-01", "1997-05-01")
HISTORY_SQL = f"""s1 AS {state_sql(LOG_DAYS[0])}, s2 AS {state_sql(LOG_DAYS[1])}, s3 AS {state_sql(LOG_DAYS[2])},
  changed AS (SELECT * FROM s2 WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.o_custkey = s2.o_custkey AND s1.row_hash = s2.row_hash)),
  log AS (SELECT * FROM s1 UNION ALL SELECT * FROM changed),
  third AS (SELECT * FROM s1 WHERE o_custkey % 2 = 0 UNION ALL SELECT * FROM s3 WHERE o_custkey % 2 = 1)"""


def history_log(t):
    first, second = customer_state(t, LOG_DAYS[0]), customer_state(t, LOG_DAYS[1])
    changed = change_log.change_log_append(first, second, ["o_custkey"], as_of=LOG_DAYS[1])
    return first.unionByName(changed)


def third_snapshot(t):
    """Even customers go back to their first state, odd ones move on."""
    back = customer_state(t, LOG_DAYS[0]).filter(F.col("o_custkey") % 2 == 0)
    on = customer_state(t, LOG_DAYS[2]).filter(F.col("o_custkey") % 2 == 1)
    return back.unionByName(on)


@query(
    "o_custkey BIGINT, row_hash VARCHAR",
    f"""WITH {HISTORY_SQL} SELECT o_custkey, row_hash FROM third WHERE row_hash IS DISTINCT FROM
      (SELECT arg_max(row_hash, fk_date) FROM log WHERE log.o_custkey = third.o_custkey)""",
)
def change_log_latest(t):
    return change_log.change_log_append(
        history_log(t), third_snapshot(t), ["o_custkey"], as_of=LOG_DAYS[2]
    )


@query(
    "o_custkey BIGINT, row_hash VARCHAR",
    f"""WITH {HISTORY_SQL} SELECT o_custkey, row_hash FROM third WHERE NOT EXISTS
      (SELECT 1 FROM log WHERE log.o_custkey = third.o_custkey AND log.row_hash = third.row_hash)""",
)
def change_log_any(t):
    return change_log.change_log_append(
        history_log(t), third_snapshot(t), ["o_custkey"], as_of=LOG_DAYS[2], compare="any"
    )


@query(
    "order_year VARCHAR, o_orderpriority VARCHAR, n BIGINT, total DOUBLE",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS order_year, o_orderpriority, count(*) AS n, sum(o_totalprice) AS total
    FROM o GROUP BY 1, 2""",
)
def replace_partition(t):
    path = os.path.join(scratch_dir(t.spark), f"yearly-{uuid.uuid4().hex}")
    yearly = (
        t.orders.withColumn("order_year", F.year("o_orderdate"))
        .groupBy("order_year", "o_orderpriority")
        .agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    )
    yearly.write.partitionBy("order_year").parquet(path)
    write_partition(yearly, path, "order_year", 1997)  # the run of one year is repeated
    return t.spark.read.parquet(path)


@query(
    "claim_id BIGINT, paid_amount DOUBLE, paid_date VARCHAR",
    f"""SELECT l_orderkey AS claim_id, sum(l_extendedprice) AS paid_amount, max(l_shipdate) AS paid_date FROM l
    WHERE l_shipdate <= DATE '{AS_OF}' AND l_shipdate + 700 >= DATE '{AS_OF}' GROUP BY 1""",
)
def payment_rollup(t):
    payments = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"), "l_extendedprice", "l_shipdate",
        F.col("l_shipdate").alias("eff_date"), F.date_add("l_shipdate", 700).alias("end_date"),
    )
    return temporal.payment_rollup(payments, ["claim_id"], "l_extendedprice", "l_shipdate", AS_OF)


CHANNEL_COLUMNS = [
    "general_agency", "tier_2_agency", "tier_3_agency",
    "general_sale_channel", "tier_2_sale_channel", "tier_3_sale_channel",
]


@query(
    "c_custkey BIGINT, " + ", ".join(f"{c} VARCHAR" for c in CHANNEL_COLUMNS),
    """WITH b AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'D' WHEN c_custkey % 3 = 0 THEN 'K' END AS kind,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'VNPOST' WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS parent,
        CASE WHEN c_custkey % 5 > 0 THEN 'G' || c_nationkey END AS second, 'A' || c_custkey % 7 AS third,
        CASE WHEN c_custkey % 4 > 0 THEN 'K' || c_custkey END AS kt, CASE WHEN c_custkey % 6 > 0 THEN 'CO' || c_nationkey END AS company FROM c),
    x AS (SELECT *, CASE WHEN kind = 'D' THEN parent ELSE 'KHAC' END AS p, CASE WHEN kind = 'D' THEN second ELSE 'KHAC' END AS a2,
        CASE WHEN kind = 'D' THEN third ELSE 'KHAC' END AS a3 FROM b)
    SELECT c_custkey, coalesce(p, 'KHAC') AS general_agency, coalesce(a2, 'KHAC') AS tier_2_agency, coalesce(a3, 'KHAC') AS tier_3_agency,
      coalesce(parent, 'KHAC') AS general_sale_channel,
      coalesce(CASE WHEN p = 'VNPOST' AND kt IS NULL THEN a2 ELSE company END, 'KHONG_KENH_KT') AS tier_2_sale_channel,
      coalesce(CASE WHEN p = 'VNPOST' AND kt IS NULL THEN a3 ELSE kt END, 'KHONG_KENH_KT') AS tier_3_sale_channel FROM x""",
)
def channel_fallback(t):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    segment = F.col("c_mktsegment")
    policies = t.customer.select(
        "c_custkey",
        F.when(key % 2 == 0, "D").when(key % 3 == 0, "K").alias("sale_channel_type"),
        F.when(segment == "HOUSEHOLD", "VNPOST").when(segment != "BUILDING", segment).alias("custid_tong"),
        F.when(key % 5 > 0, F.concat(F.lit("G"), nation)).alias("general_agency_channel"),
        F.concat(F.lit("A"), key % 7).alias("sale_code"),
        F.when(key % 4 > 0, F.concat(F.lit("K"), key)).alias("custid_kt"),
        F.when(key % 6 > 0, F.concat(F.lit("CO"), nation)).alias("company_code"),
    )
    return claims.channel_fallback(policies)


def day(text: str):
    return F.lit(text).cast("date")


def claim_sources(t) -> dict:
    """Claim tables made from the star schema: an order is a claim, its lines are clauses,
    payments and log entries, a customer is a policy with two versions."""
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    unit = F.concat(F.lit("U"), nation).alias("unit_code")
    always = [day("1990-01-01").alias("eff_date"), day(temporal.OPEN_DATE).alias("end_date")]
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    department = F.when(nation % 3 == 0, "000").when(nation % 3 == 1, "MN").otherwise("999")
    base = owned.select(
        unit,
        F.concat(F.lit("U"), nation).alias("manage_unit_code"),
        key.alias("claim_id"),
        F.concat(F.lit("C"), key).alias("claim_no"),
        department.alias("department_code"),
        F.col("o_custkey").alias("policy_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "2B").otherwise("XE").alias("category"),
        (key % 25).alias("claim_detail_status"),
        (key % 500).alias("call_center_id"),
        F.col("o_orderdate").alias("system_date"),
        F.date_sub("o_orderdate", 3).alias("incident_date"),
        F.when(key % 5 > 0, F.concat(F.lit("K"), key % 50)).alias("garage_code"),
        F.when(key % 7 > 0, F.concat(F.lit("L|"), key)).alias("license_plate"),
        F.concat(F.lit("T"), key % 9).alias("tier1_checker_user"),
        F.when(F.col("o_orderstatus") == "F", F.date_add("o_orderdate", 30))
        .otherwise(day(temporal.OPEN_DATE))
        .alias("claim_approved_date"),
        F.col("o_orderdate").alias("eff_date"),
        day(temporal.OPEN_DATE).alias("end_date"),
    )
    # Ten sources are made from the lines with their unit: written once, then scanned with few columns each.
    lines = save_intermediate(
        t.lineitem.drop("l_partkey", "l_suppkey").join(owned.select(key.alias("l_orderkey"), unit), "l_orderkey").withColumnRenamed("l_orderkey", "claim_id"),
        "claim-lines",
    )
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    clause = F.concat(F.lit("XO."), F.col("l_linenumber")).alias("business_type_code")
    custkey = F.col("c_custkey")
    policy = t.customer.select(
        unit,
        custkey.alias("policy_id"),
        F.concat(F.lit("K"), custkey).alias("custid"),
        F.when(custkey % 4 > 0, F.concat(F.lit("K"), custkey % 50)).alias("custid_kt"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD"), "D").otherwise("K").alias("sale_channel_type"),
        F.concat(F.lit("A"), custkey % 7).alias("sale_code"),
        F.element_at(F.array(*[F.lit(v) for v in (-41, 0, 10, 20, 99)]), (custkey % 5 + 1).cast("int")).alias("vip_code"),
    )
    old = policy.withColumns({
        "policy_number": F.concat(F.lit("P"), "policy_id", F.lit("-1")),
        "eff_date": day("1990-01-01"), "end_date": day("1997-12-31"),
    })
    new = policy.withColumns({
        "policy_number": F.concat(F.lit("P"), "policy_id", F.lit("-2")),
        "eff_date": day("1998-01-01"), "end_date": day(temporal.OPEN_DATE),
    })
    dated = [F.col("l_shipdate").alias("eff_date"), day(temporal.OPEN_DATE).alias("end_date")]
    money = [
        "unit_code", "claim_id", F.when(F.col("l_linenumber") % 2 == 0, "T").otherwise("C").alias("kind"),
        F.col("l_extendedprice").alias("amount_lcy"), F.col("l_shipdate").alias("system_date"), *dated,
    ]
    actions = F.array(*[F.lit(a) for a in (
        "M_CHUYEN_C", "C_CHUYEN_V", "V_DUYET", "V_DUYET_DG_BL", "M_TRINH_C_DNTT", "C_CHUYEN_V_DNTT", "DUYET_QDINH",
    )])
    k50 = F.substring("custid_kt", 2, 10).cast("int")
    return {
        "claims": base,
        "clauses": lines.select(
            "unit_code", "claim_id", F.col("claim_id").alias("object_id"), clause,
            F.col("l_extendedprice").alias("compensation_amount"),
        ),
        "policies": old.unionByName(new),
        "certificates": owned.select(
            unit, F.col("o_custkey").alias("policy_id"), key.alias("certificate_id"),
            F.concat(F.lit("CT"), key).alias("certificate"),
            (key % 20 + 2000).alias("production_year"),
            F.col("o_orderdate").alias("certificate_effective_date"),
            F.when(key % 3 == 0, "8H30").when(key % 3 == 1, "10h05").alias("certificate_effective_time"),
            *always,
        ),
        "customers": policy.filter(F.col("custid_kt").isNotNull()).select("unit_code", F.col("custid_kt").alias("custid")).distinct()
        .withColumn("custid_kt", F.col("custid"))
        .select(
            "unit_code", "custid",
            F.when(k50 % 2 == 0, "VNPOST").otherwise("GROUP").alias("custid_tong"),
            F.concat(F.lit("CO"), k50).alias("company_code"), *always,
        ),
        "units": t.nation.select(
            F.concat(F.lit("U"), "n_nationkey").alias("unit_code"), F.col("n_name").alias("unit_name"), *always
        ),
        "departments": t.nation.select(
            F.concat(F.lit("U"), "n_nationkey").alias("unit_code"),
            F.when(F.col("n_nationkey") % 3 == 0, "000").when(F.col("n_nationkey") % 3 == 1, "MN").otherwise("998").alias("department_code"),
            F.concat(F.lit("D "), "n_name").alias("department_name"), *always,
        ),
        "agencies": policy.select("unit_code", F.col("sale_code").alias("agency_id")).distinct().select(
            "unit_code", "agency_id", F.concat(F.lit("G"), "agency_id").alias("general_agency_channel"), *always
        ),
        "vip_customers": t.customer.filter(F.col("c_acctbal") > 5000).select(
            unit, F.concat(F.lit("K"), custkey).alias("custid"),
            F.concat(F.lit("VIP "), "c_mktsegment").alias("vip_customer_type"), *always,
        ),
        "estimates": lines.filter(flag == "N").select(
            "unit_code", "claim_id", clause, F.col("l_extendedprice").alias("compensation_amount"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("requested_at"),
        ),
        "log": lines.select(
            "unit_code", "claim_id", F.element_at(actions, F.col("l_linenumber")).alias("action"),
            F.when(status == "O", "C").otherwise("D").alias("approve_type"),
            F.col("l_shipdate").cast("timestamp_ntz").alias("created_date"),
        ),
        "garage_debt": lines.filter((flag == "A") & (status == "O")).select(*money),
        "advances": lines.filter((flag == "A") & (status == "F")).select(*money),
        "calls": owned.groupBy(unit, (key % 500).alias("call_center_id")).agg(
            F.max("o_orderdate").alias("created_date"), F.lit(1).alias("valid")
        ),
        "garage_payments": lines.filter((flag == "R") & (status == "O")).select(*money),
        "customer_payments": lines.filter((flag == "R") & (status == "F")).select(*money)
        .withColumnRenamed("system_date", "created_date"),
        "prices": lines.filter(flag == "N").select(
            "unit_code", "claim_id", F.col("l_shipdate").cast("timestamp_ntz").alias("proposed_at"),
            F.when(F.col("l_linenumber") % 4 > 0, F.col("l_extendedprice")).otherwise(0).alias("price_approve_amt"),
            F.col("l_extendedprice").alias("replacement_amt"), F.col("l_quantity").alias("special_replacement_amt"),
            F.col("l_discount").alias("repair_amt"), F.col("l_tax").alias("repainting_amt"), F.col("l_discount").alias("labor_amt"),
            F.col("l_quantity").alias("lifting_amt"), F.col("l_tax").alias("compensation_amt"), F.col("l_discount").alias("risk_shared_amt"),
            F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("deductible_quantity"),
        ),
        "car_claims": owned.filter(key % 3 > 0).select(
            unit, key.alias("claim_id"), F.when(key % 2 == 0, F.concat(F.lit("M"), key % 10)).alias("user"),
            F.concat(F.lit("A"), key % 10).alias("claims_adjuster"),
            F.when(key % 11 > 0, "XE").otherwise("2B").alias("product_type"),
            F.col("o_orderdate").alias("eff_date"), day(temporal.OPEN_DATE).alias("end_date"),
        ),
    }


# Columns of the record that the star schema has no source for.
NOT_HERE = (
    "fee_payment_date notified_date event_code assessment_date garage_name motor_make motor_model_code motor_model chassis_number "
    "motor_owner_name tier2_checker_user validate_user covered_repair_amt covered_lifting_amt total_recovery_amt"
).split()
STATUS_SQL = " ".join(f"WHEN {code} THEN '{name}'" for name, (code,) in claims.STATUS_NAMES.items())
NUMBERS = {"claim_id", "policy_id", "certificate_id", "production_year", "number_of_deduction", "claim_detail_status"}


def claim_sql(on: str) -> str:
    """The record of every claim on a day, without its fingerprint."""
    newest = "ORDER BY l_shipdate DESC, l_extendedprice + l_quantity + l_discount + l_tax + l_discount DESC, l_quantity DESC, l_tax DESC, l_discount DESC"
    steps = {
        "price_make_date": "l_linenumber = 1 AND l_linestatus = 'O'", "price_check_date": "l_linenumber = 2 AND l_linestatus = 'O'",
        "price_validate_date": "l_linenumber = 3 AND l_linestatus = 'O'", "price_approval_make_date": "l_linenumber = 1 AND l_linestatus = 'F'",
        "price_approval_check_date": "l_linenumber = 2 AND l_linestatus = 'F'", "price_approval_validate_date": "l_linenumber IN (3, 4) AND l_linestatus = 'F'",
        "payment_require_make_date": "l_linenumber = 5", "payment_require_check_date": "l_linenumber = 6",
        "payment_require_validate_date": "l_linenumber = 7", "guaranteed": "l_linenumber = 4",
    }
    log = ", ".join(f"CAST(max(CASE WHEN {hit} THEN l_shipdate END) AS TIMESTAMP) AS {name}" for name, hit in steps.items())
    nulls = ", ".join(f"NULL AS {c}" for c in NOT_HERE)

    def listed(flags: str, text: str, order: str) -> str:
        return f"(SELECT l_orderkey AS id, string_agg(amt, ';' ORDER BY l_shipdate, {order}) AS a, string_agg(CAST(l_shipdate AS VARCHAR), ';' ORDER BY l_shipdate) AS d FROM li WHERE {flags} AND {text} GROUP BY 1)"

    def summed(flags: str) -> str:
        return f"(SELECT l_orderkey AS id, sum(l_extendedprice) AS a, max(l_shipdate) AS d FROM li WHERE {flags} AND l_shipdate <= DATE '{on}' GROUP BY 1)"

    return f"""SELECT k.*, {nulls}, codes.business_type_code, coalesce(est.v, '0') AS compensation_amount_lcy, ms.* EXCLUDE (id, guaranteed),
    CASE WHEN category <> '2B' THEN guaranteed END AS guarantee_date, gd.a AS garage_advance_amt, gd.d AS garage_advance_date,
    ad.a AS customer_advance_amt, ad.d AS customer_advance_date, gb.a AS garage_advance_recovery_amt, cb.a AS customer_advance_recovery_amt,
    gp.a AS garage_payment_amt, gp.d AS garage_payment_date, cp.a AS customer_payment_amt, cp.d AS customer_payment_date,
    pr.total_repair_amt, pr.lifting_amt, pr.compensation_amt, pr.risk_shared_amt, coalesce(pr.deductible, 0) AS number_of_deduction,
    calls.d AS call_date, DATE '{on}' AS fk_date
  FROM (
    SELECT o_orderkey AS claim_id, 'C' || o_orderkey AS claim_no, o_custkey AS policy_id, 'P' || o_custkey || '-{2 if on >= "1998" else 1}' AS policy_number,
      o_orderkey AS certificate_id, 'CT' || o_orderkey AS certificate, CASE WHEN o_orderpriority = '1-URGENT' THEN '2B' ELSE 'XE' END AS category,
      c_nationkey, CASE c_nationkey % 3 WHEN 0 THEN 'Miền Bắc' WHEN 1 THEN 'Miền Nam' ELSE '' END AS region,
      'U' || c_nationkey AS unit_code, 'U' || c_nationkey AS manage_unit_code, n_name AS unit_name,
      CASE c_nationkey % 3 WHEN 0 THEN '000' WHEN 1 THEN 'MN' ELSE '999' END AS department_code,
      CASE WHEN c_nationkey % 3 < 2 THEN 'D ' || n_name END AS department_name,
      CASE WHEN c_acctbal > 5000 THEN 'VIP ' || c_mktsegment ELSE CASE c_custkey % 5 WHEN 0 THEN 'VIP 1 KT' WHEN 1 THEN 'KH thông thường'
        WHEN 2 THEN 'KH xấu' WHEN 3 THEN 'Đ.lý/Môi giới VIP - Các đối tượng/KH đ.lý/Môi giới này khai thác được coi là VIP' ELSE 'Không xác định' END END AS vip_customer_type,
      CASE WHEN NOT sold THEN 'KHAC' ELSE coalesce(parent, 'KHAC') END AS general_agency,
      CASE WHEN NOT sold THEN 'KHAC' ELSE 'GA' || c_custkey % 7 END AS tier_2_agency, CASE WHEN NOT sold THEN 'KHAC' ELSE 'A' || c_custkey % 7 END AS tier_3_agency,
      coalesce(parent, 'KHAC') AS general_sale_channel,
      CASE WHEN c_custkey % 4 = 0 THEN 'KHONG_KENH_KT' ELSE 'CO' || c_custkey % 50 END AS tier_2_sale_channel,
      CASE WHEN c_custkey % 4 = 0 THEN 'KHONG_KENH_KT' ELSE 'K' || c_custkey % 50 END AS tier_3_sale_channel,
      'K' || c_custkey AS custid, o_orderdate - 3 AS incident_date, o_orderdate AS system_date,
      CASE WHEN o_orderkey % 5 > 0 THEN 'K' || o_orderkey % 50 END AS garage_code, CASE WHEN o_orderkey % 7 > 0 THEN 'L|' || o_orderkey END AS license_plate,
      o_orderkey % 20 + 2000 AS production_year, o_orderkey % 25 AS claim_detail_status, CASE o_orderkey % 25 {STATUS_SQL} ELSE '' END AS claim_detail_status_name,
      CASE WHEN o_orderstatus = 'F' THEN o_orderdate + 30 ELSE DATE '3000-01-01' END AS claim_approved_date,
      CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 11 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'A' END || o_orderkey % 10 END AS maker_user,
      'T' || o_orderkey % 9 AS tier1_checker_user,
      CASE WHEN o_orderkey % 5 > 0 AND EXISTS (SELECT 1 FROM c g WHERE g.c_nationkey = b.c_nationkey AND g.c_custkey % 4 > 0 AND g.c_custkey % 50 = o_orderkey % 50)
        THEN CASE WHEN o_orderkey % 50 % 2 = 0 THEN 'VNPOST' ELSE 'GROUP' END END AS custid_tong,
      CAST(o_orderdate AS TIMESTAMP) + to_minutes(CASE o_orderkey % 3 WHEN 0 THEN 510 WHEN 1 THEN 605 ELSE 0 END) AS certificate_effective_date
    FROM (SELECT *, c_mktsegment IN ('BUILDING', 'HOUSEHOLD') AS sold,
        CASE WHEN c_custkey % 4 > 0 THEN CASE WHEN c_custkey % 50 % 2 = 0 THEN 'VNPOST' ELSE 'GROUP' END END AS parent
      FROM o JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderdate <= DATE '{on}') b) k
  JOIN (SELECT l_orderkey AS id, string_agg(code, ',' ORDER BY code) AS business_type_code FROM li GROUP BY 1) codes ON codes.id = claim_id
  LEFT JOIN (SELECT id, v FROM (
      SELECT l_orderkey AS id, l_shipdate AS d, 0 AS src, string_agg(amt, ',' ORDER BY code, round(l_extendedprice)) AS v
      FROM li WHERE l_returnflag = 'N' AND l_shipdate <= DATE '{on}' GROUP BY 1, 2
      UNION ALL SELECT l_orderkey, o_orderdate + 30, 1, string_agg(amt, ',' ORDER BY code, round(l_extendedprice))
      FROM li JOIN o ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY d DESC, src DESC) = 1) est ON est.id = claim_id
  LEFT JOIN (SELECT l_orderkey AS id, {log} FROM li WHERE l_shipdate <= DATE '{on}' GROUP BY 1) ms ON ms.id = claim_id
  LEFT JOIN (SELECT l_orderkey AS id, l_extendedprice + l_quantity + l_discount + l_tax + l_discount AS total_repair_amt, l_quantity AS lifting_amt,
      l_tax AS compensation_amt, l_discount AS risk_shared_amt, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS deductible
    FROM li WHERE l_returnflag = 'N' AND l_linenumber % 4 > 0 AND l_extendedprice <> 0
    QUALIFY row_number() OVER (PARTITION BY l_orderkey {newest}, coalesce(deductible, 0) DESC) = 1) pr ON pr.id = claim_id
  LEFT JOIN {listed("l_returnflag = 'A' AND l_linestatus = 'O'", "l_linenumber % 2 = 0", "round(l_extendedprice)")} gd ON gd.id = claim_id
  LEFT JOIN {listed("l_returnflag = 'A' AND l_linestatus = 'F'", "l_linenumber % 2 = 1", "round(l_extendedprice)")} ad ON ad.id = claim_id
  LEFT JOIN {summed("l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber % 2 = 1")} gb ON gb.id = claim_id
  LEFT JOIN {summed("l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber % 2 = 0")} cb ON cb.id = claim_id
  LEFT JOIN {summed("l_returnflag = 'R' AND l_linestatus = 'O'")} gp ON gp.id = claim_id
  LEFT JOIN {summed("l_returnflag = 'R' AND l_linestatus = 'F'")} cp ON cp.id = claim_id
  LEFT JOIN (SELECT c_nationkey AS n, o_orderkey % 500 AS call, max(o_orderdate) AS d FROM o JOIN c ON c_custkey = o_custkey GROUP BY 1, 2) calls
    ON calls.n = k.c_nationkey AND calls.call = claim_id % 500"""


LINES_SQL = "li AS (SELECT *, CAST(CAST(round(l_extendedprice) AS BIGINT) AS VARCHAR) AS amt, 'XO.' || l_linenumber AS code FROM l)"
RECORD_TEXT = " || '|' || ".join(
    f"coalesce('=' || replace(replace(CAST({c} AS VARCHAR), '\\', '\\\\'), '|', '\\p'), '~')" for c in claims.RECORD
)
RECORD_TYPES = ", ".join(f"{c} {'BIGINT' if c in NUMBERS else 'VARCHAR'}" for c in claims.RECORD)


@query(
    f"{RECORD_TYPES}, row_hash VARCHAR, fk_date VARCHAR",
    f"WITH {LINES_SQL}, r AS ({claim_sql(AS_OF)}) SELECT *, md5({RECORD_TEXT}) AS row_hash FROM r",
)
def claim_snapshot(t):
    return claims.claim_snapshot(claim_sources(t), AS_OF, save=save_intermediate)


HISTORY_DAYS = ("1998-03-31", "1998-05-31")


@query(
    "claim_id BIGINT, certificate_id BIGINT, fk_date VARCHAR, row_hash VARCHAR, compensation_amount_lcy VARCHAR",
    f"""WITH {LINES_SQL}, r AS ({claim_sql(HISTORY_DAYS[0])} UNION ALL BY NAME {claim_sql(HISTORY_DAYS[1])}),
      h AS (SELECT *, md5({RECORD_TEXT}) AS row_hash FROM r)
    SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM h b WHERE b.claim_id = h.claim_id AND b.row_hash = h.row_hash AND b.fk_date < h.fk_date)""",
)
def claim_history(t):
    """Two days of records: of the second only those that are new or differ. Days are cut in the
    sources, so that what was written on a day comes out again when the day runs again."""
    sources, scratch = claim_sources(t), scratch_dir(t.spark)
    log, latest = (os.path.join(scratch, f"{name}-{uuid.uuid4().hex}") for name in ("claim-log", "claim-states"))
    for day in HISTORY_DAYS:
        snapshot = claims.claim_snapshot(sources, day, save=save_intermediate).drop("fk_date")
        change_log.append_day_to_latest(t.spark, log, latest, snapshot, ["claim_id", "certificate_id"], day)
    return t.spark.read.parquet(log)
