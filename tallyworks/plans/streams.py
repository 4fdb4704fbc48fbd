"""Streaming jobs run to the end of the available data, on the star-schema tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tallyworks import streaming
from tallyworks.operators.change_log import append_day_to_latest, with_fingerprint
from tallyworks.plans.registry import query
from tallyworks.sources import save_intermediate, scratch_dir
from tallyworks.sources.tables import SCHEMAS


def folder(t, name: str) -> str:
    return os.path.join(scratch_dir(t.spark), f"{name}-{uuid.uuid4().hex}")


def event_stream(t):
    # The file source needs a folder or a pattern.
    stream = t.spark.readStream.schema(SCHEMAS["events"]).parquet(f"{t.path}/events.parque[t]")
    # Watermarks need a timestamp with a zone; the day is taken from the written time.
    return stream.withColumn("day", F.to_date("ts")).withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "user_id BIGINT, day VARCHAR, minutes BIGINT, event_count BIGINT, views BIGINT, purchases BIGINT",
    """SELECT user_id, day, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) // 60000000 AS minutes, count(*) AS event_count,
      count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS purchases FROM e GROUP BY 1, 2""",
)
def session_summary_stream(t):
    kind = F.col("event_type")
    summary = streaming.sessions(
        event_stream(t), ["user_id", "day"], "ts", {"views": kind == "view", "purchases": kind == "purchase"}
    )
    path = folder(t, "sessions")
    streaming.session_stream(summary, path, folder(t, "sessions-checkpoint")).awaitTermination()
    newest = streaming.newest_sessions(t.spark.read.parquet(path), ["user_id", "day"])
    return newest.withColumn("minutes", F.timestamp_diff("MINUTE", F.col("first_ts"), F.col("last_ts")))


@query(
    "user_id BIGINT, first_ts VARCHAR, event_count BIGINT",
    """WITH g AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 21600000000 THEN 0 ELSE 1 END AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
    SELECT user_id, date_trunc('second', min(ts)) AS first_ts, count(*) AS event_count FROM n GROUP BY user_id, s""",
)
def session_windows(t):
    found = streaming.session_windows(t.events, "user_id", "ts", "6 hours")
    return found.withColumn("first_ts", F.date_trunc("second", "first_ts"))


@query(
    "item_id BIGINT, roll_code VARCHAR, id BIGINT, allocated DOUBLE",
    """WITH f AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id, day ORDER BY ts) AS n, user_id || '/' || day AS roll FROM e),
    sup AS (SELECT user_id % 20 AS item, roll, 30 AS q, ts FROM f WHERE n = 1),
    dm AS (SELECT c_custkey % 20 AS item, c_custkey AS id, c_custkey % 90 + 1 AS q FROM c),
    sc AS (SELECT *, sum(q) OVER (PARTITION BY item ORDER BY ts, roll ROWS UNBOUNDED PRECEDING) AS hi FROM sup),
    dc AS (SELECT *, sum(q) OVER (PARTITION BY item ORDER BY id ROWS UNBOUNDED PRECEDING) AS hi FROM dm)
    SELECT sc.item AS item_id, roll AS roll_code, id, least(sc.hi, dc.hi) - greatest(sc.hi - sc.q, dc.hi - dc.q) AS allocated
    FROM sc JOIN dc ON dc.item = sc.item AND dc.hi - dc.q < sc.hi AND sc.hi - sc.q < dc.hi""",
)
def scan_allocation_stream(t):
    # The first event of a user on a day is the scan of a roll, and every scan arrives twice.
    once = t.events.groupBy("user_id", "day").agg(F.min("ts").cast("timestamp").alias("ts")).select(
        (F.col("user_id") % 20).alias("item_id"),
        F.concat_ws("/", "user_id", "day").alias("roll_code"),
        F.lit(30).cast("decimal(18,2)").alias("quantity"),
        "ts",
    )
    doubled = once.unionByName(once)
    stored = save_intermediate(doubled, "scans")
    source = t.spark.readStream.schema(stored.schema).parquet(os.path.dirname(stored.inputFiles()[0]))
    lines = t.customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") % 20).alias("item_id"),
        (F.col("c_custkey") % 90 + 1).cast("decimal(18,2)").alias("quantity"),
        F.lit(0).alias("builtin_order"),
    )
    path = folder(t, "allocations")
    job = streaming.scan_stream(
        source, lambda: lines, path, folder(t, "allocations-checkpoint")
    )
    job.awaitTermination()
    return t.spark.read.parquet(path)


@query(
    "o_custkey BIGINT, fk_date VARCHAR, order_count BIGINT",
    """WITH d(day) AS (VALUES (DATE '1997-01-01'), (DATE '1997-02-01'), (DATE '1997-03-01')),
    st AS (SELECT o_custkey, day, count(*) AS n FROM o, d WHERE o_orderdate <= day GROUP BY 1, 2)
    SELECT o_custkey, day AS fk_date, n AS order_count FROM st
    QUALIFY n IS DISTINCT FROM lag(n) OVER (PARTITION BY o_custkey ORDER BY day)""",
)
def change_log_stream(t):
    days = ["1997-01-01", "1997-02-01", "1997-03-01"]
    before = F.filter(
        F.array(*[F.lit(d).cast("date") for d in days]), lambda d: d >= F.col("o_orderdate")
    )
    counted = (
        t.orders.select("o_custkey", F.explode(before).alias("fk_date"))
        .groupBy("o_custkey", "fk_date")
        .agg(F.count("*").alias("order_count"))
    )
    stored = save_intermediate(with_fingerprint(counted, ["o_custkey", "order_count"]), "snapshots")
    source = t.spark.readStream.schema(stored.schema).parquet(os.path.dirname(stored.inputFiles()[0]))
    path = folder(t, "log")
    job = streaming.change_log_stream(
        source, path, folder(t, "log-checkpoint"), ["o_custkey"], lambda batch: days
    )
    job.awaitTermination()
    return t.spark.read.parquet(path)


@query(
    "o_custkey BIGINT, fk_date VARCHAR, order_count BIGINT",
    """WITH d(day) AS (VALUES (DATE '1997-01-01'), (DATE '1997-02-01'), (DATE '1997-03-01')),
    st AS (SELECT o_custkey, day, count(*) AS n FROM o, d WHERE o_orderdate <= day GROUP BY 1, 2)
    SELECT o_custkey, day AS fk_date, n AS order_count FROM st
    QUALIFY n IS DISTINCT FROM lag(n) OVER (PARTITION BY o_custkey ORDER BY day)""",
)
def change_log_daily(t):
    # Three daily runs and a second run of the second day, each against the newest states only.
    path, latest = folder(t, "daily-log"), folder(t, "daily-latest")
    for day in ("1997-01-01", "1997-02-01", "1997-03-01", "1997-02-01"):
        counted = t.orders.filter(F.col("o_orderdate") <= F.lit(day).cast("date")).groupBy("o_custkey").agg(
            F.count("*").alias("order_count")
        )
        snapshot = with_fingerprint(counted, ["o_custkey", "order_count"])
        append_day_to_latest(t.spark, path, latest, snapshot, ["o_custkey"], day)
    return t.spark.read.parquet(path)
