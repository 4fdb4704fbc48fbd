"""Streaming forms of scan handling, the change log and session summaries.

Every job writes through a checkpoint. Batch functions are safe to run twice for the same batch:
they replace what the batch wrote before, in a folder named by the batch id or the day.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.change_log import append_day
from tallyworks.operators.stock import allocate_fifo
from tallyworks.sources.sinks import save_intermediate

REPEATED, NO_CODE = "already scanned", "no roll code"


def unique_scans(scans: DataFrame, ts: str, roll: str = "roll_code") -> DataFrame:
    """Scans with ``reason``: NULL for the first scan of a roll in the frame, else why it is refused.
    Of scans at one time the one with the smaller row hash counts."""
    window = W.partitionBy(roll).orderBy(ts, F.xxhash64(*scans.columns))
    repeated = F.when(F.row_number().over(window) > 1, F.lit(REPEATED))
    return scans.withColumn("reason", F.when(F.col(roll).isNull(), F.lit(NO_CODE)).otherwise(repeated))


def scan_stream(
    scans: DataFrame,
    demand: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    ts: str = "ts",
    **options,
) -> StreamingQuery:
    """Allocate the rolls of each micro-batch to the demand that is still open.

    ``scans`` has (roll_code, item_id, quantity, ts) and ``demand`` returns the request lines
    (id, item_id, quantity, builtin_order). What earlier batches gave is read from ``path`` and
    taken off the demand first.

    A roll is taken once, ever: the codes of all taken rolls are kept in ``path``-scans and every
    batch is compared with them, however late a scan comes. Refused scans are written to
    ``path``-refused with a reason. Nothing is dropped by a watermark.
    """
    spark = scans.sparkSession
    schema = "item_id bigint, roll_code string, id bigint, allocated decimal(28,4), batch bigint"

    def handle(batch: DataFrame, number: int) -> None:
        taken_before = _read(spark, f"{path}-scans", "roll_code string, batch bigint").filter(F.col("batch") < number)
        judged = unique_scans(save_intermediate(batch, "scan-batch"), ts)
        known = taken_before.select(F.col("roll_code").alias("__taken")).distinct()
        judged = judged.join(known, F.col("roll_code") == F.col("__taken"), "left").withColumn(
            "reason", F.coalesce("reason", F.when(F.col("__taken").isNotNull(), F.lit(REPEATED)))
        )
        judged = save_intermediate(judged.drop("__taken"), "judged-scans")
        accepted = judged.filter(F.col("reason").isNull()).drop("reason")
        judged.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{path}-refused/batch={number}")
        accepted.select("roll_code").write.mode("overwrite").parquet(f"{path}-scans/batch={number}")
        lines = demand()
        given_before = _read(spark, path, schema).filter(F.col("batch") < number)
        taken = given_before.groupBy("id").agg(F.sum("allocated").alias("__taken"))
        still_open = lines.join(taken, "id", "left").withColumn(
            "quantity", F.col("quantity") - F.coalesce("__taken", F.lit(0))
        )
        given = allocate_fifo(
            accepted, still_open, ["item_id"], "roll_code", "id",
            [ts, "roll_code"], ["builtin_order", "id"], **options,
        )
        given.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        scans.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def change_log_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    days: Callable[[DataFrame], Sequence],
    hash: str = "row_hash",
    day: str = "fk_date",
    compare: str = "latest",
) -> StreamingQuery:
    """Append daily snapshots that arrive as files to the change log. ``days`` names the days of a
    batch; they are handled in order, each against the log before it."""
    spark = rows.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        for value in sorted(days(batch)):
            snapshot = batch.filter(F.col(day) == F.lit(value).cast("date"))
            append_day(spark, path, snapshot, key, value, hash, day, compare)

    return (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def sessions(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    counts: dict[str, Column],
    delay: str = "1 hour",
) -> DataFrame:
    """First and last time and event counts per session key; works on streams and on tables."""
    rows = events.withWatermark(ts, delay) if events.isStreaming else events
    return rows.groupBy(*keys).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("event_count"),
        *[F.count_if(c).alias(n) for n, c in counts.items()],
    )


def session_windows(
    events: DataFrame, user: str, ts: str, gap: str = "30 minutes", delay: str = "1 hour"
) -> DataFrame:
    """Sessions of a user where no session id exists: a pause longer than the gap starts a new
    one. On a stream the state is kept for the watermark delay."""
    rows = events.withWatermark(ts, delay) if events.isStreaming else events
    return (
        rows.groupBy(user, F.session_window(ts, gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(user, F.col("w.start").alias("first_ts"), F.col("w.end").alias("end_ts"), "event_count")
    )


def session_stream(summary: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the sessions each micro-batch changed; a later batch replaces an earlier row of the
    same session when it is read with ``newest_sessions``."""

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        summary.writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_sessions(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in written.columns if c not in (*keys, "batch")]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select(*keys, "v.*")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Batches written so far; an empty frame before the first one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
