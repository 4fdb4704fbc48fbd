from datetime import datetime as T
from decimal import Decimal as Dec

from conftest import rows, table
from pyspark.sql import functions as F

from tallyworks import streaming

SCAN = "roll_code string, item_id bigint, quantity decimal(18,2), ts timestamp"


def write(spark, path, schema, *data):
    spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(path)


def test_scans_arrive_in_two_runs(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    lines = table(spark, "id bigint, item_id bigint, quantity decimal(18,2), builtin_order int", (1, 7, Dec(5), 1), (2, 7, Dec(10), 2))
    write(spark, source, SCAN, ("a", 7, Dec(4), T(2025, 1, 1, 8)), ("a", 7, Dec(4), T(2025, 1, 1, 9)))

    def run():
        stream = spark.readStream.schema(SCAN).parquet(source)
        streaming.scan_stream(stream, lambda: lines, out, check).awaitTermination()
        return sorted((r.roll_code, r.id, int(r.allocated)) for r in spark.read.parquet(out).collect())

    assert run() == [("a", 1, 4)]
    # the roll comes again within the delay, and a new one finds the rest of the demand
    write(spark, source, SCAN, ("a", 7, Dec(4), T(2025, 1, 1, 10)), ("b", 7, Dec(3), T(2025, 1, 1, 11)))
    assert run() == [("a", 1, 4), ("b", 1, 1), ("b", 2, 2)]
    assert run() == [("a", 1, 4), ("b", 1, 1), ("b", 2, 2)]


def test_change_log_stream(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id int, row_hash string, fk_date date"
    day = lambda n: T(2025, 1, n).date()

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        days = lambda batch: [r.fk_date for r in batch.select("fk_date").distinct().collect()]
        streaming.change_log_stream(stream, out, check, ["id"], days).awaitTermination()
        return sorted((r.id, r.row_hash, r.fk_date.day) for r in spark.read.parquet(out).collect())

    write(spark, source, schema, (1, "A", day(1)), (2, "B", day(1)), (1, "A", day(2)), (2, "C", day(2)))
    assert run() == [(1, "A", 1), (2, "B", 1), (2, "C", 2)]
    write(spark, source, schema, (1, "Z", day(3)), (2, "B", day(3)))
    assert run() == [(1, "A", 1), (1, "Z", 3), (2, "B", 1), (2, "B", 3), (2, "C", 2)]


def test_session_stream_updates_a_session(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "s string, kind string, ts timestamp"

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        summary = streaming.sessions(stream, ["s"], "ts", {"views": F.col("kind") == "view"})
        streaming.session_stream(summary, out, check).awaitTermination()
        got = streaming.newest_sessions(spark.read.parquet(out), ["s"])
        return sorted((r.s, r.event_count, r.views, r.last_ts) for r in got.collect())

    write(spark, source, schema, ("x", "view", T(2025, 1, 1, 8)), ("x", "click", T(2025, 1, 1, 8, 10)), ("y", "view", T(2025, 1, 1, 8)))
    assert run() == [("x", 2, 1, T(2025, 1, 1, 8, 10)), ("y", 1, 1, T(2025, 1, 1, 8))]
    write(spark, source, schema, ("x", "view", T(2025, 1, 1, 8, 20)))
    assert run() == [("x", 3, 2, T(2025, 1, 1, 8, 20)), ("y", 1, 1, T(2025, 1, 1, 8))]


def test_session_windows(spark):
    df = table(spark, "u int, ts timestamp", (1, T(2025, 1, 1, 8)), (1, T(2025, 1, 1, 8, 20)), (1, T(2025, 1, 1, 9)), (2, T(2025, 1, 1, 8)))
    got = streaming.session_windows(df, "u", "ts")
    assert sorted((r.u, r.first_ts, r.event_count) for r in got.collect()) == [(1, T(2025, 1, 1, 8), 2), (1, T(2025, 1, 1, 9), 1), (2, T(2025, 1, 1, 8), 1)]


def test_rolls_are_refused_for_ever_and_late_scans_count(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    lines = table(spark, "id bigint, item_id bigint, quantity decimal(18,2), builtin_order int", (1, 7, Dec(50), 1))

    def run():
        stream = spark.readStream.schema(SCAN).parquet(source)
        streaming.scan_stream(stream, lambda: lines, out, check).awaitTermination()

    write(spark, source, SCAN, ("A", 7, Dec(4), T(2025, 1, 1)))
    run()
    write(spark, source, SCAN, ("B", 7, Dec(4), T(2025, 1, 6)), ("A", 7, Dec(4), T(2025, 1, 6)))
    run()
    write(spark, source, SCAN, ("L", 7, Dec(4), T(2025, 1, 2)), (None, 7, Dec(4), T(2025, 1, 2)))
    run()
    assert sorted(r.roll_code for r in spark.read.parquet(out).collect()) == ["A", "B", "L"]
    refused = sorted((r.reason, r.roll_code) for r in spark.read.parquet(f"{out}-refused").collect())
    assert refused == [("already scanned", "A"), ("no roll code", None)]
