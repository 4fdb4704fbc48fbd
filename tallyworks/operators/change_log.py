"""Append-only history: only rows that changed since the last entry are written."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import fingerprint
from tallyworks.sources.sinks import replace_partition


def with_fingerprint(
    df: DataFrame, columns: Sequence[str], name: str = "row_hash", null_tag: str = "~"
) -> DataFrame:
    return df.withColumn(name, fingerprint([F.col(c) for c in columns], null_tag))


def change_log_append(
    log: DataFrame,
    snapshot: DataFrame,
    key: Sequence[str],
    hash: str = "row_hash",
    day: str = "fk_date",
    as_of=None,
    compare: str = "latest",
) -> DataFrame:
    """Snapshot rows that are new or differ from the log before the day. ``latest`` compares with
    the newest entry of the key; ``any`` with all earlier entries, so a return to an old state
    is not seen as a change."""
    key = list(key)
    before = log if as_of is None else log.filter(F.col(day) < F.lit(as_of).cast("date"))
    if compare == "any":
        return _not_in(snapshot, before.select(*key, hash).distinct(), [*key, hash])
    if compare != "latest":
        raise ValueError(f"unknown comparison {compare}")
    same = latest_state(before, key, hash, day).select(*key, hash)
    return _not_in(snapshot, same, [*key, hash])


def _not_in(rows: DataFrame, others: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without an equal row, where NULL equals NULL: a key with a NULL part is a key too."""
    equal = [F.col(f"r.`{c}`").eqNullSafe(F.col(f"o.`{c}`")) for c in columns]
    return rows.alias("r").join(others.alias("o"), reduce(Column.__and__, equal), "left_anti")


def latest_state(log: DataFrame, key: Sequence[str], hash: str = "row_hash", day: str = "fk_date") -> DataFrame:
    """Newest fingerprint and day per key. Kept as a table beside the log, it spares a daily run
    from reading the whole history."""
    return log.groupBy(*key).agg(F.max_by(hash, day).alias(hash), F.max(day).alias(day))


def refresh_latest(
    latest: DataFrame, appended: DataFrame, key: Sequence[str], hash: str = "row_hash", day: str = "fk_date"
) -> DataFrame:
    """The latest-state table after a day's rows were appended."""
    columns = [*key, hash, day]
    both = latest.select(*columns).unionByName(appended.select(*columns))
    return latest_state(both, key, hash, day)


def append_day(
    spark: SparkSession,
    path: str,
    snapshot: DataFrame,
    key: Sequence[str],
    as_of,
    hash: str = "row_hash",
    day: str = "fk_date",
    compare: str = "latest",
) -> None:
    """Write the changed rows of a day to the log. Running the day again gives the same log: only
    partitions before the day are read and only the day's partition is written."""
    dated = snapshot.withColumn(day, F.lit(as_of).cast("date"))
    try:
        log = spark.read.schema(dated.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        replace_partition(dated, path, day, as_of)
        return
    changed = change_log_append(log, dated, key, hash, day, as_of, compare)
    replace_partition(changed, path, day, as_of)


def append_day_to_latest(
    spark: SparkSession,
    path: str,
    latest_path: str,
    snapshot: DataFrame,
    key: Sequence[str],
    as_of,
    hash: str = "row_hash",
    day: str = "fk_date",
) -> None:
    """Write the changed rows of a day to the log, comparing with the newest state of every key
    only. The state after each day is a version of its own in ``latest_path``; a day that runs
    again reads the version before it and writes the same rows again. The log is not read."""
    dated = snapshot.withColumn(day, F.lit(as_of).cast("date"))
    columns = [*key, hash, day]
    before = _version_before(spark, latest_path, dated.select(*columns), as_of)
    replace_partition(_not_in(dated, before, [*key, hash]), path, day, as_of)
    written = spark.read.schema(dated.drop(day).schema).parquet(f"{path}/{day}={as_of}")
    written = written.withColumn(day, F.lit(as_of).cast("date"))
    state = refresh_latest(before, written, key, hash, day).withColumn("version", F.lit(str(as_of)))
    replace_partition(state, latest_path, "version", str(as_of))


def _version_before(spark: SparkSession, path: str, like: DataFrame, as_of) -> DataFrame:
    try:
        versions = spark.read.schema(like.withColumn("version", F.lit("")).schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)
    newest = versions.filter(F.col("version") < str(as_of)).agg(F.max("version")).first()[0]
    if newest is None:
        return like.limit(0)
    return versions.filter(F.col("version") == newest).drop("version")
