"""Writers."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks.operators.ordering import ordered_concat, shuffles_dropped


#: Folder of a partitioned table that holds its schema; readers of data pass over it.
SCHEMA_FOLDER = "_schema"


def partition_folder(df: DataFrame, column: str, value) -> str:
    """The folder of a partition as Spark itself names it: characters that paths cannot have are
    escaped, and NULL has a name of its own."""
    spark = df.sparkSession
    text = spark.range(1).select(F.lit(value).cast(df.schema[column].dataType).cast("string")).first()[0]
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, text)


def replace_partition(df: DataFrame, path: str, column: str, value) -> None:
    """Write one partition so that a second run gives the same table: the old rows of that value
    go away, also when the new run has none. Other partitions are not touched. NULL is a value."""
    part = df.filter(F.col(column).eqNullSafe(F.lit(value))).drop(column)
    folder = f"{path}/{partition_folder(df, column, value)}"
    with shuffles_dropped(df.sparkSession):
        part.write.mode("overwrite").parquet(folder)


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence) -> None:
    """Write several partitions in one job, each as ``replace_partition`` does, and the schema of the
    table beside them, so that values come back in their own type. Rows of other values are left out."""
    spark, texts = df.sparkSession, [v for v in values if v is not None]
    wanted = F.col(column).isin(*texts) if texts else F.lit(False)
    if len(texts) < len(values):
        wanted = wanted | F.col(column).isNull()
    part = df.filter(wanted)
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    # Values without rows in this run still have what an earlier one wrote.
    filled = {r[0] for r in part.select(column).distinct().collect()}
    for value in values:
        if value not in filled:
            replace_partition(df.limit(0), path, column, value)
    schema = spark.range(1).select(F.lit(df.schema.json()).alias("value"))
    schema.write.mode("overwrite").text(f"{path}/{SCHEMA_FOLDER}")


def partitioned_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``replace_partitions`` with the schema that was written."""
    text = spark.read.text(f"{path}/{SCHEMA_FOLDER}").first()[0]
    return spark.read.schema(StructType.fromJson(json.loads(text))).parquet(path)


def committed_versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(version, batch) of every batch that ``commit_tables`` has finished, in order."""
    try:
        rows = spark.read.schema("batch string, version bigint").parquet(f"{root}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((r.version, r.batch) for r in rows)


def committed_tables(spark: SparkSession, root: str, names: Sequence[str], batch: str | None = None) -> dict[str, DataFrame]:
    """The tables as the batch left them, or as the last one did. None before the first batch."""
    versions = [v for v, b in committed_versions(spark, root) if batch in (None, b)]
    return {n: spark.read.parquet(f"{root}/{n}/{versions[-1]}") for n in names} if versions else {}


def commit_tables(spark: SparkSession, root: str, batch: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Write several tables as one step, and read them back as the batch left them.

    Each version is written to folders of its own; readers find it by the manifest, whose single file
    is added last. A run that ends before that leaves the version before it in place, and the next
    run writes its folders anew. A batch that has been committed is not written again, so running it
    twice changes nothing. One job at a time writes to a root."""
    known = committed_versions(spark, root)
    if batch not in {b for _, b in known}:
        version = known[-1][0] + 1 if known else 1
        for name, df in tables.items():
            with shuffles_dropped(spark):
                df.write.mode("overwrite").parquet(f"{root}/{name}/{version}")
        entry = spark.range(1).select(F.lit(batch).alias("batch"))
        entry.write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    return committed_tables(spark, root, list(tables), batch)


def drop_old_versions(spark: SparkSession, root: str, names: Sequence[str], keep: int = 2) -> None:
    """Delete the tables of all but the newest versions, and what was written without a commit. The
    manifest keeps its entries, so old batches are still known as done."""
    live = {str(v) for v, _ in committed_versions(spark, root)[-keep:]}
    for name in names:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(folder) if files.exists(folder) else []:
            if status.getPath().getName() not in live:
                files.delete(status.getPath(), True)


def save_intermediate(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later steps read, and read it back, so that a lost executor
    does not cause all earlier steps to run again. It goes below ``spark.checkpoint.dir``; the shuffle
    files behind it are dropped then."""
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows_to_xml(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str],
    row_tag: str = "row",
    root_tag: str = "root",
    name: str = "xml",
) -> DataFrame:
    """One XML text per key: a root element with one attribute element per row, in order."""
    element = F.to_xml(
        F.struct(*[F.col(c).cast("string").alias(f"_{c}") for c in columns]),
        {"rowTag": row_tag},
    )
    rows = df.withColumn("__xml", element).select(*keys, *[o.lstrip("-") for o in order], "__xml")
    joined = ordered_concat(rows, keys, {name: "__xml"}, order, "")
    return joined.withColumn(
        name, F.concat(F.lit(f"<{root_tag}>"), F.col(name), F.lit(f"</{root_tag}>"))
    )


_OWN_FOLDERS: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, which all executors must share. Only a local run may
    leave it unset; one folder is then made for the application."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is not None:
        return base
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="tallyworks-")
    return _OWN_FOLDERS[application]
