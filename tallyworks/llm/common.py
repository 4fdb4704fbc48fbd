"""Helpers that several operators share: shared scratch tables, neutral column names, words."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDERS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session's ``spark.checkpoint.dir``. Only a local master, as in
    tests, may leave it unset; the application then gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is not None:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _OWN_FOLDERS:
        _OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _OWN_FOLDERS[context.applicationId]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a result that later steps read more than once and read it back. The lineage ends
    there: a lost executor costs the tasks it ran, not the steps before."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


def drop_saved(df: DataFrame) -> None:
    """Delete a table of ``saved`` that no plan reads any more."""
    spark, path = df.sparkSession, getattr(df, "_scratch_path", None)
    if path:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty), so that other columns can have any name."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores behind as no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while taken & {n.lower() for n in names}:
        names = tuple(f"{n}_" for n in names)
    return list(names)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; other letters stay."""
    return F.translate(
        text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the folds of the held-out rows."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
