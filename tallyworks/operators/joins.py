"""Join sides of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 100_000
SMALL_BYTES = 32 << 20


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether a frame is measured to have at most ``max_rows`` rows and ``max_bytes`` bytes. The
    measuring stops at the bound, so it is cheap next to a shuffle."""
    width = F.lit(0)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            size = F.octet_length(column)
        elif kind.startswith(("array", "map", "struct")):
            size = F.octet_length(F.to_json(F.struct(column)))
        else:
            size = F.lit(16)
        width = width + F.coalesce(size, F.lit(0)) + 8
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Mark a frame for broadcast when it is measured to be small; a larger one is returned as it is
    and joined by a shuffle. For frames that Spark cannot size by itself because they come out of an
    aggregation or a window."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
