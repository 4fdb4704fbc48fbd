"""Profiling and exploration of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import half_up, rounded_ratio, without_quotes
from tallyworks.operators.ordering import ordered_scan

MILLION, BILLION = 1_000_000, 1_000_000_000


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, missing, distinct, smallest and largest value as text.

    Values are counted as (column, value) pairs, combined before the shuffle, so the number of
    columns does not multiply the aggregation buffers and a frequent value is no hot spot.
    """
    columns = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in columns
            ]
        )
    ).alias("cell")
    counted = df.select(cells).select("cell.*").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    sizes = counted.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("value").alias("distinct"),
    )
    ends = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.lit(types[c]).alias("type"),
                    F.min(f"`{c}`").cast("string").alias("smallest"),
                    F.max(f"`{c}`").cast("string").alias("largest"),
                )
                for c in columns
            ]
        ).alias("ends")
    ).select(F.explode("ends").alias("e")).select("e.*")
    return ends.join(sizes, "column", "left").select(
        "column", "type",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "missing", "distinct")],
        "smallest", "largest",
    )


#: Size of a distinct-count sketch (2^14 registers): its estimate is within 0.8 % of the count for two thirds
#: of all sets, within 2.5 % for 99.7 %. Quantile sketches are within 1.7 % of the rank for 99 %.
SKETCH_BITS = 14
DISTINCT_ERROR, RANK_ERROR = 0.025, 0.017
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def column_sketches(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per column, and per value of ``by``: rows, missing, a sketch of the distinct values and, for
    numbers, one of the quantiles. Sketches have a bounded size, are formed in the map tasks, and those
    of parts of a table, stored per part, give the profile of the whole (``merge_sketches``)."""
    columns = [f for f in df.schema.fields if f.name not in by]
    shown = []
    for field in columns:
        value, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        number = value.cast("double") if kind.split("(")[0] in _NUMBERS else F.lit(None).cast("double")
        shown.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(value.isNull()).alias("missing"),
                F.hll_sketch_agg(value.cast("string"), SKETCH_BITS).alias("distinct_sketch"),
                F.kll_sketch_agg_double(number).alias("quantile_sketch"),
            )
        )
    cells = df.groupBy(*by).agg(F.array(*shown).alias("cells"))
    return cells.select(*by, F.explode("cells").alias("cell")).select(*by, "cell.*")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts to those of their union."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def sketch_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """rows and missing, exact, and distinct_about and quantiles_about with the errors named above;
    quantiles are NULL for columns without numbers. ``profile`` gives exact distinct counts."""
    held = F.kll_sketch_get_n_double("quantile_sketch") > 0
    points = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q))) for q in quantiles])
    return sketches.select(
        *[c for c in sketches.columns if not c.endswith("_sketch")],
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_about"),
        F.when(held, points).alias("quantiles_about"),
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float], **options) -> DataFrame:
    """column and quantiles: exact, linear between neighbours as ``percentile`` has them, NULL without
    values. Distinct values are counted and numbered in ranges, so no task holds a whole column."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]))
    counted = df.select(cells).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = ordered_scan(counted, ["value"], ["column"], running={"upto": "n"}, **options)
    totals = df.agg(F.array(*[F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`").cast("double")).alias("total")) for c in columns]).alias("all"))
    totals = totals.select(F.inline("all"))
    numbered = upto.join(F.broadcast(totals), "column")
    places, found = [F.lit(float(q)) * (F.col("total") - 1) for q in quantiles], []
    for i, place in enumerate(places):
        for name, rank in ((f"__low{i}", F.floor(place)), (f"__high{i}", F.ceil(place))):
            found.append(F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("value"))).alias(name))
    ends = numbered.groupBy("column").agg(F.max("total").alias("total"), *found)
    values = []
    for i, place in enumerate(places):
        low, high = F.col(f"__low{i}"), F.col(f"__high{i}")
        values.append(F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high))
    known = ends.select("column", F.array(*values).alias("quantiles"))
    return totals.select("column").join(known, "column", "left")


def duplicate_rows(df: DataFrame, name: str = "duplicates") -> DataFrame:
    """Number of rows that repeat an earlier row."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias(name)
    )


def clean(
    df: DataFrame,
    fills: Mapping[str, object] | None = None,
    unquote: Sequence[str] = (),
    labels: Mapping[str, tuple[str, Mapping[str, str], str]] | None = None,
) -> DataFrame:
    """Fill missing values, take quote marks out, and label codes. ``labels`` maps the new column
    to (code column, {code: label}, default)."""
    out = df.fillna(dict(fills)) if fills else df
    if unquote:
        out = out.withColumns({c: without_quotes(F.col(c)) for c in unquote})
    for name, (column, names, default) in (labels or {}).items():
        label: Column | None = None
        for code, text in names.items():
            hit = F.col(column) == code
            label = F.when(hit, text) if label is None else label.when(hit, text)
        out = out.withColumn(name, label.otherwise(default))
    return out


def count_share(df: DataFrame, key: str, digits: int = 2) -> DataFrame:
    """Rows and percent of all rows per category, the largest marked. Rows without a category
    count in the whole and form no group."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = groups.agg(F.sum("rows")).scalar()
    counted = groups.filter(F.col(key).isNotNull())
    most = counted.agg(F.max("rows")).scalar()
    return counted.select(
        key,
        "rows",
        rounded_ratio(F.col("rows") * 100, total, digits).alias("percent"),
        (F.col("rows") == most).alias("is_largest"),
    )


def top_k_by(
    df: DataFrame, key: str, value: Column, k: int = 10, scale: int = 1, digits: int = 2, name: str = "total"
) -> DataFrame:
    """The ``k`` categories with the largest aggregate, in units of ``scale``."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key).agg(value.alias("__v"))
    top = grouped.orderBy(F.desc("__v"), F.asc(key)).limit(k)
    return top.select(
        key, F.col("__v").alias(name), half_up(F.col("__v") / scale, digits).alias(f"{name}_scaled")
    )


def monthly_trend(df: DataFrame, ts: str, amount: str, scale: int = BILLION) -> DataFrame:
    """Rows and amount per month in calendar order, with the month's name."""
    month = F.trunc(F.to_date(ts), "month")
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(month.alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(amount).alias("amount"))
        .select(
            "month",
            F.date_format("month", "MMMM").alias("month_name"),
            "rows",
            "amount",
            (F.col("amount") / scale).alias("amount_scaled"),
        )
        .orderBy("month")
    )


def mean_by(df: DataFrame, keys: Sequence[str], value: str, scale: int = MILLION) -> DataFrame:
    """Mean per group, also in units of ``scale``."""
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.avg(value).alias("mean")).withColumn(
        "mean_scaled", F.col("mean") / scale
    )


def pivot_sum(
    df: DataFrame, index: str, columns: str, value: str, scale: int = BILLION, names: Sequence | None = None
) -> DataFrame:
    """Two-way table of sums in units of ``scale``. Without ``names`` the column values are read
    from the data; Spark refuses more than ``spark.sql.pivotMaxValues`` of them."""
    known = df.filter(F.col(index).isNotNull() & F.col(columns).isNotNull())
    # Sum per cell first: the pivot then works on one row per cell.
    cells = known.groupBy(index, columns).agg((F.sum(value) / scale).alias("__v"))
    grouped = cells.groupBy(index)
    wide = grouped.pivot(columns, list(names)) if names else grouped.pivot(columns)
    return wide.agg(F.sum("__v"))
