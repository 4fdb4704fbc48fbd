"""Ordered work that does not end up in one task.

A window without partition columns, or with one very large partition, sorts its rows in a
single task. The operators here cut the order into ranges instead:

1. a uniform sample of the order columns, bounded by the number of ranges, gives split points;
2. every row finds its range with a binary search over the split points, written as plain
   column expressions, so the range of a row never changes when a task is run again;
3. windows run inside (range, key);
4. what a range needs from the ranges before or after it (a count, a sum, the neighbour row)
   comes from one summary row per (range, key). Only keys that contain a split point can lie
   in two ranges, so at most two summary rows per split point are needed, and that table is
   broadcast.

The sample decides only where the cuts are. Results are exact for any cuts. With keys, only those
are cut that hold more than about half a range of rows, into pieces of half a range; all others stay
whole, with one window per key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 64
#: Estimated bytes of rows in a range. More ranges than shuffle partitions are taken for larger frames.
RANGE_BYTES = 128 << 20
#: Split points are a constant of the plan, so there are at most so many ranges.
MAX_RANGES = 1 << 15
#: Split points that are looked at for each range, so that keys of a part of a range are seen.
FINE = 4
#: A first sample of between a half and so many times the wanted size is good enough.
GENEROUS = 16
RANGE = "__range"
#: Bytes of input files for one task of a shuffle that is dealt by ``spread``.
TASK_BYTES = 4 << 20
#: Sizes from here on mean that the optimizer does not know an input's size.
UNKNOWN_BYTES = 1 << 60
#: Setting of Spark by which the shuffle files of a query go when it ends; else they stay until the driver's memory is collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Frames made and written in the block leave no shuffle files behind. For results that are read
    once or from where they are written, so that a query of several steps holds the files of one step."""
    if not spark.conf.isModifiable(DROP_SHUFFLES):
        yield
        return
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def order_terms(order: Sequence[str]) -> list[tuple[str, bool]]:
    """``["day", "-amount"]`` to ``[("day", False), ("amount", True)]``; a minus means descending."""
    return [(o[1:], True) if o.startswith("-") else (o, False) for o in order]


def order_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order_terms(order)]


def _ranges_wanted(df: DataFrame, ranges: int | None) -> int:
    if ranges is not None:
        return max(1, ranges)
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class _Field:
    """One ascending part of the order, with the SQL type it is compared in. ``descending`` is set
    only where no ascending form exists."""

    value: Column
    kind: str
    descending: bool = False


def _fields(df: DataFrame, order: Sequence[str]) -> list[_Field]:
    """The order as parts that all ascend, NULLs first, so that rows compare as structs.

    A timestamp with a zone becomes microseconds: its text repeats an hour when clocks go back.
    A descending number or date is turned round, behind a flag that puts its NULLs last.
    Descending texts and zone-less timestamps stay descending.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out: list[_Field] = []
    for name, desc in order_terms(order):
        value, kind = F.col(name), types[name]
        if kind == "timestamp":
            value, kind = F.unix_micros(value), "bigint"
        elif kind == "date" and desc:
            value, kind = F.unix_date(value), "int"
        if not desc:
            out.append(_Field(value, kind))
            continue
        missing = _Field(value.isNull(), "boolean")
        if kind in ("tinyint", "smallint", "int", "bigint"):
            out += [missing, _Field(F.bitwise_not(value), kind)]
        elif kind.startswith("decimal"):
            out += [missing, _Field(-value, kind)]
        elif kind in ("float", "double"):
            number = _Field(~F.isnan(value), "boolean")
            out += [missing, number, _Field(-value, kind)]
        else:
            out.append(_Field(value, kind, descending=True))
    return out


def _row_bytes(df: DataFrame) -> int:
    """Bytes of a row by its types, as the optimizer counts them."""
    return 8 + sum(f.jsonValue()["type"] == "string" and 20 or 8 for f in df.schema.fields)


def _input_bytes(df: DataFrame) -> int:
    """Sizes of the inputs of the frame, which the optimizer knows without a job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _rows_guessed(df: DataFrame) -> float:
    """Rows of the frame by the sizes of its inputs."""
    return max(1.0, _input_bytes(df) / _row_bytes(df))


def spread(df: DataFrame, keys: Sequence[str], always: bool = False) -> DataFrame:
    """The frame dealt by keys over tasks whose number grows with the inputs, so that a task's share of
    rows and memory does not. A frame of unknown size, or one that the shuffle partitions of the session
    are enough for, is left as it is, or with ``always`` dealt over those."""
    size = _input_bytes(df)
    tasks = min(MAX_RANGES, size // TASK_BYTES) if size < UNKNOWN_BYTES else 0
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(tasks, *keys)
    return df.repartition(*keys) if always else df


def _sample_cuts(df: DataFrame, fields: Sequence[_Field], tiles: int, wanted: int, fraction: float):
    """(total rows, sampled rows, first rows of all tiles but the first) from one job, which counts the
    frame and samples it at once. Every task keeps a bounded sample, also when the fraction is too high:
    the chance of a row falls with its place in its partition from ``wanted`` rows on."""
    names = [f"__k{i}" for i in range(len(fields))]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    row = F.struct(*[f.value.alias(n) for f, n in zip(fields, names)])
    taken = F.rand(20240131) < F.least(F.lit(fraction), F.lit(float(wanted)) / place)
    drawn = df.select(F.when(taken, row).alias("__row")).agg(
        F.count(F.lit(1)).alias("__total"), F.collect_list("__row").alias("__rows")
    )
    by_order = W.orderBy(*[F.col(n).desc() if f.descending else F.col(n).asc() for f, n in zip(fields, names)])
    tiled = (
        drawn.select("__total", F.size("__rows").alias("__drawn"), F.explode_outer("__rows").alias("__row"))
        .select("__total", "__drawn", "__row.*")
        .withColumn("__tile", F.ntile(tiles).over(by_order))
        .withColumn("__before", F.lag("__tile").over(by_order))
    )
    first = F.col("__before").isNull() | (F.col("__before") != F.col("__tile"))
    with shuffles_dropped(df.sparkSession):
        starts = tiled.filter(first).select("__total", "__drawn", "__tile", *[F.col(n).cast("string").alias(n) for n in names])
        rows = sorted(starts.collect(), key=lambda r: r["__tile"])
    return rows[0]["__total"], rows[0]["__drawn"], [tuple(r)[3:] for r in rows[1:]]


def split_points(
    df: DataFrame, order: Sequence[str], ranges: int | None, per_range: int = SAMPLE_PER_RANGE, keys: int = 0
) -> list[tuple[str | None, ...]]:
    """Sorted split points as text, one less than there are ranges. With ``keys``, the number of leading
    columns that are keys, only those inside keys that hold more than about half a range, half a range
    apart. Empty when the whole frame is smaller than the sample: one range is then small enough.

    The first sample takes a fraction guessed from the sizes of the inputs and counts the frame at the
    same time; a second one follows only if that was far off or the frame needs more ranges."""
    fields = _fields(df, order)
    fine = max(1, min(FINE, per_range))
    grows, ranges, fraction = ranges is None, min(MAX_RANGES, _ranges_wanted(df, ranges)), None
    for last in (False, True):
        wanted = ranges * per_range
        fraction = fraction or min(1.0, 2 * wanted / _rows_guessed(df))
        total, drawn, cuts = _sample_cuts(df, fields, ranges * fine, wanted, fraction)
        if total < wanted:
            return []
        needed = min(MAX_RANGES, -(-total * _row_bytes(df) // RANGE_BYTES)) if grows else ranges
        enough = drawn >= wanted / 2 and total * fraction <= GENEROUS * wanted
        if last or (enough and needed <= ranges):
            break
        ranges = max(ranges, needed)
        fraction = min(1.0, ranges * per_range / total)
    if not keys:
        return cuts[fine - 1 :: fine]
    found, step = [], max(1, fine // 2)
    for _, group in groupby(cuts, lambda cut: cut[:keys]):
        inside = list(group)
        if len(inside) > step:
            found += inside[::step]
    return found


def _typed_array(values: Sequence[str | None], kind: str) -> Column:
    """Array constant from text. Written as one JSON text, it is a single literal for the planner
    also with thousands of split points."""
    parsed = F.from_json(F.lit(json.dumps(list(values))), "array<string>")
    return parsed.cast(f"array<{kind}>")


def _comes_after(value: Column, bound: Column, desc: bool) -> Column:
    if desc:
        after = (value < bound) | (value.isNull() & bound.isNotNull())
    else:
        after = (value > bound) | (value.isNotNull() & bound.isNull())
    return F.coalesce(after, F.lit(False))


def with_range(
    df: DataFrame, order: Sequence[str], cuts: Sequence[tuple[str | None, ...]], name: str = RANGE
) -> DataFrame:
    """Add the number of split points that are not after the row, by binary search.

    The halving steps are one expression and not one projection each: the optimizer would copy
    every step into the next."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    fields = _fields(df, order)
    bounds = [_typed_array([cut[i] for cut in cuts], f.kind) for i, f in enumerate(fields)]
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def advance(position: Column, step: Column) -> Column:
        probe = position + step - F.lit(1)
        # The first part of the order decides most rows; the rest is looked at only on a tie.
        reached = F.lit(True)
        for f, bound in reversed(list(zip(fields, bounds))):
            at = F.get(bound, probe)
            after = _comes_after(f.value, at, f.descending)
            reached = after | (f.value.eqNullSafe(at) & reached)
        taken = F.when((probe < F.lit(len(cuts))) & reached, step).otherwise(F.lit(0))
        return position + taken

    searched = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)
    return df.withColumn(name, searched)


def _null_safe(left: str, right: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return condition


def ordered_scan(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    *,
    number: str | None = None,
    running: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    fill_down: Mapping[str, str] | None = None,
    fill_up: Mapping[str, str] | None = None,
    ranges: int | None = None,
    per_range: int = SAMPLE_PER_RANGE,
    save: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Row number, running sums, neighbour values and last / next known values per key.

    ``order`` should be unique inside a key (add a tie column). The mappings go from the new
    column to the column it is taken from: ``running`` sums from the first row to this one,
    ``previous`` and ``following`` take the neighbour row's value, ``fill_down`` the last
    non-null value up to this row, ``fill_up`` the first non-null value from this row on.

    The frame is read three times: for the sample, for the summary and for the result. When it
    comes out of a join or an aggregation, pass ``save`` (for example
    ``sources.save_intermediate``) to compute it once.
    """
    if save is not None:
        df = save(df, "scan-input")
    running, previous, following = running or {}, previous or {}, following or {}
    fill_down, fill_up = fill_down or {}, fill_up or {}
    keys = list(keys)
    full_order = keys + list(order)
    cuts = list(dict.fromkeys(split_points(df, full_order, ranges, per_range, len(keys))))
    # Ranges are dealt explicitly: over a union of frames that lie by the same keys, Spark 4.1 takes its
    # parts for clustered by (range, key) and leaves the exchange out, and rows of a range stay apart.
    # Whole keys are dealt too where the frame is large.
    if cuts:
        dealt = ranged = spread(with_range(df, full_order, cuts), [RANGE, *keys], always=True)
    else:
        ranged = with_range(df, full_order, cuts)
        dealt = spread(ranged, keys) if keys else ranged

    by_order = order_columns(order)
    window = W.partitionBy(RANGE, *keys).orderBy(*by_order)
    so_far = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Looking ahead is looking back in the reverse order: a frame that ends at the last row would
    # be evaluated again for every row.
    backwards = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    from_here = (
        W.partitionBy(RANGE, *keys)
        .orderBy(*order_columns(backwards))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    need_first = bool(previous)
    need_last = bool(following)
    carried = bool(cuts)

    local: dict[str, Column] = {}
    if number or (carried and need_first):
        local[number or "__n"] = F.row_number().over(window).cast("bigint")
    for out, source in running.items():
        local[out] = F.sum(source).over(so_far)
    for out, source in previous.items():
        local[out] = F.lag(source).over(window)
    for out, source in following.items():
        local[out] = F.lead(source).over(window)
    for out, source in fill_down.items():
        local[out] = F.last(source, ignorenulls=True).over(so_far)
    for out, source in fill_up.items():
        local[out] = F.last(source, ignorenulls=True).over(from_here)
    if carried and need_last:
        local["__ahead"] = F.lead(F.lit(1)).over(window)
    # Window columns over the same window spec are computed by one Window operator.
    scanned = dealt.select("*", *[c.alias(n) for n, c in local.items()])
    if not carried:
        return scanned.drop(RANGE)

    carry = _carry_table(
        ranged, full_order, order, keys, cuts, number, running, previous, following, fill_down, fill_up
    )
    joined = scanned.alias("s").join(
        F.broadcast(carry.alias("c")), _null_safe("s", "c", [RANGE, *keys]), "left"
    )
    first_here = F.col(f"s.{number or '__n'}") == 1 if need_first else None
    columns = []
    made = set(local)
    for name in scanned.columns:
        if name in made:
            continue
        if name != RANGE:
            columns.append(F.col(f"s.{name}"))
    if number:
        columns.append(
            (F.col(f"s.{number}") + F.coalesce(F.col("c.__count"), F.lit(0))).alias(number)
        )
    for i, out in enumerate(running):
        kind = scanned.schema[out].dataType
        before, here = F.col(f"c.__sum{i}"), F.col(f"s.{out}")
        total = F.coalesce(before + here, before, here)
        columns.append(total.cast(kind).alias(out))
    for i, out in enumerate(previous):
        columns.append(
            F.when(first_here, F.col(f"c.__prev{i}")).otherwise(F.col(f"s.{out}")).alias(out)
        )
    for i, out in enumerate(following):
        columns.append(
            F.when(F.col("s.__ahead").isNull(), F.col(f"c.__next{i}"))
            .otherwise(F.col(f"s.{out}"))
            .alias(out)
        )
    for i, out in enumerate(fill_down):
        columns.append(F.coalesce(F.col(f"s.{out}"), F.col(f"c.__down{i}")).alias(out))
    for i, out in enumerate(fill_up):
        columns.append(F.coalesce(F.col(f"s.{out}"), F.col(f"c.__up{i}")).alias(out))
    return joined.select(*columns)


def _key_from_text(name: str, kind: str) -> Column:
    if kind == "timestamp":
        return F.timestamp_micros(F.col(name).cast("bigint"))
    return F.col(name).cast(kind)


def _carry_table(
    ranged, full_order, order, keys, cuts, number, running, previous, following, fill_down, fill_up
) -> DataFrame:
    """One row per (range, key) for the keys that contain a split point, with what the rows of
    that range need from the other ranges."""
    spark = ranged.sparkSession
    if keys:
        types = {f.name: f.dataType.simpleString() for f in ranged.schema.fields}
        cut_keys = sorted({cut[: len(keys)] for cut in cuts}, key=str)
        text = ", ".join(f"`{k}` string" for k in keys)
        straddling = spark.createDataFrame([tuple(c) for c in cut_keys], text).select(
            *[_key_from_text(k, types[k]).alias(k) for k in keys]
        )
        rows = (
            ranged.alias("s")
            .join(F.broadcast(straddling.alias("c")), _null_safe("s", "c", keys), "left_semi")
        )
    else:
        rows = ranged

    neighbours = [(f"__prev{i}", s) for i, s in enumerate(previous.values())]
    neighbours += [(f"__next{i}", s) for i, s in enumerate(following.values())]
    known = [(f"__down{i}", s, True) for i, s in enumerate(fill_down.values())]
    known += [(f"__up{i}", s, False) for i, s in enumerate(fill_up.values())]
    if (neighbours or known) and any(desc for _, desc in order_terms(order)):
        raise ValueError("neighbour and fill columns need an ascending order")
    position = F.struct(*[F.col(c) for c in order])
    aggregates = [F.count(F.lit(1)).alias("__count")]
    aggregates += [F.sum(s).alias(f"__sum{i}") for i, s in enumerate(running.values())]
    for name, source in neighbours:
        # The value is wrapped: a NULL in the neighbour row is still that row's value.
        pick = F.max_by if name.startswith("__prev") else F.min_by
        aggregates.append(pick(F.struct(F.col(source).alias("v")), position).alias(name))
    for name, source, down in known:
        pick = F.max_by if down else F.min_by
        where = F.when(F.col(source).isNotNull(), position)
        aggregates.append(pick(F.col(source), where).alias(name))
    summary = rows.groupBy(RANGE, *keys).agg(*aggregates)

    # At most two rows per split point, so plain windows are small here.
    window = W.partitionBy(*keys).orderBy(RANGE) if keys else W.partitionBy(F.lit(0)).orderBy(RANGE)
    before = window.rowsBetween(W.unboundedPreceding, -1)
    after = window.rowsBetween(1, W.unboundedFollowing)
    carried = [F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__count")]
    for i in range(len(running)):
        carried.append(F.sum(f"__sum{i}").over(before).alias(f"__sum{i}"))
    for i in range(len(previous)):
        carried.append(F.lag(f"__prev{i}").over(window).getField("v").alias(f"__prev{i}"))
    for i in range(len(following)):
        carried.append(F.lead(f"__next{i}").over(window).getField("v").alias(f"__next{i}"))
    for i in range(len(fill_down)):
        carried.append(F.last(f"__down{i}", ignorenulls=True).over(before).alias(f"__down{i}"))
    for i in range(len(fill_up)):
        carried.append(F.first(f"__up{i}", ignorenulls=True).over(after).alias(f"__up{i}"))
    return summary.select(RANGE, *keys, *carried)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_number", **options) -> DataFrame:
    """Number all rows of the frame from 1 in the given order."""
    return ordered_scan(df, order, number=name, **options)


def running_total(
    df: DataFrame, order: Sequence[str], amount: str, name: str = "running_total", **options
) -> DataFrame:
    """Sum of ``amount`` over all rows up to this one, in the given order."""
    return ordered_scan(df, order, running={name: amount}, **options)


def dense_rank_all(
    df: DataFrame, value: str, name: str = "rank", descending: bool = True, **options
) -> DataFrame:
    """Dense rank of every row of the frame: the distinct values are numbered, then joined back."""
    ranked = number_rows(
        df.select(value).distinct(), [f"-{value}" if descending else value], name, **options
    )
    return (
        df.alias("r")
        .join(ranked.alias("d"), F.col(f"r.{value}").eqNullSafe(F.col(f"d.{value}")), "left")
        .select("r.*", F.col(f"d.{name}").alias(name))
    )


def next_ids(
    df: DataFrame,
    order: Sequence[str],
    existing: DataFrame,
    existing_id: str,
    name: str = "id",
    negative: bool = False,
    **options,
) -> DataFrame:
    """Ids that go on from the highest existing absolute id, in the given order. Negative ids
    mark rows that are not stored yet."""
    start = existing.agg(F.coalesce(F.max(F.abs(existing_id)), F.lit(0)).cast("bigint")).scalar()
    numbered = number_rows(df, order, name, **options)
    value = F.col(name) + start
    return numbered.withColumn(name, -value if negative else value)


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, str],
    order: Sequence[str],
    separator: str = ",",
    **options,
) -> DataFrame:
    """Values of a key joined to one text in the given order; NULLs are left out. Pieces are
    joined inside each range of the order first, so a large key is never sorted in one task."""
    keys = list(keys)
    full_order = keys + list(order)
    if options.get("save") is not None:
        df = options["save"](df, "concat-input")
    per_range = options.get("per_range", SAMPLE_PER_RANGE)
    cuts = list(dict.fromkeys(split_points(df, full_order, options.get("ranges"), per_range, len(keys))))
    ordering = ", ".join(f"`{c}` DESC" if desc else f"`{c}`" for c, desc in order_terms(order))
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")

    def listed(column: str, within: str, alias: str) -> Column:
        return F.expr(
            f"listagg(cast(`{column}` as string), '{quoted}') within group (order by {within})"
        ).alias(alias)

    if not cuts:
        return df.groupBy(*keys).agg(*[listed(c, ordering, out) for out, c in values.items()])
    ranged = with_range(df, full_order, cuts)
    pieces = ranged.groupBy(*keys, RANGE).agg(
        *[listed(c, ordering, out) for out, c in values.items()]
    )
    return pieces.groupBy(*keys).agg(*[listed(out, RANGE, out) for out in values])
