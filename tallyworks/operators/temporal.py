"""Dimension versions, newest values, code maps and milestones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import broadcast_if_small
from tallyworks.operators.ordering import ordered_concat, ordered_scan
from tallyworks.operators.ranking import first_rows

OPEN_DATE = "3000-01-01"


def is_open(date: str) -> Column:
    """The far date stands for "not yet"."""
    return F.to_date(date) == F.lit(OPEN_DATE).cast("date")


def valid_on(dim: DataFrame, as_of, eff: str = "eff_date", end: str = "end_date") -> DataFrame:
    """Versions that hold on a date, without the validity columns."""
    on = F.lit(as_of).cast("date")
    return dim.filter((F.col(eff) <= on) & (F.col(end) >= on)).drop(eff, end)


def asof_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    as_of,
    eff: str = "eff_date",
    end: str = "end_date",
    how: str = "left",
) -> DataFrame:
    """Attach the dimension version valid on one date. Versions are filtered before the join."""
    return fact.join(valid_on(dim, as_of, eff, end), list(on), how)


def asof_row_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    date: str,
    eff: str = "eff_date",
    end: str = "end_date",
    how: str = "left",
    **options,
) -> DataFrame:
    """Attach the version valid on each row's own date. Versions of a key must not overlap.

    Facts and versions are put in one order per key and the last version seen is carried down,
    so the work is linear, also for a key with many facts and many versions.
    """
    on = list(on)
    payload = [c for c in dim.columns if c not in (*on, eff, end)]
    known = dim
    for k in on:
        known = known.filter(F.col(k).isNotNull())
    version = F.struct(F.col(end).cast("date").alias("__end"), *payload)
    versions = known.select(
        *on, F.col(eff).cast("date").alias("__at"), F.lit(0).alias("__kind"), F.lit(0).cast("bigint").alias("__tie"), version.alias("__v")
    )
    # The tie lets many facts of one key and day be cut; they see the same version in any order.
    facts = fact.select(
        *on, F.col(date).cast("date").alias("__at"), F.lit(1).alias("__kind"), F.xxhash64(*fact.columns).alias("__tie"),
        F.struct(*fact.columns).alias("__f"),
    )
    scanned = ordered_scan(
        versions.unionByName(facts, allowMissingColumns=True),
        ["__at", "__kind", "__tie"],
        on,
        fill_down={"__seen": "__v"},
        **options,
    ).filter(F.col("__kind") == 1)
    holds = F.col("__at") <= F.col("__seen.__end")
    out = scanned.select(
        "__f.*",
        *[F.when(holds, F.col(f"__seen.`{c}`")).alias(c) for c in payload],
        holds.alias("__holds"),
    )
    if how == "inner":
        out = out.filter(F.col("__holds"))
    return out.drop("__holds")


def map_codes(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, Sequence] | DataFrame,
    default: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Label of a code. The mapping is ``{label: codes}``, or a frame (code, label) for long
    lists. Codes are compared as text."""
    name = name or column
    if isinstance(mapping, DataFrame):
        code, label = mapping.columns[:2]
        pairs = mapping.select(F.col(code).cast("string").alias("__code"), F.col(label).alias("__label"))
        known = broadcast_if_small(pairs)
        joined = df.join(known, F.col(column).cast("string") == F.col("__code"), "left")
        return joined.withColumn(name, F.coalesce(F.col("__label"), F.lit(default))).drop(
            "__code", "__label"
        )
    text, out = F.col(column).cast("string"), None
    for label, codes in mapping.items():
        hit = text.isin(*[str(c) for c in codes])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return df.withColumn(name, out.otherwise(F.lit(default)))


def estimate_history(
    estimates: DataFrame,
    approvals: DataFrame,
    keys: Sequence[str],
    code: str,
    amount: str,
    requested_at: str,
    approved_at: str,
    as_of,
    **options,
) -> DataFrame:
    """Newest estimate of every claim: requests up to the date, and the approved amount once
    there is one. Amounts of one request are joined in code order; an approval wins over a
    request of the same day."""
    keys = list(keys)
    at = F.lit(as_of).cast("date")
    requests = estimates.filter(
        F.col(requested_at).isNotNull() & (F.to_date(requested_at) <= at)
    ).withColumn("__amount", F.round(amount, 0).cast("bigint"))
    asked = ordered_concat(
        requests, [*keys, requested_at], {"estimated_amount": "__amount"}, [code, "__amount"], **options
    ).select(
        *keys,
        F.to_date(requested_at).alias("change_date"),
        F.lit(0).alias("__source"),
        F.col(requested_at).cast("timestamp_ntz").alias("__at"),
        "estimated_amount",
    )
    settled = approvals.filter(~is_open(approved_at)).withColumn(
        "__amount", F.round(amount, 0).cast("bigint")
    )
    approved = ordered_concat(
        settled, [*keys, approved_at], {"estimated_amount": "__amount"}, [code, "__amount"], **options
    ).select(
        *keys,
        F.to_date(approved_at).alias("change_date"),
        F.lit(1).alias("__source"),
        F.col(approved_at).cast("timestamp_ntz").alias("__at"),
        "estimated_amount",
    )
    newest = first_rows(
        asked.unionByName(approved), keys, ["-change_date", "-__source", "-__at"]
    )
    return newest.select(*keys, "change_date", "estimated_amount")


def patch_from(
    df: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    newest_by: str,
    mode: str = "replace",
    when: Column | None = None,
) -> DataFrame:
    """Set columns from another frame. ``replace`` takes the source value, also NULL when there
    is no source row; ``fill`` keeps existing values. The source is first made unique by key."""
    if mode not in ("replace", "fill"):
        raise ValueError(f"unknown mode {mode}")
    on = list(on)
    picked = source.groupBy(*on).agg(F.max_by(F.struct(*columns), newest_by).alias("__src"))
    joined = df.join(picked, on, "left")
    changes = {}
    for c in columns:
        new = F.col(f"__src.`{c}`")
        if c not in df.columns:
            changes[c] = new if when is None else F.when(when, new)
            continue
        value = F.coalesce(F.col(c), new) if mode == "fill" else new
        changes[c] = value if when is None else F.when(when, value).otherwise(F.col(c))
    return joined.withColumns(changes).drop("__src")


def milestones(
    log: DataFrame, keys: Sequence[str], ts: str, spec: Mapping[str, Column], as_of=None
) -> DataFrame:
    """Newest time of each named action per key, up to the end of a day."""
    rows = log if as_of is None else log.filter(F.to_date(ts) <= F.lit(as_of).cast("date"))
    return rows.groupBy(*keys).agg(
        *[F.max(F.when(condition, F.col(ts))).alias(name) for name, condition in spec.items()]
    )


def payment_rollup(
    payments: DataFrame,
    keys: Sequence[str],
    amount: str,
    date: str,
    as_of,
    names: Sequence[str] = ("paid_amount", "paid_date"),
    eff: str = "eff_date",
    end: str = "end_date",
) -> DataFrame:
    """Amount paid and date of the last payment per key, over the rows valid on a date."""
    return (
        valid_on(payments, as_of, eff, end)
        .groupBy(*keys)
        .agg(F.sum(amount).alias(names[0]), F.max(F.to_date(date)).alias(names[1]))
    )
