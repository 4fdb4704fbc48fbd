"""Profit-and-loss tables from metric definitions.

A metric definition is a row ``(stt, item_code, item_name, ma_so, source, source_col, formula,
formula_t2, bac)``. It is configuration: some hundred rows that people edit. Formulas such as
``A1+A2-B`` refer to other metrics, which may have formulas too. As every formula is a signed
sum, each metric is a signed sum of base values. The signs are worked out once on the
definitions, and all metrics of all depths, branches and divisions then come from a single join
and aggregation, whatever the depth.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.temporal import map_codes
from tallyworks.sources.sinks import save_intermediate

AMOUNT = "decimal(38,4)"
#: Definitions that a branch meets at a time where zero rows are filled in.
ZERO_BUCKET = 1_000
VALUE_KEYS = ("stt", "item_code", "item_name", "ma_so", "branch_code", "division_code")

# Division codes and the other spellings of each; no code at all is KXD.
DIVISION_SYNONYMS = {
    "TREASURY": ("TREA",),
    "KXD": ("KHOI KD-KXD", "KHÁC", "KHOI_KD_KXD", "NULL"),
    "NHS": ("COST CENTER", "?COST CENTER?"),
    "SMEs": ("SME", "?SMEs?"),
}
UNKNOWN_DIVISION = "KXD"
# Columns of the published table, in order.
DIVISIONS = ("TREASURY", "INDIV", "FI", "CIB", "SMEs", "DVC", "INVEST", "KXD", "ALM", "NHS")
# Divisions of the income and deposit sources; division of each balance line.
CUSTOMER_DIVISIONS = ("INDIV", "SME", "CIB", "FI")
LINE_DIVISIONS = {"SMEs": ("704000",), "INDIV": ("704100",), "CIB": ("703900",)}
BRANCH_PREFIX, ZERO_DIVISION, CARRY_OVER, ZERO = "VN0010", "INDIV", "TU_THAN", "0"


def ledger_totals(gl: DataFrame, as_of, prefix: str = BRANCH_PREFIX) -> DataFrame:
    """Amount per branch, KPI and division on a date."""
    return (
        gl.filter(F.col("report_date") == F.lit(as_of).cast("date"))
        .groupBy(F.concat(F.lit(prefix), "branch_code").alias("branch_code"), "kpi_code", "division_code")
        .agg(F.sum("amount").cast(AMOUNT).alias("amount"))
    )


def normalize_division(
    df: DataFrame,
    column: str = "division_code",
    synonyms: Mapping[str, Sequence[str]] = DIVISION_SYNONYMS,
    unknown: str | None = UNKNOWN_DIVISION,
) -> DataFrame:
    """One code per division; other codes stay as they are, a missing code becomes ``unknown``."""
    mapped = map_codes(df, column, synonyms, None, "__division")
    return mapped.withColumn(
        column, F.coalesce("__division", column, F.lit(unknown))
    ).drop("__division")


def customer_ftp_totals(income: DataFrame, listed: DataFrame, first, last) -> DataFrame:
    """Interest income, funding cost and provisions of the listed customers."""
    kept = income.filter(
        F.col("transaction_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        & F.trim("division_code").isin(*CUSTOMER_DIVISIONS)
    ).join(listed.select("customer").distinct(), "customer", "left_semi")
    return normalize_division(
        kept.groupBy(F.trim("branch_code").alias("branch_code"), F.trim("division_code").alias("division_code")).agg(
            F.sum("interest_income").cast(AMOUNT).alias("interest_income"),
            F.sum("funding_cost").cast(AMOUNT).alias("funding_cost"),
            F.sum("provision").cast(AMOUNT).alias("provision"),
        )
    )


def deposit_totals(deposits: DataFrame, listed: DataFrame, first, last) -> DataFrame:
    """Deposit interest and transfer price of the listed accounts."""
    kept = deposits.filter(
        F.col("transaction_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        & F.trim("division_code").isin(*CUSTOMER_DIVISIONS)
    ).join(listed.select("account").distinct(), "account", "left_semi")
    return normalize_division(
        kept.groupBy("branch_code", F.trim("division_code").alias("division_code")).agg(
            F.sum("deposit_interest").cast(AMOUNT).alias("deposit_interest"),
            F.sum("transfer_interest").cast(AMOUNT).alias("transfer_interest"),
        )
    )


def gl_line_balances(balances: DataFrame, as_of, lines: Mapping[str, Sequence[str]] = LINE_DIVISIONS) -> DataFrame:
    """Credit, debit and their difference of the ledger lines that stand for a division."""
    wanted = [line for group in lines.values() for line in group]
    kept = balances.filter(
        (F.col("transaction_date") == F.lit(as_of).cast("date")) & F.col("line_gl").isin(*wanted)
    )
    return (
        map_codes(kept, "line_gl", lines, None, "division_code")
        .groupBy("branch_code", "division_code")
        .agg(
            F.sum("credit").cast(AMOUNT).alias("credit"),
            F.sum("debit").cast(AMOUNT).alias("debit"),
            F.sum(F.col("credit") - F.col("debit")).cast(AMOUNT).alias("net"),
        )
    )


def formula_terms(metrics: DataFrame, column: str = "formula") -> DataFrame:
    """Signed terms of every formula: (ma_so, term, sign)."""
    pieces = F.regexp_extract_all(F.col(column), F.lit(r"([+-]?[^+-]+)"), F.lit(1))
    return (
        metrics.filter(F.length(F.trim(column)) > 0)
        .select("ma_so", F.explode(pieces).alias("piece"))
        .select(
            "ma_so",
            F.trim(F.regexp_replace("piece", "^[+-]", "")).alias("term"),
            F.when(F.col("piece").startswith("-"), -1).otherwise(1).alias("sign"),
        )
        .filter(F.length("term") > 0)
    )


def expanded_terms(
    metrics: DataFrame,
    column: str = "formula",
    save: Callable[[DataFrame, str], DataFrame] = save_intermediate,
) -> DataFrame:
    """Coefficients of every formula metric over metrics without a formula: (ma_so, term,
    coefficient). A term that cancels out stays in with coefficient 0, as its rows still count
    as rows of the metric. Formulas that refer to themselves are refused.

    Every round puts the expansions so far in place of the metrics in them, so a chain of n metrics
    takes about log2(n) rounds of one join."""
    terms = formula_terms(metrics, column).groupBy("ma_so", "term").agg(F.sum("sign").alias("coefficient"))
    known = save(terms, "formula-terms")
    codes = save(known.select(F.col("ma_so").alias("__code")).distinct(), "formula-codes")
    rounds = codes.count().bit_length() + 1
    while True:
        open_terms = known.join(codes, F.col("term") == F.col("__code"), "left_semi")
        waiting = open_terms.first()
        if waiting is None:
            return known
        if rounds == 0:
            raise ValueError(f"formula of {waiting.ma_so} refers to itself")
        rounds -= 1
        inner = known.select(
            F.col("ma_so").alias("__inner"), F.col("term").alias("__term"), F.col("coefficient").alias("__times")
        )
        replaced = known.join(inner, F.col("term") == F.col("__inner"), "left").select(
            "ma_so",
            F.coalesce("__term", "term").alias("term"),
            (F.col("coefficient") * F.coalesce("__times", F.lit(1))).alias("coefficient"),
        )
        known = save(replaced.groupBy("ma_so", "term").agg(F.sum("coefficient").alias("coefficient")), "formula-terms")


def base_metrics(
    metrics: DataFrame, ledger: DataFrame, sources: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Metrics without a formula. Those of the ledger add up a list of KPI codes; those of another
    source take one of its columns. ``sources`` maps the source name to (branch_code,
    division_code, value columns)."""
    plain = metrics.filter(F.length(F.trim(F.coalesce("formula", F.lit("")))) == 0)
    wanted = plain.filter(F.col("source") == "ledger").select(
        "stt", "item_code", "item_name", "ma_so",
        F.explode(F.split("source_col", ",")).alias("kpi_code"),
    ).withColumn("kpi_code", F.trim("kpi_code"))
    parts = [ledger.join(wanted, "kpi_code").select(*VALUE_KEYS, "amount")]
    for name, frame in (sources or {}).items():
        columns = [c for c in frame.columns if c not in ("branch_code", "division_code")]
        long = frame.unpivot(["branch_code", "division_code"], columns, "source_col", "amount")
        chosen = plain.filter(F.col("source") == name).drop("source")
        parts.append(
            long.filter(F.col("amount").isNotNull())
            .join(chosen, "source_col")
            .select(*VALUE_KEYS, F.col("amount").cast(AMOUNT).alias("amount"))
        )
    return _totals(reduce(DataFrame.unionByName, parts))


def _totals(values: DataFrame) -> DataFrame:
    known = values.withColumn(
        "division_code", F.coalesce("division_code", F.lit(UNKNOWN_DIVISION))
    )
    return known.groupBy(*VALUE_KEYS).agg(F.sum("amount").cast(AMOUNT).alias("amount"))


def formula_metrics(
    metrics: DataFrame,
    values: DataFrame,
    column: str = "formula",
    value_key: str = "ma_so",
    nested: bool = True,
) -> DataFrame:
    """Values of all formula metrics of all depths in one pass over the base values. Without
    ``nested`` the terms are value keys only and never other metrics."""
    if nested:
        terms = expanded_terms(metrics, column)
    else:
        terms = formula_terms(metrics, column).groupBy("ma_so", "term").agg(
            F.sum("sign").alias("coefficient")
        )
    signed = terms.join(metrics.select("stt", "item_code", "item_name", "ma_so"), "ma_so")
    base = values.select(
        F.col(value_key).alias("term"), "branch_code", "division_code", "amount"
    )
    signed_values = base.join(signed, "term").withColumn(
        "amount", F.col("amount") * F.col("coefficient")
    )
    return _totals(signed_values.select(*VALUE_KEYS, "amount"))


def unpivot_adjustments(adjustments: DataFrame, metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Manual amounts, one column per division, as long rows with the metric number."""
    keys = ["branch_code", "item_code", "item_name", "ma_so"]
    long = adjustments.unpivot(keys, list(columns), "division_code", "amount").filter(
        F.col("amount").isNotNull()
    )
    numbers = metrics.select("stt", "item_code").dropDuplicates(["item_code"])
    return long.join(numbers, "item_code", "left").select(
        *VALUE_KEYS, F.col("amount").cast(AMOUNT).alias("amount")
    )


def zero_fill(metrics: DataFrame, branches: DataFrame, values: DataFrame) -> DataFrame:
    """The values and a zero row for every (branch, metric) that has none. Definitions are dealt to
    hashed buckets of about ``ZERO_BUCKET`` and every branch meets each bucket, so no row or task
    holds all of them."""
    defined = metrics.select("stt", "item_code", "item_name", "ma_so")
    buckets = max(1, -(-defined.count() // ZERO_BUCKET))
    dealt = defined.withColumn("__bucket", F.pmod(F.xxhash64("ma_so", "stt"), F.lit(buckets)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("__bucket")
    wanted = branches.select("branch_code").distinct().select("branch_code", every).join(dealt, "__bucket").drop("__bucket")
    missing = wanted.join(values.select("ma_so", "branch_code").distinct(), ["ma_so", "branch_code"], "left_anti")
    zeros = missing.select(
        "stt", "item_code", "item_name", "ma_so", "branch_code",
        F.lit(ZERO_DIVISION).alias("division_code"), F.lit(0).cast(AMOUNT).alias("amount"),
    )
    return values.select(*VALUE_KEYS, "amount").unionByName(zeros)


def first_table(
    metrics: DataFrame,
    ledger: DataFrame,
    sources: Mapping[str, DataFrame] | None = None,
    adjustments: DataFrame | None = None,
    save: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Base metrics, adjustments, ledger formulas and metric formulas, with zero rows.

    The values without metric formulas are read by three later steps. ``save``, for example
    ``sources.save_intermediate``, writes them once (one row per metric, branch and division) so
    that the ledger is not read again for each step."""
    plain = base_metrics(metrics, ledger, sources)
    if adjustments is not None:
        plain = plain.unionByName(adjustments)
    by_ledger = metrics.filter(F.col("source") == "ledger")
    from_ledger = formula_metrics(by_ledger, ledger, value_key="kpi_code", nested=False)
    known = plain.unionByName(from_ledger)
    if save is not None:
        known = save(known, "metric-values")
    by_metric = metrics.filter(F.coalesce("source", F.lit("")) != "ledger")
    everything = known.unionByName(formula_metrics(by_metric, known))
    return zero_fill(metrics, ledger.select("branch_code"), everything)


def second_table(metrics: DataFrame, values: DataFrame) -> DataFrame:
    """Carried-over metrics, metrics set to zero, and the formulas of the second table."""
    rule = metrics.select("stt", F.trim("formula_t2").alias("__rule"))
    ruled = values.join(rule, "stt")
    carried = ruled.filter(F.col("__rule") == CARRY_OVER).select(*VALUE_KEYS, "amount")
    zeros = (
        ruled.filter(F.col("__rule") == ZERO)
        .withColumn("amount", F.lit(0).cast(AMOUNT))
        .select(*VALUE_KEYS, "amount")
    )
    base = carried.unionByName(zeros)
    formulas = metrics.filter(
        (F.trim("formula_t2") != CARRY_OVER) & (F.trim("formula_t2") != ZERO) & F.col("bac").isNotNull()
    )
    return base.unionByName(formula_metrics(formulas, base, "formula_t2"))


def pivot_with_total(
    values: DataFrame, divisions: Sequence[str] = DIVISIONS, other: bool = False
) -> DataFrame:
    """One row per metric and branch with a column per division, and their sum. Values of other
    divisions are left out, unless ``other`` asks for a column of them."""
    columns = list(divisions)
    rows = values
    if other:
        rows = rows.withColumn(
            "division_code",
            F.when(F.col("division_code").isin(*columns), F.col("division_code")).otherwise("OTHER"),
        )
        columns = [*columns, "OTHER"]
    keys = ["stt", "branch_code", "item_code", "item_name", "ma_so"]
    wide = rows.groupBy(*keys).pivot("division_code", columns).agg(F.sum("amount"))
    filled = wide.select(
        *keys, *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast(AMOUNT).alias(c) for c in columns]
    )
    total: Column = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in columns])
    return filled.select(*keys, total.cast(AMOUNT).alias("total"), *[F.col(f"`{c}`") for c in columns])


def side_by_side(first: DataFrame, second: DataFrame, suffix: str = "_t2") -> DataFrame:
    """Both tables in one row per branch and metric."""
    measures = [c for c in first.columns if c not in ("stt", "branch_code", "item_code", "item_name", "ma_so")]
    right = second.select("branch_code", "ma_so", *[F.col(f"`{c}`").alias(c + suffix) for c in measures])
    return first.join(right, ["branch_code", "ma_so"], "left").orderBy("branch_code", "stt")
