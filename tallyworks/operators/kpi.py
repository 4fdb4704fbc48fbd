"""Tall KPI rows per region, department and employee."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyworks.functions import fiscal_period, root_code, weekday_gap
from tallyworks.operators.joins import SMALL_BYTES, broadcast_if_small, is_small
from tallyworks.operators.ordering import ordered_scan, spread
from tallyworks.operators.temporal import OPEN_DATE, map_codes, milestones

KEYS = ("region", "department_code", "employee_code")
#: Levels of bands are this many powers of two apart.
BIN_STEP = 3


def band_join(
    fact: DataFrame,
    bands: DataFrame,
    on: Sequence[str],
    value: str,
    low: str,
    high: str,
    how: str = "left",
    max_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Band columns of the band that holds the value, bounds included, within the same code. A fact in
    several bands comes once for each; NULL codes, values and bounds match nothing.

    Few codes and many facts: a shuffle by code would pile the facts up in as many tasks. Bands of a
    measured size are broadcast, others are found by bins (``band_matches``)."""
    on = list(on)
    if not is_small(bands, max_bytes=max_bytes):
        pairs = fact.select(*on, value).distinct()
        dealt = spread(fact, [*on, value])
        return dealt.join(band_matches(pairs, bands, on, value, low, high), [*on, value], how).select(
            *fact.columns, *[c for c in bands.columns if c not in (*on, low, high)]
        )
    condition = F.col(f"f.{value}").between(F.col(f"b.{low}"), F.col(f"b.{high}"))
    for c in on:
        condition = condition & (F.col(f"f.{c}") == F.col(f"b.{c}"))
    extra = [F.col(f"b.{c}") for c in bands.columns if c not in (*on, low, high)]
    return fact.alias("f").join(F.broadcast(bands.alias("b")), condition, how).select("f.*", *extra)


def band_matches(
    pairs: DataFrame, bands: DataFrame, on: Sequence[str], value: str, low: str, high: str
) -> DataFrame:
    """Every distinct (code, value) with the columns of the bands that hold the value.

    A band belongs to the level of the next power of eight above its width and lies in at most three bins
    of it, as wide as that power. A value is looked up in its bin at every level that bands have, by
    equality of code, level and bin; the bounds are checked then. Bins are numbered by one rising
    function of value and bounds, so a band that holds a value shares its bin, whatever the rounding.
    A step of eight asks a third of the lookups that one of two does. Lookups are dealt over tasks that
    grow with the input."""
    on = list(on)
    where = [*on, "__level", "__bin"]

    def bin_of(column: str, width: Column) -> Column:
        return F.floor(F.col(column).cast("double") / width).cast("bigint")

    width = F.greatest(F.col(high).cast("double") - F.col(low).cast("double"), F.lit(2.0**-40))
    # A width just above a power may count as that power: its band then lies in one bin more.
    level = F.ceil(F.log2(width) / BIN_STEP).cast("int")
    dealt = bands.filter(F.col(low) <= F.col(high)).withColumn("__level", level)
    levels = sorted(r[0] for r in dealt.select("__level").distinct().collect())  # one for each power of eight
    size = F.pow(F.lit(2.0**BIN_STEP), F.col("__level"))
    dealt = dealt.withColumn("__bin", F.explode(F.sequence(bin_of(low, size), bin_of(high, size))))
    places = [
        F.struct(F.lit(n).alias("__level"), bin_of(value, F.lit(2.0 ** (BIN_STEP * n))).alias("__bin")) for n in levels
    ]
    none = F.array().cast("array<struct<__level:int,__bin:bigint>>")
    asked = pairs.filter(F.col(value).isNotNull()).withColumn("__place", F.explode(F.array(*places) if places else none))
    asked = spread(asked.select(*on, value, "__place.*"), where)
    met = asked.join(dealt, where).filter(F.col(value).between(F.col(low), F.col(high)))
    return met.select(*on, value, *[c for c in bands.columns if c not in (*on, low, high)])


def overlapping_bands(bands: DataFrame, on: Sequence[str], low: str, high: str) -> DataFrame:
    """Bands that begin before an earlier band of the same code has ended: values there would get
    two levels."""
    earlier = W.partitionBy(*on).orderBy(low, high).rowsBetween(W.unboundedPreceding, -1)
    return bands.withColumn("__end", F.max(high).over(earlier)).filter(
        F.col(low) <= F.col("__end")
    ).drop("__end")


def claim_slices(
    claims: DataFrame, as_of, approved: str = "claim_approved_date", name: str = "slice"
) -> DataFrame:
    """Claims settled on the day, settled on the same day a year before, or still open after it,
    found in one pass."""
    at = F.lit(as_of).cast("date")
    day = F.to_date(approved)
    label = (
        F.when(day == at, "settled")
        .when(day == F.add_months(at, -12), "last_year")
        .when(day > at, "open")
    )
    return claims.withColumn(name, label).filter(F.col(name).isNotNull())


# Actions of the claim log that make up its milestones.
CLAIM_ACTIONS = {
    "check_received_at": ("M_CHUYEN_C",),
    "check_returned_at": ("C_HUYNHAN_M",),
    "checked_at": ("C_CHUYEN_V",),
    "validate_returned_at": ("V_HUYNHAN_C",),
    "validated_at": ("V_DUYET", "V_DUYET_DG_BL"),
}
TIMED_ACTIONS = ("M_CHUYEN_C", "C_CHUYEN_V", "V_DUYET", "V_DUYET_DG_BL")


def claim_milestones(
    log: DataFrame, claims: DataFrame, clauses: DataFrame, bands: DataFrame, key: str = "claim_id"
) -> DataFrame:
    """Newest times of the claim steps with the amount and the highest level of the claim. Log
    and clauses are each reduced to one row per claim, so neither inflates the other."""
    spec = {n: F.col("action").isin(*actions) for n, actions in CLAIM_ACTIONS.items()}
    times = milestones(log, [key], "created_date", spec)
    sized = band_join(
        clauses, bands, ["business_type_code"], "compensation_amount", "amount_from", "amount_to"
    )
    amounts = clauses.groupBy(key).agg(F.sum("compensation_amount").alias("amount"))
    levels = sized.groupBy(key).agg(F.max("level").alias("level"))
    return claims.join(times, key).join(amounts, key, "left").join(levels, key, "left")


def business_calendar(
    days: DataFrame, holidays: DataFrame | None = None, opens: int = 8 * 3600, closes: int = 17 * 3600
) -> DataFrame:
    """One row per day between the bounds in ``days`` (columns first, last): opening second and
    working seconds, zero at weekends and on holidays."""
    all_days = days.select(F.explode(F.sequence("first", "last")).alias("day"))
    length = F.when(F.dayofweek("day").isin(1, 7), 0).otherwise(closes - opens)
    calendar = all_days.select("day", F.lit(opens).alias("opens"), length.alias("length"))
    if holidays is not None:
        closed = holidays.select("day").distinct().withColumn("__closed", F.lit(True))
        calendar = calendar.join(closed, "day", "left").select(
            "day", "opens", F.when(F.col("__closed"), 0).otherwise(F.col("length")).alias("length")
        )
    return calendar


def working_seconds(
    df: DataFrame, start: str, end: str, calendar: DataFrame, name: str = "working_seconds", **options
) -> DataFrame:
    """Business seconds between two timestamps. The calendar gets a running total of seconds, so
    each row needs one look-up per end and no walk over the days between. A day that the calendar
    does not have is an error, not a time of zero; a NULL timestamp gives NULL."""
    totals = ordered_scan(calendar, ["day"], running={"__through": "length"}, **options)
    placed = broadcast_if_small(
        totals.withColumn("__before", F.col("__through") - F.col("length"))
    )

    def position(moment: str, side: str) -> Column:
        second = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
        inside = F.least(
            F.greatest(second - F.col(f"{side}.opens"), F.lit(0)), F.col(f"{side}.length")
        )
        return F.col(f"{side}.__before") + inside

    joined = (
        df.alias("r")
        .join(placed.alias("a"), F.to_date(F.col(f"r.{start}")) == F.col("a.day"), "left")
        .join(placed.alias("b"), F.to_date(F.col(f"r.{end}")) == F.col("b.day"), "left")
    )
    seconds = position(f"r.{end}", "b") - position(f"r.{start}", "a")
    outside = (F.col(f"r.{start}").isNotNull() & F.col("a.day").isNull()) | (
        F.col(f"r.{end}").isNotNull() & F.col("b.day").isNull()
    )
    result = F.when(outside, F.raise_error(F.lit("a timestamp is outside the business calendar"))).otherwise(
        F.greatest(seconds, seconds * 0).cast("bigint")
    )
    return joined.select("r.*", result.alias(name))


# Seconds allowed by claim amount, (upper bound, bound included, seconds).
CHECK_LIMITS = (
    (20_000_000, False, 7200), (50_000_000, True, 14400), (100_000_000, True, 18000), (None, True, 36000),
)
VALIDATE_LIMITS = ((50_000_000, True, 7200), (100_000_000, True, 10800), (None, True, 21600))


def tier_limit(amount: Column, tiers: Sequence[tuple]) -> Column:
    out = None
    for bound, included, seconds in tiers:
        if bound is None:
            return out.otherwise(seconds)
        test = amount <= bound if included else amount < bound
        out = F.when(test, seconds) if out is None else out.when(test, seconds)
    return out


def turnaround(
    log: DataFrame,
    claims: DataFrame,
    calendar: DataFrame,
    key: str = "claim_id",
    actions: Sequence[str] = TIMED_ACTIONS,
    amount: str = "amount",
    **options,
) -> DataFrame:
    """Newest row per claim and action, the time of the step before it, the business seconds
    between them and the limits for the claim's amount. After the first step a claim has at most
    one row per action, so the window that follows is small."""
    step = F.struct("created_date", "sent_user", "received_user")
    newest = (
        log.filter(F.col("action").isin(*actions))
        .groupBy(key, "action")
        .agg(F.max(step).alias("__step"))
        .select(key, "action", "__step.*")
    )
    by_claim = W.partitionBy(key).orderBy("created_date", "action")
    steps = newest.withColumn("previous_date", F.lag("created_date").over(by_claim))
    timed = working_seconds(steps, "previous_date", "created_date", calendar, **options)
    return timed.join(claims, key).withColumns(
        {
            "check_limit": tier_limit(F.col(amount), CHECK_LIMITS),
            "validate_limit": tier_limit(F.col(amount), VALIDATE_LIMITS),
        }
    )


def period_edge_estimates(
    claims: DataFrame,
    requests: DataFrame,
    quotes: DataFrame,
    clauses: DataFrame,
    as_of,
    key: str = "claim_id",
) -> DataFrame:
    """Estimated value of every open claim at the start and at the end of the fiscal period. A
    quote goes before a request; within each the newest counts. Once the claim is settled its
    end value is the settled amount.

    Requests, quotes and clauses are put under each other, dealt by claim over tasks that grow with the
    input and folded to one row a claim, so no entry is sorted; only claims are joined then."""
    period = fiscal_period(F.lit(as_of).cast("date"))
    first, last = period.getField("first"), period.getField("last")
    open_claims = claims.filter(
        (F.col("system_date") < first) & (F.to_date("claim_approved_date") >= first)
    )
    asked = requests.filter(
        (F.col("request_amount") != 0)
        & (F.to_date("requested_at") < last)
        & (F.second("requested_at") != 0)
    ).select(key, F.lit(1).alias("__source"), F.col("requested_at").alias("__at"), "request_amount")
    quoted = quotes.filter((F.col("approval_amount") != 0) & (F.to_date("quoted_at") < last)).select(
        key, F.lit(0).alias("__source"), F.col("quoted_at").alias("__at"), "approval_amount"
    )
    billed = clauses.select(key, F.lit(2).alias("__source"), "compensation_amount")
    entries = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), (asked, quoted, billed))
    dealt = spread(entries.filter(F.col(key).isNotNull()), [key])
    estimate = F.coalesce(
        F.sum("request_amount").cast("decimal(30,4)"), F.max("approval_amount").cast("decimal(30,4)")
    )
    moments = dealt.groupBy(key, "__source", "__at").agg(
        estimate.alias("__estimate"), F.sum("compensation_amount").cast("decimal(30,4)").alias("__settled")
    )

    def newest(source: int, side: Column) -> Column:
        return F.max_by("__estimate", F.when((F.col("__source") == source) & side, F.col("__at")))

    opening, closing = F.to_date("__at") < first, ~(F.to_date("__at") < first)
    sides = moments.groupBy(key).agg(
        F.coalesce(newest(0, opening), newest(1, opening)).alias("opening_value"),
        F.coalesce(newest(0, closing), newest(1, closing)).alias("__closing"),
        F.max("__settled").alias("__settled"),
        F.bool_or(F.col("__source") == 2).alias("__billed"),
    )
    still_open = F.to_date("claim_approved_date") == F.lit(OPEN_DATE).cast("date")
    value = F.when(still_open, F.coalesce("__closing", "__settled")).otherwise(F.col("__settled"))
    return (
        open_claims.join(sides.filter(F.col("opening_value").isNotNull() & F.col("__billed")), key)
        .withColumn("closing_value", value)
        .drop("__closing", "__settled", "__billed")
    )


@dataclass(frozen=True)
class Metric:
    """One KPI: its code and label, the rows it takes, and either a value to add up or, without a
    value, the number of distinct ids. ``per`` is written behind code and label, so that each of
    its values is a KPI of its own, ``suffix`` behind the label's."""

    code: str
    label: str
    where: Column | None = None
    value: Column | None = None
    per: Column | None = None
    suffix: str = ""


def metric_facts(
    df: DataFrame, metrics: Mapping[str, Sequence[Metric]], id: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """What each row of one input adds to the metrics, in one pass: a row for every metric that takes it.

    ``metrics`` are listed by the column that is the last of ``keys`` for them. Facts of several inputs
    can be put under each other: keys, code, name, id (NULL for sums), exact and approximate value."""
    *shared, last = keys
    known = df.schema[id].dataType
    facts, taken = [], []
    for column, listed in metrics.items():
        for m in listed:
            code, name = F.lit(m.code), F.lit(m.label)
            if m.per is not None:
                code, name = F.concat(code, m.per), F.concat(name, m.per, F.lit(m.suffix))
            takes = F.lit(True) if m.where is None else m.where
            none = F.lit(None).cast("double")
            if m.value is None:
                counted, exact, inexact, takes = F.col(id), F.lit(None), none, takes & F.col(id).isNotNull()
            else:
                binary = df.select(m.value).schema[0].dataType.typeName() in ("double", "float")
                counted, takes = F.lit(None).cast(known), takes & m.value.isNotNull()
                exact, inexact = (F.lit(None), m.value) if binary else (m.value, none)
            fact = F.struct(
                F.col(column).cast("string").alias(last), code.alias("code"), name.alias("name"), counted.alias("id"),
                exact.cast("decimal(38,6)").alias("exact"), inexact.cast("double").alias("inexact"),
            )
            facts.append(F.when(takes, fact))
            taken.append(F.coalesce(takes, F.lit(False)))
    # Most rows add to no metric of the day: they go before any fact is built.
    some = df.filter(reduce(Column.__or__, taken))
    return some.select(*shared, F.explode(F.array_compact(F.array(*facts))).alias("fact")).select(*shared, "fact.*")


def fold_facts(facts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """keys, code, name, and exact and inexact values of all metrics: ids are made distinct, then counted;
    sums are formed in the tasks first, so they cross the first exchange as one row a task."""
    group = [*keys, "code", "name"]
    once = facts.groupBy(*group, "id").agg(F.sum("exact").alias("exact"), F.sum("inexact").alias("inexact"))
    counted = F.when(F.col("id").isNotNull(), F.lit(1).cast("decimal(38,6)")).otherwise(F.col("exact"))
    return once.groupBy(*group).agg(F.sum(counted).alias("exact"), F.sum("inexact").alias("inexact"))


def fact_value() -> Column:
    return F.coalesce(F.col("exact").cast("double"), F.col("inexact"))


def group_total(
    folded: DataFrame, hidden: str, group: str, code: str, label: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The total of a folded metric over a group of its members, on every member."""
    members = folded.filter(F.col("code") == hidden)
    totals = members.groupBy(F.col(group).alias("__group")).agg(F.sum("exact").alias("exact"), F.sum("inexact").alias("inexact"))
    joined = members.select(*keys).join(totals, F.col(group).eqNullSafe(F.col("__group")))
    return joined.select(*keys, F.lit(code).alias("code"), F.lit(label).alias("name"), "exact", "inexact")


def metric_union(
    df: DataFrame, metrics: Sequence[Metric], id: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """All metrics over one input as tall rows, from one aggregation. The input is first reduced
    to one row per group and id with a flag or a sum per metric; a distinct count is then a sum
    of flags."""
    keys = list(keys)
    slots = [f"m{i}" for i in range(len(metrics))]
    per_id, totals = [], []
    for slot, m in zip(slots, metrics):
        if m.value is None:
            flag = F.when(m.where & F.col(id).isNotNull(), 1) if m.where is not None else F.when(
                F.col(id).isNotNull(), 1
            )
            per_id.append(F.max(flag).alias(slot))
        else:
            per_id.append(
                F.sum(m.value if m.where is None else F.when(m.where, m.value)).alias(slot)
            )
        totals.append(F.sum(slot).cast("double").alias(slot))
    wide = df.groupBy(*keys, id).agg(*per_id).groupBy(*keys).agg(*totals)
    tall = wide.unpivot(keys, slots, "slot", "value").filter(F.col("value").isNotNull())
    codes = {m.code: [s] for s, m in zip(slots, metrics)}
    labels = F.create_map(*[F.lit(x) for s, m in zip(slots, metrics) for x in (s, m.label)])
    named = map_codes(tall, "slot", codes, None, "code").withColumn("name", labels[F.col("slot")])
    return named.select(*keys, "code", "name", "value")


def broadcast_group_total(
    df: DataFrame,
    group: Sequence[str],
    value: Column,
    code: str,
    label: str,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The total of the group, on every member of it."""
    totals = df.groupBy(*group).agg(F.sum(value).cast("double").alias("value"))
    members = df.select(*keys).distinct()
    condition = F.lit(True)
    for c in group:
        condition = condition & F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}"))
    joined = members.alias("m").join(totals.alias("t"), condition)
    return joined.select("m.*", F.lit(code).alias("code"), F.lit(label).alias("name"), "value")


def level_counts(
    df: DataFrame,
    id: str,
    prefix: str,
    label: str,
    where: Column | None = None,
    levels: Sequence[int] = tuple(range(1, 9)),
    level: str = "level",
    keys: Sequence[str] = KEYS,
    suffix: str = "",
) -> DataFrame:
    """Distinct ids per level; the level is part of the metric code."""
    rows = df.filter(F.col(level).isin(*levels))
    if where is not None:
        rows = rows.filter(where)
    counted = rows.groupBy(*keys, level).agg(F.countDistinct(id).cast("double").alias("value"))
    return counted.select(
        *keys,
        F.concat(F.lit(prefix), F.col(level)).alias("code"),
        F.concat(F.lit(label), F.col(level), F.lit(suffix)).alias("name"),
        "value",
    )


# Days after which an open claim of a level counts as old.
AGE_LIMITS = {1: 45, 2: 45, 3: 60, 4: 60, 5: 90, 6: 90, 7: 90, 8: 90}


def aged_backlog(
    df: DataFrame,
    as_of,
    id: str,
    opened: str,
    limits: Mapping[int, int] = AGE_LIMITS,
    prefix: str = "GD_ton_lau_lv",
    label: str = "Level ",
    suffix: str = " tồn lâu",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Open ids older than the limit of their level."""
    allowed = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date(opened))
    old = age > allowed[F.col("level")]
    return level_counts(df, id, prefix, label, old, tuple(limits), keys=keys, suffix=suffix)


def head_rollup(
    tall: DataFrame, employees: DataFrame, heads: DataFrame, regions: DataFrame, codes: Sequence[str]
) -> DataFrame:
    """For some metrics the head of a department shows the sum of all its members, each counted in
    the department the employee belongs to."""
    chosen = F.col("code").isin(*codes)
    home = employees.select("employee_code", F.col("department_code").alias("__home"))
    sums = (
        tall.filter(chosen)
        .join(home, "employee_code")
        .filter(F.col("__home").isNotNull())
        .groupBy(F.col("__home").alias("department_code"), "code")
        .agg(F.max("name").alias("name"), F.sum("value").alias("value"))
    )
    head_rows = (
        sums.join(regions.select("department_code", "region"), "department_code", "left")
        .join(heads.select("department_code", "employee_code"), "department_code", "left")
        .select(*tall.columns)
    )
    is_head = heads.select("employee_code").distinct().withColumn("__head", F.lit(True))
    kept = (
        tall.join(is_head, "employee_code", "left")
        .filter(~(chosen & F.col("__head").isNotNull()))
        .select(*tall.columns)
    )
    return kept.unionByName(head_rows)


# Region names.
REGION_NAMES = {"Miền Nam": ("MN",), "Miền Bắc": ("MB",)}


def publish(tall: DataFrame, as_of, region_names: Mapping[str, Sequence] = REGION_NAMES) -> DataFrame:
    """Rows with a value and a region, stamped with the day and the fiscal month."""
    at = F.lit(as_of).cast("date")
    shown = tall.filter((F.col("value") != 0) & F.col("region").isNotNull())
    return map_codes(shown, "region", region_names).select(
        at.alias("day"), fiscal_period(at).getField("label").alias("report_month"), *tall.columns
    )


# Metrics that are summed up for the head of a department.
HEAD_CODES = (
    "GD_HSBT_ton_dau_ky", "GD_HSBT_phat_sinh", "GD_ton_lau_lv1", "GD_ton_lau_lv2", "GD_ton_lau_lv3",
    "GD_ton_lau_lv4", "GD_ton_lau_lv5", "GD_ton_lau_lv6", "GD_ton_lau_lv7", "GD_ton_lau_lv8",
    "GD_GT_HSBT_ton_dau_ky", "GD_GT_HSBT_ton_cuoi_ky", "GD_mo_sau_2_ngay", "GD_HSBT_dgq",
)
CAR_CATEGORIES, PRODUCTS = ("XE", "XEL"), ("XE", "XEL", "2BL", "2B")
CANCELLED_STATUS, MAIN_CLAUSE, SKIPPED_CLAUSES = 1, "XO.4.1.1", "XM"
# Folded metrics that are only shown as totals of groups.
RATED_TOTAL, AMOUNT_TOTAL = "__rated", "__amount"


def claim_base(claims: DataFrame, regions: DataFrame) -> DataFrame:
    """Valid car claims that are not cancelled, with root department, region and employee."""
    status = F.coalesce(F.col("claim_detail_status").cast("string"), F.lit(""))
    kept = claims.filter(
        (F.col("valid") == 1)
        & F.col("motor_category").isin(*CAR_CATEGORIES)
        & (status != str(CANCELLED_STATUS))
    )
    rooted = kept.withColumns(
        {
            "department_code": root_code(F.col("area_code"), F.col("department_code")),
            "employee_code": F.when(F.col("product_type").isin(*PRODUCTS), F.col("user")),
            "system_date": F.to_date("system_date"),
        }
    )
    return rooted.join(regions.select("department_code", "region"), "department_code", "left")


def kpi_dataset(
    sources: Mapping[str, DataFrame],
    as_of,
    save: Callable[[DataFrame, str], DataFrame] | None = None,
    **options,
) -> DataFrame:
    """The tall KPI dataset of one day.

    Every input is read once and turned into the facts that it adds to its metrics (``metric_facts``);
    the facts of all inputs are put under each other and folded in one aggregation by group, metric
    and id and one by group and metric. Totals of departments and regions come from the folded rows.
    ``save``, for example ``sources.save_intermediate``, writes the cleaned claims, which five inputs
    read, and the folded metrics.

    ``sources`` holds claims, regions (department_code, region), clauses, bands, rates, log,
    requests, quotes, approved_prices, calls, employees, heads and calendar.
    """
    save = save or (lambda frame, name: frame)
    at = F.lit(as_of).cast("date")
    base = save(claim_base(sources["claims"], sources["regions"]), "claims")
    recent = sources["clauses"].filter(
        (F.to_date("system_date") >= F.add_months(at, -24))
        & ~F.col("business_type_code").startswith(SKIPPED_CLAUSES)
    )
    clauses = recent.select(
        "claim_id", "business_type_code", F.col("compensation_amount").alias("amount")
    )
    # Only claims with a step on the day can have a newest step on it; amounts, levels and times between steps
    # are asked of them alone, so log rows and clauses of others are left out before they are grouped.
    log = sources["log"]
    active = broadcast_if_small(log.filter(F.to_date("created_date") == at).select("claim_id").distinct())
    slices = claim_slices(base, as_of)
    # Deductions count for claims settled on the day or the year before.
    closed = broadcast_if_small(slices.filter(F.col("slice") != "open").select("claim_id").distinct())
    prices = (
        sources["approved_prices"]
        .filter(F.col("deductible_quantity") > 0)
        .join(closed, "claim_id", "left_semi")
        .groupBy("claim_id")
        .agg(F.sum("deductible_quantity").alias("deductions"))
    )
    rates = sources["rates"].select(
        F.col("unit_code").alias("manage_unit_code"), "report_month", "claim_rate"
    )
    month = fiscal_period(at).getField("label")
    detail = band_join(
        slices.join(spread(clauses, ["claim_id"]), "claim_id"),
        sources["bands"], ["business_type_code"], "amount", "amount_from", "amount_to",
    )
    detail = detail.join(prices, "claim_id", "left").join(
        rates.filter(F.col("report_month") == month).drop("report_month"), "manage_unit_code", "left"
    )
    positive = F.col("amount") > 0
    settled, last_year, still_open = (F.col("slice") == name for name in ("settled", "last_year", "open"))
    rated = F.col("amount") * F.col("claim_rate")

    def average_cost(prefix: str, bound: int, rows: Column, suffix: str) -> list[Metric]:
        chosen = (
            rows & positive & (F.col("amount") < bound)
            & (F.col("business_type_code") == MAIN_CLAUSE) & (F.col("deductions") > 0)
        )
        return [
            Metric(f"{prefix}_CPBQ_TU{suffix}", "Chi phí bình quân (tử số)", chosen, F.col("amount")),
            Metric(f"{prefix}_CPBQ_MAU{suffix}", "Chi phí bình quân (mẫu số)", chosen, F.col("deductions")),
        ]

    def by_level(code: str, label: str, where: Column, suffix: str = "") -> Metric:
        return Metric(code, label, where & F.col("level").between(1, 8), per=F.col("level").cast("string"), suffix=suffix)

    allowed = F.create_map(*[F.lit(x) for pair in AGE_LIMITS.items() for x in pair])
    old = F.datediff(at, F.to_date("system_date")) > allowed[F.col("level")]
    levelled = positive & F.col("level").between(1, 8)
    facts = [
        metric_facts(
            detail,
            {
                "employee_code": [
                    Metric(RATED_TOTAL, "", settled, F.coalesce(rated, F.lit(0.0))),
                    Metric(AMOUNT_TOTAL, "", settled, F.coalesce(F.col("amount"), F.lit(0))),
                    Metric("TD_TLBT_TU", "Tỷ lệ BT thực hiện (tử số)", settled, rated),
                    Metric("GD_HSBT_dgq", "Tổng HSBT đã giải quyết", settled & levelled),
                    *average_cost("GD", 10_000_000, settled, ""),
                    *average_cost("TD", 20_000_000, settled, ""),
                    by_level("GD_C", "Giám định C", settled & positive),
                    *average_cost("GD", 10_000_000, last_year, "_NT"),
                    *average_cost("TD", 20_000_000, last_year, "_NT"),
                    by_level("GD_ton_lau_lv", "Level ", still_open & positive & old, " tồn lâu"),
                ]
            },
            "claim_id",
        )
    ]

    named = [a for actions in CLAIM_ACTIONS.values() for a in actions]
    steps = claim_milestones(
        spread(log.filter(F.col("action").isin(*named)).select("claim_id", "action", "created_date"), ["claim_id"]),
        base.drop("employee_code"),
        sources["clauses"].join(active, "claim_id", "left_semi"),
        sources["bands"],
    )
    cutoff = F.lit(f"{as_of} 17:00:00").cast("timestamp_ntz")

    def waiting(arrived: str, returned: str, done: str) -> Column:
        open_after = [F.col(c).isNull() | (F.col(c) > cutoff) for c in (returned, done)]
        return (F.col(arrived) <= cutoff) & open_after[0] & open_after[1]

    checked_today = positive & (F.to_date("checked_at") == at)
    validated_today = positive & (F.to_date("validated_at") == at)
    unchecked = waiting("check_received_at", "check_returned_at", "checked_at") & F.col("tier1_checker_user").isNotNull()
    unvalidated = waiting("checked_at", "validate_returned_at", "validated_at")
    facts.append(
        metric_facts(
            steps,
            {
                "tier1_checker_user": [
                    by_level("TD_check_C", "Check C", checked_today),
                    Metric("TD_Check_chua_duyet", "Số HSBT chưa check xong", unchecked),
                ],
                "validate_user": [
                    by_level("TD_validate_C", "Validate C", validated_today),
                    Metric("TD_validate_chua_duyet", "Số HSBT chưa validate xong", unvalidated),
                ],
            },
            "claim_id",
        )
    )

    opened_today = F.col("system_date") == at
    pending = (F.col("system_date") < at) & (F.to_date("claim_approved_date") >= at)
    # The call is asked of claims opened on the day; pending ones, all earlier, are counted without it.
    fresh = base.filter(opened_today)
    call_key = ["call_center_id", "manage_unit_code"]
    calls = (
        sources["calls"].filter(F.col("valid") == 1)
        .select(F.col("call_id").alias("call_center_id"), F.col("unit_code").alias("manage_unit_code"), "system_date")
        .join(broadcast_if_small(fresh.select(*call_key).distinct()), call_key, "left_semi")
        .groupBy(*call_key).agg(F.max(F.to_date("system_date")).alias("call_date"))
    )
    called = fresh.join(calls, call_key, "left").unionByName(base.filter(pending), allowMissingColumns=True)
    gap = weekday_gap(F.col("call_date"), F.col("system_date"))
    positive_gap = F.when(gap > 0, gap).otherwise(0)
    facts.append(
        metric_facts(
            called,
            {
                "user": [
                    Metric("GD_HSBT_ton_dau_ky", "HSBT tồn đầu kỳ", pending),
                    Metric("GD_HSBT_phat_sinh", "HSBT phát sinh", opened_today),
                    Metric("GD_mo_sau_2_ngay", "Số HSBT mở sau 2 ngày nhập call", opened_today & (gap > 2)),
                    Metric("GD_so_ngay_mo_hs_sau_call", "Tổng số ngày mở HSBT sau khi nhận call", opened_today, positive_gap),
                    Metric("GD_HSBT_phat_sinh_vizualize", "HSBT phát sinh trong kỳ", opened_today),
                    Metric("GD_HSBT_ton_dau_ky_vizualize", "HSBT tồn đầu kỳ", pending),
                ]
            },
            "claim_id",
        )
    )

    main = (
        sources["clauses"].filter(F.col("business_type_code") == MAIN_CLAUSE)
        .join(active, "claim_id", "left_semi")
        .groupBy("claim_id").agg(F.sum("compensation_amount").alias("amount"))
    )
    at_work = base.select("claim_id", "region", "department_code").join(active, "claim_id", "left_semi")
    timed = turnaround(
        log.join(active, "claim_id", "left_semi"),
        at_work.join(main, "claim_id"),
        sources["calendar"],
        **options,
    ).filter(F.to_date("created_date") == at)
    to_check, to_validate = F.col("action") == "M_CHUYEN_C", F.col("action") == "C_CHUYEN_V"
    approved = F.col("action").isin("V_DUYET", "V_DUYET_DG_BL")
    spent = F.coalesce("working_seconds", F.lit(0))
    facts.append(
        metric_facts(
            timed,
            {
                "received_user": [
                    Metric("TD_check_nhan_moi", "Check nhận mới trong kỳ", to_check),
                    Metric("TD_validate_nhan_moi", "Validate nhận mới trong kỳ", to_validate),
                ],
                "sent_user": [
                    Metric("TD_check_hoan_thanh", "Check hoàn thành trong kỳ", to_validate),
                    Metric("TD_check_dung_han", "Check hoàn thành trong kỳ", to_validate & (spent <= F.col("check_limit"))),
                    Metric("TD_validate_hoan_thanh", "Validate hoàn thành trong kỳ", approved),
                    Metric("TD_validate_dung_han", "Check hoàn thành trong kỳ", approved & (spent <= F.col("validate_limit"))),
                ],
            },
            "claim_id",
        )
    )

    edge = {
        21: ("opening_value", "GD_GT_HSBT_ton_dau_ky", "Ước HSBT tồn đầu kỳ"),
        20: ("closing_value", "GD_GT_HSBT_ton_cuoi_ky", "Ước HSBT tồn cuối kỳ"),
    }.get(int(str(as_of)[8:10]))
    if edge:
        column, code, label = edge
        values = period_edge_estimates(
            base, sources["requests"], sources["quotes"], sources["clauses"], as_of
        ).filter(F.col("region").isNotNull())
        facts.append(metric_facts(values, {"employee_code": [Metric(code, label, None, F.col(column))]}, "claim_id"))

    folded = save(fold_facts(reduce(DataFrame.unionByName, facts)), "metrics")
    hidden = F.col("code").isin(RATED_TOTAL, AMOUNT_TOTAL)
    parts = [
        folded.filter(~hidden),
        group_total(folded, RATED_TOTAL, "department_code", "GD_TLBT_TU", "Tỷ lệ BT thực hiện (tử số)"),
        group_total(folded, AMOUNT_TOTAL, "department_code", "GD_TLBT_MAU", "Tỷ lệ BT thực hiện (mẫu số)"),
        group_total(folded, AMOUNT_TOTAL, "region", "TD_TLBT_MAU", "Tỷ lệ BT thực hiện (mẫu số)"),
    ]
    tall = reduce(DataFrame.unionByName, parts).select(*KEYS, "code", "name", fact_value().alias("value"))
    rolled = head_rollup(tall, sources["employees"], sources["heads"], sources["regions"], HEAD_CODES)
    return publish(rolled, as_of)


def day_bounds(spark: SparkSession, first, last) -> DataFrame:
    return spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
