"""Counts, conditional sums and rates per group or for the whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import decimal_ratio, half_of_year, half_up, rounded_ratio
from tallyworks.operators.ordering import spread


def covers_all(facts: DataFrame, entity: str, member: str, required: DataFrame) -> DataFrame:
    """Entities that hold every member of the required set (a frame with the member column)."""
    needed = required.select(member).distinct()
    wanted = needed.agg(F.count(F.lit(1))).scalar()
    held = facts.select(entity, member).distinct().join(needed, member, "left_semi")
    counted = held.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    return counted.filter(F.col("__n") == wanted).select(entity)


def next_day_return_rate(
    df: DataFrame, entity: str, day: str, name: str = "fraction", digits: int = 2
) -> DataFrame:
    """Share of entities that are active on the day after their first day."""
    days = df.select(entity, F.col(day).alias("__day")).distinct()
    firsts = days.groupBy(entity).agg(F.date_add(F.min("__day"), 1).alias("__day"))
    back = firsts.join(days, [entity, "__day"], "left_semi").agg(F.count(F.lit(1))).scalar()
    return firsts.agg(rounded_ratio(back, F.count(F.lit(1)), digits).alias(name))


def first_row_match_rate(
    df: DataFrame,
    entity: str,
    order: Sequence[str],
    predicate: Column,
    name: str = "percentage",
    digits: int = 2,
) -> DataFrame:
    """Percent of entities whose first row meets a test."""
    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    hit = F.when(predicate, 1).otherwise(0)
    firsts = df.groupBy(entity).agg(F.min_by(hit, position).alias("__hit"))
    return firsts.agg(
        rounded_ratio(F.sum("__hit") * 100, F.count(F.lit(1)), digits).alias(name)
    )


def conditional_summary(
    df: DataFrame,
    keys: Sequence[str],
    condition: Column,
    amount: str,
    names: Sequence[str] = ("row_count", "matched_count", "total_amount", "matched_amount"),
) -> DataFrame:
    """Count and sum of all rows and of the rows that meet a condition, per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(names[0]),
        F.count_if(condition).alias(names[1]),
        F.sum(amount).alias(names[2]),
        F.coalesce(F.sum(F.when(condition, F.col(amount))), F.lit(0)).alias(names[3]),
    )


def signed_sum(
    df: DataFrame, keys: Sequence[str], amount: str, negative_when: Column, name: str = "net"
) -> DataFrame:
    """Sum in which the rows that meet the condition count negative."""
    signed = F.when(negative_when, -F.col(amount)).otherwise(F.col(amount))
    return df.groupBy(*keys).agg(F.sum(signed).alias(name))


def total_with_zero(
    dim: DataFrame, facts: DataFrame, dim_key: str, fact_key: str, amount: str, name: str = "total"
) -> DataFrame:
    """Every dimension row with the sum of its facts, zero without facts. Facts are summed
    before the join."""
    totals = facts.groupBy(F.col(fact_key).alias(dim_key)).agg(F.sum(amount).alias(name))
    return dim.join(totals, dim_key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def conditional_rate(
    dim: DataFrame,
    facts: DataFrame,
    dim_key: str,
    fact_key: str,
    condition: Column,
    name: str = "rate",
    digits: int = 2,
) -> DataFrame:
    """Share of an entity's rows that meet a condition, zero without rows."""
    counts = facts.groupBy(F.col(fact_key).alias(dim_key)).agg(
        F.count_if(condition).alias("__hit"), F.count(F.lit(1)).alias("__all")
    )
    rate = rounded_ratio(F.col("__hit"), F.col("__all"), digits)
    return (
        dim.join(counts, dim_key, "left")
        .withColumn(name, F.coalesce(rate, F.lit(0).cast(f"decimal(20,{digits})")))
        .drop("__hit", "__all")
    )


def rate_with_role_filters(
    facts: DataFrame,
    dim: DataFrame,
    dim_key: str,
    roles: Sequence[str],
    allowed: Column,
    condition: Column,
    day: str,
    low,
    high,
    name: str = "rate",
    digits: int = 2,
) -> DataFrame:
    """Daily rate over facts whose partners in all roles are allowed by the same dimension."""
    kept = facts.filter(F.col(day).between(F.lit(low), F.lit(high)))
    good = dim.filter(allowed).select(dim_key)
    for role in roles:
        kept = kept.join(good.select(F.col(dim_key).alias(role)), role, "left_semi")
    return kept.groupBy(day).agg(
        rounded_ratio(F.count_if(condition), F.count(F.lit(1)), digits).alias(name)
    )


def parity_sums(
    df: DataFrame, keys: Sequence[str], amount: str, names: Sequence[str] = ("odd_sum", "even_sum")
) -> DataFrame:
    """Sum of the odd and of the even amounts per group; zero where there are none."""
    odd = F.col(amount) % 2 != 0
    value = F.col(amount)
    return df.groupBy(*keys).agg(
        F.sum(F.when(odd, value).otherwise(0)).alias(names[0]),
        F.sum(F.when(~odd, value).otherwise(0)).alias(names[1]),
    )


def two_phase_average(
    df: DataFrame,
    entity: str,
    phase: str,
    value: str,
    first: str,
    second: str,
    names: Sequence[str] = ("first_avg", "second_avg"),
    digits: int = 2,
) -> DataFrame:
    """Mean value in two phases, for the entities that have rows in both."""
    in_first, in_second = F.col(phase) == first, F.col(phase) == second
    both = (
        df.filter(in_first | in_second)
        .groupBy(entity)
        .agg(
            F.sum(F.when(in_first, F.col(value))).alias("__s1"),
            F.count_if(in_first).alias("__n1"),
            F.sum(F.when(in_second, F.col(value))).alias("__s2"),
            F.count_if(in_second).alias("__n2"),
        )
        .filter((F.col("__n1") > 0) & (F.col("__n2") > 0))
    )
    return both.select(
        entity,
        rounded_ratio(F.col("__s1"), F.col("__n1"), digits).alias(names[0]),
        rounded_ratio(F.col("__s2"), F.col("__n2"), digits).alias(names[1]),
    )


def half_year_delta(
    df: DataFrame,
    entity: str,
    date: str,
    numerator: str,
    denominator: str,
    digits: int = 2,
) -> DataFrame:
    """Mean of the row ratios in the second half of the year minus the first half, for entities
    with rows in both and a positive difference."""
    ratio = decimal_ratio(F.col(numerator), F.col(denominator))
    halves = df.select(entity, half_of_year(F.col(date)).alias("__half"), ratio.alias("__r"))
    first, second = F.col("__half") == 1, F.col("__half") == 2
    means = (
        halves.filter(F.col("__r").isNotNull())
        .groupBy(entity)
        .agg(
            F.avg(F.when(first, F.col("__r"))).alias("__a"),
            F.avg(F.when(second, F.col("__r"))).alias("__b"),
        )
        .filter(F.col("__b") > F.col("__a"))
    )
    return means.select(
        entity,
        half_up(F.col("__a"), digits).alias("first_half_avg"),
        half_up(F.col("__b"), digits).alias("second_half_avg"),
        half_up(F.col("__b") - F.col("__a"), digits).alias("improvement"),
    )


def loyal_entities(
    df: DataFrame,
    entity: str,
    date: str,
    purchase: Column,
    refund: Column,
    min_purchases: int = 3,
    min_days: int = 30,
    max_refund_share=0.2,
) -> DataFrame:
    """Entities with enough purchases, a long enough active span and a refund share below the
    limit."""
    limit = F.lit(str(max_refund_share)).cast("decimal(10,6)")
    return (
        df.filter(purchase | refund)
        .groupBy(entity)
        .agg(
            F.count_if(purchase).alias("__buys"),
            F.count_if(refund).alias("__refunds"),
            F.count(F.lit(1)).alias("__all"),
            F.datediff(F.max(date), F.min(date)).alias("__days"),
        )
        .filter(
            (F.col("__buys") >= min_purchases)
            & (F.col("__days") >= min_days)
            & (F.col("__refunds") < F.col("__all") * limit)
        )
        .select(entity)
    )


def idle_sessions(
    events: DataFrame,
    session: str,
    user: str,
    ts: str,
    scroll: Column,
    click: Column,
    purchase: Column,
    min_minutes: int = 30,
    min_scrolls: int = 5,
    max_click_share=0.2,
) -> DataFrame:
    """Long sessions with many scrolls, few clicks for them and no purchase."""
    limit = F.lit(str(max_click_share)).cast("decimal(10,6)")
    return (
        events.groupBy(session, user)
        .agg(
            F.timestamp_diff("MINUTE", F.min(ts), F.max(ts)).alias("session_duration_minutes"),
            F.count_if(scroll).alias("scroll_count"),
            F.count_if(click).alias("__clicks"),
            F.count_if(purchase).alias("__buys"),
        )
        .filter(
            (F.col("session_duration_minutes") > min_minutes)
            & (F.col("scroll_count") >= min_scrolls)
            & (F.col("__clicks") < F.col("scroll_count") * limit)
            & (F.col("__buys") == 0)
        )
        .drop("__clicks", "__buys")
    )


def dominant_share(
    df: DataFrame,
    entity: str,
    item: str,
    category: str,
    min_items: int = 5,
    min_share=0.6,
    digits: int = 2,
) -> DataFrame:
    """Most frequent category of an entity when its share reaches a level; the smaller category
    name wins a tie. The share is compared unrounded."""
    level = F.lit(str(min_share)).cast("decimal(10,6)")
    items = (
        df.groupBy(entity)
        .agg(F.countDistinct(item).alias("__items"))
        .filter(F.col("__items") >= min_items)
    )
    by_category = df.groupBy(entity, category).agg(F.count(F.lit(1)).alias("__n"))
    top = by_category.groupBy(entity).agg(
        F.sum("__n").alias("__all"),
        F.max("__n").alias("__top"),
        F.min_by(category, F.struct(-F.col("__n"), F.col(category))).alias("dominant_category"),
    )
    return (
        top.filter(F.col("__top") >= F.col("__all") * level)
        .join(items, entity, "left_semi")
        .select(
            entity,
            "dominant_category",
            rounded_ratio(F.col("__top"), F.col("__all"), digits).alias("share"),
        )
    )


def extreme_pair_ratio(
    df: DataFrame,
    group: str,
    item: str,
    price: str,
    quantity: str,
    min_items: int = 3,
    digits: int = 2,
) -> DataFrame:
    """Quantity of the cheapest item over quantity of the dearest, for groups with enough items
    whose dearest item has the smaller quantity. Price ties go to the smaller item."""
    pair = F.struct(F.col(item).alias("item"), F.col(quantity).alias("quantity"))
    ends = (
        df.groupBy(group)
        .agg(
            F.min_by(pair, F.struct(-F.col(price), F.col(item))).alias("__dear"),
            F.min_by(pair, F.struct(F.col(price), F.col(item))).alias("__cheap"),
        )
        .filter(F.col("__dear.quantity") < F.col("__cheap.quantity"))
    )
    wide = (
        spread(df.select(group, item), [group, item])
        .distinct()
        .groupBy(group)
        .agg(F.count(item).alias("__items"))
        .filter(F.col("__items") >= min_items)
    )
    return ends.join(wide, group, "left_semi").select(
        group,
        F.col("__dear.item").alias("dearest_item"),
        F.col("__cheap.item").alias("cheapest_item"),
        rounded_ratio(F.col("__cheap.quantity"), F.col("__dear.quantity"), digits).alias("ratio"),
    )
