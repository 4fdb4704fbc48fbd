"""Stock for scanned rolls, open request lines and first-in-first-out allocation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.functions import decimal_ratio
from tallyworks.operators.ordering import next_ids, ordered_scan
from tallyworks.operators.ranking import first_rows
from tallyworks.sources.sinks import commit_tables, committed_tables, committed_versions

RECEIPT, ISSUE = 1, 2
# Fixed value: the document that always takes stock from the factory.
FACTORY_DOCUMENT = "SI"
ALREADY_SCANNED, NO_STOCK = "already scanned", "no stock left"


def available_stock(
    scans: DataFrame,
    produced: DataFrame,
    consumed: DataFrame,
    master: DataFrame,
    current: DataFrame,
) -> DataFrame:
    """Stock of every scanned roll: (roll_code, warehouse_id, item_id, quantity).

    A receipt starts from the roll master with quantity zero. An issue takes the largest current
    balance of the roll, or, for the factory document and for rolls without any balance, the
    produced rows that are not consumed yet. ``current`` is already limited to the fiscal year
    and branch.
    """
    columns = ["roll_code", "warehouse_id", "item_id", "quantity"]
    has_balance = (
        current.filter(F.col("quantity") > 0)
        .select("roll_code")
        .distinct()
        .withColumn("__balance", F.lit(True))
    )
    flagged = scans.select("roll_code", "doc_group", "doc_code").distinct().join(
        has_balance, "roll_code", "left"
    )
    factory = F.col("__balance").isNull() | (F.col("doc_code") == FACTORY_DOCUMENT)
    issue = F.col("doc_group") == ISSUE

    def rolls(condition: Column) -> DataFrame:
        return flagged.filter(condition).select("roll_code").distinct()

    unused = produced.join(
        consumed.filter(F.col("row_id").isNotNull()).select("row_id").distinct(), "row_id", "left_anti"
    )
    from_factory = unused.join(rolls(issue & factory), "roll_code", "left_semi").select(*columns)
    from_master = master.join(rolls(F.col("doc_group") == RECEIPT), "roll_code", "left_semi").select(
        "roll_code",
        F.lit(None).cast(current.schema["warehouse_id"].dataType).alias("warehouse_id"),
        "item_id",
        F.lit(0).cast(current.schema["quantity"].dataType).alias("quantity"),
    )
    balances = current.filter(F.col("quantity") >= 0).join(
        rolls(issue & ~factory), "roll_code", "left_semi"
    )
    from_current = first_rows(
        balances.select(*columns), ["roll_code"], ["-quantity", "warehouse_id", "item_id"]
    )
    return from_factory.unionByName(from_master).unionByName(from_current)


def reject_scans(
    scans: DataFrame, scanned: DataFrame, stock: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Accepted scans, and refused scans with the reason."""
    seen = scanned.select("roll_code").distinct().withColumn("__seen", F.lit(True))
    in_stock = (
        stock.filter(F.col("quantity") > 0)
        .select("roll_code")
        .distinct()
        .withColumn("__stock", F.lit(True))
    )
    reason = F.when(F.col("__seen"), ALREADY_SCANNED).when(
        (F.col("doc_group") == ISSUE) & F.col("__stock").isNull(), NO_STOCK
    )
    judged = (
        scans.join(seen, "roll_code", "left")
        .join(in_stock, "roll_code", "left")
        .withColumn("reason", reason)
        .drop("__seen", "__stock")
    )
    accepted = judged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, judged.filter(F.col("reason").isNotNull())


def fill_location(lines: DataFrame, stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Missing warehouse of a line from the stock of its item; factory warehouses are not taken.
    With several places the largest quantity wins, then the smaller warehouse id."""
    outside = warehouses.filter(F.col("is_factory") == 0).select(F.col("id").alias("warehouse_id"))
    places = first_rows(
        stock.join(outside, "warehouse_id", "left_semi").select("item_id", "warehouse_id", "quantity"),
        ["item_id"],
        ["-quantity", "warehouse_id"],
    ).select("item_id", F.col("warehouse_id").alias("__place"))
    return (
        lines.join(places, "item_id", "left")
        .withColumn("warehouse_id", F.coalesce("warehouse_id", "__place"))
        .drop("__place")
    )


def open_lines(lines: DataFrame, warehouses: DataFrame, id: str = "id", **options) -> DataFrame:
    """Remaining need, filled flag and scan order of request lines.

    Lines of an item are served by promotion flag, then order, then id. Lines in a factory
    warehouse, or in none, take no part and get scan order 0. A line without a requested quantity
    is never filled.
    """
    outside = (
        warehouses.filter(F.col("is_factory") == 0)
        .select(F.col("id").alias("warehouse_id"), F.lit(1).alias("__outside"))
    )
    got = F.coalesce("quantity9", F.lit(0))
    prepared = lines.join(outside, "warehouse_id", "left").withColumns(
        {
            "is_promotion": F.coalesce("is_promotion", F.lit(0)),
            "remaining": F.col("request_quantity") - got,
            "enough": F.when(F.col("request_quantity").isNull(), 0)
            .when(got < F.col("request_quantity"), 0)
            .otherwise(1),
        }
    )
    served = ordered_scan(
        prepared.filter(F.col("__outside").isNotNull()),
        ["is_promotion", "builtin_order", id],
        ["item_id"],
        number="scan_order",
        **options,
    )
    rest = prepared.filter(F.col("__outside").isNull()).withColumn(
        "scan_order", F.lit(0).cast("bigint")
    )
    return served.unionByName(rest).drop("__outside")


def allocate_fifo(
    supply: DataFrame,
    demand: DataFrame,
    keys: Sequence[str],
    supply_id: str,
    demand_id: str,
    supply_order: Sequence[str],
    demand_order: Sequence[str],
    supply_quantity: str = "quantity",
    demand_quantity: str = "quantity",
    name: str = "allocated",
    **options,
) -> DataFrame:
    """Spread supply over demand, both in order, until one of them is used up.

    Running totals cut the quantity axis of a key into pieces; each piece belongs to the next
    supply end and the next demand end. Both kinds of ends are put in one order and the ids are
    carried back to the piece, so the work grows with the number of rows and not with pairs.
    ``save`` in the options writes the ends of both sides once, as they are read three times.
    """
    keys = list(keys)
    save = options.pop("save", None)

    def ends(df: DataFrame, id: str, order: Sequence[str], quantity: str, as_name: str) -> DataFrame:
        # A key with a NULL part equals no other key, so such rows take no part.
        known = [F.col(k).isNotNull() for k in keys]
        positive = df.filter(reduce(Column.__and__, known, F.col(quantity) > 0))
        totals = ordered_scan(positive, order, keys, running={"__end": quantity}, **options)
        return totals.select(
            *keys, F.col("__end").cast("decimal(38,4)").alias("__end"), F.col(id).alias(as_name)
        )

    both = ends(supply, supply_id, supply_order, supply_quantity, "__s").unionByName(
        ends(demand, demand_id, demand_order, demand_quantity, "__d"), allowMissingColumns=True
    )
    placed = ordered_scan(
        both.withColumn("__kind", F.when(F.col("__s").isNotNull(), 0).otherwise(1)),
        ["__end", "__kind"],
        keys,
        previous={"__start": "__end"},
        fill_up={"__supply": "__s", "__demand": "__d"},
        save=save,
        **options,
    )
    piece = F.col("__end") - F.coalesce("__start", F.lit(0))
    return placed.filter(
        F.col("__supply").isNotNull() & F.col("__demand").isNotNull() & (piece > 0)
    ).select(
        *keys,
        F.col("__supply").alias(supply_id),
        F.col("__demand").alias(demand_id),
        piece.cast("decimal(28,4)").alias(name),
    )


def unmatched_supply(
    supply: DataFrame, lines: DataFrame, mode: int = ISSUE, id: str = "id", **options
) -> DataFrame:
    """A new line for every supply that no request line fits: same item and, for an issue, same
    warehouse. New lines get negative ids after the highest existing one."""
    on = ["item_id", "warehouse_id"] if mode == ISSUE else ["item_id"]
    fitting = lines.select(*on).distinct()
    new = supply.join(fitting, on, "left_anti").select(
        "item_id",
        "warehouse_id",
        "roll_code",
        F.col("quantity").alias("quantity9"),
        "quantity",
        F.lit(0).alias("is_promotion"),
        F.lit(0).alias("enough"),
        F.lit(1).cast("bigint").alias("scan_order"),
    )
    return next_ids(
        new, ["item_id", "warehouse_id", "roll_code"], lines, id, id, negative=True, **options
    )


def receipt_pieces(lines: DataFrame, stock: DataFrame) -> DataFrame:
    """For receipts: a piece of quantity zero for each line of the roll's item."""
    return lines.join(stock.select("item_id", "roll_code").distinct(), "item_id", "left").select(
        "item_id",
        "roll_code",
        F.lit(0).cast("decimal(28,4)").alias("quantity9"),
        F.lit(0).cast("decimal(28,4)").alias("quantity"),
        F.col("id").alias("parent_id"),
    )


def parent_totals(
    lines: DataFrame,
    pieces: DataFrame,
    id: str = "id",
    parent: str = "parent_id",
    columns: Sequence[str] = ("quantity9", "quantity"),
) -> DataFrame:
    """Line quantities as the sum of their pieces; lines without pieces keep theirs."""
    sums = pieces.groupBy(F.col(parent).alias(id)).agg(
        *[F.sum(c).alias(f"__{c}") for c in columns]
    )
    joined = lines.join(sums, id, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}
    ).drop(*[f"__{c}" for c in columns])


def convert_unit(df: DataFrame, items: DataFrame, name: str = "quantity9") -> DataFrame:
    """Quantity in the sales unit: divided by the packing of the item where the line converts."""
    packing = items.select(F.col("id").alias("item_id"), "packing")
    sales = decimal_ratio(F.col("quantity"), F.col("packing"))
    converts = F.coalesce(F.col("convert_rate9") != 1, F.lit(False))
    return df.join(packing, "item_id", "left").withColumn(
        name, F.when(converts, sales).otherwise(F.col("quantity"))
    )


# Documents whose quantities may be counted in the sales unit.
CONVERTING_DOCUMENTS = ("XK", "HD", "DC")


def sales_stock(stock: DataFrame, lines: DataFrame, items: DataFrame | None, doc_code: str = CONVERTING_DOCUMENTS[0]) -> DataFrame:
    """Stock with quantity9, what it holds in the unit of the request lines, and packing, how much of its
    own unit is in one of that. Stock converts if a line of its item does and the document allows it; an
    item that converts without a packing has no quantity9."""
    if items is None or doc_code not in CONVERTING_DOCUMENTS:
        return stock.withColumns({"quantity9": F.col("quantity"), "packing": F.lit(1).cast("decimal(18,2)")})
    rates = lines.filter(F.col("convert_rate9") != 1).groupBy("item_id").agg(F.max("convert_rate9").alias("convert_rate9"))
    converted = convert_unit(stock.join(rates, "item_id", "left"), items)
    return converted.withColumns(
        {
            "quantity9": F.round("quantity9", 4).cast("decimal(28,4)"),
            "packing": F.when(F.col("convert_rate9").isNotNull(), F.col("packing")).otherwise(1).cast("decimal(18,2)"),
        }
    ).drop("convert_rate9")


def scan_out(
    stock: DataFrame, lines: DataFrame, pieces: DataFrame, warehouses: DataFrame, items: DataFrame | None = None,
    doc_code: str = CONVERTING_DOCUMENTS[0], **options,
) -> tuple[DataFrame, DataFrame]:
    """Issue scanned stock to open request lines: the lines with new quantities, and all pieces.

    Stock is divided by the packing of its item first where the item's lines are in the sales unit
    (``items`` has id and packing). A piece holds what is allocated in that unit (quantity9) and times
    the packing (quantity). Stock that fits no line opens a new one, in its own unit. ``save`` in the
    options writes the located lines, the new lines and the new pieces once, as each is read several
    times."""
    save = options.get("save") or (lambda frame, name: frame)
    scans = {k: v for k, v in options.items() if k != "save"}
    located = save(open_lines(fill_location(lines, stock, warehouses), warehouses, **scans), "located-lines")
    supply = sales_stock(stock.filter(F.col("quantity") > 0), located, items, doc_code)
    open_demand = located.filter((F.col("enough") == 0) & (F.col("scan_order") > 0))
    given = allocate_fifo(
        supply, open_demand, ["item_id", "warehouse_id"], "roll_code", "id",
        ["roll_code"], ["scan_order"], "quantity9", "remaining", **options,
    )
    rolls = ["item_id", "warehouse_id", "roll_code"]
    packings = supply.groupBy(*rolls).agg(F.max("packing").alias("packing"))
    fresh = save(unmatched_supply(supply.drop("quantity9", "packing"), located, **scans), "new-lines")
    new_pieces = given.join(packings, rolls).select(
        *rolls,
        F.col("allocated").cast("decimal(28,4)").alias("quantity9"),
        (F.col("allocated") * F.col("packing")).cast("decimal(28,4)").alias("quantity"),
        F.col("id").cast("bigint").alias("parent_id"),
    ).unionByName(
        fresh.select(
            *rolls,
            F.col("quantity9").cast("decimal(28,4)").alias("quantity9"),
            F.col("quantity").cast("decimal(28,4)").alias("quantity"),
            F.col("id").cast("bigint").alias("parent_id"),
        )
    )
    new_pieces = save(new_pieces, "new-pieces")
    numbered = next_ids(new_pieces, ["parent_id", "roll_code"], pieces, "id", "id", negative=True, **scans)
    all_pieces = pieces.unionByName(numbered, allowMissingColumns=True)
    all_lines = located.unionByName(fresh.drop("roll_code"), allowMissingColumns=True)
    return parent_totals(all_lines, all_pieces), all_pieces


LINES, PIECES = "lines", "pieces"


def scan_out_batch(
    spark: SparkSession, root: str, batch: str, stock: DataFrame, warehouses: DataFrame, items: DataFrame | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """Scan out against the lines and pieces that the last batch left below ``root`` and commit both
    together. A batch that is run again gives what it gave, without another allocation; a run that broke
    off between the two tables has changed nothing."""
    if batch not in {b for _, b in committed_versions(spark, root)}:
        now = committed_tables(spark, root, [LINES, PIECES])
        lines, pieces = scan_out(stock, now[LINES], now[PIECES], warehouses, items, **options)
        kept = lines.select(*now[LINES].columns)
        commit_tables(spark, root, batch, {LINES: kept, PIECES: pieces.select(*now[PIECES].columns)})
    done = committed_tables(spark, root, [LINES, PIECES], batch)
    return done[LINES], done[PIECES]
