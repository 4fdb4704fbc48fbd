"""Balanced stock documents made from quality results.

A result row holds (row_id, item_id_delivery, warehouse_id_delivery, quantity9, item_id_receipt,
warehouse_id_receipt, receipt_quantity, lot_code, lot_code_t5, roll_code, customer_id, trans_code,
description, doc_date). Every result becomes one document with a receipt and a delivery.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import decimal_ratio
from tallyworks.operators.ordering import number_rows
from tallyworks.operators.stock import ISSUE, RECEIPT

# Fixed value: first letters of the document number.
NUMBER_PREFIX = "LR"
CREATED_REMARK = "Đã tạo phiếu xuất lắp ráp"


def same_warehouse(results: DataFrame) -> DataFrame:
    """The delivery leaves from the warehouse that receives."""
    return results.withColumn("warehouse_id_delivery", F.col("warehouse_id_receipt"))


def batch_values(results: DataFrame, columns: Sequence[str], order: str = "row_id") -> Column:
    """Values that hold for the whole batch: for each column that of the first row that has one,
    as one struct from one pass."""

    def first_known(column: str) -> Column:
        known = F.col(column).isNotNull() & (F.col(column).cast("string") != "")
        return F.min_by(column, F.when(known, F.col(order))).alias(column)

    return results.agg(F.struct(*[first_known(c) for c in columns])).scalar()


def document_headers(results: DataFrame, context: Mapping[str, Any]) -> DataFrame:
    """One header per result. Customer, transaction code, description and date are the same on
    all documents of the batch; ``context`` adds constants such as branch and user."""
    batch = batch_values(results, ["customer_id", "trans_code", "description", "doc_date"])
    return results.select(
        F.col("row_id").alias("source_row_id"),
        F.col("item_id_delivery").alias("order_item_id"),
        F.col("item_id_receipt").alias("item_id"),
        F.col("warehouse_id_receipt").alias("warehouse_id"),
        F.col("receipt_quantity").alias("quantity"),
        batch.getField("customer_id").alias("customer_id"),
        batch.getField("trans_code").alias("trans_code"),
        F.coalesce(batch.getField("description"), F.lit("")).alias("description"),
        batch.getField("doc_date").alias("doc_date"),
        F.lit(ISSUE).alias("doc_group"),
        *[F.lit(v).alias(k) for k, v in context.items()],
    )


def document_numbers(
    headers: DataFrame, existing: DataFrame, number_format: str, month: int, year: int, **options
) -> DataFrame:
    """Document number prefix/month/year-sequence, after the highest number with the prefix."""
    prefix = NUMBER_PREFIX + number_format
    # The highest number, not the highest text: texts of other months or lengths sort otherwise.
    last = F.substring_index("doc_no", "-", -1).try_cast("bigint")
    taken = existing.filter(F.col("doc_no").startswith(prefix)).agg(
        F.coalesce(F.max(last), F.lit(0))
    ).scalar()
    numbered = number_rows(headers, ["order_item_id", "source_row_id"], "__n", **options)
    number = (F.col("__n") + taken).cast("string")
    # Padding to a fixed width would cut longer numbers.
    sequence = F.when(F.length(number) >= 6, number).otherwise(F.lpad(number, 6, "0"))
    stem = f"{prefix}/{month:02d}/{year % 100:02d}-"
    return numbered.withColumn("doc_no", F.concat(F.lit(stem), sequence)).drop("__n")


def movement_lines(results: DataFrame, warehouses: DataFrame, items: DataFrame) -> DataFrame:
    """A receipt and a delivery line per result, in the same warehouse. Both debit the account
    of the receiving side and credit that of the delivering side."""
    accounts = warehouses.select("id", "account")
    receiving = accounts.select(F.col("id").alias("warehouse_id_receipt"), F.col("account").alias("debit_account"))
    delivering = accounts.select(F.col("id").alias("__from"), F.col("account").alias("credit_account"))
    moved = (
        same_warehouse(results)
        .withColumn("__from", F.col("warehouse_id_delivery"))
        .join(receiving, "warehouse_id_receipt", "left")
        .join(delivering, "__from", "left")
    )
    receipt = F.struct(
        F.lit(RECEIPT).alias("doc_group"),
        F.col("item_id_receipt").alias("item_id"),
        F.col("warehouse_id_receipt").alias("warehouse_id"),
        F.col("receipt_quantity").cast("decimal(18,4)").alias("quantity"),
        F.col("lot_code").alias("lot_code"),
    )
    delivery = F.struct(
        F.lit(ISSUE).alias("doc_group"),
        F.col("item_id_delivery").alias("item_id"),
        F.col("warehouse_id_delivery").alias("warehouse_id"),
        F.col("quantity9").cast("decimal(18,4)").alias("quantity"),
        F.col("lot_code_t5").alias("lot_code"),
    )
    lines = moved.select(
        F.col("row_id").alias("source_row_id"),
        F.explode(F.array(receipt, delivery)).alias("m"),
        "debit_account",
        "credit_account",
        "roll_code",
    ).select("source_row_id", "m.*", "debit_account", "credit_account", "roll_code")
    units = items.select(F.col("id").alias("item_id"), "unit")
    named = lines.join(units, "item_id", "left")
    return named.withColumn("line_id", F.concat_ws("-", "source_row_id", "doc_group"))


def piece_rows(lines: DataFrame) -> DataFrame:
    """Physical pieces of both directions, linked to their lines."""
    return lines.select(
        F.concat(F.lit("P"), "line_id").alias("piece_id"),
        "line_id", "source_row_id", "doc_group", "item_id", "warehouse_id", "quantity", "unit",
        "roll_code", F.coalesce("lot_code", F.lit("")).alias("lot_code"),
    )


def child_counts(lines: DataFrame, pieces: DataFrame, items: DataFrame) -> DataFrame:
    """Rolls and barrels of the delivery lines."""
    rolls = pieces.groupBy("line_id").agg(F.count("piece_id").alias("total_roll"))
    packing = items.select(F.col("id").alias("item_id"), "packing")
    barrels = F.round(decimal_ratio(F.col("quantity"), F.col("packing")), 2)
    return (
        lines.filter(F.col("doc_group") == ISSUE)
        .join(rolls, "line_id", "left")
        .join(packing, "item_id", "left")
        .withColumn(
            "barrel_quantity", F.when(F.col("packing").isNotNull(), barrels).otherwise(0).cast("decimal(18,2)")
        )
    )


def replace_by_source(
    headers: DataFrame, dependents: Mapping[str, DataFrame], results: DataFrame, branch: str
) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """Stored documents without those made from the same source rows before: headers, dependent
    tables (by header id), and one row with the dates that must be posted again."""
    sources = results.select(F.col("row_id").alias("source_row_id")).distinct()
    old = headers.filter(F.col("branch_code") == branch).join(sources, "source_row_id", "left_semi")
    gone = old.select("header_id").distinct()
    span = old.agg(
        F.min("doc_date").alias("first_date"),
        F.max("doc_date").alias("last_date"),
        (F.count(F.lit(1)) > 0).alias("post_again"),
    )
    kept = headers.join(gone, "header_id", "left_anti")
    return kept, {n: d.join(gone, "header_id", "left_anti") for n, d in dependents.items()}, span


def result_labels(
    results: DataFrame, items: DataFrame, warehouses: DataFrame, documents: DataFrame
) -> DataFrame:
    """Codes and names of items and warehouses in both roles, with the source document number."""

    def named(df: DataFrame, table: DataFrame, id: str, what: str) -> DataFrame:
        role = id.rsplit("_", 1)[1]
        labels = table.select(
            F.col("id").alias(id),
            F.col("code").alias(f"{what}_code_{role}"),
            F.col("name").alias(f"{what}_name_{role}"),
        )
        return df.join(labels, id, "left")

    out = same_warehouse(results).join(
        documents.select("row_id", F.col("doc_no").alias("source_doc_no")), "row_id", "left"
    )
    for role in ("delivery", "receipt"):
        out = named(out, items, f"item_id_{role}", "item")
        out = named(out, warehouses, f"warehouse_id_{role}", "warehouse")
    return out.withColumn("remark", F.lit(CREATED_REMARK))
