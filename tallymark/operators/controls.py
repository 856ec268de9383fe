"""Control tests: small ranked listings an audit team reads first.

Every limit has a unique last sort column, so the listing is deterministic
and runs as a distributed top-k.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.expressions import deviates, is_after_hours, month
from tallymark.functions.ordering import global_rank


def po_deviation(
    invoices: DataFrame, purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = 50
) -> DataFrame:
    """Invoices further than the tolerance from their order's value."""
    orders = purchase_orders.filter(F.col("total_po_value") > 0).select("po_number", "total_po_value")
    gap = F.col("invoice_amount") - F.col("total_po_value")
    ordered = (
        invoices.join(orders, "po_number")
        .filter(deviates(F.col("invoice_amount"), F.col("total_po_value"), cfg.match_tolerance))
        .withColumn("_relative", F.abs(gap) / F.col("total_po_value"))
        .orderBy(F.desc("_relative"), "invoice_number")
    )
    return _first(ordered, limit).select(
            "invoice_number",
            "invoice_date",
            "vendor_id",
            F.col("total_po_value").alias("po_amount"),
            "invoice_amount",
            F.round(gap * 100 / F.col("total_po_value"), 2).alias("deviation_pct"),
            "invoice_status",
            "anomaly_type",
        )


def _first(ordered: DataFrame, limit: int | None) -> DataFrame:
    """The listing's top, or all of it."""
    return ordered if limit is None else ordered.limit(limit)


def _with_members(
    rows: DataFrame, groups: DataFrame, order: list, keys: list[str], member: str, limit: int | None
) -> DataFrame:
    """One row per member of the top groups, with the group's rank.

    With a limit the groups are few and are ranked in one window and
    broadcast; without one they are ranked along a global order. NULL keys
    form groups as in SQL.
    """
    if limit is None:
        ranked = global_rank(groups, order, "group_rank")
    else:
        top = groups.orderBy(*order).limit(limit)
        ranked = F.broadcast(top.withColumn("group_rank", F.row_number().over(Window.orderBy(*order))))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return rows.alias("r").join(ranked.alias("t"), same).select("t.group_rank", *[f"t.{c}" for c in groups.columns], f"r.{member}")


def same_amount_month(
    invoices: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = 30
) -> DataFrame:
    """Members of vendor, amount and month seen more than once, largest groups first."""
    keys = ["vendor_id", "invoice_amount", "invoice_month"]
    rows = (
        invoices.filter(F.col("invoice_amount") > 0)
        .withColumn("invoice_month", month(F.col("invoice_date")))
        .select(*keys, "invoice_number")
    )
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("invoice_count")).filter(F.col("invoice_count") > 1)
    return _with_members(rows, groups, [F.desc("invoice_count"), *keys], keys, "invoice_number", limit)


def split_orders_by_month(
    purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = 30
) -> DataFrame:
    """Members of groups of approved orders below the threshold that exceed it together in a month."""
    keys = ["vendor_id", "po_month"]
    rows = (
        purchase_orders.filter(
            (F.col("total_po_value") < F.lit(cfg.approval_threshold))
            & (F.col("approval_status") == "Approved")
        )
        .withColumn("po_month", month(F.col("po_date")))
        .select(*keys, "po_number", "total_po_value")
    )
    groups = (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("po_count"),
            F.sum("total_po_value").alias("total_combined_value"),
            F.max("total_po_value").alias("max_single_po"),
        )
        .filter((F.col("po_count") > 1) & (F.col("total_combined_value") > F.lit(cfg.approval_threshold)))
    )
    return _with_members(rows, groups, [F.desc("total_combined_value"), *keys], keys, "po_number", limit)


def no_order(invoices: DataFrame, vendors: DataFrame, limit: int | None = 50) -> DataFrame:
    """Largest invoices without an order, of known vendors."""
    names = vendors.select("vendor_id", "vendor_name", "vendor_category")
    ordered = (
        invoices.filter(F.col("po_number").isNull())
        .join(names, "vendor_id")
        .orderBy(F.desc("invoice_amount"), "invoice_number")
    )
    return _first(ordered, limit).select(
            "invoice_number", "invoice_date", "vendor_id", "vendor_name", "vendor_category",
            "invoice_amount", "invoice_status", "processed_by",
        )


def after_hours(invoices: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = 50) -> DataFrame:
    """Earliest postings at night or on a weekend; day_of_week 0 is Sunday."""
    dow = F.dayofweek("invoice_date") - 1
    ordered = (
        invoices.filter(is_after_hours(F.col("invoice_date"), cfg))
        .orderBy("invoice_date", "invoice_number")
    )
    return _first(ordered, limit).select(
            "invoice_number",
            "invoice_date",
            F.hour("invoice_date").alias("posting_hour"),
            dow.alias("day_of_week"),
            F.when(dow == 0, "Sunday").when(dow == 6, "Saturday").otherwise("Weekday").alias("day_type"),
            "vendor_id",
            "invoice_amount",
            "processed_by",
        )


def budget_overruns(budget: DataFrame) -> DataFrame:
    over = F.col("actual_spend") - F.col("approved_budget")
    return (
        budget.filter(F.col("actual_spend") > F.col("approved_budget"))
        .select(
            "cost_centre",
            "department",
            "budget_period",
            "approved_budget",
            "actual_spend",
            F.round(over, 2).alias("overrun_amount"),
            F.round("budget_utilisation_pct", 1).alias("utilisation_pct"),
        )
        .orderBy(F.desc("overrun_amount"), "cost_centre", "budget_period")
    )


def early_first_use(
    invoices: DataFrame, vendors: DataFrame, cfg: AuditConfig = DEFAULT, limit: int | None = 30
) -> DataFrame:
    """Vendors whose first invoice came within days of their creation.

    Invoices are reduced to one row per vendor before the join.
    """
    first = invoices.groupBy("vendor_id").agg(
        F.to_date(F.min("invoice_date")).alias("first_invoice_date"),
        F.sum("invoice_amount").alias("total_invoiced"),
        F.count("invoice_number").alias("invoice_count"),
    )
    ordered = (
        vendors.join(first, "vendor_id")
        .withColumn(
            "days_to_first_invoice", F.datediff("first_invoice_date", "vendor_creation_date")
        )
        .filter(F.col("days_to_first_invoice") <= cfg.new_vendor_days)
        .orderBy("days_to_first_invoice", "vendor_id")
    )
    return _first(ordered, limit).select(
            "vendor_id", "vendor_name", "vendor_creation_date", "created_by_user",
            "contact_email", "first_invoice_date", "days_to_first_invoice",
            "total_invoiced", "invoice_count", "is_ghost_vendor",
        )
