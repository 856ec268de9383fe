"""Ten risk features per invoice, and their robust scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, FEATURES, AuditConfig
from tallymark.functions.expressions import (
    benford_share,
    days_floor,
    finite_or_zero,
    first_digit,
    is_after_hours,
    is_round,
    month,
)
from tallymark.functions.joins import left_lookup
from tallymark.functions.quantiles import column_quantiles

#: Columns that `assemble` looks up in the other tables.
LOOKED_UP = ("total_po_value", "vendor_creation_date", "vendor_category", "is_ghost_vendor", "cc_budget", "cc_actual")


def vendor_profile(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """One row per vendor seen on invoices: amount statistics and master data.

    The statistics are grouped (map-side combined) and joined back, so a hot
    vendor is never sorted or held in one task as a window would.
    """
    amount = F.col("invoice_amount").cast("double")
    stats = (
        invoices.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(F.avg(amount).alias("vendor_mean"), F.stddev_samp(amount).alias("vendor_std"))
    )
    master = vendors.select("vendor_id", "vendor_creation_date", "vendor_category", "is_ghost_vendor")
    return stats.join(master, "vendor_id", "left")


def _monthly_counts(invoices: DataFrame) -> DataFrame:
    """(vendor_id, _by_month): a map from calendar month to number of invoices, so that one join by
    vendor brings them with the vendor's other figures."""
    counts = (
        invoices.filter(F.col("vendor_id").isNotNull() & F.col("invoice_date").isNotNull())
        .groupBy("vendor_id", month(F.col("invoice_date")).alias("_month"))
        .agg(F.count("invoice_number").alias("_n"))
    )
    return counts.groupBy("vendor_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_month", "_n"))).alias("_by_month")
    )


def assemble(
    invoices: DataFrame, vendors: DataFrame, purchase_orders: DataFrame, budget: DataFrame
) -> DataFrame:
    """Invoices with vendor, order, budget and monthly-frequency columns."""
    centre = budget.groupBy("cost_centre").agg(
        F.sum("approved_budget").alias("cc_budget"), F.sum("actual_spend").alias("cc_actual")
    )
    # the order first, while rows are at their narrowest
    with_order = left_lookup(
        invoices, purchase_orders.select("po_number", "total_po_value"), "po_number", "invoice_number"
    )
    profile = vendor_profile(invoices, vendors).join(_monthly_counts(invoices), "vendor_id", "left")
    with_vendor = left_lookup(with_order, profile, "vendor_id", "invoice_number").withColumn(
        "month_count", F.try_element_at("_by_month", month(F.col("invoice_date")))
    )
    return left_lookup(with_vendor.drop("_by_month"), centre, "cost_centre", "invoice_number")


def add_features(df: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """The ten features over an assembled frame; missing or infinite becomes 0."""
    amount = F.col("invoice_amount").cast("double")
    po_value = F.col("total_po_value").cast("double")
    cc_budget = F.col("cc_budget").cast("double")
    std = F.when(F.col("vendor_std") == 0, F.lit(1.0)).otherwise(F.col("vendor_std"))
    digit = first_digit(F.col("invoice_amount"))
    age = days_floor(F.col("invoice_date"), F.col("vendor_creation_date"))
    exprs = {
        "feat_amount_zscore": F.try_divide(amount - F.col("vendor_mean"), std),
        "feat_invoice_to_po_ratio": F.when(po_value > 0, amount / po_value).otherwise(1.5),
        # greatest skips NULLs, so an unknown age is replaced before clipping
        "feat_vendor_age_days": F.greatest(F.coalesce(age, F.lit(365)), F.lit(0)),
        "feat_days_to_payment": F.least(
            F.greatest(
                F.coalesce(days_floor(F.col("payment_date"), F.col("invoice_date")), F.lit(90)), F.lit(0)
            ),
            F.lit(200),
        ),
        "feat_vendor_monthly_freq": F.col("month_count"),
        "feat_pct_of_cc_budget": F.least(
            F.greatest(F.when(cc_budget > 0, amount / cc_budget).otherwise(0.5), F.lit(0.0)), F.lit(5.0)
        ),
        "feat_after_hours": is_after_hours(F.col("invoice_date"), cfg).cast("int"),
        "feat_no_po": F.col("po_number").isNull().cast("int"),
        "feat_round_number": is_round(F.col("invoice_amount"), cfg).cast("int"),
        "feat_benford_dev": F.abs(F.lit(1.0) / F.lit(9.0) - benford_share(digit)),
    }
    return df.select(
        "*", *[finite_or_zero(exprs[f].cast("double")).alias(f) for f in FEATURES]
    ).drop("vendor_mean", "vendor_std", "month_count")


def build_features(
    invoices: DataFrame,
    vendors: DataFrame,
    purchase_orders: DataFrame,
    budget: DataFrame,
    cfg: AuditConfig = DEFAULT,
) -> DataFrame:
    return add_features(assemble(invoices, vendors, purchase_orders, budget), cfg)


def scaler(features: DataFrame, chunks: int | None = None) -> DataFrame:
    """Median, quartiles and scale per feature, fitted on all rows.

    All features are quantiled at once, without a row per feature. A feature without spread
    keeps scale 1.
    """
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    found = column_quantiles(features, {f: (F.col(f), quartiles) for f in FEATURES}, chunks)
    rows = [(f, found[f]["n"], *[found[f][q] for q in quartiles]) for f in FEATURES if found[f]["n"]]
    q = features.sparkSession.createDataFrame(rows, "feature string, n bigint, p25 double, p50 double, p75 double")
    iqr = F.col("p75") - F.col("p25")
    return q.withColumn("scale", F.when(iqr == 0, F.lit(1.0)).otherwise(iqr))


def scale(features: DataFrame, fitted: DataFrame) -> DataFrame:
    """Add `scaled`: array of (x - median) / scale in feature order. The fitted
    table has ten rows and enters as a scalar map."""
    pairs = F.struct("feature", F.struct("p50", "scale"))
    table = fitted.agg(F.map_from_entries(F.collect_list(pairs)).alias("m")).scalar()
    cols = [
        (F.col(f) - table[f]["p50"]) / table[f]["scale"] for f in FEATURES
    ]
    return features.withColumn("scaled", F.array(*cols))
