"""Forensic and exploratory aggregates: the numbers behind each chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.expressions import (
    benford_share,
    days_floor,
    deviation_pct,
    first_digit,
    is_after_hours,
    money,
    month,
)
from tallymark.functions.joins import left_lookup
from tallymark.functions.quantiles import exact_quantiles, histogram, per_label

# Weekday labels by number, Monday first.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def calendar(invoices: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    ts = F.col("invoice_date")
    return (
        invoices.withColumn("invoice_hour", F.hour(ts))
        .withColumn("invoice_dow", F.weekday(ts))
        .withColumn("invoice_month", month(ts))
        .withColumn("invoice_year", F.year(ts))
        .withColumn("is_weekend", F.weekday(ts) >= 5)
        .withColumn("posted_after_hours", is_after_hours(ts, cfg))
        .withColumn("days_to_payment", days_floor(F.col("payment_date"), ts))
    )


def type_counts(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("n"))


def type_exposure(invoices: DataFrame) -> DataFrame:
    return (
        invoices.groupBy("anomaly_type")
        .agg((money(F.sum("invoice_amount")) / 1e6).alias("exposure_millions"))
        .orderBy("exposure_millions", "anomaly_type")
    )


def anomaly_overview(invoices: DataFrame) -> DataFrame:
    return invoices.agg(
        F.sum(F.when(F.col("anomaly_flag") == 1, F.col("invoice_amount"))).alias("anomalous_exposure"),
        (F.sum("anomaly_flag") * 100.0 / F.count("anomaly_flag")).alias("anomaly_rate_pct"),
    )


def log_amount_histogram(invoices: DataFrame, bins: int = 50) -> DataFrame:
    """log10(amount + 1) in equal bins over each label's own range."""
    logs = invoices.filter(F.col("invoice_amount") > 0).select(
        "anomaly_flag", F.log10(money(F.col("invoice_amount")) + 1).alias("log_amount")
    )
    return histogram(logs, "log_amount", bins, "anomaly_flag")


def log_amount_boxes(invoices: DataFrame, chunks: int | None = None) -> DataFrame:
    """Quartiles, whiskers (1.5 IQR) and outlier count of log10(amount) by type."""
    logs = invoices.filter(F.col("invoice_amount") > 0).select(
        "anomaly_type", F.log10(money(F.col("invoice_amount"))).alias("v")
    )
    quartiles = exact_quantiles(logs, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ("anomaly_type",), chunks)
    spread = (F.col("q3") - F.col("q1")) * 1.5
    boxes = quartiles.withColumn("lo", F.col("q1") - spread).withColumn("hi", F.col("q3") + spread)
    box = per_label(boxes, "anomaly_type", ["q1", "median", "q3", "lo", "hi"])
    fenced = logs.withColumn("_b", box[F.col("anomaly_type")]).select("anomaly_type", "v", "_b.*")
    inside = F.col("v").between(F.col("lo"), F.col("hi"))
    return fenced.groupBy("anomaly_type").agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def leading_digits(invoices: DataFrame) -> DataFrame:
    return invoices.withColumn("first_digit", first_digit(F.col("invoice_amount")))


def benford(invoices: DataFrame) -> DataFrame:
    """Observed and expected share per digit and label, also for unseen digits.

    One aggregate row per label holds nine counters; it is then turned into
    nine rows, so nothing is joined.
    """
    digit = first_digit(F.col("invoice_amount"))
    counters = (
        invoices.select("anomaly_flag", digit.alias("d"))
        .filter(F.col("d").isNotNull())
        .groupBy("anomaly_flag")
        .agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("d") == d).alias(f"d{d}") for d in range(1, 10)])
    )
    entries = [F.struct(F.lit(d).alias("digit"), F.col(f"d{d}").alias("observed")) for d in range(1, 10)]
    rows = counters.select("anomaly_flag", "total", F.inline(F.array(*entries)))
    share = benford_share(F.col("digit"))
    return rows.select(
        "anomaly_flag",
        "digit",
        "observed",
        (F.col("observed") * 100.0 / F.col("total")).alias("observed_pct"),
        (share * 100.0).alias("expected_pct"),
        (share * F.col("total")).alias("expected"),
    )


def benford_test(invoices: DataFrame) -> DataFrame:
    """Chi-square statistic against Benford and its p-value, per label.

    With 8 degrees of freedom (even) the survival function is the finite sum
    exp(-h) * (1 + h + h^2/2 + h^3/6) at h = statistic / 2.
    """
    gap = F.col("observed") - F.col("expected")
    h = F.col("chi_square") / 2
    return (
        benford(invoices)
        .groupBy("anomaly_flag")
        .agg(F.sum(gap * gap / F.col("expected")).alias("chi_square"))
        .withColumn("p_value", F.exp(-h) * (1 + h + h * h / 2 + h * h * h / 6))
    )


def _label_counts() -> list[Column]:
    return [
        F.count_if(F.col("anomaly_flag") == 0).alias("normal"),
        F.count_if(F.col("anomaly_flag") == 1).alias("anomalous"),
    ]


def by_hour(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(F.hour("invoice_date").alias("invoice_hour")).agg(*_label_counts())


def by_weekday(invoices: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    counts = invoices.groupBy(F.weekday("invoice_date").alias("invoice_dow")).agg(*_label_counts())
    return counts.withColumn("day_name", F.get(names, F.col("invoice_dow")))


def by_month(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(
        F.date_format("invoice_date", "yyyy-MM").alias("invoice_month")
    ).agg(*_label_counts())


def payment_speed(invoices: DataFrame, bins: int = 40, cap: int = 120) -> DataFrame:
    days = days_floor(F.col("payment_date"), F.col("invoice_date"))
    paid = invoices.select("anomaly_flag", days.alias("d")).filter(F.col("d") > 0)
    clipped = paid.select("anomaly_flag", F.least("d", F.lit(cap)).cast("double").alias("d"))
    return histogram(clipped, "d", bins, "anomaly_flag")


def vendor_stats(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    """Totals, counts, mean and anomaly rate per vendor, with master data."""
    stats = (
        invoices.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(
            F.sum("invoice_amount").alias("total_invoiced"),
            F.count("invoice_number").alias("invoice_count"),
            F.sum("anomaly_flag").alias("anomaly_count"),
            (money(F.sum("invoice_amount")) / F.count("invoice_amount")).alias("avg_amount"),
        )
        .withColumn("anomaly_rate", F.col("anomaly_count") / F.col("invoice_count"))
    )
    master = vendors.select("vendor_id", "vendor_name", "vendor_category", "is_ghost_vendor")
    return stats.join(master, "vendor_id", "left")


def top_vendors(invoices: DataFrame, vendors: DataFrame, n: int = 15) -> DataFrame:
    return (
        vendor_stats(invoices, vendors)
        .orderBy(F.desc("total_invoiced"), "vendor_id")
        .limit(n)
        .select(
            "vendor_id",
            "vendor_name",
            (money(F.col("total_invoiced")) / 1e6).alias("total_millions"),
            "is_ghost_vendor",
        )
    )


def rate_vs_volume(invoices: DataFrame, vendors: DataFrame) -> DataFrame:
    return vendor_stats(invoices, vendors).select(
        "vendor_id", "invoice_count", (F.col("anomaly_rate") * 100).alias("anomaly_rate_pct"), "total_invoiced"
    )


def high_rate_vendors(invoices: DataFrame, vendors: DataFrame, rate: float = 0.1) -> DataFrame:
    return vendor_stats(invoices, vendors).filter(F.col("anomaly_rate") > rate)


def spend_concentration(invoices: DataFrame, n: int = 10) -> DataFrame:
    """Share of spend with the n largest vendors, one row."""
    totals = (
        invoices.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(F.sum("invoice_amount").alias("total"))
    )
    top = totals.orderBy(F.desc("total"), "vendor_id").limit(n).agg(F.sum("total").alias("top_total"))
    everything = totals.agg(F.sum("total").alias("t")).scalar()
    return top.select(
        F.try_divide(money(F.col("top_total")) * 100.0, money(everything)).alias("top_share_pct")
    )


# --- order match ------------------------------------------------------------


def match_rows(invoices: DataFrame, purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Deviation from the order and pass flag for invoices that name one.

    An order that is missing or worth 0 has no deviation and does not pass.
    """
    named = invoices.filter(F.col("po_number").isNotNull())
    joined = left_lookup(
        named, purchase_orders.select("po_number", "total_po_value"), "po_number", "invoice_number"
    )
    amount, base = F.col("invoice_amount"), F.col("total_po_value")
    within = F.abs(amount - base) <= F.lit(cfg.match_tolerance) * F.abs(base)
    return joined.withColumn("match_deviation_pct", deviation_pct(amount, base)).withColumn(
        "match_pass", F.coalesce((base != 0) & within, F.lit(False))
    )


def match_rate(invoices: DataFrame, purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    return match_rows(invoices, purchase_orders, cfg).agg(
        F.count(F.lit(1)).alias("matched_rows"),
        F.count_if("match_pass").alias("passed"),
        (F.count_if("match_pass") * 100.0 / F.count(F.lit(1))).alias("match_pass_rate"),
    )


def deviation_histogram(invoices: DataFrame, purchase_orders: DataFrame, bins: int = 80) -> DataFrame:
    rows = match_rows(invoices, purchase_orders).filter(F.col("match_deviation_pct").isNotNull())
    clipped = rows.select(
        F.least(F.greatest("match_deviation_pct", F.lit(-50.0)), F.lit(50.0)).alias("d")
    )
    return histogram(clipped, "d", bins)


def failure_by_category(
    invoices: DataFrame, purchase_orders: DataFrame, vendors: DataFrame, cfg: AuditConfig = DEFAULT
) -> DataFrame:
    rows = match_rows(invoices, purchase_orders, cfg).join(
        vendors.select("vendor_id", "vendor_category"), "vendor_id"
    )
    return (
        rows.filter(F.col("vendor_category").isNotNull())
        .groupBy("vendor_category")
        .agg(F.count_if("match_pass").alias("passed"), F.count(F.lit(1)).alias("n"))
        .withColumn("fail_rate", (1 - F.col("passed") / F.col("n")) * 100)
        .orderBy("fail_rate", "vendor_category")
    )


# --- budget, threshold, summary ---------------------------------------------


def budget_bands(budget: DataFrame) -> DataFrame:
    used = F.col("budget_utilisation_pct")
    return budget.select(
        F.concat("cost_centre", F.lit(" ("), "budget_period", F.lit(")")).alias("label"),
        used.alias("utilisation_pct"),
        F.when(used > 100, "Overrun").when(used > 90, "At Risk").otherwise("Normal").alias("band"),
    ).orderBy("utilisation_pct", "label")


def budget_counts(budget: DataFrame) -> DataFrame:
    used = F.col("budget_utilisation_pct")
    return budget.agg(
        F.count_if(used > 100).alias("overrun_count"),
        F.count_if((used > 90) & (used <= 100)).alias("at_risk_count"),
    )


def threshold_clustering(
    invoices: DataFrame, cfg: AuditConfig = DEFAULT, window: str = "0.10"
) -> DataFrame:
    """Invoices just below the approval threshold against the band before it."""
    t = F.lit(cfg.approval_threshold)
    w = F.lit(window).cast("decimal(3,2)")
    a = F.col("invoice_amount")
    near_from, far_from = t * (1 - w), t * (1 - w * 3)
    near, far = F.col("near_count"), F.col("far_count")
    return invoices.agg(
        F.count_if((a >= near_from) & (a < t)).alias("near_count"),
        F.count_if((a >= far_from) & (a < near_from)).alias("far_count"),
    ).withColumn("ratio", near / F.greatest(far, F.lit(1)))


def threshold_histogram(invoices: DataFrame, cfg: AuditConfig = DEFAULT, bins: int = 60) -> DataFrame:
    t = float(cfg.approval_threshold)
    a = money(F.col("invoice_amount"))
    rows = invoices.select(a.alias("a")).filter((F.col("a") > t * 0.5) & (F.col("a") < t * 1.2))
    return histogram(rows, "a", bins)


def summary(
    invoices: DataFrame, purchase_orders: DataFrame, budget: DataFrame, cfg: AuditConfig = DEFAULT
) -> DataFrame:
    """One row with the figures of the closing overview."""
    row = invoices.agg(
        (F.sum("anomaly_flag") * 100.0 / F.count("anomaly_flag")).alias("anomaly_rate_pct"),
        F.sum(F.when(F.col("anomaly_flag") == 1, F.col("invoice_amount"))).alias("anomalous_exposure"),
        F.count_if(is_after_hours(F.col("invoice_date"), cfg)).alias("after_hours_count"),
        F.count_if("is_maverick").alias("maverick_count"),
    )
    return row.withColumn(
        "match_pass_rate",
        match_rate(invoices, purchase_orders, cfg).select("match_pass_rate").scalar(),
    ).withColumn("overrun_count", budget_counts(budget).select("overrun_count").scalar())
