"""Composite 0-100 risk score, tiers, case queue and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, TIERS, AuditConfig
from tallymark.functions.expressions import fixed, money, tier
from tallymark.functions.joins import left_lookup
from tallymark.functions.ordering import global_rank
from tallymark.operators.metrics import minmax



def tier_meaning(cfg: AuditConfig = DEFAULT) -> dict[str, str]:
    """What a score in each tier's range says about its parts, from weights and limits."""
    ml, rule, value = (round(100 * w) for w in (cfg.weight_ml, cfg.weight_rule, cfg.weight_value))
    top, high, medium = (f"{t:g}" for t in (cfg.tier_critical, cfg.tier_high, cfg.tier_medium))
    return {
        "Critical": f"{top} points or more out of {ml} for the models, {rule} for rules and {value} for the amount: at most one of the three can be small.",
        "High": f"{high} to under {top} points: more than any one of models, rules and amount can give.",
        "Medium": f"{medium} to under {high} points: models or rules alone can give as much.",
        "Low": f"Under {medium} points: what the amount alone can give, or traces of several parts.",
    }


TIER_MEANING = tier_meaning()
TIER_ACTION = {
    "Critical": "Front of the queue; left out of payment runs until someone has cleared it.",
    "High": "Next in the queue by score; compare with order, receipt and earlier invoices.",
    "Medium": "Look at it where a vendor or cost centre has several of these.",
    "Low": "Stays in the table and is scored again with the next run.",
}

# Columns of the wide export, in order.
EXPORT_COLUMNS = (
    "invoice_number", "invoice_date", "due_date", "payment_date", "vendor_id", "po_number",
    "gr_number", "invoice_amount", "tax_amount", "total_amount", "invoice_status", "cost_centre",
    "department", "composite_risk_score", "risk_tier", "ml_component", "rule_component",
    "value_component", "rule_triggered", "rule_risk_score", "full_explanation",
    "tier_recommended_action", "anomaly_flag", "anomaly_type", "iso_score", "ae_score",
    "ensemble_score", "feat_amount_zscore", "feat_invoice_to_po_ratio", "feat_vendor_age_days",
    "feat_days_to_payment", "feat_after_hours", "feat_no_po", "feat_round_number",
)


def attach_rules(scored: DataFrame, report: DataFrame) -> DataFrame:
    """Strongest rule hit per invoice; 0 and "None" where there is none."""
    hits = report.select(
        "invoice_number",
        "rule_triggered",
        F.col("risk_score").alias("rule_risk_score"),
        F.col("explanation").alias("rule_explanation"),
        F.col("recommended_action").alias("rule_recommended_action"),
    )
    return (
        scored.join(hits, "invoice_number", "left")
        .withColumn("rule_risk_score", F.coalesce("rule_risk_score", F.lit(0)))
        .withColumn("rule_triggered", F.coalesce("rule_triggered", F.lit("None")))
    )


def _lookup(values: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)


def add_scores(
    df: DataFrame, cfg: AuditConfig = DEFAULT, ranges_from: DataFrame | None = None
) -> DataFrame:
    """Components, composite score (half-even to one digit), tier and tier text.

    `df` needs ensemble_score, rule_risk_score and invoice_amount. The ranges
    for the two min-max components are scalar subqueries over `ranges_from`,
    the same rows before any join (default: `df`).
    """
    log_amount = F.log1p(F.greatest(money(F.col("invoice_amount")), F.lit(0.0)))
    base = (df if ranges_from is None else ranges_from).withColumn("log_amount", log_amount)
    out = (
        df.withColumn("log_amount", log_amount)
        .withColumn("ml_component", minmax(base, "ensemble_score", 100.0))
        .withColumn("rule_component", F.col("rule_risk_score").cast("double") * 10)
        .withColumn("value_component", minmax(base, "log_amount", 100.0))
    )
    total = (
        F.lit(cfg.weight_ml) * F.col("ml_component")
        + F.lit(cfg.weight_rule) * F.col("rule_component")
        + F.lit(cfg.weight_value) * F.col("value_component")
    )
    return (
        out.withColumn("composite_risk_score", F.rint(total * 10) / 10)
        .withColumn(
            "risk_tier",
            tier(F.col("composite_risk_score"), cfg.tier_critical, cfg.tier_high, cfg.tier_medium),
        )
        .withColumn("tier_definition", _lookup(TIER_MEANING, F.col("risk_tier")))
        .withColumn("tier_recommended_action", _lookup(TIER_ACTION, F.col("risk_tier")))
    )


def add_explanation(df: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    rule_part = F.when(F.col("rule_triggered") != "None", F.col("rule_explanation"))
    model_part = F.when(
        F.col("ml_component") > cfg.strong_outlier,
        F.concat(
            F.lit("The models see a strong outlier (ensemble score in the top "),
            fixed(F.lit(100.0) - F.col("ml_component"), 0),
            F.lit("% of its range)."),
        ),
    )
    joined = F.concat_ws(" ", rule_part, model_part)
    default = "No rule hit and no strong model signal; kept for completeness."
    return df.withColumn(
        "full_explanation", F.when(joined == "", F.lit(default)).otherwise(joined)
    )


def rated(scored: DataFrame, report: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Scored invoices + exceptions report -> scores and tiers."""
    return add_scores(attach_rules(scored, report), cfg, scored)


def risk_frame(scored: DataFrame, report: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Scored invoices + exceptions report -> scores, tiers and explanation."""
    return add_explanation(rated(scored, report, cfg), cfg)


def _is_priority() -> Column:
    return F.col("risk_tier").isin("Critical", "High")


def tier_distribution(risk: DataFrame) -> DataFrame:
    """Count and percent for each of the four tiers, zero where absent: one
    aggregate row turned into four."""
    counts = risk.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col("risk_tier") == t).alias(t) for t in TIERS]
    )
    entries = [
        F.struct(F.lit(i + 1).alias("tier_order"), F.lit(t).alias("risk_tier"), F.col(t).alias("n"))
        for i, t in enumerate(TIERS)
    ]
    return counts.select("_all", F.inline(F.array(*entries))).select(
        "tier_order", "risk_tier", "n",
        F.coalesce(F.try_divide(F.col("n") * 100.0, F.col("_all")), F.lit(0.0)).alias("pct"),
    )


def exposure_by_tier(risk: DataFrame) -> DataFrame:
    """Sum, mean and count per tier, plus the Critical + High total."""
    amounts = risk.select("risk_tier", "invoice_amount")
    labelled = amounts.withColumn(
        "risk_tier",
        F.explode(F.array_compact(F.array("risk_tier", F.when(_is_priority(), "Critical+High")))),
    )
    return labelled.groupBy("risk_tier").agg(
        F.sum("invoice_amount").alias("total"),
        (F.sum("invoice_amount").cast("double") / F.count("invoice_amount")).alias("mean"),
        F.count("invoice_amount").alias("n"),
    )


def audit_efficiency(risk: DataFrame) -> DataFrame:
    return risk.agg(
        F.count(F.lit(1)).alias("total_transactions"), F.count_if(_is_priority()).alias("needs_review")
    ).select(
        "total_transactions",
        "needs_review",
        (F.col("total_transactions") - F.col("needs_review")).alias("auto_cleared"),
        F.try_divide(
            (F.col("total_transactions") - F.col("needs_review")) * 100.0, F.col("total_transactions")
        ).alias("efficiency_pct"),
    )


def case_queue(risk: DataFrame, chunks: int | None = None) -> DataFrame:
    """All invoices ranked 1..n by score, then invoice number."""
    ranks = global_rank(
        risk.select("invoice_number", "composite_risk_score"),
        [F.desc("composite_risk_score"), F.asc("invoice_number")],
        "priority_rank",
        chunks,
    ).select("invoice_number", "priority_rank")
    return risk.join(ranks, "invoice_number").select(
        "priority_rank", "invoice_number", "invoice_date", "vendor_id", "invoice_amount",
        "composite_risk_score", "risk_tier", "rule_triggered", "full_explanation",
        "tier_recommended_action", "cost_centre", "invoice_status",
    )


def master_export(risk: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """The wide export; department comes from the order. Columns the scored
    frame does not have are left out."""
    departments = purchase_orders.select("po_number", "department").distinct()
    full = left_lookup(risk, departments, "po_number", "invoice_number")
    return full.select(*[c for c in EXPORT_COLUMNS if c in full.columns])


def vendor_risk(risk: DataFrame, vendors: DataFrame) -> DataFrame:
    rolled = (
        risk.filter(F.col("vendor_id").isNotNull())
        .groupBy("vendor_id")
        .agg(
            F.sum("invoice_amount").alias("total_invoiced"),
            F.count("invoice_number").alias("invoice_count"),
            F.sum((F.col("composite_risk_score") * 10).cast("bigint")).alias("_tenths"),
            F.max("composite_risk_score").alias("max_risk_score"),
            F.count_if(F.col("risk_tier") == "Critical").alias("critical_count"),
            F.count_if(F.col("risk_tier") == "High").alias("high_count"),
        )
        # scores have one digit: whole tenths make the mean independent of row order
        .withColumn("avg_risk_score", F.rint(F.col("_tenths") / F.col("invoice_count")) / 10)
        .drop("_tenths")
    )
    master = vendors.select(
        "vendor_id", "vendor_name", "vendor_category", "vendor_creation_date", "is_ghost_vendor"
    )
    return rolled.join(master, "vendor_id", "left")


def final_check(risk: DataFrame) -> DataFrame:
    """Tier counts, priority exposure and the most frequent anomaly type."""
    top = (
        risk.filter(F.col("anomaly_flag") == 1)
        .groupBy("anomaly_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max_by("anomaly_type", F.struct("n", "anomaly_type")).alias("top"))
        .scalar()
    )
    counts = [F.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_count") for t in TIERS]
    row = risk.agg(
        *counts, F.sum(F.when(_is_priority(), F.col("invoice_amount"))).alias("priority_exposure")
    )
    return row.withColumn("top_anomaly_type", top)


# --- report aggregates ------------------------------------------------------

# Anomaly types counted in the headline row.
COUNTED_TYPES = {
    "ghost_vendor_invoices": "Ghost Vendor Invoice",
    "maverick_invoices": "Maverick Buying",
    "duplicate_invoices": "Duplicate Invoice",
    "near_duplicate_invoices": "Near-Duplicate Invoice",
    "match_failure_invoices": "Three-Way Match Failure",
    "after_hours_invoices": "After-Hours Transaction",
    "round_number_invoices": "Round Number",
}


def kpi_row(risk: DataFrame, budget: DataFrame, match_rate: DataFrame) -> DataFrame:
    """One row of headline figures. `match_rate` is the one-row pass rate."""
    total = F.count(F.lit(1))
    priority = F.count_if(_is_priority())
    row = risk.agg(
        total.alias("total_transactions"),
        F.sum("anomaly_flag").alias("total_anomalies"),
        (F.sum("anomaly_flag") * 100.0 / total).alias("detection_rate"),
        *[F.count_if(F.col("risk_tier") == t).alias(f"{t.lower()}_count") for t in TIERS],
        F.sum(F.when(_is_priority(), F.col("invoice_amount"))).alias("total_exposure"),
        ((total - priority) * 100.0 / total).alias("audit_efficiency"),
        *[F.count_if(F.col("anomaly_type") == t).alias(n) for n, t in COUNTED_TYPES.items()],
    )
    overruns = budget.agg(F.count_if(F.col("is_overrun")).alias("n")).scalar()
    return row.withColumn("budget_overruns", overruns).withColumn(
        "match_pass_rate", match_rate.select("match_pass_rate").scalar()
    )


# Finding id, title, tier and the anomaly types it merges.
FINDINGS = (
    ("F-01", "Three-Way Match Failures", "Critical", ("Three-Way Match Failure",)),
    ("F-02", "Ghost Vendor Invoices", "Critical", ("Ghost Vendor Invoice",)),
    ("F-03", "Maverick Buying", "High", ("Maverick Buying",)),
    ("F-04", "Duplicate and Near-Duplicate Invoices", "High", ("Duplicate Invoice", "Near-Duplicate Invoice")),
    ("F-05", "After-Hours Transaction Postings", "Medium", ("After-Hours Transaction",)),
)
BUDGET_FINDING = ("F-06", "Budget Overruns", "Medium")


def findings(risk: DataFrame, budget: DataFrame) -> DataFrame:
    """Count and exposure of each finding, also where nothing was found."""
    kind = F.col("anomaly_type")
    measured = risk.agg(
        *[F.count_if(kind.isin(*types)).alias(f"n_{fid}") for fid, _, _, types in FINDINGS],
        *[
            F.coalesce(F.sum(F.when(kind.isin(*types), F.col("invoice_amount"))), F.lit(0)).alias(f"x_{fid}")
            for fid, _, _, types in FINDINGS
        ],
    )
    amount = "decimal(25,2)"
    rows = [
        F.struct(
            F.lit(fid).alias("finding"), F.lit(title).alias("title"), F.lit(level).alias("risk_tier"),
            F.col(f"`n_{fid}`").alias("n"), F.col(f"`x_{fid}`").cast(amount).alias("exposure"),
        )
        for fid, title, level, _ in FINDINGS
    ]
    fid, title, level = BUDGET_FINDING
    over = budget.filter(F.col("is_overrun")).agg(
        F.lit(fid).alias("finding"), F.lit(title).alias("title"), F.lit(level).alias("risk_tier"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("actual_spend") - F.sum("approved_budget"), F.lit(0)).cast(amount).alias("exposure"),
    )
    return reduce(DataFrame.unionByName, [measured.select(F.inline(F.array(*rows))), over])
