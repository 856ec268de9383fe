"""Named queries: one per operator, each a function of an `Audit`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.config import FEATURES
from tallymark.functions.ordering import new_path
from tallymark.operators import (
    autoencoder,
    controls,
    ensemble,
    explain,
    explore,
    isolation,
    metrics,
    quality,
    rules,
)
from tallymark.operators import features as feat
from tallymark.operators import near_duplicates as nd
from tallymark.operators import risk as rk
from tallymark.plans.pipeline import Audit
from tallymark.sources import loading
from tallymark.sources.schemas import SCHEMAS

Query = Callable[[Audit], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Engine-neutral result types: bigint, double, zone-free times, text lists."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round columns that come from floating-point sums."""
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _hits(exceptions: DataFrame) -> DataFrame:
    """Exceptions without prose, for comparison by value."""
    return exceptions.select("invoice_number", "rule_triggered", "risk_score", "financial_value")


def _csv_roundtrip(a: Audit) -> DataFrame:
    path = new_path(a.spark, "csv")
    loading.write_csv(a.inv, path)
    return loading.read_csv(a.spark, path, SCHEMAS["invoices"])


def _csv_scan(a: Audit) -> DataFrame:
    return _csv_roundtrip(a).select(
        "invoice_number", "invoice_date", "po_number", "invoice_amount", "payment_date", "is_maverick"
    )


def _csv_sink(a: Audit) -> DataFrame:
    path = new_path(a.spark, "csv-report")
    loading.write_csv(a.report, path)
    return a.spark.read.csv(path, header=True).groupBy("rule_triggered").agg(
        F.count(F.lit(1)).alias("n")
    )


def _append_load(a: Audit) -> DataFrame:
    """Invoices appended in two halves, the first of them twice."""
    path = new_path(a.spark, "append")
    half = F.col("invoice_status") == "Paid"
    for load_id, part in (("paid", half), ("others", ~half), ("paid", half)):
        loading.append_load(a.inv.filter(part), "invoices", path, load_id)
    loaded = loading.read_loaded(a.spark, "invoices", path)
    return loaded.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(F.col(c).isNull()).alias(f"null_{c}")
            for c in ("po_number", "gr_number", "payment_date", "approved_by")
        ],
    )


def _ordered_load(a: Audit) -> DataFrame:
    """All six tables from CSV, parents first, and from a folder without files."""
    source, target = new_path(a.spark, "csv-all"), new_path(a.spark, "load-all")
    for name, df in a.tables.items():
        loading.write_csv(df, f"{source}/{name}.csv")
    loaded = loading.load_all(a.spark, source, target)
    absent = loading.load_all(a.spark, f"{source}/none", target)
    rows = [(i + 1, t, n, absent[t]) for i, (t, n) in enumerate(loaded.items())]
    return a.spark.createDataFrame(rows, 'load_order int, `table` string, n long, n_absent long')


VENDOR_SPEND_SQL = """
SELECT v.vendor_category, count(*) AS n, sum(i.invoice_amount) AS total
FROM invoices i JOIN vendors v ON i.vendor_id = v.vendor_id
WHERE i.invoice_amount > :floor
GROUP BY v.vendor_category
"""

SOURCES: dict[str, Query] = {
    "s1_csv_scan": _csv_scan,
    "s2_csv_sink": _csv_sink,
    "s3_append_load": _append_load,
    "s4_sql_over_tables": lambda a: loading.run_sql(a.spark, a.tables, VENDOR_SPEND_SQL, floor=1000),
    "s5_ordered_load": _ordered_load,
    "s5_row_counts": lambda a: quality.row_counts(a.tables),
    "s6_constraint_violations": lambda a: quality.constraint_violations(a.tables, a.integrity),
}

CONTROLS: dict[str, Query] = {
    "q1_po_deviation": lambda a: controls.po_deviation(a.inv, a.po),
    "q2_same_amount_month": lambda a: controls.same_amount_month(a.inv),
    "q3_split_orders_by_month": lambda a: controls.split_orders_by_month(a.po),
    "q4_no_order": lambda a: controls.no_order(a.inv, a.ven),
    "q5_after_hours": lambda a: controls.after_hours(a.inv),
    "q6_budget_overruns": lambda a: controls.budget_overruns(a.bud),
    "q7_early_first_use": lambda a: controls.early_first_use(a.inv, a.ven),
}

RULES: dict[str, Query] = {
    "r1_exact_duplicates": lambda a: _hits(rules.exact_duplicates(a.inv)),
    "r2_near_duplicates": lambda a: a.near,
    "r2_pair_totals": lambda a: nd.pair_totals(a.near),
    "r3_split_orders": lambda a: _hits(rules.split_orders(a.po)),
    "r4_match_failures": lambda a: _hits(rules.match_failures(a.inv, a.po)),
    "r5_maverick": lambda a: _hits(rules.maverick(a.inv)),
    "r6_after_hours": lambda a: _hits(rules.after_hours(a.inv)),
    "r7_budget_overruns": lambda a: _hits(rules.budget_overruns(a.bud)),
    "r8_round_amounts": lambda a: _hits(rules.round_amounts(a.inv)),
    "r9_new_vendors": lambda a: _hits(rules.new_vendors(a.inv, a.ven)),
    "r10_exceptions_report": lambda a: _hits(rules.exceptions_report(a.inv, a.po, a.ven, a.bud, near=a.near)),
    "r10_exceptions_with_text": lambda a: a.report,
    "r11_rule_tier": lambda a: a.report.select("invoice_number", "risk_score", "risk_tier"),
    "r12_tier_totals": lambda a: rules.tier_totals(a.report),
    "r13_evaluation": lambda a: rules.evaluate(a.inv, a.report),
    "r14_rule_counts": lambda a: rules.rule_totals(a.inv, a.po, a.ven, a.bud, near=a.near),
}


def _features(a: Audit) -> DataFrame:
    return _rounded(a.features.select("invoice_number", *FEATURES), *FEATURES)


def _feature(name: str) -> Query:
    return lambda a: _rounded(a.features.select("invoice_number", name), name)


FEATURE_QUERIES: dict[str, Query] = {
    **{f"f{i}_{f.removeprefix('feat_')}": _feature(f) for i, f in enumerate(FEATURES, 1)},
    "f0_assembly": lambda a: feat.assemble(a.inv, a.ven, a.po, a.bud).select(
        "invoice_number", "vendor_creation_date", "vendor_category", "is_ghost_vendor",
        "total_po_value", "cc_budget", "cc_actual",
    ),
    "f1_to_f11_features": _features,
    "f12_scaler": lambda a: _rounded(feat.scaler(a.features), "p25", "p50", "p75", "scale"),
    "f12_scaled": lambda a: _scaled(a),
}


def _scaled(a: Audit) -> DataFrame:
    scaled = feat.scale(a.features, a.scaler)
    cols = [F.get("scaled", F.lit(i)).alias(f.replace("feat_", "scaled_")) for i, f in enumerate(FEATURES)]
    out = scaled.select("invoice_number", *cols)
    return _rounded(out, *[c for c in out.columns if c != "invoice_number"], digits=4)


def _metric_input(a: Audit) -> DataFrame:
    return a.zscore_scored.select("invoice_number", "anomaly_flag", F.col("ensemble_score").alias("score"))


def _zscore_flagged(a: Audit) -> DataFrame:
    df = _metric_input(a)
    return df.withColumn("flag", metrics.above_quantile(df, "score", 1 - a.cfg.contamination))


METRICS: dict[str, Query] = {
    "m8_roc_auc": lambda a: _rounded(metrics.roc_auc(_metric_input(a), "anomaly_flag", "score"), "auc"),
    "m9_roc_points": lambda a: metrics.roc_points(_metric_input(a), "anomaly_flag", "score"),
    "m10_confusion": lambda a: rules.confusion(_zscore_flagged(a), "anomaly_flag", "flag"),
    "m11_minmax": lambda a: _rounded(
        _metric_input(a).select("invoice_number", metrics.minmax(_metric_input(a), "score").alias("unit")), "unit"
    ),
    "m13_quantile_cut": lambda a: _zscore_flagged(a).select("invoice_number", "flag"),
}

def _score(name: str) -> Query:
    return lambda a: _component(a.zscore_risk, name)


def _component(risk: DataFrame, name: str) -> DataFrame:
    out = risk.select("invoice_number", name)
    return _rounded(out, name) if out.schema[name].dataType == T.DoubleType() else out


RISK: dict[str, Query] = {
    "k2_ml_component": _score("ml_component"),
    "k3_rule_component": _score("rule_component"),
    "k4_value_component": _score("value_component"),
    "k5_composite_score": _score("composite_risk_score"),
    "k6_risk_tier": _score("risk_tier"),
    "k1_attach_rules": lambda a: rk.attach_rules(a.features, a.report).select(
        "invoice_number", "rule_triggered", "rule_risk_score"
    ),
    "k2_to_k6_scores": lambda a: _rounded(
        a.zscore_risk.select(
            "invoice_number", "ml_component", "rule_component", "value_component",
            "composite_risk_score", "risk_tier",
        ),
        "ml_component", "value_component",
    ),
    "k7_tier_text": lambda a: a.zscore_risk.select(
        "invoice_number", "tier_definition", "tier_recommended_action"
    ),
    "k8_tier_distribution": lambda a: _rounded(rk.tier_distribution(a.zscore_risk), "pct"),
    "k9_exposure_by_tier": lambda a: _rounded(rk.exposure_by_tier(a.zscore_risk), "mean"),
    "k10_audit_efficiency": lambda a: _rounded(rk.audit_efficiency(a.zscore_risk), "efficiency_pct"),
    "k11_full_explanation": lambda a: a.zscore_risk.select("invoice_number", "full_explanation"),
    "k12_case_queue": lambda a: rk.case_queue(a.zscore_risk).drop(
        "full_explanation", "tier_recommended_action"
    ),
    "k13_master_export": lambda a: _master(a),
    "k14_vendor_risk": lambda a: rk.vendor_risk(a.zscore_risk, a.ven),
    "k15_budget_table": lambda a: a.bud,
    "k16_final_check": lambda a: rk.final_check(a.zscore_risk),
    "p1_kpi_row": lambda a: _rounded(
        rk.kpi_row(a.zscore_risk, a.bud, explore.match_rate(a.inv, a.po)),
        "detection_rate", "audit_efficiency", "match_pass_rate",
    ),
    "p2_findings": lambda a: rk.findings(a.zscore_risk, a.bud),
}


def _master(a: Audit) -> DataFrame:
    out = rk.master_export(a.zscore_risk, a.po).drop("full_explanation", "tier_recommended_action")
    doubles = [c for c, t in out.dtypes if t == "double"]
    return _rounded(out, *doubles)


EXPLORE: dict[str, Query] = {
    "e1_calendar": lambda a: explore.calendar(a.inv).select(
        "invoice_number", "invoice_hour", "invoice_dow", "invoice_month", "invoice_year",
        "is_weekend", "posted_after_hours", "days_to_payment",
    ),
    "e2_type_counts": lambda a: explore.type_counts(a.inv),
    "e3_type_exposure": lambda a: explore.type_exposure(a.inv),
    "e4_anomaly_overview": lambda a: _rounded(explore.anomaly_overview(a.inv), "anomaly_rate_pct"),
    "e5_log_amount_histogram": lambda a: explore.log_amount_histogram(a.inv),
    "e6_log_amount_boxes": lambda a: _rounded(
        explore.log_amount_boxes(a.inv), "q1", "median", "q3", "whisker_low", "whisker_high"
    ),
    "e7_leading_digits": lambda a: explore.leading_digits(a.inv).select("invoice_number", "first_digit"),
    "e8_benford": lambda a: _rounded(explore.benford(a.inv), "observed_pct", "expected_pct", "expected"),
    "e9_benford_test": lambda a: _rounded(explore.benford_test(a.inv), "chi_square", "p_value", digits=4),
    "e10_by_hour": lambda a: explore.by_hour(a.inv),
    "e11_by_weekday": lambda a: explore.by_weekday(a.inv),
    "e12_by_month": lambda a: explore.by_month(a.inv),
    "e13_payment_speed": lambda a: explore.payment_speed(a.inv),
    "e14_vendor_stats": lambda a: _rounded(
        explore.vendor_stats(a.inv, a.ven), "avg_amount", "anomaly_rate"
    ),
    "e15_top_vendors": lambda a: explore.top_vendors(a.inv, a.ven),
    "e16_rate_vs_volume": lambda a: _rounded(explore.rate_vs_volume(a.inv, a.ven), "anomaly_rate_pct"),
    "e17_high_rate_vendors": lambda a: explore.high_rate_vendors(a.inv, a.ven).select(
        "vendor_id", "invoice_count", "anomaly_count"
    ),
    "e18_spend_concentration": lambda a: _rounded(explore.spend_concentration(a.inv), "top_share_pct"),
    "e19_match_rows": lambda a: _rounded(
        explore.match_rows(a.inv, a.po).select("invoice_number", "match_deviation_pct", "match_pass"),
        "match_deviation_pct",
    ),
    "e19_match_rate": lambda a: _rounded(explore.match_rate(a.inv, a.po), "match_pass_rate"),
    "e20_deviation_histogram": lambda a: explore.deviation_histogram(a.inv, a.po),
    "e21_failure_by_category": lambda a: _rounded(
        explore.failure_by_category(a.inv, a.po, a.ven), "fail_rate"
    ),
    "e22_budget_bands": lambda a: explore.budget_bands(a.bud),
    "e23_budget_counts": lambda a: explore.budget_counts(a.bud),
    "e24_threshold_clustering": lambda a: _rounded(explore.threshold_clustering(a.inv), "ratio"),
    "e25_threshold_histogram": lambda a: explore.threshold_histogram(a.inv),
    "e26_summary": lambda a: _rounded(
        explore.summary(a.inv, a.po, a.bud), "anomaly_rate_pct", "match_pass_rate"
    ),
}

QUALITY: dict[str, Query] = {
    "v1_shape_and_nulls": lambda a: _rounded(quality.shape_and_nulls(a.tables), "pct"),
    "v2_duplicate_keys": lambda a: quality.duplicate_keys(a.tables, a.integrity),
    "v3_orphans": lambda a: quality.orphans(a.tables, a.integrity),
    "v4_labelled_duplicates": lambda a: quality.labelled_duplicates(a.inv),
    "v5_near_duplicate_labels": lambda a: quality.near_duplicate_labels(a.inv),
    "v6_split_labels": lambda a: quality.split_labels(a.po),
    "v6_split_label_groups": lambda a: quality.split_label_groups(a.po),
    "v7_match_labels": lambda a: _rounded(
        quality.match_labels(a.inv, a.po), "min_deviation_pct", "max_deviation_pct"
    ),
    "v8_maverick_labels": lambda a: quality.maverick_labels(a.inv),
    "v9_after_hours_labels": lambda a: quality.after_hours_labels(a.inv),
    "v10_round_labels": lambda a: quality.round_labels(a.inv),
    "v11_ghost_labels": lambda a: quality.ghost_labels(a.inv, a.ven),
    "v12_overrun_rows": lambda a: quality.overrun_rows(a.bud),
    "v13_flag_consistency": lambda a: quality.flag_consistency(a.inv),
}

MODELS: dict[str, Query] = {
    "m1_forest_nodes": lambda a: _rounded(a.forest_nodes, "threshold"),
    "m2_anomaly_score": lambda a: _rounded(
        isolation.add_score(a.scaled, a.forest).select("invoice_number", "iso_score"), "iso_score"
    ),
    "m3_contamination_cut": lambda a: _rounded(a.scored.select("invoice_number", "iso_score", "iso_prediction"), "iso_score"),
    "m4_permutation_importance": lambda a: _rounded(
        isolation.permutation_importance(a.scaled, a.forest, "anomaly_flag"), "auc_drop"
    ),
    "m5_training_history": lambda a: autoencoder.history_frame(a.scaled, a.autoencoder),
    "m6_reconstruction_error": lambda a: autoencoder.add_error(a.scaled, a.autoencoder.weights).select(
        "invoice_number", "ae_score"
    ),
    "m7_error_cut": lambda a: a.scored.select("invoice_number", "ae_score", "ae_prediction"),
    "m12_ensemble": lambda a: a.scored.select(
        "invoice_number", "iso_score", "ae_score", "ensemble_score", "ensemble_prediction"
    ),
    "m14_model_comparison": lambda a: metrics.compare_models(a.scored, "anomaly_flag", ensemble.MODELS),
    "m14_forest_comparison": lambda a: _rounded(
        metrics.compare_models(a.scored, "anomaly_flag", {"Isolation Forest": ensemble.MODELS["Isolation Forest"]}),
        "precision", "recall", "f1", "auc",
    ),
    "m14_model_roc_points": lambda a: metrics.roc_points(
        metrics.long_scores(a.scored, "anomaly_flag", ensemble.MODELS), "label", "score", ("model",)
    ),
    "k2_model_risk": lambda a: a.risk.select(
        "invoice_number", "ml_component", "rule_component", "value_component",
        "composite_risk_score", "risk_tier",
    ),
    "k13_model_export": lambda a: rk.master_export(a.risk, a.po),
    "x1_contributions": lambda a: _rounded(explain.long_contributions(a.explained), "base_value", "contribution"),
    "x2_seeded_sample": lambda a: _rounded(explain.sample(a.features).select("invoice_number", *FEATURES), *FEATURES),
    "x3_global_importance": lambda a: _rounded(explain.importance(a.explained), "mean_abs_contribution"),
    # the same with the forest alone choosing the cases, which SQL can follow
    "k2_forest_risk": lambda a: _rounded(
        a.forest_risk.select("invoice_number", "ml_component", "composite_risk_score", "risk_tier"), "ml_component", digits=4
    ),
    "x4_forest_top_case": lambda a: _rounded(
        explain.long_contributions(explain.top_cases(a.forest_cases, 1), "composite_risk_score"), "base_value", "contribution"
    ),
    "x5_forest_sentences": lambda a: explain.priority_cases(a.forest_cases).select("invoice_number", "shap_explanation"),
    "x6_forest_top_cases": lambda a: explain.top_cases(a.forest_cases, 5).select(
        "invoice_number", F.col("composite_risk_score").alias("risk_score"), "shap_explanation"
    ),
    "x7_forest_priority_cases": lambda a: explain.priority_cases(a.forest_cases).select(
        "invoice_number", "vendor_id", "invoice_amount", "composite_risk_score", "risk_tier",
        "rule_triggered", "full_explanation", "shap_explanation",
    ),
    "x4_top_case": lambda a: explain.long_contributions(
        explain.top_cases(a.explained_top, 1), "composite_risk_score"
    ).orderBy(F.desc(F.abs("contribution")), "feature"),
    "x5_sentences": lambda a: a.explained_cases.select("invoice_number", "shap_explanation"),
    "x6_top_cases": lambda a: a.explained_top.select(
        "invoice_number", F.col("composite_risk_score").alias("risk_score"), "shap_explanation"
    ),
    "x7_priority_cases": lambda a: a.explained_cases.select(
        "invoice_number", "vendor_id", "invoice_amount", "composite_risk_score", "risk_tier",
        "rule_triggered", "full_explanation", "shap_explanation",
    ),
}



def _score_facts(df: DataFrame, score: str, most: float) -> DataFrame:
    """Rows, and scores that are missing or out of range."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(score).isNull() | F.isnan(score)).alias("missing"),
        F.count_if((F.col(score) < 0) | (F.col(score) > most)).alias("outside"),
    )


def _cut_facts(a: Audit, score: str, prediction: str) -> DataFrame:
    """Rows, and whether the cut splits them by score and flags no more than its share."""
    flagged = F.col(prediction) == 1
    return a.scored.agg(
        F.count(F.lit(1)).alias("n"),
        (F.min(F.when(flagged, F.col(score))) > F.max(F.when(~flagged, F.col(score)))).alias("split_by_score"),
        (F.count_if(flagged) <= F.ceil(F.count(F.lit(1)) * a.cfg.contamination)).alias("within_share"),
    )


def _forest_facts(a: Audit) -> DataFrame:
    """Trees, the rows at their roots, and nodes whose children don't add up."""
    nodes = a.forest_nodes
    kids = nodes.filter("feature >= 0 and left != right").select("tree", "n", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("up"))
    sums = kids.join(nodes.select("tree", "node", F.col("n").alias("m")), ["tree", "node"]).groupBy("tree", "up").agg(
        F.first("n").alias("n"), F.sum("m").alias("m")
    )
    odd = sums.filter("n != m").agg(F.count(F.lit(1)).alias("n")).scalar()
    roots = nodes.filter(F.col("node") == isolation.ROOT)
    return roots.agg(
        F.count(F.lit(1)).alias("trees"), F.min("n").cast("bigint").alias("least_root"), F.max("n").cast("bigint").alias("largest_root")
    ).withColumn("uneven_nodes", odd)


def _ensemble_facts(a: Audit) -> DataFrame:
    """Largest gap between the ensemble and the weighted scores it is made of."""
    iso, ae = (metrics.minmax(a.scored, c) for c in ("iso_score", "ae_score"))
    own = a.cfg.weight_forest * iso + a.cfg.weight_autoencoder * ae
    return a.scored.select(F.abs(own - F.col("ensemble_score")).alias("gap")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("gap") < 1e-9).alias("adds_up")
    )


def _risk_facts(risk: DataFrame, cfg) -> DataFrame:
    """Rows, and those whose score or tier disagrees with its parts."""
    own = (
        cfg.weight_ml * F.col("ml_component") + cfg.weight_rule * F.col("rule_component")
        + cfg.weight_value * F.col("value_component")
    )
    s = F.col("composite_risk_score")
    tier = (
        F.when(s >= cfg.tier_critical, "Critical").when(s >= cfg.tier_high, "High").when(s >= cfg.tier_medium, "Medium").otherwise("Low")
    )
    return risk.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(own - s) > 0.0501).alias("odd_score"),
        F.count_if(F.col("risk_tier") != tier).alias("odd_tier"),
    )


def _cases_facts(a: Audit, text: str) -> DataFrame:
    """Whether the cases are all Critical and High invoices, each once and with a text."""
    wanted = a.risk.filter(F.col("risk_tier").isin("Critical", "High")).agg(F.count(F.lit(1)).alias("n")).scalar()
    return a.explained_cases.agg(
        (F.count(F.lit(1)) == wanted).alias("all_cases"),
        (F.countDistinct("invoice_number") == wanted).alias("each_once"),
        F.count_if(F.coalesce(F.length(text), F.lit(0)) == 0).alias("without_text"),
    )


def _additivity_facts(a: Audit) -> DataFrame:
    """Contributions and base against the forest's mean path length, over all invoices."""
    total = F.aggregate("contributions", F.col("base_value"), lambda s, x: s + x)
    scores = isolation.add_score(a.scaled, a.forest).select("invoice_number", "iso_score")
    gap = F.abs(total - F.log2("iso_score") * F.lit(float(a.forest.norm)))
    return a.explained.join(scores, "invoice_number").agg(
        F.count(F.lit(1)).alias("n"), (F.max(gap) < 1e-6).alias("adds_up")
    )


#: What SQL can state of results that come from fitted models.
FACTS: dict[str, Query] = {
    "m1_forest_facts": _forest_facts,
    "m2_score_facts": lambda a: _score_facts(a.scored, "iso_score", 1.0),
    "m3_cut_facts": lambda a: _cut_facts(a, "iso_score", "iso_prediction"),
    "m4_importance_facts": lambda a: isolation.permutation_importance(a.scaled, a.forest, "anomaly_flag").select("feature"),
    "m5_history_facts": lambda a: autoencoder.history_frame(a.scaled, a.autoencoder).agg(
        (F.count(F.lit(1)) == F.max("epoch")).alias("every_epoch"),
        F.count_if("is_best").alias("best_epochs"),
        (F.min("val_loss") == F.min(F.when(F.col("is_best"), F.col("val_loss")))).alias("best_is_least"),
    ),
    "m6_error_facts": lambda a: _score_facts(a.scored, "ae_score", float("inf")),
    "m12_ensemble_facts": _ensemble_facts,
    "m14_comparison_facts": lambda a: metrics.compare_models(a.scored, "anomaly_flag", ensemble.MODELS).select(
        "model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n"), (F.col("fn") + F.col("tp")).alias("positives")
    ),
    "k2_model_risk_facts": lambda a: _risk_facts(a.risk, a.cfg),
    "k13_model_export_facts": lambda a: rk.master_export(a.risk, a.po).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("invoice_number").alias("numbers")
    ),
    "x1_additivity_facts": _additivity_facts,
    "x3_importance_facts": lambda a: explain.importance(a.explained).select("feature"),
    "x4_top_case_facts": lambda a: explain.long_contributions(explain.top_cases(a.explained_top, 1), "composite_risk_score").select("feature"),
    "x5_sentence_facts": lambda a: _cases_facts(a, "shap_explanation"),
    "x6_top_cases_facts": lambda a: a.explained_top.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("invoice_number").alias("numbers")
    ),
    "x7_priority_facts": lambda a: _cases_facts(a, "full_explanation"),
}

ALL: dict[str, Query] = {
    **SOURCES, **CONTROLS, **RULES, **FEATURE_QUERIES, **METRICS, **RISK, **EXPLORE, **QUALITY,
    **MODELS, **FACTS,
}
