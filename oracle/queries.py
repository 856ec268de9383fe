"""DuckDB text per registered query, written independently of the Spark code:
plain self-joins, windows and quantile functions over the same views."""

from __future__ import annotations

from oracle import forest as grown
from oracle.views import q
from tallymark.config import RULE_NAMES
from tallymark.operators.explain import FEATURE_LABELS
from tallymark.operators.risk import TIER_ACTION, TIER_MEANING
from tallymark.operators.rules import ACTIONS


def _days(later: str, earlier: str) -> str:
    return (
        f"CAST(floor((epoch_us({later}) - epoch_us(CAST({earlier} AS TIMESTAMP)))"
        f" / CAST(86400000000 AS DOUBLE)) AS BIGINT)"
    )


OFF_HOURS = "(isodow(invoice_date) >= 6 OR hour(invoice_date) < 8 OR hour(invoice_date) >= 19)"
ROUND = "cents % 100000 = 0"


def _hit(rule: str, score: str, key: str = "invoice_number", value: str = "invoice_amount") -> str:
    return (
        f"{key} AS invoice_number, '{rule}' AS rule_triggered, CAST({score} AS BIGINT) AS risk_score, "
        f"CAST({value} AS DOUBLE) AS financial_value"
    )


# --- rules as CTEs ----------------------------------------------------------

R1 = f"""r1 AS (
  SELECT {_hit('Exact Duplicate Invoice', '8')} FROM (
    SELECT *, lag(cents) OVER w AS pc, lag(invoice_date) OVER w AS pd FROM invoices
    WINDOW w AS (PARTITION BY vendor_id, vendor_invoice_number ORDER BY invoice_date, invoice_number))
  WHERE abs(cents - pc) < 1 AND {_days('invoice_date', 'pd')} <= 30)"""

PAIRS = f"""pairs AS (
  SELECT j.invoice_number, i.invoice_number AS matched_invoice, j.vendor_id,
         CAST(j.invoice_amount AS DOUBLE) AS invoice_amount, CAST(i.invoice_amount AS DOUBLE) AS matched_amount,
         {_days('j.invoice_date', 'i.invoice_date')} AS days_apart,
         i.invoice_date AS i_ts,
         epoch_us(i.invoice_date) // 2678400000000 AS i_slot, epoch_us(j.invoice_date) // 2678400000000 AS j_slot
  FROM invoices i JOIN invoices j ON i.vendor_id = j.vendor_id
   AND (i.invoice_date, i.invoice_number) < (j.invoice_date, j.invoice_number)
  WHERE {_days('j.invoice_date', 'i.invoice_date')} <= 30
    AND i.vendor_invoice_number IS DISTINCT FROM j.vendor_invoice_number
    AND i.cents > 0 AND i.cents <> j.cents AND 50 * abs(j.cents - i.cents) <= i.cents)"""

NEAR = """near AS (
  SELECT invoice_number, matched_invoice, vendor_id, invoice_amount, matched_amount, days_apart FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY j_slot - i_slot,
        CASE WHEN i_slot = j_slot THEN epoch_us(i_ts) ELSE -epoch_us(i_ts) END,
        CASE WHEN i_slot = j_slot THEN matched_invoice END,
        CASE WHEN i_slot < j_slot THEN matched_invoice END DESC) AS rn
    FROM pairs) WHERE rn = 1)"""

R2 = """r2 AS (
  SELECT invoice_number, 'Near-Duplicate Invoice' AS rule_triggered, CAST(6 AS BIGINT) AS risk_score,
         invoice_amount AS financial_value FROM near)"""

R3 = f"""r3 AS (
  SELECT {_hit('Split Purchase Order', '7', 'p.po_number', 'p.total_po_value')}
  FROM purchase_orders p JOIN (
    SELECT vendor_id, min(w) AS w FROM (
      SELECT a.vendor_id, a.po_number, a.po_date AS w
      FROM purchase_orders a JOIN purchase_orders b ON a.vendor_id = b.vendor_id
       AND b.po_date >= a.po_date AND b.po_date <= a.po_date + INTERVAL '30' DAY
      WHERE a.po_cents < 10000000 AND b.po_cents < 10000000
      GROUP BY ALL HAVING count(*) >= 2 AND sum(b.po_cents) > 10000000)
    GROUP BY vendor_id) f ON f.vendor_id = p.vendor_id
  WHERE p.po_cents < 10000000 AND p.po_date >= f.w AND p.po_date <= f.w + INTERVAL '30' DAY)"""

R4 = f"""r4 AS (
  SELECT {_hit('Three-Way Match Failure', 'CASE WHEN 100 * abs(cents - po_cents) > 20 * po_cents THEN 7 ELSE 5 END')}
  FROM invoices i JOIN purchase_orders p ON i.po_number = p.po_number
  WHERE po_cents <> 0 AND 100 * abs(cents - po_cents) > 5 * po_cents)"""
R5 = f"r5 AS (SELECT {_hit('Maverick Buying', '5')} FROM invoices WHERE po_number IS NULL)"
R6 = f"r6 AS (SELECT {_hit('After-Hours Transaction', '4')} FROM invoices WHERE {OFF_HOURS})"
_BUDGET_KEY = "'BUDGET-' || cost_centre || '-' || budget_period"
R7 = f"""r7 AS (
  SELECT {_hit('Budget Overrun', 'CASE WHEN (actual_spend - approved_budget) * 5 > approved_budget THEN 6 ELSE 4 END',
               _BUDGET_KEY, 'actual_spend - approved_budget')}
  FROM budget WHERE actual_spend > approved_budget)"""
R8 = f"r8 AS (SELECT {_hit('Round Number Invoice', '3')} FROM invoices WHERE {ROUND})"
R9 = f"""r9 AS (
  SELECT {_hit('New Vendor Fast Payment', 'CASE WHEN is_ghost_vendor THEN 9 ELSE 6 END')}
  FROM invoices i JOIN vendors v ON i.vendor_id = v.vendor_id
  WHERE {_days('invoice_date', 'vendor_creation_date')} <= 7)"""

UNION = "allhits AS (" + " UNION ALL ".join(
    f"SELECT *, {n} AS rule_no FROM r{n}" for n in range(1, 10)
) + ")"
REPORT = """report AS (
  SELECT invoice_number, rule_triggered, risk_score, financial_value,
         CASE WHEN risk_score >= 8 THEN 'Critical' WHEN risk_score >= 6 THEN 'High'
              WHEN risk_score >= 4 THEN 'Medium' ELSE 'Low' END AS rule_tier
  FROM (SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY risk_score DESC, rule_no) AS rn FROM allhits)
  WHERE rn = 1)"""
ALL_RULES = (R1, PAIRS, NEAR, R2, R3, R4, R5, R6, R7, R8, R9, UNION, REPORT)

# --- features and risk as CTEs ----------------------------------------------

FEAT = f"""vstats AS (
  SELECT vendor_id, avg(CAST(invoice_amount AS DOUBLE)) AS m, stddev_samp(CAST(invoice_amount AS DOUBLE)) AS s
  FROM invoices GROUP BY vendor_id),
centre AS (
  SELECT cost_centre, CAST(sum(approved_budget) AS DOUBLE) AS cc_budget, CAST(sum(actual_spend) AS DOUBLE) AS cc_actual
  FROM budget GROUP BY cost_centre),
joined AS (
  SELECT i.*, v.vendor_creation_date, v.vendor_category, v.is_ghost_vendor, p.total_po_value, p.po_cents, p.department,
         c.cc_budget, c.cc_actual, s.m, s.s,
         count(*) OVER (PARTITION BY i.vendor_id, date_trunc('month', i.invoice_date)) AS freq,
         CASE WHEN cents >= 100 THEN CAST(substr(CAST(cents // 100 AS VARCHAR), 1, 1) AS INT) END AS digit
  FROM invoices i LEFT JOIN vendors v ON i.vendor_id = v.vendor_id
  LEFT JOIN purchase_orders p ON i.po_number = p.po_number
  LEFT JOIN centre c ON i.cost_centre = c.cost_centre LEFT JOIN vstats s ON i.vendor_id = s.vendor_id),
feat AS (
  SELECT *,
    coalesce((CAST(invoice_amount AS DOUBLE) - m) / (CASE WHEN s = 0 THEN 1.0 ELSE s END), 0.0) AS feat_amount_zscore,
    CASE WHEN total_po_value > 0 THEN CAST(invoice_amount AS DOUBLE) / CAST(total_po_value AS DOUBLE) ELSE CAST(1.5 AS DOUBLE) END AS feat_invoice_to_po_ratio,
    CAST(CASE WHEN vendor_creation_date IS NULL THEN 365 ELSE greatest({_days('invoice_date', 'vendor_creation_date')}, 0) END AS DOUBLE) AS feat_vendor_age_days,
    CAST(least(greatest(CASE WHEN payment_date IS NULL THEN 90 ELSE {_days('payment_date', 'invoice_date')} END, 0), 200) AS DOUBLE) AS feat_days_to_payment,
    CAST(freq AS DOUBLE) AS feat_vendor_monthly_freq,
    least(greatest(CASE WHEN cc_budget > 0 THEN CAST(invoice_amount AS DOUBLE) / cc_budget ELSE 0.5 END, 0.0), 5.0) AS feat_pct_of_cc_budget,
    CAST(CASE WHEN {OFF_HOURS} THEN 1 ELSE 0 END AS DOUBLE) AS feat_after_hours,
    CAST(CASE WHEN po_number IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS feat_no_po,
    CAST(CASE WHEN {ROUND} THEN 1 ELSE 0 END AS DOUBLE) AS feat_round_number,
    coalesce(abs(1.0 / 9.0 - log10(1.0 + 1.0 / CAST(digit AS DOUBLE))), 0.0) AS feat_benford_dev
  FROM joined)"""

FEATURES = (
    "feat_amount_zscore", "feat_invoice_to_po_ratio", "feat_vendor_age_days", "feat_days_to_payment",
    "feat_vendor_monthly_freq", "feat_pct_of_cc_budget", "feat_after_hours", "feat_no_po",
    "feat_round_number", "feat_benford_dev",
)
SCALER = "fitted AS (" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, count(*) AS n, quantile_cont({f}, 0.25) AS p25, quantile_cont({f}, 0.5) AS p50,
    quantile_cont({f}, 0.75) AS p75,
    CASE WHEN quantile_cont({f}, 0.75) = quantile_cont({f}, 0.25) THEN 1.0
         ELSE quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) END AS scale FROM feat"""
    for f in FEATURES
) + ")"

SCORE = """scored AS (SELECT *, round(abs(feat_amount_zscore), 6) AS score FROM feat)"""

RISK = """parts AS (
  SELECT s.*, coalesce(r.rule_triggered, 'None') AS rule_triggered, CAST(coalesce(r.risk_score, 0) AS BIGINT) AS rule_risk_score,
         score AS ensemble_score, ln(1 + greatest(CAST(invoice_amount AS DOUBLE), 0.0)) AS la
  FROM scored s LEFT JOIN report r ON r.invoice_number = s.invoice_number),
comps AS (
  SELECT *, (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER () + 1e-10) * 100.0 AS ml_component,
         CAST(rule_risk_score AS DOUBLE) * 10 AS rule_component,
         (la - min(la) OVER ()) / (max(la) OVER () - min(la) OVER () + 1e-10) * 100.0 AS value_component
  FROM parts),
composed AS (
  SELECT *, round_even(10 * (CAST(0.4 AS DOUBLE) * ml_component + CAST(0.35 AS DOUBLE) * rule_component
                        + CAST(0.25 AS DOUBLE) * value_component), 0) / 10 AS composite_risk_score FROM comps),
risk AS (
  SELECT *, CASE WHEN composite_risk_score >= 75 THEN 'Critical' WHEN composite_risk_score >= 55 THEN 'High'
                 WHEN composite_risk_score >= 35 THEN 'Medium' ELSE 'Low' END AS risk_tier FROM composed)"""

FULL = (*ALL_RULES, FEAT, SCORE, RISK)


def _rules(body: str) -> str:
    return q(body, *ALL_RULES)


def _risk(body: str) -> str:
    return q(body, *FULL)


ORACLE: dict[str, str] = {}

# sources
ORACLE["s1_csv_scan"] = q(
    "SELECT invoice_number, invoice_date, po_number, CAST(invoice_amount AS DOUBLE) AS invoice_amount, payment_date, is_maverick FROM invoices"
)
ORACLE["s2_csv_sink"] = _rules("SELECT rule_triggered, count(*) AS n FROM report GROUP BY 1")
ORACLE["s3_append_load"] = q(
    "SELECT count(*) AS n, "
    + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in ("po_number", "gr_number", "payment_date", "approved_by"))
    + " FROM invoices"
)
ORACLE["s4_sql_over_tables"] = q(
    "SELECT vendor_category, count(*) AS n, CAST(sum(invoice_amount) AS DOUBLE) AS total FROM invoices i "
    "JOIN vendors v ON i.vendor_id = v.vendor_id WHERE invoice_amount > 1000 GROUP BY 1"
)
TABLES = ("users", "vendors", "budget", "purchase_orders", "goods_receipts", "invoices")
ORACLE["s5_row_counts"] = q(
    " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS load_order, '{t}' AS \"table\", count(*) AS n FROM {t}" for i, t in enumerate(TABLES)
    )
)


ORACLE["s5_ordered_load"] = q(
    " UNION ALL ".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS load_order, '{t}' AS \"table\", count(*) AS n, CAST(0 AS BIGINT) AS n_absent FROM {t}"
        for i, t in enumerate(TABLES)
    )
)


def _check(check: str, subject: str, measure: str, value: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, '{measure}' AS measure, "
        f"CAST({value} AS BIGINT) AS value FROM {source}"
    )


_NOT_NULL = {
    "users": ("user_id", "user_name", "role"), "vendors": ("vendor_id", "vendor_name", "vendor_creation_date"),
    "budget": ("cost_centre",), "purchase_orders": ("po_number", "po_date"),
    "goods_receipts": ("gr_number", "gr_date"), "invoices": ("invoice_number", "invoice_date"),
}
_UNIQUE = {
    "users": ("user_id",), "vendors": ("vendor_id",), "budget": ("cost_centre", "budget_period"),
    "purchase_orders": ("po_number",), "goods_receipts": ("gr_number",), "invoices": ("invoice_number",),
}
ORACLE["s6_constraint_violations"] = q(
    " UNION ALL ".join(
        [_check("constraint", t, f"not_null.{c}", f"count(*) - count({c})", t) for t, cs in _NOT_NULL.items() for c in cs]
        + [_check("constraint", "users", "check.access_level_1_to_4",
                  "count(*) FILTER (WHERE NOT access_level BETWEEN 1 AND 4)", "users")]
        + [_check("constraint", t, "unique." + ",".join(ks), f"count(*) - count(DISTINCT ({', '.join(ks)}))", t)
           for t, ks in _UNIQUE.items()]
    )
)

# controls
ORACLE["q1_po_deviation"] = q("""
SELECT i.invoice_number, i.invoice_date, i.vendor_id, CAST(p.total_po_value AS DOUBLE) AS po_amount,
       CAST(i.invoice_amount AS DOUBLE) AS invoice_amount,
       CAST(sign(cents - po_cents) * ((20000 * abs(cents - po_cents) + po_cents) // (2 * po_cents)) AS DOUBLE) / 100 AS deviation_pct,
       invoice_status, anomaly_type
FROM invoices i JOIN purchase_orders p ON i.po_number = p.po_number
WHERE po_cents > 0 AND 20 * abs(cents - po_cents) > po_cents
ORDER BY CAST(abs(cents - po_cents) AS DOUBLE) / po_cents DESC, invoice_number LIMIT 50""")
ORACLE["q2_same_amount_month"] = q("""
SELECT group_rank, g.vendor_id, CAST(g.cents AS DOUBLE) / 100 AS invoice_amount, CAST(g.m AS TIMESTAMP) AS invoice_month, invoice_count, invoice_number
FROM (SELECT *, row_number() OVER (ORDER BY invoice_count DESC, vendor_id, cents, m) AS group_rank
      FROM (SELECT vendor_id, cents, date_trunc('month', invoice_date) AS m, count(*) AS invoice_count FROM invoices WHERE cents > 0
            GROUP BY vendor_id, cents, date_trunc('month', invoice_date) HAVING count(*) > 1 ORDER BY count(*) DESC, 1, 2, 3 LIMIT 30)) g
JOIN invoices i ON i.vendor_id IS NOT DISTINCT FROM g.vendor_id AND i.cents = g.cents AND date_trunc('month', i.invoice_date) = g.m""")
ORACLE["q3_split_orders_by_month"] = q("""
SELECT group_rank, g.vendor_id, CAST(g.m AS TIMESTAMP) AS po_month, g.po_count, CAST(g.total AS DOUBLE) / 100 AS total_combined_value,
       CAST(g.most AS DOUBLE) / 100 AS max_single_po, po_number
FROM (SELECT *, row_number() OVER (ORDER BY total DESC, vendor_id, m) AS group_rank
      FROM (SELECT vendor_id, date_trunc('month', po_date) AS m, count(*) AS po_count, sum(po_cents) AS total, max(po_cents) AS most
            FROM purchase_orders WHERE po_cents < 10000000 AND approval_status = 'Approved'
            GROUP BY 1, 2 HAVING count(*) > 1 AND sum(po_cents) > 10000000 ORDER BY sum(po_cents) DESC, 1, 2 LIMIT 30)) g
JOIN purchase_orders p ON p.vendor_id IS NOT DISTINCT FROM g.vendor_id AND date_trunc('month', p.po_date) = g.m
WHERE po_cents < 10000000 AND approval_status = 'Approved'""")
ORACLE["q4_no_order"] = q("""
SELECT invoice_number, invoice_date, i.vendor_id, vendor_name, vendor_category, CAST(invoice_amount AS DOUBLE) AS invoice_amount,
       invoice_status, processed_by
FROM invoices i JOIN vendors v ON i.vendor_id = v.vendor_id WHERE po_number IS NULL
ORDER BY i.cents DESC, invoice_number LIMIT 50""")
ORACLE["q5_after_hours"] = q(f"""
SELECT invoice_number, invoice_date, hour(invoice_date) AS posting_hour, dayofweek(invoice_date) AS day_of_week,
       CASE dayofweek(invoice_date) WHEN 0 THEN 'Sunday' WHEN 6 THEN 'Saturday' ELSE 'Weekday' END AS day_type,
       vendor_id, CAST(invoice_amount AS DOUBLE) AS invoice_amount, processed_by
FROM invoices WHERE {OFF_HOURS} ORDER BY invoice_date, invoice_number LIMIT 50""")
ORACLE["q6_budget_overruns"] = q("""
SELECT cost_centre, department, budget_period, CAST(approved_budget AS DOUBLE) AS approved_budget, CAST(actual_spend AS DOUBLE) AS actual_spend,
       CAST(actual_spend - approved_budget AS DOUBLE) AS overrun_amount, CAST(round(budget_utilisation_pct, 1) AS DOUBLE) AS utilisation_pct
FROM budget WHERE actual_spend > approved_budget""")
ORACLE["q7_early_first_use"] = q("""
SELECT v.vendor_id, vendor_name, vendor_creation_date, created_by_user, contact_email,
       CAST(min(invoice_date) AS DATE) AS first_invoice_date,
       CAST(min(invoice_date) AS DATE) - vendor_creation_date AS days_to_first_invoice,
       CAST(sum(cents) AS DOUBLE) / 100 AS total_invoiced, count(invoice_number) AS invoice_count, is_ghost_vendor
FROM vendors v JOIN invoices i ON v.vendor_id = i.vendor_id
GROUP BY v.vendor_id, vendor_name, vendor_creation_date, created_by_user, contact_email, is_ghost_vendor
HAVING CAST(min(invoice_date) AS DATE) - vendor_creation_date <= 7 ORDER BY days_to_first_invoice, v.vendor_id LIMIT 30""")

# rules
_HITS = "SELECT invoice_number, rule_triggered, risk_score, financial_value FROM "
ORACLE["r1_exact_duplicates"] = q(_HITS + "r1", R1)
ORACLE["r2_near_duplicates"] = q(
    "SELECT near.*, n_partners FROM near JOIN (SELECT invoice_number, count(*) AS n_partners FROM pairs GROUP BY 1) p ON p.invoice_number = near.invoice_number",
    PAIRS, NEAR,
)
ORACLE["r2_pair_totals"] = q("SELECT count(DISTINCT invoice_number) AS n_invoices, count(*) AS n_pairs FROM pairs", PAIRS)
for _n, _name, _cte in (
    (3, "split_orders", R3), (4, "match_failures", R4), (5, "maverick", R5), (6, "after_hours", R6),
    (7, "budget_overruns", R7), (8, "round_amounts", R8), (9, "new_vendors", R9),
):
    ORACLE[f"r{_n}_{_name}"] = q(_HITS + f"r{_n}", _cte)
ORACLE["r10_exceptions_report"] = _rules(_HITS + "report")
ORACLE["r11_rule_tier"] = _rules("SELECT invoice_number, risk_score, rule_tier AS risk_tier FROM report")
ORACLE["r12_tier_totals"] = _rules("""
SELECT coalesce(rule_tier, 'All') AS risk_tier, count(*) AS n, CAST(sum(CAST(financial_value AS DECIMAL(18,2))) AS DOUBLE) AS exposure
FROM report GROUP BY ROLLUP (rule_tier)""")


def _confusion(source: str) -> str:
    return f"""
SELECT tn, fp, fn, tp, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0.0) AS precision,
       coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0.0) AS recall,
       coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
FROM (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp FROM ({source}))"""


ORACLE["r13_evaluation"] = _rules(
    _confusion(
        "SELECT anomaly_flag AS y, CASE WHEN invoice_number IN (SELECT invoice_number FROM report) THEN 1 ELSE 0 END AS p FROM invoices"
    )
)
ORACLE["r14_rule_counts"] = q(
    "SELECT rule_triggered, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT rule_triggered FROM {t}" for t in ("r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "r9"))
    + ") GROUP BY 1",
    R1, PAIRS, NEAR, R2, R3, R4, R5, R6, R7, R8, R9,
)

# features
ORACLE["f0_assembly"] = q(
    "SELECT invoice_number, vendor_creation_date, vendor_category, is_ghost_vendor, CAST(total_po_value AS DOUBLE) AS total_po_value, cc_budget, cc_actual FROM joined",
    FEAT,
)
ORACLE["f1_to_f11_features"] = q(
    "SELECT invoice_number, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURES) + " FROM feat", FEAT
)
for _i, _f_name in enumerate(FEATURES, 1):
    ORACLE[f"f{_i}_{_f_name.removeprefix('feat_')}"] = q(
        f"SELECT invoice_number, round({_f_name}, 6) AS {_f_name} FROM feat", FEAT
    )
ORACLE["f12_scaler"] = q(
    "SELECT feature, n, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, round(scale, 6) AS scale FROM fitted",
    FEAT, SCALER,
)
ORACLE["f12_scaled"] = q(
    "SELECT invoice_number, "
    + ", ".join(
        f"round(({f} - (SELECT p50 FROM fitted WHERE feature = '{f}')) / (SELECT scale FROM fitted WHERE feature = '{f}'), 4) AS {f.replace('feat_', 'scaled_')}"
        for f in FEATURES
    )
    + " FROM feat",
    FEAT, SCALER,
)

# metrics on |z-score|
_AUC = """
SELECT round(sum(rank_sum - p * (p + 1) / 2.0) / (sum(p) * sum(n)), 6) AS auc FROM (
  SELECT sum(CASE WHEN anomaly_flag = 1 THEN r ELSE 0 END) AS rank_sum,
         CAST(sum(anomaly_flag) AS DOUBLE) AS p, CAST(sum(1 - anomaly_flag) AS DOUBLE) AS n
  FROM (SELECT anomaly_flag, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored))"""
ORACLE["m8_roc_auc"] = q(_AUC, FEAT, SCORE)
_STEPS = """steps AS (SELECT score, CAST(sum(anomaly_flag) AS BIGINT) AS pos, CAST(sum(1 - anomaly_flag) AS BIGINT) AS neg FROM scored GROUP BY score),
curve AS (SELECT *, row_number() OVER (ORDER BY score DESC) AS place, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
    CAST(sum(neg) OVER w AS DOUBLE) / CAST(sum(neg) OVER () AS DOUBLE) AS fpr, CAST(sum(pos) OVER w AS DOUBLE) / CAST(sum(pos) OVER () AS DOUBLE) AS tpr
    FROM steps WINDOW w AS (ORDER BY score DESC))"""
ORACLE["m9_roc_points"] = q("""
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT score, fpr, tpr FROM curve WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg""", FEAT, SCORE, _STEPS)
_FLAG = "CAST(CASE WHEN score > (SELECT quantile_cont(score, 0.95) FROM scored) THEN 1 ELSE 0 END AS BIGINT)"
ORACLE["m10_confusion"] = q(_confusion(f"SELECT anomaly_flag AS y, {_FLAG} AS p FROM scored"), FEAT, SCORE)
ORACLE["m11_minmax"] = q(
    "SELECT invoice_number, round((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER () + 1e-10), 6) AS unit FROM scored",
    FEAT, SCORE,
)
ORACLE["m13_quantile_cut"] = q(f"SELECT invoice_number, {_FLAG} AS flag FROM scored", FEAT, SCORE)

# risk
ORACLE["k1_attach_rules"] = _risk("SELECT invoice_number, rule_triggered, rule_risk_score FROM parts")
ORACLE["k2_to_k6_scores"] = _risk(
    "SELECT invoice_number, round(ml_component, 6) AS ml_component, rule_component, round(value_component, 6) AS value_component, composite_risk_score, risk_tier FROM risk"
)
for _n, _col, _value in (
    ("k2_ml_component", "ml_component", "round(ml_component, 6)"),
    ("k3_rule_component", "rule_component", "rule_component"),
    ("k4_value_component", "value_component", "round(value_component, 6)"),
    ("k5_composite_score", "composite_risk_score", "composite_risk_score"),
    ("k6_risk_tier", "risk_tier", "risk_tier"),
):
    ORACLE[_n] = _risk(f"SELECT invoice_number, {_value} AS {_col} FROM risk")
ORACLE["k7_tier_text"] = _risk(
    "SELECT invoice_number, "
    + ", ".join(
        "CASE risk_tier " + " ".join(f"WHEN '{t}' THEN '" + text.replace("'", "''") + "'" for t, text in texts.items()) + f" END AS {name}"
        for name, texts in (("tier_definition", TIER_MEANING), ("tier_recommended_action", TIER_ACTION))
    )
    + " FROM risk"
)
ORACLE["k8_tier_distribution"] = _risk("""
SELECT CAST(o AS BIGINT) AS tier_order, t AS risk_tier, count(invoice_number) AS n,
       round(count(invoice_number) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM risk), 6) AS pct
FROM (VALUES (1, 'Critical'), (2, 'High'), (3, 'Medium'), (4, 'Low')) v(o, t) LEFT JOIN risk ON risk_tier = t GROUP BY o, t""")
ORACLE["k9_exposure_by_tier"] = _risk("""
SELECT risk_tier, CAST(sum(cents) AS DOUBLE) / 100 AS total, round(CAST(sum(cents) AS DOUBLE) / 100 / count(*), 6) AS mean, count(*) AS n FROM (
  SELECT risk_tier, cents FROM risk UNION ALL SELECT 'Critical+High', cents FROM risk WHERE risk_tier IN ('Critical', 'High')) GROUP BY 1""")
_PRIORITY = "risk_tier IN ('Critical', 'High')"
ORACLE["k10_audit_efficiency"] = _risk(f"""
SELECT count(*) AS total_transactions, count(*) FILTER (WHERE {_PRIORITY}) AS needs_review,
       count(*) FILTER (WHERE NOT {_PRIORITY}) AS auto_cleared,
       round(count(*) FILTER (WHERE NOT {_PRIORITY}) * CAST(100 AS DOUBLE) / count(*), 6) AS efficiency_pct FROM risk""")
ORACLE["k12_case_queue"] = _risk("""
SELECT row_number() OVER (ORDER BY composite_risk_score DESC, invoice_number) AS priority_rank, invoice_number, invoice_date, vendor_id,
       CAST(invoice_amount AS DOUBLE) AS invoice_amount, composite_risk_score, risk_tier, rule_triggered, cost_centre, invoice_status FROM risk""")
ORACLE["k13_master_export"] = _risk(
    """
SELECT invoice_number, invoice_date, due_date, payment_date, vendor_id, po_number, gr_number,
       CAST(invoice_amount AS DOUBLE) AS invoice_amount, CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(total_amount AS DOUBLE) AS total_amount,
       invoice_status, cost_centre, department, composite_risk_score, risk_tier, round(ml_component, 6) AS ml_component,
       rule_component, round(value_component, 6) AS value_component, rule_triggered, rule_risk_score,
       CAST(anomaly_flag AS BIGINT) AS anomaly_flag, anomaly_type, ensemble_score, """
    + ", ".join(
        f"round({f}, 6) AS {f}" for f in FEATURES
        if f not in ("feat_vendor_monthly_freq", "feat_pct_of_cc_budget", "feat_benford_dev")
    )
    + " FROM risk"
)
ORACLE["k14_vendor_risk"] = _risk(f"""
SELECT r.vendor_id, CAST(sum(r.cents) AS DOUBLE) / 100 AS total_invoiced, count(*) AS invoice_count,
       round_even(CAST(sum(CAST(round(composite_risk_score * 10) AS BIGINT)) AS DOUBLE) / count(*), 0) / 10 AS avg_risk_score,
       max(composite_risk_score) AS max_risk_score, count(*) FILTER (WHERE risk_tier = 'Critical') AS critical_count,
       count(*) FILTER (WHERE risk_tier = 'High') AS high_count, v.vendor_name, v.vendor_category, v.vendor_creation_date, v.is_ghost_vendor
FROM risk r LEFT JOIN vendors v ON r.vendor_id = v.vendor_id
GROUP BY r.vendor_id, v.vendor_name, v.vendor_category, v.vendor_creation_date, v.is_ghost_vendor""")
ORACLE["k15_budget_table"] = q("""
SELECT cost_centre, department, budget_period, CAST(approved_budget AS DOUBLE) AS approved_budget, CAST(committed_amount AS DOUBLE) AS committed_amount,
       CAST(actual_spend AS DOUBLE) AS actual_spend, CAST(remaining_budget AS DOUBLE) AS remaining_budget,
       CAST(budget_utilisation_pct AS DOUBLE) AS budget_utilisation_pct, is_overrun, CAST(anomaly_flag AS BIGINT) AS anomaly_flag FROM budget""")
_TIERS = ", ".join(
    f"count(*) FILTER (WHERE risk_tier = '{t}') AS {t.lower()}_count" for t in ("Critical", "High", "Medium", "Low")
)
ORACLE["k16_final_check"] = _risk(f"""
SELECT {_TIERS}, CAST(sum(cents) FILTER (WHERE {_PRIORITY}) AS DOUBLE) / 100 AS priority_exposure,
       (SELECT anomaly_type FROM invoices WHERE anomaly_flag = 1 GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS top_anomaly_type
FROM risk""")
_MATCH = """matched AS (
  SELECT i.invoice_number, i.vendor_id, CAST(i.invoice_amount - p.total_po_value AS DOUBLE) * 100.0 / nullif(CAST(p.total_po_value AS DOUBLE), 0) AS dev,
         coalesce(po_cents <> 0 AND 20 * abs(cents - po_cents) <= po_cents, FALSE) AS ok
  FROM invoices i LEFT JOIN purchase_orders p ON i.po_number = p.po_number WHERE i.po_number IS NOT NULL)"""
_TYPES = {
    "ghost_vendor_invoices": "Ghost Vendor Invoice", "maverick_invoices": "Maverick Buying",
    "duplicate_invoices": "Duplicate Invoice", "near_duplicate_invoices": "Near-Duplicate Invoice",
    "match_failure_invoices": "Three-Way Match Failure", "after_hours_invoices": "After-Hours Transaction",
    "round_number_invoices": "Round Number",
}
ORACLE["p1_kpi_row"] = q(
    f"""
SELECT count(*) AS total_transactions, CAST(sum(anomaly_flag) AS BIGINT) AS total_anomalies,
       round(CAST(sum(anomaly_flag) AS DOUBLE) * 100 / count(*), 6) AS detection_rate, {_TIERS},
       CAST(sum(cents) FILTER (WHERE {_PRIORITY}) AS DOUBLE) / 100 AS total_exposure,
       round(count(*) FILTER (WHERE NOT {_PRIORITY}) * CAST(100 AS DOUBLE) / count(*), 6) AS audit_efficiency,
       """
    + ", ".join(f"count(*) FILTER (WHERE anomaly_type = '{t}') AS {n}" for n, t in _TYPES.items())
    + """, (SELECT count(*) FROM budget WHERE is_overrun) AS budget_overruns,
       (SELECT round(count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*), 6) FROM matched) AS match_pass_rate FROM risk""",
    *FULL, _MATCH,
)
_FINDING = "SELECT '{}' AS finding, '{}' AS title, '{}' AS risk_tier, count(*) AS n, coalesce(CAST(sum(cents) AS DOUBLE) / 100, 0.0) AS exposure FROM invoices WHERE anomaly_type IN ({})"
ORACLE["p2_findings"] = q(
    " UNION ALL ".join(
        [
            _FINDING.format("F-01", "Three-Way Match Failures", "Critical", "'Three-Way Match Failure'"),
            _FINDING.format("F-02", "Ghost Vendor Invoices", "Critical", "'Ghost Vendor Invoice'"),
            _FINDING.format("F-03", "Maverick Buying", "High", "'Maverick Buying'"),
            _FINDING.format("F-04", "Duplicate and Near-Duplicate Invoices", "High", "'Duplicate Invoice', 'Near-Duplicate Invoice'"),
            _FINDING.format("F-05", "After-Hours Transaction Postings", "Medium", "'After-Hours Transaction'"),
            "SELECT 'F-06', 'Budget Overruns', 'Medium', count(*), CAST(sum(actual_spend) - sum(approved_budget) AS DOUBLE) FROM budget WHERE is_overrun",
        ]
    )
)

# exploration
ORACLE["e1_calendar"] = q(f"""
SELECT invoice_number, hour(invoice_date) AS invoice_hour, isodow(invoice_date) - 1 AS invoice_dow,
       CAST(date_trunc('month', invoice_date) AS TIMESTAMP) AS invoice_month, year(invoice_date) AS invoice_year,
       isodow(invoice_date) >= 6 AS is_weekend, {OFF_HOURS} AS posted_after_hours, {_days('payment_date', 'invoice_date')} AS days_to_payment
FROM invoices""")
ORACLE["e2_type_counts"] = q("SELECT anomaly_type, count(*) AS n FROM invoices GROUP BY 1")
ORACLE["e3_type_exposure"] = q(
    "SELECT anomaly_type, CAST(sum(invoice_amount) AS DOUBLE) / 1e6 AS exposure_millions FROM invoices GROUP BY 1"
)
ORACLE["e4_anomaly_overview"] = q("""
SELECT CAST(sum(cents) FILTER (WHERE anomaly_flag = 1) AS DOUBLE) / 100 AS anomalous_exposure,
       round(CAST(sum(anomaly_flag) AS DOUBLE) * 100 / count(*), 6) AS anomaly_rate_pct FROM invoices""")


def _hist(rows: str, bins: int, label: str | None) -> str:
    part = f"PARTITION BY {label}" if label else ""
    lab = f"{label}, " if label else ""
    cast = f"CAST({label} AS BIGINT) AS {label}, " if label else ""
    return f"""
SELECT {cast}bin, count(*) AS n FROM (
  SELECT {lab}CAST(least(coalesce(CASE WHEN hi > lo THEN floor((x - lo) / ((hi - lo) / CAST({bins} AS DOUBLE))) END, 0), {bins - 1}) AS BIGINT) AS bin
  FROM (SELECT {lab}x, min(x) OVER ({part}) AS lo, max(x) OVER ({part}) AS hi FROM ({rows}))) GROUP BY ALL"""


ORACLE["e5_log_amount_histogram"] = q(
    _hist("SELECT anomaly_flag, log10(CAST(invoice_amount AS DOUBLE) + 1) AS x FROM invoices WHERE cents > 0", 50, "anomaly_flag")
)
ORACLE["e6_log_amount_boxes"] = q("""
SELECT anomaly_type, round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT anomaly_type, v, quantile_cont(v, 0.25) OVER w AS q1, quantile_cont(v, 0.5) OVER w AS q2, quantile_cont(v, 0.75) OVER w AS q3
      FROM (SELECT anomaly_type, log10(CAST(invoice_amount AS DOUBLE)) AS v FROM invoices WHERE cents > 0)
      WINDOW w AS (PARTITION BY anomaly_type)) GROUP BY anomaly_type""")
_DIGIT = "CASE WHEN cents >= 100 THEN CAST(substr(CAST(cents // 100 AS VARCHAR), 1, 1) AS BIGINT) END"
ORACLE["e7_leading_digits"] = q(f"SELECT invoice_number, {_DIGIT} AS first_digit FROM invoices")
_BENFORD = f"""benf AS (
  SELECT l.anomaly_flag, d.digit, count(i.d) AS observed, l.total, log10(1.0 + 1.0 / CAST(d.digit AS DOUBLE)) AS share
  FROM (SELECT anomaly_flag, count({_DIGIT}) AS total FROM invoices GROUP BY 1) l
  CROSS JOIN (SELECT unnest(range(1, 10)) AS digit) d
  LEFT JOIN (SELECT anomaly_flag, {_DIGIT} AS d FROM invoices) i ON i.anomaly_flag = l.anomaly_flag AND i.d = d.digit
  GROUP BY ALL)"""
ORACLE["e8_benford"] = q(
    "SELECT CAST(anomaly_flag AS BIGINT) AS anomaly_flag, CAST(digit AS BIGINT) AS digit, observed, round(observed * CAST(100 AS DOUBLE) / total, 6) AS observed_pct, round(share * 100, 6) AS expected_pct, round(share * total, 6) AS expected FROM benf",
    _BENFORD,
)
ORACLE["e9_benford_test"] = q("""
SELECT CAST(anomaly_flag AS BIGINT) AS anomaly_flag, round(x, 4) AS chi_square,
       round(exp(-x / 2) * (1 + x / 2 + power(x / 2, 2) / 2 + power(x / 2, 3) / 6), 4) AS p_value
FROM (SELECT anomaly_flag, sum(power(observed - share * total, 2) / (share * total)) AS x FROM benf GROUP BY 1)""", _BENFORD)
_LABELS = "count(*) FILTER (WHERE anomaly_flag = 0) AS normal, count(*) FILTER (WHERE anomaly_flag = 1) AS anomalous"
ORACLE["e10_by_hour"] = q(f"SELECT hour(invoice_date) AS invoice_hour, {_LABELS} FROM invoices GROUP BY 1")
ORACLE["e11_by_weekday"] = q(
    f"SELECT isodow(invoice_date) - 1 AS invoice_dow, {_LABELS}, strftime(any_value(invoice_date), '%a') AS day_name FROM invoices GROUP BY 1"
)
ORACLE["e12_by_month"] = q(f"SELECT strftime(invoice_date, '%Y-%m') AS invoice_month, {_LABELS} FROM invoices GROUP BY 1")
ORACLE["e13_payment_speed"] = q(
    _hist(
        f"SELECT anomaly_flag, CAST(least(d, 120) AS DOUBLE) AS x FROM (SELECT anomaly_flag, {_days('payment_date', 'invoice_date')} AS d FROM invoices) WHERE d > 0",
        40, "anomaly_flag",
    )
)
_VSTATS = """vs AS (
  SELECT i.vendor_id, sum(cents) AS total_cents, count(*) AS invoice_count, CAST(sum(i.anomaly_flag) AS BIGINT) AS anomaly_count,
         v.vendor_name, v.vendor_category, v.is_ghost_vendor
  FROM invoices i LEFT JOIN vendors v ON i.vendor_id = v.vendor_id GROUP BY ALL)"""
ORACLE["e14_vendor_stats"] = q("""
SELECT vendor_id, CAST(total_cents AS DOUBLE) / 100 AS total_invoiced, invoice_count, anomaly_count,
       round(CAST(total_cents AS DOUBLE) / 100 / invoice_count, 6) AS avg_amount, round(CAST(anomaly_count AS DOUBLE) / invoice_count, 6) AS anomaly_rate,
       vendor_name, vendor_category, is_ghost_vendor FROM vs""", _VSTATS)
ORACLE["e15_top_vendors"] = q(
    "SELECT vendor_id, vendor_name, CAST(total_cents AS DOUBLE) / 100 / 1e6 AS total_millions, is_ghost_vendor FROM vs ORDER BY total_cents DESC, vendor_id LIMIT 15",
    _VSTATS,
)
ORACLE["e16_rate_vs_volume"] = q(
    "SELECT vendor_id, invoice_count, round(CAST(anomaly_count AS DOUBLE) / invoice_count * 100, 6) AS anomaly_rate_pct, CAST(total_cents AS DOUBLE) / 100 AS total_invoiced FROM vs",
    _VSTATS,
)
ORACLE["e17_high_rate_vendors"] = q(
    "SELECT vendor_id, invoice_count, anomaly_count FROM vs WHERE 10 * anomaly_count > invoice_count", _VSTATS
)
ORACLE["e18_spend_concentration"] = q(
    "SELECT round(CAST(sum(total_cents) AS DOUBLE) * 100 / (SELECT CAST(sum(cents) AS DOUBLE) FROM invoices), 6) AS top_share_pct FROM (SELECT total_cents FROM vs ORDER BY total_cents DESC, vendor_id LIMIT 10)",
    _VSTATS,
)
ORACLE["e19_match_rows"] = q(
    "SELECT invoice_number, round(dev, 6) AS match_deviation_pct, ok AS match_pass FROM matched", _MATCH
)
ORACLE["e19_match_rate"] = q(
    "SELECT count(*) AS matched_rows, count(*) FILTER (WHERE ok) AS passed, round(count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*), 6) AS match_pass_rate FROM matched",
    _MATCH,
)
ORACLE["e20_deviation_histogram"] = q(
    _hist("SELECT least(greatest(dev, -50.0), 50.0) AS x FROM matched WHERE dev IS NOT NULL", 80, None), _MATCH
)
ORACLE["e21_failure_by_category"] = q("""
SELECT vendor_category, count(*) FILTER (WHERE ok) AS passed, count(*) AS n,
       round((1 - CAST(count(*) FILTER (WHERE ok) AS DOUBLE) / count(*)) * 100, 6) AS fail_rate
FROM matched m JOIN vendors v ON m.vendor_id = v.vendor_id GROUP BY 1""", _MATCH)
ORACLE["e22_budget_bands"] = q("""
SELECT cost_centre || ' (' || budget_period || ')' AS label, CAST(budget_utilisation_pct AS DOUBLE) AS utilisation_pct,
       CASE WHEN budget_utilisation_pct > 100 THEN 'Overrun' WHEN budget_utilisation_pct > 90 THEN 'At Risk' ELSE 'Normal' END AS band FROM budget""")
ORACLE["e23_budget_counts"] = q("""
SELECT count(*) FILTER (WHERE budget_utilisation_pct > 100) AS overrun_count,
       count(*) FILTER (WHERE budget_utilisation_pct > 90 AND budget_utilisation_pct <= 100) AS at_risk_count FROM budget""")
ORACLE["e24_threshold_clustering"] = q("""
SELECT near_count, far_count, round(CAST(near_count AS DOUBLE) / greatest(far_count, 1), 6) AS ratio FROM (
  SELECT count(*) FILTER (WHERE cents >= 9000000 AND cents < 10000000) AS near_count,
         count(*) FILTER (WHERE cents >= 7000000 AND cents < 9000000) AS far_count FROM invoices)""")
ORACLE["e25_threshold_histogram"] = q(
    _hist("SELECT CAST(invoice_amount AS DOUBLE) AS x FROM invoices WHERE cents > 5000000 AND cents < 12000000", 60, None)
)
ORACLE["e26_summary"] = q(f"""
SELECT round(CAST(sum(anomaly_flag) AS DOUBLE) * 100 / count(*), 6) AS anomaly_rate_pct,
       CAST(sum(cents) FILTER (WHERE anomaly_flag = 1) AS DOUBLE) / 100 AS anomalous_exposure,
       count(*) FILTER (WHERE {OFF_HOURS}) AS after_hours_count, count(*) FILTER (WHERE is_maverick) AS maverick_count,
       (SELECT round(count(*) FILTER (WHERE ok) * CAST(100 AS DOUBLE) / count(*), 6) FROM matched) AS match_pass_rate,
       (SELECT count(*) FROM budget WHERE budget_utilisation_pct > 100) AS overrun_count FROM invoices""", _MATCH)

# quality
_COLUMNS = {
    "users": "user_id user_name role department access_level last_login_date is_active",
    "vendors": "vendor_id vendor_name vendor_creation_date vendor_category bank_account_number registered_address contact_email payment_method is_active created_by_user is_ghost_vendor anomaly_flag",
    "budget": "cost_centre department budget_period approved_budget committed_amount actual_spend remaining_budget budget_utilisation_pct is_overrun anomaly_flag",
    "purchase_orders": "po_number po_date vendor_id vendor_name item_description quantity_ordered unit_price total_po_value department cost_centre budget_code approval_status approver_id plant_location is_split_po anomaly_flag",
    "goods_receipts": "gr_number gr_date po_number vendor_id quantity_received actual_unit_price receiving_location received_by anomaly_flag",
    "invoices": "invoice_number invoice_date vendor_invoice_number vendor_id po_number gr_number invoice_amount tax_amount total_amount payment_terms_days due_date payment_date payment_amount invoice_status processed_by approved_by cost_centre is_duplicate is_near_duplicate is_match_failure is_maverick is_after_hours is_round_number is_ghost_vendor_inv anomaly_flag anomaly_type",
}


def _shape(table: str, columns: list[str]) -> str:
    rows = [
        f"SELECT '{table}' AS \"table\", '_rows' AS measure, count(*) AS value, CAST(NULL AS DOUBLE) AS pct FROM {table}",
        f"SELECT '{table}', '_columns', CAST({len(columns)} AS BIGINT), CAST(NULL AS DOUBLE)",
    ]
    rows += [
        f"SELECT '{table}', '{c}', count(*) - count({c}), round((count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*), 6) FROM {table}"
        for c in columns
    ]
    return " UNION ALL ".join(rows)


ORACLE["v1_shape_and_nulls"] = q(" UNION ALL ".join(_shape(t, c.split()) for t, c in _COLUMNS.items()))
ORACLE["v2_duplicate_keys"] = q(
    " UNION ALL ".join(
        _check("duplicate_key", f"{t}.{k[0]}", "duplicates", f"count(*) - count(DISTINCT {k[0]})", t)
        for t, k in _UNIQUE.items() if len(k) == 1
    )
)
_FKS = (
    ("purchase_orders", "vendor_id", "vendors", "vendor_id"), ("goods_receipts", "po_number", "purchase_orders", "po_number"),
    ("invoices", "po_number", "purchase_orders", "po_number"), ("invoices", "vendor_id", "vendors", "vendor_id"),
    ("invoices", "gr_number", "goods_receipts", "gr_number"),
)
ORACLE["v3_orphans"] = q(
    " UNION ALL ".join(
        _check("orphan", f"{c}.{k}", "orphans", "count(*)",
               f"{c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM {p})")
        for c, k, p, pk in _FKS
    )
)
_SEEN = "(SELECT is_duplicate, count(*) OVER (PARTITION BY vendor_id, vendor_invoice_number) AS n FROM invoices)"
ORACLE["v4_labelled_duplicates"] = q(
    _check("labelled_duplicates", "invoices", "labelled", "count(*) FILTER (WHERE is_duplicate)", _SEEN)
    + " UNION ALL "
    + _check("labelled_duplicates", "invoices", "reference_seen_once", "count(*) FILTER (WHERE is_duplicate AND n < 2)", _SEEN)
)
ORACLE["v5_near_duplicate_labels"] = q("""
SELECT invoice_number, vendor_id, CAST(invoice_amount AS DOUBLE) AS invoice_amount, count(*) OVER () AS labelled_total
FROM invoices WHERE is_near_duplicate""")
_SPLITS = "(SELECT vendor_id, count(*) AS n, sum(po_cents) AS total, bool_and(po_cents < 10000000) AS below FROM purchase_orders WHERE is_split_po GROUP BY 1)"
ORACLE["v6_split_labels"] = q(
    " UNION ALL ".join(
        [
            _check("split_labels", "purchase_orders", "labelled", "coalesce(sum(n), 0)", _SPLITS),
            _check("split_labels", "purchase_orders", "all_below_threshold", "CAST(coalesce(bool_and(below), TRUE) AS INT)", _SPLITS),
            _check("split_labels", "purchase_orders", "vendor_groups_above", "count(*) FILTER (WHERE total > 10000000)", _SPLITS),
        ]
    )
)
ORACLE["v6_split_label_groups"] = q(
    f"SELECT vendor_id, n, CAST(total AS DOUBLE) / 100 AS total FROM {_SPLITS} WHERE total > 10000000"
)
ORACLE["v7_match_labels"] = q("""
SELECT count(*) AS labelled, count(*) FILTER (WHERE 20 * abs(cents - po_cents) > po_cents) AS outside_tolerance,
       round(min(CAST(cents - po_cents AS DOUBLE) * 100 / po_cents), 6) AS min_deviation_pct,
       round(max(CAST(cents - po_cents AS DOUBLE) * 100 / po_cents), 6) AS max_deviation_pct, bool_and(invoice_status = 'Blocked') AS all_blocked
FROM invoices i LEFT JOIN purchase_orders p ON i.po_number = p.po_number WHERE is_match_failure""")
ORACLE["v8_maverick_labels"] = q("""
SELECT count(*) AS labelled, bool_and(po_number IS NULL) AS all_without_po, bool_and(gr_number IS NULL) AS all_without_gr
FROM invoices WHERE is_maverick""")
ORACLE["v9_after_hours_labels"] = q(
    f"SELECT count(*) AS labelled, count(*) FILTER (WHERE {OFF_HOURS}) AS outside_hours FROM invoices WHERE is_after_hours"
)
ORACLE["v10_round_labels"] = q("""
SELECT invoice_number, CAST(invoice_amount AS DOUBLE) AS invoice_amount, count(*) OVER () AS labelled_total
FROM invoices WHERE is_round_number""")
ORACLE["v11_ghost_labels"] = q(f"""
SELECT count(*) AS labelled_invoices, min({_days('invoice_date', 'vendor_creation_date')}) AS min_days,
       max({_days('invoice_date', 'vendor_creation_date')}) AS max_days, bool_and(payment_terms_days = 15) AS all_15_day_terms,
       (SELECT count(*) FROM vendors WHERE is_ghost_vendor) AS ghost_vendors
FROM invoices i LEFT JOIN vendors v ON i.vendor_id = v.vendor_id WHERE is_ghost_vendor_inv""")
ORACLE["v12_overrun_rows"] = q("SELECT count(*) AS overrun_rows FROM budget WHERE actual_spend > approved_budget")
_SUBS = " + ".join(
    f"CAST({f} AS INT)" for f in (
        "is_duplicate", "is_near_duplicate", "is_match_failure", "is_maverick", "is_after_hours", "is_round_number", "is_ghost_vendor_inv",
    )
)
ORACLE["v13_flag_consistency"] = q(f"""
SELECT count(*) FILTER (WHERE anomaly_flag = 1) AS anomalous, count(*) FILTER (WHERE anomaly_flag = 1 AND n = 1) AS one_flag,
       count(*) FILTER (WHERE anomaly_flag = 1 AND n = 0) AS no_flag, count(*) FILTER (WHERE anomaly_flag = 1 AND n > 1) AS several_flags,
       count(*) FILTER (WHERE anomaly_flag = 0 AND n > 0) AS normal_with_flag
FROM (SELECT anomaly_flag, {_SUBS} AS n FROM invoices)""")

# --- explanations -----------------------------------------------------------


def _w(amount: str) -> str:
    """Whole units with thousands separators, half-even."""
    return f"'₹' || format('{{:,}}', CAST(round_even(CAST({amount} AS DOUBLE), 0) AS BIGINT))"


def _f(x: str, digits: int = 1) -> str:
    return f"format('{{:.{digits}f}}', {x})"


TEXTS = f"""texts AS (
  SELECT invoice_number, 1 AS rule_no, 'Invoice ' || invoice_number || ' of vendor ' || vendor_id || ' for ' || {_w('invoice_amount')}
         || ' repeats ' || pn || ', posted ' || {_days('invoice_date', 'pd')} || ' days earlier under the same vendor reference.' AS explanation
  FROM (SELECT *, lag(invoice_date) OVER w AS pd, lag(invoice_number) OVER w AS pn FROM invoices
        WINDOW w AS (PARTITION BY vendor_id, vendor_invoice_number ORDER BY invoice_date, invoice_number)) WHERE pn IS NOT NULL
  UNION ALL
  SELECT invoice_number, 2, 'Invoice ' || invoice_number || ' (' || {_w('invoice_amount')} || ') differs by '
         || {_f('abs(CAST(CAST(invoice_amount * 100 AS BIGINT) - CAST(matched_amount * 100 AS BIGINT) AS DOUBLE) / 100) * 100 / matched_amount')}
         || '% from ' || matched_invoice || ' (' || {_w('matched_amount')} || ') of the same vendor, ' || days_apart
         || ' days apart; a small change can hide a duplicate.' FROM near
  UNION ALL
  SELECT p.po_number, 3, 'Order ' || p.po_number || ' to vendor ' || p.vendor_id || ' for ' || {_w('p.total_po_value')} || ' is one of ' || g.n
         || ' orders within 30 days, each below ₹100,000, together ' || {_w('CAST(g.total AS DOUBLE) / 100')} || '.'
  FROM purchase_orders p JOIN (
    SELECT a.vendor_id, a.po_date AS w, count(DISTINCT b.po_number) AS n, sum(b.po_cents) AS total
    FROM (SELECT DISTINCT vendor_id, po_date FROM purchase_orders WHERE po_cents < 10000000) a
    JOIN purchase_orders b ON a.vendor_id = b.vendor_id AND b.po_date >= a.po_date AND b.po_date <= a.po_date + INTERVAL '30' DAY
    WHERE b.po_cents < 10000000 GROUP BY a.vendor_id, a.po_date HAVING count(*) >= 2 AND sum(b.po_cents) > 10000000
    QUALIFY row_number() OVER (PARTITION BY a.vendor_id ORDER BY a.po_date) = 1) g ON g.vendor_id = p.vendor_id
  UNION ALL
  SELECT invoice_number, 4, 'Invoice ' || invoice_number || ' for ' || {_w('invoice_amount')} || ' is '
         || {_f('CAST(abs(i.invoice_amount - total_po_value) AS DOUBLE) * 100 / CAST(total_po_value AS DOUBLE)')} || '% '
         || CASE WHEN cents > po_cents THEN 'OVER' ELSE 'UNDER' END || ' the order value ' || {_w('total_po_value')} || ', beyond the 5% tolerance.'
  FROM invoices i JOIN purchase_orders p ON i.po_number = p.po_number
  UNION ALL
  SELECT invoice_number, 5, 'Invoice ' || invoice_number || ' for ' || {_w('invoice_amount')} || ' of vendor ' || vendor_id || ' refers to no purchase order.'
  FROM invoices
  UNION ALL
  SELECT invoice_number, 6, 'Invoice ' || invoice_number || ' for ' || {_w('invoice_amount')} || ' was posted '
         || CASE isodow(invoice_date) WHEN 6 THEN 'on a Saturday' WHEN 7 THEN 'on a Sunday'
            ELSE 'at ' || strftime(invoice_date, '%H') || CASE WHEN hour(invoice_date) < 8 THEN ':00 (before business hours)' ELSE ':00 (after business hours)' END END
         || '; business hours are 08:00-19:00 on weekdays.' FROM invoices
  UNION ALL
  SELECT {_BUDGET_KEY}, 7, 'Cost centre ' || cost_centre || ' (' || department || ') spent ' || {_w('actual_spend')} || ' of ' || {_w('approved_budget')}
         || ' in ' || budget_period || ', over by ' || {_w('actual_spend - approved_budget')} || ' ('
         || {_f('CAST(actual_spend - approved_budget AS DOUBLE) * 100 / CAST(approved_budget AS DOUBLE)')} || '%).' FROM budget
  UNION ALL
  SELECT invoice_number, 8, 'Invoice ' || invoice_number || ' has the round amount ' || {_w('invoice_amount')} || '; real deliveries seldom come to full thousands.' FROM invoices
  UNION ALL
  SELECT invoice_number, 9, 'Invoice ' || invoice_number || ' for ' || {_w('invoice_amount')} || ' of vendor ' || i.vendor_id || ' came '
         || {_days('invoice_date', 'vendor_creation_date')} || ' days after the vendor was created'
         || CASE WHEN is_ghost_vendor THEN ' (POTENTIAL GHOST VENDOR)' ELSE '' END || '.'
  FROM invoices i JOIN vendors v ON i.vendor_id = v.vendor_id)"""


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULE_NO = "CASE rule_triggered " + " ".join(f"WHEN '{name}' THEN {no}" for no, name in RULE_NAMES.items()) + " END"
_ACTION = "CASE t.rule_no " + " ".join(f"WHEN {no} THEN {_sql(text)}" for no, text in ACTIONS.items()) + " END"
ORACLE["r10_exceptions_with_text"] = q(
    f"""
SELECT r.invoice_number, rule_triggered, risk_score, explanation, {_ACTION} AS recommended_action, financial_value, rule_tier AS risk_tier
FROM report r JOIN texts t ON t.invoice_number = r.invoice_number AND t.rule_no = {_RULE_NO}""",
    *ALL_RULES, TEXTS,
)
ORACLE["k11_full_explanation"] = q(
    f"""
SELECT r.invoice_number, coalesce(nullif(concat_ws(' ', t.explanation,
         CASE WHEN ml_component > 70 THEN 'The models see a strong outlier (ensemble score in the top ' || {_f('CAST(100 AS DOUBLE) - ml_component', 0)} || '% of its range).' END), ''),
         'No rule hit and no strong model signal; kept for completeness.') AS full_explanation
FROM risk r LEFT JOIN texts t ON t.invoice_number = r.invoice_number AND t.rule_no = {_RULE_NO}""",
    *FULL, TEXTS,
)


# --- facts about results of fitted models -----------------------------------

_N = "CAST((SELECT count(*) FROM invoices) AS BIGINT)"
ORACLE["x2_seeded_sample"] = q(
    "SELECT invoice_number, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURES)
    + " FROM feat ORDER BY md5(invoice_number || '42'), invoice_number LIMIT 2000",
    FEAT,
)
ORACLE["m1_forest_facts"] = q(
    f"SELECT CAST(200 AS BIGINT) AS trees, least(256, {_N}) AS least_root, least(256, {_N}) AS largest_root, CAST(0 AS BIGINT) AS uneven_nodes"
)
for _name in ("m2_score_facts", "m6_error_facts"):
    ORACLE[_name] = q(f"SELECT {_N} AS n, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS outside")
ORACLE["m3_cut_facts"] = q(f"SELECT {_N} AS n, TRUE AS split_by_score, TRUE AS within_share")
for _name in ("m4_importance_facts", "x3_importance_facts", "x4_top_case_facts"):
    ORACLE[_name] = q(" UNION ALL ".join(f"SELECT '{f}' AS feature" for f in FEATURES))
ORACLE["m5_history_facts"] = q("SELECT TRUE AS every_epoch, CAST(1 AS BIGINT) AS best_epochs, TRUE AS best_is_least")
for _name in ("m12_ensemble_facts", "x1_additivity_facts"):
    ORACLE[_name] = q(f"SELECT {_N} AS n, TRUE AS adds_up")
ORACLE["m14_comparison_facts"] = q(
    " UNION ALL ".join(
        f"SELECT '{m}' AS model, {_N} AS n, CAST((SELECT count(*) FROM invoices WHERE anomaly_flag = 1) AS BIGINT) AS positives"
        for m in ("Isolation Forest", "Autoencoder", "Ensemble")
    )
)
ORACLE["k2_model_risk_facts"] = q(f"SELECT {_N} AS n, CAST(0 AS BIGINT) AS odd_score, CAST(0 AS BIGINT) AS odd_tier")
ORACLE["k13_model_export_facts"] = q(f"SELECT {_N} AS n, {_N} AS numbers")
ORACLE["x6_top_cases_facts"] = q("SELECT CAST(5 AS BIGINT) AS n, CAST(5 AS BIGINT) AS numbers")
for _name in ("x5_sentence_facts", "x7_priority_facts"):
    ORACLE[_name] = q("SELECT TRUE AS all_cases, TRUE AS each_once, CAST(0 AS BIGINT) AS without_text")


# --- forest, scores and contributions by value ------------------------------

_FOREST = (FEAT, SCALER, grown.inputs(FEATURES), grown.GROWN)
ORACLE["m1_forest_nodes"] = q(
    """SELECT CAST(tree AS BIGINT) AS tree, CAST(node AS BIGINT) AS node, CAST(feature AS BIGINT) AS feature, round(threshold, 6) AS threshold,
       CAST(CASE WHEN feature >= 0 THEN 2 * node ELSE node END AS BIGINT) AS "left", CAST(CASE WHEN feature >= 0 THEN 2 * node + 1 ELSE node END AS BIGINT) AS "right",
       CAST(n AS BIGINT) AS n, CAST(depth AS BIGINT) AS depth FROM nodes""",
    *_FOREST,
)
ORACLE["m2_anomaly_score"] = q("SELECT key AS invoice_number, round(iso_score, 6) AS iso_score FROM iso", *_FOREST, *grown.scores())
ORACLE["m3_contamination_cut"] = q(
    """SELECT key AS invoice_number, round(iso_score, 6) AS iso_score,
       CAST(iso_score > (SELECT quantile_cont(iso_score, 0.95) FROM iso) AS BIGINT) AS iso_prediction FROM iso""",
    *_FOREST, *grown.scores(),
)
ORACLE["m14_forest_comparison"] = q(
    f"""SELECT 'Isolation Forest' AS model, c.tn, c.fp, c.fn, c.tp, round(c.precision, 6) AS precision, round(c.recall, 6) AS recall, round(c.f1, 6) AS f1,
      round((SELECT (sum(CASE WHEN label = 1 THEN r ELSE 0 END) - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2) / (CAST(sum(label) AS DOUBLE) * sum(1 - label))
        FROM (SELECT label, rank() OVER (ORDER BY iso_score) + (count(*) OVER (PARTITION BY iso_score) - 1) / 2.0 AS r FROM iso)), 6) AS auc
    FROM ({_confusion("SELECT label AS y, CAST(iso_score > (SELECT quantile_cont(iso_score, 0.95) FROM iso) AS INT) AS p FROM iso")}) c""",
    *_FOREST, *grown.scores(),
)
# A feature's values are taken from the row half the table ahead in the order of a hash.
_MOVED = f"""mixed AS (SELECT *, row_number() OVER (ORDER BY md5(key || ':42'), key) AS r, count(*) OVER () AS n FROM fx),
moved AS MATERIALIZED (SELECT a.key, a.label, run, list_transform(range(1, {len(FEATURES)} + 1), lambda i: CASE WHEN i = run THEN b.x[i] ELSE a.x[i] END) AS x
  FROM mixed a JOIN mixed b ON b.r = (a.r - 1 + a.n // 2) % a.n + 1 CROSS JOIN (SELECT unnest(range({len(FEATURES)} + 1)) AS run))"""
ORACLE["m4_permutation_importance"] = q(
    f"""SELECT [{', '.join(repr(f) for f in FEATURES)}][f] AS feature, round((SELECT auc FROM aucs WHERE run = 0) - auc, 6) AS auc_drop FROM (SELECT *, run AS f FROM aucs) WHERE run > 0""",
    *_FOREST, _MOVED, *grown.scores("moved", "key, label, run"),
    """aucs AS (SELECT run, (sum(CASE WHEN label = 1 THEN r ELSE 0 END) - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / 2) / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) AS auc
      FROM (SELECT run, label, rank() OVER (PARTITION BY run ORDER BY iso_score) + (count(*) OVER (PARTITION BY run, iso_score) - 1) / 2.0 AS r FROM iso) GROUP BY run)""",
)
_LONG = "unnest([" + ", ".join(f"{{'feature': '{f}', 'label': {_sql(FEATURE_LABELS[f])}, 'c': p{i}}}" for i, f in enumerate(FEATURES)) + "], recursive := true)"
ORACLE["x1_contributions"] = q(
    f"""SELECT key AS invoice_number, round((SELECT base_value FROM baseline), 6) AS base_value, feature, label, round(c, 6) AS contribution
    FROM (SELECT key, {_LONG} FROM phi)""",
    *_FOREST, grown.CONTRIBUTIONS, grown.contributions("fx"),
)
ORACLE["x3_global_importance"] = q(
    f"""SELECT feature, label, round(avg(abs(c)), 6) AS mean_abs_contribution FROM (SELECT key, {_LONG} FROM phi) GROUP BY feature, label""",
    *_FOREST, grown.CONTRIBUTIONS, grown.contributions("fx"),
)

# Cases as the forest alone ranks them.
_ISO_SCORED = "scored AS (SELECT f.*, iso_score AS score FROM feat f JOIN iso ON iso.key = f.invoice_number)"
_FOREST_RISK = (*ALL_RULES, *_FOREST, *grown.scores(), _ISO_SCORED, RISK)
_FOREST_TOP = "ranked AS (SELECT *, row_number() OVER (ORDER BY composite_risk_score DESC, invoice_number) AS place FROM risk)"
_FOREST_CASES = (
    *_FOREST_RISK, _FOREST_TOP,
    "asked AS MATERIALIZED (SELECT fx.* FROM fx JOIN ranked ON key = invoice_number WHERE risk_tier IN ('Critical', 'High') OR place <= 5)",
    grown.CONTRIBUTIONS, grown.contributions("asked"),
)
_SAID = {
    "feat_amount_zscore": f"{_f('feat_amount_zscore')} || ' sample deviations from the mean of the vendor''s invoices'",
    "feat_invoice_to_po_ratio": f"""{_f('abs((feat_invoice_to_po_ratio - 1) * 100)', 0)}
        || CASE WHEN (feat_invoice_to_po_ratio - 1) * 100 > 0 THEN '% more than ordered' ELSE '% less than ordered' END""",
    "feat_vendor_age_days": f"{_f('feat_vendor_age_days', 0)} || ' days between the vendor''s creation and the invoice'",
    "feat_days_to_payment": "CAST(NULL AS VARCHAR)",
    "feat_vendor_monthly_freq": f"{_f('feat_vendor_monthly_freq', 0)} || ' invoices of the vendor in the calendar month'",
    "feat_pct_of_cc_budget": f"'amount equal to ' || {_f('feat_pct_of_cc_budget * 100')} || '% of the cost centre''s approved budgets'",
    "feat_after_hours": "CASE WHEN feat_after_hours = 1 THEN 'time stamp on a weekend or off the business hours' END",
    "feat_no_po": "CASE WHEN feat_no_po = 1 THEN 'order number missing' END",
    "feat_round_number": "CASE WHEN feat_round_number = 1 THEN 'amount in full thousands' END",
    "feat_benford_dev": "'first digit with an expected share far from one ninth'",
}
_SENTENCES = f"""reasons AS (SELECT invoice_number, unnest([{', '.join(f"{{'i': {i}, 'c': p{i}, 'said': {_SAID[f]}}}" for i, f in enumerate(FEATURES))}], recursive := true)
  FROM ranked JOIN phi ON key = invoice_number),
told AS (SELECT invoice_number, string_agg(said, '; ' ORDER BY abs(c) DESC, i) AS said FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_number ORDER BY abs(c) DESC, i) AS place FROM reasons) WHERE place <= 3 AND c > 0 AND said IS NOT NULL GROUP BY 1),
cases AS (SELECT r.*, CASE WHEN said IS NULL THEN 'Score raised by nothing that has words.' ELSE 'Score raised by: ' || said || '.' END AS shap_explanation
  FROM ranked r JOIN asked ON key = r.invoice_number LEFT JOIN told t ON t.invoice_number = r.invoice_number)"""
ORACLE["k2_forest_risk"] = q(
    "SELECT invoice_number, round(ml_component, 4) AS ml_component, composite_risk_score, risk_tier FROM risk", *_FOREST_RISK
)
ORACLE["x4_forest_top_case"] = q(
    f"""SELECT invoice_number, composite_risk_score, round((SELECT base_value FROM baseline), 6) AS base_value, feature, label, round(c, 6) AS contribution
    FROM (SELECT invoice_number, composite_risk_score, {_LONG} FROM phi JOIN ranked ON key = invoice_number WHERE place = 1)""",
    *_FOREST_CASES,
)
ORACLE["x5_forest_sentences"] = q(f"SELECT invoice_number, shap_explanation FROM cases WHERE {_PRIORITY}", *_FOREST_CASES, _SENTENCES)
ORACLE["x6_forest_top_cases"] = q(
    "SELECT invoice_number, composite_risk_score AS risk_score, shap_explanation FROM cases WHERE place <= 5", *_FOREST_CASES, _SENTENCES
)
_EXPLAINED = f"""coalesce(nullif(concat_ws(' ', t.explanation,
    CASE WHEN ml_component > 70 THEN 'The models see a strong outlier (ensemble score in the top ' || {_f('CAST(100 AS DOUBLE) - ml_component', 0)} || '% of its range).' END), ''),
    'No rule hit and no strong model signal; kept for completeness.')"""
ORACLE["x7_forest_priority_cases"] = q(
    f"""SELECT r.invoice_number, vendor_id, CAST(invoice_amount AS DOUBLE) AS invoice_amount, composite_risk_score, risk_tier, rule_triggered,
       {_EXPLAINED} AS full_explanation, shap_explanation
    FROM cases r LEFT JOIN texts t ON t.invoice_number = r.invoice_number AND t.rule_no = {_RULE_NO} WHERE {_PRIORITY}""",
    *_FOREST_CASES, _SENTENCES, TEXTS,
)
