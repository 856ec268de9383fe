"""Detection rules. Each returns exceptions of one shared shape; the report
keeps the strongest one per key.

Shape: invoice_number, rule_no, rule_triggered, risk_score, explanation,
recommended_action, financial_value. The key is an invoice number, a PO number
(split orders) or `BUDGET-<cost centre>-<period>` (overruns).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, RULE_NAMES, AuditConfig
from tallymark.functions.expressions import (
    MICROS_PER_DAY,
    days_floor,
    deviates,
    fixed,
    is_after_hours,
    is_round,
    micros,
    plus_days,
    safe_ratio,
    tier,
    whole,
)
from tallymark.functions.joins import left_lookup
from tallymark.functions.ordering import previous_row, running_totals
from tallymark.operators import near_duplicates as nd

ACTIONS = {
    1: "Hold the payment, ask the vendor which invoice is open and review who posted both.",
    2: "Check both invoices against order and receipt; escalate if only one delivery exists.",
    3: "Ask for approval after the fact and review why the purchase was divided.",
    4: "Keep the payment blocked until order, receipt and invoice are reconciled.",
    5: "Raise an order after the fact and check that the vendor is approved.",
    6: "Check access logs and the business reason for posting at this time.",
    7: "Obtain a supplementary budget and review the cost centre's postings.",
    8: "Ask for time sheets or delivery notes that support the amount.",
    9: "Verify the vendor's registration and bank account through another channel.",
}


def _exceptions(
    df: DataFrame, rule: int, key: str | Column, score: Column | int, text: Column, value: str
) -> DataFrame:
    score = F.lit(score) if isinstance(score, int) else score
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        key.alias("invoice_number"),
        F.lit(rule).alias("rule_no"),
        F.lit(RULE_NAMES[rule]).alias("rule_triggered"),
        score.cast("int").alias("risk_score"),
        text.alias("explanation"),
        F.lit(ACTIONS[rule]).alias("recommended_action"),
        F.round(F.col(value), 2).cast("decimal(17,2)").alias("financial_value"),
    )


def _say(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _amt(col: str) -> Column:
    return F.concat(F.lit("₹"), whole(F.col(col)))


def exact_duplicates(
    invoices: DataFrame, cfg: AuditConfig = DEFAULT, chunks: int | None = None
) -> DataFrame:
    """Same vendor and reference, equal amount, at most 30 days after the
    posting just before it. Only repeated references are put in order."""
    keys = ["vendor_id", "vendor_invoice_number"]
    narrow = invoices.select(*keys, "invoice_date", "invoice_number", "invoice_amount").dropna(
        subset=[*keys, "invoice_date"]
    )
    repeated = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    rows = narrow.join(repeated.select(*keys), keys, "left_semi")
    seen = previous_row(
        rows, keys, ["invoice_date", "invoice_number"],
        ["invoice_date", "invoice_number", "invoice_amount"], chunks,
    )
    days = days_floor(F.col("invoice_date"), F.col("prev.invoice_date"))
    same = F.abs(F.col("invoice_amount") - F.col("prev.invoice_amount")) < F.lit(cfg.dup_amount_epsilon)
    hits = seen.withColumn("days_apart", days).filter(
        same & (F.col("days_apart") <= cfg.dup_date_window_days)
    )
    text = _say(
        "Invoice ", F.col("invoice_number"), " of vendor ", F.col("vendor_id"), " for ",
        _amt("invoice_amount"), " repeats ", F.col("prev.invoice_number"), ", posted ",
        F.col("days_apart").cast("string"), " days earlier under the same vendor reference.",
    )
    return _exceptions(hits, 1, "invoice_number", 8, text, "invoice_amount")


def _near_exceptions(found: DataFrame) -> DataFrame:
    pct = F.abs(F.col("invoice_amount") - F.col("matched_amount")).cast("double") * 100 / F.col(
        "matched_amount"
    ).cast("double")
    text = _say(
        "Invoice ", F.col("invoice_number"), " (", _amt("invoice_amount"), ") differs by ",
        fixed(pct, 1), "% from ", F.col("matched_invoice"), " (", _amt("matched_amount"),
        ") of the same vendor, ", F.col("days_apart").cast("string"),
        " days apart; a small change can hide a duplicate.",
    )
    return _exceptions(found, 2, "invoice_number", 6, text, "invoice_amount")


def near_duplicates(invoices: DataFrame, cfg: AuditConfig = DEFAULT, near: DataFrame | None = None) -> DataFrame:
    """One exception per flagged invoice (what the report keeps). `near` is the result of
    rule 2's search where it is known already."""
    return _near_exceptions(nd.near_duplicates(invoices, cfg) if near is None else near)


def _split_windows(orders: DataFrame, cfg: AuditConfig, chunks: int | None = None) -> DataFrame:
    """First qualifying window per vendor: start, end, number and sum of orders.

    Orders of one vendor and instant are summed first. Every instant is also
    asked about `split_window_days` later; running totals along (vendor, time)
    over instants and questions give what lies before either, and a window is
    the difference. A vendor of any size is cut across chunks.
    """
    instants = orders.groupBy("vendor_id", F.col("po_date").alias("start")).agg(
        F.sum("total_po_value").alias("value"), F.count(F.lit(1)).alias("n")
    ).withColumn("t", micros(F.col("start")))
    span = F.lit(cfg.split_window_days * MICROS_PER_DAY)
    asked = instants.select(
        "vendor_id", "start", F.lit(None).cast(instants.schema["value"].dataType).alias("value"),
        F.lit(0).cast("bigint").alias("n"), (F.col("t") + span).alias("t"), F.lit(1).alias("kind"),
    )
    points = instants.select("vendor_id", "start", "value", "n", "t", F.lit(0).alias("kind")).unionByName(asked)
    run = running_totals(points, ["t", "kind", "start"], ["value", "n"], ("vendor_id",), chunks)
    ends = F.col("kind") == 1
    sums = run.groupBy("vendor_id", "start").agg(
        *[
            (F.max(F.when(ends, F.col(f"before_{c}"))) - F.max(F.when(~ends, F.col(f"before_{c}")))).alias(name)
            for c, name in (("n", "group_size"), ("value", "group_value"))
        ]
    )
    return (
        sums.filter((F.col("group_size") >= 2) & (F.col("group_value") > F.lit(cfg.approval_threshold)))
        .groupBy("vendor_id")
        .agg(F.min(F.struct("start", "group_size", "group_value")).alias("w"))
        .select("vendor_id", "w.*")
    )


def split_orders(purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Orders below the threshold in a vendor's first 30-day window whose sum
    exceeds it."""
    small = purchase_orders.filter(
        F.col("vendor_id").isNotNull()
        & F.col("po_date").isNotNull()
        & (F.col("total_po_value") < F.lit(cfg.approval_threshold))
    ).select("po_number", "vendor_id", "po_date", "total_po_value")
    hits = small.join(_split_windows(small, cfg), "vendor_id").filter(
        (F.col("po_date") >= F.col("start"))
        & (F.col("po_date") <= plus_days(F.col("start"), cfg.split_window_days))
    )
    text = _say(
        "Order ", F.col("po_number"), " to vendor ", F.col("vendor_id"), " for ",
        _amt("total_po_value"), " is one of ", F.col("group_size").cast("string"),
        f" orders within {cfg.split_window_days} days, each below ₹{cfg.approval_threshold:,.0f}, together ",
        _amt("group_value"), ".",
    )
    return _exceptions(hits, 3, "po_number", 7, text, "total_po_value")


# Rules that a single invoice row decides, once its order's value and its vendor's
# creation are at hand: (condition, score, explanation).
Terms = tuple[Column, Column, Column]


def _match_terms(cfg: AuditConfig) -> Terms:
    gap = F.col("invoice_amount") - F.col("total_po_value")
    severe = deviates(F.col("invoice_amount"), F.col("total_po_value"), cfg.match_severe)
    pct = F.abs(gap).cast("double") * 100 / F.abs(F.col("total_po_value")).cast("double")
    over = (gap > 0) == (F.col("total_po_value") > 0)
    text = _say(
        "Invoice ", F.col("invoice_number"), " for ", _amt("invoice_amount"), " is ",
        fixed(pct, 1), "% ", F.when(over, "OVER").otherwise("UNDER"), " the order value ",
        _amt("total_po_value"), f", beyond the {cfg.match_tolerance:.0%} tolerance.",
    )
    beyond = deviates(F.col("invoice_amount"), F.col("total_po_value"), cfg.match_tolerance)
    return beyond, F.when(severe, 7).otherwise(5), text


def _maverick_terms(cfg: AuditConfig) -> Terms:
    text = _say(
        "Invoice ", F.col("invoice_number"), " for ", _amt("invoice_amount"), " of vendor ",
        F.col("vendor_id"), " refers to no purchase order.",
    )
    return F.col("po_number").isNull(), F.lit(5), text


def _after_hours_terms(cfg: AuditConfig) -> Terms:
    day, hour = F.weekday("invoice_date"), F.hour("invoice_date")
    clock = F.concat(F.lit("at "), F.date_format("invoice_date", "HH"), F.lit(":00 "))
    timing = (
        F.when(day == 5, "on a Saturday")
        .when(day == 6, "on a Sunday")
        .when(hour < cfg.biz_hour_start, F.concat(clock, F.lit("(before business hours)")))
        .otherwise(F.concat(clock, F.lit("(after business hours)")))
    )
    text = _say(
        "Invoice ", F.col("invoice_number"), " for ", _amt("invoice_amount"), " was posted ", timing,
        f"; business hours are {cfg.biz_hour_start:02d}:00-{cfg.biz_hour_end:02d}:00 on weekdays.",
    )
    return is_after_hours(F.col("invoice_date"), cfg), F.lit(4), text


def _round_terms(cfg: AuditConfig) -> Terms:
    text = _say(
        "Invoice ", F.col("invoice_number"), " has the round amount ", _amt("invoice_amount"),
        "; real deliveries seldom come to full thousands.",
    )
    return is_round(F.col("invoice_amount"), cfg), F.lit(3), text


def _new_vendor_terms(cfg: AuditConfig) -> Terms:
    age = days_floor(F.col("invoice_date"), F.col("vendor_creation_date"))
    ghost = F.coalesce(F.col("is_ghost_vendor"), F.lit(False))
    text = _say(
        "Invoice ", F.col("invoice_number"), " for ", _amt("invoice_amount"), " of vendor ",
        F.col("vendor_id"), " came ", age.cast("string"),
        " days after the vendor was created",
        F.when(ghost, " (POTENTIAL GHOST VENDOR)").otherwise(""), ".",
    )
    return age <= cfg.new_vendor_days, F.when(ghost, 9).otherwise(6), text


def _single(df: DataFrame, rule: int, terms: Terms) -> DataFrame:
    condition, score, text = terms
    return _exceptions(df.filter(condition), rule, "invoice_number", score, text, "invoice_amount")


def match_failures(
    invoices: DataFrame, purchase_orders: DataFrame, cfg: AuditConfig = DEFAULT
) -> DataFrame:
    """Invoice differs from its order by more than 5%; above 20% scores higher."""
    return _single(invoices.join(_order_values(purchase_orders), "po_number"), 4, _match_terms(cfg))


def maverick(invoices: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    return _single(invoices, 5, _maverick_terms(cfg))


def after_hours(invoices: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    return _single(invoices, 6, _after_hours_terms(cfg))


def round_amounts(invoices: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    return _single(invoices, 8, _round_terms(cfg))


def new_vendors(invoices: DataFrame, vendors: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Invoice within 7 days of the vendor's creation, or before it."""
    return _single(invoices.join(_vendor_ages(vendors), "vendor_id"), 9, _new_vendor_terms(cfg))


def _order_values(purchase_orders: DataFrame) -> DataFrame:
    return purchase_orders.select("po_number", "total_po_value")


def _vendor_ages(vendors: DataFrame) -> DataFrame:
    return vendors.select("vendor_id", "vendor_creation_date", "is_ghost_vendor")


def _row_terms(cfg: AuditConfig) -> dict[int, tuple]:
    """The rules that one row with its order and vendor decides."""
    return {
        4: _match_terms(cfg), 5: _maverick_terms(cfg), 6: _after_hours_terms(cfg),
        8: _round_terms(cfg), 9: _new_vendor_terms(cfg),
    }


def _with_lookups(invoices: DataFrame, purchase_orders: DataFrame, vendors: DataFrame) -> DataFrame:
    joined = left_lookup(invoices, _order_values(purchase_orders), "po_number", "invoice_number")
    return left_lookup(joined, _vendor_ages(vendors), "vendor_id", "invoice_number")


def strongest_of_row(
    invoices: DataFrame, purchase_orders: DataFrame, vendors: DataFrame, cfg: AuditConfig = DEFAULT
) -> DataFrame:
    """The strongest of rules 4, 5, 6, 8 and 9 for every invoice that breaks
    one, from a single pass over the invoices; explanations are written for the
    chosen rule only."""
    terms = _row_terms(cfg)
    joined = _with_lookups(invoices, purchase_orders, vendors)
    # one number orders score (high first), then rule
    codes = [F.when(broken, -100 * score + rule) for rule, (broken, score, _) in terms.items()]
    chosen = joined.withColumn("_code", F.array_min(F.array(*codes))).filter(F.col("_code").isNotNull())
    chosen = chosen.withColumn("_rule", F.pmod("_code", F.lit(100)))

    def of_rule(values: dict[int, Column]) -> Column:
        out = F.lit(None)
        for rule, value in values.items():
            out = F.when(F.col("_rule") == rule, value).otherwise(out)
        return out

    return chosen.select(
        "invoice_number",
        F.col("_rule").cast("int").alias("rule_no"),
        of_rule({r: F.lit(RULE_NAMES[r]) for r in terms}).alias("rule_triggered"),
        F.expr("(_rule - _code) / 100").cast("int").alias("risk_score"),
        of_rule({r: t[2] for r, t in terms.items()}).alias("explanation"),
        of_rule({r: F.lit(ACTIONS[r]) for r in terms}).alias("recommended_action"),
        F.round(F.col("invoice_amount"), 2).cast("decimal(17,2)").alias("financial_value"),
    )


def budget_overruns(budget: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    hits = budget.filter(F.col("actual_spend") > F.col("approved_budget")).withColumn(
        "overrun", F.col("actual_spend") - F.col("approved_budget")
    )
    severe = (F.col("approved_budget") >= 0) & (
        F.col("overrun") > F.lit(cfg.budget_severe) * F.col("approved_budget")
    )
    pct = F.try_divide(
        F.col("overrun").cast("double") * 100, F.col("approved_budget").cast("double")
    )
    key = F.concat(F.lit("BUDGET-"), "cost_centre", F.lit("-"), "budget_period")
    text = _say(
        "Cost centre ", F.col("cost_centre"), " (", F.coalesce("department", F.lit("no department")),
        ") spent ", _amt("actual_spend"), " of ", _amt("approved_budget"), " in ",
        F.col("budget_period"), ", over by ", _amt("overrun"), " (",
        F.coalesce(fixed(pct, 1), F.lit("n/a ")), "%).",
    )
    return _exceptions(hits, 7, key, F.when(severe, 6).otherwise(4), text, "overrun")


# --- report over all rules --------------------------------------------------


def all_exceptions(
    invoices: DataFrame,
    purchase_orders: DataFrame,
    vendors: DataFrame,
    budget: DataFrame,
    cfg: AuditConfig = DEFAULT,
    near: DataFrame | None = None,
) -> DataFrame:
    """Exceptions of every rule before deduplication; rule 2 gives one per
    flagged invoice, whatever the number of its partners."""
    parts = [
        exact_duplicates(invoices, cfg),
        near_duplicates(invoices, cfg, near),
        split_orders(purchase_orders, cfg),
        match_failures(invoices, purchase_orders, cfg),
        maverick(invoices, cfg),
        after_hours(invoices, cfg),
        budget_overruns(budget, cfg),
        round_amounts(invoices, cfg),
        new_vendors(invoices, vendors, cfg),
    ]
    return reduce(DataFrame.unionByName, parts)


def strongest(exceptions: DataFrame) -> DataFrame:
    """One row per key: highest score, then lowest rule number, then text.

    A grouped minimum instead of a ranking window: it combines before the
    shuffle, so a key with many hits costs nothing extra.
    """
    order = F.struct(
        (-F.col("risk_score")).alias("neg"), "rule_no", "explanation", "rule_triggered",
        "risk_score", "recommended_action", "financial_value",
    )
    kept = exceptions.groupBy("invoice_number").agg(F.min(order).alias("best"))
    return kept.select(
        "invoice_number", "best.rule_triggered", "best.risk_score", "best.explanation",
        "best.recommended_action", "best.financial_value",
    )


def with_rule_tier(exceptions: DataFrame) -> DataFrame:
    return exceptions.withColumn("risk_tier", tier(F.col("risk_score"), 8, 6, 4))


def exceptions_report(
    invoices: DataFrame,
    purchase_orders: DataFrame,
    vendors: DataFrame,
    budget: DataFrame,
    cfg: AuditConfig = DEFAULT,
    near: DataFrame | None = None,
) -> DataFrame:
    """The strongest exception per key with its tier. Rules that one row decides
    are settled in a single pass before the rest is added."""
    parts = [
        exact_duplicates(invoices, cfg),
        near_duplicates(invoices, cfg, near),
        split_orders(purchase_orders, cfg),
        budget_overruns(budget, cfg),
        strongest_of_row(invoices, purchase_orders, vendors, cfg),
    ]
    return with_rule_tier(strongest(reduce(DataFrame.unionByName, parts)))


def tier_totals(report: DataFrame) -> DataFrame:
    """Count and exposure per tier, and one `All` row."""
    return (
        report.rollup("risk_tier")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("financial_value").alias("exposure"))
        .withColumn("risk_tier", F.coalesce("risk_tier", F.lit("All")))
    )


def rule_counts(exceptions: DataFrame) -> DataFrame:
    return exceptions.groupBy("rule_triggered").agg(F.count(F.lit(1)).alias("n"))


def rule_totals(
    invoices: DataFrame,
    purchase_orders: DataFrame,
    vendors: DataFrame,
    budget: DataFrame,
    cfg: AuditConfig = DEFAULT,
    near: DataFrame | None = None,
) -> DataFrame:
    """`rule_counts` of all exceptions without writing them: the rules that one row
    decides are counted in a single pass over the invoices."""
    terms = _row_terms(cfg)
    passed = _with_lookups(invoices, purchase_orders, vendors).agg(
        *[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{rule}") for rule, (broken, _, _) in terms.items()]
    )
    entries = [F.struct(F.lit(RULE_NAMES[r]).alias("rule_triggered"), F.col(f"r{r}").alias("n")) for r in terms]
    counted = passed.select(F.inline(F.array(*entries)))
    rest = [
        exact_duplicates(invoices, cfg), near_duplicates(invoices, cfg, near), split_orders(purchase_orders, cfg),
        budget_overruns(budget, cfg),
    ]
    return counted.filter("n > 0").unionByName(rule_counts(reduce(DataFrame.unionByName, rest)))


def confusion(df: DataFrame, label: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Confusion counts with precision, recall and F1 (0 where undefined)."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        counts.withColumn("precision", safe_ratio(tp, tp + fp))
        .withColumn("recall", safe_ratio(tp, tp + fn))
        .withColumn("f1", safe_ratio(tp * 2, tp * 2 + fp + fn))
    )


def evaluate(invoices: DataFrame, report: DataFrame) -> DataFrame:
    """The report's invoice keys against the labels, one row."""
    flagged = report.select("invoice_number").distinct().withColumn("hit", F.lit(1))
    joined = left_lookup(
        invoices.select("invoice_number", "anomaly_flag"), flagged, "invoice_number", "invoice_number"
    ).withColumn("predicted", F.coalesce("hit", F.lit(0)))
    return confusion(joined, "anomaly_flag", "predicted")
