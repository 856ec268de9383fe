import re

import pytest

from tallymark.config import DEFAULT
from tallymark.operators import controls, rules
from tests.tables import day, invoice, keys, table, ts


def scores(df) -> dict:
    return {r["invoice_number"]: r["risk_score"] for r in df.collect()}


@pytest.mark.parametrize("chunks", [None, 5])
def test_exact_duplicates_compare_with_previous_row(spark, chunks):
    inv = table(
        spark, "invoices",
        [
            invoice("A1", "2020-01-01T10:00:00", "100.00", ref="R"),
            invoice("A2", "2020-01-31T10:00:00", "100.00", ref="R"),  # 30 days
            invoice("A3", "2020-03-02T10:00:01", "100.00", ref="R"),  # 31 days after A2
            invoice("B1", "2020-01-01T10:00:00", "100.00", vendor="B", ref="R"),
            invoice("B2", "2020-01-02T10:00:00", "100.01", vendor="B", ref="R"),  # differs by 0.01
            invoice("B3", "2020-01-03T10:00:00", "100.01", vendor="B", ref="R"),
            invoice("N1", "2020-01-01T10:00:00", "100.00", vendor="C"),
            invoice("N2", "2020-01-02T10:00:00", "100.00", vendor="C"),  # no reference
        ],
    )
    assert keys(rules.exact_duplicates(inv, chunks=chunks)) == {"A2", "B3"}


def po(num, when, value, vendor="A", **more):
    return {"po_number": num, "po_date": ts(when), "total_po_value": value, "vendor_id": vendor, **more}


def test_split_orders(spark):
    orders = table(
        spark, "purchase_orders",
        [
            po("A1", "2020-01-01T08:00:00", "50000"), po("A2", "2020-01-31T08:00:00", "50000.01"),  # last instant
            po("A3", "2020-06-01T08:00:00", "90000"), po("A4", "2020-06-02T08:00:00", "90000"),  # later window
            po("B1", "2020-01-01T08:00:00", "50000", "B"), po("B2", "2020-01-02T08:00:00", "50000", "B"),  # exactly
            po("C1", "2020-01-01T08:00:00", "60000", "C"), po("C2", "2020-01-31T08:00:01", "60000", "C"),  # too late
            po("D1", "2020-01-01T08:00:00", "100000", "D"), po("D2", "2020-01-02T08:00:00", "60000", "D"),
            po("E0", "2020-01-01T08:00:00", "10", "E"), po("E1", "2020-03-01T08:00:00", "60000", "E"),
            po("E2", "2020-03-01T08:00:00", "60000", "E"),  # same instant
        ],
    )
    assert keys(rules.split_orders(orders)) == {"A1", "A2", "E1", "E2"}


def test_match_failures(spark):
    amounts = {"at5": "105", "over5": "105.01", "under": "94.99", "at20": "120", "over20": "120.01", "low": "79"}
    orders = table(spark, "purchase_orders", [po(n, "2020-01-01T08:00:00", "100") for n in amounts] + [po("zero", "2020-01-01T08:00:00", "0")])
    inv = table(
        spark, "invoices",
        [invoice(n, "2020-01-02T10:00:00", a, po_number=n) for n, a in amounts.items()]
        + [invoice("zero", "2020-01-02T10:00:00", "5", po_number="zero"),
           invoice("gone", "2020-01-02T10:00:00", "5", po_number="nowhere"),
           invoice("none", "2020-01-02T10:00:00", "5")],
    )
    got = rules.match_failures(inv, orders)
    assert scores(got) == {"over5": 5, "under": 5, "at20": 5, "over20": 7, "low": 7}
    text = {r["invoice_number"]: r["explanation"] for r in got.collect()}
    assert "20.0% OVER" in text["over20"] and "21.0% UNDER" in text["low"]
    assert keys(controls.po_deviation(inv, orders)) == {"over5", "under", "at20", "over20", "low"}
    assert keys(rules.maverick(inv)) == {"none"}


def test_after_hours(spark):
    times = {
        "before": "2020-01-06T07:59:00", "open": "2020-01-06T08:00:00", "late": "2020-01-06T18:59:59",
        "closed": "2020-01-06T19:00:00", "sat": "2020-01-04T12:00:00", "sun": "2020-01-05T12:00:00",
    }
    inv = table(spark, "invoices", [invoice(n, t, "1") for n, t in times.items()])
    got = rules.after_hours(inv)
    assert keys(got) == {"before", "closed", "sat", "sun"}
    text = {r["invoice_number"]: r["explanation"] for r in got.collect()}
    assert "on a Saturday" in text["sat"] and "on a Sunday" in text["sun"]
    assert "at 07:00 (before" in text["before"] and "at 19:00 (after" in text["closed"]


def test_budget_overruns(spark):
    def row(period, approved, actual):
        return {"cost_centre": "CC1", "budget_period": period, "approved_budget": approved, "actual_spend": actual}

    bud = table(spark, "budget", [row("1", 100, 100), row("2", 100, 120), row("3", 100, "120.01"), row("4", 0, 5)])
    assert scores(rules.budget_overruns(bud)) == {"BUDGET-CC1-2": 4, "BUDGET-CC1-3": 6, "BUDGET-CC1-4": 6}


def test_round_amounts(spark):
    inv = table(spark, "invoices", [invoice(a, "2020-01-06T10:00:00", a) for a in ("0", "999.99", "1000", "-5000", "1000.5")])
    assert keys(rules.round_amounts(inv)) == {"0", "1000", "-5000"}


def test_new_vendors(spark):
    ven = table(
        spark, "vendors",
        [{"vendor_id": "A", "vendor_creation_date": day("2020-01-10")},
         {"vendor_id": "G", "vendor_creation_date": day("2020-01-10"), "is_ghost_vendor": True}],
    )
    inv = table(
        spark, "invoices",
        [invoice("d7", "2020-01-17T23:59:59", "1"), invoice("d8", "2020-01-18T00:00:00", "1"),
         invoice("neg", "2020-01-01T10:00:00", "1"), invoice("ghost", "2020-01-12T10:00:00", "1", "G"),
         invoice("unknown", "2020-01-12T10:00:00", "1", "Z")],
    )
    got = rules.new_vendors(inv, ven)
    assert scores(got) == {"d7": 6, "neg": 6, "ghost": 9}
    assert {r["invoice_number"] for r in got.collect() if "GHOST" in r["explanation"]} == {"ghost"}


def test_strongest_keeps_one_row_per_key(spark, tiny):
    rows = [("X", 6, "Second", 4), ("X", 5, "First", 5), ("X", 4, "Tie", 5), ("Y", 8, "Only", 3)]
    df = spark.createDataFrame(
        [(k, n, name, s, name, "do", None) for k, n, name, s in rows],
        "invoice_number string, rule_no int, rule_triggered string, risk_score int, explanation string,"
        " recommended_action string, financial_value decimal(17,2)",
    )
    got = {r["invoice_number"]: r["rule_triggered"] for r in rules.strongest(df).collect()}
    assert got == {"X": "Tie", "Y": "Only"}
    keys(tiny.report)  # unique


PATTERNS = {
    "Exact Duplicate Invoice": r"Invoice \S+ of vendor \S+ for ₹[\d,]+ repeats \S+, posted \d+ days earlier",
    "Near-Duplicate Invoice": r"Invoice \S+ \(₹[\d,]+\) differs by \d\.\d% from \S+",
    "Split Purchase Order": r"Order PO\d+ to vendor \S+ for ₹[\d,]+ is one of \d+ orders within 30 days",
    "Three-Way Match Failure": r"is \d+\.\d% (OVER|UNDER) the order value ₹[\d,]+, beyond the 5% tolerance",
    "Maverick Buying": r"refers to no purchase order",
    "After-Hours Transaction": r"was posted (on a|at \d\d:00)",
    "Budget Overrun": r"spent ₹[\d,]+ of ₹[\d,]+ in \d{4}, over by ₹[\d,]+ \(\d+\.\d%\)",
    "Round Number Invoice": r"has the round amount ₹[\d,]+",
    "New Vendor Fast Payment": r"came -?\d+ days after the vendor was created",
}


def test_every_explanation_is_complete(tiny):
    every = rules.all_exceptions(tiny.inv, tiny.po, tiny.ven, tiny.bud).collect()
    assert {r["rule_triggered"] for r in every} == set(PATTERNS)
    for r in every:
        assert re.search(PATTERNS[r["rule_triggered"]], r["explanation"]), r


@pytest.mark.parametrize("chunks", [1, 7])
def test_split_windows_of_one_vendor_cut_across_chunks(spark, chunks):
    """All orders belong to one vendor; windows as a plain scan finds them."""
    import random
    from datetime import datetime, timedelta

    from tallymark.config import DEFAULT

    rnd = random.Random(chunks)
    for _ in range(3):
        times = sorted(datetime(2020, 1, 1) + timedelta(hours=rnd.randint(0, 24 * 400)) for _ in range(60))
        values = [rnd.randint(1, 60_000) for _ in times]
        rows = [
            {"po_number": f"P{i}", "vendor_id": "V", "po_date": t, "total_po_value": v}
            for i, (t, v) in enumerate(zip(times, values))
        ]
        found = rules._split_windows(table(spark, "purchase_orders", rows), DEFAULT, chunks).collect()
        expected = None
        for start in times:
            inside = [v for t, v in zip(times, values) if start <= t <= start + timedelta(days=30)]
            if len(inside) >= 2 and sum(inside) > DEFAULT.approval_threshold:
                expected = (start, len(inside), sum(inside))
                break
        got = [(r["start"], r["group_size"], int(r["group_value"])) for r in found]
        assert got == ([expected] if expected else [])


@pytest.mark.parametrize("n", [900, 5000])
def test_groups_of_any_size_give_one_row_per_member(spark, n):
    rows = [invoice(f"M{k:04d}", "2020-01-06T10:00:00", "10") for k in range(n)]
    for limit in (30, None):
        got = controls.same_amount_month(table(spark, "invoices", rows), limit=limit)
        assert got.columns == ["group_rank", "vendor_id", "invoice_amount", "invoice_month", "invoice_count", "invoice_number"]
        found = got.collect()
        assert {(r["group_rank"], r["invoice_count"]) for r in found} == {(1, n)}
        assert sorted(r["invoice_number"] for r in found) == [r["invoice_number"] for r in rows]


def test_null_vendor_forms_a_group_in_the_listing(spark):
    rows = [invoice(n, "2020-01-06T10:00:00", "10", vendor=None) for n in "ab"]
    got = controls.same_amount_month(table(spark, "invoices", rows)).collect()
    assert sorted((r["vendor_id"], r["invoice_count"], r["invoice_number"]) for r in got) == [(None, 2, "a"), (None, 2, "b")]
