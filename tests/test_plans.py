"""Results do not depend on the join strategy, and scans read what they need."""

import pytest

from tallymark.operators import controls, features, rules


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_report_with_shuffled_joins(tiny, no_broadcast):
    again = rules.exceptions_report(tiny.inv, tiny.po, tiny.ven, tiny.bud)
    assert same(again, tiny.report)


def test_features_with_shuffled_joins(tiny, no_broadcast):
    again = features.assemble(tiny.inv, tiny.ven, tiny.po, tiny.bud)
    assert "BroadcastHashJoin" not in plan(again)
    cols = ["invoice_number", "vendor_category", "total_po_value", "cc_budget"]
    assert same(again.select(cols), tiny.features.select(cols))


def test_scans_prune_and_push_down(tiny):
    text = plan(rules.maverick(tiny.inv).select("invoice_number", "financial_value"))
    assert "PushedFilters: [IsNull(po_number)]" in text
    assert "ReadSchema: struct<invoice_number:string,po_number:string,invoice_amount:decimal(15,2)>" in text


def test_listings_use_top_k(tiny):
    assert "TakeOrderedAndProject" in plan(controls.no_order(tiny.inv, tiny.ven))


def test_no_cross_join_in_any_query(tiny):
    from tallymark.plans.registry import ALL

    odd = [n for n, query in ALL.items() if "CartesianProduct" in (text := plan(query(tiny))) or "BroadcastNestedLoopJoin" in text]
    assert not odd


def test_one_pass_report_equals_all_rules(tiny):
    every = rules.with_rule_tier(rules.strongest(rules.all_exceptions(tiny.inv, tiny.po, tiny.ven, tiny.bud)))
    assert same(every, tiny.report.select(*every.columns))


def test_stages_store_what_is_read_and_no_case_list_is_sorted_whole(tiny, monkeypatch):
    from tallymark.plans import pipeline

    given = tiny.report, tiny.scaler, tiny.forest
    seen, pin = {}, pipeline.pin
    monkeypatch.setattr(pipeline, "pin", lambda df, label: (seen.update({label: (df.columns, plan(df))}), pin(df, label))[1])
    own = pipeline.Audit(tiny.spark, tiny.tables)
    own.report, own.scaler, own.forest = given
    own.scored = own.forest_scored
    top, cases = own.explained_top, own.forest_cases
    assert set(seen) == {"features", "scored-forest", "risk", "top-rated", "top", "risk-forest", "cases-forest"}
    assert not any("scaled" in seen[s][0] for s in ("features", "scored-forest", "risk", "risk-forest", "top-rated"))
    assert not any("payment_amount" in columns or "full_explanation" in columns for s, (columns, _) in seen.items() if s != "top" and s != "cases-forest")
    assert "TakeOrderedAndProject" in seen["top-rated"][1]
    assert not any("rangepartitioning" in text for _, text in seen.values())
    told = own.forest_risk.select("invoice_number", "composite_risk_score", "full_explanation", "scaled")
    first = sorted(told.collect(), key=lambda r: (-r["composite_risk_score"], r["invoice_number"]))[:5]
    got = sorted(top.collect(), key=lambda r: (-r["composite_risk_score"], r["invoice_number"]))
    assert [(r["invoice_number"], r["full_explanation"], r["scaled"]) for r in got] == [(r["invoice_number"], r["full_explanation"], r["scaled"]) for r in first]
    assert cases.count() >= 5


def test_invoices_meet_their_vendor_once(spark, no_broadcast):
    from tests.tables import day, invoice, table

    inv = table(spark, "invoices", [
        invoice("a", "2020-01-05", 10), invoice("b", "2020-01-31", 30), invoice("c", "2020-02-01", 20),
        {"invoice_number": "d", "vendor_id": "A", "invoice_amount": 5}, invoice("e", "2020-01-05", 10, vendor=None),
        invoice(None, "2020-02-09", 20), invoice("a", "2020-01-05", 10),
    ])
    ven = table(spark, "vendors", [{"vendor_id": "A", "vendor_creation_date": day("2020-01-01")}] * 2)
    found = features.assemble(inv, ven, table(spark, "purchase_orders", []), table(spark, "budget", []))
    # orders, vendor and cost centre: the invoices are joined three times, not a fourth time by vendor and month
    joins = [line for line in plan(found).splitlines() if "SortMergeJoin" in line and "_key#" in line]
    assert len(joins) == 3 and not any("_month" in line for line in plan(found).splitlines() if "SortMergeJoin" in line)
    # a null number counts for no month; a vendor listed twice gives each of its invoices twice, as before
    got = sorted((r["invoice_number"] or "", r["month_count"]) for r in found.collect() if r["vendor_id"])
    assert got == [("", 1)] * 2 + [("a", 3)] * 4 + [("b", 3)] * 2 + [("c", 1)] * 2 + [("d", None)] * 2
