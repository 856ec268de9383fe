import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.functions.expressions import days_floor, first_digit, tier
from tallymark.functions.joins import left_lookup
from tallymark.operators import explore, quality, risk
from tallymark.sources import loading
from tallymark.sources.schemas import LOAD_ORDER, SCHEMAS
from tests.tables import invoice, table


def test_tier_borders(spark):
    df = spark.createDataFrame([(s,) for s in (34.9, 35.0, 54.9, 55.0, 74.9, 75.0)], "s double")
    got = [r[0] for r in df.select(tier(F.col("s"), 75, 55, 35)).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Critical"]


def test_composite_rounds_like_numpy(spark):
    values = [34.95, 54.95, 0.25, 0.35, 2.45, 74.949999]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(F.rint(F.col("x") * 10) / 10).collect()]
    assert got == [float(np.round(v, 1)) for v in values]


def test_queue_is_a_permutation(tiny):
    queue = risk.case_queue(tiny.zscore_risk, chunks=5)
    rows = queue.orderBy("priority_rank").select("priority_rank", "composite_risk_score").collect()
    assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    assert all(a[1] >= b[1] for a, b in zip(rows, rows[1:]))


def test_explanations(tiny):
    rows = tiny.zscore_risk.select("rule_triggered", "ml_component", "full_explanation", "rule_explanation").collect()
    for r in rows:
        assert ("strong outlier" in r["full_explanation"]) == (r["ml_component"] > 70)
        if r["rule_triggered"] != "None":
            assert r["full_explanation"].startswith(r["rule_explanation"])
        elif r["ml_component"] <= 70:
            assert r["full_explanation"].startswith("No rule hit")


def test_export_has_all_columns(tiny):
    assert tuple(risk.master_export(tiny.risk, tiny.po).columns) == risk.EXPORT_COLUMNS
    assert len(risk.EXPORT_COLUMNS) == 34


def test_absent_tiers_and_findings_are_zero(spark, tiny):
    none = tiny.zscore_risk.filter("1 = 0")
    assert {r["risk_tier"]: r["n"] for r in risk.tier_distribution(none).collect()} == dict.fromkeys(
        ("Critical", "High", "Medium", "Low"), 0
    )
    got = risk.findings(none, tiny.bud.filter("1 = 0")).collect()
    assert len(got) == 6 and all(r["n"] == 0 and r["exposure"] == 0 for r in got)


def test_first_digit_and_days(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (0D), (0.5D), (1D), (9.99D), (12345678.90D), (-3D) AS t(x)"
    )
    assert [r[0] for r in df.select(first_digit(F.col("x"))).collect()] == [None, None, 1, 9, 1, None]
    days = spark.sql(
        "SELECT timestamp'2020-01-01 10:00:00' a, timestamp'2020-01-02 09:00:00' b"
    ).select(days_floor(F.col("b"), F.col("a")), days_floor(F.col("a"), F.col("b"))).first()
    assert tuple(days) == (0, -1)


def test_match_without_order_value_does_not_pass(spark):
    orders = table(spark, "purchase_orders", [{"po_number": "P", "total_po_value": 100}, {"po_number": "Z", "total_po_value": 0}])
    inv = table(spark, "invoices", [invoice(n, "2020-01-06T10:00:00", "105", po_number=n) for n in ("P", "Z", "gone")])
    got = {r["invoice_number"]: r["match_pass"] for r in explore.match_rows(inv, orders).collect()}
    assert got == {"P": True, "Z": False, "gone": False}


def test_lookup_keeps_null_and_unmatched_rows(spark):
    left = spark.createDataFrame([("1", None), ("2", "a"), ("3", "x"), ("4", None)], "id string, k string")
    right = spark.createDataFrame([("a", 7)], "k string, v int")
    got = {r["id"]: (r["k"], r["v"]) for r in left_lookup(left, right, "k", "id").collect()}
    assert got == {"1": (None, None), "2": ("a", 7), "3": ("x", None), "4": (None, None)}


def test_csv_load(spark, tiny, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for name, df in tiny.tables.items():
        if name != "users":
            loading.write_csv(df, f"{source}/{name}.csv")
    counts = loading.load_all(spark, source, target)
    assert list(counts) == list(LOAD_ORDER) and counts["users"] == 0
    back = loading.read_loaded(spark, "invoices", f"{target}/invoices")
    assert back.exceptAll(tiny.inv).count() == 0 and counts["invoices"] == tiny.inv.count()
    again = loading.load_table(spark, f"{source}/invoices.csv", "invoices", f"{target}/invoices")
    assert again == counts["invoices"] and loading.read_loaded(spark, "invoices", f"{target}/invoices").count() == again
    loading.load_table(spark, f"{source}/invoices.csv", "invoices", f"{target}/invoices", "second")
    assert spark.read.parquet(f"{target}/invoices").count() == 2 * counts["invoices"]


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_load_that_crashes_is_there_once_after_a_rerun(spark, tiny, tmp_path, monkeypatch, fails):
    source, target = str(tmp_path / "in" / "vendors.csv"), str(tmp_path / "out")
    loading.write_csv(tiny.ven, source)
    publish = loading._publish

    def crash(*args):
        if fails == "after":
            publish(*args)
        raise OSError("lost")

    monkeypatch.setattr(loading, "_publish", crash)
    with pytest.raises(OSError):
        loading.load_table(spark, source, "vendors", target)
    assert len(loading.published_loads(spark, target)) == (fails == "after")
    monkeypatch.setattr(loading, "_publish", publish)
    n = tiny.ven.count()
    for _ in range(2):
        assert loading.load_table(spark, source, "vendors", target) == n
    assert loading.read_loaded(spark, "vendors", target).count() == n
    loading.write_csv(tiny.ven.limit(3), source)  # a changed source is another load
    assert loading.load_table(spark, source, "vendors", target) == 3
    assert len(loading.published_loads(spark, target)) == 2 and loading.read_loaded(spark, "vendors", target).count() == n + 3


def test_contract_fills_defaults_and_drops_nan(spark):
    df = spark.createDataFrame([("V", float("nan"))], "vendor_id string, anomaly_flag double")
    row = loading.apply_contract(df, "vendors").first()
    assert (row["anomaly_flag"], row["is_ghost_vendor"], row["is_active"]) == (0, False, True)


def test_quality_finds_planted_faults(spark, tiny):
    from dataclasses import replace

    bad = table(
        spark, "invoices",
        [invoice("X", "2020-01-06T10:00:00", "1", vendor="nobody", po_number="nowhere"),
         invoice("X", "2020-01-06T10:00:00", "1", vendor="nobody", anomaly_flag=1)],
    )
    tables = replace(tiny.tables, invoices=tiny.inv.unionByName(bad))
    value = {r["subject"]: r["value"] for r in quality.orphans(tables).collect()}
    assert (value["invoices.vendor_id"], value["invoices.po_number"], value["invoices.gr_number"]) == (2, 1, 0)
    assert {r["subject"]: r["value"] for r in quality.duplicate_keys(tables).collect()}["invoices.invoice_number"] == 1
    assert quality.flag_consistency(tables.invoices).first()["no_flag"] == 1


def test_keys_of_all_tables_take_one_scan_each_and_one_shuffle(tiny):
    plan = quality.integrity(tiny.tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 6
    assert plan.count("Exchange hashpartitioning(domain") == 1 and "Join" not in plan


@pytest.mark.parametrize("name,expected", [("r1_exact_duplicates", 9), ("r2_near_duplicates", 29), ("r3_split_orders", 24)])
def test_control_counts(tiny, name, expected):
    from tallymark.plans.registry import ALL

    assert ALL[name](tiny).count() == expected


def test_closing_deletes_intermediate_tables(sf_dir, tmp_path):
    """In a session of its own, as other tests still read their tables."""
    code = f"""
import os
from pyspark.sql import SparkSession
from tallymark.plans.pipeline import audit, close_audits
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
assert audit(spark, {sf_dir!r}).report.count() > 0
root = os.path.join({str(tmp_path)!r}, "tallymark")
assert os.listdir(os.path.join(root, spark.sparkContext.applicationId))
close_audits(spark)
assert not os.listdir(root)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=300)
