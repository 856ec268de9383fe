"""Banded and interval search against brute force, also under heavy skew."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tallymark.operators import near_duplicates as nd
from tests.tables import invoice, keys, table

START = datetime(2020, 1, 1)


def brute(rows: list[dict]) -> set[tuple[str, str]]:
    out = set()
    for j in rows:
        for i in rows:
            if i["vendor_id"] is None or i["vendor_id"] != j["vendor_id"]:
                continue
            if (i["invoice_date"], i["invoice_number"]) >= (j["invoice_date"], j["invoice_number"]):
                continue
            if (j["invoice_date"] - i["invoice_date"]).days > 30:
                continue
            ri, rj = i["vendor_invoice_number"], j["vendor_invoice_number"]
            if ri is not None and ri == rj:
                continue
            a, b = Decimal(str(i["invoice_amount"])), Decimal(str(j["invoice_amount"]))
            if a > 0 and a != b and abs(b - a) <= Decimal("0.02") * a:
                out.add((j["invoice_number"], i["invoice_number"]))
    return out


def random_rows(n: int, seed: int) -> list[dict]:
    """Over a third of the rows share one vendor and nearly one amount."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        hot = rnd.random() < 0.4
        rows.append(
            invoice(
                f"I{k:04d}",
                (START + timedelta(minutes=rnd.randint(0, 150 * 24 * 60))).isoformat(),
                Decimal(rnd.choice([100000, 100000, 100900, 101000, 102000, 99000, 98100])) / 100
                if hot else Decimal(rnd.randint(-200, 300000)) / 100,
                vendor="HOT" if hot else rnd.choice(["A", "B", None]),
                ref=rnd.choice([None, "R1", "R1", "R2", f"R{k}"]),
            )
        )
    return rows


def test_matches_brute_force(spark):
    rows = random_rows(400, 11)
    expected = brute(rows)
    inv = table(spark, "invoices", rows)
    flagged = nd.near_duplicates(inv, counted=True).collect()
    got = {(r.invoice_number, r.matched_invoice) for r in flagged}
    assert {j for j, _ in got} == {j for j, _ in expected}
    assert got <= expected
    assert {r.invoice_number: r.n_partners for r in flagged} == Counter(j for j, _ in expected)
    totals = nd.pair_totals(nd.near_duplicates(inv, counted=True)).first()
    assert (totals.n_invoices, totals.n_pairs) == (len(got), len(expected))


EDGES = [
    # (earlier amount, later amount, later date, matches)
    ("1000.00", "1020.00", "2020-01-05T10:00:00", True),  # exactly 2%
    ("1000.00", "1020.01", "2020-01-05T10:00:00", False),
    ("1000.00", "1000.00", "2020-01-05T10:00:00", False),  # equal
    ("1000.00", "980.00", "2020-01-05T10:00:00", True),
    ("1000.00", "979.99", "2020-01-05T10:00:00", False),
    ("0.00", "0.01", "2020-01-05T10:00:00", False),
    ("-100.00", "-101.00", "2020-01-05T10:00:00", False),
    ("1000.00", "1010.00", "2020-02-01T09:59:59", True),  # 30 days 23:59:59
    ("1000.00", "1010.00", "2020-02-01T10:00:00", False),  # 31 days
    ("1000.00", "1010.00", "2020-01-01T10:00:00", True),  # same instant
]


@pytest.mark.parametrize("refs", [("X", "Y"), (None, None)])
def test_edges(spark, refs):
    rows = []
    for n, (a, b, when, _) in enumerate(EDGES):
        rows.append(invoice(f"E{n}a", "2020-01-01T10:00:00", a, vendor=f"V{n}", ref=refs[0]))
        rows.append(invoice(f"E{n}b", when, b, vendor=f"V{n}", ref=refs[1]))
    got = keys(nd.near_duplicates(table(spark, "invoices", rows)))
    assert got == {f"E{n}b" for n, e in enumerate(EDGES) if e[3]}


def test_copies_of_one_posting_never_pair(spark):
    """A thousand copies fold into one cell and give no row."""
    rows = [invoice(f"C{k}", f"2020-01-0{1 + k % 9}T10:00:00", "500.00", ref="SAME") for k in range(1000)]
    inv = table(spark, "invoices", rows)
    assert nd.near_duplicates(inv).count() == 0
    extra = table(spark, "invoices", [invoice("D", "2020-01-20T10:00:00", "505.00", ref="OTHER")])
    both = inv.unionByName(extra)
    assert keys(nd.near_duplicates(both)) == {"D"}


def test_two_postings_copied_many_times_give_a_row_each_at_most(spark):
    """10,000 copies of each of two matching postings would be 100 million pairs."""
    from pyspark.sql import functions as F

    one = table(spark, "invoices", [invoice("A", "2020-01-06T10:00:00", "500.00", ref="X")])
    two = table(spark, "invoices", [invoice("B", "2020-01-07T10:00:00", "505.00", ref="Y")])
    many = spark.range(10_000).withColumnRenamed("id", "n")
    rows = one.unionByName(two).crossJoin(many)
    rows = rows.withColumn("invoice_number", F.concat("invoice_number", F.col("n").cast("string"))).drop("n")
    found = nd.near_duplicates(rows, counted=True)
    assert found.count() == 10_000
    assert nd.pair_totals(found).first().n_pairs == 100_000_000


@pytest.mark.parametrize("slot_rows", [0, 12])
def test_crowded_and_other_slots_give_the_same(spark, slot_rows):
    """By rank throughout, or by both ways side by side, as by comparison throughout; also repeated rows."""
    rows = random_rows(250, 23)
    inv = table(spark, "invoices", rows + [r for r in rows if r["invoice_number"].endswith("7")])
    found = nd.near_duplicates(inv, counted=True, slot_rows=slot_rows)
    expected = nd.near_duplicates(inv, counted=True)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, expected.collect()))
    listed = nd.near_duplicates(inv, slot_rows=slot_rows)
    assert Counter(map(tuple, listed.collect())) == Counter(map(tuple, found.drop("n_partners").collect()))
    plain = nd.near_duplicates(table(spark, "invoices", rows), counted=True, slot_rows=slot_rows)
    assert {r.invoice_number: r.n_partners for r in plain.collect()} == Counter(j for j, _ in brute(rows))


def test_slots_with_few_postings_need_no_blocks(spark, monkeypatch):
    """Nothing is ranked or written per block where no slot is crowded."""

    def fail(*_):
        raise AssertionError("ranked")

    monkeypatch.setattr(nd, "_matches", fail)
    rows = random_rows(120, 5)
    found = nd.near_duplicates(table(spark, "invoices", rows), counted=True)
    assert {r.invoice_number: r.n_partners for r in found.collect()} == Counter(j for j, _ in brute(rows))
