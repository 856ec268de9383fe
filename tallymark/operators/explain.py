"""Why a case scored high: additive feature contributions and sentences.

Contributions are path-dependent Shapley values of the forest (Lundberg et al.
2020) on the negated mean path length, so a positive one makes a row odder and
base + contributions = -(mean path length).

A leaf is a box in feature space. For a row, o says per feature whether the row
lies in the box and z is the share of training rows that the path's splits on
that feature let through. A leaf's part in a row's values depends on the set of its features
that hold the row alone. So each leaf gets a table over the subsets of its features: the
weights of single subsets, summed over all subsets of a set at once by a fast
subset-sum transform. Neighbouring leaves of a tree then share one table over the cells their bounds
cut the features into, so a row looks up a few groups of leaves in each tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, FEATURES, AuditConfig
from tallymark.functions.expressions import fixed
from tallymark.operators.isolation import Forest, forest_cols

# Display names of the features.
FEATURE_LABELS = {
    "feat_amount_zscore": "Amount vs Vendor Average",
    "feat_invoice_to_po_ratio": "Invoice-to-PO Ratio",
    "feat_vendor_age_days": "Vendor Age (days)",
    "feat_days_to_payment": "Days to Payment",
    "feat_vendor_monthly_freq": "Vendor Invoice Frequency",
    "feat_pct_of_cc_budget": "% of Cost Centre Budget",
    "feat_after_hours": "After-Hours Posting",
    "feat_no_po": "No PO Reference",
    "feat_round_number": "Round Number Amount",
    "feat_benford_dev": "Benford's Law Deviation",
}
#: Rows of a sample that a task gets, and rows looked up at a time.
ROWS_AT_ONCE, LOOKED_UP = 64, 4096
#: Rows of the table that neighbouring leaves share.
STATES = 1024


@dataclass(frozen=True)
class Boxes:
    """The leaves of one tree: bounds, pass-through shares and values."""

    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_boxes(forest: Forest) -> list[Boxes]:
    width = len(FEATURES)
    out = []
    for t in forest.trees:
        found = []
        pending = [(0, np.full(width, -np.inf), np.full(width, np.inf), np.ones(width))]
        leaf = t.is_leaf
        while pending:
            at, low, high, share = pending.pop()
            if leaf[at]:
                found.append((low, high, share, -t.length[at]))
                continue
            f, cut = t.feature[at], t.threshold[at]
            for child, is_left in ((t.left[at], True), (t.right[at], False)):
                lo, hi, sh = low.copy(), high.copy(), share.copy()
                if is_left:
                    hi[f] = min(hi[f], cut)
                else:
                    lo[f] = max(lo[f], cut)
                sh[f] *= t.n[child] / t.n[at]
                pending.append((child, lo, hi, sh))
        low, high, share, value = zip(*found)
        out.append(Boxes(np.array(low), np.array(high), np.array(share), np.array(value)))
    return out


def base_value(boxes: list[Boxes]) -> float:
    return float(np.mean([(b.value * b.share.prod(axis=1)).sum() for b in boxes]))


def subset_values(share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(leaf, set, feature) values of leaves with equally many features: `share` is
    (leaf, feature), sets are bit masks of the features whose range holds the row."""
    leaves, d = share.shape
    sets = np.arange(1 << d)
    size = sum((sets >> j) & 1 for j in range(d))
    outside = np.ones((leaves, 1 << d))
    for j in range(d):
        outside *= np.where((sets >> j) & 1, 1.0, share[:, j : j + 1])
    out = np.zeros((leaves, 1 << d, d))
    for f in range(d):
        without = ((sets >> f) & 1) == 0
        weight = np.array([factorial(k) * factorial(d - 1 - k) / factorial(d) if k < d else 0.0 for k in size])
        sums = np.where(without, weight * outside / share[:, f : f + 1], 0.0)
        for j in range(d):
            if j != f:
                halves = sums.reshape(leaves, -1, 2, 1 << j)
                halves[:, :, 1] += halves[:, :, 0]
        sums[:, ~without] = sums[:, without]
        out[:, :, f] = value[:, None] * sums * (np.where(without, 0.0, 1.0) - share[:, f : f + 1])
    return out


def _lookup(b: Boxes) -> tuple[np.ndarray, np.ndarray, list]:
    """A tree's table (one row per leaf and set, all features wide), where each leaf
    begins in it, and per feature the leaves that split on it with their bit."""
    used = b.share < 1
    count = used.sum(axis=1)
    begin = np.concatenate([[0], np.cumsum(1 << count)])
    table = np.zeros((begin[-1], used.shape[1]))
    bit = np.cumsum(used, axis=1) - 1
    for d in set(count.tolist()) - {0}:
        of = np.flatnonzero(count == d)
        features = np.nonzero(used[of])[1].reshape(len(of), d)
        values = subset_values(np.take_along_axis(b.share[of], features, 1), b.value[of])
        rows = begin[of][:, None] + np.arange(1 << d)
        for j in range(d):
            table[rows, features[:, j : j + 1]] = values[:, :, j]
    split = [(f, np.flatnonzero(used[:, f])) for f in range(used.shape[1]) if used[:, f].any()]
    return table, begin[:-1], [(f, at, (1 << bit[at, f])[:, None]) for f, at in split]


@dataclass(frozen=True)
class Tables:
    """Leaves in groups that are looked up at once: per feature all thresholds of the forest, and
    per group its features, what each rank of a value among the thresholds adds to the row of its table, and
    the table."""

    thresholds: tuple[np.ndarray, ...]
    groups: tuple[tuple[tuple[int, ...], tuple[np.ndarray, ...], np.ndarray], ...]
    trees: int


def _joined(cells: np.ndarray | None, held: np.ndarray) -> tuple[np.ndarray, int]:
    """Cells of the ranks after telling apart whether a further leaf holds them, and their number."""
    pairs = held.astype(np.int64) if cells is None else 2 * cells + held
    # cells are numbered anew without gaps, few enough for a count
    number = np.cumsum(np.bincount(pairs) > 0) - 1
    return number[pairs], int(number[-1]) + 1


def _group(members: list, cells: dict[int, np.ndarray], counts: dict[int, int], local: list[np.ndarray], width: int) -> tuple:
    """Features, steps and table of leaves that share a table: its rows are the combinations of the
    features' cells, each the sum of what its members give there."""
    features = sorted(cells)
    strides = np.cumprod([1, *[counts[f] for f in features]])
    table = np.zeros((strides[-1], width))
    for values, held in members:
        sets = np.zeros(1, np.int64)
        for f in reversed(features):
            bits = np.zeros(counts[f], np.int64)
            if f in held:
                bit, inside = held[f]
                bits[cells[f]] = np.where(inside, bit, 0)  # equal for all ranks of a cell
            sets = (sets[:, None] + bits).ravel()
        table += values[sets]
    steps = tuple((cells[f] * stride).astype(np.int16)[local[f]] for f, stride in zip(features, strides))
    return tuple(features), steps, table


def tables(boxes: list[Boxes]) -> Tables:
    """Neighbouring leaves of a tree share a table while it has at most `STATES` rows (a leaf
    alone has up to 2^features)."""
    width = boxes[0].share.shape[1]
    edges = [np.concatenate([side[:, f] for b in boxes for side in (b.low, b.high)]) for f in range(width)]
    thresholds = tuple(np.unique(e[np.isfinite(e)]) for e in edges)
    groups = []
    for b in boxes:
        own = [np.unique(e[np.isfinite(e)]) for e in (np.concatenate([b.low[:, f], b.high[:, f]]) for f in range(width))]
        # the rank among the tree's thresholds for each rank among the forest's
        local = [np.concatenate([[0], np.searchsorted(t, every, side="right")]) for t, every in zip(own, thresholds)]
        table, begin, split = _lookup(b)
        ends = [*begin[1:], len(table)]
        held: list[dict] = [{} for _ in begin]
        for f, leaves, bits in split:
            ranks = np.arange(len(own[f]) + 1)
            low, high = (np.searchsorted(own[f], side[leaves, f]) for side in (b.low, b.high))
            low = np.where(np.isneginf(b.low[leaves, f]), -1, low)
            for leaf, bit, inside in zip(leaves, bits[:, 0], (ranks > low[:, None]) & (ranks <= high[:, None])):
                held[leaf][f] = int(bit), inside
        members, cells, counts = [], {}, {}
        for leaf, of in enumerate(held):
            joined = {f: _joined(cells.get(f), inside) for f, (_, inside) in of.items()}
            merged = counts | {f: n for f, (_, n) in joined.items()}
            if members and np.prod(list(merged.values()), dtype=float) > STATES:
                groups.append(_group(members, cells, counts, local, width))
                members, cells, counts = [], {}, {}
                joined = {f: _joined(None, inside) for f, (_, inside) in of.items()}
                merged = {f: n for f, (_, n) in joined.items()}
            cells, counts = cells | {f: c for f, (c, _) in joined.items()}, merged
            members.append((table[begin[leaf] : ends[leaf]], of))
        groups.append(_group(members, cells, counts, local, width))
    return Tables(thresholds, tuple(groups), len(boxes))


def attribute(boxes: list[Boxes], x: np.ndarray) -> np.ndarray:
    """Contributions, one row per row of `x`."""
    return attribute_by(tables(boxes), x)


def attribute_by(found: Tables, x: np.ndarray) -> np.ndarray:
    """`attribute` with tables made before."""
    out = np.zeros(x.shape)
    for start in range(0, len(x), LOOKED_UP):
        part, total = x[start : start + LOOKED_UP], out[start : start + LOOKED_UP]
        ranks = [np.searchsorted(t, part[:, f]) for f, t in enumerate(found.thresholds)]
        for features, steps, table in found.groups:
            at = np.zeros(len(part), np.int16)
            for f, step in zip(features, steps):
                at += step[ranks[f]]
            total += table[at]
    return out / found.trees


@dataclass(frozen=True)
class _Lookups:
    """The leaves, small enough to be sent, and the tables a worker process makes of them when
    it first needs them."""

    boxes: list[Boxes]

    @cached_property
    def tables(self) -> Tables:
        return tables(self.boxes)


def add_contributions(scaled: DataFrame, forest: Forest) -> DataFrame:
    """Add array `contributions` (feature order) and `base_value`. Tables are made once a
    worker process. Filter the cases before calling: this is the most expensive step per row."""
    boxes = leaf_boxes(forest)
    shared = scaled.sparkSession.sparkContext.broadcast(_Lookups(boxes))

    @F.pandas_udf("array<double>")
    def contributions(*cols: pd.Series) -> pd.Series:
        return pd.Series(list(attribute_by(shared.value.tables, np.column_stack(cols))))

    return scaled.withColumn("contributions", contributions(*forest_cols())).withColumn(
        "base_value", F.lit(base_value(boxes))
    )


def long_contributions(explained: DataFrame, *keep: str) -> DataFrame:
    """(key, feature, label, contribution, base) rows."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(FEATURE_LABELS[f]).alias("label"),
            F.get("contributions", F.lit(i)).alias("contribution"),
        )
        for i, f in enumerate(FEATURES)
    ]
    return explained.select("invoice_number", *keep, "base_value", F.inline(F.array(*entries)))


def sample(df: DataFrame, n: int = 2000, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """n rows without replacement, the same ones on every run and in every
    engine. The limit leaves them in one partition, so they are dealt out again
    for the work to come."""
    picked = df.orderBy(F.md5(F.concat("invoice_number", F.lit(str(cfg.seed)))), "invoice_number").limit(n)
    return picked.repartition(max(1, -(-n // ROWS_AT_ONCE)), "invoice_number")


def importance(explained: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    means = [F.avg(F.abs(F.get("contributions", F.lit(i)))).alias(f) for i, f in enumerate(FEATURES)]
    entries = [
        F.struct(
            F.lit(f).alias("feature"), F.lit(FEATURE_LABELS[f]).alias("label"),
            F.col(f).alias("mean_abs_contribution"),
        )
        for f in FEATURES
    ]
    return (
        explained.agg(*means)
        .select(F.inline(F.array(*entries)))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )


def _phrases() -> dict[str, Column]:
    """What to say when a feature pushes toward the anomaly; NULL says nothing."""
    v = {f: F.col(f) for f in FEATURES}
    off = (v["feat_invoice_to_po_ratio"] - 1) * 100
    return {
        "feat_amount_zscore": F.concat(fixed(v["feat_amount_zscore"], 1), F.lit(" sample deviations from the mean of the vendor's invoices")),
        "feat_invoice_to_po_ratio": F.concat(
            fixed(F.abs(off), 0), F.when(off > 0, "% more than ordered").otherwise("% less than ordered")
        ),
        "feat_vendor_age_days": F.concat(fixed(v["feat_vendor_age_days"], 0), F.lit(" days between the vendor's creation and the invoice")),
        "feat_days_to_payment": F.lit(None).cast("string"),
        "feat_vendor_monthly_freq": F.concat(fixed(v["feat_vendor_monthly_freq"], 0), F.lit(" invoices of the vendor in the calendar month")),
        "feat_pct_of_cc_budget": F.concat(F.lit("amount equal to "), fixed(v["feat_pct_of_cc_budget"] * 100, 1), F.lit("% of the cost centre's approved budgets")),
        "feat_after_hours": F.when(v["feat_after_hours"] == 1, "time stamp on a weekend or off the business hours"),
        "feat_no_po": F.when(v["feat_no_po"] == 1, "order number missing"),
        "feat_round_number": F.when(v["feat_round_number"] == 1, "amount in full thousands"),
        "feat_benford_dev": F.lit("first digit with an expected share far from one ninth"),
    }


def add_sentence(explained: DataFrame, top: int = 3) -> DataFrame:
    """One sentence from the `top` largest contributions that raise the score.

    Everything happens inside the row's arrays, without a shuffle.
    """
    phrases = _phrases()
    reasons = F.array(
        *[
            F.struct(
                F.abs(F.get("contributions", F.lit(i))).alias("size"),
                F.lit(-i).alias("tie"),
                F.get("contributions", F.lit(i)).alias("c"),
                phrases[f].alias("text"),
            )
            for i, f in enumerate(FEATURES)
        ]
    )
    largest = F.slice(F.sort_array(reasons, asc=False), 1, top)
    said = F.filter(largest, lambda r: (r["c"] > 0) & r["text"].isNotNull())
    joined = F.array_join(F.transform(said, lambda r: r["text"]), "; ")
    sentence = F.when(F.size(said) == 0, F.lit("Score raised by nothing that has words.")).otherwise(
        F.concat(F.lit("Score raised by: "), joined, F.lit("."))
    )
    return explained.withColumn("shap_explanation", sentence)


def top_cases(risk: DataFrame, n: int) -> DataFrame:
    return risk.orderBy(F.desc("composite_risk_score"), "invoice_number").limit(n)


def priority_cases(risk: DataFrame, others: bool = False) -> DataFrame:
    """Critical and High cases, or all others."""
    found = F.col("risk_tier").isin("Critical", "High")
    return risk.filter(~found if others else found)
