"""Isolation forest (Liu, Ting, Zhou 2008) fitted and scored on Spark.

Fit: each tree takes the rows with the smallest hash for that tree, and all trees grow
level by level at once: one pass over (tree, node) gives every open node its size and
the range of each feature, a hash of (seed, tree, node) draws feature and cut. The
forest depends on keys, values and the seed alone. It is a node table whose size depends
on its parameters only, so it may be broadcast. Score: an Arrow-batched function over
the feature columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, FEATURES, AuditConfig
from tallymark.functions.ordering import global_rank, pin
from tallymark.operators.metrics import roc_auc

WIDTH = len(FEATURES)
#: Values are compared on a grid of so many steps to one, so that sums taken in another order decide alike.
GRID = 1e6
ROOT = 1  # the children of node k are 2k (at most the cut) and 2k + 1


def on_grid(value: Column) -> Column:
    return F.rint(value * F.lit(GRID)) / F.lit(GRID)


def hash_unit(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on the values only: 32 bits of an md5."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def draw_samples(scaled: DataFrame, key: str = "invoice_number", cfg: AuditConfig = DEFAULT) -> DataFrame:
    """(tree, key, x): the rows each tree grows from."""
    trees, size, seed = cfg.forest_trees, cfg.forest_sample, cfg.seed
    rows = scaled.select(F.col(key).alias("key"), F.col("scaled").alias("x"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    # Draws: each row takes part in so many, and each draw that is taken names a
    # tree, so that a tree expects twice its sample from all rows. Small tables
    # need several draws a row, up to every row in every tree; large ones one.
    wanted = F.lit(2.0 * trees * size) / total
    draws = F.least(F.greatest(F.ceil(wanted), F.lit(1)), F.lit(trees)).cast("int")
    every = F.lit(2.0 * size) / total >= 1.0
    drawn = F.transform(
        F.sequence(F.lit(0), F.when(F.col("_every"), trees).otherwise(F.col("_draws")) - 1),
        lambda d: F.when(F.col("_every"), d).when(
            hash_unit(F.col("key"), d, seed) < F.col("_share"),
            F.floor(hash_unit(F.col("key"), d, seed, "tree") * trees).cast("int"),
        ),
    )
    picked = (
        rows.withColumn("_draws", draws)
        .withColumn("_every", every)
        .withColumn("_share", wanted / F.col("_draws"))
        .withColumn("tree", F.explode(F.array_distinct(F.array_compact(drawn))))
        .withColumn("h", F.md5(F.concat_ws(":", F.col("key"), F.col("tree").cast("string"), F.lit(str(seed)))))
    )
    order = Window.partitionBy("tree").orderBy("h", "key")
    return picked.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= size).select(
        "tree", "key", F.transform("x", on_grid).alias("x")
    )


def _draw_text(seed: int, what: str) -> str:
    """`hash_unit` of (seed, tree, node, what) as SQL text."""
    return f"CAST(conv(substring(md5(concat_ws(':', {seed}, tree, node, '{what}')), 1, 8), 16, 10) AS DOUBLE) / {2**32}D"


def _grow(rows: DataFrame, xs: list[str], depth: int, last: bool, seed: int) -> DataFrame:
    """One level: every row's node is recorded as `at<depth>` and split. Rows of a
    leaf go on with node NULL."""
    kept = ["tree", *xs, *[f"at{d}" for d in range(depth)]]
    here = "OVER (PARTITION BY tree, node)"
    spread = "" if last else ", ".join(f"struct({i} AS i, min({x}) {here} AS lo, max({x}) {here} AS hi, {x} AS x)" for i, x in enumerate(xs))
    sized = rows.selectExpr(*kept, "node", f"CAST(count(1) {here} AS INT) AS n", f"array({spread}) AS spread")
    if last:
        leaf = "IF(node IS NULL, NULL, named_struct('node', node, 'n', n, 'feature', -1, 'threshold', 0.0D, 'depth', {0}))".format(depth)
        return sized.selectExpr(*kept, f"{leaf} AS at{depth}")
    usable = sized.selectExpr(*kept, "node", "n", "filter(spread, s -> s.hi > s.lo) AS usable")
    drawn = usable.selectExpr(
        *kept, "node", "n", f"get(usable, CAST(floor({_draw_text(seed, 'feature')} * size(usable)) AS INT)) AS one", f"{_draw_text(seed, 'cut')} AS u"
    ).selectExpr(*kept, "node", "n", "one.i AS feature", "one.x AS x", "one.hi AS hi", "one.lo + u * (one.hi - one.lo) AS cut")
    # rounding may put the cut on the maximum
    split = drawn.selectExpr(*kept, "node", "n", "feature", "x", "cut", "coalesce(cut < hi, false) AND node IS NOT NULL AS splits")
    entry = f"named_struct('node', node, 'n', n, 'feature', IF(splits, feature, -1), 'threshold', IF(splits, cut, 0.0D), 'depth', {depth})"
    return split.selectExpr(*kept, f"IF(node IS NULL, NULL, {entry}) AS at{depth}", "IF(splits, 2 * node + CAST(x > cut AS INT), NULL) AS node")


def fit_forest(scaled: DataFrame, key: str = "invoice_number", cfg: AuditConfig = DEFAULT) -> DataFrame:
    """The forest as a node table: tree, node, feature (-1 at leaves), threshold, left, right,
    n, depth. `scaled` has `key` and array `scaled`. A node whose feature ranges are all
    empty is a leaf."""
    depths = max(1, math.ceil(math.log2(max(cfg.forest_sample, 2))))
    xs = [f"x{i}" for i in range(WIDTH)]
    rows = draw_samples(scaled, key, cfg).selectExpr("tree", *[f"x[{i}] AS x{i}" for i in range(WIDTH)], f"{ROOT} AS node")
    for depth in range(depths + 1):
        rows = _grow(rows, xs, depth, depth == depths, cfg.seed)
    levels = ", ".join(f"at{d}" for d in range(depths + 1))
    nodes = rows.selectExpr("tree", f"explode(array({levels})) AS at").filter("at.node IS NOT NULL").select("tree", "at.*").distinct()
    inner = F.col("feature") >= 0
    return nodes.select(
        "tree", "node", "feature", "threshold", F.when(inner, 2 * F.col("node")).otherwise(F.col("node")).alias("left"),
        F.when(inner, 2 * F.col("node") + 1).otherwise(F.col("node")).alias("right"), "n", "depth",
    )


def expected_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    m = n[big]
    out[big] = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return out


@dataclass(frozen=True)
class Tree:
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    n: np.ndarray
    length: np.ndarray  # path length credited to a row that ends at the node

    @property
    def is_leaf(self) -> np.ndarray:
        return self.left == np.arange(len(self.left))


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]
    norm: float
    depth: int


def load_forest(nodes: DataFrame, cfg: AuditConfig = DEFAULT) -> Forest:
    """Node table to arrays. Its size is bounded by trees * (2 * sample - 1)."""
    limit = cfg.forest_trees * (2 * cfg.forest_sample - 1)
    pdf = nodes.limit(limit + 1).toPandas()
    if len(pdf) > limit:
        raise ValueError("node table is larger than the forest's parameters allow")
    trees = []
    for _, t in pdf.sort_values(["tree", "node"]).groupby("tree"):
        node = t["node"].to_numpy()
        trees.append(
            Tree(
                feature=np.maximum(t["feature"].to_numpy(), 0),
                threshold=t["threshold"].to_numpy(),
                left=np.searchsorted(node, t["left"].to_numpy()),
                right=np.searchsorted(node, t["right"].to_numpy()),
                n=t["n"].to_numpy(),
                length=t["depth"].to_numpy() + expected_path(t["n"].to_numpy()),
            )
        )
    sample = int(max(t.n[0] for t in trees))
    return Forest(tuple(trees), float(expected_path(np.array([sample]))[0]), int(pdf["depth"].max()))


def anomaly_score(forest: Forest, x: np.ndarray) -> np.ndarray:
    """2^(-mean path length / norm), in (0, 1], higher is odder."""
    rows = np.arange(len(x))
    total = np.zeros(len(x))
    for t in forest.trees:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(forest.depth):
            goes_left = x[rows, t.feature[at]] <= t.threshold[at]
            at = np.where(goes_left, t.left[at], t.right[at])
        total += t.length[at]
    return np.exp2(-total / len(forest.trees) / forest.norm)


def rounded_score(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Scores to nine digits, so that equal ones compare equal whatever the order of sums."""
    return np.round(anomaly_score(forest, x), 9)


@dataclass(frozen=True)
class LeafMasks:
    """A tree as bit vectors: leaves are numbered from left to right, and a row above a
    node's threshold can't reach the leaves to its left. Per feature the thresholds in order, and
    for each number of them that lie below a value the leaves that stay; a row ends at the first leaf that
    all features leave."""

    features: tuple[int, ...]
    thresholds: tuple[np.ndarray, ...]
    stay: tuple[np.ndarray, ...]  # (thresholds + 1, words of 64 leaves)
    length: np.ndarray


def leaf_masks(tree: Tree) -> LeafMasks:
    order, spans, pending = [], {}, [(0, False)]
    while pending:
        at, done = pending.pop()
        if tree.left[at] == at:
            order.append(at)
        elif done:
            spans[at] = (spans[at], len(order))
        else:
            spans[at] = len(order)
            # behind its left subtree a node knows the leaves it bars
            pending += [(tree.right[at], False), (at, True), (tree.left[at], False)]
    every = (1 << len(order)) - 1
    words = -(-len(order) // 64)
    by_feature: dict[int, list] = {}
    for at, (lo, hi) in spans.items():
        by_feature.setdefault(int(tree.feature[at]), []).append((float(tree.threshold[at]), every & ~(((1 << (hi - lo)) - 1) << lo)))
    thresholds, stay = [], []
    for _, nodes in sorted(by_feature.items()):
        nodes.sort()
        left, rows = every, [every]
        for _, mask in nodes:
            left &= mask
            rows.append(left)
        thresholds.append(np.array([t for t, _ in nodes]))
        stay.append(np.array([[(r >> (64 * w)) & (2**64 - 1) for w in range(words)] for r in rows], np.uint64))
    return LeafMasks(tuple(sorted(by_feature)), tuple(thresholds), tuple(stay), tree.length[order])


def _first_leaf(masks: np.ndarray) -> np.ndarray:
    word, skipped = masks[:, 0], np.zeros(len(masks), np.int64)
    for w in range(1, masks.shape[1]):
        none = word == 0
        word, skipped = np.where(none, masks[:, w], word), np.where(none, 64 * w, skipped)
    return skipped + np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1))


def permuted_scores(trees: list[LeafMasks], norm: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(row, 1 + features): scores of `x`, and of `x` with one feature taken from `y`. Only that
    feature's leaves are looked up anew; those of the features before and after it are ANDed once."""
    total = np.zeros((len(x), 1 + x.shape[1]))
    for t in trees:
        own = [s[np.searchsorted(c, x[:, f])] for f, c, s in zip(t.features, t.thresholds, t.stay)]
        behind = [None] * len(own)
        for j in range(len(own) - 2, -1, -1):
            behind[j] = own[j + 1] if behind[j + 1] is None else own[j + 1] & behind[j + 1]
        before = None
        lengths = np.repeat(t.length[_first_leaf(own[0] if behind[0] is None else own[0] & behind[0])][:, None], total.shape[1], axis=1) if own else t.length[0]
        for j, (f, c, s) in enumerate(zip(t.features, t.thresholds, t.stay)):
            masks = s[np.searchsorted(c, y[:, f])]
            for others in (before, behind[j]):
                masks = masks if others is None else masks & others
            lengths[:, 1 + f] = t.length[_first_leaf(masks)]
            before = own[j] if before is None else before & own[j]
        total += lengths
    return np.round(np.exp2(-total / len(trees) / norm), 9)


def feature_cols(array: str = "scaled") -> list[Column]:
    return [F.get(array, F.lit(i)) for i in range(WIDTH)]


def forest_cols(array: str = "scaled") -> list[Column]:
    """The feature values as the forest compares them."""
    return [on_grid(c) for c in feature_cols(array)]


def add_score(scaled: DataFrame, forest: Forest, name: str = "iso_score") -> DataFrame:
    shared = scaled.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(rounded_score(shared.value, np.column_stack(cols)))

    return scaled.withColumn(name, score(*forest_cols()))


def permutation_importance(
    scaled: DataFrame, forest: Forest, label: str, key: str = "invoice_number",
    cfg: AuditConfig = DEFAULT, chunks: int | None = None,
) -> DataFrame:
    """AUC lost when one feature is taken from another row, per feature.

    Rows are ranked by key hash; the partner is the row half the table ahead
    in that random order, so every value moves exactly once. One join serves
    all features; the scores of all permutations come from one pass over bit vectors of leaves.
    """
    ranked = global_rank(
        scaled.select(F.col(key).alias("key"), F.col(label).alias("label"), "scaled").withColumn(
            "h", F.md5(F.concat_ws(":", "key", F.lit(str(cfg.seed))))
        ),
        ["h", "key"], "rank", chunks,
    )
    n = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    half = F.floor(n / F.lit(2)).cast("bigint")
    partner = F.pmod(F.col("rank") - 1 + half, n) + 1
    others = ranked.select(F.col("rank").alias("partner"), F.col("scaled").alias("other"))
    paired = ranked.withColumn("partner", partner).join(others, "partner")
    shared = scaled.sparkSession.sparkContext.broadcast(([leaf_masks(t) for t in forest.trees], forest.norm))

    @F.pandas_udf("array<double>")
    def scores(own: pd.Series, other: pd.Series) -> pd.Series:
        masks, norm = shared.value
        return pd.Series(list(permuted_scores(masks, norm, np.stack(own.to_numpy()), np.stack(other.to_numpy()))))

    long = paired.select("label", F.posexplode(scores(F.transform("scaled", on_grid), F.transform("other", on_grid))).alias("run", "score"))
    auc = roc_auc(pin(long, "permuted"), "label", "score", ("run",), chunks)
    pairs = F.map_from_entries(F.collect_list(F.struct("run", "auc")))
    table = auc.agg(pairs.alias("auc"))
    entries = [
        F.struct(
            F.lit(f).alias("feature"), (F.col("auc")[0] - F.col("auc")[i + 1]).alias("auc_drop")
        )
        for i, f in enumerate(FEATURES)
    ]
    return table.select(F.inline(F.array(*entries))).orderBy(F.desc("auc_drop"), "feature")
