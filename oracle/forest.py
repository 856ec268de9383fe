"""DuckDB text of the forest, its scores and contributions: the same hashes draw samples,
features and cuts; levels are CTEs, scores walk them, contributions come from the
subset formula over leaf boxes."""

from __future__ import annotations

import math

TREES, SIZE, SEED, DEPTHS, WIDTH = 200, 256, 42, 8, 10


def _unit(*parts: str) -> str:
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def inputs(features: tuple[str, ...]) -> str:
    """fx: key, label and x, the scaled features on the grid."""
    cols = ", ".join(
        f"round_even((({f} - (SELECT p50 FROM fitted WHERE feature = '{f}')) / (SELECT scale FROM fitted WHERE feature = '{f}')) * 1000000.0::DOUBLE, 0) / 1000000.0::DOUBLE"
        for f in features
    )
    return f"fx AS MATERIALIZED (SELECT invoice_number AS key, anomaly_flag AS label, [{cols}] AS x FROM feat)"


_X = ", ".join(f"x[{i + 1}]" for i in range(WIDTH))
_LOW = ", ".join(f"min(x[{i + 1}])" for i in range(WIDTH))
_HIGH = ", ".join(f"max(x[{i + 1}])" for i in range(WIDTH))


def _levels() -> str:
    out = []
    for d in range(DEPTHS + 1):
        out.append(
            f"""st{d} AS (SELECT tree, node, count(*) AS n, [{_LOW}] AS lo, [{_HIGH}] AS hi FROM s{d} WHERE node IS NOT NULL GROUP BY tree, node)"""
        )
        if d == DEPTHS:
            out.append(f"sp{d} AS MATERIALIZED (SELECT tree, node, n, -1 AS feature, 0.0::DOUBLE AS threshold, {d} AS depth FROM st{d})")
            break
        out.append(
            f"""sp{d} AS MATERIALIZED (SELECT tree, node, n, CASE WHEN cut < top THEN f - 1 ELSE -1 END AS feature, CASE WHEN cut < top THEN cut ELSE 0.0::DOUBLE END AS threshold, {d} AS depth
  FROM (SELECT *, hi[f] AS top, lo[f] + {_unit(str(SEED), 'tree', 'node', "'cut'")} * (hi[f] - lo[f]) AS cut
    FROM (SELECT *, usable[1 + CAST(floor({_unit(str(SEED), 'tree', 'node', "'feature'")} * len(usable)) AS INT)] AS f
      FROM (SELECT *, list_filter(range(1, {WIDTH + 1}), lambda i: hi[i] > lo[i]) AS usable FROM st{d}))))"""
        )
        out.append(
            f"""s{d + 1} AS MATERIALIZED (SELECT s.tree, s.key, s.x, CASE WHEN p.feature >= 0 THEN 2 * s.node + CAST(x[p.feature + 1] > p.threshold AS INT) END AS node
  FROM s{d} s JOIN sp{d} p ON p.tree = s.tree AND p.node = s.node)"""
        )
    return ",\n".join(out)


GROWN = f"""draws AS (SELECT *, (SELECT count(*) FROM fx) AS total FROM fx),
drawn AS (
  SELECT DISTINCT key, x, CASE WHEN {2.0 * SIZE} / total >= 1 THEN d WHEN {_unit('key', 'd', str(SEED))} < {2.0 * TREES * SIZE}::DOUBLE / total / k
         THEN CAST(floor({_unit('key', 'd', str(SEED), "'tree'")} * {TREES}) AS INT) END AS tree
  FROM (SELECT *, unnest(range(CASE WHEN {2.0 * SIZE} / total >= 1 THEN {TREES} ELSE k END)) AS d
        FROM (SELECT *, CAST(least(greatest(ceil({2.0 * TREES * SIZE}::DOUBLE / total), 1), {TREES}) AS INT) AS k FROM draws))),
s0 AS MATERIALIZED (SELECT tree, key, x, 1 AS node FROM (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY md5(key || ':' || tree || ':{SEED}'), key) AS rn FROM drawn WHERE tree IS NOT NULL) WHERE rn <= {SIZE}),
{_levels()},
nodes AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM sp{d}' for d in range(DEPTHS + 1))})"""

_C = "CASE WHEN n > 2 THEN 2 * (ln(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n WHEN n = 2 THEN 1.0 ELSE 0.0 END"


def paths(source: str, keep: str) -> str:
    """ended: for every row of `source` (`keep`, x) and tree the length of its path."""
    steps = [f"w0 AS (SELECT {keep}, x, t.tree, 1 AS node, CAST(NULL AS DOUBLE) AS length FROM {source} CROSS JOIN (SELECT DISTINCT tree FROM nodes) t)"]
    for d in range(DEPTHS + 1):
        steps.append(
            f"""w{d + 1} AS (SELECT {keep}, x, w.tree, CASE WHEN feature >= 0 THEN 2 * w.node + CAST(x[feature + 1] > threshold AS INT) ELSE w.node END AS node,
  CASE WHEN feature < 0 THEN depth + {_C} END AS length FROM w{d} w JOIN nodes p ON p.tree = w.tree AND p.node = w.node)"""
        )
    steps.append(f"ended AS (SELECT {keep}, tree, length FROM w{DEPTHS + 1})")
    return ",\n".join(steps)


NORM = f"norm AS (SELECT max({_C}) AS c FROM nodes WHERE node = 1)"


def scores(source: str = "fx", keep: str = "key, label") -> tuple[str, ...]:
    """iso: `keep` and iso_score."""
    return (
        paths(source, keep), NORM,
        f"iso AS MATERIALIZED (SELECT {keep}, round_even(pow(2.0, -sum(length) / {TREES} / (SELECT c FROM norm)) * 1000000000.0, 0) / 1000000000.0 AS iso_score FROM ended GROUP BY {keep})",
    )


def _weights() -> str:
    """w[d][k + 1] = k! (d - 1 - k)! / d!"""
    rows = [[math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)] for d in range(1, DEPTHS + 1)]
    return "[" + ", ".join("[" + ", ".join(repr(w) for w in r) + "]" for r in rows) + "]"


#: Polynomial with the elementary symmetric sums of the listed shares as coefficients.
_SUMS = "list_reduce(list_concat([[1.0::DOUBLE]], list_transform({zs}, lambda z: [z])), lambda p, z: list_transform(range(1, len(p) + 2), lambda i: coalesce(p[i], 0.0) + z[1] * coalesce(p[i - 1], 0.0)))"
_ONE = _SUMS.format(zs="has")

CONTRIBUTIONS = f"""leafs AS MATERIALIZED (SELECT tree, node AS leaf, depth, -(depth + {_C}) AS value FROM nodes WHERE feature < 0),
sides AS (SELECT l.tree, l.leaf, p.feature, p.threshold, (l.leaf >> (l.depth - p.depth - 1)) % 2 AS side, CAST(c.n AS DOUBLE) / p.n AS share
  FROM (SELECT *, unnest(range(depth)) AS k FROM leafs) l
  JOIN nodes p ON p.tree = l.tree AND p.node = (l.leaf >> (l.depth - l.k))
  JOIN nodes c ON c.tree = l.tree AND c.node = (l.leaf >> (l.depth - l.k - 1))),
boxes AS (SELECT tree, leaf, feature, coalesce(max(CASE WHEN side = 1 THEN threshold END), '-infinity'::DOUBLE) AS lo,
    coalesce(min(CASE WHEN side = 0 THEN threshold END), 'infinity'::DOUBLE) AS hi, product(share) AS z FROM sides GROUP BY tree, leaf, feature),
listed AS MATERIALIZED (SELECT tree, leaf, list(feature ORDER BY feature) AS fs, list(z ORDER BY feature) AS zs, list(lo ORDER BY feature) AS los, list(hi ORDER BY feature) AS his FROM boxes GROUP BY tree, leaf),
masks AS (SELECT l.tree, l.leaf, fs, zs, len(fs) AS d, value, unnest(range(1 << len(fs))) AS mask FROM listed l JOIN leafs v ON v.tree = l.tree AND v.leaf = l.leaf),
alone AS (SELECT tree, leaf, d, value, mask, fs[i] AS feature, zs[i] AS z, (mask >> (i - 1)) & 1 AS o,
    list_filter(zs, lambda z, j: j <> i AND ((mask >> CAST(j - 1 AS BIGINT)) & 1) = 1) AS has,
    list_product(list_concat([1.0::DOUBLE], list_filter(zs, lambda z, j: j <> i AND ((mask >> CAST(j - 1 AS BIGINT)) & 1) = 0))) AS rest
  FROM (SELECT *, unnest(range(1, d + 1)) AS i FROM masks)),
sums AS (SELECT *, {_ONE} AS e FROM alone),
gains AS MATERIALIZED (SELECT tree, leaf, mask, feature, value * (o - z) * rest * list_sum(list_transform(range(0, len(has) + 1), lambda k: {_weights()}[d][k + 1] * e[len(has) - k + 1])) AS phi FROM sums),
wide AS MATERIALIZED (SELECT tree, leaf, mask, {', '.join(f'coalesce(sum(phi) FILTER (feature = {f}), 0.0) AS p{f}' for f in range(WIDTH))} FROM gains GROUP BY tree, leaf, mask),
bounds AS MATERIALIZED (SELECT tree, leaf, {', '.join(f"coalesce(los[list_position(fs, {f})], '-infinity'::DOUBLE) AS lo{f}, coalesce(his[list_position(fs, {f})], 'infinity'::DOUBLE) AS hi{f}, coalesce(1 << (list_position(fs, {f}) - 1), 0) AS b{f}" for f in range(WIDTH))} FROM listed),
baseline AS (SELECT sum(v.value * list_product(l.zs)) / {TREES} AS base_value FROM listed l JOIN leafs v ON v.tree = l.tree AND v.leaf = l.leaf)"""


def contributions(source: str) -> str:
    """phi: key and p0..p9 for every row of `source` (key, x)."""
    mask = " + ".join(f"b{f} * CAST(x[{f + 1}] > lo{f} AND x[{f + 1}] <= hi{f} AS BIGINT)" for f in range(WIDTH))
    return f"""phi AS MATERIALIZED (SELECT key, {', '.join(f'sum(p{f}) / {TREES} AS p{f}' for f in range(WIDTH))}
  FROM (SELECT key, tree, leaf, {mask} AS mask FROM {source} CROSS JOIN bounds) m JOIN wide w ON w.tree = m.tree AND w.leaf = m.leaf AND w.mask = m.mask GROUP BY key)"""
