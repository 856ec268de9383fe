"""Near-duplicate vectors over robust-pruned graphs built on overlapping shards.

Equal vectors are one class. Classes go to the shards of their nearest centroids;
each shard builds a flat graph by robust pruning, the lists of a class from all
its shards are united, and every class searches the united graph inside its home
shard: greedily from the medoid, then widening from all that is near until
nothing new comes into range. What is found is verified in double precision. A
bounded set of queries is compared with all vectors to measure recall; if it is
too low, shards overlap more and the graph is built again.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import components, grouped_stream, in_blocks, positional, prepare, stored, table, union_find

COSINE = 0.9
#: Classes per centroid, the bound on centroids, and on the sample they are fitted on (rows and bytes).
PER_CENTROID, MOST_CENTROIDS, SAMPLE_ROWS, SAMPLE_BYTES = 512, 4096, 20_000, 16 << 20
#: Members that one task takes of a shard, twice.
BLOCK = 1024
OVERLAP = 4
#: Out-degree, candidates and slack of robust pruning; beam of the greedy search; what the widening goes through.
DEGREE, CANDIDATES, ALPHA, BEAM, SLACK = 24, 64, 1.2, 16, 0.06
AUDIT_QUERIES, LEAST_RECALL = 200, 0.98
#: Queries from which on the audit takes those of similar numbers of links for themselves.
LEAST_BAND = 10

_log = logging.getLogger(__name__)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, units, dims = [], [], []
        for value in batch.column(1).to_pylist():
            key = unit = dim = None
            if value and None not in value:
                x = np.array(value, np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    x = x / np.sqrt(np.dot(x, x)) + 0.0
                    unit, dim = x.tobytes(), len(x)
                    key = hashlib.blake2b(unit, digest_size=16).digest()
            keys.append(key)
            units.append(unit)
            dims.append(dim)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(keys, pa.binary()), pa.array(units, pa.binary()), pa.array(dims, pa.int32())],
            ["id", "key", "unit", "dim"],
        )


def _matrix(column, rows: slice | None = None) -> np.ndarray:
    values = column.to_pylist() if rows is None else column.slice(rows.start, rows.stop - rows.start).to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def fit_centroids(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Spherical k-means on a bounded sample, from evenly spaced rows."""
    centers = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([(sample[i : i + 4096] @ centers.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centers)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centers = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centers)
    return centers


def robust_prune(x: np.ndarray) -> np.ndarray:
    """Out-neighbours of every row (-1 fills up): the nearest one stays, and
    drops all candidates that it is nearer to, by ALPHA, than the row is."""
    n = len(x)
    if n < 2:
        return np.full((n, 1), -1)
    sim = x @ x.T
    np.fill_diagonal(sim, -2.0)
    k = min(CANDIDATES, n - 1)
    near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    own = np.take_along_axis(sim, near, axis=1)
    order = np.argsort(-own, axis=1, kind="stable")
    near, own = np.take_along_axis(near, order, axis=1), np.take_along_axis(own, order, axis=1)
    gap = np.sqrt(np.maximum(2 - 2 * own, 0))
    alive = np.ones_like(near, bool)
    out = np.full((n, min(DEGREE, k)), -1)
    rows = np.arange(n)
    for d in range(out.shape[1]):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        best = near[rows, first]
        out[some, d] = best[some]
        between = np.sqrt(np.maximum(2 - 2 * sim[best[:, None], near], 0))
        between[near == best[:, None]] = 0
        alive &= ~(ALPHA * between <= gap)
        alive[rows, first] = False
    return out


def _build(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    node = t["node"].to_numpy()
    nodes, lists = [], []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        graph = robust_prune(_matrix(t["unit"], slice(lo, hi)))
        own = node[lo:hi]
        nodes.append(own)
        lists += [own[g[g >= 0]] for g in graph]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(nodes)), pa.array(lists, pa.list_(pa.int64()))], ["node", "near"]
    )


def range_search(x: np.ndarray, adjacent: list[np.ndarray], medoid: int, query: int, least: float) -> np.ndarray:
    """Rows whose product with the query row is `least` or more, as far as the graph leads."""
    q = x[query]
    seen = np.zeros(len(x), bool)
    sims = np.full(len(x), -2.0)

    def visit(rows: np.ndarray) -> np.ndarray:
        rows = rows[~seen[rows]]
        seen[rows] = True
        sims[rows] = x[rows] @ q
        return rows

    start = visit(np.unique(np.append(adjacent[query], [medoid, query])))
    beam, expanded = start, np.zeros(len(x), bool)
    expanded[query] = True
    while len(beam):
        beam = beam[np.argsort(-sims[beam], kind="stable")[:BEAM]]
        open_ = beam[~expanded[beam]]
        if not len(open_):
            break
        expanded[open_[:4]] = True
        beam = np.append(beam, visit(np.unique(np.concatenate([adjacent[i] for i in open_[:4]]))))
    wide = np.flatnonzero((sims >= least - SLACK) & ~expanded)
    while len(wide):
        expanded[wide] = True
        fresh = visit(np.unique(np.concatenate([adjacent[i] for i in wide])))
        wide = fresh[sims[fresh] >= least - SLACK]
    return np.flatnonzero(sims >= least)


def _search(least: float):
    def work(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        keys, node, home = t["key"].combine_chunks(), t["node"].to_numpy(), t["home"].to_numpy(zero_copy_only=False)
        times, block, low, high = (t[c].to_numpy() for c in ("times", "block", "lo", "hi"))
        lists = t["near"].combine_chunks()
        rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            x, own = _matrix(t["unit"], slice(lo, hi)), node[lo:hi]
            order = np.argsort(own)
            part = lists.slice(lo, hi - lo)
            flat = part.flatten().to_numpy()
            ends = np.cumsum(part.value_lengths().fill_null(0).to_numpy())
            at = np.searchsorted(own[order], flat)
            at[at == len(own)] = 0
            here = own[order][at] == flat
            adjacent = [order[a[h]] for a, h in zip(np.split(at, ends[:-1]), np.split(here, ends[:-1]), strict=True)]
            center = x.mean(axis=0)
            medoid = int((x @ center).argmax())
            cross = low[lo] != high[lo]
            left, right = [], []
            for q in np.flatnonzero(home[lo:hi]):
                found = range_search(x, adjacent, medoid, int(q), least)
                found = found[found != q]
                if cross:
                    found = found[block[lo + found] != block[lo + q]]
                if len(found):
                    left.append(np.full(len(found), q))
                    right.append(found)
            if not left:
                continue
            a, b = np.concatenate(left), np.concatenate(right)
            root = union_find(hi - lo, a, b)
            leaf = np.flatnonzero(root != np.arange(hi - lo))
            rows.append((lo + leaf, lo + root[leaf], np.zeros(len(leaf), np.int64), np.zeros(len(leaf), np.int64)))
            # a pair at home here is met in no other task: counted at both ends at once
            inner = home[lo + b]
            pair = np.unique(np.minimum(a, b)[inner] * (hi - lo) + np.maximum(a, b)[inner])
            u, v = pair // (hi - lo), pair % (hi - lo)
            total = np.zeros(hi - lo, np.int64)
            np.add.at(total, u, times[lo + v])
            np.add.at(total, v, times[lo + u])
            own_count = np.flatnonzero(total)
            rows.append((lo + own_count, np.full(len(own_count), -1), total[own_count], np.zeros(len(own_count), np.int64)))
            # others may be found from either home: written as pairs, counted once later
            u, v = lo + a[~inner], lo + b[~inner]
            rows.append((u, v, times[v], times[u]))
        if not rows:
            return None
        a, b, n, m = (np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array(a)), keys.take(pa.array(np.where(b < 0, None, b), pa.int64())), pa.array(n), pa.array(m)],
            ["a", "b", "n", "m"],
        )

    return work


def _assign(centroids, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            take, shard, home = [], [], []
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(batch.column(1).take(pa.array(rows)).to_pylist()), np.float64).reshape(len(rows), -1)
                centers = centroids.value.get(int(dim), x[:1] * 0)
                sim = x @ centers.T
                m = min(overlap, len(centers))
                near = np.argsort(-sim, axis=1, kind="stable")[:, :m]
                take.append(np.repeat(rows, m))
                shard.append((int(dim) << 16) + near.ravel())
                home.append(np.tile(np.arange(m) == 0, len(rows)))
            if take:
                rows = pa.array(np.concatenate(take))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(shard)),
                        pa.array(np.concatenate(home)),
                        *[batch.column(i).take(rows) for i in (0, 1, 3, 4)],
                    ],
                    ["shard", "home", "key", "unit", "times", "node"],
                )

    return run


def _link_counts(found: DataFrame) -> DataFrame:
    """(key, found): rows linked with each class, every found pair counted at
    both its ends, whichever end it was found from. In `found`, rows without b
    are counts of a home shard, those with n > 0 pairs of different homes."""
    forward = F.col("a") < F.col("b")
    across = (
        found.filter("b is not null and n > 0")
        .select(
            F.when(forward, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(forward, F.col("b")).otherwise(F.col("a")).alias("v"),
            F.when(forward, F.col("n")).otherwise(F.col("m")).alias("of_u"), F.when(forward, F.col("m")).otherwise(F.col("n")).alias("of_v"),
        )
        .distinct()
    )
    ends = F.explode(F.array(F.struct(F.col("u").alias("key"), F.col("of_u").alias("n")), F.struct(F.col("v").alias("key"), F.col("of_v").alias("n"))))
    both = across.select(ends.alias("end")).select("end.key", "end.n")
    inner = found.filter("b is null").select(F.col("a").alias("key"), "n")
    return inner.unionByName(both).groupBy("key").agg(F.sum("n").alias("found"))


def _recall(of_query: list[tuple[int, int]]) -> float:
    """Recall from (links, links found) of queries: their mean over queries of
    similar numbers of links (the same power of two), and of these the lowest,
    so that a large group does not hide what is missed in small ones."""
    bands: dict[int, list[float]] = {}
    for links, got in of_query:
        if links > 0:
            bands.setdefault(links.bit_length(), []).append(min(got, links) / links)
    means = [sum(b) / len(b) for b in bands.values() if len(b) >= LEAST_BAND]
    every = [x for b in bands.values() for x in b]
    return min([*means, sum(every) / len(every)]) if every else 1.0


def _audit(classes: DataFrame, found: DataFrame, least: float) -> float:
    """Recall of a bounded set of queries, by brute force over all classes; see _recall."""
    spark = classes.sparkSession
    n = classes.count()
    every = max(1, n // AUDIT_QUERIES)
    asked = classes.filter(F.pmod(F.xxhash64(F.lit("audit"), "key"), F.lit(every)) == 0).select("key", "unit", "dim")
    asked = asked.limit(4 * AUDIT_QUERIES).collect()
    queries = spark.sparkContext.broadcast([(bytes(r.key), bytes(r.unit), r.dim) for r in asked])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries.value), np.int64)
        for batch in batches:
            dims = batch.column(1).to_numpy(zero_copy_only=False)
            times = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                mine = [i for i, q in enumerate(queries.value) if q[2] == dim]
                if not mine:
                    continue
                x = np.frombuffer(b"".join(batch.column(0).take(pa.array(rows)).to_pylist()), np.float64).reshape(len(rows), -1)
                q = np.frombuffer(b"".join(queries.value[i][1] for i in mine), np.float64).reshape(len(mine), -1)
                total[mine] += ((q @ x.T >= least) * times[rows]).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([q[0] for q in queries.value], pa.binary()), pa.array(total)], ["key", "n"]
        )

    true = classes.select("unit", "dim", "times").mapInArrow(count, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))
    true = true.join(classes.select("key", "times"), "key").join(found, "key", "left")
    return _recall([(r["n"] - r["times"], r["found"] or 0) for r in true.select("n", "times", "found").collect()])


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", least: float = COSINE, overlap: int = OVERLAP
) -> DataFrame:
    """One row per row of `vectors`: id, n_links (other rows found at a cosine of
    `least` or more, from either end), component_id (smallest id reachable), kept.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing and are their own component. Vectors of different lengths
    never link. Copies and repeated rows link with each other; null ids take
    part but name no component. Other columns, labels too, are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    renamed, _, new = positional(vectors)
    base = renamed.select(F.col(new[id_col]).alias("id"), F.col(new[column]).cast("array<double>").alias("v"))
    kind = dict(base.dtypes)["id"]
    signed = stored(base.mapInArrow(_units, f"id {kind}, key binary, unit binary, dim int"), "units")
    classes = stored(
        signed.filter("key is not null")
        .groupBy("key")
        .agg(
            F.first("unit").alias("unit"), F.first("dim").alias("dim"),
            F.count(F.lit(1)).alias("times"), F.min("id").alias("first_id"),
        )
        .withColumn("node", F.xxhash64("key")),
        "vector-classes",
    )
    shape = {r.dim: r["count"] for r in classes.groupBy("dim").count().collect()}
    centroids = {}
    for dim, n in shape.items():
        rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        every = max(1, -(-n // rows))
        sample = classes.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("key"), F.lit(every)) == 0)).select("key", "unit")
        sample = sorted((bytes(r.key), bytes(r.unit)) for r in sample.collect())
        if sample:
            x = np.frombuffer(b"".join(u for _, u in sample), np.float64).reshape(len(sample), dim)
            centroids[dim] = fit_centroids(x, min(MOST_CENTROIDS, -(-n // PER_CENTROID)))
    shared = spark.sparkContext.broadcast(centroids)  # bounded by MOST_CENTROIDS and the sample
    most = max((len(c) for c in centroids.values()), default=1)
    while True:
        assigned = classes.select("key", "unit", "dim", "times", "node").mapInArrow(
            _assign(shared, overlap), "shard long, home boolean, key binary, unit binary, times long, node long"
        )
        members = stored(in_blocks(assigned, "shard", "key", BLOCK), "vector-shards")
        near = grouped_stream(members.select("shard", "lo", "hi", "node", "unit"), ["shard", "lo", "hi"], "node long, near array<long>", _build)
        united = near.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        found = stored(
            grouped_stream(members.join(united, "node"), ["shard", "lo", "hi"], "a binary, b binary, n long, m long", _search(least)),
            "vector-links",
        )
        counts = stored(_link_counts(found), "vector-counts")
        recall = _audit(classes, counts, least)
        _log.info("recall %.4f at overlap %d", recall, overlap)
        if recall >= LEAST_RECALL or overlap >= most:
            break
        overlap = min(most, 2 * overlap)
    linked = components(found.filter("b is not null and n = 0"))
    linked = linked.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    named = classes.join(linked, F.col("key") == F.col("_node"), "left")
    named = named.select("key", "first_id", "times", F.coalesce("_root", "key").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(smallest, "root").join(counts, "key", "left").select(
        "key", (F.coalesce("found", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    out = signed.select("id", "key").join(of_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all `embeddings`, a row per row; edge cases as in `near_vectors` (null, zero and
    non-finite vectors link with nothing)."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
