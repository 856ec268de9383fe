"""Helpers shared by the operators: text as byte arrays, grouped streams, links to components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.ordering import pin
from tallymark.plans.shipping import ship_package

#: Texts are handled in slices of about this many bytes, so temporaries stay small.
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers."""
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positional(df: DataFrame, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], dict[str, str]]:
    """`df` with columns c0, c1, ... so that no name of an operator's own can
    clash, not even in case; the names they had, without those in `drop`; and
    the new name of each. The first of equal names counts."""
    renamed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    kept = [(f"c{i}", c) for i, c in enumerate(df.columns) if c not in drop]
    new: dict[str, str] = {}
    for i, c in enumerate(df.columns):
        new.setdefault(c, f"c{i}")
    return renamed.select(*[n for n, _ in kept]), [c for _, c in kept], new


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back: cuts lineage and
    survives lost executors. Then lets Spark's cleaner drop the shuffle files
    of what was computed, which else stay on the executors' disks."""
    out = pin(df, f"llm-{label}")
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return out


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_string(col.type) or pa.types.is_binary(col.type)):
        col = col.cast(pa.binary() if pa.types.is_large_binary(col.type) else pa.string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, last row, bytes, offsets) of runs of whole texts of about `limit` bytes."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of the rolling hash's base (or its inverse) modulo 2^64."""
    key = "inv" if inverse else "fwd"
    if key not in _powers or len(_powers[key]) < n:
        size = max(n, 2 * SLICE_BYTES)
        steps = np.full(size, _INV if inverse else _MULT, np.uint64)
        steps[0] = 1
        _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a public finaliser of splitmix type)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """c with c[j] - c[i] = sum of values[k] * base^k for i <= k < j."""
    c = np.empty(len(values) + 1, np.uint64)
    c[0] = 0
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=c[1:])
    return c


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple:
    """Start, end and 64-bit hash of every word, and per text the index of its
    first word (one entry more than texts). A-Z count as a-z; words never cross texts."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = is_word[data]
    begin, end = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        begin[cut] = inside[cut]
        end[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    c = prefix_hash(lower[data])
    raw = (c[ends] - c[starts]) * powers(len(data) + 1, inverse=True)[starts]
    hashed = mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return starts, ends, hashed, np.searchsorted(starts, offsets)


def grouped_stream(
    df: DataFrame,
    keys: list[str],
    schema: str,
    work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
    order: list[str] | None = None,
) -> DataFrame:
    """Hand whole groups to `work(table, starts)` in the order of keys: as many
    groups as a batch holds at a time, group i being rows starts[i]:starts[i+1].
    Groups must be small enough for a task; callers split large ones by a key."""
    laid = df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            first = _changes(batch, keys)
            if not held or len(first) > 1 or not _same(held[-1], batch, keys):
                cut = int(first[-1])
                if held and cut == 0 and not _same(held[-1], batch, keys):
                    yield from _done(held, keys, work)
                    held = [batch]
                    continue
                if cut:
                    yield from _done([*held, batch.slice(0, cut)], keys, work)
                    held = [batch.slice(cut)]
                    continue
            held.append(batch)
        if held:
            yield from _done(held, keys, work)

    return laid.mapInArrow(run, schema)


def _changes(batch, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new key starts, 0 included."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for k in keys:
        col = batch.column(batch.schema.get_field_index(k))
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        codes = col.dictionary_encode(null_encoding="encode")
        idx = codes.indices.to_numpy(zero_copy_only=False)
        new[1:] |= idx[1:] != idx[:-1]
    return np.flatnonzero(new)


def _same(a, b, keys: list[str]) -> bool:
    return all(
        a.column(a.schema.get_field_index(k))[-1] == b.column(b.schema.get_field_index(k))[0] for k in keys
    )


def _done(held, keys, work):
    whole = pa.Table.from_batches(held).combine_chunks()
    starts = np.append(_changes(whole, keys), whole.num_rows)
    out = work(whole, starts)
    if out is not None and out.num_rows:
        yield out


def in_blocks(df: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Deal the members of each key to pairs of blocks (lo, hi) of about `size`
    members, so that any two members meet in some pair and no task sees more
    than two blocks. Column `block` is the member's own one."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).filter("_m > 1")
    joined = df.join(counts, key).withColumn("_nb", F.ceil(F.col("_m") / size).cast("int"))
    own = joined.withColumn("block", F.pmod(F.xxhash64(member), F.col("_nb")).cast("int")).drop("_m")
    other = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return other.select(
        *[c for c in df.columns],
        "block",
        F.least("block", "_o").alias("lo"),
        F.greatest("block", "_o").alias("hi"),
    )


def union_find(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _stars(edges: DataFrame) -> bool:
    """Whether every node of distinct edges from u to a smaller v has one edge if it is a u, and none if it is a v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"))
    )
    nodes = ends.groupBy("node").agg(F.sum("out").alias("up"), F.count_if(F.col("out") == 0).alias("down"))
    return not nodes.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node in `links`; root is the component's smallest
    node. Alternating large-star and small-star rounds over the link table until
    it is made of stars; each round is stored in the shared folder."""
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "links"
    )
    while not _stars(edges):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        edges = stored(
            small.filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(down.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
