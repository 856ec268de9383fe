"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

MinHash samples of a document's shingle set give bands that find candidates;
the same samples, folded into a parity bitmap (odd sketch), estimate a pair's
similarity from the population count of the XOR, which is precise just where
similarities are high. Pairs that pass are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import (
    buffers,
    components,
    grouped_stream,
    in_blocks,
    mix,
    positional,
    prepare,
    slices,
    stored,
    table,
    union_find,
    words,
)

BANDS, ROWS = 24, 4  # a pair at similarity 0.8 shares no band with probability 3e-6
SKETCH_BITS = 512
#: XOR counts up to this pass to the exact test; a pair at 0.8 has 36 on average, deviation 7.
MOST_ODD = 80
#: Members of a bucket or family that one task compares at a time.
BLOCK = 1024

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_SAMPLES = BANDS * ROWS
_FACTORS = mix(np.arange(1, _SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_SALTS = mix(np.arange(1000, 1000 + _SAMPLES, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text of fewer words
    than `width` has one shingle, its whole sequence; without words, none."""
    _, _, hashed, first = words(data, offsets, WORD_BYTES)
    joined = hashed.copy()
    for j in range(1, width):
        n = max(0, len(hashed) - j)
        joined[:n] = mix(joined[:n] * np.uint64(0x9FB21C651E98DF25) + hashed[j:])
    sets = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= width:
            sets.append(np.unique(joined[lo : hi - width + 1]))
        elif hi > lo:
            whole = hashed[lo]
            for h in hashed[lo + 1 : hi]:
                whole = mix(np.array([whole]) * np.uint64(0x9FB21C651E98DF25) + h)[0]
            sets.append(mix(np.array([whole + np.uint64(hi - lo)], np.uint64)))
        else:
            sets.append(hashed[:0])
    return sets


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes (texts x BANDS) and packed odd sketches of non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    samples = np.empty((len(sets), _SAMPLES), np.uint64)
    buffer = np.empty_like(flat)
    for i in range(_SAMPLES):
        np.multiply(flat, _FACTORS[i], out=buffer)
        np.bitwise_xor(buffer, _SALTS[i], out=buffer)
        samples[:, i] = np.minimum.reduceat(buffer, starts)
    bands = samples[:, ::ROWS].copy()
    for r in range(1, ROWS):
        bands = mix(bands * np.uint64(0x9FB21C651E98DF25) + samples[:, r::ROWS])
    spots = (mix(samples + _SALTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    spots += np.arange(len(sets))[:, None] * SKETCH_BITS
    parity = np.bincount(spots.ravel(), minlength=len(sets) * SKETCH_BITS) & 1
    return bands, np.packbits(parity.astype(np.uint8).reshape(len(sets), SKETCH_BITS), axis=1)


def _set_id(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi, part, own in slices(data, offsets):
                sets = shingle_sets(part, own, width)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                sketch: list = [None] * len(sets)
                if full:
                    b, o = _signatures([sets[i] for i in full])
                    for i, x, y in zip(full, b.view(np.int64), o, strict=True):
                        bands[i], sketch[i] = x, y.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_id(s) for s in sets], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketch, pa.binary()),
                    ],
                    ["id", "text_key", "n_shingles", "set_id", "bands", "sketch"],
                )

    return run


def _estimate(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
    """Within each group, join members whose sketches pass; a star per component."""
    ids, n = t["set_id"].combine_chunks(), t["n_shingles"].to_numpy()
    sketch = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(t.num_rows, -1)
    block, lo, hi = t["block"].to_numpy(), t["lo"].to_numpy(), t["hi"].to_numpy()
    a, b = [], []
    sizes = np.diff(starts)
    two = starts[:-1][sizes == 2]
    if len(two):
        odd = np.bitwise_count(sketch[two] ^ sketch[two + 1]).sum(axis=1)
        small, large = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
        ok = (odd <= MOST_ODD) & (100 * small >= 80 * large) & ((lo[two] == hi[two]) | (block[two] != block[two + 1]))
        a.append(two[ok])
        b.append(two[ok] + 1)
    for s, e in zip(starts[:-1][sizes > 2], starts[1:][sizes > 2], strict=True):
        own, size, cross = sketch[s:e], n[s:e], lo[s] != hi[s]
        left, right = [], []
        for i in range(e - s - 1):
            odd = np.bitwise_count(own[i + 1 :] ^ own[i]).sum(axis=1)
            ok = (odd <= MOST_ODD) & (100 * np.minimum(size[i + 1 :], size[i]) >= 80 * np.maximum(size[i + 1 :], size[i]))
            if cross:
                ok &= block[s + i + 1 : e] != block[s + i]
            found = np.flatnonzero(ok)
            left.append(np.full(len(found), i))
            right.append(found + i + 1)
        root = union_find(e - s, np.concatenate(left), np.concatenate(right))
        hang = np.flatnonzero(root != np.arange(e - s))
        a.append(s + root[hang])
        b.append(s + hang)
    if not a or not sum(map(len, a)):
        return None
    return pa.RecordBatch.from_arrays([ids.take(np.concatenate(a)), ids.take(np.concatenate(b))], ["a", "b"])


def _confirm(similarity: int):
    """Exact links inside each group, as a spanning forest of them."""

    def work(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        ids = t["set_id"].combine_chunks()
        raw, offs = buffers(t["shingles"])
        block, lo, hi = t["block"].to_numpy(), t["lo"].to_numpy(), t["hi"].to_numpy()
        a, b = [], []
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            flat = np.frombuffer(raw[offs[s] : offs[e]].tobytes(), np.uint64)
            begin = (offs[s:e] - offs[s]) // 8
            size = np.diff(np.append(begin, len(flat)))
            root = np.arange(e - s)
            local = None
            for i in range(e - s - 1):
                ok = root != root[i]
                ok[: i + 1] = False
                ok &= 100 * np.minimum(size, size[i]) >= similarity * np.maximum(size, size[i])
                if lo[s] != hi[s]:
                    ok &= block[s:e] != block[s + i]
                maybe = np.flatnonzero(ok)
                if not len(maybe):
                    continue
                mine = flat[begin[i] : begin[i] + size[i]]
                if len(maybe) <= 2:
                    both = np.array([len(np.intersect1d(mine, flat[begin[j] : begin[j] + size[j]], True)) for j in maybe])
                else:
                    if local is None:
                        distinct, local = np.unique(flat, return_inverse=True)
                        mark = np.zeros(len(distinct), np.int64)
                    mark[local[begin[i] : begin[i] + size[i]]] = 1
                    both = np.add.reduceat(mark[local], begin)[maybe]
                    mark[local[begin[i] : begin[i] + size[i]]] = 0
                linked = maybe[100 * both >= similarity * (size[maybe] + size[i] - both)]
                for j in linked:
                    if root[j] != root[i]:
                        a.append(s + i)
                        b.append(s + j)
                        low, high = sorted((root[i], root[j]))
                        root[root == high] = low
        if not a:
            return None
        return pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], ["a", "b"])

    return work


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for lo, hi, part, own in slices(data, offsets):
                sets = shingle_sets(part, own, width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([_set_id(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["wanted", "set_id", "shingles"],
                )

    return run


def near_duplicates(
    documents: DataFrame, width: int = 5, similarity: int = 80, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `documents`: id, text_key (64-bit hash of the text),
    n_shingles, set_id, component_id (the smallest id reachable by links),
    kept. Links are pairs whose shingle sets have a similarity of `similarity`
    percent or more, all confirmed on the full sets.

    Copies of one set are one class from the start, so a group of copies of any
    size costs one row per band. Buckets and families beyond BLOCK members are
    dealt to tasks by pairs of blocks. Texts without words (null, empty, blank)
    link with nothing; their component is their own id. Null ids take part but
    never name a component unless all its ids are null (then it is null);
    repeated rows are copies of each other. Other columns are not read.
    """
    return _with_roots(documents, width, similarity, id_col, text).drop("root")


def _with_roots(
    documents: DataFrame, width: int = 5, similarity: int = 80, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """near_duplicates with `root`, the set_id that stands for the component
    whatever ids its rows have; null for texts without words."""
    prepare(documents.sparkSession)
    renamed, _, new = positional(documents)
    base = renamed.select(
        F.col(new[id_col]).alias("id"), F.xxhash64(new[text]).alias("text_key"), F.col(new[text]).alias("text")
    )
    kind = dict(base.dtypes)["id"]
    signed = stored(
        base.mapInArrow(
            _sign(width),
            f"id {kind}, text_key long, n_shingles long, set_id binary, bands array<long>, sketch binary",
        ),
        "signed",
    )
    classes = stored(
        signed.filter("set_id is not null")
        .groupBy("set_id")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    narrow = classes.select("set_id", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "set_id"
    )
    in_buckets = in_blocks(narrow, "bucket", "set_id", BLOCK).join(
        classes.select("set_id", "n_shingles", "sketch"), "set_id"
    )
    candidates = grouped_stream(in_buckets, ["bucket", "lo", "hi"], "a binary, b binary", _estimate)
    families = components(candidates)
    wanted = stored(
        families.join(classes.select("set_id", "first"), F.col("node") == F.col("set_id")).select(
            "set_id", F.col("root").alias("family"), F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")
        ),
        "families",
    )
    texts = base.alias("d").join(  # the list grows with the corpus: never broadcast
        wanted.hint("merge").alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.text_key") == F.col("w.text_key"))
    )
    sets = texts.select(F.col("w.set_id").alias("wanted"), F.col("d.text").alias("text")).mapInArrow(
        _sets(width), "wanted binary, set_id binary, shingles binary"
    )
    sets = sets.filter("wanted = set_id").select("set_id", "shingles").dropDuplicates(["set_id"])
    in_families = in_blocks(wanted.select("family", "set_id"), "family", "set_id", BLOCK).join(sets, "set_id")
    links = grouped_stream(in_families, ["family", "lo", "hi"], "a binary, b binary", _confirm(similarity))
    named = classes.select("set_id", F.col("first.id").alias("first_id")).join(
        components(links), F.col("set_id") == F.col("node"), "left"
    )
    named = named.select("set_id", "first_id", F.coalesce("root", "set_id").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = named.join(smallest, "root").select("set_id", "component_id", "root")
    out = signed.join(of_class, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        "text_key",
        "n_shingles",
        "set_id",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        "root",
    )


def drop_near_duplicates(documents: DataFrame, width: int = 5, similarity: int = 80) -> DataFrame:
    """`documents` with one row of each group of near-duplicates: the smallest
    id (nulls last), then the smallest text hash; one of exactly repeated rows.
    Rows without words all stay. Groups are told by their links alone: different
    texts stay also where they share an id or have none."""
    found = _with_roots(documents, width, similarity)
    alone = F.col("set_id").isNull()
    names = (
        found.filter(~alone)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "text_key")).alias("first"))
        .select("first.id", "first.text_key", F.lit(False).alias("all_stay"))
    )
    blank = found.filter(alone).select(F.col("doc_id").alias("id"), "text_key", F.lit(True).alias("all_stay")).distinct()
    stay = names.unionByName(blank).alias("s")
    renamed, columns, new = positional(documents)
    kept = renamed.withColumn("_key", F.xxhash64(new["text"])).join(
        stay, F.col(new["doc_id"]).eqNullSafe(F.col("s.id")) & (F.col("_key") == F.col("s.text_key"))
    )
    one = Window.partitionBy(new["doc_id"], "_key").orderBy(F.lit(0))
    numbered = kept.withColumn("_nth", F.row_number().over(one))
    return numbered.filter("all_stay or _nth = 1").select(*renamed.columns).toDF(*columns)


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of `documents` by two-word shingles, a row per row; edge cases as in
    `near_duplicates` (texts without words link with nothing)."""
    found = near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
