"""Benchmark decontamination with suffix arrays over the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import buffers, positional, prepare, slices, table, words

WINDOW = 13
#: The benchmark is held by every task; beyond this many bytes the caller must split it.
MAX_BENCHMARK_BYTES = 256 << 20
#: Words a key of the suffix order compares: covers any window.
DEPTH = 16

#: Bytes of words: 0-9, letters (upper case counts as lower), all bytes from 0x80.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[0x30:0x3A] = True
WORD_BYTES[0x41:0x5B] = True
WORD_BYTES[0x61:0x7B] = True
WORD_BYTES[0x80:] = True


class TestSuffixes:
    """The benchmark's windows: its suffixes cut to the length that counts as a
    match, as keys of word numbers, with the items and places they come from."""

    def __init__(self, item_ids: list[str | None], texts: list[str | None], window: int):
        data, offsets = buffers(pa.array(texts, pa.string()))
        _, _, hashed, first = words(data, offsets, WORD_BYTES)
        self.vocabulary = np.unique(hashed)
        numbers = (np.searchsorted(self.vocabulary, hashed) + 1).astype(">u4")
        places: dict[tuple[int, bytes], list[tuple[str, int]]] = {}
        for i, item in enumerate(item_ids):
            own = numbers[first[i] : first[i + 1]]
            length = min(window, len(own))
            for j in range(len(own) - length + 1 if length else 0):
                places.setdefault((length, own[j : j + length].tobytes()), []).append((item, j))
        self.by_length: dict[int, tuple[np.ndarray, list[list[tuple[str, int]]]]] = {}
        for length in sorted({k[0] for k in places}):
            keys = sorted(k[1] for k in places if k[0] == length)
            self.by_length[length] = (
                np.array(keys, f"V{4 * length}"),
                [places[(length, k)] for k in keys],
            )
        self.shortest = min(self.by_length, default=0)


def _suffix_array(numbers: np.ndarray, run: np.ndarray, shortest: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order and their keys. A suffix ends with its run of
    benchmark words, beyond which nothing can match; shorter runs than the
    shortest window are left out of the array."""
    at = np.flatnonzero(run >= shortest)
    padded = np.concatenate([numbers, np.zeros(depth, np.uint32)])
    keys = np.empty((len(at), depth), np.uint32)
    for d in range(depth):
        keys[:, d] = np.where(run[at] > d, padded[at + d], 0)
    order = np.lexsort(keys.T[::-1])
    return at[order], keys[order]


def _bound(keys: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of every wanted prefix (rows) in the sorted key rows."""
    lo, hi = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys), np.int64)
    length = wanted.shape[1]
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        have, want = keys[mid, :length], wanted[open_]
        differ = have != want
        first = differ.argmax(axis=1)
        rows = np.arange(len(open_))
        less = differ.any(axis=1) & (have[rows, first] < want[rows, first])
        if right:
            less |= ~differ.any(axis=1)
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def _search(data, offsets, tests: TestSuffixes):
    """Per text: words, words hit, and its matches (item, place there, place here, words)."""
    _, _, hashed, first = words(data, offsets, WORD_BYTES)
    n = len(hashed)
    counts = np.diff(first)
    marks = np.zeros(n + 1, np.int64)
    matches: list[list[tuple]] = [[] for _ in counts]
    if n and tests.shortest:
        at = np.searchsorted(tests.vocabulary, hashed)
        at[at == len(tests.vocabulary)] = 0
        numbers = np.where(tests.vocabulary[at] == hashed, at + 1, 0).astype(np.uint32)
        stop = np.zeros(n, bool)
        stop[numbers == 0] = True
        index = np.arange(n)
        ends = np.repeat(first[1:], counts)  # texts end runs too
        nearest = np.where(stop, index, n)
        nearest = np.minimum.accumulate(nearest[::-1])[::-1]
        run = np.minimum(nearest, ends) - index
        depth = max(tests.by_length)
        sa, keys = _suffix_array(numbers, run, tests.shortest, depth)
        found: list[tuple[int, int, int, str, int]] = []
        for length, (wanted, places) in tests.by_length.items():
            if not len(sa):
                break
            rows = wanted.view(">u4").reshape(len(wanted), length).astype(np.uint32)
            left, right = _bound(keys, rows, False), _bound(keys, rows, True)
            for w in np.flatnonzero(right > left):
                here = sa[left[w] : right[w]]
                np.add.at(marks, here, 1)
                np.add.at(marks, here + length, -1)
                for doc, p in zip(np.searchsorted(first, here, side="right") - 1, here, strict=True):
                    for item, j in places[w]:
                        found.append((int(doc), item, int(p - j), int(p), length))
        # consecutive windows on one diagonal are one longest match
        found.sort(key=lambda m: (m[0], m[1] is None, m[1] or "", *m[2:]))
        for doc, item, diagonal, p, length in found:
            own = matches[doc]
            start = p - int(first[doc])
            if own and own[-1][0] == item and own[-1][4] == diagonal and own[-1][2] + own[-1][3] >= start + length - 1:
                own[-1][3] = max(own[-1][3], start + length - own[-1][2])
            else:
                own.append([item, p - diagonal, start, length, diagonal])
    hit = np.cumsum(marks[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    return counts, total[first[1:]] - total[first[:-1]], matches


MATCHES = "array<struct<item_id:string,item_word:long,doc_word:long,n_words:long>>"


def find_matches(
    documents: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Add n_words, n_hit and `matches`, the longest verbatim matches with any
    benchmark item and their word places, to every row; all columns stay.

    Every task builds suffix arrays over its texts (shards of about a megabyte,
    always whole texts) and looks all test suffixes up by binary search. Null or
    wordless texts have no words; null or wordless item texts never match; an item without id
    matches like any other and has a null item_id; repeated items each count; columns of
    these names in the input are replaced.
    Benchmarks above MAX_BENCHMARK_BYTES are refused, as all tasks hold them.
    """
    spark = documents.sparkSession
    prepare(spark)
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"split the benchmark: {size} bytes, the bound is {MAX_BENCHMARK_BYTES}")
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), "text").collect()
    tests = spark.sparkContext.broadcast(TestSuffixes([r[0] for r in items], [r[1] for r in items], window))
    renamed, kept, new = positional(documents, ("n_words", "n_hit", "matches"))
    names = renamed.columns
    at = names.index(new[text])
    struct = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("n_words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(at))
            for lo, hi, part, own in slices(data, offsets):
                n_words, n_hit, matches = _search(part, own, tests.value)
                rows = [
                    [{"item_id": m[0], "item_word": m[1], "doc_word": m[2], "n_words": m[3]} for m in ms]
                    for ms in matches
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(rows, struct)],
                    [*names, "n_words", "n_hit", "matches"],
                )

    schema = ", ".join(f"{n} {t}" for n, t in renamed.dtypes) + f", n_words long, n_hit long, matches {MATCHES}"
    return renamed.mapInArrow(run, schema).toDF(*kept, "n_words", "n_hit", "matches")


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of `documents` of whose words less than a twentieth lies in matches. Rows
    without words stay, repeated rows fare alike, an empty table or benchmark removes nothing."""
    renamed, columns, new = positional(documents)
    found = find_matches(renamed, benchmark, new["text"])
    return found.filter(~is_contaminated()).select(*renamed.columns).toDF(*columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` against `benchmark`. Items without id count as one in n_items and have no name in
    the digest; null and wordless texts have no words."""
    found = find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )
