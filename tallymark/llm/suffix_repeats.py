"""Repeated passages by suffix order, refined level by level.

Sorting all suffixes of a corpus would move many times its bytes, so the suffix
order is taken where it decides: every window of `LENGTH` bytes names an anchor,
the place of the smallest hash among its K-byte strings. Equal windows have
their anchors at the same offset, so suffixes can only match over a whole window
if their anchors' K-byte strings are equal. Anchors whose string is unique drop
out; the rest are ordered string by string. Suffixes that stay equal over all
windows of an anchor are one run of the suffix order, kept as its size and its
first place: that place is where its longest previous factors begin.

Where a string has several runs that a task can hold, the suffixes of their windows are sorted,
adjacent common prefixes measured, and the previous and next smaller positions in that order
give the longest previous factor of each. A string with more runs is refined first: anchors are
taken again with longer strings (166, 192, 198, 200 of 200 bytes), runs are cut where the anchor
moves, strings that have become unique drop out, runs that have become equal are folded to
their size and first place, and what a task can hold by then is sorted. At `LENGTH` bytes a run is
one window and nothing is left to tell apart. Either way gives the same spans; a passage in N
different surroundings keeps a few runs per occurrence and level, and no task holds more
than `TASK_RUNS` runs of a string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm.common import buffers, grouped_stream, mix, positional, powers, prefix_hash, prepare, slices, stored, table

LENGTH = 200
K = 64
#: Runs of one string that a task sorts; strings with more are refined by longer anchors.
TASK_RUNS = 256

_LOW = np.uint64(0xFFFFFFFF)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, k: int = K) -> tuple[np.ndarray, ...]:
    """First window start, number of consecutive windows, anchor place and
    anchor string hash; windows lie within one text each."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    width = length - k + 1
    c = prefix_hash(data)
    hashed = mix((c[k:] - c[:-k]) * powers(len(data) - k + 1, inverse=True))
    low = (hashed & ~_LOW) | np.arange(len(hashed), dtype=np.uint64)
    n = len(low) - width + 1
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    at = (np.minimum(low[:n], low[width - span : width - span + n]) & _LOW).astype(np.int64)
    start = np.arange(n)
    inside = start + length <= offsets[np.searchsorted(offsets, start, side="right")]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    total = np.concatenate([[0], np.cumsum(inside)])
    count = total[np.append(first[1:], n)] - total[first]
    return first, count, at[first], hashed[at[first]]


def longest_previous_factor(keys: list[bytes], position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For equal-length suffix keys: the longest common prefix of each with one
    at a smaller position, and with any other one."""
    n = len(keys)
    order = sorted(range(n), key=keys.__getitem__)
    rows = np.frombuffer(b"".join([keys[i] for i in order]), np.uint8).reshape(n, -1)
    common = np.zeros(n + 1, np.int64)  # common[i]: between the suffixes of rank i-1 and i
    differ = rows[1:] != rows[:-1]
    common[1:n] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    best = np.maximum(common[:-1], common[1:])
    previous = np.zeros(n, np.int64)
    where = position[order].tolist()
    for ranks, gap in ((range(n), 0), (range(n - 1, -1, -1), 1)):
        stack: list[tuple[int, int]] = []  # position, shortest prefix to the next on the stack
        prefix = common.tolist()
        for i in ranks:
            shortest = prefix[i + gap]
            while stack and stack[-1][0] >= where[i]:
                shortest = min(shortest, stack.pop()[1])
            if stack:
                previous[i] = max(previous[i], shortest)
            stack.append((where[i], shortest))
    out_previous, out_best = np.empty(n, np.int64), np.empty(n, np.int64)
    out_previous[order], out_best[order] = previous, best
    return out_previous, out_best


def levels(length: int, k: int = K) -> list[int]:
    """String lengths of the refinements: three quarters of the way to `length` each time."""
    out = []
    while k < length:
        k = length - (length - k) // 4
        out.append(k)
    return out


def _run_digest(content: bytes, offset: int) -> bytes:
    return hashlib.blake2b(content, digest_size=16, salt=offset.to_bytes(4, "little")).digest()


def _list_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi, part, own in slices(data, offsets):
                first, count, at, hashed = anchors(part, own, length)
                raw = part.tobytes()
                row = np.searchsorted(own, first, side="right") - 1
                offset = at - first
                same = [
                    _run_digest(raw[s : s + n + length - 1], o) for s, n, o in zip(first.tolist(), count.tolist(), offset.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                        batch.column(1).slice(lo, hi - lo).take(pa.array(row)),
                        pa.array(hashed.view(np.int64)),
                        pa.array(same, pa.binary()),
                        pa.array(first - own[row]),
                        pa.array(count.astype(np.int32)),
                        pa.array(offset.astype(np.int32)),
                    ],
                    ["id", "text_key", "string", "run", "start", "n_windows", "offset"],
                )

    return run


def _list_strings(length: int):
    """The anchors' strings alone, so that counting moves no more than them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for _, _, part, own in slices(data, offsets):
                hashed = anchors(part, own, length)[3]
                yield pa.RecordBatch.from_arrays([pa.array(hashed.view(np.int64))], ["string"])

    return run


def _list_contexts(length: int, of_items: bool):
    """Bytes of the wanted runs, from texts or (`of_items`) from the runs they lie in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, raw, wanted = (batch.column(i).to_pylist() for i in range(4))
            begins = batch.column(4).to_pylist() if of_items else [0] * len(ids)
            rows = []
            for id_, key, text, runs, begin in zip(ids, keys, raw, wanted, begins, strict=True):
                text = text.encode() if isinstance(text, str) else text or b""
                for w in runs:
                    s = w["start"] - begin
                    rows.append((id_, key, w["start"], w["size"], text[s : s + w["n_windows"] + length - 1], w["string"], w["large"]))
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)],
                ["id", "text_key", "item", "size", "bytes", "string", "large"],
            )

    return run


def _cut_runs(length: int, k: int):
    """Items cut where the anchor of `k` bytes moves: string, digest, start, windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(4))
            items = batch.column(2).to_numpy()
            for lo, hi, part, own in slices(data, offsets):
                first, count, at, hashed = anchors(part, own, length, k)
                raw = part.tobytes()
                row = np.searchsorted(own, first, side="right") - 1
                same = [
                    _run_digest(raw[s : s + n + length - 1], o)
                    for s, n, o in zip(first.tolist(), count.tolist(), (at - first).tolist(), strict=True)
                ]
                of = pa.array(lo + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(i).take(of) for i in range(4)], pa.array(hashed.view(np.int64)), pa.array(same, pa.binary()),
                        pa.array(items[lo + row] + first - own[row]), pa.array(count.astype(np.int64)),
                    ],
                    ["id", "text_key", "item", "size", "string", "run", "start", "n_windows"],
                )

    return run


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist(), strict=True))


def _order_suffixes(length: int):
    def work(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        ids, keys = t["id"].to_pylist(), t["text_key"].to_pylist()
        begin, size, raw = t["item"].to_numpy(), t["size"].to_numpy(), t["bytes"].to_pylist()
        rows = []
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if hi - lo < 2:
                continue
            texts = {d: i for i, d in enumerate(sorted({(ids[i] is None, ids[i] or 0, keys[i]) for i in range(lo, hi)}))}
            suffixes, place, counts = [], [], []
            for i in range(lo, hi):
                n = len(raw[i]) - length + 1
                counts.append(n)
                suffixes += [raw[i][j : j + length] for j in range(n)]
                place.append((texts[(ids[i] is None, ids[i] or 0, keys[i])] << 40) + begin[i] + np.arange(n))
            previous, best = longest_previous_factor(suffixes, np.concatenate(place))
            at = 0
            for i, n in zip(range(lo, hi), counts, strict=True):
                if size[i] == 1:
                    rows += [(ids[i], keys[i], begin[i] + s, m, False) for s, m in _runs(best[at : at + n] >= length)]
                rows += [(ids[i], keys[i], begin[i] + s, m, True) for s, m in _runs(previous[at : at + n] >= length)]
                at += n
        if not rows:
            return None
        kinds = [t.schema.field("id").type, pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["id", "text_key", "start", "n_windows", "later"],
        )

    return work


PLACE = ("no_id", "id", "text_key", "start")


def _place():
    """Order of places: id with nulls last, hash of the text, byte."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "start")


def _folded(runs: DataFrame, *more: str) -> DataFrame:
    """Equal runs as one: how many places they have, and the first of them with `more`."""
    detail = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "start", *more)
    return runs.groupBy("string", "run").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("parts"), F.min(detail).alias("first"))


def _wanted(folded: DataFrame, *item: str) -> DataFrame:
    """The runs of strings that have several, listed per text (and item)."""
    many = folded.groupBy("string").agg(F.count(F.lit(1)).alias("n_runs")).filter("n_runs > 1")
    # stored frames on both sides: a string with many runs can be split over tasks
    several = folded.join(stored(many, "several").hint("merge"), "string")
    run = F.struct("string", "size", "first.start", "first.n_windows", (F.col("n_runs") > TASK_RUNS).alias("large"))
    names = ["id", "text_key", *item]
    return several.select(*[F.col(f"first.{c}").alias(c) for c in names], run.alias("wanted")).groupBy(*names).agg(
        F.collect_list("wanted").alias("wanted")
    )


def _newly_equal(runs: DataFrame, folded: DataFrame, keep_first: bool) -> DataFrame:
    """Places of runs that turn out to have an equal one: those after the first
    place, or all that were single so far."""
    both = runs.withColumnRenamed("size", "own").join(folded.filter("parts > 1").hint("merge"), ["string", "run"])
    first = F.struct(*[f"first.{c}" for c in PLACE])
    both = both.filter(_place() != first) if keep_first else both.filter("own = 1")
    return both.select("id", "text_key", "start", F.col("n_windows").cast("long").alias("n_windows"))


def _settle(items: DataFrame, kind: str, length: int, keep_first: bool, with_runs) -> list[DataFrame]:
    """Repeated windows of `items`, runs with their bytes in strings that have several:
    those that a task can hold by suffix order, the others refined level by level."""
    found = []
    for k in [0, *levels(length)]:
        if k:
            large = items.filter("large")
            if large.isEmpty():
                break
            runs = stored(
                large.mapInArrow(
                    _cut_runs(length, k), f"id {kind}, text_key long, item long, size long, string long, run binary, start long, n_windows long"
                ),
                "cut-runs",
            )
            folded = stored(_folded(runs, "item", "n_windows"), "folded-runs")
            found.append(_newly_equal(runs, folded, keep_first))
            if k == length:
                break
            items = stored(
                with_runs(_wanted(folded, "item"), "inner", large, ("item",)).select("id", "text_key", "bytes", "wanted", "item").mapInArrow(
                    _list_contexts(length, True), f"id {kind}, {ITEM}"
                ),
                "contexts",
            )
        ordered = grouped_stream(
            items.filter("not large"), ["string"], f"id {kind}, text_key long, start long, n_windows long, later boolean", _order_suffixes(length)
        )
        found.append(stored(ordered, "factors").filter(F.col("later") == F.lit(keep_first)).drop("later"))
    return found


ITEM = "text_key long, item long, size long, bytes binary, string long, large boolean"


def _cut(length: int, n_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(n_columns))
            spans, kept = [], []
            for i, found in enumerate(batch.column(n_columns + 1).to_pylist()):
                raw = data[offsets[i] : offsets[i + 1]]
                marks = np.zeros(len(raw) + 1, np.int64)
                if found:
                    s = np.array([f["start"] for f in found])
                    e = s + np.array([f["n_windows"] for f in found]) + length - 1
                    np.add.at(marks, s, 1)
                    np.add.at(marks, e, -1)
                gone = np.cumsum(marks[:-1]) > 0
                spans.append([{"start": s, "end": s + m} for s, m in _runs(gone)])
                kept.append(raw[~gone].tobytes())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n_columns], pa.array(np.diff(offsets)), pa.array(spans, kind), pa.array(kept, pa.binary())],
                [*batch.schema.names[:n_columns], "n_bytes", "spans", "kept"],
            )

    return run


def repeated_passages(
    documents: DataFrame, keep_first: bool = True, length: int = LENGTH, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`documents` with n_bytes, spans (byte ranges covered by a string of
    `length` bytes that starts elsewhere, too) and kept (the other bytes).

    With keep_first only strings with an earlier copy are cut (order: id with
    nulls last, hash of the text, byte place), so the first copy stays; else
    all copies go. Matches never cross rows. Null and short texts have no
    spans. Exactly repeated rows count as copies of each other; as they share
    one place, keep_first leaves both. Columns named like the added ones are replaced.
    """
    spark = documents.sparkSession
    prepare(spark)
    carried, columns, new = positional(documents, ("n_bytes", "spans", "kept"))
    names, id_name, text_name = carried.columns, new[id_col], new[text]
    base = carried.select(
        F.col(id_name).alias("id"), F.xxhash64(text_name).alias("text_key"), F.col(text_name).alias("text")
    )
    kind = dict(base.dtypes)["id"]
    listed = base.mapInArrow(
        _list_anchors(length),
        f"id {kind}, text_key long, string long, run binary, start long, n_windows int, offset int",
    )
    counted = (
        base.select("text").mapInArrow(_list_strings(length), "string long")
        .groupBy("string").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("string")
    )
    # stored, so that both sides of the join come from a shuffle of their own and a
    # string that many places share can be split over tasks
    again = stored(counted, "strings")
    shared = stored(listed.join(again.hint("merge"), "string"), "anchors")
    shared = shared.withColumn("size", F.lit(1).cast("long"))
    folded = stored(_folded(shared, "n_windows"), "runs")
    def with_text(other: DataFrame, how: str, left: DataFrame = base, more: tuple[str, ...] = ()) -> DataFrame:
        other = other.withColumnsRenamed({c: f"_{c}" for c in ("id", "text_key", *more)})
        on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_text_key"))
        for c in more:
            on = on & (F.col(c) == F.col(f"_{c}"))
        # the lists grow with the corpus: never broadcast
        return left.join(other.hint("merge"), on, how).drop("_id", "_text_key", *[f"_{c}" for c in more])

    contexts = stored(
        with_text(_wanted(folded), "inner").mapInArrow(_list_contexts(length, False), f"id {kind}, {ITEM}"),
        "contexts",
    )
    found = _newly_equal(shared, folded, keep_first)
    for more in _settle(contexts, kind, length, keep_first, with_text):
        found = found.unionByName(more)
    found = found.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "n_windows")).alias("found"))
    left = carried.select("*", F.col(id_name).alias("id"), F.xxhash64(text_name).alias("text_key"))
    joined = with_text(found, "left", left).select(*names, F.col(text_name).alias("text"), "found")
    schema = ", ".join(f"{n} {t}" for n, t in carried.dtypes)
    return joined.mapInArrow(
        _cut(length, len(names)), f"{schema}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    ).toDF(*columns, "n_bytes", "spans", "kept")


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats within `documents`, a row per row, all copies cut; edge cases as in `repeated_passages`
    (null and short texts lose nothing, repeated rows are copies of each other)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_passages(docs, keep_first=False).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
