"""Token counts through a digest cache, and token ids packed into fixed-length rows."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.ordering import new_path
from tallymark.llm.common import grouped_stream, positional, prepare, stored, table

#: Encoded words a worker remembers; beyond that it starts afresh.
REMEMBERED_WORDS = 400_000
#: Longer words are encoded each time.
LONGEST_REMEMBERED = 64
CONTEXT = 2048
#: Text bytes per packing shard; shards are packed on their own.
SHARD_BYTES = 16 << 20
PAD = 50256

_SPACES = re.compile("[ \t\n\r]+")
#: Characters that str.split takes for space but that may be word characters to a tokenizer.
_UNSURE = re.compile(
    "[" + "".join(map(chr, (*range(0x0B, 0x0D), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]"
)
_loaded: dict[str, object] = {}


class WordCounts:
    """Counts of a tokenizer that splits at white space and drops it: a text's
    count is the sum over its space-separated words, each encoded by the library."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str | None]) -> list[int]:
        split = [
            [] if not t else _SPACES.split(t) if _UNSURE.search(t) else t.split() for t in texts
        ]
        new = list({w for ws in split for w in ws if w not in self.known})
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = list({w for ws in split for w in ws})
        short = [w for w in new if len(w) <= LONGEST_REMEMBERED]
        long_ = [w for w in new if len(w) > LONGEST_REMEMBERED]
        for w, n in zip(short, self._lengths(short), strict=True):
            self.known[w] = n
        extra = dict(zip(long_, self._lengths(long_), strict=True))
        known = self.known
        if extra:
            return [sum(extra[w] if w in extra else known[w] for w in ws) for ws in split]
        get = known.__getitem__
        return [sum(map(get, ws)) for ws in split]


def _batches_by_size(texts: list[str | None], limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def normalised(text: Column) -> Column:
    """What the digest covers: runs of blanks, tabs and line ends are one blank,
    none at either end; null is empty. No tokenizer that drops white space tells
    these apart."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\r\\n]+", " "))


CACHE_SCHEMA = "digest binary, version string, n_tokens long"


def count_tokens(
    documents: DataFrame, definition: str, cache: str, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens) per row; `definition` is the tokenizer's JSON and
    `cache` the folder of stored counts, made if absent.

    A row's key is the digest of its normalised text with the digest of the
    tokenizer's definition. Keys found in the cache are not encoded; of the
    missing ones, one text each is, and their counts are appended. Copies, ties
    and repeated rows share a key; null and empty texts count 0; other columns
    are not read. A job that fails before its append leaves the cache as it was,
    and keys stored twice by concurrent jobs count once.
    """
    spark = documents.sparkSession
    prepare(spark)
    version = hashlib.sha256(definition.encode()).hexdigest()
    shared = spark.sparkContext.broadcast(definition)  # a vocabulary file of fixed size
    renamed, _, new = positional(documents)
    base = renamed.select(
        F.col(new[id_col]).alias("id"), F.xxhash64(new[text]).alias("text_key"), F.col(new[text]).alias("text")
    )
    keyed = stored(
        base.select(
            "id",
            "text_key",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("digest"),
        ),
        "token-keys",
    )
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)

    def known() -> DataFrame:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version)
        return rows.select("digest", "n_tokens").dropDuplicates(["digest"])

    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key")
    misses = (
        keyed.groupBy("digest")
        .agg(F.min(place).alias("one"))
        .join(known(), "digest", "left_anti")
        .select("digest", F.col("one.id").alias("_id"), F.col("one.text_key").alias("_key"))
    )
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    texts = base.join(misses.hint("merge"), on).select("digest", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if version not in _loaded:
            _loaded[version] = WordCounts(shared.value)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            counts: list[int] = []
            for lo, hi in _batches_by_size(rows):
                counts += _loaded[version].count(rows[lo:hi])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    counted = texts.mapInArrow(encode, "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(known(), "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a cache of its own, so that every call encodes all distinct texts."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counts = count_tokens(docs, definition, new_path(spark, "llm-token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT).alias("over_limit"))


class WordIds:
    """Ids of a byte-level BPE as bytes of little-endian 16-bit numbers. Its
    pattern starts a piece at every blank that no white space follows, so texts
    whose blanks are all such are encoded word by word."""

    UNEVEN = re.compile(r" \s| $")

    def __init__(self, ranks_file: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        self.encoding = tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _bytes(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u2")
        if self.UNEVEN.search(text):
            return np.frombuffer(self._bytes(text), "<u2")
        first, *rest = text.split(" ")
        known, out = self.known, [self._bytes(first)]
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for w in rest:
            b = known.get(w)
            if b is None:
                b = self._bytes(" " + w)
                if len(w) <= LONGEST_REMEMBERED:
                    known[w] = b
            out.append(b)
        return np.frombuffer(b"".join(out), "<u2")


class FreeSpace:
    """A segment tree over free capacities 0..size: finds the smallest one that
    holds a length, in a number of steps that is the logarithm of size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def smallest(self, least: int) -> int | None:
        i = least + self.leaves
        if self.count[i]:
            return least
        while i > 1:  # up to the first ancestor with bins to the right, then down to its left end
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of indexes; each length goes to the fullest bin that holds it,
    longest first (ties: in the order given), the newest of equally full bins."""
    space, bins = FreeSpace(size), []
    by_capacity: dict[int, list[int]] = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        free = space.smallest(lengths[i])
        if free is None:
            number, free = len(bins), size
            bins.append([])
        else:
            number = by_capacity[free].pop()
            space.add(free, -1)
        bins[number].append(i)
        left = free - lengths[i]
        if left:
            by_capacity.setdefault(left, []).append(number)
            space.add(left, 1)
    return bins


PACKED = (
    "shard long, row long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<{kind}>, doc_offsets array<long>"
)


def pack_documents(
    documents: DataFrame,
    ranks_file: bytes,
    pattern: str,
    size: int = CONTEXT,
    id_col: str = "doc_id",
    text: str = "text",
    pad: int = PAD,
) -> DataFrame:
    """Rows of a packed id matrix: input_ids (`size` little-endian 16-bit ids,
    padded with `pad`), cu_seqlens (0 and the cumulative segment lengths),
    position_resets (places where positions start again at 0), and for each
    segment its document and token offset therein.

    Texts are dealt by hash to shards of about SHARD_BYTES; the number of
    shards grows with the input, and the result doesn't depend on partitions.
    Each document's ids are cut into pieces of `size` and a rest, none lost;
    pieces go into rows best fit decreasing. Null and empty texts take no
    place; copies and repeated rows are packed each on its own; other columns
    are not read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast((ranks_file, pattern))  # a vocabulary file of fixed size
    version = hashlib.sha256(ranks_file + pattern.encode()).hexdigest()
    renamed, _, new = positional(documents)
    base = renamed.select(F.col(new[id_col]).alias("id"), F.col(new[text]).alias("text")).filter("text != ''")
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // SHARD_BYTES) or 1
    keyed = base.withColumn("text_key", F.xxhash64("text"))
    sharded = keyed.withColumn("shard", F.pmod(F.xxhash64("id", "text_key"), F.lit(shards)))
    kind = dict(base.dtypes)["id"]

    def work(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        if version not in _loaded:
            _loaded[version] = WordIds(*shared.value)
        encoder = _loaded[version]
        out: list[list] = [[] for _ in range(8)]
        shard, names = t["shard"].to_pylist(), t["id"].to_pylist()
        texts = t["text"]
        for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            pieces: list[tuple] = []  # ids, document, offset
            for i in range(lo, hi):
                ids = encoder.ids(texts[i].as_py())
                pieces += [(ids[at : at + size], names[i], at) for at in range(0, len(ids), size)]
            for row, members in enumerate(best_fit_decreasing([len(p[0]) for p in pieces], size)):
                ids = np.full(size, pad, "<u2")
                ends = np.concatenate([[0], np.cumsum([len(pieces[m][0]) for m in members])])
                ids[: ends[-1]] = np.concatenate([pieces[m][0] for m in members])
                values = (
                    shard[lo], row, ends[-1], ids.tobytes(), ends, ends[:-1],
                    [pieces[m][1] for m in members], [pieces[m][2] for m in members],
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        kinds = [
            pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()),
            pa.list_(t.schema.field("id").type), pa.list_(pa.int64()),
        ]
        names_out = ["shard", "row", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "doc_offsets"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names_out)

    return grouped_stream(sharded, ["shard"], PACKED.format(kind=kind), work, order=["id", "text_key"])


def packing_vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed rows of all `documents`; edge cases as in `pack_documents`."""
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), *packing_vocabulary())
