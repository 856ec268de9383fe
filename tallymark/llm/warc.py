"""Web archives: write WARC records, read them back by verified record boundaries.

A reader that starts in the middle of a file can't tell a record's first line from the same
bytes inside a payload. Here every place with the magic bytes is a candidate. Its
header says where its successor would start, whether it is a record or not. Tasks follow
these pointers within their byte range, so that a candidate points to the first place beyond its
range; then pointers jump from range to range, doubling each time, from the start of the file.
Candidates that are not reached lie inside payloads and are given back to them.

Writing and reading use Spark's text source with the record separator and the magic bytes as
line separators, so that files are split by byte ranges and live on any file system
Spark knows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.ordering import new_path
from tallymark.llm.common import grouped_stream, positional, prepare, stored, table

# Fixed values of the file format.
MAGIC, RECORD_END, HEADER_END = "WARC/1.0\r\n", "\r\n\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

MAGIC_BYTES = len(MAGIC)


def base32(sha1_hex: Column) -> Column:
    """A SHA-1 in hex as 32 letters and digits: ten hex digits are eight of base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _uuid(key: Column) -> Column:
    h = F.md5(key)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _clean(value: Column) -> Column:
    """Header values hold no white space or control characters; such a value is percent-encoded."""
    return F.when(value.rlike(r"[\x00-\x20\x7F]"), F.url_encode(value)).otherwise(value)


def _header(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: str, block: Column, content_type: str, *more: Column, date: str) -> Column:
    return F.concat(
        F.lit(f"{MAGIC}WARC-Type: {kind}\r\n"),
        _header("WARC-Record-ID", F.col("record_id")), F.lit(f"WARC-Date: {date}\r\n"),
        _header("WARC-Target-URI", _clean(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        _header("X-Page-ID", _clean(F.col("page_id").cast("string"))),
        *more,
        F.lit(f"Content-Type: {content_type}\r\n"),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block,
    )


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write `pages` (page_id, url, html) as WARC files below `path`.

    Of pages with equal html (null is empty), the one with the largest page_id (nulls last, then
    the largest url) is a response, the others are revisits without payload that refer to it;
    of exactly repeated rows one is the response. Other columns are ignored. Html of revisits is
    read for its digest only; nothing but digests and ids is shuffled for them."""
    renamed, _, new = positional(pages)
    html = F.coalesce(F.col(new["html"]).cast("string"), F.lit(""))
    page, url = F.col(new["page_id"]), F.col(new["url"]).cast("string")
    rows = renamed.select(page.alias("page_id"), url.alias("url"), html.alias("html")).withColumns(
        {"sha1": F.sha1(F.col("html").cast("binary")), "sha": F.unhex(F.sha2(F.col("html").cast("binary"), 256))}
    )
    mark = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    keyed = rows.withColumn("row_key", F.unhex(F.md5(F.concat_ws("\n", F.hex("sha"), mark("page_id"), mark("url")).cast("binary"))))
    size = F.octet_length("html")
    each = stored(
        keyed.groupBy("row_key", "sha", "sha1", "page_id", "url", size.alias("size")).agg(F.count(F.lit(1)).alias("n")), "page-digests"
    )
    best = F.struct("page_id", "url", "row_key")
    shared = each.groupBy("sha").agg(F.max(best).alias("top"), F.sum("n").alias("m")).filter("m > 1")
    group = stored(
        each.join(shared, "sha").select(
            "row_key", "sha1", "page_id", "url", "n", (F.col("row_key") == F.col("top.row_key")).alias("is_top"), F.col("top.row_key").alias("top")
        ),
        "page-groups",
    )
    # Only rows of shared html are listed, each once; pages that aren't in the list are responses.
    listed = keyed.join(group.select("row_key", "n", "is_top"), "row_key", "left")
    single = listed.filter("n is null or (is_top and n = 1)").select("row_key", "page_id", "url", "sha1", "html")
    folded = listed.filter("is_top and n > 1").groupBy("row_key", "page_id", "url", "sha1").agg(F.first("html").alias("html"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8"), F.lit(HEADER_END), F.col("html"))
    first = F.lit(":1")
    responses = single.unionByName(folded).withColumn("record_id", _uuid(F.concat(F.hex("row_key"), first).cast("binary")))
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("n"))
    again = group.select("*", F.explode(copies).alias("copy")).filter("not (is_top and copy = 1)").withColumn(
        "record_id", _uuid(F.concat(F.hex("row_key"), F.lit(":"), F.col("copy").cast("string")).cast("binary"))
    )
    refers = _header("WARC-Refers-To", _uuid(F.concat(F.hex("top"), first).cast("binary")))
    lines = responses.select(_record("response", http, "application/http; msgtype=response", date=date).alias("value")).unionByName(
        again.select(
            _record("revisit", F.lit(""), "application/http; msgtype=response", F.lit(f"WARC-Profile: {PROFILE}\r\n"), refers, date=date).alias("value")
        )
    )
    lines.write.option("lineSep", RECORD_END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two places with the magic bytes: file, byte range of the task
    (`block`), order in it, content."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), "value",
    )


def _field(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?mi)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _payload(block: Column) -> Column:
    """Payload of an HTTP message: what follows its header."""
    head = F.substring_index(block.cast("string"), HEADER_END, 1)
    return F.substring(block, F.octet_length(head) + len(HEADER_END) + 1, F.octet_length(block))


def _digests(payload: Column) -> dict[str, Column]:
    return {"payload_bytes": F.octet_length(payload).cast("bigint"), "payload_sha1": F.sha1(payload)}


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every place with the magic bytes: file, block, nth, at (byte offset), next (offset of the
    record that would follow; null without a header), header fields, and size and digest of the
    payload where it ends before the next such place."""
    head = F.substring_index("value", HEADER_END, 1)
    parsed = _segments(spark, path).withColumns({"head": head, "size": F.octet_length("value").cast("bigint")})
    length = F.when(F.instr("value", HEADER_END) > 0, _field("Content-Length").try_cast("bigint"))
    body = (F.octet_length("head") + len(HEADER_END)).cast("bigint")
    told = parsed.withColumns({"length": length, "body": body})
    whole = F.col("length").isNotNull() & (F.col("body") + F.col("length") <= F.col("size"))
    block = F.substring(F.col("value").cast("binary"), (F.col("body") + 1).cast("int"), F.col("length").cast("int"))
    payload = F.when(whole & (_field("WARC-Type") == "response"), _payload(block))
    slim = stored(
        told.select(
            "file", "block", "nth", "size", "body", "length", whole.alias("whole"),
            _field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("record_id"), _field("WARC-Target-URI").alias("url"),
            _field("WARC-Payload-Digest").alias("told_digest"), _field("X-Page-ID").alias("page_id"), _field("WARC-Refers-To").alias("refers_to_id"),
            *[x.alias(c) for c, x in _digests(payload).items()],
        ),
        "segments",
    )
    step = F.col("size") + MAGIC_BYTES
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = slim.groupBy("file", "block").agg(F.sum(step).alias("bytes")).select(
        "file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("ahead")
    )
    inside = Window.partitionBy("file", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("ahead") + F.coalesce(F.sum(step).over(inside), F.lit(0))
    placed = slim.join(ranges, ["file", "block"]).withColumn("at", begin - MAGIC_BYTES).filter("at >= 0")
    behind = F.col("at") + MAGIC_BYTES + F.col("body") + F.col("length") + len(RECORD_END)
    return stored(placed.withColumn("next", behind).drop("ahead", "size"), "candidates")


def _steps(rows: pa.Table, starts: np.ndarray):
    """Per range (first row, last row, index of the successor within it or -1)."""
    at, after = rows.column("at").to_numpy(), rows.column("next").fill_null(-1).to_numpy()
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        here, to = at[lo:hi], after[lo:hi]
        i = np.minimum(np.searchsorted(here, to), hi - lo - 1)
        yield lo, hi, np.where(here[i] == to, i, -1).tolist()


def _leave(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """For each candidate the first place beyond its range that its chain leads to."""
    out = rows.column("next").to_pylist()
    for lo, _, step in _steps(rows, starts):
        for i in range(len(step) - 1, -1, -1):
            if step[i] >= 0:
                out[lo + i] = out[lo + step[i]]
    return pa.RecordBatch.from_arrays(
        [rows.column("file").combine_chunks(), rows.column("at").combine_chunks(), pa.array(out, pa.int64())], names=["file", "at", "leaves"]
    )


def _follow(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """Candidates on the chain from the range's entry."""
    reached = rows.column("entry").to_numpy(zero_copy_only=False).tolist()
    for lo, _, step in _steps(rows, starts):
        for i, to in enumerate(step):
            if to >= 0 and reached[lo + i]:
                reached[lo + to] = True
    on = pa.array(np.flatnonzero(reached))
    return pa.RecordBatch.from_arrays([rows.column("file").take(on).combine_chunks(), rows.column("at").take(on).combine_chunks()], names=["file", "at"])


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of the candidates (file, block, at, next) on the chain from each file's start."""
    pointers = candidates.select("file", "block", "at", "next")
    out = stored(grouped_stream(pointers, ["file", "block"], "file string, at bigint, leaves bigint", _leave, ["at"]), "pointers")
    targets = out.filter("leaves is not null").select("file", F.col("leaves").alias("at")).distinct()
    start = out.select("file", F.lit(0).cast("bigint").alias("at")).distinct()
    jumps = stored(
        out.join(targets.unionByName(start).distinct(), ["file", "at"], "left_semi").withColumn("reached", F.col("at") == 0), "jumps"
    )
    longest = jumps.groupBy("file").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    for _ in range(int(longest).bit_length()):
        further = jumps.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("further"))
        marks = jumps.filter("reached and leaves is not null").select("file", F.col("leaves").alias("at"), F.lit(True).alias("mark")).distinct()
        jumps = stored(
            jumps.join(further, ["file", "leaves"], "left").join(marks, ["file", "at"], "left")
            .select("file", "at", F.col("further").alias("leaves"), (F.col("reached") | F.col("mark").isNotNull()).alias("reached")),
            "jumps",
        )
    entries = jumps.filter("reached").select("file", "at", F.lit(True).alias("entry"))
    entered = pointers.join(entries, ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    return grouped_stream(entered, ["file", "block"], "file string, at bigint", _follow, ["at"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records below `path`: file, at, record_type, record_id, url, page_id, payload_bytes,
    payload_digest, intact (the payload has the digest its header tells), refers_to_id. A
    revisit has the size of the response it refers to. Records are those that the chain from a
    file's start reaches; a file that doesn't start with a record, or an empty folder, has none."""
    prepare(spark)
    candidates = _candidates(spark, path)
    on_chain = stored(reachable(candidates), "reached")
    records = candidates.join(on_chain, ["file", "at"])
    torn = records.filter("not whole and record_type = 'response'")
    if not torn.isEmpty():
        records = _with_mended(records, _mended(spark, path, candidates, on_chain))
    answers = records.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max("payload_bytes").alias("answer_bytes"), F.max("page_id").alias("refers_to"),
    )
    own = F.when(F.col("record_type") == "response", F.concat(F.lit("sha1:"), base32(F.col("payload_sha1"))))
    digest = F.regexp_replace(F.coalesce(own, F.col("told_digest")), "^sha1:", "")
    # Responses refer to nothing and stay out of the join, where they would share one key.
    nothing = {"answer_bytes": F.lit(None).cast("bigint"), "refers_to": F.lit(None).cast("string")}
    referring = records.filter("refers_to_id is not null").join(answers, "refers_to_id", "left")
    return referring.unionByName(records.filter("refers_to_id is null").withColumns(nothing)).select(
        "file", "at", "record_type", "record_id", "url", "page_id", F.coalesce("payload_bytes", "answer_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"), F.coalesce(own == F.col("told_digest"), F.lit(True)).alias("intact"), "refers_to_id", "refers_to",
    )


def _with_mended(records: DataFrame, mended: DataFrame) -> DataFrame:
    fresh = mended.withColumnsRenamed({"payload_bytes": "mended_bytes", "payload_sha1": "mended_sha1"})
    return records.join(fresh, ["file", "at"], "left").withColumns(
        {"payload_bytes": F.coalesce("mended_bytes", "payload_bytes"), "payload_sha1": F.coalesce("mended_sha1", "payload_sha1")}
    ).drop("mended_bytes", "mended_sha1")


def _mended(spark: SparkSession, path: str, candidates: DataFrame, on_chain: DataFrame) -> DataFrame:
    """Size and digest of payloads that hold the magic bytes: their segments, put together again."""
    marked = candidates.join(on_chain.withColumn("own", F.col("at")), ["file", "at"], "left")
    since = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = marked.withColumn("owner", F.last("own", ignorenulls=True).over(since))
    torn = marked.filter("own is not null and not whole and record_type = 'response'").select(
        "file", F.col("at").alias("owner"), F.col("body").alias("from"), F.col("length").alias("bytes")
    )
    pieces = owned.select("file", "block", "nth", "at", "owner").join(torn, ["file", "owner"])
    whole = (
        _segments(spark, path).join(pieces, ["file", "block", "nth"])
        .groupBy("file", "owner", "from", "bytes")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("pieces"))
        .withColumn("value", F.array_join(F.transform("pieces", lambda p: p["value"]), MAGIC).cast("binary"))
    )
    block = F.substring(F.col("value"), (F.col("from") + 1).cast("int"), F.col("bytes").cast("int"))
    return whole.select("file", F.col("owner").alias("at"), *[x.alias(c) for c, x in _digests(_payload(block)).items()])


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes `pages` as archives in the shared folder and reads them back, a row per page."""
    path = new_path(spark, "llm-warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path).select(
        F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("refers_to")).cast("bigint").alias("refers_to"), "intact",
    )
