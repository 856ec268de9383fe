"""Prefix trie of conversations by the recursion of van Emde Boas.

Sequences are cut at half depth. The part above a cut makes the upper trie, the
parts below it one lower trie per cut prefix, and both are tries of half the depth, so
the same cut applies to all of them at once. Here the recursion is unrolled by
level, each a step over one table:

- *Names.* Content names of aligned spans double in length level by level; then
  cut prefixes are named from the top down: the prefix at a cut is named by the
  prefix half a span above it and the content between (names are 128-bit digests).
- *Tries.* At the bottom of the recursion spans hold `SPAN` turns. Given the name of its cut
  prefix, a span names its own prefixes within the row. Equal names are one node.
- *Totals.* Every node first gathers the nodes below it within its span. Then, level by level,
  the roots of lower tries hand their totals to the cut node above, and those are
  grafted onto the nodes on its path through the upper trie. A level only moves one row per
  cut node and per step of its path, a small part of the trie even for very long sequences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.ordering import running_totals
from tallymark.llm.common import positional, prepare, stored, table

#: Turns of a span at the bottom of the recursion.
SPAN = 16

ROOT = b"root"


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest of role and text, chars of the text; by turn
    (null first, equal ones by digest). A null role or text is empty; rows without
    conv_id belong to no conversation and are left out."""
    renamed, _, new = positional(conversations)
    text = F.coalesce(F.col(new["text"]).cast("string"), F.lit(""))
    role = F.coalesce(F.col(new["role"]).cast("string"), F.lit(""))
    rows = renamed.filter(F.col(new["conv_id"]).isNotNull()).select(
        F.col(new["conv_id"]).cast("bigint").alias("conv_id"),
        F.col(new["turn"]).alias("turn"),
        _name(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_totals(rows, ["turn", "digest"], ["one"], ("conv_id",))
    return placed.select("conv_id", (F.col("before_one") + 1).alias("pos"), "digest", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequences, conversations): conversation c starts with the first h turns of conversation
    c - c % 100 and goes on with its own turns after its first h, h being the checksum of c
    modulo 6. Second, every conv_id with its number of turns then."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("bigint")
    per = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumn("h", h)
    base = F.col("conv_id") - F.col("conv_id") % 100
    bases = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("pos") <= 5)).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    heads = (
        per.withColumn("base", base).join(bases, "base").filter("pos <= h").select("conv_id", "pos", "digest", "chars")
    )
    taken = bases.groupBy("base").agg(F.max("pos").alias("has"))
    sized = per.withColumn("base", base).join(taken, "base", "left").select(
        "conv_id", "own", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("head")
    )
    tails = (
        turns.withColumn("h", h).filter("pos > h").join(sized.select("conv_id", "head"), "conv_id")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "digest", "chars")
    )
    length = F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return heads.unionByName(tails), sized.select("conv_id", length.alias("turns"))


def _spans(sequences: DataFrame, span: int) -> DataFrame:
    """One row per conversation and span: its turns in order."""
    at = F.floor((F.col("pos") - 1) / span).cast("bigint")
    turn = F.struct("pos", "digest", "chars")
    return sequences.groupBy("conv_id", at.alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _cut_names(spans: DataFrame, span: int, levels: int) -> DataFrame | None:
    """(conv_id, block, cut): the name of the prefix in front of each span but the first.

    Content names of 2^j spans in a row are made from those of half as many; from the top down,
    the cut at an odd multiple of 2^j spans is named by the cut 2^j spans before and the content between."""
    if not levels:
        return None
    full = F.size("turns") == span
    content = spans.filter(full).select("conv_id", "block", _name(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "").cast("binary")).alias("content"))
    contents = [stored(content, "spans")]
    for _ in range(levels - 1):
        below = contents[-1]
        halves = below.groupBy("conv_id", F.floor(F.col("block") / 2).cast("bigint").alias("up")).agg(
            F.max(F.when(F.col("block") % 2 == 0, F.hex("content"))).alias("left"),
            F.max(F.when(F.col("block") % 2 == 1, F.hex("content"))).alias("right"),
        )
        both = halves.filter("left is not null and right is not null")
        contents.append(
            stored(both.select("conv_id", F.col("up").alias("block"), _name(F.concat("left", "right").cast("binary")).alias("content")), "spans")
        )
    cuts = None
    for j in range(levels - 1, -1, -1):
        # cuts so far: multiples of 2^(j+1) spans; add the odd multiples of 2^j
        even = contents[j].filter("block % 2 = 0")
        first = even.filter("block = 0").withColumn("cut", F.lit(ROOT))
        later = even.filter("block > 0")
        if cuts is None:
            named = first
        else:
            above = cuts.select("conv_id", F.floor(F.col("block") / (1 << j)).cast("bigint").alias("block"), "cut")
            named = first.unionByName(later.join(above, ["conv_id", "block"]))
        own = named.select("conv_id", ((F.col("block") + 1) * (1 << j)).alias("block"), _name("cut", "content").alias("cut"))
        cuts = stored(own if cuts is None else cuts.unionByName(own), "cuts")
    return cuts


def _paths(spans: DataFrame, cuts: DataFrame | None, span: int) -> DataFrame:
    """conv_id, block, top (name of the cut prefix), names of the span's prefixes, chars of their last texts."""
    if cuts is None:
        placed = spans.withColumn("top", F.lit(ROOT))
    else:
        placed = spans.join(cuts, ["conv_id", "block"], "left").withColumn("top", F.coalesce("cut", F.lit(ROOT)))
    empty = F.array().cast("array<binary>")
    names = F.aggregate(
        "turns", F.struct(F.col("top").alias("at"), empty.alias("names")),
        lambda acc, t: _extended(acc, t), lambda acc: acc["names"],
    )
    # A full span ends at a cut, and the cut has a name of its own: use that one, so that both agree.
    ends = placed.select("conv_id", "block", "top", names.alias("names"), F.transform("turns", lambda t: t["chars"]).alias("chars"))
    if cuts is None:
        return ends
    after = cuts.select("conv_id", (F.col("block") - 1).alias("block"), F.col("cut").alias("bottom"))
    joined = ends.join(after, ["conv_id", "block"], "left")
    closed = F.when(
        F.col("bottom").isNull(), F.col("names")
    ).otherwise(F.concat(F.slice("names", 1, span - 1), F.array("bottom")))
    return joined.select("conv_id", "block", "top", closed.alias("names"), "chars")


def _extended(acc: Column, turn: Column) -> Column:
    name = _name(acc["at"], turn["digest"])
    return F.struct(name.alias("at"), F.concat(acc["names"], F.array(name)).alias("names"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each node, which come in order and are not held."""
    at, sha = None, hashlib.sha256()
    done: list[tuple] = []

    def pack():
        names, shas = [d[0] for d in done], [d[1] for d in done]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(shas, pa.string())], names=["node", "ends_sha256"])

    for batch in batches:
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if node != at:
                if at is not None:
                    done.append((at, sha.hexdigest()))
                at, sha = node, hashlib.sha256(str(conv).encode())
            else:
                sha.update(b",%d" % conv)
        yield pack()
    if at is not None:
        done.append((at, sha.hexdigest()))
    yield pack()


def build_trie(sequences: DataFrame, conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """The trie of `sequences` (conv_id, pos from 1, digest, chars) over all of `conversations`
    (conv_id, turns), also those without turns. One row per node: node and parent (names),
    depth, conv_id (smallest member), n_convs, n_children, n_leaves, saved_chars, ends_sha256.
    Without conversations there is no node. Equal sequences are members of the same nodes."""
    prepare(sequences.sparkSession)
    spans = stored(_spans(sequences, span), "spans")
    deepest = spans.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]
    levels = int(deepest).bit_length()
    paths = stored(_paths(spans, _cut_names(spans, span, levels), span), "paths")
    member = paths.select(
        "conv_id", "block", "top", "names", F.posexplode(F.arrays_zip("names", "chars")).alias("i", "turn"),
    ).select(
        "conv_id", F.col("turn.names").alias("node"), F.col("turn.chars").alias("chars"),
        F.when(F.col("i") == 0, F.col("top")).otherwise(F.get("names", F.col("i") - 1)).alias("parent"),
        (F.col("block") * span + F.col("i") + 1).alias("depth"),
    )
    nodes = stored(
        member.groupBy("node", "parent", "depth", "chars").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "nodes"
    )
    children = nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "node")
    weighed = stored(
        nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaf", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")),
        "nodes",
    )
    totals = _totals(weighed, paths, span, levels)
    last = conversations.filter("turns > 0").select(
        "conv_id", F.floor((F.col("turns") - 1) / span).cast("bigint").alias("block"), ((F.col("turns") - 1) % span + 1).cast("int").alias("i")
    )
    at_end = paths.join(last, ["conv_id", "block"]).select(F.element_at("names", F.col("i")).alias("node"), "conv_id")
    at_root = conversations.filter("turns = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    ends = at_end.unionByName(at_root).repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(
        _ends, "node binary, ends_sha256 string"
    )
    below = totals.join(weighed.filter("depth = 1").select("node"), "node", "left_semi")
    under = below.agg(F.struct(F.sum("n_leaves").alias("leaves"), F.sum("saved_chars").alias("saved"), F.count(F.lit(1)).alias("n"))).scalar()
    root = (
        conversations.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
        .withColumn("under", under).select("*", "under.*")
        .select(
            F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_convs",
            F.col("n").alias("n_children"), F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).cast("bigint").alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_chars"),
        )
    )
    rest = weighed.join(totals, "node").select("node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_chars")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        rest.unionByName(root).join(ends, "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    )


def _totals(nodes: DataFrame, paths: DataFrame, span: int, levels: int) -> DataFrame:
    """(node, n_leaves, saved_chars) over each node's subtree."""
    block = F.floor((F.col("depth") - 1) / span).cast("bigint")
    mine = nodes.select("node", "conv_id", "depth", block.alias("block"), "leaf", "saved")
    within = (
        mine.join(paths.select("conv_id", "block", "names"), ["conv_id", "block"])
        .select(F.explode(F.slice("names", 1, ((F.col("depth") - 1) % span + 1).cast("int"))).alias("node"), "leaf", "saved")
        .groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_chars"))
    )
    local = stored(within, "totals")
    if not levels:
        return local
    # Roots of lower tries: first node of a span that is not the first.
    tops = stored(
        nodes.filter((F.col("depth") > span) & ((F.col("depth") - 1) % span == 0))
        .select("node", "parent", "conv_id", block.alias("block")).join(local, "node"), "tops",
    )
    grafted = None
    for j in range(levels):
        of_level = F.shiftright(F.col("block"), j) % 2 == 1
        lowest = F.col("block") % (1 << j) == 0
        now = tops.filter(of_level & lowest)
        if grafted is not None:
            more = grafted.groupBy("node").agg(F.sum("n_leaves").alias("ml"), F.sum("saved_chars").alias("ms"))
            now = now.join(more, "node", "left").select(
                "node", "parent", "conv_id", "block",
                (F.col("n_leaves") + F.coalesce("ml", F.lit(0))).alias("n_leaves"), (F.col("saved_chars") + F.coalesce("ms", F.lit(0))).alias("saved_chars"),
            )
        # All roots below one cut node hang on the path of any of its members.
        cut = now.groupBy("parent", "block").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_chars").alias("saved_chars")
        )
        upper = cut.select("conv_id", "n_leaves", "saved_chars", F.explode(F.sequence(F.col("block") - (1 << j), F.col("block") - 1)).alias("block"))
        onto = stored(
            upper.join(paths.select("conv_id", "block", "names"), ["conv_id", "block"])
            .select(F.explode("names").alias("node"), "n_leaves", "saved_chars")
            .groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_chars").alias("saved_chars")),
            "grafts",
        )
        grafted = onto if grafted is None else grafted.unionByName(onto)
    return local.unionByName(grafted).groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_chars").alias("saved_chars"))


def conversation_trie(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """The trie of `conversations` as they are. Nulls, ties and repeated rows as in
    `turns_in_order`; a repeated row is a turn of its own. An empty table gives no node."""
    turns = stored(turns_in_order(conversations), "turns")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("turns"))
    return build_trie(turns, sizes, span)


def op12_prefix_trie(spark: SparkSession, sf_dir: str, span: int = SPAN) -> DataFrame:
    """The trie of the rebuilt `conversations`, a row per node; rows without conv_id have none."""
    return rebuilt_trie(table(spark, sf_dir, "conversations"), span)


def rebuilt_trie(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """`build_trie` over rebuilt conversations with the digest columns of the query."""
    turns = stored(turns_in_order(conversations), "turns")
    sequences, sizes = rebuilt(turns)
    trie = stored(build_trie(stored(sequences, "sequences"), stored(sizes, "sizes"), span), "trie")
    parents = trie.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return trie.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved_chars").alias("saved_tokens"), "ends_sha256"
    )
