"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's target over its size is the expected number of copies of each of its
documents: a whole part that all get and a fraction p that rounding decides.
Rounding takes two undecided documents and moves words between their fractions,
p1*size1 + p2*size2 staying the same, until one is 0 or 1; which way is drawn so
that both expectations hold. The other one goes on. Blocks of documents run this
from left to right; the one undecided document each block leaves goes to the next
level of the tree, whose blocks hold the leftovers of FAN blocks below. Long
documents come first in a block, so what stays undecided is short. All but one
document of a source are decided this way, so its words come within one
document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.llm.common import positional, stored, table

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Documents in a block, and blocks whose leftovers meet on the next level.
FAN = 64

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST_COPIES, weights=WEIGHTS) -> DataFrame:
    """(source, n_docs, source_size, target) from rows of (source, size).

    Sources by code point, null last, weigh `weights` in turn and share `share`
    times all sizes; none gets over `most` times its size, and what is cut is
    shared again by weight until none is above. That ends at one level of words
    a weight. With sources in the order of most*size/weight, the level left to a
    source and all after it rises while sources before it are capped and falls
    afterwards, so it is the largest among sources that it doesn't cap. One row
    per source is ordered here, not documents.
    """
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = per.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    cap = F.lit(most) * F.col("source_size")
    by_level = Window.orderBy(cap / F.col("_w"), F.col("source").isNull(), "source")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0))
    others = F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0))
    at = weighed.withColumn("_level", left / others).withColumn("_binds", cap / F.col("_w") >= left / others)
    level = F.max(F.when(F.col("_binds"), F.col("_level"))).over(all_rows)
    target = F.least(cap, F.coalesce(level * F.col("_w"), cap))
    return at.withColumn("target", target.cast("double")).select("source", "n_docs", "source_size", "target")


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) fixed by its arguments."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11)).cast("double") / F.lit(float(1 << 53))


def _fold(items: Column, seed: int) -> Column:
    """Run pivotal rounding along an array of (row, size, p); `done` gets rows
    with their decision, `open` the one left undecided."""

    def step(state: Column, x: Column) -> Column:
        held = state["open"]
        p1, s1, p2, s2 = held["p"], held["size"].cast("double"), x["p"], x["size"].cast("double")
        # words that can move from x to held, and from held to x
        up = F.least((1.0 - p1) * s1, p2 * s2)
        down = F.least(p1 * s1, (1.0 - p2) * s2)
        rise = _uniform(F.lit(seed), held["row"]["tag"], x["row"]["tag"], held["size"], x["size"]) * (up + down) < down
        q1 = F.when(rise, F.when((1.0 - p1) * s1 <= p2 * s2, 1.0).otherwise(p1 + up / s1)).otherwise(
            F.when(p1 * s1 <= (1.0 - p2) * s2, 0.0).otherwise(p1 - down / s1)
        )
        q2 = F.when(rise, F.when((1.0 - p1) * s1 <= p2 * s2, p2 - up / s2).otherwise(0.0)).otherwise(
            F.when(p1 * s1 <= (1.0 - p2) * s2, p2 + down / s2).otherwise(1.0)
        )
        one_done = (q1 <= 0.0) | (q1 >= 1.0)
        decided = F.when(one_done, F.struct(held["row"].alias("row"), (q1 >= 1.0).alias("more"))).otherwise(
            F.struct(x["row"].alias("row"), (q2 >= 1.0).alias("more"))
        )
        goes_on = F.when(
            one_done, F.struct(x["row"].alias("row"), x["size"].alias("size"), q2.alias("p"))
        ).otherwise(F.struct(held["row"].alias("row"), held["size"].alias("size"), q1.alias("p")))
        return F.struct(F.concat(state["done"], F.array(decided)).alias("done"), goes_on.alias("open"))

    first = F.element_at(items, 1)
    none = F.filter(F.array(F.struct(first["row"].alias("row"), F.lit(True).alias("more"))), lambda _: F.lit(False))
    rest = F.slice(items, 2, F.lit(1 << 30))
    return F.aggregate(rest, F.struct(none.alias("done"), first.alias("open")), step)


def pivotal_copies(rows: DataFrame, seed: int = 7) -> DataFrame:
    """`rows` of (row struct with a long `tag`, stratum, n_docs, size, expected)
    with `copies`: the whole part of `expected`, and rounding's decision on the
    rest. `tag` should tell rows apart; equal rows may share it."""
    whole = F.floor("expected")
    p = F.col("expected") - whole
    laid = stored(rows.withColumn("_whole", whole.cast("long")).withColumn("_p", p), "mix-rows")
    settled = (F.col("_p") <= 0) | (F.col("size") <= 0)
    out = [laid.filter(settled).select("row", F.col("_whole").alias("copies"))]
    most = laid.filter(~settled).groupBy("stratum").count().agg(F.max("count")).first()[0] or 0
    blocks = F.ceil(F.col("n_docs") / F.lit(FAN)).cast("long")
    level = laid.filter(~settled).select(
        F.struct("row.*", "_whole").alias("row"),
        "stratum",
        "size",
        F.col("_p").alias("p"),
        F.pmod(F.xxhash64(F.lit(seed), "row.tag"), blocks).alias("block"),
        blocks.alias("n_blocks"),
    )
    while most > 0:
        item = F.struct("row", "size", "p")
        ordered = F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), F.xxhash64(F.lit(seed), "row.tag").alias("o"), item.alias("item")))),
            lambda x: x["item"],
        )
        folded = stored(
            level.groupBy("stratum", "block", "n_blocks")
            .agg(ordered.alias("items"))
            .select("stratum", "block", "n_blocks", _fold(F.col("items"), seed).alias("s")),
            "mix-level",
        )
        decided = folded.select(F.explode("s.done").alias("d")).select(
            "d.row", (F.col("d.row._whole") + F.col("d.more").cast("long")).alias("copies")
        )
        fields = [f"row.{f}" for f in rows.schema["row"].dataType.names]
        out.append(decided.select(F.struct(*fields).alias("row"), "copies"))
        left = folded.select(
            F.col("s.open.row").alias("row"), "stratum", F.col("s.open.size").alias("size"), F.col("s.open.p").alias("p"),
            "block", "n_blocks",
        )
        if folded.filter("n_blocks > 1").isEmpty():
            # the last undecided row of each stratum: an independent draw
            draw = _uniform(F.lit(seed), F.lit("last"), F.col("row.tag")) < F.col("p")
            last = left.select("row", (F.col("row._whole") + draw.cast("long")).alias("copies"))
            out.append(last.select(F.struct(*fields).alias("row"), "copies"))
            break
        level = left.select(
            "row", "stratum", "size", "p",
            F.floor(F.col("block") / FAN).alias("block"),
            F.ceil(F.col("n_blocks") / F.lit(FAN)).cast("long").alias("n_blocks"),
        )
    whole_out = out[0]
    for part in out[1:]:
        whole_out = whole_out.unionByName(part)
    return whole_out


def mix_copies(documents: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7) -> DataFrame:
    """Per document: id, text_key (64-bit text hash), source, size (words),
    source_size, target, copies (0, 1 or 2).

    Null texts have size 0; documents of size 0 get the whole part of their
    source's copies; sources without words get a target of 0; an empty table
    gives no rows. Null ids and repeated rows are documents of their own.
    Seeded hashes draw, so reruns agree. Other columns are not read.
    """
    renamed, _, new = positional(documents)
    sized = stored(
        renamed.select(
            F.col(new[id_col]).alias("id"),
            F.xxhash64(new[text]).alias("text_key"),
            F.col(new[source]).alias("source"),
            F.coalesce(F.regexp_count(F.col(new[text]), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    targets = stored(source_targets(sized), "mix-targets")
    t = targets.alias("t")
    joined = sized.alias("d").join(t, F.col("d.source").eqNullSafe(F.col("t.source")))
    rows = joined.select(
        F.struct(
            "d.id", "d.text_key", "d.source", "d.size", "t.source_size", "t.target",
            F.xxhash64("d.id", "d.text_key", "d.source").alias("tag"),
        ).alias("row"),
        F.xxhash64(F.col("d.source").isNull(), "d.source").alias("stratum"),
        "t.n_docs",
        "d.size",
        F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0).alias("expected"),
    )
    return pivotal_copies(rows, seed).select(
        F.col("row.id").alias(id_col), "row.text_key", "row.source", "row.size", "row.source_size", "row.target", "copies"
    )


def mix_documents(documents: DataFrame, seed: int = 7) -> DataFrame:
    """`documents` with every row as often as the mix takes it (0, 1 or 2 times). Null texts, sources and
    ids and repeated rows as in `mix_copies`; all columns stay as they are; an empty table stays empty."""
    copies = (
        mix_copies(documents, seed=seed)
        .filter("copies > 0")
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("source").alias("_source"), "copies")
    )
    order = Window.partitionBy("_id", "_key", "_source")
    copies = copies.withColumn("_nth", F.row_number().over(order.orderBy(F.desc("copies"))))
    renamed, columns, new = positional(documents)
    same = Window.partitionBy(new["doc_id"], "_k", new["source"])
    numbered = renamed.withColumn("_k", F.xxhash64(new["text"])).withColumn("_n", F.row_number().over(same.orderBy(F.lit(0))))
    on = (
        F.col(new["doc_id"]).eqNullSafe(F.col("_id"))
        & (F.col("_k") == F.col("_key"))
        & F.col(new["source"]).eqNullSafe(F.col("_source"))
        & (F.col("_n") == F.col("_nth"))
    )
    taken = numbered.join(copies, on)
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*renamed.columns).toDF(*columns)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of `documents`, a row per row; edge cases as in `mix_copies` (null texts have size 0, a null
    source is a source of its own, the last one)."""
    mixed = mix_copies(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
