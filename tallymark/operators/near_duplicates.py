"""Near-duplicate invoices: same vendor, at most 30 elapsed days apart, other
reference, amounts within 2% of the earlier one but not equal.

The result has one row per flagged invoice, with a chosen partner and, if asked for, the
number of its partners; pairs are never listed. Partners of an invoice lie in its own 31-day
slot and in the slot before.

Where a vendor has few postings in both slots, as nearly everywhere, they are held against each
other as they are: one shuffle of the rows, each compared with at most twice `SLOT_ROWS` others.

Crowded slots of any size go by cells and ranks. Copies of one posting (vendor, reference,
amount, slot) are first folded into one *cell*; they never match each other, and
cells of other postings match them alike. For a cell it is enough to know the earliest
matching posting in its own slot and the latest one in the slot before.

Cells of a vendor and slot are dealt to buckets of slightly over 2% of the amount, so an
amount range lies in three buckets. Only buckets that hold another amount in range and
another reference are asked. In them amounts count by their rank: postings are kept per block
of 2^k ranks, and a range is made up of at most two blocks a level. A bucket of one amount has
one block; rows grow with the logarithm of a bucket's distinct amounts, however close
together the postings of a vendor lie. Partners are counted along time and amount at once
(`functions.dominance`), less those of equal reference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.dominance import blocks_of_range, blocks_of_rank, count_dominated, prefix_ranks
from tallymark.functions.expressions import MICROS_PER_DAY, micros
from tallymark.functions.ordering import pin

CELL = ["vendor_id", "ref", "cents", "slot"]
#: Where postings are looked up: a vendor's bucket of amounts in a slot.
PLACE = ["vendor_id", "g_slot", "bucket"]
#: A vendor's slot with more postings is crowded: its postings are looked up by rank.
SLOT_ROWS = 256


def _slot_micros(cfg: AuditConfig) -> int:
    """Two rows of one slot are at most `dup_date_window_days` whole days apart."""
    return (cfg.dup_date_window_days + 1) * MICROS_PER_DAY


def _rows(invoices: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Rows that can match at all. A NULL reference equals no other one."""
    t = micros(F.col("invoice_date"))
    return invoices.filter(
        F.col("vendor_id").isNotNull() & (F.col("invoice_amount") > 0) & F.col("invoice_date").isNotNull()
    ).select(
        "vendor_id",
        F.coalesce("vendor_invoice_number", F.concat(F.lit("\u0000"), "invoice_number")).alias("ref"),
        (F.col("invoice_amount") * 100).cast("bigint").alias("cents"),
        F.floor(t.cast("double") / F.lit(float(_slot_micros(cfg)))).cast("bigint").alias("slot"),
        t.alias("t"),
        F.col("invoice_number").alias("num"),
    )


def _cells(rows: DataFrame, cfg: AuditConfig) -> DataFrame:
    post = F.struct("t", "num")
    return (
        rows.groupBy(*CELL, "by_rank")
        .agg(F.min(post).alias("first"), F.max(post).alias("last"))
    )


def _amount(cents: str) -> Column:
    return (F.col(cents).cast("decimal(17,2)") / 100).cast("decimal(15,2)")


def _days(span: Column) -> Column:
    return F.floor(span.cast("double") / F.lit(float(MICROS_PER_DAY))).cast("int")


def _bucket(cents: Column, cfg: AuditConfig) -> Column:
    """Buckets are wider than the tolerance, so a range around an amount lies in the
    amount's own bucket and the two beside it, also where logarithms round at a border."""
    width = -math.log(1 - float(cfg.dup_amount_tolerance)) * 1.05
    return F.floor(F.ln(cents.cast("double")) / F.lit(width)).cast("bigint")


def _ends(cents: Column, cfg: AuditConfig) -> tuple[Column, Column]:
    """Partners' amounts lie in [low, end)."""
    # later = (1 +- tolerance) * earlier, so earlier lies in later / (1 +- tolerance)
    cents, one = cents.cast("decimal(20,0)"), 1
    low = F.ceil(cents / F.lit(one + cfg.dup_amount_tolerance)).cast("bigint")
    return low, F.floor(cents / F.lit(one - cfg.dup_amount_tolerance)).cast("bigint") + 1


def _asked(cells: DataFrame, cfg: AuditConfig) -> DataFrame:
    """(cell as j_*, place, back, the ranges [low, cents) and [cents + 1, end)): a cell marked
    `by_rank` and a place in its own slot or the one before (`back` = 1) that may hold partners."""
    places = cells.groupBy("vendor_id", F.col("slot").alias("g_slot"), "bucket").agg(
        F.min("cents").alias("least"), F.max("cents").alias("most"), F.min("ref").alias("ref_1"), F.max("ref").alias("ref_2")
    )
    near = F.array(*[F.struct(F.lit(b).alias("back"), F.lit(d).alias("by")) for b in (0, 1) for d in (-1, 0, 1)])
    low, end = _ends(F.col("cents"), cfg)
    looking = cells.filter("by_rank").select(
        "vendor_id", *[F.col(c).alias(f"j_{c}") for c in ("ref", "cents", "slot")],
        low.alias("low"), end.alias("end"), "bucket", F.explode(near).alias("near"),
    ).select(
        "*", (F.col("j_slot") - F.col("near.back")).alias("g_slot"), F.col("near.back").alias("back"),
    ).withColumn("bucket", F.col("bucket") + F.col("near.by")).drop("near")
    in_range = (F.col("least") < F.col("end")) & (F.col("most") >= F.col("low"))
    other_amount = (F.col("least") != F.col("j_cents")) | (F.col("most") != F.col("j_cents"))
    other_ref = (F.col("ref_1") != F.col("j_ref")) | (F.col("ref_2") != F.col("j_ref"))
    return looking.join(places, PLACE).filter(in_range & other_amount & other_ref).drop("least", "most", "ref_1", "ref_2")


def _ranges() -> Column:
    own = F.col("j_cents")
    return F.array(F.struct(F.col("low").alias("from"), own.alias("to")), F.struct((own + 1).alias("from"), F.col("end").alias("to")))


def _matches(cells: DataFrame, asked: DataFrame) -> DataFrame:
    """Per later cell the earliest match in its slot and the latest in the slot before.

    Two postings with different references suffice per block of ranks: whatever the
    asking reference is, one of them differs from it.
    """
    held = cells.withColumnRenamed("slot", "g_slot").join(asked.select(*PLACE).distinct(), PLACE, "left_semi")
    amounts = held.select(*PLACE, F.col("cents").alias("value")).distinct()
    asking = ["j_ref", "j_cents", "j_slot", "back", "part", "end_of"]
    borders = asked.select("*", F.posexplode(_ranges()).alias("part", "range")).select(
        *PLACE, "j_ref", "j_cents", "j_slot", "back", "part", F.explode(F.array(*[F.struct(F.lit(i).alias("end_of"), F.col(f"range.{c}").alias("value")) for i, c in enumerate(("from", "to"))])).alias("at"),
    ).select(*PLACE, *asking[:-1], "at.*")
    ranked, placed = prefix_ranks(amounts, borders, PLACE, ["value"])
    blocks = ranked.withColumnRenamed("value", "cents").join(held, [*PLACE, "cents"]).select(
        *PLACE, F.explode(blocks_of_rank(F.col("rank"), F.col("size"))).alias("at"), "ref", "cents",
        F.struct("first.t", "first.num", "cents").alias("lo"), F.struct("last.t", "last.num", "cents").alias("hi"),
    ).select(*PLACE, "at.*", "ref", "lo", "hi")
    node = [*PLACE, "level", "node"]
    ends = pin(blocks.groupBy(*node, "ref").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "blocks")
    first, last = F.struct("lo", "ref"), F.struct("hi", "ref")
    best = ends.groupBy(*node).agg(F.min(first).alias("lo_1"), F.max(last).alias("hi_1"))
    others = ends.join(best, node).groupBy(*node, "lo_1", "hi_1").agg(
        F.min(F.when(F.col("ref") != F.col("lo_1.ref"), first)).alias("lo_2"),
        F.max(F.when(F.col("ref") != F.col("hi_1.ref"), last)).alias("hi_2"),
    )
    spans = placed.groupBy(*PLACE, *asking[:-1]).agg(
        F.min(F.when(F.col("end_of") == 0, F.col("rank"))).alias("low"), F.min(F.when(F.col("end_of") == 1, F.col("rank"))).alias("to")
    ).filter("low < to")
    sought = spans.select(*PLACE, "j_ref", "j_cents", "j_slot", "back", F.explode(blocks_of_range(F.col("low"), F.col("to"))).alias("at")).select(
        *PLACE, "j_ref", "j_cents", "j_slot", "back", "at.*"
    )
    found = sought.join(others, node)

    def other(side: str) -> Column:
        return F.when(F.col(f"{side}_1.ref") != F.col("j_ref"), F.col(f"{side}_1.{side}")).otherwise(F.col(f"{side}_2.{side}"))

    return found.groupBy(F.col("vendor_id").alias("j_vendor_id"), "j_ref", "j_cents", "j_slot").agg(
        F.min(F.when(F.col("back") == 0, other("lo"))).alias("own"),
        F.max(F.when(F.col("back") == 1, other("hi"))).alias("before"),
    )


def _partner_counts(rows: DataFrame, flagged: DataFrame, asked: DataFrame, cfg: AuditConfig) -> DataFrame:
    """(id, n): earlier invoices that match a flagged one. Along time those in front of it
    in its own slot, and in the slot before all less those over 30 days back; along the
    amount those below the end of a range less those below its beginning; all that less
    the ones with the invoice's own reference."""
    places = asked.select(*PLACE).distinct()
    of = rows.withColumn("g_slot", F.col("slot")).withColumn("bucket", _bucket(F.col("cents"), cfg)).join(places, PLACE, "left_semi")
    everyone = F.array(F.lit(""), F.concat(F.lit("="), F.col("ref")))
    points = of.select(*PLACE, F.explode(everyone).alias("of_ref"), "t", "num", F.col("cents").alias("value"))
    cell = ["vendor_id", "j_ref", "j_cents", "j_slot"]
    flagged = flagged.select(
        "vendor_id", *[F.col(c).alias(f"j_{c}") for c in ("ref", "cents", "slot")], F.col("t").alias("f_t"), F.col("num").alias("f_num")
    )
    terms = []
    for ref_sign, of_ref in ((1, F.lit("")), (-1, F.concat(F.lit("="), F.col("j_ref")))):
        for end, end_sign in (("to", 1), ("from", -1)):
            for back, all_of, sign in ((0, False, 1), (1, True, 1), (1, False, -1)):
                terms.append(
                    F.struct(F.lit(back).alias("when_back"), of_ref.alias("of_ref"), F.col(f"range.{end}").alias("value"), F.lit(all_of).alias("all"), F.lit(ref_sign * end_sign * sign).alias("sign"))
                )
    asking = (
        flagged.join(asked.withColumn("range", F.explode(_ranges())), cell)
        .select(*PLACE, "back", "f_t", "f_num", F.explode(F.array(*terms)).alias("term"))
        .filter("term.when_back = back")
    )
    # Far ago comes behind the last posting of that instant, a posting in front of itself.
    queries = asking.select(
        *PLACE, "term.of_ref", F.when(F.col("back") == 0, F.col("f_t")).otherwise(F.col("f_t") - F.lit(_slot_micros(cfg))).alias("t"),
        F.when(F.col("back") == 0, F.col("f_num")).alias("num"), "term.value", "term.all", "term.sign", F.col("f_num").alias("id"),
    )
    return count_dominated(points, queries, [*PLACE, "of_ref"], ["t", F.asc_nulls_last("num")], "value")


def _crowding(rows: DataFrame, slot_rows: int) -> DataFrame:
    """(vendor_id, slot, crowded, by_rank) of crowded slots and those beside them. Postings of a
    crowded slot and of the one after it are looked up by rank (`by_rank`)."""
    crowded = rows.groupBy("vendor_id", "slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > slot_rows)
    beside = crowded.select("vendor_id", "slot", F.explode(F.array(*[F.lit(by) for by in (-1, 0, 1)])).alias("by"))
    return beside.groupBy("vendor_id", (F.col("slot") + F.col("by")).alias("slot")).agg(
        F.max(F.col("by") == 0).alias("crowded"), F.max(F.col("by") >= 0).alias("by_rank")
    )


def _small_slots(rows: DataFrame, cfg: AuditConfig) -> DataFrame:
    """Flagged postings (vendor_id, cents, t, num, partner, n), n their partners, whose own slot and
    the one before are not crowded. `rows` of a vendor are `SLOT_ROWS` a slot at most."""
    posting = F.struct("t", "num", "cents", "ref")
    slots = rows.repartition("vendor_id").groupBy("vendor_id", "slot", "by_rank").agg(F.collect_list(posting).alias("own"))
    along = Window.partitionBy("vendor_id").orderBy("slot")
    follows = F.lag("slot").over(along) == F.col("slot") - 1
    asking = slots.withColumn("before", F.when(follows, F.lag("own").over(along))).filter(~F.col("by_rank")).select(
        "vendor_id", "own", F.coalesce("before", F.array().cast(slots.schema["own"].dataType)).alias("before"),
        F.explode("own").alias("at"),
    ).select("*", "at.*", *[x.alias(c) for c, x in zip(("low", "end"), _ends(F.col("at.cents"), cfg))])

    def matches(p: Column) -> Column:
        return (p.cents >= F.col("low")) & (p.cents < F.col("end")) & (p.cents != F.col("cents")) & (p.ref != F.col("ref"))

    def earlier(p: Column) -> Column:
        return (p.t < F.col("t")) | ((p.t == F.col("t")) & F.coalesce(p.num < F.col("num"), p.num.isNotNull()))

    def bare(p: Column) -> Column:
        return F.struct(p.t.alias("t"), p.num.alias("num"), p.cents.alias("cents"))

    found = asking.select(
        "vendor_id", "cents", "t", "num", F.filter("own", matches).alias("own"),
        F.filter("before", lambda p: matches(p) & (F.col("t") - p.t < F.lit(_slot_micros(cfg)))).alias("before"),
    )
    return found.select(
        "vendor_id", "cents", "t", "num",
        _partner(F.array_min(F.transform("own", bare)), F.array_max(F.transform("before", bare)), cfg).alias("partner"),
        (F.size(F.filter("own", earlier)) + F.size("before")).cast("bigint").alias("n"),
    ).filter(F.col("partner").isNotNull())


def _partner(own: Column, before: Column, cfg: AuditConfig) -> Column:
    """The earliest match in a posting's own slot if it is earlier than the posting, else the
    latest one of the slot before if it is near enough."""
    own_ok = own.isNotNull() & (F.struct(own["t"], own["num"]) < F.struct("t", "num"))
    before_ok = F.col("t") - before["t"] < F.lit(_slot_micros(cfg))
    return F.when(own_ok, own).when(before_ok, before)


def _by_rank(held: DataFrame, cfg: AuditConfig) -> tuple[DataFrame, DataFrame]:
    """Flagged postings (vendor_id, ref, cents, slot, t, num, partner) among those marked `by_rank`, and what was asked."""
    cells = pin(_cells(held, cfg).withColumn("bucket", _bucket(F.col("cents"), cfg)), "cells")
    asked = pin(_asked(cells, cfg), "asked")
    found = _matches(cells.drop("by_rank"), asked).withColumnsRenamed({f"j_{c}": c for c in CELL})
    placed = held.select(*CELL, "t", "num").join(found, CELL)
    hits = placed.withColumn("partner", _partner(F.col("own"), F.col("before"), cfg)).filter(F.col("partner").isNotNull())
    return hits.drop("own", "before"), asked


def near_duplicates(
    invoices: DataFrame, cfg: AuditConfig = DEFAULT, counted: bool = False, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """One row per flagged invoice with one partner: the earliest match in the
    invoice's own 31-day slot, else the latest one of the slot before. With `counted` also
    n_partners, the number of earlier invoices that match it. Slots of more than `slot_rows`
    postings are looked up by rank."""
    rows = _rows(invoices, cfg)
    crowding = pin(_crowding(rows, slot_rows), "crowding")
    marked = rows.join(crowding, ["vendor_id", "slot"], "left")
    small = _small_slots(
        marked.filter(F.coalesce(~F.col("crowded"), F.lit(True))).withColumn("by_rank", F.coalesce("by_rank", F.lit(False))), cfg
    )
    shown = [
        F.col("num").alias("invoice_number"),
        F.col("partner.num").alias("matched_invoice"),
        F.col("vendor_id"),
        _amount("cents").alias("invoice_amount"),
        _amount("partner.cents").alias("matched_amount"),
        _days(F.col("t") - F.col("partner.t")).alias("days_apart"),
    ]
    flagged = ["vendor_id", "cents", "t", "num", "partner"]
    kept = pin(small, "flagged") if counted else small
    hits, counts = kept.select(*flagged), kept.select("num", "n") if counted else None
    if not crowding.isEmpty():
        held = marked.filter(F.col("crowded").isNotNull())
        by_rank, asked = _by_rank(held, cfg)
        by_rank = pin(by_rank, "flagged") if counted else by_rank
        hits = hits.unionByName(by_rank.select(*flagged))
        if counted:
            counts = counts.unionByName(_partner_counts(held, by_rank, asked, cfg).withColumnRenamed("id", "num"))
    if not counted:
        return hits.select(*shown)
    partners = counts.groupBy("num").agg(F.sum("n").alias("n_partners"))
    return hits.join(partners, "num").select(*shown, "n_partners")


def pair_totals(counted: DataFrame) -> DataFrame:
    """One row: flagged invoices, and pairs of an invoice and an earlier match."""
    return counted.agg(F.count(F.lit(1)).alias("n_invoices"), F.coalesce(F.sum("n_partners"), F.lit(0)).cast("bigint").alias("n_pairs"))
