"""Range questions along two orders without pairs.

`prefix_ranks` tells how many values of a group lie below others. `blocks_of_prefix` and
`blocks_of_rank` split the first r places of a group into blocks of 2^k places, at most one a
level; a place lies in one block a level. `count_dominated` uses both: places in one order,
then counts within blocks along the other. All steps run along a global order, so a group
of any size is cut across tasks, and rows grow with the logarithm of a group only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.ordering import running_totals


def prefix_ranks(points: DataFrame, asked: DataFrame, group: list[str], order: list, chunks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both frames with `rank`, the points of the group in front of the row, and `size`, the
    group's points. Both have `group`, the columns of `order` and others under different
    names. An asked row comes before points that are equal to it in `order`."""
    union = points.withColumns({"_point": F.lit(1).cast("bigint")}).unionByName(
        asked.withColumn("_point", F.lit(0).cast("bigint")), allowMissingColumns=True
    )
    ranked = running_totals(union, [*order, "_point"], ["_point"], tuple(group), chunks).withColumnsRenamed(
        {"before__point": "rank", "total__point": "size"}
    )
    own = [*points.columns, "rank", "size"]
    other = [*asked.columns, "rank", "size"]
    return ranked.filter("_point = 1").select(*own), ranked.filter("_point = 0").select(*other)


def blocks_of_rank(rank: Column, size: Column) -> Column:
    """(level, block) of a place on every level with whole blocks."""
    return F.transform(F.sequence(F.lit(0), _top(size)), lambda k: F.struct(k.alias("level"), _shift(rank, k).alias("node")))


def blocks_of_prefix(length: Column) -> Column:
    """(level, block) of the blocks that make up the first `length` places."""
    levels = F.filter(F.sequence(F.lit(0), _top(length)), lambda k: _shift(length, k) % 2 == 1)
    return F.transform(levels, lambda k: F.struct(k.alias("level"), (_shift(length, k) - 1).alias("node")))


def blocks_of_range(low: Column, end: Column) -> Column:
    """(level, block) of blocks whose disjoint union is the places [low, end), two a level at most."""
    levels = F.sequence(F.lit(0), _top(end - low))

    def at(k: Column) -> Column:
        left, right = -_shift(-low, k), _shift(end, k)
        room = left < right
        return F.array_compact(
            F.array(
                F.when(room & (left % 2 == 1), F.struct(k.alias("level"), left.alias("node"))),
                F.when(room & (right % 2 == 1), F.struct(k.alias("level"), (right - 1).alias("node"))),
            )
        )

    return F.flatten(F.transform(levels, at))


def _top(count: Column) -> Column:
    """Highest level with a whole block of `count` places."""
    return F.length(F.bin(F.greatest(count, F.lit(1)).cast("bigint"))) - 1


def _shift(value: Column, times: Column) -> Column:
    """floor(value / 2^times)"""
    return F.call_function("shiftright", value.cast("bigint"), times)


def count_dominated(
    points: DataFrame, asked: DataFrame, group: list[str], first: list, second: str, chunks: int | None = None
) -> DataFrame:
    """Per `id` the signed number of points of the group that are below in both orders.

    `points` has `group`, the columns of `first` and `second`. `asked` has these too and id, sign and
    `all`: a row asks for points in front of it along `first` (all of the group if `all`) whose
    `second` is smaller than its own; answers of an id are added up by sign."""
    placed, wanted = prefix_ranks(points, asked, group, first, chunks)
    at = placed.select(*group, second, F.explode(blocks_of_rank(F.col("rank"), F.col("size"))).alias("at")).select(*group, "at.*", second)
    length = F.when(F.col("all"), F.col("size")).otherwise(F.col("rank"))
    of = (
        wanted.withColumn("length", length).filter("length > 0")
        .select(*group, "id", "sign", second, F.explode(blocks_of_prefix(F.col("length"))).alias("at"))
        .select(*group, "at.*", second, "id", "sign")
    )
    _, answered = prefix_ranks(at, of, [*group, "level", "node"], [second], chunks)
    return answered.groupBy("id").agg(F.sum(F.col("sign") * F.col("rank")).cast("bigint").alias("n"))
