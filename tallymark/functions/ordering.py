"""Work along a global order (ranks, running totals, previous row) without a
single-task window.

Rows are range-partitioned by the order and written once to the shared
checkpoint folder, so that every later read sees the same partition borders
even if executors are lost. Windows then run per (partition, group), and a
table with one row per partition and group carries the borders. That table
grows with the number of partitions, not with the data.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; an own one only in local mode
    where none is set."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="tallymark-")
    return _own_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return os.path.join(shared_dir(spark), "tallymark", app, f"{label}-{uuid.uuid4().hex}")


def remove_stored(spark: SparkSession) -> None:
    """Delete all that this application has written to the shared folder; results
    that still read from there can't be evaluated afterwards."""
    jvm = spark.sparkContext._jvm
    root = os.path.join(shared_dir(spark), "tallymark", spark.sparkContext.applicationId)
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame, label: str = "pin") -> DataFrame:
    """Write `df` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _sort_exprs(order: list) -> list[Column]:
    return [F.asc(o) if isinstance(o, str) else o for o in order]


def ordered_chunks(df: DataFrame, order: list, chunks: int | None = None) -> DataFrame:
    """Pin `df` with a `chunk` number; all rows of a chunk sort before those of
    the next one. `order` should be a total order, else ties may be cut."""
    exprs = _sort_exprs(order)
    ranged = (
        df.repartitionByRange(chunks, *exprs) if chunks else df.repartitionByRange(*exprs)
    )
    return pin(ranged.withColumn("chunk", F.spark_partition_id()), "ordered")


def _null_safe(left: str, right: str, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return cond


def running_totals(
    df: DataFrame,
    order: list,
    values: list[str],
    group: tuple[str, ...] = (),
    chunks: int | None = None,
) -> DataFrame:
    """Add `before_<v>`, the sum of `v` over all earlier rows of the group, and
    `total_<v>`, its sum over the whole group."""
    group = list(group)
    laid = ordered_chunks(df, [*group, *order], chunks)
    per_chunk = laid.groupBy("chunk", *group).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    of_group = Window.partitionBy(*(group or [F.lit(0)]))
    over_chunks = of_group.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        "chunk",
        *group,
        *[F.coalesce(F.sum(f"_t_{v}").over(over_chunks), F.lit(0)).alias(f"_o_{v}") for v in values],
        *[F.sum(f"_t_{v}").over(of_group).alias(f"total_{v}") for v in values],
    )
    inside = (
        Window.partitionBy("chunk", *group)
        .orderBy(*_sort_exprs(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = laid.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_l_{v}") for v in values]
    )
    joined = local.alias("l").join(
        offsets.alias("o"), _null_safe("l", "o", ["chunk", *group]), "inner"
    )
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        *[(F.col(f"l._l_{v}") + F.col(f"o._o_{v}")).alias(f"before_{v}") for v in values],
        *[F.col(f"o.total_{v}") for v in values],
    )


def global_rank(df: DataFrame, order: list, name: str, chunks: int | None = None) -> DataFrame:
    """Add 1..n along a total order."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], (), chunks)
    return counted.withColumn(name, F.col("before__one") + 1).drop("_one", "before__one", "total__one")


def previous_row(
    df: DataFrame,
    group: list[str],
    order: list[str],
    carry: list[str],
    chunks: int | None = None,
) -> DataFrame:
    """Add struct `prev` with `carry` of the row before, inside `group`.

    A group may span many chunks; its first row in a chunk takes the last row
    of the nearest earlier chunk that holds the group.
    """
    laid = ordered_chunks(df, [*group, *order], chunks)
    packed = F.struct(*carry)
    tails = laid.groupBy("chunk", *group).agg(
        F.max_by(packed, F.struct(*order)).alias("_tail")
    )
    over_chunks = Window.partitionBy(*group).orderBy("chunk")
    borders = tails.select(
        "chunk", *group, F.lag("_tail").over(over_chunks).alias("_border")
    ).filter(F.col("_border").isNotNull())
    inside = Window.partitionBy("chunk", *group).orderBy(*order)
    local = laid.withColumn("_prev", F.lag(packed).over(inside))
    joined = local.alias("l").join(
        borders.alias("b"), _null_safe("l", "b", ["chunk", *group]), "left"
    )
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        F.coalesce(F.col("l._prev"), F.col("b._border")).alias("prev"),
    )
