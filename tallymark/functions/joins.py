"""Join helpers that keep NULL and hot keys from piling up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_key(key: Column, row_id: Column) -> Column:
    """The key, or a value unique to the row when it is NULL.

    A left join sends every NULL key to the same shuffle partition. NULL never
    matches, so any value absent from the other side gives the same rows while
    spreading them.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id))


def left_lookup(left: DataFrame, right: DataFrame, key: str, row_id: str) -> DataFrame:
    """Left join of a fact table to a table with one row per `key`."""
    keyed = left.withColumn("_key", spread_key(F.col(key), F.col(row_id)))
    return keyed.join(right.withColumnRenamed(key, "_key"), "_key", "left").drop("_key")
