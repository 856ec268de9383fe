"""Scans, sinks and loads with fixed schemas.

Appends go through a ledger: a load has an id, is written to a staging folder that readers
skip, and is published by one rename to the folder `load=<id>` of its table. A load that
stopped before the rename leaves nothing in the table and is written anew; one that is
published is not repeated. The published folders are the ledger.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.expressions import nan_to_null
from tallymark.sources.schemas import DEFAULTS, LOAD_ORDER, SCHEMAS, ErpTables


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with a fixed schema; empty fields are NULL, bad rows fail."""
    return spark.read.schema(schema).csv(
        path, header=True, mode="FAILFAST", nullValue="", nanValue="nan"
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[nan_to_null(F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def apply_contract(df: DataFrame, table: str) -> DataFrame:
    """Cast to the table's schema, add absent columns and fill defaults."""
    defaults = DEFAULTS.get(table, {})
    cols: list[Column] = []
    clean = missing_to_null(df)
    for field in SCHEMAS[table].fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        cols.append(value.alias(field.name))
    return clean.select(*cols)


def _located(spark: SparkSession, path: str):
    """A path and its file system."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    located, files = _located(spark, path)
    return files.exists(located)


def _publish(spark: SparkSession, staged: str, final: str) -> None:
    source, files = _located(spark, staged)
    if not files.rename(source, _located(spark, final)[0]):
        raise OSError(f"could not publish {final}")


def published_loads(spark: SparkSession, target: str) -> list[str]:
    """Ids of the loads a table consists of."""
    located, files = _located(spark, target)
    if not files.exists(located):
        return []
    names = [s.getPath().getName() for s in files.listStatus(located)]
    return sorted(n.removeprefix("load=") for n in names if n.startswith("load="))


def append_load(df: DataFrame, table: str, target: str, load_id: str | None = None) -> bool:
    """Append rows to a Parquet table under the table's contract; whether they were
    appended. A load whose id is published already appends nothing; without an id every
    call is a load of its own."""
    spark = df.sparkSession
    load_id = load_id or uuid.uuid4().hex
    final = f"{target}/load={load_id}"
    if _exists(spark, final):
        return False
    staged = f"{target}/_staged/{load_id}"
    apply_contract(df, table).write.mode("overwrite").parquet(staged)
    _publish(spark, staged, final)
    return True


def read_loaded(spark: SparkSession, table: str, target: str) -> DataFrame:
    """The rows of a table's published loads."""
    schema = SCHEMAS[table]
    return spark.read.schema(schema).parquet(target).select(*schema.names)


def source_id(spark: SparkSession, path: str) -> str:
    """Names a source by its path and its files' names, sizes and times: a changed source is
    another load."""
    located, files = _located(spark, path)
    listed = files.listFiles(located, True)
    seen = []
    while listed.hasNext():
        status = listed.next()
        seen.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join([path, *sorted(seen)]).encode()).hexdigest()[:32]


def load_table(spark: SparkSession, source_csv: str, table: str, target: str, load_id: str | None = None) -> int:
    """Append one CSV to its table and return the rows it has there; 0 if absent.
    Without an id the source names the load, so that a rerun appends nothing."""
    if not _exists(spark, source_csv):
        return 0
    load_id = load_id or source_id(spark, source_csv)
    counted = Observation()  # counts while the rows are written
    rows = read_csv(spark, source_csv, SCHEMAS[table]).observe(counted, F.count(F.lit(1)).alias("n"))
    if append_load(rows, table, target, load_id):
        return counted.get["n"]
    return spark.read.schema(SCHEMAS[table]).parquet(f"{target}/load={load_id}").count()


def load_all(spark: SparkSession, source_dir: str, target_dir: str) -> dict[str, int]:
    """Load the six tables, parents first."""
    return {
        t: load_table(spark, f"{source_dir}/{t}.csv", t, f"{target_dir}/{t}") for t in LOAD_ORDER
    }


def open_tables(spark: SparkSession, target_dir: str) -> ErpTables:
    return ErpTables(
        **{t: read_loaded(spark, t, f"{target_dir}/{t}") for t in LOAD_ORDER}
    )


def register_views(tables: ErpTables) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, tables: ErpTables, sql: str, **args) -> DataFrame:
    """SQL over the six tables by name, with named parameters."""
    register_views(tables)
    return spark.sql(sql, args=args or None)
