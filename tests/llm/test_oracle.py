"""Queries with oracle text give the same in both engines."""

import duckdb
import pytest

from tallymark.llm.registry import ORACLE, QUERIES
from tests.compare import duck, oracle_rows, spark_rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, sf_dir, name):
    con = duck(sf_dir)
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert spark_rows(QUERIES[name](spark, sf_dir)) == oracle_rows(con, ORACLE[name])


def test_items_without_id_match_in_both_engines(spark, tmp_path):
    documents = [(1, "one two three four"), (2, "one two three"), (3, None), (4, "five six"), (5, "no match here")]
    benchmark = [(None, "one two"), (None, "five"), (7, "two three"), (8, None), (None, " ")]
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = spark_rows(QUERIES["op10_decontamination"](spark, str(tmp_path)))
    assert got == oracle_rows(con, ORACLE["op10_decontamination"])
    assert sum(r[0] == "True" for r in got[1]) == 3
