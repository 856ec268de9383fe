import os
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymark.functions import ordering
from tallymark.functions.quantiles import exact_quantiles, histogram


@pytest.fixture(scope="module")
def hot(spark):
    """One group holds most rows and many equal values."""
    rnd = random.Random(5)
    rows = [(i, "hot" if rnd.random() < 0.7 else f"g{rnd.randint(0, 30)}", rnd.randint(0, 40)) for i in range(3000)]
    return spark.createDataFrame(rows, "id long, grp string, v long").repartition(8).cache()


@pytest.mark.parametrize("chunks", [None, 1, 7])
def test_global_rank(hot, chunks):
    got = ordering.global_rank(hot, [F.desc("v"), F.asc("id")], "rank", chunks)
    expected = hot.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("v"), "id")).cast("long"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("chunks", [None, 9])
def test_previous_row_crosses_chunks(hot, chunks):
    got = ordering.previous_row(hot, ["grp"], ["v", "id"], ["id", "v"], chunks)
    w = Window.partitionBy("grp").orderBy("v", "id")
    expected = hot.withColumn("prev", F.lag(F.struct("id", "v")).over(w))
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_running_totals_per_group_with_null_group(spark):
    rows = [(None if i % 5 == 0 else "ab"[i % 2], i, i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = ordering.running_totals(df, ["o"], ["v"], ("g",), 6)
    w = Window.partitionBy("g")
    before = w.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    expected = df.select(
        "*", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("b"), F.sum("v").over(w).alias("t")
    )
    assert got.exceptAll(expected).count() == 0 and got.count() == 200


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=501), np.repeat([1.0, 2.0], [90, 10])
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("one", 4.0), ("one", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = {"p25": 0.25, "p50": 0.5, "p95": 0.95}
    got = {r["g"]: r for r in exact_quantiles(df, "x", probs, ("g",), 5).collect()}
    for g, values in (("a", a), ("b", b), ("one", np.array([4.0]))):
        assert got[g]["n"] == len(values)
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-12)
    whole = exact_quantiles(df, "x", probs).first()
    assert whole["p95"] == pytest.approx(np.percentile(np.concatenate([a, b, [4.0]]), 95))


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_quantiles_from_narrow_brackets(spark, monkeypatch, accuracy):
    """Coarse and fine sketches leave few values to order and give the same, also with ties."""
    from tallymark.functions import quantiles

    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = np.random.default_rng(accuracy)
    groups = {"n": rng.normal(size=20_001), "t": rng.integers(0, 40, 15_000) / 4.0, "s": rng.normal(size=7), "two": np.array([1.0, 9.0])}
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v], "g string, x double")
    probs = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, "x", probs, ("g",)).collect()}
    for g, values in groups.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-12), (g, name)


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 5, 9.9, 10)], "x double")
    got = {r["bin"]: r["n"] for r in histogram(df, "x", 5).collect()}
    counts, _ = np.histogram([0, 1, 5, 9.9, 10], bins=5)
    assert got == {i: int(n) for i, n in enumerate(counts) if n}


def test_pins_go_to_the_configured_folder(spark, hot):
    folder = spark.conf.get("spark.checkpoint.dir")
    pinned = ordering.pin(hot, "probe")
    assert pinned.inputFiles() and all(folder in f for f in pinned.inputFiles())
    assert os.path.isdir(folder)


def test_a_hot_group_is_cut_across_chunks(hot):
    laid = ordering.ordered_chunks(hot, ["grp", "v", "id"], 8)
    sizes = [r["count"] for r in laid.filter("grp = 'hot'").groupBy("chunk").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 3000 / 4
