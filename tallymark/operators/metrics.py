"""Model evaluation as aggregates over distinct scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.ordering import previous_row, running_totals
from tallymark.functions.quantiles import column_quantiles
from tallymark.operators.rules import confusion


def _score_counts(df: DataFrame, label: str, score: str, by: tuple[str, ...]) -> DataFrame:
    y = F.col(label) == 1
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    )


def _ranked(df: DataFrame, label: str, score: str, by: tuple[str, ...], chunks: int | None):
    counts = _score_counts(df, label, score, by)
    run = running_totals(counts, [F.desc("score")], ["pos", "neg"], by, chunks)
    return run.withColumn("upto_pos", F.col("before_pos") + F.col("pos")).withColumn(
        "upto_neg", F.col("before_neg") + F.col("neg")
    )


def roc_auc(
    df: DataFrame, label: str, score: str, by: tuple[str, ...] = (), chunks: int | None = None
) -> DataFrame:
    """Area under the ROC curve per group; equal scores count half."""
    run = _ranked(df, label, score, by, chunks)
    wide = "decimal(38,0)"
    twice = F.col("neg").cast("decimal(18,0)") * (F.col("before_pos") * 2 + F.col("pos")).cast("decimal(19,0)")
    return run.groupBy(*by).agg(
        F.try_divide(
            F.sum(twice.cast(wide)).cast("double"),
            F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double"),
        ).alias("auc")
    )


def roc_points(
    df: DataFrame, label: str, score: str, by: tuple[str, ...] = (), chunks: int | None = None
) -> DataFrame:
    """The corners of the ROC curve: threshold, false and true positive rate.

    The curve starts at (0, 0), which no threshold reaches (NULL), and has a point per
    distinct score, highest first. A point whose step is the same as the next one's lies on
    the line between its neighbours and is left out; the first and last score stay. Steps
    are compared along the global order, also across chunks."""
    run = _ranked(df, label, score, by, chunks)
    steps = previous_row(run, list(by), ["score"], ["pos", "neg"], chunks)  # the row with the next lower score
    first = (F.col("before_pos") == 0) & (F.col("before_neg") == 0)
    bends = F.col("prev").isNull() | (F.col("prev.pos") != F.col("pos")) | (F.col("prev.neg") != F.col("neg"))
    corners = steps.filter(first | bends).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("upto_neg").cast("double"), F.col("total_neg").cast("double")).alias("fpr"),
        F.try_divide(F.col("upto_pos").cast("double"), F.col("total_pos").cast("double")).alias("tpr"),
    )
    origin = run.filter(first).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(corners)


def minmax(df: DataFrame, col: str, factor: float = 1.0):
    """(x - min) / (max - min + 1e-10) * factor as a column over `df`."""
    box = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("b")).scalar()
    unit = (F.col(col) - box["lo"]) / (box["hi"] - box["lo"] + F.lit(1e-10))
    return unit if factor == 1.0 else unit * F.lit(factor)


def minmax_between(col: str, low: float | None, high: float | None):
    """`minmax` where the ends are known; NULL without them."""
    low, high = (F.lit(end).cast("double") for end in (low, high))
    return (F.col(col) - low) / (high - low + F.lit(1e-10))


def above_quantile(df: DataFrame, score: str, p: float, fit_on: DataFrame | None = None):
    """1 where the score exceeds the exact p-quantile, as a column over `df`."""
    source = df if fit_on is None else fit_on
    return over_cut(score, column_quantiles(source, {score: (F.col(score), {"cut": p})})[score]["cut"])


def over_cut(score: str, cut: float | None):
    """1 where the score exceeds `cut`; NULL without one."""
    return (F.col(score) > F.lit(cut).cast("double")).cast("int")


def long_scores(df: DataFrame, label: str, models: dict[str, tuple[str, str]]) -> DataFrame:
    """(model, label, score, flag) rows from one (score, flag) pair per model."""
    entries = [
        F.struct(
            F.lit(name).alias("model"), F.col(s).cast("double").alias("score"), F.col(p).alias("flag")
        )
        for name, (s, p) in models.items()
    ]
    return df.select(F.col(label).alias("label"), F.explode(F.array(*entries)).alias("m")).select(
        "label", "m.*"
    )


def compare_models(df: DataFrame, label: str, models: dict[str, tuple[str, str]]) -> DataFrame:
    """Precision, recall, F1, confusion counts and AUC, one row per model."""
    rows = long_scores(df, label, models)
    parts = [confusion(rows, "label", "flag", ("model",)), roc_auc(rows, "label", "score", ("model",))]
    return reduce(lambda a, b: a.join(b, "model"), parts)
