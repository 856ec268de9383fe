"""Both detectors and their weighted ensemble."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.ordering import pin
from tallymark.functions.quantiles import column_quantiles
from tallymark.operators import autoencoder, isolation
from tallymark.operators.metrics import minmax_between, over_cut

# model name -> (score column, flag column)
MODELS = {
    "Isolation Forest": ("iso_score", "iso_prediction"),
    "Autoencoder": ("ae_score", "ae_prediction"),
    "Ensemble": ("ensemble_score", "ensemble_prediction"),
}


def score_models(
    scaled: DataFrame,
    forest: isolation.Forest,
    weights: np.ndarray,
    train_filter: str,
    cfg: AuditConfig = DEFAULT,
) -> DataFrame:
    """Scores and flags of both models and the ensemble.

    The forest and ensemble flag the top 5% of all rows; the autoencoder flags
    errors above the 95th percentile of the rows it was trained on. `scaled` is left out of what is
    stored and returned: it follows from the features.
    """
    top = 1 - cfg.contamination
    scored = pin(autoencoder.add_error(isolation.add_score(scaled, forest), weights).drop("scaled"), "scores")
    # four numbers, so that the ensemble is arithmetic over what is stored and needs no copy of it
    ends = scored.agg(*[end(m).alias(f"{end.__name__}_{m}") for m in ("iso_score", "ae_score") for end in (F.min, F.max)]).first()
    combined = scored.withColumn(
        "ensemble_score",
        F.lit(cfg.weight_forest) * minmax_between("iso_score", ends["min_iso_score"], ends["max_iso_score"])
        + F.lit(cfg.weight_autoencoder) * minmax_between("ae_score", ends["min_ae_score"], ends["max_ae_score"]),
    )
    cuts = column_quantiles(
        combined,
        {
            "iso": (F.col("iso_score"), {"cut": top}),
            "ae": (F.when(F.expr(train_filter), F.col("ae_score")), {"cut": top}),
            "ensemble": (F.col("ensemble_score"), {"cut": top}),
        },
    )
    return combined.withColumns({f"{m}_prediction": over_cut(f"{m}_score", cuts[m]["cut"]) for m in cuts})
