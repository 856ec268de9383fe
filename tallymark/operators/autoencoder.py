"""Autoencoder 10-16-8-3-8-16-10, trained data-parallel by averaging
(Zinkevich et al. 2010).

One Spark job per epoch: every partition trains its own copy of the weights on
its rows, batch by batch, and the copies are averaged by row count in a grouped
sum. The driver holds one weight vector (685 numbers and the optimiser's two
moments), whatever the data size. Validation rows are chosen by key hash; their
loss decides early stopping, and the best weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.config import DEFAULT, AuditConfig
from tallymark.functions.ordering import pin
from tallymark.operators.isolation import feature_cols, hash_unit

# Layer sizes and training parameters.
SIZES = (10, 16, 8, 3, 8, 16, 10)
DROPOUT, RATE, BATCH = 0.1, 1e-3, 64
EPOCHS, PATIENCE, VALIDATION = 50, 5, 0.15
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-7

SHAPES = [((a, b), (b,)) for a, b in zip(SIZES, SIZES[1:])]
N_WEIGHTS = sum(a * b + b for a, b in zip(SIZES, SIZES[1:]))


@dataclass(frozen=True)
class Fitted:
    weights: np.ndarray
    history: tuple[tuple[int, float, float], ...]  # epoch, training loss, validation loss
    best_epoch: int


def _layers(flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for (a, b), _ in SHAPES:
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def initial_weights(seed: int) -> np.ndarray:
    """Glorot-uniform kernels and zero biases."""
    rng = np.random.default_rng(seed)
    parts = []
    for (a, b), _ in SHAPES:
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def reconstruct(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    layers = _layers(flat)
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0.0)
    w, b = layers[-1]
    return x @ w + b


def row_error(flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.mean((x - reconstruct(flat, x)) ** 2, axis=1)


def _gradient(flat: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Gradient of the mean squared error, with dropout after the first layer."""
    layers = _layers(flat)
    acts, mask = [x], None
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        if i < len(layers) - 1:
            z = np.maximum(z, 0.0)
        if i == 0:
            mask = (rng.random(z.shape) >= DROPOUT) / (1.0 - DROPOUT)
            z = z * mask
        acts.append(z)
    gap = acts[-1] - x
    delta = 2.0 * gap / gap.size
    grads: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        grads = [(acts[i].T @ delta).ravel(), delta.sum(axis=0), *grads]
        if i:
            delta = (delta @ w.T) * (acts[i] > 0)
            if i == 1:
                delta = delta * mask
    return np.concatenate(grads), float(np.mean(gap**2))


class _Worker:
    """Adam on one copy's rows, starting from the shared state."""

    def __init__(self, state: np.ndarray, step: int, seed: tuple[int, ...]):
        self.w, self.m, self.v = (p.copy() for p in np.split(state, 3))
        self.step, self.rng = step, np.random.default_rng(seed)
        self.rows = self.loss = 0.0

    def learn(self, x: np.ndarray) -> None:
        x = x[self.rng.permutation(len(x))]
        for i in range(0, len(x), BATCH):
            part = x[i : i + BATCH]
            g, loss = _gradient(self.w, part, self.rng)
            self.step += 1
            self.m = BETA1 * self.m + (1 - BETA1) * g
            self.v = BETA2 * self.v + (1 - BETA2) * g * g
            fast = self.m / (1 - BETA1**self.step)
            scale = np.sqrt(self.v / (1 - BETA2**self.step)) + EPSILON
            self.w = self.w - RATE * fast / scale
            self.rows += len(part)
            self.loss += loss * len(part)

    def sums(self) -> np.ndarray:
        return np.concatenate([self.w, self.m, self.v]) * self.rows


def _epoch(data: DataFrame, state: np.ndarray, step: int, epoch: int, seed: int) -> np.ndarray:
    """Sums over all copies: weighted state, then rows, loss, validation
    loss at the incoming weights, validation rows, steps."""

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for number, flat, flags in zip(batch["worker"], batch["x"], batch["held"]):
                x, held = np.reshape(flat, (-1, SIZES[0])), np.asarray(flags, dtype=bool)
                worker = _Worker(state, step, (seed, epoch, int(number)))
                val_loss = row_error(np.split(state, 3)[0], x[held]).sum() if held.any() else 0.0
                worker.learn(x[~held])
                tail = [worker.rows, worker.loss, val_loss, int(held.sum()), (worker.step - step) * worker.rows]
                values = np.concatenate([worker.sums(), tail])
                total = values if total is None else total + values
        if total is not None:
            yield pd.DataFrame({"pos": np.arange(len(total), dtype=np.int32), "value": total})

    sums = data.mapInPandas(train, "pos int, value double").groupBy("pos").agg(F.sum("value").alias("value"))
    out = np.zeros(3 * N_WEIGHTS + 5)
    for row in sums.collect():  # one row per position, a fixed number
        out[row["pos"]] = row["value"]
    return out


def fit(scaled: DataFrame, key: str = "invoice_number", cfg: AuditConfig = DEFAULT) -> Fitted:
    """Train on the given rows (the caller filters them)."""
    seed = cfg.seed
    rows = scaled.select(
        "scaled",
        F.xxhash64(F.col(key), F.lit(seed)).alias("h"),
        (hash_unit(F.col(key), F.lit(seed + 1)) < VALIDATION).alias("held"),
    )
    # One stored row per model copy holds its training rows in the order of their
    # hash, so what a copy sees depends on keys alone and no epoch shuffles. A
    # copy gets about `rows_per_worker` rows, and copies grow with the data.
    workers = max(1, -(-rows.count() // cfg.rows_per_worker))
    # The rows are dealt first and each copy's are put together where they lie: lists that are
    # begun before the shuffle spill once a task sees many copies.
    dealt = rows.withColumn("worker", F.pmod(F.xxhash64("h"), F.lit(workers))).repartitionByRange(min(workers, 10_000), "worker")
    items = F.sort_array(F.collect_list(F.struct("h", "scaled", "held")))
    packed = dealt.groupBy("worker").agg(items.alias("i")).select(
        "worker", F.flatten(F.col("i.scaled")).alias("x"), F.col("i.held").alias("held")
    )
    data = pin(packed, "ae-train")
    state = np.concatenate([initial_weights(seed), np.zeros(2 * N_WEIGHTS)])
    best, best_loss, best_epoch = state, np.inf, 0
    history: list[tuple[int, float, float]] = []
    step, waited, train_loss = 0, 0, None
    for epoch in range(1, EPOCHS + 2):
        sums = _epoch(data, state, step, epoch, seed)
        n, loss, val_loss, val_rows, steps = sums[-5:]
        measured = val_loss / max(val_rows, 1)
        if epoch > 1:  # the incoming weights are those after epoch - 1
            history.append((epoch - 1, train_loss, float(measured)))
            if measured < best_loss:
                best, best_loss, best_epoch, waited = state, measured, epoch - 1, 0
            else:
                waited += 1
            if waited >= PATIENCE:
                break
        state = sums[:-5] / max(n, 1.0)
        train_loss = float(loss / max(n, 1.0))
        step += int(round(steps / max(n, 1.0)))
    return Fitted(np.split(best, 3)[0], tuple(history), best_epoch)


def add_error(scaled: DataFrame, weights: np.ndarray, name: str = "ae_score") -> DataFrame:
    """Mean squared reconstruction error per row."""

    @F.pandas_udf("double")
    def error(*cols: pd.Series) -> pd.Series:
        return pd.Series(row_error(weights, np.column_stack(cols)))

    return scaled.withColumn(name, error(*feature_cols()))


def history_frame(like: DataFrame, fitted: Fitted) -> DataFrame:
    """Loss per epoch; at most `EPOCHS` rows."""
    rows = [(e, t, v, e == fitted.best_epoch) for e, t, v in fitted.history]
    return like.sparkSession.createDataFrame(rows, "epoch int, loss double, val_loss double, is_best boolean")
