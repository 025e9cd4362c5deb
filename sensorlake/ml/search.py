"""Hyperparameter search on the chronological split.

Random k-fold would train on the future and score on the past, so the search
reuses the per-sensor train/validation labels: every (regParam,
elasticNetParam) pair is fitted on ``train`` and scored on ``validation``.

A linear fit needs of its rows only the means and (co)variances of features and
target. One aggregation over the training rows gives these, 20 numbers for four
features whatever the number of rows, and every pair is solved from them on the
driver by coordinate descent, with Spark's own objective: population standard
deviations scale features and target, and

    1/2 w'Cw - c'w + reg/sd(y) * (alpha * |w|_1 + (1 - alpha)/2 * |w|^2)

over the correlations C, c. One more aggregation scores all models: the grid's
size adds columns to it, not passes or rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS, TARGET_COLUMN

REG_PARAMS = (0.0, 0.01, 0.1)
ELASTIC_NET_PARAMS = (0.0, 0.5)
_MOST_ROUNDS = 100_000
_SETTLED = 1e-15


@dataclass
class Moments:
    """Number of rows, means and population covariances of features and target (last)."""
    n: int
    mean: np.ndarray
    cov: np.ndarray


def moments(rows: DataFrame, features=tuple(FEATURE_COLUMNS), label: str = TARGET_COLUMN) -> Moments:
    """One aggregation, partial in each task; ``covar_pop`` merges stably."""
    names = [*features, label]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in names], *[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    cov = np.zeros((len(names), len(names)))
    if row[0]:
        for (i, j), value in zip(pairs, row[1 + len(names):]):
            cov[i, j] = cov[j, i] = value
    return Moments(row[0], np.array([x or 0.0 for x in row[1:1 + len(names)]]), cov)


def solve(m: Moments, reg_param: float, elastic_net: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of the elastic-net fit. A constant feature gets
    weight 0, a constant target all weights 0."""
    sd = np.sqrt(np.maximum(np.diag(m.cov), 0.0))
    used = np.flatnonzero(sd[:-1] > 0)
    weights = np.zeros(len(sd) - 1)
    if sd[-1] > 0 and len(used):
        scale = np.where(sd > 0, sd, 1.0)
        corr = m.cov / np.outer(scale, scale)
        lasso, ridge = (reg_param * share / sd[-1] for share in (elastic_net, 1 - elastic_net))
        w = np.zeros(len(sd) - 1)
        for _ in range(_MOST_ROUNDS):
            before = w.copy()
            for j in used:
                pull = corr[j, -1] - corr[j, :-1] @ w + corr[j, j] * w[j]
                w[j] = np.sign(pull) * max(abs(pull) - lasso, 0.0) / (corr[j, j] + ridge)
            if np.abs(w - before).max() <= _SETTLED:
                break
        weights = w * sd[-1] / scale[:-1]
    return weights, float(m.mean[-1] - weights @ m.mean[:-1])


def grid_search(labelled: DataFrame, reg_params=REG_PARAMS, elastic_nets=ELASTIC_NET_PARAMS,
                features=tuple(FEATURE_COLUMNS), label: str = TARGET_COLUMN) -> DataFrame:
    """One row per pair: ``reg_param``, ``elastic_net_param``, ``mse``, ``mae``,
    ``rmse``, ``r2`` on the validation rows (null without any)."""
    fitted = moments(labelled.filter(F.col("split") == "train"), features, label)
    grid = list(product(reg_params, elastic_nets))
    measures = [F.var_pop(label).alias("_var")]
    for i, (reg_param, elastic_net) in enumerate(grid):
        weights, intercept = solve(fitted, reg_param, elastic_net)
        error = F.lit(intercept) - F.col(label)
        for name, weight in zip(features, weights.tolist()):
            error = error + F.col(name) * F.lit(weight)
        measures += [F.avg(error * error).alias(f"_mse{i}"), F.avg(F.abs(error)).alias(f"_mae{i}")]
    one = labelled.filter(F.col("split") == "validation").agg(*measures)
    entries = [F.struct(F.lit(float(r)).alias("reg_param"), F.lit(float(e)).alias("elastic_net_param"),
                        F.col(f"_mse{i}").alias("mse"), F.col(f"_mae{i}").alias("mae"), F.sqrt(f"_mse{i}").alias("rmse"),
                        (F.lit(1.0) - F.try_divide(F.col(f"_mse{i}"), F.col("_var"))).alias("r2"))
               for i, (r, e) in enumerate(grid)]
    return one.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
