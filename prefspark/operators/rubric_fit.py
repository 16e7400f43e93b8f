"""Rubric weights from judged pairs: a Bradley-Terry model fitted by aggregated Newton steps (F6).

A pair says that one completion won. The chance that a wins is the two-way softmax of the rubric
logits, sigmoid(w . (f(a) - f(b))), where f are the rubric's feature counts and the scaled length.
The weights maximise the likelihood of the winners under a Gaussian prior around the rubric's own
weights, so a feature that hardly occurs keeps its default and the optimum is unique.

Every step is one aggregate over the pairs (gradient and Hessian, a few dozen sums with map-side
combine); only those sums reach the driver, whatever the number of pairs.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.operators.judge import LENGTH_SCALE, LENGTH_WEIGHT, RUBRIC, rubric_features
from prefspark.operators.ordinal import checked_table

FEATURES = [*RUBRIC, "length"]
DEFAULTS = {**{name: weight for name, (_, weight) in RUBRIC.items()}, "length": LENGTH_WEIGHT}


def pair_differences(pairs: DataFrame, a: str = "completion_a", b: str = "completion_b", winner: str = "winner") -> DataFrame:
    """``(won, <features>)``: 1.0 if a won, and the rubric features of a minus those of b.

    Pairs without a winner (null) take no part; a null completion counts as an empty one.
    """
    def features(col: str) -> dict:
        text = F.coalesce(F.col(col), F.lit(""))
        return {**rubric_features(text), "length": F.length(text) / F.lit(LENGTH_SCALE)}

    fa, fb = features(a), features(b)
    won = (F.col(winner) == 0).cast("double").alias("won")
    return pairs.where(F.col(winner).isNotNull()).select(won, *[(fa[n] - fb[n]).cast("double").alias(n) for n in FEATURES])


def _margin(weights: dict[str, float]):
    total = F.lit(0.0)
    for n in FEATURES:
        total = total + F.lit(float(weights[n])) * F.col(n)
    return total


def pair_loss(differences: DataFrame, weights: dict[str, float]) -> float:
    """Mean negative log likelihood of the winners."""
    z = F.when(F.col("won") == 1.0, _margin(weights)).otherwise(-_margin(weights))
    loss = F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
    return float(differences.agg(F.avg(loss)).first()[0] or 0.0)


def fit_rubric_weights(
    pairs: DataFrame, a: str = "completion_a", b: str = "completion_b", winner: str = "winner",
    strength: float = 1.0, steps: int = 25, tolerance: float = 1e-9,
) -> dict[str, float]:
    """Weights by feature name; ``length`` is that of ``rubric_score(length_weight=...)``.

    ``strength`` is the prior's precision, in pairs. Stops when a step moves no weight by more
    than ``tolerance``; fails if ``steps`` do not suffice. Without pairs the defaults remain.
    """
    if strength <= 0:
        raise ValueError("strength must be positive")
    x, n, _ = checked_table(pair_differences(pairs, a, b, winner))
    prior = np.array([DEFAULTS[f] for f in FEATURES])
    w = prior.copy()
    if not n:
        return dict(DEFAULTS)

    def objective(v: np.ndarray) -> float:
        return n * pair_loss(x, dict(zip(FEATURES, v.tolist()))) + 0.5 * strength * float(((v - prior) ** 2).sum())

    upper = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    here = objective(w)
    for _ in range(steps):
        z = _margin(dict(zip(FEATURES, w.tolist())))
        p = F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))
        staged = x.withColumn("_p", p).withColumns({"_g": F.col("won") - F.col("_p"), "_h": F.col("_p") * (1 - F.col("_p"))})
        sums = staged.agg(*[F.sum(F.col("_g") * F.col(f)) for f in FEATURES],
                          *[F.sum(F.col("_h") * F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in upper]).first()
        gradient = np.array(sums[: len(FEATURES)]) - strength * (w - prior)
        hessian = np.zeros((len(FEATURES), len(FEATURES)))
        for (i, j), v in zip(upper, sums[len(FEATURES):]):
            hessian[i, j] = hessian[j, i] = v
        move = np.linalg.solve(hessian + strength * np.eye(len(FEATURES)), gradient)
        # The objective is convex; a step that overshoots is halved.
        while (there := objective(w + move)) > here + 1e-12 * abs(here) and np.abs(move).max() > tolerance:
            move /= 2
        w, here = w + move, min(here, there)
        if np.abs(move).max() <= tolerance:
            return dict(zip(FEATURES, w.tolist()))
    raise RuntimeError(f"weights did not settle in {steps} steps")
