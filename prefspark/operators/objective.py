"""Offline preference objective over logged sums of log-probabilities.

Formulas from the DPO (Rafailov et al. 2023), IPO (Azar et al. 2023) and XPO
(Xie et al. 2024) papers: z = (policy_chosen - ref_chosen) - (policy_rejected -
ref_rejected); sigmoid loss -log sigmoid(beta z); ipo loss (z - 1/(2 beta))^2;
XPO adds alpha times the policy log-prob of the reference policy's sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.functions.scoring import softplus

LOSS_TYPES = ("sigmoid", "ipo")


def eos_penalty(
    df: DataFrame, completion: str = "completion", score: str = "score", eos: str = "<|im_end|>",
    penalty: float | None = None, out: str | None = None,
) -> DataFrame:
    """Subtract ``penalty`` from the score of a completion that lacks ``eos``; None is off."""
    if penalty is None:
        return df.withColumn(out or score, F.col(score))
    missing = ~F.coalesce(F.col(completion).endswith(F.lit(eos)), F.lit(False))
    return df.withColumn(out or score, F.when(missing, F.col(score) - F.lit(float(penalty))).otherwise(F.col(score)))


def _num(v: float | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def loss_columns(df: DataFrame, beta: float | Column = 0.1, alpha: float | Column = 1e-5,
                 loss_type: str = "sigmoid") -> DataFrame:
    if loss_type not in LOSS_TYPES:
        raise ValueError(f"loss_type must be one of {LOSS_TYPES}")
    b, a = _num(beta), _num(alpha)
    z = (F.col("policy_chosen") - F.col("ref_chosen")) - (F.col("policy_rejected") - F.col("ref_rejected"))
    pref = softplus(-(b * z)) if loss_type == "sigmoid" else (z - F.lit(1.0) / (F.lit(2.0) * b)) ** 2
    return (
        df.withColumn("z", z)
        .withColumn("margin", b * F.col("z"))
        .withColumn("pref_loss", pref)
        .withColumn("loss", F.col("pref_loss") + a * F.col("policy_explore"))
    )


def preference_loss(df: DataFrame, beta: float = 0.1, alpha: float = 1e-5, loss_type: str = "sigmoid") -> DataFrame:
    """Per-pair ``z``, ``margin`` (beta z), ``pref_loss`` and ``loss``."""
    return loss_columns(df, beta, alpha, loss_type)


def per_epoch(values: Sequence[float], epoch: Column) -> Column:
    """One value per epoch; the last one repeats."""
    arr = F.array(*[F.lit(float(v)) for v in values])
    return F.get(arr, F.least(epoch, F.lit(len(values) - 1)))


def loss_report(
    df: DataFrame,
    beta: Sequence[float] = (0.1,),
    alpha: Sequence[float] = (1e-5,),
    loss_type: str = "sigmoid",
    by: Sequence[str] = ("epoch", "step"),
) -> DataFrame:
    """Mean loss, margin and accuracy (z > 0) per step, beta/alpha by epoch."""
    e = F.col("epoch").cast("int")
    scored = loss_columns(df, per_epoch(beta, e), per_epoch(alpha, e), loss_type)
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("loss").alias("mean_loss"),
        F.avg("margin").alias("mean_margin"),
        F.avg(F.when((F.col("z") > 0) & ~F.isnan("z"), 1.0).otherwise(0.0)).alias("accuracy"),
    )
