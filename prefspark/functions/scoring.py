"""Numeric expressions for judge scores and preference losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_probability(logit_yes: Column, logit_no: Column) -> Column:
    """Two-way softmax: probability of the "yes" token."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(logit_no - logit_yes))


def softplus(x: Column) -> Column:
    """ln(1 + e^x) without overflow; -log(sigmoid(x)) is softplus(-x)."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
