"""Deterministic stand-in models for the registered queries.

They take the place of the user's judge and generator so the Python-worker
paths run over the whole tables and can be checked against SQL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd


def length_scorer():
    """Judge: shorter judge input is better; logit_yes = -chars/100, logit_no = 0."""

    def score(texts: pd.Series) -> pd.DataFrame:
        n = texts.str.len().astype("float64")
        return pd.DataFrame({"logit_yes": -n / 100.0, "logit_no": np.zeros(len(n))})

    return score


def echo_generator():
    """Generator: ``<chars of the rendered input>:<seed>``."""

    def generate(rendered: pd.Series, seeds: pd.Series) -> pd.Series:
        return rendered.str.len().astype("int64").astype(str) + ":" + seeds.astype("int64").astype(str)

    return generate
