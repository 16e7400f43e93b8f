import numpy as np
import pytest

from prefspark.operators import judge, rubric_fit

PHRASES = {"opener": "Certainly! ", "self_ref": "as an AI ", "hedge": "that said ", "list_line": "\n- x ", "closer": "hope this helps ", "contraction": "it's ", "unsure": "i don't know "}
TRUE = {"opener": -2.0, "self_ref": 0.5, "hedge": 0.0, "list_line": 1.0, "closer": -1.5, "contraction": 1.5, "unsure": -0.5, "length": 2.0}


def _pairs(n, seed):
    rng = np.random.default_rng(seed)

    def text():
        parts = [v for k, v in PHRASES.items() if k != "opener" and rng.random() < 0.4]
        return (PHRASES["opener"] if rng.random() < 0.4 else "") + "".join(parts) + "w " * int(rng.integers(0, 900))

    def logit(t):
        return sum(TRUE[k] * t.count(v.strip() if k != "opener" else "Certainly!") for k, v in PHRASES.items()) + TRUE["length"] * len(t) / 2000

    out = []
    for _ in range(n):
        a, b = text(), text()
        out.append((a, b, int(rng.random() >= 1 / (1 + np.exp(logit(b) - logit(a))))))
    return out


def _exact(x, won, strength=1.0):
    """Plain gradient descent to the optimum, on the rows themselves."""
    prior = np.array([rubric_fit.DEFAULTS[f] for f in rubric_fit.FEATURES])
    w = prior.copy()
    rate = 1.0 / (0.25 * np.linalg.norm(x, 2) ** 2 + strength)
    for _ in range(200_000):
        g = x.T @ (won - 1 / (1 + np.exp(-x @ w))) - strength * (w - prior)
        w = w + rate * g
        if np.abs(g).max() < 1e-9:
            break
    return w


def test_fit_equals_a_plain_solver_and_beats_the_set_weights(spark):
    schema = "completion_a string, completion_b string, winner int"
    train, other = (spark.createDataFrame(_pairs(n, s), schema) for n, s in ((400, 1), (300, 2)))
    weights = rubric_fit.fit_rubric_weights(train.repartition(5))
    rows = rubric_fit.pair_differences(train).collect()
    x = np.array([[r[f] for f in rubric_fit.FEATURES] for r in rows])
    want = _exact(x, np.array([r["won"] for r in rows]))
    assert np.allclose([weights[f] for f in rubric_fit.FEATURES], want, atol=1e-6)
    held = rubric_fit.pair_differences(other)
    assert rubric_fit.pair_loss(held, weights) < rubric_fit.pair_loss(held, rubric_fit.DEFAULTS) - 0.05
    # The fitted weights are those rubric_score takes.
    scored = judge.rubric_score(other.select("completion_a"), "completion_a", {k: v for k, v in weights.items() if k != "length"}, weights["length"])
    assert scored.where("score between 0 and 1").count() == 300


def test_no_pairs_and_odd_rows(spark):
    schema = "completion_a string, completion_b string, winner int"
    assert rubric_fit.fit_rubric_weights(spark.createDataFrame([], schema)) == rubric_fit.DEFAULTS
    odd = spark.createDataFrame([(None, "x", 0), ("a", None, None), ("", "", 1)], schema)
    got = rubric_fit.fit_rubric_weights(odd)
    assert all(abs(got[f] - rubric_fit.DEFAULTS[f]) < 0.1 for f in rubric_fit.FEATURES)
    with pytest.raises(ValueError):
        rubric_fit.fit_rubric_weights(odd, strength=0)
