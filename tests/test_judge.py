import math

import numpy as np
import pandas as pd
import pytest

from prefspark.operators import judge
from prefspark.types import MESSAGES


def test_judge_query_forms(spark):
    cases = [
        [{"role": "assistant", "content": "a"}, {"role": "user", "content": "u1"}, {"role": "user", "content": "u2"}],
        [{"role": "system", "content": "s"}, {"role": "assistant", "content": "a"}],
        [],
        [{"role": "user", "content": None}],
    ]
    df = spark.createDataFrame(list(enumerate(cases)), f"id long, prompt {MESSAGES.simpleString()}")
    got = [r.query for r in judge.judge_query(df).orderBy("id").collect()]
    assert got == ["u1", "s", "[]", ""]
    last = [r.query for r in judge.judge_query(df, turn="last").orderBy("id").collect()]
    assert last[0] == "u2" and last[1] == "s" and last[2] == "[]"
    s = spark.createDataFrame([(0, "plain")], "id long, prompt string")
    assert judge.judge_query(s).first().query == "plain"


def test_truncate_keeps_first_tokens_and_text(spark):
    df = spark.createDataFrame([(0, "  one two\tthree  four "), (1, "short")], "id long, t string")
    out = judge.truncate_input(df, "t", max_length=4, prefix="P: ", suffix=" :S", out="o").orderBy("id").collect()
    assert out[0].o == "P:   one two\t :S"
    assert out[1].o == "P: short :S"
    with pytest.raises(ValueError):
        judge.truncate_input(df, "t", max_length=2, prefix="a b", suffix="")


def test_truncate_with_tokenizer(spark):
    df = spark.createDataFrame([(0, "abcdef")], "id long, t string")
    out = judge.truncate_input(df, "t", max_length=3, tokenizer=lambda s: [s[i:i + 2] for i in range(0, len(s), 2)])
    assert out.first().t == "abcdef"
    out = judge.truncate_input(df, "t", max_length=2, tokenizer=lambda s: [s[i:i + 2] for i in range(0, len(s), 2)])
    assert out.first().t == "abcd"


def test_yes_probability_extremes(spark):
    df = spark.createDataFrame([(0.0, 0.0), (800.0, 0.0), (0.0, 800.0), (1.0, 0.0)], "logit_yes double, logit_no double")
    got = [r.score for r in judge.judge_score(df).collect()]
    assert got[0] == 0.5 and got[1] == 1.0 and got[2] == 0.0
    assert abs(got[3] - 1 / (1 + math.exp(-1))) < 1e-12


def test_pick_winner_python_rules(spark):
    nan = float("nan")
    rows = [(1.0, 1.0), (2.0, 1.0), (1.0, 2.0), (nan, 1.0), (1.0, nan), (nan, nan)]
    df = spark.createDataFrame(rows, "score_a double, score_b double")
    assert [r.winner for r in judge.pick_winner(df).collect()] == [0, 0, 1, 1, 1, 1]
    ints = spark.createDataFrame([(1, 0), (0, 1), (1, 1)], "score_a int, score_b int")
    assert [r.winner for r in judge.pick_winner(ints).collect()] == [0, 1, 0]
    with pytest.raises(Exception, match="null score"):
        judge.pick_winner(spark.createDataFrame([(None, 1.0)], "score_a double, score_b double")).collect()


def test_pair_completions_strict(spark):
    p = spark.createDataFrame([(1, "p1"), (2, "p2")], "pair_id long, prompt string")
    a = spark.createDataFrame([(1, "a1"), (2, "a2")], "pair_id long, completion string")
    b = spark.createDataFrame([(1, "b1"), (2, "b2")], "pair_id long, completion string")
    rows = judge.pair_completions(p, a, b).orderBy("pair_id").collect()
    assert [(r.prompt, r.completion_a, r.completion_b) for r in rows] == [("p1", "a1", "b1"), ("p2", "a2", "b2")]
    short = b.filter("pair_id = 1")
    with pytest.raises(Exception, match="exactly one prompt"):
        judge.pair_completions(p, a, short).collect()


def test_rubric_features(spark):
    t = "Certainly! As an AI, it's important to note:\n1. one\n- two\nHope this helps. I don't know"
    df = spark.createDataFrame([(0, t), (1, "plain words")], "id long, text string")
    r = judge.rubric_score(df).orderBy("id").collect()
    assert (r[0].opener, r[0].self_ref, r[0].hedge, r[0].list_line, r[0].closer, r[0].unsure) == (1, 1, 1, 2, 1, 1)
    assert r[0].contraction == 2
    assert r[1].score > r[0].score


def test_preference_pairs_and_report(spark):
    df = spark.createDataFrame([("g", "a1", "b1", 0.9, 0.1), ("g", "a2", "b2", 0.2, 0.8), ("h", "a3", "b3", 0.5, 0.5)],
                               "g string, completion_a string, completion_b string, score_a double, score_b double")
    pp = judge.preference_pairs(judge.pick_winner(df)).collect()
    assert [(r.chosen, r.rejected) for r in pp] == [("a1", "b1"), ("b2", "a2"), ("a3", "b3")]
    rep = {r.g: r for r in judge.win_report(judge.pick_winner(df), ["g"]).collect()}
    assert rep["g"].n_pairs == 2 and rep["g"].win_rate_a == 0.5
    assert rep[None].n_pairs == 3 and rep[None].level == 1 and rep["h"].tie_rate == 1.0


def _stub_scorer():
    def score(texts: pd.Series) -> pd.DataFrame:
        n = texts.str.len().astype("float64")
        return pd.DataFrame({"logit_yes": -n / 100.0, "logit_no": np.zeros(len(n))})
    return score


def test_score_pairs_with_stub_model(spark):
    df = spark.createDataFrame([(1, "q", "short", "a much longer answer"), (2, "q", "long long answer", "x")],
                               "pair_id long, prompt string, completion_a string, completion_b string")
    out = judge.score_pairs(df, _stub_scorer, "judge", max_length=64).orderBy("pair_id").collect()
    assert [r.winner for r in out] == [0, 1]
    assert all(0 < r.score_a < 1 for r in out)


def _pairs(spark):
    return spark.createDataFrame([(1, "q", "one", "two")] * 8, "pair_id long, prompt string, completion_a string, completion_b string")


def test_each_call_uses_its_own_model(spark):
    import math

    import pandas as pd

    def scorer(x):
        return lambda: lambda s: pd.DataFrame({"logit_yes": [float(x)] * len(s), "logit_no": [0.0] * len(s)})

    for x in range(4):
        rows = judge.score_pairs(_pairs(spark).coalesce(1), scorer(x), "ok?").collect()
        assert all(abs(r.score_a - 1 / (1 + math.exp(-x))) < 1e-9 for r in rows)


def test_scoring_counts_tokens_of_the_given_tokenizer(spark):
    import pandas as pd

    def make():
        return lambda s: pd.DataFrame({"logit_yes": s.str.len().astype(float), "logit_no": [0.0] * len(s)})

    short = judge.score_pairs(_pairs(spark), make, "ok?", max_length=3, tokenizer=list).first()
    whole = judge.score_pairs(_pairs(spark), make, "ok?", max_length=10_000, tokenizer=list).first()
    assert short.score_a < whole.score_a and short.score_a == short.score_b


def test_pairs_without_scores_are_no_ties(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, 0.5, 0.5), (1, nan, nan), (0, 0.9, 0.1), (1, nan, 0.3)], "winner long, score_a double, score_b double")
    assert judge.win_report(df).first().tie_rate == 0.25
