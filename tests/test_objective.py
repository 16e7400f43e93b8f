import math

from prefspark.operators import objective


def _lp(spark):
    rows = [(1, -1.0, -2.0, -1.5, -1.5, -3.0), (2, -2.0, -2.0, -2.0, -2.0, -1.0), (3, 0.0, -900.0, 0.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, "pair_id long, policy_chosen double, policy_rejected double, ref_chosen double, "
                                       "ref_rejected double, policy_explore double")


def test_sigmoid_loss(spark):
    out = {r.pair_id: r for r in objective.preference_loss(_lp(spark), 0.1, 0.01).collect()}
    z = (-1.0 + 1.5) - (-2.0 + 1.5)
    assert abs(out[1].loss - (math.log1p(math.exp(-0.1 * z)) + 0.01 * -3.0)) < 1e-12
    assert abs(out[2].pref_loss - math.log(2)) < 1e-12
    assert out[3].pref_loss >= 0 and math.isfinite(out[3].pref_loss)


def test_ipo_loss(spark):
    out = {r.pair_id: r for r in objective.preference_loss(_lp(spark), 0.5, 0.0, "ipo").collect()}
    assert abs(out[2].loss - 1.0) < 1e-12


def test_eos_penalty(spark):
    df = spark.createDataFrame([("done<|im_end|>", 1.0), ("cut", 1.0), (None, 1.0)], "completion string, score double")
    got = [r.score for r in objective.eos_penalty(df, penalty=0.5).collect()]
    assert got == [1.0, 0.5, 0.5]
    assert [r.score for r in objective.eos_penalty(df, penalty=None).collect()] == [1.0, 1.0, 1.0]


def test_loss_report_beta_per_epoch(spark):
    from pyspark.sql import functions as F
    df = _lp(spark).withColumn("epoch", F.lit(3)).withColumn("step", F.lit(0))
    rep = objective.loss_report(df, beta=(0.1, 0.2)).first()
    assert rep.n == 3
    direct = objective.preference_loss(_lp(spark), 0.2, 1e-5).agg(F.avg("loss")).first()[0]
    assert abs(rep.mean_loss - direct) < 1e-12
