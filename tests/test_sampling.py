import math

import pytest
from pyspark.sql import functions as F

from prefspark.operators import ordinal, sampling

from conftest import SF_SMALL


def _rows(spark, n, parts):
    return spark.range(1, n + 1, numPartitions=parts).withColumnRenamed("id", "row_id")


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_shuffle_is_same_permutation_under_any_partitioning(spark, parts):
    got = {r.row_id: r.position for r in sampling.seeded_shuffle(_rows(spark, 500, parts), 7).collect()}
    assert sorted(got.values()) == list(range(1, 501))
    ref = {r.row_id: r.position for r in sampling.seeded_shuffle(_rows(spark, 500, 3), 7).collect()}
    assert got == ref


def test_shuffle_matches_plain_row_number(spark):
    df = _rows(spark, 300, 5)
    got = {r.row_id: r.position for r in sampling.seeded_shuffle(df, 42).collect()}
    key = sampling.seed_key(42, F.col("row_id"))
    ref = df.selectExpr("row_id").withColumn("k", key).toPandas().sort_values(["k", "row_id"])
    assert [got[i] for i in ref.row_id] == list(range(1, 301))


@pytest.mark.parametrize("fraction,n", [(0.05, 1000), (0.1, 37), (0.33, 10), (0.5, 3)])
def test_split_exact_disjoint_complete(spark, fraction, n):
    df = sampling.train_eval_split(_rows(spark, n, 4), fraction, 42)
    ev = df.filter("split = 'eval'").select("row_id")
    tr = df.filter("split = 'train'").select("row_id")
    assert ev.count() == math.ceil(fraction * n)
    assert ev.intersect(tr).count() == 0
    assert ev.unionByName(tr).exceptAll(_rows(spark, n, 1)).count() == 0
    assert _rows(spark, n, 1).exceptAll(ev.unionByName(tr)).count() == 0


def test_split_zero_and_empty_side(spark):
    df = sampling.train_eval_split(_rows(spark, 10, 2), 0.0)
    assert df.filter("split = 'train'").count() == 10
    with pytest.raises(Exception, match="leaves a part empty"):
        sampling.train_eval_split(_rows(spark, 1, 1), 0.5).collect()


def test_limit_samples(spark):
    df = _rows(spark, 20, 3)
    assert sampling.limit_samples(df, 5).count() == 5
    assert sampling.limit_samples(df, None).count() == 20
    assert sampling.limit_samples(df, 0).count() == 20
    assert sampling.limit_samples(df, 100).count() == 20


def test_assign_batches(spark):
    df = sampling.assign_batches(_rows(spark, 21, 3), batch_size=2, grad_accum=4, epochs=2)
    pdf = df.toPandas()
    assert len(pdf) == 42
    assert pdf.groupby("epoch").row_id.nunique().tolist() == [21, 21]
    assert sorted(pdf.step.unique().tolist()) == list(range(6))
    assert pdf.groupby("step").size().tolist() == [8, 8, 5, 8, 8, 5]
    capped = sampling.assign_batches(_rows(spark, 21, 3), 2, 4, epochs=2, max_steps=4)
    assert capped.agg(F.max("step")).first()[0] == 3


def test_row_id_over_several_files(spark, scratch):
    path = scratch("rowid")
    spark.range(0, 3000, numPartitions=3).withColumn("v", F.col("id") * 2).write.parquet(path)
    df = ordinal.with_row_id(spark.read.option("maxPartitionBytes", 4096).parquet(path))
    pdf = df.toPandas()
    assert sorted(pdf.row_id) == list(range(1, 3001))
    files = spark.read.parquet(path).select("id", F.col("_metadata.file_path").alias("f"),
                                           F.col("_metadata.row_index").alias("i")).toPandas()
    files = files.sort_values(["f", "i"]).reset_index(drop=True)
    order = dict(zip(files.id, range(1, 3001)))
    assert all(order[i] == r for i, r in zip(pdf.id, pdf.row_id))


def test_ordinal_plan_has_no_single_partition_exchange_over_data(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    df = sampling.seeded_shuffle(ordinal.with_row_id(docs), 42)
    plan = df._jdf.queryExecution().executedPlan().toString()
    data_exchanges = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert data_exchanges
    assert not any("SinglePartition" in ln for ln in data_exchanges)


def test_checked_small_sizes_by_rows_and_bytes(spark):
    small = spark.range(10).withColumn("s", F.lit("x" * 10))
    _, fits = ordinal.checked_small(small)
    assert fits
    _, fits = ordinal.checked_small(small, max_rows=5)
    assert not fits
    _, fits = ordinal.checked_small(small, max_bytes=100)
    assert not fits


def test_big_histogram_falls_back_to_shuffle_join(spark):
    df = _rows(spark, 200, 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ordinal.exact_ordinal(df, [("b", F.col("row_id") % 50)], ["row_id"], max_rows=10)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        pos = {r.row_id: r.ordinal for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(pos.values()) == list(range(1, 201))
    assert pos[50] == 1 and pos[100] == 2


@pytest.mark.parametrize("k,digits", [(0, 4), (1, 4), (37, 1), (150, 2), (400, 4)])
def test_hash_first_equals_full_ranking(spark, k, digits):
    df = _rows(spark, 400, 4)
    key = sampling.seed_key(9, F.col("row_id"))
    flags = {r.row_id: r.first for r in ordinal.hash_first(df, key, ["row_id"], lambda n: F.lit(k), digits=digits).collect()}
    pos = {r.row_id: r.ordinal for r in ordinal.hash_ordinal(df, key, ["row_id"]).collect()}
    assert len(flags) == 400
    assert flags == {i: pos[i] <= k for i in pos}


def test_hash_buckets_refine_when_too_big(spark):
    df = _rows(spark, 400, 4)
    key = sampling.seed_key(1, F.col("row_id"))
    fine = {r.row_id: r.ordinal for r in ordinal.hash_ordinal(df, key, ["row_id"], digits=1, max_bucket=3).collect()}
    plain = {r.row_id: r.ordinal for r in ordinal.hash_ordinal(df, key, ["row_id"]).collect()}
    assert fine == plain and sorted(fine.values()) == list(range(1, 401))
    flags = ordinal.hash_first(df, key, ["row_id"], lambda n: F.lit(100), digits=1, max_bucket=3).collect()
    assert {r.row_id for r in flags if r.first} == {i for i, p in plain.items() if p <= 100}


def test_refinement_stops_on_repeated_key(spark):
    df = _rows(spark, 300, 3)
    same = F.lit("0" * 32)
    out = {r.row_id: r.ordinal for r in ordinal.hash_ordinal(df, same, ["row_id"], digits=1, max_bucket=10).collect()}
    assert out == {i: i for i in range(1, 301)}


def test_rows_of_a_null_group_are_numbered_too(spark):
    from pyspark.sql import functions as F

    from prefspark.operators import ordinal

    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "g string, v long")
    rows = ordinal.hash_ordinal(df, F.md5(F.col("v").cast("string")), out="n", partition_by=["g"]).collect()
    assert sorted((r.g or "", r.n) for r in rows) == [("", 1), ("", 2), ("a", 1)]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 7919])
def test_permuted_positions_are_a_permutation(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("row_id"))
    out = df.select("row_id", *[sampling.permuted_position(F.col("row_id"), n, s, e).alias(f"p{s}_{e}") for s, e in ((1, 0), (1, 1), (2, 0))]).orderBy("row_id").collect()
    for c in ("p1_0", "p1_1", "p2_0"):
        assert sorted(r[c] for r in out) == list(range(1, n + 1))
    if n > 90:
        a, b, c = ([r[k] for r in out] for k in ("p1_0", "p1_1", "p2_0"))
        assert a != b and a != c
        # Neighbours are torn apart: few keep their distance.
        assert sum(abs(x - y) == 1 for x, y in zip(a, a[1:])) < 0.1 * n


def test_permutation_shape_leaves_little_over():
    for n in [*range(1, 2000), 10**6 + 3, 2**31 - 1, 10**12 + 39, 2**60 - 1]:
        a, b, excess = sampling.permutation_shape(n)
        assert a * b == n + excess and 0 <= excess <= max(64, a // 10_000) and max(a, b) < 2**31 and 4 * (a + 1) >= b


def test_permuted_batches_move_no_rows(spark):
    df = spark.range(1, 1001, numPartitions=7).select(F.col("id").alias("row_id"), F.lit("x" * 50).alias("payload"))
    out = sampling.assign_batches(df, 2, 4, epochs=3, seed=5, order="permutation")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    key = lambda f: sorted((r.row_id, r.epoch, r.epoch_pos, r.step, r.micro_batch) for r in f.collect())
    rows = key(out)
    assert rows == key(sampling.assign_batches(df.repartition(31), 2, 4, epochs=3, seed=5, order="permutation"))
    assert {(e, p) for _, e, p, _, _ in rows} == {(e, p) for e in range(3) for p in range(1, 1001)}
    assert rows != key(sampling.assign_batches(df, 2, 4, epochs=3, seed=6, order="permutation"))
    few = key(sampling.assign_batches(df, 2, 4, epochs=3, max_steps=130, seed=5, order="permutation"))
    assert few == [r for r in rows if r[3] < 130]
    for bad in (df.where("row_id > 1"), df.where("row_id <> 5"), df.withColumn("row_id", F.greatest("row_id", F.lit(3)))):
        with pytest.raises(ValueError):
            sampling.assign_batches(bad, order="permutation")
    assert sampling.assign_batches(df.limit(0), order="permutation").count() == 0
