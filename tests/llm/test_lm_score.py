import math
import re
import zlib
from collections import Counter

import pytest

from prefspark.llm import lm_score as L

SF = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def test_base_columns_equal_brute_force(spark, docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in rows}
    counts = Counter(t for i, x in rows.items() if not held[i] for t in tokens(x))
    total = sum(counts.values())
    for r in L.query(spark, SF).collect():
        t = tokens(rows[r["doc_id"]])
        assert r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(counts[x] > 0 for x in t), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (len(counts) + 1))) for x in t), rel=1e-9)
        assert r["score"] < 0


def test_pieces_of_vocabulary_and_filter_change_nothing(spark, docs):
    whole = L.score(docs, L.train(docs))
    model = L.train(docs, vocab_entries=5_000, filter_bytes=20_000, range_bytes=40_000)
    assert len(model.vocab_pieces) > 1 and len(model.filter_pieces) > 1
    a = {r["id"]: r for r in whole.collect()}
    for r in L.score(docs, model).collect():
        assert (r["n_tokens"], r["n_known"]) == (a[r["id"]]["n_tokens"], a[r["id"]]["n_known"])
        assert r["base_score"] == pytest.approx(a[r["id"]]["base_score"], rel=1e-9)
        assert r["score"] == pytest.approx(a[r["id"]]["score"], rel=0.02)  # other slices, other filter errors


def test_probabilities_after_a_history_sum_to_at_most_one(spark):
    texts = [("a b a c a b d",), ("a b c",), ("b a d a b",)] * 7
    df = spark.createDataFrame([(i, t) for i, (t,) in enumerate(texts)], "doc_id bigint, text string")
    model = L.train(df)
    one = lambda text: {r["id"]: r["score"] for r in L.score(spark.createDataFrame([(0, text)], "doc_id bigint, text string"), model).collect()}[0]
    start = one("a")  # P(a) P(end | a)
    ways = {w: one(f"a {w}") - one(w) for w in "bcd"}
    assert start < 0 and all(v < 3 for v in ways.values())


def test_held_out_texts_gain_over_single_words(spark):
    rows = [r for r in L.query(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_filter_counts_are_never_too_low():
    import numpy as np

    keys = L.mix(np.arange(5000, dtype=np.uint64))
    keys.sort()
    counts = np.random.default_rng(0).integers(1, 300, len(keys))
    f = L.Filter(0, 0, [L.build_slice(keys, counts)])
    got = f.counts(keys, np.zeros(len(keys), np.int64))
    assert (got >= 2 ** np.floor(np.log2(counts))).all() and (got == 2 ** np.floor(np.log2(counts))).mean() > 0.9
    absent = f.counts(L.mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64)), np.zeros(5000, np.int64))
    assert (absent > 0).mean() < 0.05
