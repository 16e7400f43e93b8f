"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, in every operator."""

import pytest
from pyspark.sql import functions as F

from prefspark.llm import decontaminate, html_extract, licenses, lm_score, minhash_dedup, pii, quality, sentencepiece, sharding, simhash_dedup, substring_dedup

ITEM = " ".join(f"item{i}" for i in range(20))
LONG = " ".join(f"w{i % 977} mail{i}@x.example.org" for i in range(20_000))
CLASH = ["id", "key", "h", "at", "tag", "fp", "n", "word", "unit", "ids", "size", "shard", "slot", "kept", "hits", "low", "bucket", "base", "terms", "pos", "contexts", "_s", "_l", "_q", "_p_id", "_p_key", "_w_id", "_w_key", "_b_id", "_b_tag", "_s_key", "_s_out", "row", "a.b"]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "plain text", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (None, "no id here", "en", "a"), (None, None, None, None), (4, LONG, "en", "b"), (5, "same row", "en", "a"), (5, "same row", "en", "a"), (5, "other text of one id", "en", "a"), (6, f"x {ITEM} y", "en", "a"), (7, " \t\n", "de", "a")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASH}).withColumn("n_chars", F.lit(1).cast("bigint"))


def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (1, ITEM)], "item_id bigint, text string")


def operators(spark):
    vocab = sentencepiece.Vocabulary()
    return {
        "lm": lambda d: lm_score.score(d, lm_score.train(d)),
        "html": lambda d: html_extract.extract(d, {"ratio": {}, "pairs": {}, "every": [[0.9, 0.1], [0.1, 0.9]]}, "text"),
        "sentencepiece": lambda d: sentencepiece.decode(sentencepiece.encode(d, vocab), vocab),
        "pii": pii.find,
        "sanitise": pii.sanitise,
        "licenses": licenses.scan,
        "quality": quality.judged,
        "substring": substring_dedup.dedup,
        "sharding": sharding.shard_records,
        "simhash": simhash_dedup.simhash_near_dups,
    }


def test_every_input_row_has_a_result(spark, rows):
    n = rows.count()
    empty = rows.limit(0)
    for name, f in operators(spark).items():
        assert f(rows).count() == n, name
        assert f(empty).count() == 0, name


def test_results_of_edge_rows(spark, rows):
    s = {(r["id"], r["n_tokens"]) for r in lm_score.score(rows, lm_score.train(rows)).collect()}
    assert {(2, 1), (3, 1), (None, 1), (7, 1), (1, 3)} <= s
    got = sentencepiece.decode(sentencepiece.encode(rows)).select("text", "ids", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in got) and all(r["ids"] == [] for r in got if not r["text"])
    assert {r["doc_id"] for r in sharding.shard_records(rows).where("size = 1").collect()} == {2, 3, None}
    near = {(r["id"], r["fp"]): r["component_id"] for r in simhash_dedup.simhash_near_dups(rows).collect()}
    assert near[2, 0] == near[3, 0] == near[7, 0] == near[None, 0] == 2
    cut = {r["id"]: r for r in substring_dedup.dedup(rows).collect()}
    assert cut[3]["kept"] == "" and cut[4]["n_removed"] == 0
    assert {r["id"]: r["n_words"] for r in licenses.scan(rows).collect()}[7] == 0
    assert {r["id"] for r in pii.find(rows).where(F.size("base") > 0).collect()} == {4}


def test_matches_and_filters(spark, rows):
    found = decontaminate.contaminated(rows, items(spark)).collect()
    assert {(r["id"], r["item_id"], r["start"], r["n_words"]) for r in found} == {(6, 1, 1, 20)}
    assert decontaminate.contaminated(rows, items(spark).limit(0)).count() == 0
    assert decontaminate.contaminated(rows.limit(0), items(spark)).count() == 0
    clean = decontaminate.decontaminate(rows, items(spark))
    assert clean.columns == rows.columns and clean.count() == rows.count() - 1
    kept = simhash_dedup.keep_first(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(1, "plain text"), (2, ""), (0, "no id here"), (4, LONG), (5, "same row"), (5, "other text of one id"), (6, f"x {ITEM} y")])
    assert simhash_dedup.keep_first(rows.limit(0)).count() == 0
    assert quality.quality_filter(rows).columns == rows.columns
    assert pii.sanitise(rows).columns == rows.columns


def test_large_ids_beside_a_null_stay_as_they_are(spark):
    big = 2**60 + 1
    text = " ".join(f"word{i} and" for i in range(40))
    data = [(big, f"{text} {ITEM}"), (None, text), (big + 2, text + " more words here"), (None, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").coalesce(1)
    ids = sorted([big, big + 2, None, None], key=repr)
    for f in (lambda d: lm_score.score(d, lm_score.train(d)), simhash_dedup.simhash_near_dups, substring_dedup.dedup, minhash_dedup.minhash_near_dups):
        assert sorted((r["id"] for r in f(df).collect()), key=repr) == ids
    model = lm_score.train(df, vocab_entries=10, filter_bytes=64, range_bytes=64)
    assert sorted((r["id"] for r in lm_score.score(df, model).collect()), key=repr) == ids
    assert {r["id"] for r in decontaminate.contaminated(df, items(spark)).collect()} == {big}
    clean = decontaminate.decontaminate(df, items(spark))
    assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted([big + 2, None, None], key=repr)
    apart = spark.createDataFrame([(big, LONG), (None, "one two three four")], "doc_id bigint, text string").coalesce(1)
    assert sorted((r["doc_id"] for r in simhash_dedup.keep_first(apart).collect()), key=repr) == sorted([big, None], key=repr)
