"""Decontamination, licenses, quality, substring dedup, sharding and SentencePiece."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from prefspark.llm import decontaminate as D
from prefspark.llm import licenses, quality, sentencepiece, sharding, substring_dedup

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("module", [licenses, quality, substring_dedup])
def test_query_equals_duckdb(spark, module):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = module.query(spark, SF)
    want = con.execute(module.oracle()).df()[df.columns].sort_values("doc_id").reset_index(drop=True)
    got = df.toPandas().sort_values("doc_id").reset_index(drop=True)
    for c in df.columns:
        assert ((got[c] == want[c]) | (got[c].isna() & want[c].isna())).all(), c


def jaccard(a, b, weight):
    a, b = Counter(a), Counter(b)
    shared = sum(min(a[k], b[k]) * weight(k) for k in a.keys() & b.keys())
    return shared / sum(max(a[k], b[k]) * weight(k) for k in a.keys() | b.keys())


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(40))
    items = {i: [word() for _ in range(rng.choice([9, 24, 30, 41]))] for i in range(12)}
    items[12] = items[0][:3]  # shorter than a shingle
    docs = {}
    for k in range(120):
        text = [word() for _ in range(rng.randrange(0, 60))]
        if k % 2:
            own = list(items[rng.randrange(13)])
            for _ in range(rng.choice([0, 0, 1])):
                own[rng.randrange(len(own))] = word()
            own = own[rng.choice([0, 0, 1, 2]) :]
            at = rng.randrange(len(text) + 1)
            text[at:at] = own
        docs[k] = " ".join(w.upper() if k % 3 == 0 else w for w in text)
    grams = lambda w, n: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    df = Counter(g for w in items.values() for g in set(grams(w, min(5, len(w)))))
    import math

    weight = lambda g: round(8 * math.log2(1 + len(items) / df[g])) if g in df else round(8 * math.log2(1 + len(items)))
    want = {}
    for k, t in docs.items():
        w = t.lower().split()
        for i, item in items.items():
            n = min(5, len(item))
            best = 0.0
            for s in range(max(1, len(w))):
                window = w[s : s + len(item)]
                if len(window) >= n:
                    best = max(best, jaccard(grams(window, n), grams(item, n), weight))
            if best >= 0.8:
                want[k, i] = best
    a = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    got = {(r["id"], r["item_id"]): r["similarity"] for r in D.contaminated(a, b).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    again = {(r["id"], r["item_id"]): r["similarity"] for r in D.contaminated(a, b, pass_bytes=400).collect()}
    assert again == got


def test_license_labels(spark):
    texts = {
        1: "Released under the MIT License. Again: under the mit\tlicense!", 2: "Licensed under CC BY-NC 4.0.", 3: "Apache License, Version 2.0", 4: "under the mit-licenses",
        5: "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        6: "This work is licensed under the GNU General Public License, version 3.", 7: "permission is hereby granted to nobody",
    }
    rows = {r["id"]: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["last_word"], rows[1]["base_labels"]) == (2, 1, 6, "mit")
    assert [rows[k]["labels"] for k in range(2, 8)] == ["cc-by-nc", "apache-2", "", "mit", "gpl-3", ""]
    assert rows[5]["base_labels"] == "" and 0.7 <= rows[5]["score"] < 1 and 0 < rows[7]["score"] < 0.7


def test_quality_keeps_the_good_and_drops_the_bad(spark):
    got = quality.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    n = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in got}
    assert n.get((1, False, False), 0) <= 0.01 * n[1, False, True]
    assert n.get((0, False, True), 0) <= 0.05 * n[0, False, False]


def test_quality_sketches_merge(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = [quality.sketch(quality.with_counts(docs.where(F.col("doc_id") % 2 == k))) for k in (0, 1)]
    merged = parts[0].unionByName(parts[1]).groupBy("lang", "source", "signal", "cell").agg(F.sum("n").alias("n"))
    whole = quality.sketch(quality.with_counts(docs))
    assert merged.exceptAll(whole).count() == whole.exceptAll(merged).count() == 0


def test_quality_fences_follow_their_groups(spark):
    """Two sources of one language with different ordinary texts have different fences; neither is a fixed number."""
    rng = random.Random(7)
    text = lambda word, n: " ".join("".join(rng.choice("abcdef") for _ in range(word + rng.randrange(-1, 2))) for _ in range(n))
    rows = [(k, text(4, 60) + " #" * (k % 3), "xx", "short") for k in range(80)] + [(100 + k, text(11, 60), "xx", "long") for k in range(80)]
    rows += [(998, text(11, 60), "xx", "short"), (999, text(4, 60), "xx", "long"), (997, text(4, 60) + " # " * 40, "xx", "short")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    limits = {(r["source"], r["signal"]): (r["lo"], r["hi"]) for r in quality.fences(quality.sketch(quality.with_counts(df))).collect()}
    assert limits["short", "word_len"][1] < 1000 < limits["long", "word_len"][1] and limits["long", "word_len"][0] > 500
    assert limits["short", "symbol_rate"][1] > limits["long", "symbol_rate"][1]
    kept = {r["doc_id"] for r in quality.judged(df).where("_kept").collect()}
    assert not kept & {997, 998, 999} and len(kept) >= 156


def test_levels_double():
    assert substring_dedup.levels(13) == [7, 13] and substring_dedup.levels(50) == [7, 13, 25, 50] and substring_dedup.levels(5) == [5]


@pytest.mark.parametrize("window", [3, 13, 20, 40])
def test_substring_dedup_equals_brute_force(spark, window):
    rng = random.Random(window)
    pool = [[rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(5, 90))] for _ in range(12)]
    docs = {}
    for k in range(80):
        out = []
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            out += p[a : a + rng.randrange(1, 60)]
        docs[k] = out
    first = {}
    for k, w in sorted(docs.items()):
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), k)
    got = {r["id"]: r for r in substring_dedup.dedup(spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id bigint, text string"), window).collect()}
    for k, w in docs.items():
        gone = {p for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < k for p in range(i, i + window)}
        assert (got[k]["n_words"], got[k]["n_removed"], got[k]["kept"]) == (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))


def test_sharding_law(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.query(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
    assert set(slots) == set(range(8))
    for s in slots.values():
        assert sorted(x for x, _ in s) == list(range(len(s)))
        ids = [i for _, i in sorted(s)]
        assert ids != sorted(ids)
    moved = sum(r["grown_shard"] == 8 for r in rows)
    assert 0.05 < moved / len(rows) < 0.2


def test_sharding_order_depends_on_the_seed_alone(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(1000)], "doc_id bigint, text string")
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "31")
    same = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(1000)][::-1], "doc_id bigint, text string").repartition(13)
    again = other.createDataFrame([(i, "x" * (i % 50)) for i in range(1000)], "doc_id bigint, text string").repartition(3)
    for size in (300, 1 << 20):
        places = [{r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_records(d, bucket_bytes=size, seed=s).collect()} for d, s in ((df, 7), (same, 7), (again, 7), (df, 8))]
        assert places[0] == places[1] == places[2] != places[3]


def test_sharding_depends_on_the_key_alone(spark):
    df = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(500)], "doc_id bigint, text string")
    a = {r["doc_id"]: r["shard"] for r in sharding.shard_records(df, bucket_bytes=300).collect()}
    b = {r["doc_id"]: r["shard"] for r in sharding.shard_records(df.withColumn("text", F.lit("y")).repartition(5), 8).collect()}
    assert a == b
    rows = sharding.shard_records(df, bucket_bytes=300).collect()  # many buckets a shard
    for s in range(8):
        own = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(own) == list(range(len(own)))


def viterbi(text, vocab, pieces):
    out = []
    for w in sentencepiece.words(text):
        y = w.replace(" ", sentencepiece.MARK)
        best = [(0.0, [])]
        for e in range(1, len(y) + 1):
            top = None
            for s in range(e):
                i = pieces.get(y[s:e]) if w != sentencepiece.MARK else None
                if i is None and e - s > 1:
                    continue
                c = (vocab.scores[0] if i is None else vocab.scores[i]) + best[s][0]
                if top is None or c > top[0]:
                    top = (c, best[s][1] + ([vocab.bytes[k] for k in y[s:e].encode()] if i is None else [i]))
            best.append(top)
        out += best[-1][1]
    return out


def test_sentencepiece_equals_brute_force_and_round_trips(spark):
    vocab = sentencepiece.Vocabulary()
    pieces = dict(vocab.pieces)
    texts = ["Hello  wor▁ld\nx", "", " a", "  lead\n\n\ttab  ", "▁▁ ▁", "日本語テキスト 🎉🎉 naïve\r\n", "a" * 300 + " " * 200 + "b", 'wh.,;!?"x', "\x00\x01"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for travelling in (8_000_000, 50, 0):
        for r in sentencepiece.decode(sentencepiece.encode(df, vocab, table_units=travelling), vocab).collect():
            assert list(r["ids"]) == viterbi(texts[r["doc_id"]], vocab, pieces)
            assert r["decoded"] == texts[r["doc_id"]]


def uncut(text, vocab, pieces):
    """The best path over the whole text, cut nowhere."""
    y = "".join("\0" if c == sentencepiece.MARK else sentencepiece.MARK if c == " " else c for c in " " + text)
    own = [c == sentencepiece.MARK for c in " " + text]
    longest = max(map(len, pieces))
    best = [(0.0, 0, [])]
    for e in range(1, len(y) + 1):
        top = None
        for s in range(max(0, e - longest), e):
            i = None if any(own[s:e]) else pieces.get(y[s:e])
            if i is None and e - s > 1:
                continue
            c = best[s][0] + (vocab.scores[0] if i is None else vocab.scores[i])
            if top is None or c > top[0]:
                top = (c, s, [vocab.bytes[k] for k in (sentencepiece.MARK if own[s] else y[s]).encode()] if i is None else [i])
        best.append(top)
    out, e = [], len(y)
    while e:
        out.append(best[e][2])
        e = best[e][1]
    return [i for ids in reversed(out) for i in ids]


def test_long_runs_are_cut_only_where_no_piece_goes_on(spark):
    rng = random.Random(21)
    vocab = sentencepiece.Vocabulary()
    pieces = dict(vocab.pieces)
    run = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = ["https://www.example.org/" + "international/communication/" * 20, run("0123456789abcdef", 2_000), run("acgt", 70_000), run("ABCDefghijklmnop0123+/", 500), " " * 500 + "x", "日本語の文章は空白なしで続く" * 30, "ภาษาไทยไม่มีช่องว่าง" * 20, "information" * 40 + " " * 61 + "end", "a▁" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for travelling in (8_000_000, 20, 0):
        for r in sentencepiece.encode(df, vocab, table_units=travelling, check=True).collect():
            assert list(r["ids"]) == uncut(texts[r["doc_id"]], vocab, pieces), r["doc_id"]
            assert r["round_trip"]


def test_unit_table_costs_the_driver_few_jobs_and_a_short_plan(spark, capsys):
    vocab = sentencepiece.Vocabulary()
    units = [f"▁unit{i}" for i in range(400)]
    found = spark.createDataFrame([(u,) for u in units], "unit string").repartition(40)
    capsys.readouterr()
    sentencepiece.encode_units(found, vocab).explain()
    # Once in the plan: its other parts are a few thousand characters.
    assert len(capsys.readouterr().out) < 1.5 * len(",".join(map(repr, vocab.scores)))
    rows = [(u, [i, 0, 65_535]) for i, u in enumerate(units)]
    table = spark.createDataFrame(rows, "unit string, ids array<int>").repartition(40)
    for lot_bytes in (8 << 20, 200):
        spark.sparkContext.setJobGroup(f"pack_{lot_bytes}", "")
        packed = sentencepiece.pack_table(table, lot_bytes)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"pack_{lot_bytes}")
        assert jobs and (len(jobs) < 20 or lot_bytes == 200)
        ids, sizes = packed.ids_of(sentencepiece.keys_of(units))
        assert (sizes == 3).all() and ids.tolist() == [i for _, own in rows for i in own]
