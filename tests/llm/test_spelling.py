import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from prefspark.llm import spelling as S


def brute_words(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:j] + a[j + 1 :] == b for j in range(len(a)))


def brute(vocab):
    # Words within one edit share a string made by deleting at most one code point.
    shared = defaultdict(set)
    for w in vocab:
        for cut in {w} | {w[:j] + w[j + 1 :] for j in range(len(w))}:
            shared[cut].add(w)
    out = {}
    for w, n in vocab.items():
        around = {x for cut in {w} | {w[:j] + w[j + 1 :] for j in range(len(w))} for x in shared[cut] if near(w, x)}
        best = min(around, key=lambda x: (-vocab[x], x), default=None)
        form = best if best is not None and vocab[best] >= 5 * n else None
        out[w] = (form, n, len(around), vocab[form] if form else None)
    full = {}
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        full[w] = (out[w][0], root, *out[w][1:])
    return full


def rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    df = S.query(spark, "/root/testdata/sf0.01")
    assert df.count() == len(got := rows(df))
    assert got == brute(brute_words(docs))


@pytest.fixture(scope="module")
def vocab():
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(6, 10))): rng.choice([5, 6, 25, 130, 700, 10**12]) for _ in range(1200)}
    words["x" * 70], words["x" * 69], words["x" * 68 + "y"] = 5, 25, 125  # beyond LENGTHS
    words |= {"ladder" + "a" * k: 5 ** (k + 1) for k in range(12)}  # a chain of twelve forms
    words |= {"tieaaa": 5, "tieaab": 50, "tieaac": 50}
    return words


@pytest.mark.parametrize("pass_bytes", [S.PASS_BYTES, 700])
def test_dense_words_chains_ties_and_passes(spark, vocab, pass_bytes):
    df = spark.createDataFrame(list(vocab.items()), "word string, n bigint")
    got = rows(S.variants(df, pass_bytes=pass_bytes))
    assert got == brute(vocab)
    assert got["ladder"][1] == "ladder" + "a" * 11 and got["tieaaa"][0] == "tieaab"


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (None, "Wörterx wörterx WÖRTERX 123"), (None, "wörterx wörterx"), (5, "x" * 50_000), (3, "Éclairs " * 6), (3, "Éclairs " * 6)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in texts], "doc_id bigint, text string, word string")
    got = {r["word"]: r["n"] for r in S.count_words(df.withColumn("i", df["word"]).withColumn("h", df["word"]), noise=199).collect()}
    assert got == brute_words(texts)
    assert S.variants(S.count_words(df.limit(0))).count() == 0
    assert S.variants(S.count_words(df.where("doc_id < 3"))).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_filter_has_no_false_negatives_and_few_false_positives():
    words = [f"word{i:06d}" for i in range(4000)]
    blocks = -(-len(words) * S.BITS // S.BLOCK)
    h = S.hashes(words)
    table = np.zeros(blocks * 8, np.uint64)
    block, second = S.slots(h, blocks)
    for p in range(S.PROBES):
        b = S.bit(second, p)
        np.bitwise_or.at(table, (block * np.uint64(8) + (b >> np.uint64(6))).astype(np.int64), np.uint64(1) << (b & np.uint64(63)))
    assert len(S.probe(h, blocks, table, 0, 1)) == len(words)
    assert len(S.probe(S.hashes([f"other{i}" for i in range(20_000)]), blocks, table, 0, 1)) < 400
