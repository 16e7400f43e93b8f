import random
import re

import numpy as np
import pytest

from prefspark.llm import minhash_dedup as M
from prefspark.llm.common import chunks


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """Component of every row, by comparing all pairs of distinct sets."""
    sets = [shingles(t) for _, t in docs]
    label = {s: k for k, s in enumerate(dict.fromkeys(sets))}
    names = list(label)

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    up = list(range(len(names)))
    for i, x in enumerate(names):
        for j in range(i):
            y = names[j]
            both = len(x & y)
            if both and 100 * both >= 85 * (len(x) + len(y) - both):
                up[find(i)] = find(j)
    low = {}
    for (k, _), s in zip(docs, sets):
        r = find(label[s])
        if k is not None:
            low[r] = min(low.get(r, k), k)
    return [(k, len(s), low.get(find(label[s])) if s else k) for (k, _), s in zip(docs, sets)]


def rows(df):
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def families():
    """Texts in families whose similarities lie around the threshold, with chains of edits and copies."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    docs = []
    for _ in range(8):
        base = [word() for _ in range(rng.randrange(50, 160))]
        step = list(base)
        for _ in range(25):
            t = list(step if rng.random() < 0.5 else base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = word()
            step = t
            docs.append(" ".join(t))
    docs += ["One two", "one TWO", "one two three", "one two three four five", "one two three four five", None, "", " \n"]
    docs += [docs[0].upper(), docs[0] + "\n"]
    rng.shuffle(docs)
    return [(2**60 + 3 * k + 1, t) for k, t in enumerate(docs)] + [(None, docs[3]), (None, "alone without an id"), (None, None), (2**60 + 1, docs[0])]


@pytest.mark.parametrize("block", [M.BLOCK, 2])
def test_equals_brute_force_and_keeps_large_ids_beside_null(spark, families, block):
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in families], "doc_id bigint, text string, m string, key int")
    got = rows(M.minhash_near_dups(df, block=block))
    want = sorted(brute(families), key=repr)
    assert got == want
    assert len({c for _, _, c in want}) > 12


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in M.query(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted((i, n, c, i == c) for i, n, c in brute(docs))


def test_blocks_meet_all_cross_pairs_once_or_more(spark):
    """Every pair of members of different components shares a block, whatever the block size."""
    members = [(1, k, 0 if k < 17 else k, k < 17, 17, 9, 17, 9) for k in range(26)]
    df = spark.createDataFrame(members, "key bigint, m bigint, root bigint, main boolean, n_main bigint, n_rest bigint, w_main bigint, w_rest bigint")
    for block in (1, 4, 100):
        met, blocks = set(), {}
        for r in M.blocked(df, block).collect():
            blocks.setdefault((r["i"], r["j"]), []).append(r)
        for rows_ in blocks.values():
            met |= {frozenset((x["m"], y["m"])) for x in rows_ if x["side"] == 0 for y in rows_ if x["root"] != y["root"]}
        assert met == {frozenset((a, b)) for a in range(26) for b in range(17, 26) if a != b}


def test_block_links_join_what_links_and_no_more():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 100)
    sets = [np.unique(np.concatenate([base[: 100 - k], rng.integers(0, 2**63, k)])) for k in rng.integers(0, 14, 60).tolist()] + [np.unique(rng.integers(0, 2**63, 3))]
    root = np.arange(len(sets))
    root[:20] = 0
    links = M.block_links(np.arange(len(sets)), root, (root != 0).astype(int) ^ 1, sets, 85)

    def parts(pairs):
        label = root.tolist()
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return len(set(label)), {frozenset(k for k, x in enumerate(label) if x == y) for y in label}

    near = lambda a, b: 100 * len(set(sets[a]) & set(sets[b])) >= 85 * len(set(sets[a]) | set(sets[b]))
    assert all(near(a, b) for a, b in links) and len(links) < len(sets)
    assert parts(links) == parts([(a, b) for a in range(len(sets)) for b in range(a) if near(a, b)])


def test_signatures_estimate_similarity():
    a = " ".join(f"w{i}" for i in range(1004))
    b = " ".join(f"w{i}" if i < 905 else f"v{i}" for i in range(1004))
    (c,) = chunks([a, b])
    h, doc = M.sets_of(c, 5)
    n = np.bincount(doc)
    sig = M.minima(h, np.concatenate(([0], np.cumsum(n)[:-1])))
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert list(n) == [1000, 1000] and abs((sig[0] == sig[1]).mean() - true) < 0.12


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert M.minhash_near_dups(df).count() == 0
    with pytest.raises(ValueError):
        M.minhash_near_dups(df, percent=50)
