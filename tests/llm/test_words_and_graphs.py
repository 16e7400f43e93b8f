import re

import numpy as np
import pytest

from prefspark.llm import common

TEXTS = ["", " ", "a", "a b\tc\n d", "naïve 日本 x", "\x1c \x85 b", "x" * 50, "a a a a a a a"]


def test_word_hashes_follow_words_across_texts():
    seen = {}
    for t in TEXTS:
        words = re.findall(rb"[^\x20\x09-\x0D]+", t.encode())
        h = common.word_hashes(t.encode()).tolist()
        assert len(h) == len(words)
        for a, b in zip(h, words):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    raw = b"alpha beta " * 50 + b"g" * 300 + b" delta"
    whole = common.word_hashes(raw)
    monkeypatch.setattr(common, "CHUNK", 64)
    assert (common.word_hashes(raw) == whole).all()


def test_chunks_keep_texts_apart(monkeypatch):
    monkeypatch.setattr(common, "CHUNK", 8)
    texts = ["a b c", "", "b c", "a b c d e f g h i"]
    n = []
    for c in common.chunks(texts):
        h, at = c.windows(2)
        n += [int((c.doc[at] == k).sum()) for k in range(c.hi - c.lo)]
    assert n == [2, 0, 1, 8]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(-40, 40, (45, 2))] + [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(200, 230)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in common.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    for a, b in links:
        if a != b:
            assert got[a] == find(a) and got[b] == find(b)
    assert common.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
