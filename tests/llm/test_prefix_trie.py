import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from prefspark.llm import prefix_trie as P


def conversations(rows):
    """Turn lists (role, text) by id, from rows (conv_id, turn, role, text)."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        out[c] = ([] if c is None else convs.get(c - c % 20, []))[:h] + own[h:]
    return out


def brute(convs):
    nodes = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].add(c)
    low = {k: min((c for c in v if c is not None), default=None) for k, v in nodes.items()}
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, v in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(v) - 1) * words
    out = []
    for k, v in nodes.items():
        ends = sorted(c for c in v if c is not None and tuple(convs[c]) == k)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((low[k], len(k), low[k[:-1]] if k else None, len(v), children[k], leaves[k], saved[k], digest))
    return Counter(out)


def rows(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(12)
    out = []
    for c in range(160):
        base = (2**60 + 1 if c % 3 else 0) + c
        length = rng.choice([0, 1, 2, 3, 5, 9])
        out += [(base, k, rng.choice(["user", "bot"]) if k > 2 else "user", f"say {rng.randrange(2)}  again") for k in range(length)]
    out += [(900, k, "user", "same thing") for k in range(70)] + [(901, k, "user", "same thing") for k in range(64)]  # long, one a prefix of the other
    out += [(902, k, "user", "same thing" if k < 40 else "other") for k in range(70)]
    out += [(None, 1, "user", "say 0  again"), (None, None, None, None), (None, 1, "user", "say 0  again")]
    out += [(904, 3, "b", "x"), (904, 3, "a", "y"), (904, 3, "a", "y"), (904, None, "z", None), (905, None, None, "")]
    return out


@pytest.mark.parametrize("segment,shard,part_size", [(P.SEGMENT, P.SHARD, 1 << 16), (3, 7, 8), (1, 1, 1 << 16)])
def test_equals_brute_force_in_any_segments_and_shards(spark, turns, segment, shard, part_size):
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id bigint, turn bigint, role string, text string, conv string")
    df = df.withColumns({c: df["conv"] for c in ("part", "pos", "words", "n", "low")})
    encoded = P.materialize(P.encode_turns(df, part_size=part_size), "test_turns")
    convs = conversations(turns)
    assert rows(P.trie(encoded, encoded.select("conv"), segment, shard)) == brute(convs)
    if segment == P.SEGMENT:
        assert rows(P.trie(P.rebuilt(encoded), encoded.select("conv"))) == brute(rebuilt(convs))
        assert rows(P.conversation_trie(df)) == brute(convs)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    convs = conversations([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert rows(P.query(spark, "/root/testdata/sf0.01")) == brute(rebuilt(convs))


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert P.conversation_trie(none).count() == 0
    encoded = P.encode_turns(none)
    convs = spark.createDataFrame([(12,), (7,), (100,)], "conv bigint")
    assert rows(P.trie(encoded, convs)) == brute({12: [], 7: [], 100: []})


def test_end_digests_of_many_ids(spark):
    ends = spark.range(3000).selectExpr("id * 7919 % 3001 as conv", "id % 2 as e1", "5L as e2")
    got = {r["e1"]: r["ends"] for r in P.end_digests(ends).collect()}
    for k in (0, 1):
        ids = sorted(i * 7919 % 3001 for i in range(3000) if i % 2 == k)
        assert got[k] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_medians_keep_the_tree_shallow():
    assert sorted(P.medians(1000)) == list(range(1000)) and next(P.medians(1000)) == 500
    tree = P.Tree(8)
    for k in P.medians(1023):
        tree.insert({"seg": 0, "p1": 0, "p2": 0, "turns": [{"id": k, "words": 1, "k1": k, "k2": k}], "n": 1, "low": k, "ends": None})

    def deep(v):
        return 0 if v < 0 else 1 + max(deep(tree.low[v]), deep(tree.high[v]))

    assert deep(tree.down[0]) == 10
