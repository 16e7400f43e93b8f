import random
import re

import numpy as np
import xxhash

from prefspark.llm import simhash_dedup as S


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(ids, prints, bits=3):
    label = list(range(len(ids)))
    p = np.array(prints, np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None, :]) <= bits
    while True:
        new = [min(label[j] for j in np.nonzero(near[i])[0]) for i in range(len(ids))]
        if new == label:
            break
        label = new
    low = {}
    for i, k in zip(ids, label):
        low[k] = min(low.get(k, i), i)
    return [low[k] for k in label]


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in S.query(spark, "/root/testdata/sf0.01").collect()}
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    prints = [fingerprint(t) for _, t in docs]
    assert [got[i]["fingerprint"] for i, _ in docs] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i, _ in docs] == brute([i for i, _ in docs], prints)


def test_links_of_dense_and_chained_prints(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    prints = set(base) | {0, 2**64 - 1}
    for b in base[:20]:  # chains of steps of three bits, and dense clouds
        for _ in range(15):
            prints.add(b := b ^ sum(1 << x for x in rng.sample(range(64), 3)))
    for _ in range(150):
        prints.add(base[0] ^ sum(1 << x for x in rng.sample(range(8), 3)))
    prints = sorted(prints)
    want = brute(prints, prints)
    df = spark.createDataFrame([(S._long(p),) for p in prints], "fp bigint")
    for bucket in (8192, 3):  # 3: nearly every bucket is dealt again
        links = [(a % 2**64, b % 2**64) for a, b in S.fingerprint_links(df, 3, bucket).collect()]
        assert all((a ^ b).bit_count() >= 1 for a, b in links)
        label = {p: p for p in prints}

        def find(x, label=label):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in links:
            a, b = find(a), find(b)
            label[max(a, b)] = min(a, b)
        assert [find(p) for p in prints] == want


def test_in_bucket_links_are_a_forest():
    members = np.array([i ^ 0xABCDEF for i in range(512)], np.uint64)
    child, root = S.bucket_links(members, 3)
    assert len(child) == len(members) - 1 and len(set(root.tolist())) == 1


def test_one_row_stays_of_each_group_whatever_its_ids(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(4))
    texts = [" ".join(word() for _ in range(40)) for _ in range(6)]
    prints = [fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(prints) for b in prints[:i])
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (None, texts[0]), (9, texts[4]), (None, texts[4]), (3, texts[4]), (7, texts[2]), (None, texts[5])]
    kept = S.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (3, texts[4]), (None, texts[5])]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted((i or 0, t) for i, t in want)
