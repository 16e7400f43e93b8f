"""SimHash near-duplicates by pivot distance tables (operator 10).

A pair within ``max_bits`` differs by at most ``max_bits`` in its distance to *any* reference
fingerprint. Every distinct fingerprint gets its row of distances to ``PIVOTS`` references;
inside a bucket the rows are sorted by the first distance, a pair is discarded as soon as one
coordinate differs by more than ``max_bits``, and survivors are verified on the 64 bits.

Pivots over the whole fingerprint cannot deal pairs to tasks (two random fingerprints agree
within 3 on one pivot with probability 0.46), so buckets come from the pigeonhole rule: cut the
64 bits into ``max_bits + 2`` blocks, then a linked pair agrees on at least two of them. Every
choice of two blocks is one equi-join key. Exact copies share one fingerprint and are one
member. A bucket emits a spanning forest of its links, never its pairs; buckets above
``BUCKET`` members are dealt again by a second pigeonhole over their other bits, after which
a bucket has at most 2**20 distinct members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import connected_components, encode, map_with_ids, materialize, packed, text_of

BUCKET = 8192
PIVOTS = 24


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(20).integers(0, 2**64, n, dtype=np.uint64)


def simhash(text: str, shingle: int) -> int:
    """Majority bits over the XXH64 (seed 42) hashes of the word shingles, repeats included."""
    import xxhash

    words = encode(text).lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    first = np.concatenate(([0], ends))[:n].tolist()
    last = (ends[min(shingle, len(words)) - 1 :][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], 42) for a, b in zip(first, last)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, key, fp)`` per row: key is a hash of the text, fp the signed fingerprint."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"id": b["id"], "key": b["key"], "fp": fp})

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_with_ids(rows, fold, f"id {kind}, key bigint, fp bigint")


def bucket_links(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest ``(member, root)`` of the links between distinct uint64 fingerprints."""
    table = np.bitwise_count(members[:, None] ^ pivots()[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    members, table = members[order], table[order]
    n = len(members)
    label = np.arange(n)
    step = max(1, min(n, 2_000_000 // n))
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        end = int(np.searchsorted(table[:, 0], table[hi - 1, 0] + max_bits, "right"))
        near = np.abs(table[lo:hi, None, 1] - table[None, lo:end, 1]) <= max_bits
        i, j = np.nonzero(near)
        i, j = i + lo, j + lo
        i, j = i[keep := i < j], j[keep]
        for p in (0, *range(2, table.shape[1])):
            keep = np.abs(table[i, p] - table[j, p]) <= max_bits
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(members[i] ^ members[j]) <= max_bits
        i, j = i[keep], j[keep]
        while len(i):
            low = np.minimum(label[i], label[j])
            if (label[i] == label[j]).all():
                break
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            while (label != (up := label[label])).any():
                label = up
    child = label != np.arange(n)
    return members[child], members[label[child]]


def _masks(bits: list[int], blocks: int, equal: int) -> list[int]:
    """One mask per choice of ``equal`` out of ``blocks`` near-equal cuts of the bit positions."""
    parts = [list(p) for p in np.array_split(np.array(bits), blocks)]
    out = []
    for chosen in combinations(parts, equal):
        out.append(sum(1 << int(b) for p in chosen for b in p))
    return out


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint_links(fps: DataFrame, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what pairs of ``fps(fp)`` within ``max_bits`` connect."""
    masks = _masks(list(range(64)), max_bits + 2, 2)

    def keyed(df: DataFrame, tables: list[int]) -> DataFrame:
        return df.select("*", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_long(m))).alias("k")) for t, m in enumerate(tables)])).alias("e")).select("fp", "e.t", "e.k")

    keys = keyed(fps, masks)
    sizes = materialize(keys.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "bucket_sizes")
    shared = keys.join(sizes, ["t", "k"])
    small = shared.where(F.col("n") <= bucket).groupBy("t", "k").agg(F.collect_list("fp").alias("fps"))

    sub = [_masks([b for b in range(64) if not m >> b & 1], 2 * max_bits, max_bits) if max_bits else [0] for m in masks]
    finer = [[_long(m | s) for s in sub[t]] for t, m in enumerate(masks)]
    big = shared.where(F.col("n") > bucket).select(
        "fp", F.col("t"), F.posexplode(F.transform(F.get(F.lit(finer), F.col("t")), lambda m: F.col("fp").bitwiseAND(m))).alias("s", "k")
    )
    big = big.groupBy("t", "s", "k").agg(F.collect_list("fp").alias("fps"))

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for f in b["fps"]:
                f = np.asarray(f, np.int64).view(np.uint64)
                child, root = bucket_links(f, max_bits)
                if len(child):
                    yield pd.DataFrame({"a": child.view(np.int64), "b": root.view(np.int64)})

    groups = small.select("fps").unionByName(big.select("fps")).where(F.size("fps") > 1)
    return groups.mapInPandas(link, "a bigint, b bigint")


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``(id, key, fp, root, component_id)`` per row; root is a fingerprint that names the component."""
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    low = rows.groupBy("fp").agg(F.min("id").alias("low"))
    fps = low.select("fp")
    comp = connected_components(fingerprint_links(fps, max_bits, bucket))
    # Roots of linked fingerprints; all others are their own component.
    named = low.join(comp, low["fp"] == comp["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "roots")
    best = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(named.join(best, "root").select("fp", "root", "component_id"), "fp", "left")


def simhash_near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Every input row with its fingerprint (signed bigint ``fp``) and ``component_id``.

    Texts without words have fingerprint zero and link like any other. A null id takes part
    through its text, and is never a component id unless all ids of the component are null.
    Repeated rows give repeated results. Columns: ``id, key, fp, component_id``.
    """
    return _rooted(docs, id_col, text_col, shingle, max_bits, bucket).select("id", "key", "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest id (nulls last).

    Groups are told apart by their fingerprints, so null or repeated ids merge none. Rows
    repeated whole under that id leave one row.
    """
    near = _rooted(docs, id_col, text_col, **how)
    best = near.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("w"))
    best = best.select(F.col("w.id").alias("_w_id"), F.col("w.key").alias("_w_key"))
    rows = packed(docs, id=F.col(id_col), key=F.xxhash64(text_of(text_col)))
    kept = rows.join(best, F.col("id").eqNullSafe(F.col("_w_id")) & (F.col("key") == F.col("_w_key")), "left_semi")
    return kept.dropDuplicates(["id", "key"]).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = simhash_near_dups(docs, shingle=3, max_bits=3)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
