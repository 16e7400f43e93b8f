"""Benchmark decontamination by SimHash of item-sized windows (operator 5).

Words are lower-cased (A-Z) and cut at white space; shingles are five words (an item of fewer
words is one shingle). A shingle weighs by its rarity among the items; one that no item holds
weighs most. For each item length the windows of that many words get a weighted 64-bit SimHash.
A multi-index over the items' fingerprints (``radius + 1`` blocks: two fingerprints within the
radius agree on one of them) yields every item of that length within the radius, and the exact
weighted Jaccard similarity of the shingle multisets, 0.8 or more, decides.

A window that shares no shingle with an item has similarity 0, so only windows around a shared
shingle are fingerprinted. Documents are read once, in place, without a shuffle. Items go to the
workers in passes of at most ``PASS_BYTES`` of text, one read of the documents for each. Weights
are those of the whole benchmark in every pass (only shingles of several items differ from the
largest weight, and only these travel with each pass), so passes change no result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import chunks, encode, map_with_ids, packed, text_of, window_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 two fingerprints differ in 10 bits on average, with a deviation of 3.
RADIUS = 20
PASS_BYTES = 32 << 20


def weighted_simhash_sums(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Running sums of the signed bit votes of shingles: one row more than shingles."""
    bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64)
    out = np.zeros((len(h) + 1, 64), np.int64)
    np.cumsum((2 * bits - 1) * weight[:, None], axis=0, out=out[1:])
    return out


def sign_bits(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1).view(">u8").ravel().astype(np.uint64)


class Items:
    """A bounded set of benchmark items, ready to be probed."""

    def __init__(self, ids: list, texts: list[str], radius: int, total: int, common: np.ndarray, df: np.ndarray) -> None:
        """``total``: non-empty items of all passes; ``common``: sorted shingles that ``df`` of them hold, two or more."""
        hashes = [word_hashes(encode(t).lower()) for t in texts]
        keep = [i for i, h in enumerate(hashes) if len(h)]
        self.ids = [ids[i] for i in keep]
        words = [hashes[i] for i in keep]
        self.length = np.array([len(w) for w in words], np.int64)
        self.unit = np.minimum(self.length, SHINGLE)
        self.shingles = [np.unique(window_hashes(w, int(k)), return_counts=True) for w, k in zip(words, self.unit)]
        every = np.concatenate([s[0] for s in self.shingles]) if keep else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(keep)), [len(s[0]) for s in self.shingles]) if keep else np.empty(0, np.int64)
        self.known = np.unique(every)
        self.common, self.idf = common, np.round(8 * np.log2(1 + max(1, total) / df)).astype(np.int64)
        self.rare = round(8 * math.log2(1 + max(1, total)))  # of a shingle that one item holds, or none
        # Sizes (unit, length) of the items that hold a known shingle.
        pairs = np.unique(np.column_stack([np.searchsorted(self.known, every), self.unit[owner], self.length[owner]]), axis=0) if keep else np.empty((0, 3), np.int64)
        self.sizes, self.size_begin = pairs[:, 1:], np.searchsorted(pairs[:, 0], np.arange(len(self.known) + 1))
        prints = []
        for w, k in zip(words, self.unit):
            h = window_hashes(w, int(k))
            prints.append(sign_bits(weighted_simhash_sums(h, self.weight(h))[-1:])[0])
        self.prints = np.array(prints, np.uint64)
        self.radius = radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.masks = [np.uint64(((1 << int(b)) - (1 << int(a)))) for a, b in zip(edges, edges[1:])]
        self.by_length = {int(n): np.nonzero(self.length == n)[0] for n in np.unique(self.length)}

    def weight(self, h: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(h), self.rare)
        at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
        return np.where(self.common[at] == h, self.idf[at], self.rare)

    def within(self, prints: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, by equal blocks."""
        own = self.by_length[length]
        found = []
        for m in self.masks:
            block = self.prints[own] & m
            order = np.argsort(block, kind="stable")
            lo = np.searchsorted(block[order], prints & m, "left")
            n = np.searchsorted(block[order], prints & m, "right") - lo
            w = np.repeat(np.arange(len(prints)), n)
            k = np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            i = own[order[k]]
            near = np.bitwise_count(prints[w] ^ self.prints[i]) <= self.radius
            found.append(w[near] * len(self.ids) + i[near])
        both = np.unique(np.concatenate(found))
        return both // len(self.ids), both % len(self.ids)

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of a window's shingles and an item's."""
        keys, n = np.unique(window, return_counts=True)
        other, m = self.shingles[item]
        both, a, b = np.intersect1d(keys, other, assume_unique=True, return_indices=True)
        shared = int((np.minimum(n[a], m[b]) * self.weight(both)).sum())
        total = int((n * self.weight(keys)).sum() + (m * self.weight(other)).sum()) - shared
        return shared / total if total else 0.0


def shingle_counts(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of non-empty items, the shingles that two or more of them hold, and how many do."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [h for h in (word_hashes(encode(t).lower()) for t in b["text"]) if len(h)]
            held = [np.unique(window_hashes(h, min(len(h), SHINGLE))) for h in words]
            keys, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
            yield pd.DataFrame({"h": np.append(keys.view(np.int64), 0), "n": np.append(n, len(words)), "items": [False] * len(keys) + [True]})

    counts = items.select("text").mapInPandas(each, "h bigint, n bigint, items boolean").groupBy("items", "h").agg(F.sum("n").alias("n"))
    rows = counts.where("items or n > 1").collect()
    common = sorted((r["h"] % 2**64, r["n"]) for r in rows if not r["items"])
    total = sum(r["n"] for r in rows if r["items"])
    return total, np.array([k for k, _ in common], np.uint64), np.array([n for _, n in common], np.int64)


def probe(texts, items: Items, similarity: float) -> Iterator[tuple]:
    """``(text, item, first word, words, hamming, similarity)``: the best window of each pair."""
    best: dict[tuple[int, int], tuple] = {}
    for c in chunks(texts, lower=True):
        for unit in np.unique(items.unit).tolist():
            h, at = c.windows(unit)
            if not len(h):
                continue
            k = np.minimum(np.searchsorted(items.known, h), len(items.known) - 1)
            hit = np.nonzero(items.known[k] == h)[0]
            if not len(hit):
                continue
            # Every (hit, item size): windows whose shingles include the hit, inside the text.
            n = (items.size_begin[k[hit] + 1] - items.size_begin[k[hit]])
            row = np.repeat(items.size_begin[k[hit]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            where, size = at[np.repeat(hit, n)], items.sizes[row]
            own = size[:, 0] == unit
            where, length = where[own], size[own, 1]
            shingle_at = np.full(len(c.words) + 1, -1)
            shingle_at[at] = np.arange(len(at))
            for one in np.unique(length).tolist():
                p = np.unique(where[length == one])
                d = c.doc[p]
                begin, end = c.first[d], c.first[d + 1]
                reach = np.arange(one - unit + 1)
                s = p[:, None] - reach[None, :]
                s = np.where(s >= begin[:, None], s, begin[:, None])
                s = np.unique(s)
                e = np.minimum(s + one, c.first[c.doc[s] + 1])
                used = covered_range(s, e - unit + 1, len(c.words))
                spots = np.nonzero(used)[0]
                place = np.cumsum(used) - 1
                hs = h[shingle_at[spots]]
                sums = weighted_simhash_sums(hs, items.weight(hs))
                prints = sign_bits(sums[place[e - unit] + 1] - sums[place[s]])
                for w, i in zip(*items.within(prints, one)):
                    window = hs[place[s[w]] : place[e[w] - unit] + 1]
                    sim = items.similarity(window, i)
                    if sim >= similarity:
                        doc = int(c.doc[s[w]])
                        start = int(s[w] - c.first[doc])
                        new = (-sim, start, int(e[w] - s[w]), int(np.bitwise_count(prints[w] ^ items.prints[i])))
                        key = (c.lo + doc, int(i))
                        if key not in best or new < best[key]:
                            best[key] = new
    for (doc, i), (sim, start, size, bits) in sorted(best.items()):
        yield doc, items.ids[i], start, size, bits, -sim


def covered_range(lo: np.ndarray, hi: np.ndarray, total: int) -> np.ndarray:
    edge = np.bincount(lo, minlength=total + 1) - np.bincount(hi, minlength=total + 1)
    return np.cumsum(edge)[:total] > 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(id, tag, item_id, start, n_words, hamming, similarity)``: one row per row and item found.

    ``tag`` is a hash of the row's text. Null or empty texts and items match nothing; repeated
    rows and items repeat their result. An empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("tag"), text_of(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), text_of(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    passes = max(1, math.ceil(size / pass_bytes))
    total, common, df = shingle_counts(items)
    kind, item_kind = rows.schema["id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    out = None
    for p in range(passes):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).orderBy("item_id", "text").collect()  # at most about PASS_BYTES
        # Pickled by value: workers need not have this package.
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(Items([r["item_id"] for r in own], [r["text"] for r in own], radius, total, common, df)))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            held = cloudpickle.loads(shared.value)
            for b in batches:
                got = list(probe(b["text"], held, similarity)) if held.ids else []
                if got:
                    k = [g[0] for g in got]
                    yield pd.DataFrame({"id": b["id"].array.take(k), "tag": b["tag"].to_numpy()[k], **{n: [g[j + 1] for g in got] for j, n in enumerate(("item_id", "start", "n_words", "hamming", "similarity"))}})

        found = map_with_ids(rows, run, f"id {kind}, tag bigint, item_id {item_kind}, start bigint, n_words bigint, hamming int, similarity double")
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that hold an item of the benchmark."""
    bad = contaminated(docs, benchmark, id_col, text_col, **how).select(F.col("id").alias("_b_id"), F.col("tag").alias("_b_tag")).distinct()
    rows = packed(docs, id=F.col(id_col), tag=F.xxhash64(text_of(text_col)))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("_b_id")) & (F.col("tag") == F.col("_b_tag")), "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(docs, items).select(F.col("id").alias("doc_id"), "item_id", "start", "n_words", "hamming", "similarity")
