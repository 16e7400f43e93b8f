"""MinHash near-duplicates with banding, signature and set verification (operator 13).

A document's set are its distinct ``shingle``-word shingles (with fewer words, the whole sequence
as one; without words, the empty set, which links with nothing), as 64-bit hashes. Documents link
if 100 * intersection >= ``percent`` * union.

1. Equal sets are one member. Every member gets ``BANDS * ROWS`` minima under universal
   (multiply-shift) hashes; its bands are the equi-join keys. A pair of similarity 0.85 agrees on
   no band with probability (1 - 0.85**5)**32 = 7e-9, a closer pair less.
2. In every band bucket all members meet the bucket's leader, the member that meets most others in
   its buckets: one pair a member, whatever the bucket's size. Pairs whose signatures agree on at
   least ``SURE`` of the minima are verified on the full sets; verified links give first components.
3. Buckets that still hold several components are searched in full for links between different
   components: the members outside the bucket's largest component against all of it, in blocks of
   at most about ``BLOCK`` members and ``WEIGHT`` shingles a side. A task holds the full sets of a block, counts
   intersections on bit rows over the shingles that stand in two or more of them, and emits only
   links that join components of the block: at most one less than its members, never its pairs.
4. Components of all links by alternating large-star and small-star.

Pairs within a first component are not looked at, so a group of copies costs links in proportion to
its size; no bucket, partner or candidate is capped. A set that many pairs need goes to them in
lots of about ``LOT`` pairs. A pair of similarity 0.85 shows fewer than ``SURE`` of 160 equal minima
with probability 2e-10 (binomial tail).

Edge rows: null text is empty text; a null id takes part through its text and is a component id
only where all ids of a component are null; documents with an empty set are components of their
own; repeated rows give repeated results; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import chunks, connected_components, materialize, mix, text_of, window_hashes
from prefspark.operators.ordinal import checked_small, join_small

BANDS = 32
ROWS = 5
SURE = 0.65
BLOCK = 1024
WEIGHT = 1 << 20
LOT = 256


def coefficients(n: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` multiply-shift hashes."""
    rng = np.random.default_rng(13)
    return rng.integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**64, n, dtype=np.uint64)


def sets_of(c, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk's texts, sorted by text and hash, and the text of each."""
    size = np.diff(c.first)
    h, at = c.windows(shingle)
    short = np.nonzero((size > 0) & (size < shingle))[0]
    whole = [window_hashes(c.words[c.first[k] : c.first[k + 1]], int(size[k])) ^ np.uint64(size[k]) for k in short.tolist()]
    h = np.concatenate([h, *whole])
    doc = np.concatenate([c.doc[at], short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new]


def minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima, one row for each of the sets that start at ``starts``, under every hash."""
    a, b = coefficients()
    out = np.empty((len(starts), len(a)), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(len(a)):
            out[:, i] = np.minimum.reduceat(((h * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit key of each band, the band's number mixed in; one row a signature."""
    part = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS))
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part[:, :, r])
    return out


def _lists(flat: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat.view(np.int64)))


def described(rows: DataFrame, shingle: int, full: bool) -> DataFrame:
    """``rows(.., text)`` with the text replaced by its set: size ``n`` and name ``k1, k2``, then the
    ``hashes`` themselves (``full``) or signature and band keys. Other columns pass through Arrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in chunks((t.as_py() for t in batch["text"]), lower=True):
                h, doc = sets_of(c, shingle)
                n = np.bincount(doc, minlength=c.hi - c.lo)
                ends = np.concatenate(([0], np.cumsum(n)))
                some = np.nonzero(n)[0]
                names = np.zeros((2, len(n)), np.uint64)
                if len(some):
                    with np.errstate(over="ignore"):
                        for k, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
                            names[k, some] = mix(np.add.reduceat(mix(h ^ np.uint64(salt)), ends[some]) + n[some].astype(np.uint64))
                out = {k: batch[k].slice(c.lo, c.hi - c.lo) for k in batch.schema.names if k != "text"}
                out |= {"n": pa.array(n.astype(np.int64)), "k1": pa.array(names[0].view(np.int64)), "k2": pa.array(names[1].view(np.int64))}
                if full:
                    out["hashes"] = _lists(h, ends)
                else:
                    sig = np.zeros((len(n), BANDS * ROWS), np.uint32)
                    if len(some):
                        sig[some] = minima(h, ends[some])
                    out["sig"] = pa.array([s.tobytes() for s in sig], pa.binary())
                    out["bands"] = _lists(band_keys(sig).ravel(), np.arange(len(n) + 1) * BANDS)
                yield pa.RecordBatch.from_pydict(out)

    keep = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    extra = "hashes array<bigint>" if full else "sig binary, bands array<bigint>"
    return rows.mapInArrow(run, f"{keep}, n bigint, k1 bigint, k2 bigint, {extra}")


def attach(pairs: DataFrame, side: str, payload: DataFrame, names: dict[str, str]) -> DataFrame:
    """``payload(m, ..)`` joined to ``pairs`` by column ``side``, renamed by ``names``; a member of many pairs goes to them in lots."""
    many = pairs.groupBy(F.col(side).alias("m")).agg(F.count("*").alias("c")).where(F.col("c") > LOT)
    many, small = checked_small(many.select("m", F.ceil(F.col("c") / LOT).cast("int").alias("lots")))
    many = F.broadcast(many) if small else many
    spread = pairs.join(many.select(F.col("m").alias(side), "lots"), side, "left").withColumn("lot", F.pmod(F.xxhash64("a", "b"), F.coalesce("lots", F.lit(1))).cast("int")).drop("lots")
    copies = payload.join(many, "m", "left").withColumn("lot", F.explode(F.sequence(F.lit(0), F.coalesce("lots", F.lit(1)) - 1))).drop("lots")
    return spread.join(copies.withColumnsRenamed({"m": side, **names}), [side, "lot"]).drop("lot")


def agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose signatures agree on at least ``SURE`` of the minima."""
    least = SURE * BANDS * ROWS

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[c]), np.uint32).reshape(len(b), -1) for c in ("sig_a", "sig_b"))
            yield b.loc[(x == y).sum(axis=1) >= least, ["a", "b"]]

    sig = sets.select("m", "sig")
    both = attach(attach(pairs, "a", sig, {"sig": "sig_a"}), "b", sig, {"sig": "sig_b"})
    return both.mapInPandas(compare, "a bigint, b bigint")


def full_sets(members: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``(m, n, hashes)`` of ``members(m)``, made again from one text of each."""
    own = materialize(members.distinct().join(sets.select("m", "t", "k1", "k2"), "m"), "asked_members")
    held = described(join_small(texts, own.select("t").distinct(), ["t"], "left_semi"), shingle, full=True)
    held = held.dropDuplicates(["k1", "k2"]).join(own.select("m", "k1", "k2"), ["k1", "k2"])
    return materialize(held.select("m", "n", "hashes"), "full_sets")


def verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs that link by their full sets."""
    held = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("m")), sets, texts, shingle)
    both = attach(attach(pairs, "a", held, {"n": "n_a", "hashes": "h_a"}), "b", held, {"n": "n_b", "hashes": "h_b"})
    both = both.where(f"least(n_a, n_b) * 100 >= {percent} * greatest(n_a, n_b)")
    both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("total"), F.size(F.array_intersect("h_a", "h_b")).cast("bigint").alias("both"))
    return both.where(f"100 * both >= {percent} * (total - both)").select("a", "b")


def bit_rows(flat: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """One bit row for each of ``n`` sets, a bit for each hash of ``flat`` that several sets hold."""
    _, column, held = np.unique(flat, return_inverse=True, return_counts=True)
    several = held > 1
    column = (np.cumsum(several) - 1)[column[keep := several[column]]]
    out = np.zeros((n, max(1, -(-int(several.sum()) // 64))), np.uint64)
    np.bitwise_or.at(out, (of[keep], column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    return out


def block_links(m: np.ndarray, root: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between components of a block that join them; members of side 0 meet all others."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    rows = bit_rows(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), len(sets))
    _, label = np.unique(root, return_inverse=True)
    found = []
    for x in np.nonzero(side == 0)[0].tolist():
        other = np.nonzero(label != label[x])[0]
        shared = np.bitwise_count(rows[other] & rows[x]).sum(axis=1, dtype=np.int64)
        for y in other[100 * shared >= percent * (n[other] + n[x] - shared)].tolist():
            if label[y] != label[x]:
                found.append((int(m[x]), int(m[y])))
                label[label == label[y]] = label[x]
    return found


def cross_links(groups: DataFrame, percent: int) -> DataFrame:
    """Links between members of different components in the blocks ``(key, i, j)`` of ``groups``."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def linked() -> list[tuple[int, int]]:
            m, root, side = (np.array([r[c] for r in rows], np.int64) for c in range(3))
            return block_links(m, root, side, [r[3] for r in rows], percent) if len(rows) > 1 else []

        for b in batches:
            out = []
            flat, edge = b["hashes"].flatten().to_numpy(), b["hashes"].offsets.to_numpy()
            edge = edge - edge[0]
            for k, (key, i, j, m, root, side) in enumerate(zip(*[b[c].to_pylist() for c in ("key", "i", "j", "m", "root", "side")])):
                if (key, i, j) != at:
                    out += linked()
                    at, rows = (key, i, j), []
                rows.append((m, root, side, flat[edge[k] : edge[k + 1]]))
            # What is kept for the next batch must not hold this one's buffers.
            rows = [(*r[:3], r[3].copy()) for r in rows]
            yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})
        out = linked()
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    dealt = groups.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(walk, "a bigint, b bigint")


def blocked(mixed: DataFrame, block: int) -> DataFrame:
    """``mixed(key, m, root, main, n_main, n_rest, w_main, w_rest)`` dealt to blocks ``(key, i, j)``.

    Members outside the main component are cut into parts i, each of which meets every part of
    the main component (j >= 0) and every part of its own kind (j < 0) from itself on.
    """
    lots = lambda k: F.greatest(F.ceil(F.col(f"n_{k}") / block), F.ceil(F.col(f"w_{k}") / WEIGHT)).cast("int")
    parts = mixed.withColumns({"mains": lots("main"), "rests": lots("rest")})
    own = F.pmod(F.xxhash64("m"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("rests"))).cast("int")
    parts = parts.withColumn("own", own)
    # A main part meets all parts i of the rest; one block holds a small bucket whole.
    small = (F.col("n_main") + F.col("n_rest") <= block) & (F.col("w_main") + F.col("w_rest") <= WEIGHT)
    blocks = F.when(small, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("main").cast("int").alias("side"))))
    blocks = blocks.when(F.col("main"), F.transform(F.sequence(F.lit(0), F.col("rests") - 1), lambda i: F.struct(i.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"))))
    meets = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: F.struct(F.col("own").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    peers = F.transform(
        F.sequence(F.lit(0), F.col("rests") - 1),
        lambda k: F.struct(F.least(F.col("own"), k).alias("i"), (-1 - F.greatest(F.col("own"), k)).alias("j"), (F.col("own") > k).cast("int").alias("side")),
    )
    return parts.select("key", "m", "root", F.explode(blocks.otherwise(F.concat(meets, peers))).alias("e")).select("key", "m", "root", "e.*")


def set_links(sets: DataFrame, texts: DataFrame, shingle: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what all linked pairs of ``sets`` connect."""
    keys = sets.where("n > 0").select("m", "n", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = materialize(keys.join(buckets, "key"), "shared_bands")
    met = shared.groupBy("m").agg(F.sum("c").alias("met"))
    leaders = shared.select("key", "m").join(met, "m").groupBy("key").agg(F.max(F.struct("met", (-F.col("m")).alias("m"))).alias("top"))
    leaders = leaders.select("key", (-F.col("top.m")).alias("leader"))
    pairs = shared.join(leaders, "key").where("m <> leader").select(F.col("leader").alias("a"), F.col("m").alias("b")).distinct()
    tried = materialize(agreeing(materialize(pairs, "leader_pairs"), sets), "agreeing_leaders")
    links = materialize(verified(tried, sets, texts, shingle, percent), "leader_links")
    roots = connected_components(links)

    rooted = shared.join(roots.withColumnRenamed("node", "m"), "m", "left").select("key", "m", "n", F.coalesce("root", "m").alias("root"))
    comps = rooted.groupBy("key", "root").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    open_keys = comps.groupBy("key").agg(F.max(F.struct("c", "root", "w")).alias("top"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.count("*").alias("n")).where("n > 1")
    open_keys = open_keys.select("key", F.col("top.root").alias("top"), F.col("top.c").alias("n_main"), (F.col("c") - F.col("top.c")).alias("n_rest"), F.col("top.w").alias("w_main"), (F.col("w") - F.col("top.w")).alias("w_rest"))
    mixed = rooted.drop("n").join(open_keys, "key").withColumn("main", F.col("root") == F.col("top"))
    groups = materialize(blocked(mixed, block), "open_blocks")
    held = full_sets(groups.select("m"), sets, texts, shingle).select("m", "hashes")
    return links.unionByName(materialize(cross_links(groups.join(held, "m"), percent), "cross_links"))


def minhash_near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """``(id, n_shingles, component_id)`` of every input row; component_id is the smallest id that links reach.

    ``percent`` is the least similarity of a link in hundredths (85 or more: the bands are laid out for it).
    """
    if not 85 <= percent <= 100:
        raise ValueError("percent must lie between 85 and 100")
    texts = docs.select(F.xxhash64(text_of(text_col)).alias("t"), text_of(text_col).alias("text"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("t"), text_of(text_col).alias("text"))
    rows = materialize(described(rows, shingle, full=False), "signatures")
    sets = rows.groupBy("k1", "k2").agg(F.min("id").alias("low"), F.min("t").alias("t"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    sets = materialize(sets.withColumn("m", F.monotonically_increasing_id()), "sets")
    comp = connected_components(set_links(sets, texts, shingle, percent, block))
    named = sets.join(comp, sets["m"] == comp["node"], "left").select("k1", "k2", "low", F.coalesce("root", "m").alias("root"))
    named = materialize(named, "set_roots")
    best = named.groupBy("root").agg(F.min("low").alias("component_id"))
    out = rows.select("id", "n", "k1", "k2").join(named.join(best, "root").select("k1", "k2", "component_id"), ["k1", "k2"], "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = minhash_near_dups(docs, shingle=5, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def oracle() -> str:
    """DuckDB: shingle sets as strings, intersections by an equi-join, components by a recursive walk."""
    return r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, hash(s) as h, s from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)
), edges as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id, doc_id as seen from documents
  union
  select r.doc_id, e.b from reach r join edges e on e.a = r.seen
), low as (
  select doc_id, min(seen) as component_id from reach group by doc_id
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join low using (doc_id) left join sizes using (doc_id)
"""
