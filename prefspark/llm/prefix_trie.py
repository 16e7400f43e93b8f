"""Prefix trie of conversations from ternary search trees per range shard (operator 12).

Turns (role, text) are dictionary-encoded: one id for each distinct turn. Conversations become
segments of up to ``SEGMENT`` ids, so no row grows with a conversation; equal segments behind equal
prefixes are one row with their number of conversations. The rows are dealt by range of (prefix,
ids) and sorted; a task cuts its rows into shards of about ``SHARD`` turns and puts each shard into
a ternary search tree, medians first, which keeps it balanced. Walking the tree's nodes from the
last to the first sums members, leaves and savings without recursion.

Nodes that lie in one shard with all their subtree are then final. The others are merged by key:
those on a shard's first or last path (its neighbours may hold them too), those at the end of a
full segment (their subtree goes on in other rows) and those above one. Sums over the subtrees of
the merged nodes come from pointer doubling, in rounds that grow with the logarithm of the depth.

A prefix is named by 128 bits: the exclusive or of two hashes of each (turn id, position), so the
prefix of a later segment follows from its conversation's earlier segments alone. The ids that
end at a node are sorted by range and packed into strings; one task then hashes a node's
few strings one after the other, as SHA-256 asks for, without holding them.

Edge rows: null roles and texts are empty; turns are ordered by ``turn`` (null first), then role
and text; repeated rows are repeated turns; rows with a null id are one conversation, which counts
as a member, but is no smallest member and is not listed at its end; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import SPACE, materialize, release, text_of
from prefspark.operators.ordinal import join_small, null_safe_join
from prefspark.operators.segments import PART_SIZE, split_hot

SEGMENT = 256
SHARD = 200_000
PACK = 512  # ids in one packed string
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = "skeleton boolean, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, top boolean, parent_low bigint, n bigint, low bigint, w bigint, children bigint, leaves bigint, saved bigint, ends string"


def encode_turns(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text", part_size: int = PART_SIZE) -> DataFrame:
    """``(conv, pos, id, words)``: position from 1, dictionary id of (role, text), words of the text.

    Conversations of over ``part_size`` turns are ranked in parts, each a range of ``order_col``.
    """
    role, text = text_of(role_col), text_of(text_col)
    rows = turns.select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(order_col).cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), text, role).alias("t2"),
        F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("bigint").alias("words"),
    )
    entries = rows.groupBy("t1", "t2").agg(F.min("words").alias("words")).withColumn("id", F.monotonically_increasing_id())
    entries = materialize(entries, "turn_ids")
    parts, hot = split_hot(rows, "conv", "turn", part_size)
    rank = F.row_number().over(Window.partitionBy("conv", "part").orderBy(F.asc_nulls_first("turn"), "role", "text")).cast("bigint")
    placed = parts.select("conv", "part", "t1", "t2", rank.alias("pos"))
    if hot:
        sizes = placed.groupBy("conv", "part").agg(F.count("*").alias("c"))
        before = F.coalesce(F.sum("c").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        before = sizes.select("conv", "part", before.alias("before")).where("before > 0")
        placed = join_small(placed, before, ["conv", "part"], "left").withColumn("pos", F.col("pos") + F.coalesce("before", F.lit(0)))
    return placed.join(entries, ["t1", "t2"]).select("conv", "pos", "id", "words")


def segments(encoded: DataFrame, segment: int) -> DataFrame:
    """``(conv, seg, p1, p2, e1, e2, len, turns)``: names of the prefixes before and with the segment."""
    keyed = encoded.withColumns({"seg": F.floor((F.col("pos") - 1) / segment).cast("bigint"), "k1": F.xxhash64("id", "pos"), "k2": F.xxhash64(F.lit(1), "id", "pos")})
    one = F.sort_array(F.collect_list(F.struct("pos", "id", "words", "k1", "k2")))
    rows = keyed.groupBy("conv", "seg").agg(one.alias("turns"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"), F.count("*").alias("len"))
    rows = materialize(rows, "segments")
    # Only conversations of several segments have prefixes.
    several = rows.where("seg > 0").select("conv").distinct()
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = join_small(rows.select("conv", "seg", "x1", "x2"), several, ["conv"], "left_semi")
    prefixes = prefixes.select("conv", "seg", F.bit_xor("x1").over(before).alias("p1"), F.bit_xor("x2").over(before).alias("p2")).where("seg > 0")
    out = join_small(rows, prefixes, ["conv", "seg"], "left")
    out = out.withColumns({"p1": F.coalesce("p1", F.lit(0)), "p2": F.coalesce("p2", F.lit(0))})
    return out.select("conv", "seg", "p1", "p2", F.col("p1").bitwiseXOR(F.col("x1")).alias("e1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("e2"), "len", "turns")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(e1, e2, ends)`` of ``ends(conv, e1, e2)``: SHA-256 of a node's ids in numeric order, joined by commas."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            name = b[["e1", "e2"]].to_numpy()
            conv = b["conv"].to_numpy()
            cut = np.concatenate(([0], np.nonzero((name[1:] != name[:-1]).any(axis=1))[0] + 1, [len(b)]))
            lows = [x for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()) for x in range(lo, hi, PACK)]
            packed = [",".join(map(str, conv[lo : min(hi, lo + PACK)].tolist())) for lo, hi in zip(lows, [*lows[1:], len(b)])]
            yield pd.DataFrame({"e1": name[lows, 0], "e2": name[lows, 1], "first": conv[lows], "ids": pd.Series(packed, dtype=object)})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, digest = None, None
        for b in batches:
            done = []
            for e1, e2, ids in zip(b["e1"].tolist(), b["e2"].tolist(), b["ids"]):
                if (e1, e2) != at:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (e1, e2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["e1", "e2", "ends"])
        if at is not None:
            yield pd.DataFrame([(*at, digest.hexdigest())], columns=["e1", "e2", "ends"])

    rows = ends.where("conv is not null").select("e1", "e2", "conv")
    rows = rows.repartitionByRange("e1", "e2", "conv").sortWithinPartitions("e1", "e2", "conv")
    packs = rows.mapInPandas(pack, "e1 bigint, e2 bigint, first bigint, ids string")
    return packs.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "first").mapInPandas(fold, "e1 bigint, e2 bigint, ends string")


class Tree:
    """Ternary search tree of the sorted segments of one shard, and what its trie nodes sum up to.

    Nodes are numbered as they are made, a trie parent before its children; ``low``, ``high`` and
    ``down`` are the three links, ``down`` leading to the search tree of a node's children.
    """

    def __init__(self, segment: int):
        self.segment = segment
        self.low, self.high, self.down = [], [], []
        self.turn, self.parent, self.depth, self.k1, self.k2, self.w = [], [], [], [], [], []
        self.n, self.least, self.ends, self.cut = [], [], [], []
        self.roots: dict[tuple, int] = {}

    def node(self, turn: int | None, parent: int, depth: int, k1: int, k2: int, w: int | None) -> int:
        for column, value in zip((self.low, self.high, self.down, self.turn, self.parent, self.depth, self.k1, self.k2, self.w), (-1, -1, -1, turn, parent, depth, k1, k2, w)):
            column.append(value)
        for column, value in zip((self.n, self.least, self.ends, self.cut), (0, None, None, False)):
            column.append(value)
        return len(self.n) - 1

    def count(self, v: int, n: int, least: int | None) -> None:
        self.n[v] += n
        if least is not None and (self.least[v] is None or least < self.least[v]):
            self.least[v] = least

    def child(self, v: int, turn: int) -> tuple[list[int], int]:
        """The link (list and place) under which ``turn`` is, or belongs, among the children of ``v``."""
        links, at = self.down, v
        while links[at] >= 0:
            at = links[at]
            if turn == self.turn[at]:
                return links, -1 - at
            links = self.low if turn < self.turn[at] else self.high
        return links, at

    def insert(self, row: dict) -> list[int]:
        """Put a segment in; its path, root first."""
        name = row["seg"], row["p1"], row["p2"]
        v = self.roots.get(name)
        if v is None:
            v = self.roots[name] = self.node(None, -1, row["seg"] * self.segment, row["p1"], row["p2"], None)
            self.cut[v] = True
        if row["seg"] == 0:
            self.count(v, row["n"], row["low"])
        path = [v]
        for t in row["turns"]:
            links, at = self.child(v, t["id"])
            if at < 0:
                v = -1 - at
            else:
                links[at] = new = self.node(t["id"], v, self.depth[v] + 1, self.k1[v] ^ t["k1"], self.k2[v] ^ t["k2"], t["words"])
                v = new
            self.count(v, row["n"], row["low"])
            path.append(v)
        if len(row["turns"]) == self.segment:
            self.cut[v] = True
        self.ends[v] = row["ends"]
        return path

    def rows(self, shared: set[int]) -> dict[str, list]:
        """Columns of ``NODE``; nodes in ``shared`` and above a cut go to the skeleton, with sums over the rest."""
        size = len(self.n)
        skeleton = [c or v in shared for v, c in enumerate(self.cut)]
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        for v in range(size - 1, -1, -1):
            p = self.parent[v]
            if skeleton[v]:
                if p >= 0:
                    skeleton[p] = True
                continue
            leaves[v] += not children[v]
            saved[v] += (self.n[v] - 1) * self.w[v]
            children[p] += 1
            leaves[p] += leaves[v]
            saved[p] += saved[v]
        up = [p if p >= 0 else None for p in self.parent]
        above = [p is not None and skeleton[p] for p in up]
        return {
            "skeleton": skeleton,
            "depth": self.depth,
            "k1": self.k1,
            "k2": self.k2,
            "p1": [None if p is None else self.k1[p] for p in up],
            "p2": [None if p is None else self.k2[p] for p in up],
            "top": above,
            "parent_low": [None if p is None or a else self.least[p] for p, a in zip(up, above)],
            "n": self.n,
            "low": self.least,
            "w": self.w,
            "children": children,
            "leaves": leaves,
            "saved": saved,
            "ends": self.ends,
        }


def medians(n: int) -> Iterator[int]:
    """0..n-1, the median of each range before those of its halves."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


def shard_nodes(rows: list[dict], segment: int) -> dict[str, list]:
    tree = Tree(segment)
    shared: set[int] = set()
    for k in medians(len(rows)):
        path = tree.insert(rows[k])
        if k in (0, len(rows) - 1):
            shared.update(path)
    return tree.rows(shared)


def tree_nodes(distinct: DataFrame, segment: int, shard: int) -> DataFrame:
    """``NODE`` rows of every shard of ``distinct(seg, p1, p2, ids, turns, n, low, ends)``."""
    schema = pa.schema([(f.split()[0], {"boolean": pa.bool_(), "bigint": pa.int64(), "string": pa.string()}[f.split()[1]]) for f in NODE.split(", ")])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for lo in range(0, len(batch), 256):
                for row in batch.slice(lo, 256).to_pylist():
                    rows.append(row)
                    size += len(row["turns"])
                    if size >= shard:
                        yield pa.RecordBatch.from_pydict(shard_nodes(rows, segment), schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict(shard_nodes(rows, segment), schema)

    order = ["seg", "p1", "p2", "ids"]
    return distinct.repartitionByRange(*order).sortWithinPartitions(*order).drop("ids").mapInArrow(walk, NODE)


def subtree_sums(skeleton: DataFrame) -> DataFrame:
    """``leaves`` and ``saved`` of ``skeleton(k1, k2, u1, u2, ..)`` summed over all nodes below, by pointer doubling."""
    rows = materialize(skeleton.select("k1", "k2", "u1", "u2", "leaves", "saved"), "skeleton_sums")
    while not (linked := rows.where("u1 is not null")).isEmpty():
        add = linked.groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        up = linked.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        out = rows.join(add, ["k1", "k2"], "left").join(up, ["u1", "u2"], "left")
        zero = F.lit(0).cast("bigint")
        before, rows = rows, materialize(
            out.select("k1", "k2", F.col("v1").alias("u1"), F.col("v2").alias("u2"), (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved")),
            "skeleton_sums",
        )
        release(before)
    return rows.select("k1", "k2", "leaves", "saved")


def trie(encoded: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """Nodes of the trie of ``encoded(conv, pos, id, words)``; ``convs(conv)`` lists all conversations, also turnless ones.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.
    """
    zero = F.lit(0).cast("bigint")
    segs = materialize(segments(encoded, segment), "prefixed_segments")
    own = segs.groupBy("conv").agg(F.max(F.struct("seg", "e1", "e2")).alias("last")).select("conv", F.col("last.e1").alias("e1"), F.col("last.e2").alias("e2"))
    everyone = convs.select("conv").distinct()
    ends = materialize(null_safe_join(everyone, own, ["conv"], "left").select("conv", F.col("e1").isNull().alias("turnless"), F.coalesce("e1", zero).alias("e1"), F.coalesce("e2", zero).alias("e2")), "ends")
    digests = materialize(end_digests(ends), "end_digests")

    distinct = segs.groupBy("seg", "p1", "p2", "e1", "e2", "len").agg(F.count("*").alias("n"), F.min("conv").alias("low"), F.first("turns").alias("turns"))
    distinct = distinct.join(digests, ["e1", "e2"], "left")
    distinct = materialize(distinct.select("seg", "p1", "p2", F.col("turns.id").alias("ids"), F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"), t["k1"].alias("k1"), t["k2"].alias("k2"))).alias("turns"), "n", "low", "ends"), "distinct_segments")
    nodes = tree_nodes(distinct, segment, shard)
    root = ends.where("turnless").agg(F.count("*").alias("n"), F.min("conv").alias("low")).where("n > 0").select("*", zero.alias("e1"), zero.alias("e2")).join(digests, ["e1", "e2"], "left")
    null = F.lit(None).cast("bigint")
    root = root.select(F.lit(True), zero, "e1", "e2", null, null, F.lit(False), null, "n", "low", null, zero, zero, zero, "ends").toDF(*[f.split()[0] for f in NODE.split(", ")])
    nodes = materialize(nodes.unionByName(root), "shard_nodes")

    merged = nodes.where("skeleton").groupBy("k1", "k2").agg(
        *[F.max(c).alias(c) for c in ("depth", "p1", "p2", "w", "ends")], *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("low").alias("low")
    )
    merged = materialize(merged, "skeleton_nodes")
    below = merged.where("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("more"))
    merged = merged.join(below, ["k1", "k2"], "left").withColumn("children", F.col("children") + F.coalesce("more", zero)).drop("more")
    merged = merged.withColumns({"leaves": F.col("leaves") + (F.col("children") == 0).cast("bigint"), "saved": F.col("saved") + F.coalesce((F.col("n") - 1) * F.col("w"), zero)})
    merged = materialize(merged, "skeleton_own")
    sums = subtree_sums(merged.withColumnsRenamed({"p1": "u1", "p2": "u2"}))
    merged = merged.drop("leaves", "saved").join(sums, ["k1", "k2"])
    parents = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("low").alias("parent_low"))
    merged = merged.join(parents, ["p1", "p2"], "left")

    inner = nodes.where("not skeleton")
    tops = join_small(inner.where("top").drop("parent_low"), parents, ["p1", "p2"], "left")
    columns = [
        F.col("low").alias("conv_id"), "depth", F.col("parent_low").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]
    return merged.select(*columns).unionByName(tops.select(*columns)).unionByName(inner.where("not top").select(*columns))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text", **how) -> DataFrame:
    """The prefix trie of the conversations of ``turns``; see ``trie``."""
    encoded = materialize(encode_turns(turns, conv_col, order_col, role_col, text_col), "turns")
    return trie(encoded, encoded.select("conv"), **how)


def rebuilt(encoded: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """Conversations whose first h turns are those of conversation c - c % ``family``; h is crc32(c) % ``heads``.

    With fewer turns there, all of them; then follow the conversation's own turns after its first h.
    """
    h = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % heads, F.lit(0))
    source = F.col("conv") - F.col("conv") % family
    sizes = encoded.groupBy("conv").agg(F.count("*").alias("size")).withColumns({"h": h, "source": source})
    lent = sizes.select(F.col("conv").alias("source"), F.col("size").alias("lent"))
    short = sizes.join(lent, "source", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0)))).where("lent < h").select("conv", "lent")
    own = join_small(encoded.withColumn("h", h).where("pos > h"), short, ["conv"], "left")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.coalesce("lent", "h")).alias("pos"), "id", "words")
    first = encoded.where(F.col("pos") < heads).select(F.col("conv").alias("source"), "pos", "id", "words")
    first = sizes.where("h > 0").select("conv", "h", "source").join(first, "source").where("pos <= h")
    return first.select("conv", "pos", "id", "words").unionByName(own)


def query(spark, sf_dir: str) -> DataFrame:
    encoded = materialize(encode_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    return trie(rebuilt(encoded), encoded.select("conv"))


def oracle() -> str:
    """DuckDB: prefixes by a running list of turn digests, subtrees by ancestor pairs of each conversation."""
    return r"""
with recursive crc_table as (
  select list(list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by b) as t
  from range(256) as r(b)
), turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
    md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) as id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations
), convs as (
  select conv_id, conv_id - conv_id % 20 as source, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(string_split(conv_id::varchar, ''), lambda c: unicode(c)::bigint)), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) % 4 as h
  from (select distinct conv_id from conversations), crc_table
), parts as (
  select c.conv_id, 0 as part, pos, id, words from convs c join turns t on t.conv_id = c.source and t.pos <= c.h
  union all
  select c.conv_id, 1, pos, id, words from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
), placed as (
  select conv_id, row_number() over w as depth, md5(array_to_string(list(id) over w, ',')) as k, words from parts window w as (partition by conv_id order by part, pos)
), paths as (
  select conv_id, depth, k, words from placed union all select conv_id, 0, '', 0 from convs
), linked as (
  select *, lag(k) over (partition by conv_id order by depth) as up, lead(k) over (partition by conv_id order by depth) is null as last from paths
), nodes as (
  select k, min(depth) as depth, min(up) as up, min(words) as words, count(*) as n, min(conv_id) as low,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends
  from linked group by k
), childless as (
  select n.*, (select count(*) from nodes c where c.up = n.k) as children from nodes n
), below as (
  select distinct a.k as top, b.k from paths a join paths b on a.conv_id = b.conv_id and a.depth <= b.depth
), sums as (
  select top, sum((children = 0)::bigint) as leaves, sum((n - 1) * words) as saved from below join childless using (k) group by top
)
select c.low as conv_id, c.depth, p.low as parent_conv_id, c.n as n_convs, c.children as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, c.ends as ends_sha256
from childless c join sums on sums.top = c.k left join nodes p on p.k = c.up
"""
