"""Spelling variants by Bloom-guided neighbourhoods (operator 11).

Two words are near if one code point inserted, deleted or replaced makes one into the other. Every
word probes its generated edits against blocked Bloom filters of the vocabulary, one filter per
word length, which are broadcast to the workers; only edits that the filter answers with yes are
turned into strings and shuffled to an exact join with the vocabulary, which drops the filter's
false positives. A filter has no false negatives, so every near pair is found.

Each unordered pair is generated once and mirrored after the join: an insertion is the deletion of
the longer word, and a replacement is made only towards the larger code point. An edit's hash
comes from running sums of its word's hash (polynomial over code points), so no string is built
for a probe. The replaced code points are those of the vocabulary.

Sizes: a filter takes 16 bits a word. Up to ``PASS_BYTES`` of filters travel at once; a larger
vocabulary is probed in several passes, each with every ``passes``-th block, and the results of the
passes are united, so they do not depend on that bound. Words of over ``LENGTHS`` code points share
one filter. Every shuffle is by word; a word has at most (length x alphabet) near words.

Edge rows: a null text has no words, an empty vocabulary gives an empty result, a null id counts
as an empty string where ids are used (``count_words``), repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import materialize, mix, release, strings, text_of

RUNS = "[A-Za-zÀ-ÿ]+"
LENGTHS = 64
BITS = 16  # filter bits per word
PROBES = 6
BLOCK = 512  # bits
PASS_BYTES = 64 << 20
CHUNK = 4096  # 64-bit filter words in a collected row
TASK_WORDS = 8192
_K = 0x9E3779B97F4A7C15
_K1 = pow(_K, -1, 1 << 64)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None, min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """``(word, n)``: lower-cased letter runs of at least ``min_chars`` that occur ``min_count`` times.

    With ``noise``, a run loses one code point where that number divides h, the crc32 of
    ``<id>:<run>``: the one at h modulo the run's length. A null id stands as an empty string.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUNS), F.lit(0))).alias("r"))
    runs = runs.select("i", lower_ascii(F.col("r")).alias("word")).where(F.length("word") >= min_chars)
    if noise:
        h = F.crc32(F.concat("i", F.lit(":"), "word").cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("word")).alias("word"))
        runs = runs.where(F.length("word") >= min_chars)
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), -1)


def values(cps: np.ndarray) -> np.ndarray:
    return mix(cps.astype(np.uint64) + np.uint64(0x51ED270B))


def word_powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.array([1] + [_K] * n, np.uint64))


def same_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Lots ``(length, positions)`` of words of one length, with bounded code points."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes).tolist():
        at = np.nonzero(sizes == size)[0]
        step = max(1, min(TASK_WORDS, (1 << 22) // max(1, size)))
        for i in range(0, len(at), step):
            yield size, at[i : i + step]


def hashes(words: list[str]) -> np.ndarray:
    out = np.empty(len(words), np.uint64)
    for size, at in same_length(words):
        with np.errstate(over="ignore"):
            out[at] = (values(points([words[i] for i in at.tolist()])) * word_powers(size)[None, :size]).sum(axis=1, dtype=np.uint64)
    return out


def slots(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each word hash, and a second hash from which its bits in the block are drawn."""
    h = mix(h)
    return (h >> np.uint64(20)) % np.uint64(blocks), mix(h ^ np.uint64(0xD1B54A32D192ED03))


def bit(second: np.ndarray, p: int) -> np.ndarray:
    return (second >> np.uint64(9 * p)) & np.uint64(BLOCK - 1)


def probe(h: np.ndarray, blocks: int, words: np.ndarray, part: int, passes: int) -> np.ndarray:
    """Positions of the hashes that the filter's ``part`` (of ``passes``) answers with yes."""
    block, second = slots(h, blocks)
    at = np.arange(len(h))
    if passes > 1:
        at = np.nonzero(block % np.uint64(passes) == np.uint64(part))[0]
        block, second = block[at], second[at]
    base = block // np.uint64(passes) * np.uint64(BLOCK // 64)
    for p in range(PROBES):
        b = bit(second, p)
        yes = (words[base + (b >> np.uint64(6))] >> (b & np.uint64(63)) & np.uint64(1)).astype(bool)
        at, base, second = at[yes], base[yes], second[yes]
    return at


def edits(words: list[str], alphabet: np.ndarray, answers) -> Iterator[tuple[np.ndarray, list[str]]]:
    """``(positions of words, edited words)`` of the edits that ``answers(length, hashes)`` lets pass."""
    letters = values(alphabet)
    for size, at in same_length(words):
        cps = points([words[i] for i in at.tolist()])
        vals, power = values(cps), word_powers(size)
        with np.errstate(over="ignore"):
            terms = vals * power[None, :size]
            whole = terms.sum(axis=1, dtype=np.uint64)
            before = np.zeros(len(at), np.uint64)
            for j in range(size):
                rest = whole - before - terms[:, j]
                # One of a run of equal code points stands for all of them.
                own = np.arange(len(at)) if j == 0 else np.nonzero(cps[:, j] != cps[:, j - 1])[0]
                hit = own[answers(size - 1, before[own] + rest[own] * np.uint64(_K1))]
                if len(hit):
                    yield at[hit], [(w := words[i])[:j] + w[j + 1 :] for i in at[hit].tolist()]
                row, letter = np.nonzero(cps[:, j, None] < alphabet[None, :])
                hit = answers(size, (before + rest)[row] + letters[letter] * power[j])
                if len(hit):
                    row, letter = row[hit], letter[hit]
                    yield at[row], [(w := words[i])[:j] + chr(c) + w[j + 1 :] for i, c in zip(at[row].tolist(), alphabet[letter].tolist())]
                before = before + terms[:, j]


def filter_rows(words: DataFrame, blocks: dict[int, int], part: int, passes: int) -> DataFrame:
    """The filters' 64-bit words of one pass, packed: ``(shard, chunk, at, bits)``."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            all_words = b["word"].tolist()
            h = hashes(all_words)
            shard = np.minimum(np.fromiter(map(len, all_words), np.int64, len(all_words)), LENGTHS)
            for s in np.unique(shard).tolist():
                block, second = slots(h[shard == s], blocks[s])
                mine = block % np.uint64(passes) == np.uint64(part)
                block, second = block[mine] // np.uint64(passes), second[mine]
                for p in range(PROBES):
                    x = bit(second, p)
                    at = (block * np.uint64(BLOCK // 64) + (x >> np.uint64(6))).astype(np.int64)
                    yield pd.DataFrame({"shard": s, "at": at, "bits": (np.uint64(1) << (x & np.uint64(63))).view(np.int64)})

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(CHUNK, np.int64)
        out[rows["at"].to_numpy() % CHUNK] = rows["bits"].to_numpy()
        return pd.DataFrame({"shard": [key[0]], "chunk": [key[1]], "data": [out.tobytes()]})

    bits = words.select("word").mapInPandas(spread, "shard int, at bigint, bits bigint")
    bits = bits.groupBy("shard", "at").agg(F.bit_or("bits").alias("bits")).withColumn("chunk", F.floor(F.col("at") / CHUNK).cast("bigint"))
    return bits.groupBy("shard", "chunk").applyInPandas(pack, "shard int, chunk bigint, data binary")


def near_pairs(words: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(a, n_a, b, n_b)``: every near pair of ``words(word, n)`` once, in one of its orders."""
    spark = words.sparkSession
    sizes = {r["shard"]: r["c"] for r in words.groupBy(F.least(F.length("word"), F.lit(LENGTHS)).alias("shard")).agg(F.count("*").alias("c")).collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)
    blocks = {s: -(-c * BITS // BLOCK) for s, c in sizes.items()}
    passes = max(1, -(-sum(blocks.values()) * (BLOCK // 8) // pass_bytes))
    parts = max(spark.sparkContext.defaultParallelism, -(-sum(sizes.values()) // TASK_WORDS))
    dealt = words.repartition(parts, "word")

    found = None
    for part in range(passes):
        table = {s: np.zeros(-(-n // passes) * (BLOCK // 64), np.uint64) for s, n in blocks.items()}
        for r in filter_rows(words, blocks, part, passes).toLocalIterator():
            piece = np.frombuffer(r["data"], np.uint64)
            lo = r["chunk"] * CHUNK
            table[r["shard"]][lo : lo + CHUNK] = piece[: max(0, len(table[r["shard"]]) - lo)]
        shared = spark.sparkContext.broadcast({s: t.tobytes() for s, t in table.items()})
        del table

        def walk(batches: Iterator[pd.DataFrame], part=part, shared=shared) -> Iterator[pd.DataFrame]:
            tables = {s: np.frombuffer(raw, np.uint64) for s, raw in shared.value.items()}

            def answers(size: int, h: np.ndarray) -> np.ndarray:
                s = min(size, LENGTHS)
                return probe(h, blocks[s], tables[s], part, passes) if s in tables else np.empty(0, np.int64)

            for b in batches:
                w, n = b["word"].tolist(), b["n"].to_numpy()
                for at, out in edits(w, alphabet, answers):
                    yield pd.DataFrame({"a": strings(w[i] for i in at.tolist()), "n_a": n[at], "b": strings(out)})

        one = dealt.mapInPandas(walk, "a string, n_a bigint, b string")
        found = one if found is None else found.unionByName(one)
    return found.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each word's chain of ``forms(word, form, ...)``, by pointer doubling.

    A form occurs at least five times as often as its word, so a chain of counts below 2**63 has
    at most 27 steps, and five doublings reach its end.
    """
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(5):
        if up.join(up.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            break
        over = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        before, up = up, materialize(up.join(over, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        if hasattr(before, "_written_to"):
            release(before)
    return up


def variants(words: DataFrame, ratio: int = 5, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every row of ``words(word, n)``, words distinct.

    form: the near word of largest n (on ties the smallest in code-point order) if that n is at
    least ``ratio`` (5 or more) times the word's own; root: the last word of the chain of forms.
    """
    if ratio < 5:
        raise ValueError("ratio must be at least 5: chains of forms are followed for 32 steps")
    words = materialize(words.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    pairs = materialize(near_pairs(words, pass_bytes), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("other"), F.col("n_b").alias("m"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    best = best.select("word", "n_near", F.when(-F.col("best.m") >= ratio * F.col("n"), F.struct(F.col("best.other").alias("form"), (-F.col("best.m")).alias("form_n"))).alias("f"))
    best = materialize(best.select("word", "n_near", "f.form", "f.form_n"), "best_forms")
    roots = last_forms(best.where("form is not null"))
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return variants(count_words(docs, noise=199))


def oracle() -> str:
    """DuckDB: CRC-32 over the bytes of ``<doc_id>:<run>`` from its table of 256 values, near words by edit distance."""
    return """
with recursive crc_table as (
  select list(list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by b) as t
  from range(256) as r(b)
), runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents
), counted as (
  select doc_id, run, count(*) as n from runs where length(run) >= 6 group by all
), bytes as (
  select doc_id, run, n, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''), lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195, unicode(c)::bigint - 64] end)) as b
  from counted
), hashed as (
  select run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]))) as h
  from bytes, crc_table
), tokens as (
  select case when h % 199 = 0 then substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, n from hashed
), vocab as (
  select word, sum(n)::bigint as n from tokens where length(word) >= 6 group by word having sum(n) >= 5
), cuts as (
  select word, n, j, substring(word, 1, j - 1) || substring(word, j + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as j from vocab)
), near as (
  select distinct a.word, a.n, b.word as other, b.n as m from cuts a join cuts b on a.rest = b.rest and a.j = b.j and a.word <> b.word
  union
  select distinct a.word, a.n, b.word, b.n from cuts a join vocab b on a.rest = b.word
  union
  select distinct b.word, b.n, a.word, a.n from cuts a join vocab b on a.rest = b.word
), best as (
  select word, count(*) as n_near, first(other order by m desc, other) as other, max(m) as m from near group by word
), forms as (
  select v.word, v.n, coalesce(n_near, 0) as n_near, case when m >= 5 * n then other end as form, case when m >= 5 * n then m end as form_n
  from vocab v left join best using (word)
), chain as (
  select word, word as root, 0 as step from forms
  union all
  select c.word, f.form, step + 1 from chain c join forms f on f.word = c.root where f.form is not null
)
select word, form, (select last(root order by step) from chain c where c.word = f.word) as root, n::bigint as n, n_near::bigint as n_near, form_n::bigint as form_n
from forms f
"""
