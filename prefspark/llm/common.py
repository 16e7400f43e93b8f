"""Helpers shared by the operators: written tables, word splitting, small graph steps."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from prefspark.session import scratch_path, shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE = "\\x20\\x09-\\x0D"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside drop their shuffle files when they end (their result is a table)."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    shared_dir(spark)
    path = scratch_path(spark, name)
    with shuffle_cleanup(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(table: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing reads any more (all that came of it is written)."""
    spark = table.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._written_to)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(rows: DataFrame, **columns: Column) -> DataFrame:
    """``(row, <columns>)``: each row whole in a struct, so that its column names can clash with none.

    ``select("row.*")`` gives the rows back, whatever their columns are called.
    """
    whole = F.struct(*[F.col("`{}`".format(c.replace("`", "``"))) for c in rows.columns])
    return rows.select(whole.alias("row"), *[c.alias(n) for n, c in columns.items()])


def encode(text: str) -> bytes:
    """UTF-8 bytes; Spark strings hold no lone surrogates, tests may."""
    return text.encode("utf-8", "replace")


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_K = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(64).integers(0, 2**64, 256, dtype=np.uint64)
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]).astype(np.int8)
_POWERS: list[np.ndarray] = []
CHUNK = 1 << 18


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK)
        _POWERS[:] = [np.cumprod(np.array([1] + [k] * size, np.uint64)) for k in (_K, pow(_K, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (start, end) of the words between ASCII white space."""
    if not raw:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.diff(_IS_SPACE[np.frombuffer(raw, np.uint8)], prepend=1, append=1)
    return np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of every word of a text: equal words, equal hashes, in any process.

    A word's hash is a polynomial over its bytes, read off running sums of the whole text, so
    the cost is a few array operations; long texts go in pieces cut at white space.
    """
    out = []
    at = 0
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        piece = raw[at:end]
        starts, ends = word_spans(piece)
        if len(starts):
            power, inverse = powers(len(piece))
            run = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTES[np.frombuffer(piece, np.uint8)] * power[: len(piece)], out=run[1:])
            out.append(mix((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


class Chunk(NamedTuple):
    """Whole texts ``lo:hi`` of a batch, tokenised together."""

    lo: int
    hi: int
    raw: bytes  # the texts, a line feed after each
    begin: np.ndarray  # byte offset of each text, and the end
    starts: np.ndarray  # of words, in raw
    ends: np.ndarray
    words: np.ndarray  # hashes
    doc: np.ndarray  # text of each word, from 0 at lo
    first: np.ndarray  # first word of each text, and the number of words

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words within one text, and their first words."""
        if len(self.words) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.nonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :])[0]
        return window_hashes(self.words, n)[at], at


def chunks(texts: Iterable[str], lower: bool = False) -> Iterator[Chunk]:
    """Tokenise texts a few hundred kB at a time (a longer text is a chunk of its own)."""

    def done(lo: int, raws: list[bytes]) -> Chunk:
        raw = b"\n".join([*raws, b""])
        begin = np.concatenate(([0], np.cumsum(np.fromiter((len(r) + 1 for r in raws), np.int64, len(raws)))))
        starts, ends = word_spans(raw)
        first = np.searchsorted(starts, begin)
        doc = np.repeat(np.arange(len(raws)), np.diff(first))
        return Chunk(lo, lo + len(raws), raw, begin, starts, ends, word_hashes(raw), doc, first)

    lo, raws, size, k = 0, [], 0, 0
    for k, t in enumerate(texts, 1):
        r = encode(t)
        raws.append(r.lower() if lower else r)
        size += len(r)
        if size >= CHUNK:
            yield done(lo, raws)
            lo, raws, size = k, [], 0
    if raws:
        yield done(lo, raws)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (empty if there are fewer)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    size = len(h) - n + 1
    out = h[:size].copy()
    for i in range(1, n):
        out *= np.uint64(_K)
        out += h[i : size + i]
    return mix(out)


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words stand in a window of ``n`` words that starts at one of ``at``."""
    edge = np.zeros(total + 1, np.int64)
    np.add(edge, np.bincount(at, minlength=total + 1), out=edge)
    edge -= np.bincount(at + n, minlength=total + 1)
    return np.cumsum(edge)[:total] > 0


def strings(values: Iterable) -> pd.Series:
    """A column of Python strings (pandas would otherwise infer an Arrow-backed one)."""
    return pd.Series(list(values), dtype=object)


def map_with_ids(rows: DataFrame, fold, schema: str, id_col: str = "id") -> DataFrame:
    """``rows.mapInPandas(fold, schema)`` with integer ids as nullable integers.

    pandas would make floats of a bigint column that holds a null, and so change ids beyond 2**53.
    """
    out_schema = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frames() -> Iterator[pd.DataFrame]:
            for b in batches:
                frame = b.to_pandas()
                if pa.types.is_integer(b.schema.field(id_col).type):
                    frame[id_col] = b[id_col].to_pandas(types_mapper=lambda _: pd.Int64Dtype())
                yield frame

        for frame in fold(frames()):
            yield pa.RecordBatch.from_pandas(frame, schema=out_schema, preserve_index=False)

    return rows.mapInArrow(run, schema)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` (bigint); root is the smallest node.

    Alternating large-star and small-star steps: each is one aggregation and one join, the
    links stay linear in number, and every round is written to the shared folder.
    """

    def oriented(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            n = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            n = e
        low = n.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = n.join(low, "a")
        if large:
            return oriented(out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        return oriented(
            out.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        )

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(oriented(links), "links")
    last = digest(edges)
    for _ in range(rounds):
        if not last[0]:
            break
        before, edges = edges, materialize(star(star(edges, True), False), "stars")
        release(before)
        now = digest(edges)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
