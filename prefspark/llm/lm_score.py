"""Language-model scores from a log-frequency Bloom filter (operator 1).

An interpolated bigram model. A bigram counted c times is held at level 1 + floor(log2 c): the
filter stores the pairs (bigram, 1) .. (bigram, level). A reader probes levels upwards until
one is missing, so counts are never too low, and each step up is wrong with the filter's small
error rate. The quantised count 2**(level-1) never exceeds the true one, so the probabilities
after one history sum to at most 1 (up to filter errors):

    P(w | h) = a * min(q(h, w), c(h)) / c(h) + (1 - a) * P(w),   P(w) = (c(w)+0.1) / (N+0.1(V+1))

``a`` depends on the size class of c(h). It is the best of a grid on the training texts
themselves, each event scored with its own occurrence taken out of the counts.

Spark counts words and bigrams by ranges of their 64-bit hashes: a task sends one packed row
per range, a range is merged in one task of bounded size and builds its own slice of the filter.
Word counts (exact) and filter slices reach the workers by broadcast, in pieces of at most
``VOCAB_ENTRIES`` entries and ``FILTER_BYTES``. A corpus beyond one piece is scored in one pass
per piece, with partial sums kept in a table, so nothing is pruned and memory stays bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.llm.common import Chunk, chunks, materialize, mix, text_of

END = np.uint64(0x656E64)  # the token after the last word; its hash is no word's
BEGIN = np.uint64(0x626567)
GRID = np.array([0.01, 0.03, 0.08, 0.15, 0.3, 0.45, 0.6, 0.75, 0.9])
CLASSES = 40
PROBES = 5
BITS_PER_ENTRY = 8
VOCAB_ENTRIES = 8_000_000
FILTER_BYTES = 96 << 20
RANGE_BYTES = 16 << 20
FLUSH = 2_000_000


def tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes with an end after each text: (token, history, text, bigram)."""
    n = c.hi - c.lo
    tok = np.empty(len(c.words) + n, np.uint64)
    doc = np.empty(len(tok), np.int64)
    at = np.arange(len(c.words)) + c.doc
    ends = c.first[1:] + np.arange(n)
    tok[at], doc[at] = c.words, c.doc
    tok[ends], doc[ends] = END, np.arange(n)
    prev = np.empty_like(tok)
    prev[1:] = tok[:-1]
    prev[0] = BEGIN
    prev[ends[:-1] + 1] = BEGIN
    return tok, prev, doc, mix(prev * np.uint64(0x9E3779B97F4A7C15) + tok)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, bytes of equal weight together (they compress well)."""
    gaps = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return len(keys).to_bytes(8, "little") + gaps.tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    a = np.frombuffer(blob, np.uint8, offset=8)
    keys = np.cumsum(np.ascontiguousarray(a[: 8 * n].reshape(8, n).T).view(np.uint64).ravel())
    return keys, np.ascontiguousarray(a[8 * n :].reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def merge(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blobs]
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], np.concatenate([p[1] for p in parts])[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0]
    return keys[first], np.add.reduceat(counts, first)


def slots(keys: np.ndarray, level: int, probe: int, bits) -> np.ndarray:
    """Bit of each key at a level and probe, in a filter (slice) of ``bits`` bits."""
    h = mix(keys + np.uint64((level * 64 + probe + 1) * 0xD1342543DE82EF95 % 2**64))
    return ((h >> np.uint64(32)) * np.asarray(bits, np.uint64)) >> np.uint64(32)


def build_slice(keys: np.ndarray, counts: np.ndarray) -> bytes:
    level = np.frexp(counts.astype(np.float64))[1]  # 1 + floor(log2 c)
    entries = int(level.sum())
    size = max(8, -(-entries * BITS_PER_ENTRY // 8))
    out = np.zeros(size, np.uint8)
    for j in range(1, int(level.max(initial=0)) + 1):
        own = keys[level >= j]
        for p in range(PROBES):
            s = slots(own, j, p, size * 8)
            np.bitwise_or.at(out, (s >> np.uint64(3)).astype(np.int64), (1 << (s & np.uint64(7))).astype(np.uint8))
    return out.tobytes()


class Filter:
    """Slices ``lo:hi`` of the filter; ranges are the leading ``shift`` bits of a key."""

    def __init__(self, shift: int, lo: int, slices: list[bytes]) -> None:
        self._set(shift, lo, np.array([len(s) for s in slices], np.int64), np.frombuffer(b"".join(slices), np.uint8))

    def _set(self, shift: int, lo: int, sizes: np.ndarray, data: np.ndarray) -> None:
        self.shift, self.lo, self.n, self.data = shift, lo, len(sizes), data
        self.bits = sizes.astype(np.uint64) * np.uint64(8)
        self.begin = (np.cumsum(sizes) - sizes).astype(np.uint64) * np.uint64(8)

    @staticmethod
    def over(shift: int, lo: int, sizes: np.ndarray, data: np.ndarray) -> "Filter":
        """The filter whose slices of ``sizes`` bytes lie one after another in ``data``."""
        out = Filter.__new__(Filter)
        out._set(shift, lo, sizes, data)
        return out

    def range_of(self, keys: np.ndarray) -> np.ndarray:
        return ranges_of(keys, self.shift) - self.lo

    def counts(self, keys: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Quantised counts (0: not held) of keys whose range ``where`` is in this piece."""
        level = np.zeros(len(keys), np.int64)
        live = np.arange(len(keys))
        bits, begin = self.bits[where], self.begin[where]
        j = 1
        while len(live):
            for p in range(PROBES):
                s = slots(keys[live], j, p, bits[live]) + begin[live]
                live = live[(self.data[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            level[live] = j
            j += 1
        return np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)


def ranges_of(keys: np.ndarray, shift: int) -> np.ndarray:
    return (keys >> np.uint64(64 - shift)).astype(np.int64) if shift else np.zeros(len(keys), np.int64)


class Model:
    """Counts of a corpus as tables: ``parts(kind, range, blob)``, sizes, and the mixing weights."""

    def __init__(self, parts: DataFrame, shift: int, total: int, distinct: int, texts: int, vocab: list, filters: list, sizes: dict) -> None:
        self.parts, self.shift, self.total, self.distinct, self.texts = parts, shift, total, distinct, texts
        self.vocab_pieces, self.filter_pieces = vocab, filters
        #: By (kind, range): distinct words, or bytes of the filter's slice.
        self.sizes = sizes
        self.weights = np.zeros(CLASSES)
        self._whole = None

    def _layout(self, kind: int, piece: tuple[int, int], least: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([self.sizes.get((kind, k), least) for k in range(piece[0], piece[1] + 1)], np.int64)
        return sizes, np.cumsum(sizes) - sizes

    def _blobs(self, kind: int, piece: tuple[int, int]) -> Iterator[tuple[int, bytes]]:
        """``(place, blob)`` of the ranges of a piece, a partition at a time."""
        for r in self.parts.where((F.col("kind") == kind) & F.col("range").between(*piece)).select("range", "blob").toLocalIterator():
            yield r["range"] - piece[0], r["blob"]

    def vocab(self, piece: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        sizes, begin = self._layout(0, piece, 0)
        keys, counts = np.empty(sizes.sum(), np.uint64), np.empty(sizes.sum(), np.uint32)
        for k, blob in self._blobs(0, piece):
            keys[begin[k] : begin[k] + sizes[k]], counts[begin[k] : begin[k] + sizes[k]] = unpack(blob)
        return keys, counts

    def filter(self, piece: tuple[int, int]) -> tuple[int, int, np.ndarray, np.ndarray]:
        """What ``Filter.over`` takes: plain values, which workers can read without this package."""
        sizes, begin = self._layout(1, piece, 8)
        data = np.zeros(sizes.sum(), np.uint8)
        for k, blob in self._blobs(1, piece):
            data[begin[k] : begin[k] + sizes[k]] = np.frombuffer(blob, np.uint8)
        return self.shift, piece[0], sizes, data

    def shared(self, piece: tuple[int, int]):
        """Broadcast of the vocabulary (if it is one piece) and a piece of the filter.

        Where both are whole, fitting and scoring use the same one.
        """
        sc = self.parts.sparkSession.sparkContext
        one = len(self.vocab_pieces) == 1
        if self._whole is not None:
            return self._whole
        out = sc.broadcast((self.vocab(self.vocab_pieces[0]) if one else None, self.filter(piece)))
        if one and len(self.filter_pieces) == 1:
            self._whole = out
        return out


def _pieces(sizes: dict[int, int], ranges: int, most: int) -> list[tuple[int, int]]:
    """Runs of neighbouring ranges of at most ``most`` in sum (one range at least)."""
    out, lo, size = [], 0, 0
    for k in range(ranges):
        if k > lo and size + sizes.get(k, 0) > most:
            out.append((lo, k - 1))
            lo, size = k, 0
        size += sizes.get(k, 0)
    return [*out, (lo, ranges - 1)]


def train(texts: DataFrame, text_col: str = "text", vocab_entries: int = VOCAB_ENTRIES, filter_bytes: int = FILTER_BYTES, range_bytes: int = RANGE_BYTES) -> Model:
    """Count words and bigrams of every text and fit the mixing weights."""
    rows = texts.select(text_of(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shift = max(0, math.ceil(math.log2(max(1, size / range_bytes))))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(held: list) -> Iterator[pd.DataFrame]:
            for kind in (0, 1):
                keys, n = np.unique(np.concatenate([h[kind] for h in held]), return_counts=True)
                where = ranges_of(keys, shift)
                cut = np.nonzero(np.diff(where, prepend=-1))[0].tolist() + [len(keys)]
                yield pd.DataFrame({"kind": kind, "range": where[cut[:-1]], "blob": [pack(keys[a:b], n[a:b]) for a, b in zip(cut, cut[1:])]})

        held, size = [], 0
        for b in batches:
            for c in chunks(b["text"], lower=True):
                tok, _, _, pair = tokens(c)
                held.append((tok, pair))
                size += len(tok)
                if size >= FLUSH:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def merged(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        keys, n = merge(list(group["blob"]))
        blob = build_slice(keys, n) if key[0] else pack(keys, n)
        end = int(n[np.searchsorted(keys, END)]) if not key[0] and END in keys else 0
        return pd.DataFrame({"kind": [key[0]], "range": [key[1]], "blob": [blob], "bytes": [len(blob)], "distinct": [len(keys)], "total": [int(n.sum())], "ends": [end]})

    parts = rows.mapInPandas(count, "kind int, range bigint, blob binary").groupBy("kind", "range").applyInPandas(merged, "kind int, range bigint, blob binary, bytes bigint, distinct bigint, total bigint, ends bigint")
    parts = materialize(parts, "lm_counts")
    stats = parts.select("kind", "range", "bytes", "distinct", "total", "ends").collect()  # one short row per range
    words = [s for s in stats if s["kind"] == 0]
    vocab = _pieces({s["range"]: s["distinct"] for s in words}, 1 << shift, vocab_entries)
    filters = _pieces({s["range"]: s["bytes"] for s in stats if s["kind"] == 1}, 1 << shift, filter_bytes)
    sizes = {(s["kind"], s["range"]): s["bytes"] if s["kind"] else s["distinct"] for s in stats}
    model = Model(parts, shift, sum(s["total"] for s in words), sum(s["distinct"] for s in words), sum(s["ends"] for s in words), vocab, filters, sizes)
    if model.total:
        model.weights = _fit(rows, model)
    return model


def _word_counts(tok: np.ndarray, vocab: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, n = vocab
    some, back = np.unique(tok, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, some), max(len(keys) - 1, 0))
    found = np.where(keys[at] == some, n[at], 0) if len(keys) else np.zeros(len(some))
    return found.astype(np.int64)[back]


def _size_class(history: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(history.astype(np.float64))[1], CLASSES - 1)


def _events(b: pa.RecordBatch, vocab, held: Filter, texts: int) -> Iterator[tuple]:
    """Per chunk: (chunk, text of token, c(w), c(h), q(h, w), in this piece of the filter)."""
    for c in chunks(b["text"].to_pylist(), lower=True):
        tok, prev, doc, pair = tokens(c)
        if vocab is None:
            n = np.concatenate([np.frombuffer(x, "<i8") for x in b["counts"].slice(c.lo, c.hi - c.lo).to_pylist()])
        else:
            n = _word_counts(tok, vocab)
        history = np.concatenate(([0], n[:-1]))
        history[prev == BEGIN] = texts
        where = held.range_of(pair)
        here = np.nonzero((where >= 0) & (where < held.n))[0]
        q = np.zeros(len(tok), np.int64)
        q[here] = held.counts(pair[here], where[here])
        yield c, doc, n, history, q, here


def _with_counts(rows: DataFrame, model: Model) -> DataFrame:
    """Add the word counts of each token as a column, one pass per piece of the vocabulary."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("counts", T.BinaryType())])
    for k, piece in enumerate(model.vocab_pieces):
        shared = spark.sparkContext.broadcast(model.vocab(piece))

        def look(batches: Iterator[pa.RecordBatch], shared=shared, k=k) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for c in chunks(b["text"].to_pylist(), lower=True):
                    tok, _, doc, _ = tokens(c)
                    n = _word_counts(tok, shared.value)
                    cut = np.searchsorted(doc, np.arange(c.hi - c.lo + 1))
                    for i in range(c.hi - c.lo):
                        own = n[cut[i] : cut[i + 1]]
                        out.append((own + np.frombuffer(b["counts"][c.lo + i].as_py(), "<i8") if k else own).astype("<i8").tobytes())
                yield _with_columns(b, {"counts": pa.array(out, pa.binary())})

        rows = materialize(rows.mapInArrow(look, schema), "lm_word_counts")
        shared.destroy()
    return rows


def _with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns put in or in place; all others, ids above all, stay as they are."""
    return pa.RecordBatch.from_pydict({n: batch[n] for n in batch.schema.names} | columns)


def _fit(rows: DataFrame, model: Model) -> np.ndarray:
    """Best mixing weight of each size class of histories, leaving out each event itself."""
    rows = rows if len(model.vocab_pieces) == 1 else _with_counts(rows, model)
    bottom, texts = model.total + 0.1 * (model.distinct + 1) - 1, model.texts
    sums = np.zeros((CLASSES, len(GRID)))
    for piece in model.filter_pieces:
        shared = model.shared(piece)

        def gain(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocab, held = shared.value[0], Filter.over(*shared.value[1])
            acc = np.zeros((CLASSES, len(GRID)))
            for b in batches:
                for _, _, n, history, q, here in _events(b, vocab, held, texts):
                    n, history, q = n[here], history[here], q[here]
                    r = np.minimum(np.maximum(q - 1, 0), history - 1) / np.maximum(history - 1, 1)
                    u = (n - 1 + 0.1) / bottom
                    cls = _size_class(history)
                    for g, a in enumerate(GRID):
                        acc[:, g] += np.bincount(cls, np.log(a * r + (1 - a) * u), CLASSES)
            cls, g = np.repeat(np.arange(CLASSES, dtype=np.int32), len(GRID)), np.tile(np.arange(len(GRID), dtype=np.int32), CLASSES)
            yield pa.RecordBatch.from_pydict({"cls": pa.array(cls), "g": pa.array(g), "v": pa.array(acc.ravel())})

        for r in rows.mapInArrow(gain, "cls int, g int, v double").groupBy("cls", "g").agg(F.sum("v").alias("v")).collect():
            sums[r["cls"], r["g"]] += r["v"]
        if shared is not model._whole:
            shared.destroy()
    out = GRID[np.argmax(np.round(sums, 3), axis=1)]
    out[0] = 0.0  # histories never seen
    return out


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, text, n_tokens, n_known, base_score, score``.

    An empty or null text is scored as its end alone. Repeated rows score alike.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    one = len(model.vocab_pieces) == 1
    rows = rows if one else _with_counts(rows, model)
    bottom, texts = model.total + 0.1 * (model.distinct + 1), model.texts
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text string, {'' if one else 'counts binary, '}n_tokens bigint, n_known bigint, base_score double, score double"
    weights = model.weights
    for k, piece in enumerate(model.filter_pieces):
        shared = model.shared(piece)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, k=k) -> Iterator[pa.RecordBatch]:
            vocab, held = shared.value[0], Filter.over(*shared.value[1])
            for b in batches:
                out = [np.empty((0, 4))]
                for c, doc, n, history, q, here in _events(b, vocab, held, texts):
                    size = c.hi - c.lo
                    u = (n + 0.1) / bottom
                    a = weights[_size_class(history)]
                    p = a * np.minimum(q, history) / np.maximum(history, 1) + (1 - a) * u
                    part = np.bincount(doc[here], np.log10(p[here]), size)
                    out.append(np.column_stack([np.bincount(doc, minlength=size), np.bincount(doc, n > 0, size), np.bincount(doc, np.log10(u), size), part]))
                got = np.concatenate(out)
                if k:
                    yield _with_columns(b, {"score": pa.array(b["score"].to_numpy() + got[:, 3])})
                else:
                    yield _with_columns(b, {"n_tokens": pa.array(got[:, 0].astype(np.int64)), "n_known": pa.array(got[:, 1].astype(np.int64)), "base_score": pa.array(got[:, 2]), "score": pa.array(got[:, 3])})

        rows = rows.mapInArrow(run, schema)
        if len(model.filter_pieces) > 1:
            rows = materialize(rows, "lm_scores")
            shared.destroy()
    return rows.drop("counts")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 10 == 0


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs.where(~held_out()))
    out = score(docs, model)
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("bigint").alias("train_tokens"), "base_score", "score")
