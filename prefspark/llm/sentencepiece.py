"""SentencePiece encoding and decoding on a relational lattice (operator 3).

The distinct units of the corpus are encoded once: substrings of bounded length are exploded,
equi-joined to the piece table (a fixed vocabulary, broadcast), the matching edges are grouped
by unit, and a higher-order ``aggregate`` folds them into the best path (Viterbi): the
segmentation with the largest sum of piece scores, on ties the one whose last piece is longest.
A character without a piece falls back to its UTF-8 bytes.

A word is a run of spaces with what follows up to the next space or line feed; a unit is a part
of a word, cut where two neighbouring characters stand together in no piece, and nowhere else. The
model is checked to hold no piece that goes beyond a word, so the best path of a text is that of
its units. The lattice takes units up to ``RUN`` characters; the few longer ones (of any length)
have the same fold in a worker, in time linear in their length. Texts are looked up in the unit
table: up to ``TABLE_UNITS`` of the most frequent units (a long one counts once per ``RUN``
characters) travel to the workers as packed arrays (about 20 bytes each, by 64-bit hash); the
units beyond are joined to the documents that hold them.

A text gets one space in front, and spaces are written as U+2581, as the vocabulary wants them;
a U+2581 of the text itself goes as bytes, so that decoding returns every text exactly.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from prefspark.llm.common import materialize, mix, packed, powers, strings, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
OWN_MARK = "\n" + MARK  # the unit that stands for a U+2581 of the text
RUN = 60
TABLE_UNITS = 8_000_000
WORD = re.compile(f" *[^ \\n{MARK}]+| +|\\n|{MARK}")
BEFORE_SPACES = re.compile("[^ ](?= )")
OWN = 0x110000  # stands for a U+2581 of the text; no character has this code
LOT = 1 << 17
SLICE = 4 << 20
FLUSH = 100_000
FALLBACK_PENALTY = 10.0
PREFIX = 4
#: Units dealt to one task of the lattice.
TASK_UNITS = 50_000
#: Bytes of the packed unit table that go to the driver in one job.
LOT_BYTES = 8 << 20


class Vocabulary:
    """The pieces of a model file (read on the driver): ids, scores, bytes, spellings."""

    def __init__(self, path: str = MODEL) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[tuple[str, int]] = []
        self.bytes = [sp.unk_id()] * 256
        self.spelling: list[bytes] = []
        scores: list[float | None] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            scores.append(None)
            if sp.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.spelling.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.spelling.append(b"")
            else:
                if re.search(f"[^{MARK}]{MARK}", piece) or ("\n" in piece and piece != "\n"):
                    raise ValueError(f"piece {piece!r} goes beyond a word")
                self.pieces.append((piece, i))
                self.spelling.append(piece.replace(MARK, " ").encode())
                scores[-1] = sp.get_score(i)
        if len(self.spelling) > 1 << 16 or any(i == 0 for _, i in self.pieces):
            raise ValueError("ids must fit in 16 bits, and id 0 must be no piece")
        fallback = min(s for s in scores if s is not None) - FALLBACK_PENALTY
        #: By id; what is no piece (0 stands for the bytes of a character) has the fallback's score.
        self.scores = [fallback if s is None else s for s in scores]
        #: Pairs of characters that stand together in some piece.
        self.inner = frozenset(p[i : i + 2] for p, _ in self.pieces for i in range(len(p) - 1))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame(self.pieces, columns=["piece", "piece_id"]), "piece string, piece_id int")

    def prefixes(self, spark: SparkSession) -> DataFrame:
        """``(head, lens)``: the lengths of the pieces that start with some ``PREFIX`` characters."""
        lens: dict[str, set[int]] = {}
        for p, _ in self.pieces:
            if len(p) >= PREFIX:
                lens.setdefault(p[:PREFIX], set()).add(len(p))
        return spark.createDataFrame([(head, sorted(own)) for head, own in lens.items()], "head string, lens array<int>")


def words(text: str) -> list[str]:
    """The plain definition of words; ``Cutter`` cuts alike on arrays."""
    return WORD.findall(" " + text) if text else []


class Lot(NamedTuple):
    """Some texts (or pieces of long ones) cut into units together."""

    joined: str  # spaces written as U+2581
    starts: np.ndarray  # of units, in joined
    ends: np.ndarray
    keys: np.ndarray  # 64-bit hashes of units
    text: np.ndarray  # which text each unit is of

    def spelled(self, at: np.ndarray) -> list[str]:
        own = int(OWN_KEY)
        return [OWN_MARK if k == own else self.joined[a:b] for a, b, k in zip(self.starts[at].tolist(), self.ends[at].tolist(), self.keys[at].tolist())]


class Cutter:
    """Cuts texts into units by array operations: nothing runs per word."""

    def __init__(self, inner: Iterable[str]) -> None:
        inner = list(inner)
        chars = sorted({ord(c) for pair in inner for c in pair})
        #: Place of a character among those of the pairs; 0 for any other.
        self.rank = np.zeros(0x110001, np.int32)
        self.rank[chars] = np.arange(1, len(chars) + 1)
        self.inner = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for x, y in inner:
            self.inner[self.rank[ord(x)], self.rank[ord(y)]] = True

    def lots(self, texts: Iterable[str]) -> Iterator[Lot]:
        held: list[tuple[int, str]] = []
        size = 0
        for k, t in enumerate(texts):
            for part in _parts(" " + t if t else ""):
                held.append((k, part))
                size += len(part)
                if size >= LOT:
                    yield self._lot(held)
                    held, size = [], 0
        if held:
            yield self._lot(held)

    def _lot(self, held: list[tuple[int, str]]) -> Lot:
        joined = "".join(part for _, part in held)
        x = codes(joined)
        x[x == ord(MARK)] = OWN
        x[x == 32] = ord(MARK)
        begin = np.cumsum([0] + [len(part) for _, part in held])
        r = self.rank[x]
        cut = np.zeros(len(x), bool)
        cut[1:] = ~self.inner[r[:-1], r[1:]]
        cut[begin[:-1]] = True
        starts = np.nonzero(cut)[0]
        ends = np.append(starts[1:], len(x))
        which = np.searchsorted(begin, starts, "right") - 1
        text = np.fromiter((k for k, _ in held), np.int64, len(held))[which]
        return Lot(joined.replace(" ", MARK), starts, ends, unit_keys(x, starts, ends), text)


def _parts(text: str) -> Iterator[str]:
    """A text in parts of about ``LOT`` characters, cut where a run of spaces begins."""
    at = 0
    while len(text) - at > 2 * LOT:
        m = BEFORE_SPACES.search(text, at + LOT)
        if not m:
            break
        yield text[at : m.end()]
        at = m.end()
    if at < len(text):
        yield text[at:]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.int64)


def unit_keys(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``starts:ends`` of the character codes ``x``."""
    power, inverse = powers(len(x))
    run = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(mix(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * power[: len(x)], out=run[1:])
    return mix((run[ends] - run[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


OWN_KEY = unit_keys(np.array([OWN]), np.array([0]), np.array([1]))[0]


def keys_of(units: list[str]) -> np.ndarray:
    """The hashes of spelled units."""
    ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    own = np.fromiter((u == OWN_MARK for u in units), bool, len(units))
    return np.where(own, OWN_KEY, unit_keys(codes("".join(units)), starts, ends)) if units else np.empty(0, np.uint64)


def unit_counts(docs: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """``(unit, n)``: the distinct units of all texts and their frequencies."""
    pairs = sorted(vocab.inner)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter(pairs)

        def merged(held: list[tuple[Lot, np.ndarray, np.ndarray]]) -> pd.DataFrame:
            """Counts of some lots: (lot, one place of each of its distinct units, how often)."""
            keys = np.concatenate([lot.keys[at] for lot, at, _ in held])
            of = np.repeat(np.arange(len(held)), [len(at) for _, at, _ in held])
            _, first, back = np.unique(keys, return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate([n for _, _, n in held]))
            places = np.concatenate([at for _, at, _ in held])[first]
            order = np.argsort(of[first], kind="stable")
            found: list[str] = []
            for k, (lot, _, _) in enumerate(held):
                found += lot.spelled(places[order][of[first][order] == k])
            return pd.DataFrame({"unit": strings(found), "n": n[order].astype(np.int64)})

        held, size = [], 0
        for b in batches:
            for lot in cutter.lots(b["text"]):
                _, at, n = np.unique(lot.keys, return_index=True, return_counts=True)
                held.append((lot, at, n))
                size += len(at)
                if size >= FLUSH:
                    yield merged(held)
                    held, size = [], 0
        if held:
            yield merged(held)

    rows = docs.select(text_of(text_col).alias("text")).mapInPandas(count, "unit string, n bigint")
    return rows.groupBy("unit").agg(F.sum("n").alias("n"))


def _listed(values: list, kind: str) -> Column:
    """A constant array; given as one string, which is folded once, not as thousands of literals."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def encode_units(found: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(unit, ids)`` of every row of the distinct ``found(unit)``, ``RUN`` characters at most, by the lattice.

    An edge is one integer, end * 2**24 + start * 2**16 + piece (0: the bytes of a character),
    so that sorting a unit's edges brings them in the order of the fold.
    """
    spark = found.sparkSession
    starts = found.select("unit", F.explode(F.sequence(F.lit(1), F.length("unit"))).alias("start"))
    # Short substrings, and longer ones of the lengths of pieces with the same first characters.
    head = F.substring("unit", F.col("start"), F.lit(PREFIX))
    starts = starts.select("unit", "start", head.alias("head")).join(F.broadcast(vocab.prefixes(spark)), "head", "left")
    lens = F.concat(F.sequence(F.lit(1), F.lit(PREFIX - 1)), F.coalesce("lens", F.array().cast("array<int>")))
    subs = starts.select("unit", "start", F.explode(lens).alias("len")).where(F.col("start") + F.col("len") - 1 <= F.length("unit"))
    subs = subs.select("unit", "start", "len", F.substring("unit", F.col("start"), F.col("len")).alias("piece"))
    edges = subs.join(F.broadcast(vocab.table(spark)), "piece", "left").where("piece_id is not null or len = 1")
    piece = F.when(F.col("unit") == OWN_MARK, F.lit(0)).otherwise(F.coalesce("piece_id", F.lit(0)))
    edge = F.shiftleft(F.col("start") + F.col("len") - 1, 24) + F.shiftleft(F.col("start") - 1, 16) + piece
    lattice = edges.select("unit", edge.alias("e")).groupBy("unit").agg(F.sort_array(F.collect_list("e")).alias("edges"))
    lattice = materialize(lattice, "lattice")
    scores = _listed(vocab.scores, "double")
    start_of = lambda e: F.shiftright(e, 16).bitwiseAND(F.lit(255))
    piece_of = lambda e: e.bitwiseAND(F.lit(0xFFFF))
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("edge")))

    # The scores stand once in a plan that reads a table: the driver spells out every copy, at every stage of a plan.
    scored = F.transform("edges", lambda e: F.struct(e.alias("edge"), F.get(scores, piece_of(e)).alias("score")))

    def step(best, x):
        """best[k]: score and last edge of the best path over the first k characters."""
        e, end = x["edge"], F.shiftright(x["edge"], 24)
        total = F.get(best, start_of(e))["score"] + x["score"]
        here = F.array(F.struct(total.alias("score"), e.alias("edge")))
        # Edges come by end: the path to an end is there already, or is the next of the array.
        return F.when(F.size(best) == end, F.concat(best, here)).when(total > F.get(best, end)["score"], F.concat(F.slice(best, F.lit(1), end), here)).otherwise(best)

    best = lattice.select("unit", F.aggregate(scored, first, step, lambda best: F.transform(best, lambda x: x["edge"])).alias("last"))
    # Back from the end: each step takes the edge that ends where the one before starts.
    back = F.struct(F.length("unit").alias("at"), F.array().cast("array<int>").alias("path"))

    def walk(acc, _):
        e = F.get("last", acc["at"])
        return F.when(acc["at"] > 0, F.struct(start_of(e).alias("at"), F.concat(F.array(e), acc["path"]).alias("path"))).otherwise(acc)

    path = best.select("unit", F.aggregate(F.sequence(F.lit(1), F.length("unit")), back, walk, lambda acc: acc["path"]).alias("path"))
    code = lambda e: F.hex(F.encode(F.substring("unit", start_of(e) + 1, F.lit(1)), "UTF-8"))
    by_byte = lambda e: F.transform(F.sequence(F.lit(1), F.length(code(e)), F.lit(2)), lambda i: F.get(_listed(vocab.bytes, "int"), F.conv(F.substring(code(e), i, F.lit(2)), 16, 10).cast("int")))
    plain = F.transform("path", piece_of)
    mixed = F.flatten(F.transform("path", lambda e: F.when(piece_of(e) > 0, F.array(piece_of(e))).otherwise(by_byte(e))))
    ids = F.when(F.array_contains(plain, 0), mixed).otherwise(plain)
    return path.select("unit", F.when(F.col("unit") == OWN_MARK, F.slice(ids, 2, 3)).otherwise(ids).alias("ids"))


def long_path(unit: str, pieces: dict[str, int], longest: int, scores: list[float], by_byte: list[int]) -> list[int]:
    """The ids of a unit by the fold of ``encode_units``, one end after another."""
    score, start, piece = array("d", [0.0]), array("q", [0]), array("H", [0])
    for end in range(1, len(unit) + 1):
        top, at, of = float("-inf"), -1, 0
        for k in range(max(0, end - longest), end):
            i = pieces.get(unit[k:end])
            if i is None:
                if k + 1 < end:
                    continue
                i = 0
            total = score[k] + scores[i]
            if total > top:
                top, at, of = total, k, i
        score.append(top)
        start.append(at)
        piece.append(of)
    out: list[int] = []
    at = len(unit)
    while at > 0:
        k = start[at]
        out += [piece[at]] if piece[at] else [by_byte[b] for b in reversed(unit[k:at].encode())]
        at = k
    return out[::-1]


def encode_long_units(found: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(unit, ids)`` of every row of the distinct ``found(unit)``, of any length."""
    pieces = dict(vocab.pieces)
    shared = found.sparkSession.sparkContext.broadcast((pieces, max(map(len, pieces)), vocab.scores, vocab.bytes))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for unit in b["unit"]:
                yield pd.DataFrame({"unit": strings([unit]), "ids": [long_path(unit, *shared.value)]})

    return found.select("unit").mapInPandas(run, "unit string, ids array<int>")


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``begin : begin + size`` of every range, one after another."""
    return np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _filled(ids: np.ndarray, sizes: np.ndarray, lack: np.ndarray, more: np.ndarray, more_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the ids of the lacking units in their places."""
    full = sizes.copy()
    full[lack] = more_sizes
    begin = np.cumsum(full) - full
    out = np.empty(full.sum(), np.int32)
    out[_ranges(begin, sizes)] = ids
    out[_ranges(begin[lack], more_sizes)] = more
    return out, full


class UnitTable:
    """Units by sorted 64-bit hash with their ids, packed."""

    def __init__(self, keys: list[np.ndarray], sizes: list[np.ndarray], ids: list[np.ndarray]) -> None:
        """Parts of a table, in any order; the lists are emptied as they are joined, to hold little twice."""

        def join(parts: list[np.ndarray], kind: type) -> np.ndarray:
            out = np.concatenate([*parts, np.empty(0, kind)])
            parts.clear()
            return out

        self.ids = join(ids, np.uint16)
        self.keys, self.sizes = join(keys, np.uint64), join(sizes, np.uint32)
        self.begin = np.cumsum(self.sizes, dtype=np.uint32) - self.sizes
        order = np.argsort(self.keys).astype(np.uint32)
        for name in ("keys", "sizes", "begin"):
            setattr(self, name, getattr(self, name)[order])

    @staticmethod
    def over(keys: np.ndarray, begin: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> "UnitTable":
        """The table of plain arrays, which workers can read without this package."""
        out = UnitTable.__new__(UnitTable)
        out.keys, out.begin, out.sizes, out.ids = keys, begin, sizes, ids
        return out

    def plain(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.keys, self.begin, self.sizes, self.ids

    @staticmethod
    def of(keys: np.ndarray, ids: list[np.ndarray]) -> "UnitTable | None":
        sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
        return UnitTable([keys], [sizes], [np.concatenate(ids).astype(np.uint16)]) if ids else None

    def ids_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units one after another, and how many each has (0: not held)."""
        at = self.look(keys)
        held = at >= 0
        sizes, begin = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        sizes[held], begin[held] = self.sizes[at[held]], self.begin[at[held]]
        return self.ids[_ranges(begin, sizes)].astype(np.int32), sizes

    def look(self, keys: np.ndarray) -> np.ndarray:
        """Places of the hashes in the table; -1 for a unit not held."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def pack_table(table: DataFrame, lot_bytes: int = LOT_BYTES) -> UnitTable:
    """Collect a unit table of bounded size in packed form."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                keys = keys_of(list(b["unit"]))
                sizes = np.fromiter(map(len, b["ids"]), np.uint32, len(b))
                ids = np.concatenate(list(b["ids"])).astype(np.uint16)
                yield pd.DataFrame({"k": [keys.tobytes()], "n": [sizes.tobytes()], "ids": [ids.tobytes()]})

    parts: tuple[list, list, list] = ([], [], [])
    for r in _by_lots(materialize(table.select("unit", "ids").mapInPandas(pack, "k binary, n binary, ids binary"), "packed_units"), lot_bytes):
        for part, name, kind in zip(parts, ("k", "n", "ids"), (np.uint64, np.uint32, np.uint16)):
            part.append(np.frombuffer(r[name], kind))
    return UnitTable(*parts)


def _by_lots(rows: DataFrame, lot_bytes: int) -> Iterator[Row]:
    """The rows of a table of binary columns, about ``lot_bytes`` of them collected at a time.

    A job for every partition would cost the driver more memory than what a partition holds.
    """
    size = rows.agg(F.sum(sum((F.octet_length(c) for c in rows.columns), F.lit(0)))).first()[0] or 0
    return rows.coalesce(-(-size // lot_bytes) or 1).toLocalIterator()


def unit_table(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", table_units: int = TABLE_UNITS) -> tuple[DataFrame, DataFrame | None]:
    """The encoded units of all texts: those that travel, and the rest (None if all fit)."""
    spark = docs.sparkSession
    found = materialize(unit_counts(docs, vocab, text_col), "units")
    long = F.length("unit") > RUN
    room = F.ceil(F.length("unit") / RUN)
    n_units, n_long, n_room = found.agg(F.count("*"), F.count_if(long), F.coalesce(F.sum(room), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_units // TASK_UNITS))
    table = encode_units(found.where(~long).repartition(parts, "unit"), vocab)
    if n_long:
        table = table.unionByName(encode_long_units(found.where(long).repartition(parts, "unit"), vocab))
    table = materialize(table, "encoded_units")
    if n_room <= table_units:
        return table, None
    # Whole classes of frequency, most frequent first, as long as they fit.
    classes = {r["c"]: r["k"] for r in found.groupBy(F.floor(F.log2("n")).alias("c")).agg(F.sum(room).alias("k")).collect()}
    least, held = 63, classes.get(63, 0)
    while least and held + classes.get(least - 1, 0) <= table_units:
        least -= 1
        held += classes.get(least, 0)
    often = F.col("n") >= 2.0**least
    return table.join(found.where(often), "unit", "left_semi"), table.join(found.where(~often), "unit", "left_semi")


def encode(docs: DataFrame, vocab: Vocabulary | None = None, text_col: str = "text", table_units: int = TABLE_UNITS, check: bool = False) -> DataFrame:
    """``docs`` plus ``ids`` (array of int). A null or empty text has no ids; repeated rows repeat.

    With ``check`` also ``round_trip``: whether the ids, decoded in the same worker, give the text.
    """
    spark = docs.sparkSession
    vocab = vocab or Vocabulary()
    hot, cold = unit_table(docs, vocab, text_col, table_units)
    shared = spark.sparkContext.broadcast((sorted(vocab.inner), pack_table(hot).plain(), vocab.spelling))
    text = text_of(text_col)
    rows = packed(docs, _s_text=text, _s_key=F.xxhash64(text))
    text = F.col("_s_text")
    if cold is None:
        rows = rows.withColumn("_s_cold", F.lit(None).cast("array<struct<unit:string,ids:array<int>>>"))
    else:

        def missing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            cutter, table = Cutter(shared.value[0]), UnitTable.over(*shared.value[1])
            for b in batches:
                for lot in cutter.lots(b["text"]):
                    lack = np.nonzero(table.look(lot.keys) < 0)[0]
                    text_key = b["key"].to_numpy()[lot.text[lack]]
                    yield pd.DataFrame({"_s_key": text_key, "unit": strings(lot.spelled(lack))}).drop_duplicates()

        lacking = rows.select(F.col("_s_key").alias("key"), text.alias("text")).mapInPandas(missing, "_s_key bigint, unit string").distinct()
        more = lacking.join(cold.select("unit", "ids"), "unit").groupBy("_s_key").agg(F.collect_list(F.struct("unit", "ids")).alias("_s_cold"))
        rows = rows.join(materialize(more, "cold_units"), "_s_key", "left")

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cutter, table, spelling = Cutter(shared.value[0]), UnitTable.over(*shared.value[1]), shared.value[2]
        for texts, colds in batches:
            # A few rows at a time: what a batch comes to in ids need not be held at once.
            for lo, hi in _slices(texts):
                yield some(cutter, table, spelling, texts[lo:hi], colds[lo:hi])

    def some(cutter: Cutter, table: UnitTable, spelling: list[bytes], texts: pa.Array, colds: pa.Array) -> pa.Array:
        extra = {e["unit"]: np.asarray(e["ids"], np.int32) for es in colds.drop_null().to_pylist() for e in es}
        more = UnitTable.of(keys_of(list(extra)), list(extra.values()))
        found = [np.empty(0, np.int32)]
        n = np.zeros(len(texts), np.int64)
        own = texts.to_pylist()
        for lot in cutter.lots(own):
            ids, sizes = table.ids_of(lot.keys)
            if more is not None and (lack := np.nonzero(sizes == 0)[0]).size:
                ids, sizes = _filled(ids, sizes, lack, *more.ids_of(lot.keys[lack]))
            if not sizes.all():
                raise ValueError("a unit of the text is in no table")
            found.append(ids)
            n += np.bincount(lot.text, sizes, len(n)).astype(np.int64)
        ids, edge = np.concatenate(found), np.concatenate(([0], np.cumsum(n))).astype(np.int32)
        out = [pa.ListArray.from_arrays(pa.array(edge), pa.array(ids))]
        if check:
            out.append(pa.array([_spelled(ids[a:z], spelling) == t for a, z, t in zip(edge, edge[1:], own)], pa.bool_()))
        return pa.StructArray.from_arrays(out, names)

    names = ["ids", "round_trip"] if check else ["ids"]
    kind = "struct<ids:array<int>,round_trip:boolean>" if check else "struct<ids:array<int>>"
    rows = rows.withColumn("_s_out", F.arrow_udf(run, kind)(text, F.col("_s_cold")))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in names]
    return rows.select(*kept, *[F.col(f"_s_out.{n}") for n in names])


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Runs of rows of about ``SLICE`` bytes of text (one row at least); an empty batch is one run."""
    size = np.cumsum([0, *(x or 0 for x in pc.binary_length(texts).to_pylist())])
    cut = [0, *(np.nonzero(np.diff(size // SLICE))[0] + 1).tolist(), len(texts)]
    return [(a, z) for a, z in zip(cut, cut[1:]) if a < z] or [(0, len(texts))]


def _spelled(ids: np.ndarray, spelling: list[bytes]) -> str:
    return b"".join([spelling[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


def decode(rows: DataFrame, vocab: Vocabulary | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` plus the text of their ids; no ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast((vocab or Vocabulary()).spelling)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spelling = shared.value
        for b in batches:
            yield pd.Series(["" if x is None else _spelled(x, spelling) for x in b], dtype=object)

    return rows.withColumn(out, F.pandas_udf(run, "string")(F.col(ids_col)))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs, check=True).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "round_trip")
