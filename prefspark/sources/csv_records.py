"""CSV files with line ends inside quoted fields, read by many tasks.

A line end closes a record only if the quotes before it are even in number, which a task cannot
know from its own byte range. So the file is read twice. The first pass gives, for every input
split, the parity of its quotes and, for either state it may begin in, how many records start in
it and the pieces of records at its two edges. A running parity over the splits of a file (a small
table) says which of the two holds; running counts number the records. The second pass puts the
lines of each split together into whole records; only the pieces at the edges of splits are
grouped across tasks. No row of the data is shuffled.

Quotes are as in RFC 4180: a field that holds quotes, commas or line ends is quoted, quotes
inside are doubled. Records end with ``\\n`` or ``\\r\\n``; empty lines between records are skipped.
A file that ends inside a quoted field fails the read, as does a record of a wrong shape.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.operators.ordinal import checked_small, join_small
from prefspark.session import ship_code

SPLIT = "file string, block bigint, state int, parity int, starts bigint, head string, tail string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array, bool]]:
    """``(constant columns, lines, is the split's last run)`` of the splits a task reads, in order."""
    held: tuple[dict, list[pa.Array]] | None = None
    for b in batches:
        if not len(b):
            continue
        keys = [n for n in b.schema.names if n != "value"]
        block, file = b["block"].to_numpy(), b["file"]
        turn = np.nonzero((block[1:] != block[:-1]) | pc.not_equal(file.slice(1), file.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False))[0] + 1
        for lo, hi in zip([0, *turn.tolist()], [*turn.tolist(), len(b)]):
            one = {k: b[k][lo].as_py() for k in keys}
            if held and (held[0]["file"], held[0]["block"]) != (one["file"], one["block"]):
                yield held[0], pa.concat_arrays(held[1]), True
                held = None
            elif held:
                yield held[0], pa.concat_arrays(held[1]), False
            held = (one, [b["value"].slice(lo, hi - lo)])
    if held:
        yield held[0], pa.concat_arrays(held[1]), True


def _quotes_before(lines: pa.Array, quote: str) -> tuple[np.ndarray, int]:
    """Quotes of the run before each line, and in all of it."""
    n = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(n)
    return total - n, int(total[-1])


def _starts(lines: pa.Array, before: np.ndarray, state: int) -> np.ndarray:
    """Which lines start a record: outside quotes, and not empty."""
    blank = pc.is_in(lines, value_set=pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
    return ((before + state) % 2 == 0) & ~blank


def describe_splits(lines: DataFrame, quote: str) -> DataFrame:
    """``SPLIT`` rows, one for each split and state (0: begins between records, 1: inside a field)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, list] = {}
        for one, text, last in _runs(batches):
            before, total = _quotes_before(text, quote)
            for state in (0, 1):
                # Quotes so far, records started, lines before the first, lines of the last.
                own = at.setdefault(state, [0, 0, [], []])
                start = np.nonzero(_starts(text, before, state + own[0]))[0].tolist()
                if start:
                    if not own[1]:
                        own[2] += text.slice(0, start[0]).to_pylist()
                    own[1] += len(start)
                    own[3] = text.slice(start[-1]).to_pylist()
                else:
                    own[3 if own[1] else 2] += text.to_pylist()
                own[0] += total
            if last:
                rows = []
                for state, (quotes, starts, head, tail) in at.items():
                    open_end = (state + quotes) % 2 == 1
                    # Blank lines before the first record belong to none.
                    head = "\n".join(head) if state else None
                    rows.append((one["file"], one["block"], state, quotes % 2, starts, head, "\n".join(tail) if open_end and starts else None))
                yield pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(("file", "block", "state", "parity", "starts", "head", "tail"))}, schema)
                at = {}

    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in SPLIT.split(", "))])
    return lines.mapInArrow(run, SPLIT)


def place_splits(splits: DataFrame) -> DataFrame:
    """Each split with its true state and the number of records that start before it in its file."""
    by_file = Window.partitionBy("file").orderBy("block")
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    even = splits.where("state = 0").select("file", "block", F.coalesce(F.sum("parity").over(earlier) % 2, F.lit(0)).cast("int").alias("state"))
    own = splits.join(even, ["file", "block", "state"])
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.col("block").desc())) == 1
    unclosed = last & ((F.col("state") + F.col("parity")) % 2 == 1)
    failed = F.raise_error(F.concat(F.lit("quoted field is not closed at the end of "), F.col("file")))
    return own.select("*", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).cast("bigint").alias("before"), F.when(unclosed, failed).cast("int").alias("_checked"))


def whole_records(lines: DataFrame, places: DataFrame, quote: str) -> DataFrame:
    """``(file, record, text)`` of the records that lie in one split; the pieces at its edges are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, number, tail = 0, 0, []
        for one, text, last in _runs(batches):
            before, total = _quotes_before(text, quote)
            start = np.nonzero(_starts(text, before, one["state"] + quotes))[0]
            quotes += total
            lines = text.to_pylist()
            out = []
            if not len(start):
                tail += lines if number else []
            else:
                if number:
                    out.append("\n".join(tail + lines[: start[0]]))
                ends = start[1:].tolist()
                out += [lines[a] if b == a + 1 else "\n".join(lines[a:b]) for a, b in zip(start.tolist(), ends)]
                tail = lines[start[-1] :]
            first = one["before"] + max(number, 1)
            number += len(start)
            if last and number and (one["state"] + quotes) % 2 == 0:
                out.append("\n".join(tail))
            yield pa.RecordBatch.from_pydict({"file": [one["file"]] * len(out), "record": pa.array(first + np.arange(len(out)), pa.int64()), "text": pa.array(out, pa.string())})
            if last:
                quotes, number, tail = 0, 0, []

    placed = lines.join(places.select("file", "block", "state", "before"), ["file", "block"])
    return placed.select("file", "block", "state", "before", "value").mapInArrow(run, "file string, record bigint, text string")


def edge_records(places: DataFrame) -> DataFrame:
    """``(file, record, text)`` of the records that lie in several splits."""
    heads = places.where("head is not null").select("file", "block", F.col("before").alias("record"), F.lit(0).alias("side"), F.col("head").alias("text"))
    tails = places.where("tail is not null").select("file", "block", (F.col("before") + F.col("starts")).alias("record"), F.lit(1).alias("side"), F.col("tail").alias("text"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "side", "text")))
    return heads.unionByName(tails).groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, row_id: str | None = "row_id", quote: str = '"') -> DataFrame:
    """Records of CSV files with a header line each, and their file-order position ``row_id``.

    Without a schema every column is text, named by the header. Malformed records fail the read.
    """
    ship_code(spark)
    options = {"header": True, "multiLine": True, "escape": '"', "quote": quote}
    if schema is None:
        schema = spark.read.options(**options).csv(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    splits, _ = checked_small(describe_splits(lines, quote))
    places, small = checked_small(place_splits(splits))
    records = whole_records(lines, F.broadcast(places) if small else places, quote).unionByName(edge_records(places))
    sizes = places.groupBy("file").agg((F.sum("starts") - 1).alias("_n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).cast("bigint").alias("_off"))
    records = join_small(records.where("record > 1"), sizes, ["file"])
    ddl = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields)
    parsed = F.from_csv(F.regexp_replace("text", "[\r\n]+\\z", ""), ddl, {"mode": "FAILFAST", "escape": '"', "quote": quote})
    out = records.select((F.col("_off") + F.col("record") - 1).alias("_row"), parsed.alias("_r"))
    columns = [F.col("_r").getField(f.name).alias(f.name) for f in schema.fields]
    return out.select(*columns, *([F.col("_row").alias(row_id)] if row_id else []))
