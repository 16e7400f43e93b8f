"""Readers for prompt datasets, prompt files and saved sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.operators.ordinal import hash_ordinal, with_row_id
from prefspark.operators.sampling import limit_samples
from prefspark.operators.generate import clean_lines
from prefspark.operators.sessions import session_from_json
from prefspark.sources.csv_records import read_csv
from prefspark.sources.files import path_exists


def _read_file(spark: SparkSession, path: str | list[str], kind: str, schema, multiline: bool | None) -> DataFrame:
    """One data file or a folder of them; a malformed record fails the read.

    A JSON file that opens with ``[`` is one array of records and is read whole;
    JSON lines and Parquet are split among tasks, and so is CSV, whose fields may
    hold line ends (``csv_records``).
    """
    reader = (spark.read if schema is None else spark.read.schema(schema)).option("mode", "FAILFAST")
    if kind == "json" and multiline is None:
        first = spark.read.text(path).where(F.trim("value") != "").select(F.substring(F.trim("value"), 1, 1)).first()
        multiline = first is not None and first[0] == "["
    if kind == "json":
        return reader.option("multiLine", multiline).json(path)
    if kind == "csv":
        return read_csv(spark, path, schema, row_id=None)
    return reader.format(kind).load(path)


def _kind(name: str) -> str | None:
    suffix = name.rpartition(".")[2].lower()
    return {"jsonl": "json", "json": "json", "csv": "csv", "parquet": "parquet"}.get(suffix)


def _folder_kind(spark: SparkSession, path: str) -> str:
    """Format of the data files of a folder, by their names; Parquet if these do not tell."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return next((k for s in fs.listStatus(p) if (k := _kind(s.getPath().getName()))), "parquet")


def files_of_first_rows(df: DataFrame, n: int, read) -> DataFrame:
    """``read(files)`` over the leading files of ``df`` that hold its first ``n`` rows, in path order.

    Files are counted in growing runs (1, 2, 4, ... files; for Parquet from their footers), so
    only about the files that are needed are looked at.
    """
    # A scan may write file:/x where the file list says file:///x.
    plain = lambda f: f.replace(":///", ":/", 1)
    files = sorted(df.inputFiles(), key=plain)
    taken, rows, step = 0, 0, 1
    while taken < len(files) and rows < n:
        run = files[taken : taken + step]
        counted = read(run).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("c"))
        counts = {plain(r["f"]): r["c"] for r in counted.collect()}
        if not counts.keys() <= {plain(f) for f in run}:
            return df  # names that do not sort as the scan's: read everything
        for f in run:
            if rows >= n:
                break
            rows, taken = rows + counts.get(plain(f), 0), taken + 1
        step *= 2
    return df if taken == len(files) else read(files[:taken])


def table_row_id(df: DataFrame, key: Sequence[str] | None = None, out: str = "row_id") -> DataFrame:
    """Stable position 1..n of the rows of a table, which has no file order to go by.

    Rows are ordered by the md5 of their ``key`` columns joined by ``:`` (null: empty; all
    columns if none are given), then by the columns themselves: the same positions however the
    table is stored, from a histogram of key prefixes (``hash_ordinal``). Rows equal in every
    column share their positions in no fixed order.
    """
    names = list(key or df.columns)
    text = [F.coalesce(F.col(c).cast("string") if isinstance(df.schema[c].dataType, T.AtomicType) else F.to_json(c), F.lit("")) for c in names]
    rest = [c for c in df.columns if c not in names and isinstance(df.schema[c].dataType, T.AtomicType)]
    return hash_ordinal(df, F.md5(F.concat_ws(":", *text)), tie=[*text, *rest], out=out)


def read_prompts(
    spark: SparkSession,
    path: str,
    split: str = "train",
    config: str | None = None,
    schema: T.StructType | str | None = None,
    multiline_json: bool | None = None,
    format: str | None = None,
    row_id: bool = True,
    max_samples: int | None = None,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Load a prompt dataset by path or by table name.

    An existing path ending in ``.json``/``.jsonl``, ``.csv`` or ``.parquet``
    is read as that format (the split is ignored, as for a single data file);
    any other existing path is a dataset folder and its ``split`` subfolder
    (or ``split=...``, as ``write_prepared`` makes it) is loaded, in the format of its files. A path that does not exist is a catalog table, filtered on its
    ``config`` and ``split`` columns when it has them (a table partitioned by them reads only
    those partitions). ``row_id`` adds a position: file order for files, ``table_row_id`` by
    ``key`` for tables. ``max_samples`` keeps the first so many rows; of Parquet and JSON lines
    only the files that hold them are scanned.
    """
    if path_exists(spark, path):
        kind, at = _kind(path), path
        if kind is None:
            base = path.rstrip("/")
            at = next((p for p in (f"{base}/{split}", f"{base}/split={split}") if path_exists(spark, p)), f"{base}/{split}")
            kind = format or _folder_kind(spark, at)
        limited = max_samples is not None and max_samples > 0
        if kind == "csv":
            df = read_csv(spark, at, schema, "row_id")
        else:
            df = _read_file(spark, at, kind, schema, multiline_json)
            if limited:
                shape = df.schema
                df = files_of_first_rows(df, max_samples, lambda files: _read_file(spark, files, kind, shape, multiline_json))
            df = with_row_id(df) if row_id or limited else df
        df = limit_samples(df, max_samples)
        return df if row_id else df.drop("row_id")
    df = spark.table(path)
    if config is not None and "config" in df.columns:
        df = df.filter(F.col("config") == config)
    if "split" in df.columns:
        df = df.filter(F.col("split") == split)
    elif split != "train":
        raise ValueError(f"table {path} has no split column to take {split!r} from")
    limited = max_samples is not None and max_samples > 0
    if row_id or limited:
        df = limit_samples(table_row_id(df, key), max_samples)
    return df if row_id else df.drop("row_id")


def read_prompt_lines(spark: SparkSession, path: str, out: str = "prompt") -> DataFrame:
    """Prompt file, one prompt per line: ``(row_id, prompt)``.

    Line ends are ``\\n``, ``\\r\\n`` or ``\\r`` (Spark's text default, as in
    Python text mode). Blank lines are dropped and the rest stripped; the
    ``row_id`` is the line number, so input order is kept.
    """
    lines = with_row_id(spark.read.text(path))
    return clean_lines(lines, "value", out).select("row_id", out)


def read_sessions(spark: SparkSession, path: str, strict: bool = True, lines: bool | None = None, parts: bool | None = None) -> DataFrame:
    """Saved sessions: ``(name, system_prompt, messages)``, and ``part`` where documents have one.

    ``lines``: one document per line, as ``write_sessions`` makes them (so a folder with its
    ``_SUCCESS`` marker is taken for); else one document per file. ``name`` is the document's own
    or the file path, as ``/load`` names a file. Other keys are ignored.
    """
    if lines is None:
        lines = path_exists(spark, f"{path.rstrip('/')}/_SUCCESS") and spark.read.text(path).where(F.trim("value") != "").where(~F.trim("value").endswith("}")).isEmpty()
    raw = spark.read.text(path, wholetext=not lines).where(F.trim("value") != "").select(
        F.coalesce(F.get_json_object("value", "$.name"), F.col("_metadata.file_path")).alias("name"), F.get_json_object("value", "$.part").cast("long").alias("part"), F.col("value").alias("json")
    )
    parts = parts if parts is not None else bool(lines) and not raw.where("part is not null").isEmpty()
    return session_from_json(raw, "json", strict=strict).select("name", *(["part"] if parts else []), "system_prompt", "messages")
