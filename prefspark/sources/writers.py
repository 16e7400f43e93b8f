"""Writers: responses, sessions, prepared splits and run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.operators.ordinal import checked_table, join_small, null_safe_join
from prefspark.operators.sessions import session_to_json
from prefspark.sources.files import path_exists

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("phase", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


CELLS = 1 << 16  # cells of the histogram that bounds are taken from
MANIFEST = "_manifest"  # a folder that readers of the data files skip


def ordered_parts(df: DataFrame, row_id: str, rows_per_part: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_part``, and ``(part, n_rows, first_row_id, last_row_id)`` of every part.

    Parts are runs of ``row_id`` of about ``rows_per_part`` rows. Their bounds come from a
    histogram of ``CELLS`` equal ranges of ``row_id`` (exact counts, not a sample), so they
    are the same at every run; rows of one cell stay together.
    """
    lo, hi = df.agg(F.min(row_id), F.max(row_id)).first()
    width = max(1, -(-((hi or 0) - (lo or 0) + 1) // CELLS))
    cell = F.floor((F.col(row_id) - F.lit(lo or 0)) / F.lit(width)).cast("long")
    x = df.withColumn("_cell", F.coalesce(cell, F.lit(0)))
    hist = x.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_first"), F.max(row_id).alias("_last"))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # at most CELLS rows
    hist = hist.withColumn("_part", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.lit(rows_per_part)).cast("long"))
    # Parts are numbered without gaps: a cell of many rows may jump over some.
    hist = hist.withColumn("_part", (F.dense_rank().over(Window.orderBy("_part")) - 1).cast("int"))
    hist, _, _ = checked_table(hist)
    x = null_safe_join(x, F.broadcast(hist.select("_cell", "_part")), ["_cell"]).drop("_cell")
    parts = hist.groupBy(F.col("_part").alias("part")).agg(
        F.sum("_n").alias("n_rows"), F.min("_first").alias("first_row_id"), F.max("_last").alias("last_row_id"))
    return x, parts


def write_responses(df: DataFrame, path: str, row_id: str = "row_id", mode: str = "overwrite", rows_per_file: int = 1 << 20) -> None:
    """JSON lines ``{"prompt", "response"}`` in input order, and a manifest of the files.

    Every part of ``ordered_parts`` is one file, written by one task; file names follow the
    order of parts. ``path/_manifest`` has a JSON line ``(part, file, n_rows, first_row_id,
    last_row_id)`` for each; the files one after another in its order are the input in order.
    """
    spark = df.sparkSession
    x, parts = ordered_parts(df, row_id, rows_per_file)
    n = parts.count()
    laid = x.repartitionById(max(1, n), F.col("_part")).sortWithinPartitions(row_id)
    laid.select("prompt", "response").write.mode(mode).option("ignoreNullFields", "false").json(path)
    files = sorted(spark.read.text(path).inputFiles())
    names = [(k, f.rpartition("/")[2]) for k, f in enumerate(files)]
    if n and len(names) != n:
        raise RuntimeError(f"{len(names)} files for {n} parts in {path}")
    table = spark.createDataFrame(names, "part int, file string").join(parts, "part")
    table.orderBy("part").coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/{MANIFEST}")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """``(position, prompt, response)`` of what ``write_responses`` wrote; position 1..n is the input order."""
    manifest = spark.read.schema("part int, file string, n_rows bigint").json(f"{path.rstrip('/')}/{MANIFEST}")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.select("part", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_before"), "file")
    rows = spark.read.schema("prompt string, response string").json(path)
    rows = rows.select("prompt", "response", F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_m"))
    blocks = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_c"), F.min("_m").alias("_m0"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "_block", "_m0", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_in_file"))
    placed = join_small(blocks, manifest, ["file"])
    rows = join_small(rows, placed.select("file", "_block", (F.col("_before") + F.col("_in_file") - F.col("_m0") + 1).alias("_add")), ["file", "_block"])
    return rows.select((F.col("_m") + F.col("_add")).cast("long").alias("position"), "prompt", "response")


def write_sessions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per line: name and part (where there are any), system prompt (null kept), messages."""
    doc = F.col("json")
    lead = [c for c in ("name", "part") if c in df.columns]
    if lead:
        first = F.to_json(F.struct(*lead))
        doc = F.when(first == "{}", doc).otherwise(F.concat(F.left(first, F.length(first) - 1), F.lit(","), F.substring(doc, F.lit(2), F.length(doc))))
    session_to_json(df).select(doc.alias("json")).write.mode(mode).text(path)


def write_prepared(df: DataFrame, path: str, split: str = "split", mode: str = "overwrite") -> None:
    """Prepared prompts as Parquet, one folder per split."""
    df.write.mode(mode).partitionBy(split).parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Add ``(run_id, phase, metric, value)`` rows that the table does not hold yet.

    Rows become visible only when the job commits. Writing again, after a failure or by a
    retried run, adds what is missing and nothing twice, so one set of rows remains.
    """
    spark = df.sparkSession
    new = df.select([F.col(f.name).cast(f.dataType) for f in METRICS.fields]).distinct()
    if path_exists(spark, path) and not _empty(spark, path):
        held = spark.read.schema(METRICS).parquet(path)
        new = null_safe_join(new, held, [f.name for f in METRICS.fields], "left_anti")
    new.write.mode("append").parquet(path)


def _empty(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds no data file (what an attempt left behind does not count)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return not any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(p))


def metrics_frame(spark, run_id: str, phase: str, values: dict[str, float]) -> DataFrame:
    rows = [(run_id, phase, k, float(v)) for k, v in values.items()]
    return spark.createDataFrame(rows, METRICS)
