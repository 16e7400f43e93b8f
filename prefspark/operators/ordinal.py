"""Exact 1..n positions without moving all rows into one task.

A global ``row_number()`` with no ``PARTITION BY`` sorts every row in a single
task. Here rows are cut into ordered buckets (a prefix of the sort key, or an
input split); a histogram gives each bucket's count, a running sum over the
histogram (one row per bucket, a bounded table) gives its offset, and each
row's position is its bucket offset plus its rank inside the bucket.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.session import shared_dir

# Most rows one hash bucket may hold before the histogram is rebuilt one hex
# digit finer (16x more buckets), so a bucket's rank window stays bounded.
MAX_BUCKET_ROWS = 4_000_000

# Largest derived table broadcast to every task; a bigger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def _cols(cs: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _row_bytes(df: DataFrame) -> F.Column:
    """Rough serialized size of each row: string/binary lengths plus 8 bytes a field."""
    parts = [F.lit(8 * len(df.schema.fields))]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.length(F.col(f.name)), F.lit(0)))
        elif not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
            parts.append(F.coalesce(F.length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def checked_table(df: DataFrame) -> tuple[DataFrame, int, int]:
    """Materialise a derived table in the shared checkpoint folder: (table, rows, ~bytes).

    The checkpoint also cuts its lineage, so a lost task re-reads it.
    """
    shared_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    # A checkpoint keeps the plan's attribute ids; fresh aliases keep joins back
    # to the table it came from unambiguous.
    df = df.select(*[F.col(c).alias(c) for c in df.columns])
    n, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return df, int(n), int(size or 0)


def checked_small(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                  max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Checkpointed table and whether it is small enough to broadcast.

    Small means at most ``max_rows`` rows and about ``max_bytes`` bytes.
    """
    df, n, size = checked_table(df)
    return df, n <= max_rows and size <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
               max_rows: int = BROADCAST_ROWS) -> DataFrame:
    small, fits = checked_small(small, max_rows)
    return null_safe_join(big, F.broadcast(small) if fits else small, on, how)


def null_safe_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of one name; a null key meets a null key. Keeps the left keys."""
    right = small.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return big.join(right, same, how).drop(*[f"_on_{c}" for c in on])


def _offsets(hist: DataFrame, groups: list[str], buckets: list[str]) -> DataFrame:
    """Running count before each bucket, and the group total, over the histogram."""
    w = Window.partitionBy(*groups).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)).cast("long")).withColumn(
        "_tot", F.sum("_n").over(Window.partitionBy(*groups)).cast("long"))


def exact_ordinal(
    df: DataFrame,
    buckets: Sequence[tuple[str, Column]],
    within: Sequence[Column | str],
    out: str = "ordinal",
    partition_by: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
    total: str | None = None,
) -> DataFrame:
    """Position 1..n (per ``partition_by`` group) in the order (buckets, within).

    ``buckets`` are named expressions whose order is a prefix of the wanted
    order; each bucket must hold a bounded number of rows (a hash prefix, an
    input split). ``total`` names a column with the group's row count n, taken
    from the histogram, so callers need no separate ``count()`` pass.
    """
    names = [n for n, _ in buckets]
    groups = list(partition_by)
    keyed = df.select("*", *[e.alias(n) for n, e in buckets])
    hist = keyed.groupBy(*groups, *names).agg(F.count(F.lit(1)).alias("_n"))
    offs = _offsets(hist, groups, names).drop("_n")
    joined = join_small(keyed, offs, groups + names, max_rows=max_rows)
    rank = F.row_number().over(Window.partitionBy(*groups, *names).orderBy(*_cols(within)))
    joined = joined.withColumn(out, F.col("_off") + rank)
    if total:
        joined = joined.withColumnRenamed("_tot", total)
    return joined.drop("_off", "_tot", *names)


MAX_REFINE = 4


def _hash_offsets(keyed: DataFrame, groups: list[str], digits: int, max_bucket: int) -> tuple[DataFrame, int]:
    """Checkpointed bucket histogram with offsets, refined until no bucket is too big.

    Refinement stops when a finer histogram no longer shrinks the biggest
    bucket (one key value repeated, which no prefix can split) and after
    ``MAX_REFINE`` extra digits, so it costs at most a few passes.
    """
    last = None
    for step in range(MAX_REFINE + 1):
        hist = keyed.groupBy(*groups, F.substring("_h", 1, digits).alias("_hb")).agg(F.count(F.lit(1)).alias("_n"))
        offs, _, _ = checked_table(_offsets(hist, groups, ["_hb"]))
        biggest = offs.agg(F.max("_n")).first()[0] or 0
        if biggest <= max_bucket or biggest == last or digits >= 32 or step == MAX_REFINE:
            return offs, digits
        last, digits = biggest, digits + 1
    return offs, digits


def hash_ordinal(
    df: DataFrame,
    key: Column,
    tie: Sequence[Column | str] = (),
    out: str = "ordinal",
    partition_by: Sequence[str] = (),
    digits: int = 4,
    total: str | None = None,
    max_bucket: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """Exact ordinal by a hex hash key: buckets are its first ``digits`` hex digits.

    16**digits buckets (65,536 by default); when a bucket would hold more than
    ``max_bucket`` rows the histogram is rebuilt one digit finer, so the rank
    window of a bucket stays bounded at any size.
    """
    groups = list(partition_by)
    keyed = df.withColumn("_h", key)
    offs, digits = _hash_offsets(keyed, groups, digits, max_bucket)
    keyed = keyed.withColumn("_hb", F.substring("_h", 1, digits))
    small = _fits(offs)
    offs = offs.drop("_n")
    joined = null_safe_join(keyed, F.broadcast(offs) if small else offs, groups + ["_hb"])
    rank = F.row_number().over(Window.partitionBy(*groups, "_hb").orderBy(F.col("_h"), *_cols(tie)))
    joined = joined.withColumn(out, F.col("_off") + rank)
    if total:
        joined = joined.withColumnRenamed("_tot", total)
    return joined.drop("_off", "_tot", "_h", "_hb")


def _fits(df: DataFrame) -> bool:
    n, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def _has_row_index(df: DataFrame) -> bool:
    try:
        df.select(F.col("_metadata.row_index")).schema
        return True
    except Exception:  # noqa: BLE001 - not a Parquet scan
        return False


def with_row_id(df: DataFrame, out: str = "row_id", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """File-order position 1..n of each row of a file-based DataFrame; no row is shuffled.

    Parquet: the position is the file's offset (running count over the files
    in path order, from a per-file histogram) plus ``_metadata.row_index``,
    which does not depend on how files are split or packed into tasks. Other
    formats order by (file path, split start, row inside the split): rows of
    one split are read by one task in order, so their
    ``monotonically_increasing_id`` values are consecutive and the rank is
    ``id - min(id)``. Only the histogram moves; it is broadcast when checked
    small, else joined by shuffle. A row whose file or split is missing from
    the histogram (input changed between jobs) fails the job.
    """
    if _has_row_index(df):
        base = df.select("*", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_i"))
        keys, hist = ["_f"], base.groupBy("_f").agg(F.count(F.lit(1)).alias("_n"))
        within = F.col("_i")
    else:
        base = df.select(
            "*",
            F.col("_metadata.file_path").alias("_f"),
            F.col("_metadata.file_block_start").alias("_b"),
            F.monotonically_increasing_id().alias("_m"),
        )
        keys = ["_f", "_b"]
        hist = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
        within = F.col("_m") - F.col("_m0")
    offs = _offsets(hist, [], keys).drop("_n", "_tot")
    joined = join_small(base, offs, keys, how="left", max_rows=max_rows)
    missing = F.raise_error(F.concat(F.lit("input changed while numbering rows: "), F.col("_f")))
    rid = F.when(F.col("_off").isNull(), missing).otherwise(F.col("_off") + within + F.lit(1)).cast("long")
    return joined.withColumn(out, rid).drop("_f", "_b", "_m", "_m0", "_i", "_off")


def hash_first(
    df: DataFrame,
    key: Column,
    tie: Sequence[Column | str],
    count: Callable[[Column], Column],
    out: str = "first",
    digits: int = 4,
    check: Callable[[Column, Column], Column] | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bucket: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """Flag the first ``count(n)`` rows in (hash key, tie) order, without ranking all rows.

    The bucket histogram settles every bucket that lies wholly before or after
    the cut; only the one bucket the cut falls in is shuffled and ranked
    (about n / 16**digits rows). ``count`` maps the total n (a column) to the
    number wanted; ``check(n, k)`` may return a column that raises on bad sizes.
    """
    keyed = df.select("*", key.alias("_h"))
    offs, digits = _hash_offsets(keyed, [], digits, max_bucket)
    keyed = keyed.withColumn("_hb", F.substring("_h", 1, digits))
    k = count(F.col("_tot"))
    where = (F.when(F.col("_off") + F.col("_n") <= k, F.lit(1))
             .when(F.col("_off") >= k, F.lit(0))
             .otherwise(F.lit(-1)))
    guard = check(F.col("_tot"), k) if check is not None else F.lit(None)
    offs = offs.select("_hb", where.alias("_where"), (k - F.col("_off")).alias("_need"), guard.alias("_guard"))
    x = join_small(keyed, offs, ["_hb"], max_rows=max_rows)
    x = x.withColumn("_where", F.coalesce(F.col("_guard").cast("int"), F.col("_where")))
    settled = x.filter(F.col("_where") >= 0).withColumn(out, F.col("_where") == 1)
    rank = F.row_number().over(Window.partitionBy("_hb").orderBy(F.col("_h"), *_cols(tie)))
    cut = x.filter(F.col("_where") < 0).withColumn(out, rank <= F.col("_need"))
    helpers = ["_h", "_hb", "_where", "_need", "_guard"]
    return settled.unionByName(cut).drop(*helpers)
