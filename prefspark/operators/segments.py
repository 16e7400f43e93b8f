"""Split hot groups into contiguous parts so no task holds one whole group.

A group (session, conversation, prompt) with at most ``part_size`` rows keeps
``part`` 0. A longer one is cut by ranges of its order column into about
count / part_size parts. Finding such groups is one hash aggregate with
map-side combining; the hot-group table (at most rows / part_size groups) is
broadcast behind a size check. Operators then work per (group, part) and
stitch the parts with small per-part tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prefspark.operators.ordinal import BROADCAST_BYTES, BROADCAST_ROWS, checked_small, checked_table, null_safe_join

PART_SIZE = 1 << 16


def hot_parts(
    df: DataFrame,
    key: str,
    order: str,
    part_size: int = PART_SIZE,
    spans: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus ``part`` (0 unless the group is hot) and ``_hot``."""
    return split_hot(df, key, order, part_size, spans)[0]


def split_hot(
    df: DataFrame,
    key: str,
    order: str,
    part_size: int = PART_SIZE,
    spans: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """``hot_parts`` and whether any group is hot (if none, no join is added).

    Rows with a null order go to part 0.

    ``spans`` (``key, _c, _lo, _hi``: an upper bound on the row count and the
    order range per group) replaces the aggregate when the caller has it.
    """
    if spans is None:
        spans = df.groupBy(key).agg(
            F.count(F.lit(1)).alias("_c"), F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    hot = spans.filter(F.col("_c") > part_size).select(
        key, "_lo", "_hi", F.ceil(F.col("_c") / F.lit(part_size)).alias("_np"))
    hot, n_hot, size = checked_table(hot)
    if n_hot == 0:
        return df.withColumn("part", F.lit(0).cast("long")).withColumn("_hot", F.lit(False)), False
    small = n_hot <= BROADCAST_ROWS and size <= BROADCAST_BYTES
    tagged = null_safe_join(df, F.broadcast(hot) if small else hot, [key], "left")
    width = (F.col("_hi") - F.col("_lo") + F.lit(1)).cast("double") / F.col("_np")
    part = F.when(F.col("_np").isNull() | F.col(order).isNull(), F.lit(0)).otherwise(
        F.floor((F.col(order) - F.col("_lo")).cast("double") / width)).cast("long")
    tagged = tagged.withColumn("part", part).withColumn("_hot", F.col("_np").isNotNull())
    return tagged.drop("_lo", "_hi", "_np"), True


def shift_within(
    df: DataFrame,
    group: str,
    order: str,
    cols: Sequence[str],
    offset: int,
    names: Sequence[str] | None = None,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """``lag`` (offset 1) or ``lead`` (offset -1) of ``cols`` within ``group`` by ``order``.

    Exact for hot groups too: the window runs per (group, part), and the
    first (or last) row of a part takes its value from the nearest non-empty
    part before (or after) it.
    """
    if offset not in (1, -1):
        raise ValueError("offset must be 1 (lag) or -1 (lead)")
    names = list(names or [f"{'prev' if offset == 1 else 'next'}_{c}" for c in cols])
    x, any_hot = split_hot(df, group, order, part_size)
    w = Window.partitionBy(group, "part").orderBy(F.col(order) if offset == 1 else F.col(order).desc())
    if not any_hot:
        return x.select(*df.columns, *[F.lag(c).over(w).alias(n) for c, n in zip(cols, names)])
    edge_row = F.row_number().over(w) == 1
    vals = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by if offset == 1 else F.min_by
    ends = x.filter(F.col("_hot")).groupBy(group, "part").agg(pick(vals, F.col(order)).alias("_end"))
    by_part = Window.partitionBy(group).orderBy("part")
    ends = ends.select(group, "part", (F.lag if offset == 1 else F.lead)("_end").over(by_part).alias("_halo"))
    ends, small = checked_small(ends)
    x = null_safe_join(x, F.broadcast(ends) if small else ends, [group, "part"], "left")
    shifted = [F.lag(c).over(w) for c in cols]  # w runs backwards for a lead
    out = [F.when(edge_row & F.col("_hot"), F.col("_halo")[c]).otherwise(s).alias(n)
           for c, s, n in zip(cols, shifted, names)]
    return x.select(*df.columns, *out)
