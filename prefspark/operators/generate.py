"""Batch generation: clean prompt lines, build requests, call the user's model.

Only the model call leaves the JVM (``mapInPandas``, one Arrow batch at a
time, the model built once per Python worker). Each line is its own session,
and its seed comes from its ``row_id``, so a retried task gives the same text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.operators.judge import worker_model
from prefspark.functions.chat import message, render_messages
from prefspark.functions.text import is_blank, py_strip
from prefspark.operators.ordinal import BROADCAST_BYTES, BROADCAST_ROWS, checked_small, checked_table, join_small, null_safe_join
from prefspark.operators.sessions import build_messages
from prefspark.session import ship_code

# --------------------------------------------------------------------------- G0


def clean_lines(df: DataFrame, col: str = "value", out: str = "prompt") -> DataFrame:
    """Drop blank lines, strip the rest (Python ``str.strip``); order and duplicates kept."""
    return df.filter(F.col(col).isNotNull() & ~is_blank(F.col(col))).withColumn(out, py_strip(F.col(col)))


# --------------------------------------------------------------------------- G1


def batch_requests(
    df: DataFrame,
    prompt: str = "prompt",
    system_prompt: str | None = None,
    default_system: str | None = None,
    add_generation_prompt: bool = True,
    **template,
) -> DataFrame:
    """Fresh session per line: [system] + user line, rendered to model input."""
    staged = df.withColumn("messages", F.array(message("user", F.col(prompt))))
    staged = build_messages(staged, "messages", F.lit(system_prompt).cast("string"), default_system)
    return staged.withColumn("rendered", render_messages(F.col("messages"), add_generation_prompt, **template))


def batch_generate(
    df: DataFrame,
    make_generator: Callable[[], Callable[[pd.Series, pd.Series], pd.Series]],
    prompt: str = "prompt",
    row_id: str = "row_id",
    system_prompt: str | None = None,
    default_system: str | None = None,
    seed: int = 0,
    **template,
) -> DataFrame:
    """``(row_id, prompt, response)`` for every line.

    ``make_generator()`` returns ``generate(rendered: pd.Series, seeds:
    pd.Series) -> pd.Series`` of responses; it is built once per Python worker.
    Rows reach it in Arrow batches of ``spark.sql.execution.arrow.maxRecordsPerBatch``
    (the model's batch size); a retried task regenerates the same text, since
    each row's seed is ``seed + row_id``.
    """
    ship_code(df.sparkSession)
    req = batch_requests(df, prompt, system_prompt, default_system, **template)
    req = req.select(row_id, prompt, "rendered", (F.lit(seed) + F.col(row_id)).cast("long").alias("_seed"))
    key = uuid.uuid4().hex
    schema = T.StructType([req.schema[row_id], req.schema[prompt], T.StructField("response", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = worker_model(key, make_generator)
        for pdf in batches:
            resp = pd.Series(gen(pdf["rendered"], pdf["_seed"])).reset_index(drop=True)
            yield pd.DataFrame({row_id: pdf[row_id].values, prompt: pdf[prompt].values, "response": resp})

    return req.mapInPandas(run, schema)


# --------------------------------------------------------------------------- G2


HOT_CANDIDATES = 1 << 16
# Running sums round differently by order; a mass this close to ``top_p`` has reached it.
MASS_ROUNDING = 1e-12


def select_candidates(
    df: DataFrame,
    temperature: float = 0.7,
    top_k: int | None = 50,
    top_p: float = 0.9,
    group: str = "prompt_id",
    cand: str = "cand_id",
    score: str = "score",
    hot_rows: int = HOT_CANDIDATES,
) -> DataFrame:
    """Sampling limits over n-best scored candidates of each prompt.

    In sampling order: keep the ``top_k`` best scores (ties by ``cand_id``;
    null or <= 0 keeps all); ``prob`` is the softmax of score / temperature
    over those; the nucleus keeps a candidate while the mass ranked before it
    is below ``top_p``; ``kept_prob`` renormalises over what stays.

    With ``top_k`` the ``row_number <= k`` filter sits right on the ranking
    window, so Spark cuts each prompt to k rows on the map side before the
    shuffle. Without it, prompts with more than ``hot_rows`` candidates are
    ranked in buckets cut by quantile sketches (``_select_hot``) instead of one sort.
    """
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    limited = top_k is not None and top_k > 0
    if limited:
        return _select_windowed(df, temperature, top_k, top_p, group, cand, score)
    stats = df.groupBy(group).agg(F.count(F.lit(1)).alias("_c"))
    hot, small = checked_small(stats.filter(F.col("_c") > hot_rows).select(group))
    hot_b = F.broadcast(hot) if small else hot
    normal = df.join(hot_b.withColumnRenamed(group, "_hot"), F.col(group).eqNullSafe(F.col("_hot")), "left_anti")
    out = _select_windowed(normal, temperature, None, top_p, group, cand, score)
    if hot.isEmpty():
        return out
    hot_df = null_safe_join(df, hot_b, [group], "left_semi")
    return out.unionByName(_select_hot(hot_df, df.columns, temperature, top_p, group, cand, score, hot_rows))


def _select_windowed(df, temperature, top_k, top_p, group, cand, score) -> DataFrame:
    by = Window.partitionBy(group)
    ranked_w = by.orderBy(F.col(score).desc(), F.col(cand))
    x = df.withColumn("rank", F.row_number().over(ranked_w))
    if top_k is not None:
        x = x.filter(F.col("rank") <= F.lit(top_k))
    x = x.withColumn("_z", F.col(score) / F.lit(float(temperature)))
    x = x.withColumn("_e", F.exp(F.col("_z") - F.max("_z").over(by)))
    x = x.withColumn("prob", F.col("_e") / F.sum("_e").over(by))
    running = F.sum("prob").over(by.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("_before", running - F.col("prob"))
    if top_p < 1.0:
        x = x.filter(F.col("_before") < F.lit(float(top_p) - MASS_ROUNDING))
    x = x.withColumn("kept_prob", F.col("prob") / F.sum("prob").over(by))
    return x.drop("_z", "_e", "_before")


SPLITS = 64  # buckets one quantile sketch cuts a bucket into
SKETCH_ACCURACY = 2000  # a bound lies within 1/2000 of its bucket's rows from its rank
TEXT_STEP = 6  # bytes of a text id that one level of bounds looks at


def _order_key(level: Column, score: Column, cand: Column, kind: T.DataType) -> Column:
    """Numeric key of a refinement level: descending score, then the id (a text some bytes at a time).

    As in the ranking, NaN is the best score and null the worst. Null where an id has no more to look at.
    """
    best = F.when(score.isNull(), F.lit(float("inf"))).when(F.isnan(score), F.lit(float("-inf"))).otherwise(-score)
    if isinstance(kind, T.NumericType):
        rest = F.when(level == 1, F.coalesce(cand.cast("double"), F.lit(float("-inf"))))
    else:
        # A part's bytes as a number, padded with zeros, then how many bytes there are.
        part = F.substring(F.coalesce(cand.cast("string"), F.lit("")).cast("binary"), (level - 1) * TEXT_STEP + 1, F.lit(TEXT_STEP))
        number = F.conv(F.rpad(F.hex(part), 2 * TEXT_STEP, "0"), 16, 10).cast("double")
        rest = F.when(F.length(part) > 0, number * (TEXT_STEP + 1) + F.length(part))
    return F.when(level == 0, best).otherwise(rest)


def score_buckets(df: DataFrame, group: str, cand: str, score: str, hot_rows: int) -> DataFrame:
    """``df`` plus ``_b``: buckets of each group in ranking order (score descending, then id).

    Bounds come from mergeable quantile sketches (``percentile_approx``, combined on the map
    side), so they follow the scores wherever they lie. A bucket of over ``hot_rows`` rows is cut
    again by a sketch of its own; one whose rows share a score is cut by id. ``_b`` is the path
    of cuts, two digits a level, and sorts as text. Only rows with equal score and id can share
    a larger bucket.
    """
    kind = df.schema[cand].dataType
    ranks = [k / SPLITS for k in range(1, SPLITS)]
    x = df.withColumns({"_b": F.lit(""), "_level": F.lit(0)})
    while True:
        key = _order_key(F.col("_level"), F.col(score).cast("double"), F.col(cand), kind)
        stats = x.withColumn("_key", key).groupBy(group, "_b", "_level").agg(
            F.count(F.lit(1)).alias("_c"), F.count("_key").alias("_keys"), (F.min("_key") == F.max("_key")).alias("_one"),
            F.percentile_approx("_key", ranks, SKETCH_ACCURACY).alias("_q"))
        # Rows without a key on this level have the same id.
        big = stats.filter((F.col("_c") > hot_rows) & (F.col("_keys") > 0))
        cuts = F.least(F.lit(SPLITS), F.ceil(F.col("_c") * 2 / F.lit(hot_rows)).cast("int"))
        picked = F.transform(F.sequence(F.lit(1), cuts - 1), lambda i: F.element_at("_q", F.floor(i * SPLITS / cuts).cast("int")))
        single = F.col("_one") & (F.col("_keys") == F.col("_c"))
        big = big.select(group, "_b", "_level", single.alias("_single"), F.array_distinct(picked).alias("_bounds"))
        big, n, size = checked_table(big)
        if not n:
            return x.drop("_level")
        fits = n <= BROADCAST_ROWS and size <= BROADCAST_BYTES
        x = null_safe_join(x.withColumn("_key", key), F.broadcast(big) if fits else big, [group, "_b", "_level"], "left")
        # Keys between two bounds share a bucket, keys equal to a bound have one of their own.
        below, upto = F.filter("_bounds", lambda q: q < F.col("_key")), F.filter("_bounds", lambda q: q <= F.col("_key"))
        place = F.when(F.col("_key").isNull(), F.lit(0)).otherwise(1 + F.size(below) + F.size(upto))
        x = x.withColumns({
            "_b": F.when(F.col("_single"), F.col("_b")).when(~F.col("_single"), F.concat("_b", F.lpad(F.hex(place.cast("long")), 2, "0"))).otherwise(F.col("_b")),
            "_level": F.when(F.col("_single"), F.col("_level") + 1).otherwise(F.col("_level")),
        }).drop("_key", "_single", "_bounds")


def _select_hot(df, columns, temperature, top_p, group, cand, score, hot_rows) -> DataFrame:
    """Rank and running mass for prompts with very many candidates, exactly.

    Candidates are cut into ``score_buckets``. Softmax terms come from hash aggregates; a
    histogram per (prompt, bucket), one row per bucket, gives each bucket's rank and mass
    offsets; rows are then ranked and summed inside their bucket only.
    """
    t = F.lit(float(temperature))
    zmax = df.groupBy(group).agg((F.max(score) / t).alias("_zmax"))
    x = join_small(df, zmax, [group])
    x = x.withColumn("_e", F.exp(F.col(score) / t - F.col("_zmax")))
    denom = x.groupBy(group).agg(F.sum("_e").alias("_den"))
    x = join_small(x, denom, [group]).withColumn("prob", F.col("_e") / F.col("_den"))
    x = score_buckets(x, group, cand, score, hot_rows)
    hist = x.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"), F.sum("prob").alias("_m"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_roff"),
                       F.coalesce(F.sum("_m").over(before), F.lit(0.0)).alias("_moff"))
    x = join_small(x, hist, [group, "_b"])
    inner = Window.partitionBy(group, "_b").orderBy(F.col(score).desc(), F.col(cand))
    x = x.withColumn("rank", F.col("_roff") + F.row_number().over(inner))
    run = F.sum("prob").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    x = x.withColumn("_before", F.col("_moff") + run - F.col("prob"))
    if top_p < 1.0:
        x = x.filter(F.col("_before") < F.lit(float(top_p) - MASS_ROUNDING))
    kept = x.groupBy(group).agg(F.sum("prob").alias("_kept"))
    x = join_small(x, kept, [group]).withColumn("kept_prob", F.col("prob") / F.col("_kept"))
    return x.select(*columns, "rank", "prob", "kept_prob")
