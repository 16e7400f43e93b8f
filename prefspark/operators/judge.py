"""Pairwise judging: judge input text, scores, winners and reports.

Everything but the model is a column expression. ``score_pairs`` keeps both
sides of a pair in one row and calls the user's model once per Arrow batch
through ``mapInPandas``, so judging adds no shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.chat import first_user_content, user_messages
from prefspark.functions.scoring import yes_probability
from prefspark.functions.text import PY_NONSPACE, PY_SPACE
from prefspark.session import ship_code

# --------------------------------------------------------------------------- F1


def query_expr(prompt: Column, dtype: T.DataType, turn: str = "first") -> Column:
    """The judge's query from a prompt.

    Text: itself. Message list: content of the first user message (``""``
    when that has no content); no user: content of the first message; the
    empty list: the text ``[]``; null: ``None`` (Python's ``str(None)``).
    """
    if isinstance(dtype, T.StringType):
        return prompt
    if isinstance(dtype, T.ArrayType):
        has_user = F.size(user_messages(prompt)) > 0
        return (
            F.when(prompt.isNull(), F.lit("None"))
            .when(F.size(prompt) == 0, F.lit("[]"))
            .when(has_user, F.coalesce(first_user_content(prompt, turn), F.lit("")))
            .otherwise(F.coalesce(F.get(prompt, 0)["content"], F.lit("")))
        )
    return F.coalesce(prompt.cast("string"), F.lit("None"))


def judge_query(df: DataFrame, col: str = "prompt", out: str = "query", turn: str = "first") -> DataFrame:
    return df.withColumn(out, query_expr(F.col(col), df.schema[col].dataType, turn))


# --------------------------------------------------------------------------- F2, F3


def judge_input_expr(instruction: str, query: Column, document: Column) -> Column:
    """``<Instruct>: i\\n<Query>: q\\n<Document>: d`` (a null part reads ``None``)."""
    return F.concat(
        F.lit(f"<Instruct>: {instruction}\n<Query>: "),
        F.coalesce(query, F.lit("None")),
        F.lit("\n<Document>: "),
        F.coalesce(document, F.lit("None")),
    )


def judge_input(
    df: DataFrame, instruction: str, query: str = "query", document: str = "completion", out: str = "judge_input"
) -> DataFrame:
    return df.withColumn(out, judge_input_expr(instruction, F.col(query), F.col(document)))


# Word pieces: leading space, a run of non-space, trailing space. Joined back
# they give the text unchanged.
WORD_PIECE = rf"{PY_SPACE}*{PY_NONSPACE}+{PY_SPACE}*"


def word_pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PIECE), 0)


def count_word_pieces(text: str) -> int:
    return len(text.split())


def token_budget(max_length: int, prefix: str, suffix: str,
                 count: Callable[[str], int] = count_word_pieces) -> int:
    budget = max_length - count(prefix) - count(suffix)
    if budget < 1:
        raise ValueError(f"max_length {max_length} leaves no room between prefix and suffix")
    return budget


def truncate_expr(text: Column, budget: int, prefix: str = "", suffix: str = "",
                  pieces: Callable[[Column], Column] = word_pieces) -> Column:
    """prefix + the first ``budget`` tokens of ``text`` + suffix."""
    body = F.array_join(F.slice(pieces(F.coalesce(text, F.lit(""))), 1, budget), "")
    return F.concat(F.lit(prefix), body, F.lit(suffix))


def truncate_input(
    df: DataFrame,
    col: str = "judge_input",
    max_length: int = 8192,
    prefix: str = "",
    suffix: str = "",
    out: str | None = None,
    tokenizer: Callable[[str], list[str]] | None = None,
) -> DataFrame:
    """Keep the first tokens of ``col`` so prefix + body + suffix fit ``max_length``.

    Tokens are word pieces by default; ``tokenizer`` (text -> list of pieces
    whose concatenation is the text) swaps in a model tokenizer, run as an
    Arrow-batched pandas UDF.
    """
    if tokenizer is None:
        budget = token_budget(max_length, prefix, suffix)
        return df.withColumn(out or col, truncate_expr(F.col(col), budget, prefix, suffix))
    budget = token_budget(max_length, prefix, suffix, lambda s: len(tokenizer(s)))
    ship_code(df.sparkSession)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _pieces(s: pd.Series) -> pd.Series:
        return s.map(lambda x: list(tokenizer(x)))

    return df.withColumn(out or col, truncate_expr(F.col(col), budget, prefix, suffix, _pieces))


# --------------------------------------------------------------------------- F4


def judge_score(df: DataFrame, logit_yes: str = "logit_yes", logit_no: str = "logit_no",
                out: str = "score") -> DataFrame:
    return df.withColumn(out, yes_probability(F.col(logit_yes), F.col(logit_no)))


# --------------------------------------------------------------------------- F5

_MODEL: dict[str, Callable] = {}


def worker_model(key: str, make: Callable[[], Callable]) -> Callable:
    """The model of one call, built once per Python worker.

    ``key`` is unique to the call, and a worker keeps the model of the latest call only.
    """
    if key not in _MODEL:
        _MODEL.clear()
        _MODEL[key] = make()
    return _MODEL[key]


def score_pairs(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[pd.Series], pd.DataFrame]],
    instruction: str,
    max_length: int = 8192,
    prefix: str = "",
    suffix: str = "",
    prompt: str = "prompt",
    a: str = "completion_a",
    b: str = "completion_b",
    tokenizer: Callable[[str], list[str]] | None = None,
) -> DataFrame:
    """Score both completions of every pair with a user model and pick the winner.

    ``make_scorer()`` returns ``score(texts: pd.Series) -> pd.DataFrame`` with
    ``logit_yes`` and ``logit_no``; it is called once per Python worker.
    ``tokenizer`` sets what ``max_length`` counts (see ``truncate_input``).
    Adds ``score_a``, ``score_b`` and ``winner``. Only the two judge inputs go to
    Python and four numbers come back; the other columns stay in the JVM.
    """
    ship_code(df.sparkSession)
    q = query_expr(F.col(prompt), df.schema[prompt].dataType)
    staged = df.select("*", judge_input_expr(instruction, q, F.col(a)).alias("_in_a"),
                       judge_input_expr(instruction, q, F.col(b)).alias("_in_b"))
    for c in ("_in_a", "_in_b"):
        staged = truncate_input(staged, c, max_length, prefix, suffix, tokenizer=tokenizer)
    key = uuid.uuid4().hex

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = worker_model(key, make_scorer)
        for texts_a, texts_b in batches:
            sides = [model(t).reset_index(drop=True).astype("float64") for t in (texts_a, texts_b)]
            yield pd.DataFrame({f"{n}{side}": s[f"logit_{word}"] for side, s in zip("ab", sides)
                                for n, word in (("y", "yes"), ("n", "no"))})

    logits = F.pandas_udf(run, "ya double, na double, yb double, nb double")("_in_a", "_in_b")
    scored = staged.withColumn("_logits", logits).withColumns({
        "score_a": yes_probability(F.col("_logits.ya"), F.col("_logits.na")),
        "score_b": yes_probability(F.col("_logits.yb"), F.col("_logits.nb")),
    })
    return pick_winner(scored.drop("_in_a", "_in_b", "_logits"))


# --------------------------------------------------------------------------- F6

# Rubric features read off the shipped judge instruction, as
# regexes on lower-cased text, with their default weights (ours).
RUBRIC = {
    "opener": (r"^[ ]*(certainly|of course|absolutely|great question|i'd be happy to help)[!,. ]", -1.0),
    "self_ref": (r"as an ai\b|as a language model|i don't have feelings but", -1.0),
    "hedge": (r"it's important to note|it's worth mentioning|that said", -1.0),
    "list_line": (r"(?m)^[ \t]*([0-9]+[.)]|[-*])[ \t]", -0.25),
    "closer": (r"let me know if you need anything else|hope this helps", -1.0),
    "contraction": (r"[a-z]'(t|s|re|ve|ll|d|m)\b", 0.5),
    "unsure": (r"i don't know", 1.0),
}
LENGTH_WEIGHT = -1.0
LENGTH_SCALE = 2000.0


def rubric_features(text: Column) -> dict[str, Column]:
    low = F.lower(F.coalesce(text, F.lit("")))
    return {name: F.regexp_count(low, F.lit(pattern)).cast("long") for name, (pattern, _) in RUBRIC.items()}


def rubric_score(
    df: DataFrame,
    col: str = "text",
    weights: dict[str, float] | None = None,
    length_weight: float = LENGTH_WEIGHT,
    out: str = "score",
    keep_features: bool = True,
) -> DataFrame:
    """Model-free judge: weighted rubric feature counts as the yes-logit.

    ``logit_yes = sum(w_f * count_f) + length_weight * length / 2000``,
    ``logit_no = 0``; the score is their two-way softmax.
    """
    w = {name: wt for name, (_, wt) in RUBRIC.items()}
    w.update(weights or {})
    feats = rubric_features(F.col(col))
    staged = df.select("*", *[c.alias(n) for n, c in feats.items()])
    logit = F.lit(length_weight) * F.length(F.coalesce(F.col(col), F.lit(""))) / F.lit(LENGTH_SCALE)
    for name in feats:
        logit = logit + F.lit(w[name]) * F.col(name)
    staged = staged.withColumn("logit_yes", logit).withColumn("logit_no", F.lit(0.0))
    staged = judge_score(staged, out=out)
    if not keep_features:
        staged = staged.drop(*feats)
    return staged


# --------------------------------------------------------------------------- F7


def pair_completions(
    prompts: DataFrame,
    a: DataFrame,
    b: DataFrame,
    key: str = "pair_id",
    prompt: str = "prompt",
    completion: str = "completion",
) -> DataFrame:
    """Strict zip by ``key``: every key must have one prompt and both sides.

    One shuffle on ``key`` (a union then a group), no join; a missing or
    repeated side fails the job.
    """
    slots = ((prompt, "p", prompts.schema[prompt].dataType),
             ("completion_a", "a", T.StringType()),
             ("completion_b", "b", T.StringType()))

    def side(df: DataFrame, src: str, tag: str) -> DataFrame:
        cols = [F.col(key)]
        cols += [(F.col(src) if t == tag else F.lit(None)).cast(dt).alias(n) for n, t, dt in slots]
        cols += [F.lit(int(t == tag)).alias(f"_{t}") for _, t, _ in slots]
        return df.select(*cols)

    p, pa, pb = side(prompts, prompt, "p"), side(a, completion, "a"), side(b, completion, "b")
    grouped = p.unionByName(pa).unionByName(pb).groupBy(key).agg(
        F.first(prompt, ignorenulls=True).alias(prompt),
        F.first("completion_a", ignorenulls=True).alias("completion_a"),
        F.first("completion_b", ignorenulls=True).alias("completion_b"),
        F.sum("_p").alias("_p"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"),
    )
    ok = (F.col("_p") == 1) & (F.col("_a") == 1) & (F.col("_b") == 1)
    check = F.when(ok, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"pair {key}="), F.col(key).cast("string"),
                               F.lit(" does not have exactly one prompt and two completions")))
    )
    return grouped.filter(check).drop("_p", "_a", "_b")


# --------------------------------------------------------------------------- F8, F9, F10


def winner_expr(a: Column, b: Column) -> Column:
    """0 when a >= b, else 1, with Python's NaN rule (any NaN: 1); null fails."""
    a, b = a.cast("double"), b.cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.raise_error(F.lit("null score")))
        .when(F.isnan(a) | F.isnan(b), F.lit(1))
        .when(a >= b, F.lit(0))
        .otherwise(F.lit(1))
    ).cast("int")


def pick_winner(df: DataFrame, a: str = "score_a", b: str = "score_b", out: str = "winner") -> DataFrame:
    return df.withColumn(out, winner_expr(F.col(a), F.col(b)))


def preference_pairs(
    df: DataFrame,
    a: str = "completion_a",
    b: str = "completion_b",
    score_a: str = "score_a",
    score_b: str = "score_b",
    winner: str = "winner",
) -> DataFrame:
    """Chosen/rejected form: ``chosen``, ``rejected``, their scores and ``margin``."""
    first = F.col(winner) == 0
    return (
        df.withColumn("chosen", F.when(first, F.col(a)).otherwise(F.col(b)))
        .withColumn("rejected", F.when(first, F.col(b)).otherwise(F.col(a)))
        .withColumn("chosen_score", F.when(first, F.col(score_a)).otherwise(F.col(score_b)))
        .withColumn("rejected_score", F.when(first, F.col(score_b)).otherwise(F.col(score_a)))
        .withColumn("margin", F.col("chosen_score") - F.col("rejected_score"))
    )


def win_report(
    df: DataFrame,
    group: Sequence[str] = (),
    totals: bool = True,
    winner: str = "winner",
    score_a: str = "score_a",
    score_b: str = "score_b",
) -> DataFrame:
    """Pairs, win rate of side a, tie rate and mean scores, by group (+ total)."""
    group = list(group)
    aggs = [
        F.count(F.lit(1)).alias("n_pairs"),
        F.sum(F.when(F.col(winner) == 0, 1).otherwise(0)).cast("long").alias("wins_a"),
        F.avg(F.when(F.col(winner) == 0, 1.0).otherwise(0.0)).alias("win_rate_a"),
        # Spark holds NaN = NaN; a pair without scores is no tie.
        F.avg(F.when((F.col(score_a) == F.col(score_b)) & ~F.isnan(score_a), 1.0).otherwise(0.0)).alias("tie_rate"),
        F.avg(score_a).alias("mean_score_a"),
        F.avg(score_b).alias("mean_score_b"),
    ]
    if group and totals:
        g = df.rollup(*group)
        level = F.grouping_id(*group).alias("level")
        return g.agg(level, *aggs)
    if group:
        return df.groupBy(*group).agg(F.lit(0).cast("long").alias("level"), *aggs)
    return df.agg(F.lit(0).cast("long").alias("level"), *aggs)
