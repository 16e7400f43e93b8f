"""Quality rules with adaptive thresholds (operator 7).

Each text gets its counts in one pass. Every signal is an integer, and its distribution per
(language, source) is held in a mergeable quantile sketch: a histogram over integer cells that
are exact below 64 and at most 1/32 wide relative to their value above it. Two sketches merge
by adding counts, so Spark builds them by partial aggregation and those of a language (or of
all rows) are sums of those of its sources. Each group has its own fences, which replace fixed
cutoffs: its median plus (or minus) a multiple of its spread, the distance from the median to a
tail quantile of the sketch, or one cell of the sketch where that is less. Which quantile tells
ordinary texts from the rest depends on the signal: most texts have no symbols and an ordinary
length of words, while repeated lines and words are rare but ordinary. The verdict joins the
fences to the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.llm.common import chunks, covered, materialize, mix, packed, text_of

SYMBOLS = b"#*$%&|<>"
#: Signal: (lower tail quantile or None if not judged below, upper one, multiple of the spread).
SIGNALS = {"symbol_rate": (None, 75, 3), "dup_rate": (None, 99, 3), "repeat_rate": (None, 99, 3), "word_len": (25, 75, 8)}
MIN_ROWS = 50
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint"


def counts(texts: Iterable[str]) -> np.ndarray:
    """One row of ``COUNTS`` per text."""
    out = []
    for c in chunks(texts):
        n = c.hi - c.lo
        data = np.frombuffer(c.raw, np.uint8)
        by_doc = lambda x: np.bincount(x, minlength=n)
        inner = np.add.reduceat((data & 0xC0) == 0x80, c.begin[:-1], dtype=np.int64)
        chars = np.bincount(c.doc, weights=c.ends - c.starts, minlength=n).astype(np.int64) - inner
        raws = [c.raw[a : b - 1] for a, b in zip(c.begin[:-1].tolist(), c.begin[1:].tolist())]
        symbols = [len(r) - len(r.translate(None, SYMBOLS)) for r in raws]
        lines = [[x for x in r.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")] for r in raws]
        w, at = c.windows(5)
        repeat = np.zeros(n, np.int64)
        if len(w):
            w = mix(w + c.doc[at].astype(np.uint64))
            order = np.sort(w)
            twice = order[1:][order[1:] == order[:-1]]
            if len(twice):
                hit = at[np.isin(w, twice)]
                repeat = by_doc(c.doc[covered(hit, 5, len(c.words))])
        out.append(np.column_stack([np.diff(c.first), chars, symbols, [len(x) - len(set(x)) for x in lines], repeat, [len(x) for x in lines]]))
    return np.concatenate(out) if out else np.empty((0, 6), np.int64)


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the counts as one struct column ``_q``."""

    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(counts(batch).astype(np.int64), columns=[c.split()[0] for c in COUNTS.split(", ")])

    return docs.withColumn("_q", F.pandas_udf(measure, COUNTS)(text_of(text_col)))


def _rate(a: str, b: str, by: int) -> Column:
    return F.when(F.col(b) > 0, F.floor(F.col(a) * by / F.col(b)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def signals() -> dict[str, Column]:
    return {
        "symbol_rate": _rate("_q.n_symbols", "_q.word_chars", 1000),
        "dup_rate": _rate("_q.n_dup_lines", "_q.n_lines", 1000),
        "repeat_rate": _rate("_q.n_repeat_words", "_q.n_words", 1000),
        "word_len": _rate("_q.word_chars", "_q.n_words", 100),
    }


def base_failed() -> Column:
    return (F.col("_q.n_words") < 10) | (F.col("_q.n_repeat_words") * 100 > F.col("_q.n_words") * 20)


def cell_width(x: Column) -> Column:
    e = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    return F.pow(F.lit(2.0), e).cast("bigint")


def cell(x: Column) -> Column:
    """Lower end of the sketch cell of a non-negative integer."""
    return x - x % cell_width(x)


def sketch(measured: DataFrame) -> DataFrame:
    """``(lang, source, signal, cell, n)``: one sketch per group and signal; merge by summing n.

    Texts failing the base rule say nothing about ordinary texts of their group and are left out.
    """
    s = signals()
    long = measured.where(~base_failed()).select("lang", "source", F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), cell(v).alias("cell")) for k, v in s.items()])).alias("s"))
    return long.groupBy("lang", "source", "s.signal", "s.cell").agg(F.count("*").alias("n"))


def _of_signal(signal: Column, place: int) -> Column:
    out = F.lit(None).cast("bigint")
    for k, v in SIGNALS.items():
        out = F.when(signal == k, F.lit(v[place]).cast("bigint")).otherwise(out)
    return out


def fences(cells: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Fences ``lo``/``hi`` by signal for every (lang, source).

    A group of fewer than ``min_rows`` texts takes the merged sketch of its language, and a
    language of fewer that of all rows.
    """

    def quantiles(level: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by, "signal").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        total = Window.partitionBy(*by, "signal")
        r = level.withColumn("run", F.sum("n").over(w)).withColumn("total", F.sum("n").over(total))
        q = lambda p: F.min(F.when(F.col("run") * 100 >= F.col("total") * p, F.col("cell")))
        tails = (F.coalesce(_of_signal(F.col("signal"), 0), F.lit(50)), _of_signal(F.col("signal"), 1))
        return r.groupBy(*by, "signal").agg(F.max("total").alias("rows"), q(tails[0]).alias("ql"), q(50).alias("qm"), q(tails[1]).alias("qu"))

    merged = lambda by: cells.groupBy(*by, "signal", "cell").agg(F.sum("n").alias("n"))
    own = quantiles(cells, ["lang", "source"]).alias("o")
    lang = quantiles(merged(["lang"]), ["lang"]).alias("l")
    every = quantiles(merged([]), []).alias("e")
    j = own.join(lang, F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.signal") == F.col("l.signal")), "left").join(every, F.col("o.signal") == F.col("e.signal"), "left")
    pick = lambda c: F.when(F.col("o.rows") >= min_rows, F.col(f"o.{c}")).when(F.col("l.rows") >= min_rows, F.col(f"l.{c}")).otherwise(F.col(f"e.{c}"))
    out = j.select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.col("o.signal").alias("signal"), *[pick(c).alias(c) for c in ("ql", "qm", "qu")])
    times, least = _of_signal(F.col("signal"), 2), cell_width(F.col("qm"))
    lo = F.col("qm") - times * F.greatest(F.col("qm") - F.col("ql"), least)
    hi = F.col("qm") + times * F.greatest(F.col("qu") - F.col("qm"), least)
    return out.select("lang", "source", "signal", lo.alias("lo"), hi.alias("hi"))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = MIN_ROWS) -> DataFrame:
    """``docs`` with the counts ``_q``, ``_base_failed`` and ``_kept``.

    Null languages and sources are groups of their own. Empty texts fail the base rule.
    The text is measured twice (once for the sketches, once for the verdict), which costs less
    than shuffling it. The fences are a table of one row per group, joined by size.
    """
    rows = _judged(docs, text_col, lang_col, source_col, min_rows)
    return rows.select("row.*", "_q", "_base_failed", "_kept")


def _judged(docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_rows: int) -> DataFrame:
    """``(row, _q, _base_failed, _kept)``, each row in a struct."""
    rows = packed(docs, text=F.col(text_col), lang=F.col(lang_col), source=F.col(source_col))
    limits = materialize(fences(materialize(sketch(with_counts(rows.drop("row"))), "quality_sketch"), min_rows), "quality_fences")
    wide = limits.groupBy(F.col("lang").alias("_l"), F.col("source").alias("_s")).agg(*[F.max(F.when(F.col("signal") == k, F.col(c))).alias(f"_{k}_{c}") for k in SIGNALS for c in ("lo", "hi")])
    rows = with_counts(rows)
    rows = rows.join(wide, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    bad = base_failed()
    for k, v in signals().items():
        bad = bad | F.coalesce(v > F.col(f"_{k}_hi"), F.lit(False))
        if SIGNALS[k][0] is not None:
            bad = bad | F.coalesce(v < F.col(f"_{k}_lo"), F.lit(False))
    return rows.select("row", "_q", base_failed().alias("_base_failed"), (~bad).alias("_kept"))


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows of ``docs`` that pass the rules, with its own columns."""
    return _judged(docs, text_col, lang_col, source_col, min_rows).where("_kept").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    q = judged(docs)
    return q.select("doc_id", *[F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def oracle() -> str:
    """DuckDB SQL for ``query``."""
    names = list(SIGNALS)
    long = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS signal, {k} AS v FROM s WHERE NOT base_failed" for k in names)
    of = lambda place: "CASE signal " + " ".join(f"WHEN '{k}' THEN {50 if SIGNALS[k][place] is None else SIGNALS[k][place]}" for k in names) + " END"
    pick = lambda c: f"CASE WHEN o.n >= {MIN_ROWS} THEN o.{c} WHEN l.n >= {MIN_ROWS} THEN l.{c} ELSE e.{c} END"

    def quantiles(by: str) -> str:
        keys = f"{by}, signal" if by else "signal"
        return f"""SELECT {keys}, max(total) AS n, min(CASE WHEN run * 100 >= total * {of(0)} THEN cell END) AS ql,
  min(CASE WHEN run * 100 >= total * 50 THEN cell END) AS qm, min(CASE WHEN run * 100 >= total * {of(1)} THEN cell END) AS qu
FROM (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY cell) AS run, sum(n) OVER (PARTITION BY {keys}) AS total
      FROM (SELECT {keys}, cell, sum(n) AS n FROM c GROUP BY {keys}, cell)) GROUP BY {keys}"""

    bad = " OR ".join([f"coalesce(s.{k} > f.{k}_hi, false)" for k in names] + [f"coalesce(s.{k} < f.{k}_lo, false)" for k in names if SIGNALS[k][0] is not None])
    wide = ", ".join(f"max({c}) FILTER (signal = '{k}') AS {k}_{c}" for k in names for c in ("lo", "hi"))
    return f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM d)),
h AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(*) AS n_repeat FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 5)) AS p FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines FROM d LEFT JOIN r USING (doc_id)),
s AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END AS symbol_rate, CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_rate,
             CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeat_rate, CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_len FROM m),
v AS ({long}),
c AS (SELECT lang, source, signal, v - v % (1 << greatest(length(bin(v)) - 6, 0)) AS cell, count(*) AS n FROM v GROUP BY ALL),
o AS ({quantiles('lang, source')}), l AS ({quantiles('lang')}), e AS ({quantiles('')}),
q AS (SELECT o.lang, o.source, o.signal, {pick('ql')} AS ql, {pick('qm')} AS qm, {pick('qu')} AS qu
      FROM o LEFT JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.signal = l.signal LEFT JOIN e ON o.signal = e.signal),
b AS (SELECT lang, source, signal, qm - {of(2)} * greatest(qm - ql, 1 << greatest(length(bin(qm)) - 6, 0)) AS lo,
             qm + {of(2)} * greatest(qu - qm, 1 << greatest(length(bin(qm)) - 6, 0)) AS hi FROM q),
f AS (SELECT lang, source, {wide} FROM b GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR {bad}) AS kept
FROM s LEFT JOIN f ON s.lang IS NOT DISTINCT FROM f.lang AND s.source IS NOT DISTINCT FROM f.source"""
