"""License scans by diagonal voting (operator 6). DataFrame functions only.

Every 3-word gram of a text is joined to the template positions that hold the same gram
(templates are a fixed short list, so the table is broadcast). A hit votes for the diagonal
``word position - template position``. Votes are counted per diagonal, neighbouring diagonals
(a few inserted or dropped words) are merged, and a merged span is verified: it must hold
``COVERAGE`` of the template's grams within a span not much longer than the template. A phrase
must be held whole on a single diagonal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.llm.common import text_of

GRAM = 3
GAP = 4
COVERAGE = 0.7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# The phrases of the scan, and the customary notices of public licenses.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
]


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``(gram, t, t_pos, t_grams, label, base)``: every gram position of every template."""
    rows = [(t, label, text.split(), base) for t, (label, text, base) in enumerate([*((a, b, True) for a, b in phrases), *((a, b, False) for a, b in notices)])]
    flat = [(t, i, len(w) - GRAM + 1, label, base, *w[i : i + GRAM]) for t, label, w, base in rows for i in range(len(w) - GRAM + 1)]
    df = spark.createDataFrame(flat, "t int, t_pos int, t_grams int, label string, base boolean, a string, b string, c string")
    return df.select(F.xxhash64("a", "b", "c").alias("gram"), "t", "t_pos", "t_grams", "label", "base")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_WORD, -1), "")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE, gap: int = GAP) -> DataFrame:
    """One row per input row: ``id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``spans`` are the verified (label, first word, end word, coverage); ``score`` is the best
    coverage of any template, 0 where nothing votes. A text without words has no labels.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), words_of(text_of(text_col)).alias("w"))
    # The entry at -1 keeps every row, with or without hits, in the one pass over the texts.
    each = rows.select("row", "id", F.size("w").alias("n"), "w", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("w") - GRAM, F.lit(-1)))).alias("pos"))
    gram = F.xxhash64(*[F.get("w", F.col("pos") + i) for i in range(GRAM)])
    each = each.select("row", "id", "n", "pos", F.when(F.col("pos") >= 0, gram).alias("gram"))
    hits = each.join(F.broadcast(templates(spark)), "gram", "left").where("pos = -1 or t is not null")
    diagonal = (F.col("pos") - F.coalesce("t_pos", F.lit(0))).alias("diagonal")
    first = lambda c: F.max(c).alias(c)
    votes = hits.groupBy("row", "t", diagonal).agg(first("id"), first("n"), first("t_grams"), first("label"), first("base"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("t_pos").alias("held"))
    by = Window.partitionBy("row", "t").orderBy("diagonal")
    new = F.when(F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(by) > gap) | F.lag("diagonal").over(by).isNull(), 1).otherwise(0)
    merged = votes.withColumn("new", new).withColumn("run", F.sum("new").over(by))
    merged = merged.groupBy("row", "t", "run").agg(first("id"), first("n"), first("t_grams"), first("label"), first("base"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"))
    share = F.col("held") / F.col("t_grams")
    whole = F.when(F.col("base") | (F.col("t_grams") <= 3), share >= 1).otherwise((share >= coverage) & (F.col("hi") - F.col("lo") < F.col("t_grams") * 3 / 2 + gap))
    merged = merged.withColumn("share", share).withColumn("ok", F.col("t").isNotNull() & whole)
    place = F.when(F.col("base") & F.col("ok"), F.col("lo"))
    names = lambda when: F.array_join(F.array_sort(F.collect_set(F.when(when, F.col("label")))), ",")
    span = F.when(F.col("ok"), F.struct("label", F.col("lo").alias("first"), (F.col("hi") + GRAM).alias("end"), F.col("share").alias("coverage")))
    return merged.groupBy("row").agg(
        first("id"), F.max("n").cast("bigint").alias("n_words"), F.count(place).alias("n_base"), F.min(place).cast("bigint").alias("first_word"), F.max(place).cast("bigint").alias("last_word"),
        names(F.col("base") & F.col("ok")).alias("base_labels"), names(F.col("ok")).alias("labels"), F.coalesce(F.max("share"), F.lit(0.0)).alias("score"), F.array_sort(F.collect_list(span)).alias("spans"),
    ).drop("row")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def oracle() -> str:
    """DuckDB SQL for ``query``: grams joined as strings instead of hashes."""
    every = [(label, text, True) for label, text in PHRASES] + [(label, text, False) for label, text in NOTICES]
    values = ", ".join(f"({t}, '{label}', {str(base).lower()}, '{text}')" for t, (label, text, base) in enumerate(every))
    return f"""
WITH tm AS (SELECT t, label, base, string_split(txt, ' ') AS w FROM (VALUES {values}) v(t, label, base, txt)),
tg AS (SELECT t, label, base, len(w) - 2 AS t_grams, i - 1 AS t_pos, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS gram
       FROM tm, range(1, 80) r(i) WHERE i <= len(w) - 2),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents),
dg AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS gram
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d)),
v AS (SELECT doc_id, t, pos - t_pos AS diagonal, any_value(t_grams) AS t_grams, any_value(label) AS label, any_value(base) AS base,
             min(pos) AS lo, max(pos) AS hi, list(DISTINCT t_pos) AS held FROM dg JOIN tg USING (gram) GROUP BY ALL),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS run FROM (
       SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > {GAP}, true) THEN 1 ELSE 0 END AS fresh FROM v)),
m AS (SELECT doc_id, t, run, any_value(t_grams) AS t_grams, any_value(label) AS label, any_value(base) AS base, min(lo) AS lo, max(hi) AS hi,
             len(list_distinct(flatten(list(held)))) / any_value(t_grams) AS share FROM r GROUP BY doc_id, t, run),
k AS (SELECT *, CASE WHEN base OR t_grams <= 3 THEN share >= 1 ELSE share >= {COVERAGE} AND hi - lo < t_grams * 3 / 2 + {GAP} END AS ok FROM m),
a AS (SELECT doc_id, count(*) FILTER (base AND ok) AS n_base, min(lo) FILTER (base AND ok) AS first_word, max(lo) FILTER (base AND ok) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND ok) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok) AS labels, max(share) AS score
      FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (doc_id)"""
