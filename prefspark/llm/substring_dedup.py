"""Removal of passages repeated across documents, by level-wise doubling (operator 8).

Lengths double up to the wanted window (13 words: 7, then 13). On each level only windows
whose text was repeated at the level before are extended, and the work ends early when none
survives.

* First level: of every document's shortest windows, those with the smallest hash among the
  neighbours that lie in one window of the next length (a winnowing choice). Any longer window
  two documents share holds the same chosen window in both, so nothing is lost, and about a
  quarter of the windows is shuffled.
* Each level: (hash, id, position) rows are aggregated to the smallest and largest id per hash
  (map-side combined, so a window held by a third of all documents is one row per task) and
  joined back; a join is dealt anew by AQE where a hash is hot.
* Last level: a window is removed from every document but the one with its smallest id.

Windows stand for their 64-bit hashes. Survivors travel as position lists of one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import Chunk, chunks, covered, map_with_ids, materialize, release, signed, strings, text_of

LOW32 = 0xFFFFFFFF


def levels(window: int, shortest: int = 8) -> list[int]:
    """Lengths up to ``window``, each at most twice the one before."""
    out = [window]
    while out[0] > shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def winnow(h: np.ndarray, at: np.ndarray, doc: np.ndarray, span: int) -> np.ndarray:
    """Indices of windows that are the smallest of some ``span`` neighbours in one text."""
    n = len(h) - span + 1
    if span <= 1 or n <= 0:
        return np.arange(len(h)) if span <= 1 else np.empty(0, np.int64)
    low = h[:n].copy()
    arg = np.arange(n)
    for i in range(1, span):
        better = h[i : n + i] < low
        low[better] = h[i : n + i][better]
        arg[better] = np.nonzero(better)[0] + i
    whole = doc[at[:n]] == doc[at[span - 1 :][:n]]
    return np.unique(arg[whole])


def _rows(ids: pd.Series, tags: np.ndarray, c: Chunk, h: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """(h, id, at): at holds a 32-bit tag of the text above the position in the document."""
    d = c.doc[at]
    where = (tags[c.lo : c.hi][d] << 32) | (at - c.first[d])
    return pd.DataFrame({"h": signed(h), "id": ids.array[c.lo : c.hi].take(d), "at": where})


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), (F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF))).alias("tag"), text.alias("text"))


def repeated_windows(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """``(id, tag, at)``: positions of windows whose words also start in a smaller id.

    None when no candidate survives. Rows with a null id are neither smaller nor larger than
    others and take no part.
    """
    lengths = levels(window)
    rows = _docs(docs, id_col, text_col).where("id is not null")
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"h bigint, id {kind}, at bigint"
    span = lengths[1] - lengths[0] + 1 if len(lengths) > 1 else 1

    def first_level(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tags = b["tag"].to_numpy()
            for c in chunks(b["text"]):
                h, at = c.windows(lengths[0])
                pick = winnow(h, at, c.doc, span)
                yield _rows(b["id"], tags, c, h[pick], at[pick])

    def extend(length: int, shorter: int, chosen: bool):
        """Candidate windows of ``length`` from the surviving positions of ``shorter`` ones."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                tags = b["tag"].to_numpy()
                for c in chunks(b["text"]):
                    alive = np.zeros(len(c.words) + 1, bool)
                    for k in range(c.lo, c.hi):
                        alive[c.first[k - c.lo] + np.asarray(b["pos"].iat[k], np.int64)] = True
                    h, at = c.windows(length)
                    reach = length - shorter
                    if chosen:  # some chosen shorter window inside
                        total = np.concatenate(([0], np.cumsum(alive)))
                        go = total[at + reach + 1] > total[at]
                    else:  # the shorter windows at both ends
                        go = alive[at] & alive[at + reach]
                    yield _rows(b["id"], tags, c, h[go], at[go])

        return run

    found = map_with_ids(rows, first_level, schema)
    for k, length in enumerate(lengths):
        last = k == len(lengths) - 1
        if k:
            found = materialize(map_with_ids(rows.join(alive, ["id", "tag"]), extend(length, lengths[k - 1], k == 1), schema), f"windows{length}")
            release(alive)
        ends = found.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
        shared = materialize(ends.select("h", "low"), f"shared{length}")
        hits = found.join(shared, "h")
        if last:
            hits = hits.where("id > low")
        hits = hits.groupBy("id", F.shiftright("at", 32).alias("tag")).agg(F.collect_list(F.col("at").bitwiseAND(F.lit(LOW32)).cast("int")).alias("pos"))
        alive = materialize(hits, f"alive{length}")
        release(shared)
        if k:
            release(found)
        if alive.isEmpty():
            return None
    return alive


def dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row as ``(id, n_words, n_removed, kept)``: kept words joined by one space.

    Texts shorter than a window lose nothing. Repeated rows of one id share one result.
    """
    rows = _docs(docs, id_col, text_col)
    marks = repeated_windows(docs, window, id_col, text_col)
    if marks is None:
        rows = rows.withColumn("pos", F.lit(None).cast("array<int>"))
    else:
        rows = rows.join(marks, ["id", "tag"], "left")
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, pos in zip(b["text"], b["pos"]):
                words = text.encode("utf-8", "replace").split()
                if pos is None:
                    out.append((len(words), 0, b" ".join(words).decode()))
                    continue
                keep = np.nonzero(~covered(np.asarray(pos, np.int64), window, len(words)))[0]
                out.append((len(words), len(words) - len(keep), b" ".join([words[i] for i in keep.tolist()]).decode()))
            n, removed, kept = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"id": b["id"].array, "n_words": np.array(n, np.int64), "n_removed": np.array(removed, np.int64), "kept": strings(kept)})

    return map_with_ids(rows.select("id", "text", "pos"), cut, f"id {kind}, n_words bigint, n_removed bigint, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def oracle(window: int = 13) -> str:
    """DuckDB SQL for ``query``: windows as strings."""
    run = " || ' ' || ".join(f"w[i + {k}]" if k else "w[i]" for k in range(window))
    return f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
x AS (SELECT doc_id, i, {run} AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {window - 2}, 1))) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS low FROM x GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM x JOIN m USING (g) WHERE doc_id > low),
r AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.p) AS kept FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.p = t.p WHERE gone.p IS NULL GROUP BY t.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(len(r.ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)"""
