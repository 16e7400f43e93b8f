"""Every registered query against its DuckDB oracle (small scale)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from prefspark.plans import queries as core

from conftest import SF_SMALL

TABLES = "documents labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    """Exact values: both sides round doubles to 6 places themselves."""
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("key", sorted(core.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    exp = Counter(tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == exp


def test_queries_without_sql_run(spark):
    for key in core.queries().keys() - core.oracle_sql().keys():
        assert entry.queries()[key](spark, SF_SMALL).count() > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 1
    assert "win_rate_a" in df.columns


CONF_KEYS = ["session_history", "replay_sessions", "replay_messages", "seeded_shuffle", "train_eval_split",
             "assign_batches", "select_candidates_nucleus", "pair_completions", "batch_prompt_lines"]


@pytest.mark.parametrize("key", CONF_KEYS)
def test_query_without_aqe_and_many_partitions(spark, duck, key):
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.enabled", "false")
    other.conf.set("spark.sql.shuffle.partitions", "200")
    df = entry.queries()[key](other, SF_SMALL)
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[key])
    exp = Counter(tuple(_norm(dict(zip(rel.columns, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == exp
