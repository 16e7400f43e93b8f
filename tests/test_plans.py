
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

NO_PYTHON = [
    "messages_to_prompt", "messages_decode", "instruction_to_prompt", "prompt_rename", "judge_query",
    "judge_input", "truncate_input", "judge_score", "rubric_score", "sessions_from_turns", "build_messages",
    "render_chat", "turn_contexts", "replay_sessions", "seeded_shuffle", "train_eval_split", "assign_batches",
    "limit_samples", "exact_ordinal", "batch_prompt_lines", "select_candidates", "win_report",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", NO_PYTHON)
def test_no_python_in_plan(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert op not in plan, f"{key} runs {op}"


@pytest.mark.parametrize("key", ["seeded_shuffle", "train_eval_split", "exact_ordinal", "limit_samples"])
def test_no_single_partition_exchange(spark, key):
    plan = _plan(entry.queries()[key](spark, SF_SMALL))
    assert "SinglePartition" not in plan


def test_column_pruning_reaches_documents_scan(spark):
    plan = _plan(entry.queries()["seeded_shuffle"](spark, SF_SMALL))
    scans = [ln for ln in plan.splitlines() if "documents.parquet" in ln or "ReadSchema" in ln]
    assert scans and all("text" not in ln for ln in scans if "ReadSchema" in ln)
