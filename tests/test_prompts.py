import json

import pytest
from pyspark.sql import functions as F

from prefspark.operators import prompts
from prefspark.types import MESSAGES

CASES = [
    [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}, {"role": "user", "content": "more"}],
    [{"role": "system", "content": "s"}, {"role": "assistant", "content": "a"}, {"role": "assistant", "content": "b"}],
    [{"role": "assistant", "content": "only"}],
    [],
    [{"role": None, "content": "no role"}, {"role": "assistant", "content": "x"}],
    [{"role": "assistant", "content": "first"}, {"role": "user", "content": "later user"}],
]

# The prompts of CASES: the user messages, or all but the last message where no user speaks.
PROMPTS = [
    [{"role": "user", "content": "hi"}, {"role": "user", "content": "more"}],
    [{"role": "system", "content": "s"}, {"role": "assistant", "content": "a"}],
    [],
    [],
    [{"role": None, "content": "no role"}],
    [{"role": "user", "content": "later user"}],
]


def _msgs(spark, rows):
    return spark.createDataFrame([(i, m) for i, m in enumerate(rows)], f"id long, messages {MESSAGES.simpleString()}")


def _plain(rows):
    return [[{"role": m["role"], "content": m["content"]} for m in r] for r in rows]


def test_messages_to_prompt_matches_fold(spark):
    out = prompts.messages_to_prompt(_msgs(spark, CASES)).orderBy("id").collect()
    got = [[m.asDict() for m in r.prompt] for r in out]
    assert got == PROMPTS


def test_messages_null_strict_raises_and_lenient_gives_empty(spark):
    df = spark.createDataFrame([(0, None)], f"id long, messages {MESSAGES.simpleString()}")
    with pytest.raises(Exception, match="null messages"):
        prompts.messages_to_prompt(df).collect()
    assert prompts.messages_to_prompt(df, strict=False).collect()[0].prompt == []


def test_decode_json_messages(spark):
    texts = [json.dumps(c) for c in _plain(CASES)] + ["[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, messages string")
    got = [[m.asDict() for m in r.prompt] for r in prompts.messages_to_prompt(df).orderBy("id").collect()]
    assert got == [*PROMPTS, []]


def test_decode_malformed_json(spark):
    df = spark.createDataFrame([(0, "[{not json")], "id long, messages string")
    with pytest.raises(Exception):
        prompts.decode_messages(df).collect()
    assert prompts.decode_messages(df, strict=False).collect()[0].messages is None


def test_instruction_to_prompt(spark):
    rows = [(0, "Do", None), (1, "Do", ""), (2, "Do", "   "), (3, "Do", "text")]
    df = spark.createDataFrame(rows, "id long, instruction string, input string")
    got = [[m.asDict() for m in r.prompt] for r in prompts.instruction_to_prompt(df).orderBy("id").collect()]
    assert got == [[{"role": "user", "content": c}] for c in ("Do", "Do", "Do\n\n   ", "Do\n\ntext")]


def test_instruction_absent_input_column(spark):
    df = spark.createDataFrame([(0, "Only")], "id long, instruction string")
    assert prompts.instruction_to_prompt(df).collect()[0].prompt[0].content == "Only"


def test_rename_prompt(spark):
    df = spark.createDataFrame([(1, "q")], "id long, question string")
    assert prompts.rename_prompt(df, "question").columns == ["id", "prompt"]
    assert prompts.rename_prompt(df, "missing").columns == ["id", "question"]
    both = df.withColumn("prompt", F.lit("x"))
    with pytest.raises(ValueError):
        prompts.rename_prompt(both, "question")


def test_prepare_prompts_dispatch(spark):
    df = _msgs(spark, CASES[:1])
    assert "prompt" in prompts.prepare_prompts(df, "messages").columns
    with pytest.raises(ValueError):
        prompts.prepare_prompts(df, "other")


def test_prompt_ops_have_no_python_udf(spark):
    df = prompts.instruction_to_prompt(
        spark.createDataFrame([(0, "a", "b")], "id long, instruction string, input string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
