import json

import pytest

from pyspark.sql import functions as F

from prefspark.operators import prompts, sampling, sessions
from prefspark.sources import readers, writers
from prefspark.types import MESSAGES

from conftest import SF_SMALL

MSG = [{"role": "user", "content": "q, with \"quotes\"\nand a newline"}, {"role": "assistant", "content": "a"}]


def test_read_json_and_jsonl(spark, scratch):
    path = scratch("p") + ".json"
    spark.createDataFrame([(1, "x"), (2, "y")], "id long, prompt string").coalesce(1).write.json(path)
    df = readers.read_prompts(spark, path)
    assert sorted(r.prompt for r in df.collect()) == ["x", "y"]
    assert sorted(r.row_id for r in df.collect()) == [1, 2]


def test_read_multiline_json_array(spark, scratch, tmp_path):
    path = scratch("arr") + ".json"
    spark.createDataFrame([(json.dumps([{"prompt": "a"}, {"prompt": "b"}], indent=2),)], "v string") \
        .coalesce(1).write.text(path)
    df = readers.read_prompts(spark, path, multiline_json=True, row_id=False)
    assert sorted(r.prompt for r in df.collect()) == ["a", "b"]


def test_read_csv_with_quoted_newline(spark, scratch):
    path = scratch("c") + ".csv"
    spark.createDataFrame([(1, "line one\nline two, \"quoted\"")], "id long, prompt string") \
        .coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    df = readers.read_prompts(spark, path, row_id=False)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].prompt == "line one\nline two, \"quoted\""


CSV_ROWS = [("a", "plain"), ("b", 'said "hi"\nand\n\nleft'), ("c", ""), ("d", "x" * 300), ("e", "\n\n"), ("f", 'tail "'), ("g", "1,2\r\n3"), ("h", '""'), ("i", " padded ")]


def _csv_file(path, rows, end="\n", blank=False):
    quoted = lambda v: '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') or v == "" else v
    lines = ["id,prompt"] + [f"{i},{quoted(t)}" for i, t in rows]
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write((end + (end if blank else "")).join(lines) + end)


@pytest.mark.parametrize("split", [1, 7, 40, 10_000_000])
@pytest.mark.parametrize("end,blank", [("\n", False), ("\r\n", False), ("\n", True)])
def test_csv_records_across_any_splits(spark, scratch, tmp_path, split, end, blank):
    run = spark.newSession()
    run.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    run.conf.set("spark.sql.files.openCostInBytes", "0")
    for k in range(2):
        _csv_file(tmp_path / f"{k}.csv", CSV_ROWS[k:], end, blank)
    df = readers.read_prompts(run, str(tmp_path), format="csv", split=".")
    got = sorted((r.row_id, r.id, r.prompt or "") for r in df.collect())
    want = CSV_ROWS + CSV_ROWS[1:]
    assert got == [(n, i, t) for n, (i, t) in enumerate(want, 1)]
    if split < 100:
        assert df.rdd.getNumPartitions() > 2


def test_csv_unclosed_quote_and_wrong_shape_fail(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,prompt\n1,"never closed\n2,x\n')
    with pytest.raises(Exception, match="not closed"):
        readers.read_prompts(spark, str(tmp_path / "open.csv")).collect()
    (tmp_path / "wide.csv").write_text("id,prompt\n1,a,b\n")
    with pytest.raises(Exception):
        readers.read_prompts(spark, str(tmp_path / "wide.csv")).collect()


def test_read_dataset_folder_split(spark, scratch):
    base = scratch("ds")
    spark.createDataFrame([("t",)], "prompt string").write.parquet(f"{base}/train")
    spark.createDataFrame([("v",)], "prompt string").write.parquet(f"{base}/validation")
    assert readers.read_prompts(spark, base, split="validation").first().prompt == "v"


def test_read_catalog_table(spark):
    spark.createDataFrame([("a", "c1", "train"), ("b", "c2", "train"), ("c", "c1", "test")],
                          "prompt string, config string, split string").createOrReplaceTempView("prompt_tbl")
    df = readers.read_prompts(spark, "prompt_tbl", split="train", config="c1")
    assert [r.prompt for r in df.collect()] == ["a"]


def test_parquet_source_prunes_and_pushes_down(spark):
    df = readers.read_prompts(spark, f"{SF_SMALL}/conversations.parquet", row_id=False)
    df = prompts.rename_prompt(df, "text").filter(F.col("role") == "user").select("prompt")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in plan
    assert "ReadSchema: struct<role:string,text:string>" in plan


def test_sessions_write_and_read_back(spark, scratch):
    path = scratch("sessions")
    df = spark.createDataFrame([(0, None, MSG), (1, "sys", [])],
                               f"id long, system_prompt string, messages {MESSAGES.simpleString()}")
    writers.write_sessions(df, path)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert '"system_prompt":null' in text
    one = scratch("one") + ".json"
    spark.createDataFrame([(json.dumps({"system_prompt": None, "messages": MSG, "extra": 1}, indent=2),)], "v string") \
        .coalesce(1).write.text(one)
    back = readers.read_sessions(spark, one).first()
    assert back.system_prompt is None and [m.asDict() for m in back.messages] == MSG


def test_load_from_saved_session_files(spark, scratch):
    one = scratch("saved") + ".json"
    spark.createDataFrame([(json.dumps({"system_prompt": "S", "messages": MSG}),)], "v string") \
        .coalesce(1).write.text(one)
    saved = readers.read_sessions(spark, one)
    name = saved.first().name
    ev = spark.createDataFrame([(1, 1, "user", "hi"), (1, 2, "user", f"/load {name}"), (1, 3, "user", "more")],
                               "session_id long, seq long, role string, text string")
    r = sessions.replay_sessions(ev, saved=saved).first()
    assert r.system_prompt == "S" and [m.content for m in r.messages][-1] == "more" and len(r.messages) == 3


def test_write_responses_in_order(spark, scratch):
    path = scratch("resp")
    df = spark.createDataFrame([(i, f"p{i}", f"r{i}") for i in range(50)], "row_id long, prompt string, response string")
    writers.write_responses(df.repartition(7), path)
    files = sorted(f for f in spark.read.json(path).inputFiles())
    got = [json.loads(line)["prompt"] for f in files for line in open(f.replace("file:", ""), encoding="utf-8")]
    assert got == [f"p{i}" for i in range(50)]


def test_write_prepared_and_metrics(spark, scratch):
    base = scratch("prep")
    df = spark.createDataFrame([("a", "train"), ("b", "eval")], "prompt string, split string")
    writers.write_prepared(df, base)
    assert readers.read_prompts(spark, base, split="split=eval", row_id=False).first().prompt == "b"
    m = scratch("metrics")
    writers.write_metrics(writers.metrics_frame(spark, "r1", "train", {"loss": 0.5}), m)
    writers.write_metrics(writers.metrics_frame(spark, "r1", "train", {"loss": 0.4}), m)
    assert spark.read.parquet(m).count() == 2


def test_json_messages_mixed_list_and_string_rows(spark, scratch):
    path = scratch("mixed") + ".jsonl"
    lines = [json.dumps({"id": 1, "messages": MSG}), json.dumps({"id": 2, "messages": json.dumps(MSG)}),
             json.dumps({"id": 3, "messages": []})]
    spark.createDataFrame([(ln,) for ln in lines], "v string").coalesce(1).write.text(path)
    df = readers.read_prompts(spark, path, schema="id BIGINT, messages STRING", row_id=False)
    got = {r.id: [m.asDict() for m in r.prompt] for r in prompts.prepare_prompts(df, "messages").collect()}
    assert got == {1: MSG[:1], 2: MSG[:1], 3: []}


def test_sessions_keep_their_number_and_names(spark, scratch):
    path = scratch("many")
    df = spark.createDataFrame([(f"s{i}", None if i % 2 else "S", MSG) for i in range(6)], "name string, system_prompt string, messages array<struct<role:string,content:string>>")
    writers.write_sessions(df.repartition(2), path)
    back = readers.read_sessions(spark, path).collect()
    assert sorted((r.name, r.system_prompt, [m.asDict() for m in r.messages]) for r in back if r.system_prompt) == [(f"s{i}", "S", MSG) for i in (0, 2, 4)]
    assert len(back) == 6


def test_prepared_splits_are_read_by_name(spark, scratch):
    base = scratch("prep")
    writers.write_prepared(spark.createDataFrame([("a", "train"), ("b", "eval")], "prompt string, split string"), base)
    assert readers.read_prompts(spark, base).first().prompt == "a"
    assert readers.read_prompts(spark, base, split="eval").first().prompt == "b"


def test_malformed_lines_fail_and_arrays_are_recognised(spark, scratch):
    path = scratch("bad") + ".jsonl"
    spark.createDataFrame([('{"prompt": "a"}',), ('{"prompt": ',)], "v string").coalesce(1).write.text(path)
    with pytest.raises(Exception):
        readers.read_prompts(spark, path, schema="prompt string", row_id=False).collect()
    path = scratch("array") + ".json"
    spark.createDataFrame([('[\n {"prompt": "a"},\n {"prompt": "b"}\n]',)], "v string").coalesce(1).write.text(path)
    assert sorted(r.prompt for r in readers.read_prompts(spark, path, row_id=False).collect()) == ["a", "b"]


def test_responses_keep_null_keys(spark, scratch):
    path = scratch("resp")
    writers.write_responses(spark.createDataFrame([(1, "p", None)], "row_id long, prompt string, response string"), path)
    assert json.loads(spark.read.text(path).first().value) == {"prompt": "p", "response": None}


def test_first_rows_scan_only_their_files(spark, scratch):
    path = scratch("many") + ".parquet"
    spark.range(1000).repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(path)
    df = readers.read_prompts(spark, path, max_samples=120)
    assert len(df.inputFiles()) <= 4
    assert sorted((r.row_id, r.id) for r in df.collect()) == [(k + 1, k) for k in range(120)]
    assert readers.read_prompts(spark, path, max_samples=5000).count() == 1000
    assert len(readers.read_prompts(spark, path, max_samples=0).inputFiles()) == 20
    lines = scratch("lines") + ".jsonl"
    spark.range(300).repartitionByRange(10, "id").sortWithinPartitions("id").write.json(lines)
    df = readers.read_prompts(spark, lines, max_samples=40, row_id=False)
    assert len(df.inputFiles()) <= 3 and sorted(r.id for r in df.collect()) == list(range(40))


def test_catalog_table_has_stable_rows_and_prunes_partitions(spark, scratch):
    rows = [(k, f"p{k}", f"c{k % 2}", "train" if k % 3 else "test") for k in range(60)]
    for name, parts in (("rows_a", 1), ("rows_b", 7)):
        spark.createDataFrame(rows, "id long, prompt string, config string, split string").repartition(parts).write \
            .partitionBy("config", "split").option("path", scratch(name)).mode("overwrite").saveAsTable(name)
    try:
        a, b = (readers.read_prompts(spark, n, config="c1", key=["id"]) for n in ("rows_a", "rows_b"))
        got = sorted((r.row_id, r.id) for r in a.collect())
        assert got == sorted((r.row_id, r.id) for r in b.collect())
        assert [k for k, _ in got] == list(range(1, 21))
        plan = a._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(config" in plan and "(split" in plan
        assert readers.read_prompts(spark, "rows_a", config="c1", key=["id"], max_samples=5).count() == 5
        assert sampling.train_eval_split(a, 0.1).where("split = 'eval'").count() == 2
        assert sampling.assign_batches(a, order="permutation").count() == 20
        every = readers.read_prompts(spark, "rows_a")
        assert sorted(r.row_id for r in every.collect()) == list(range(1, 41))
    finally:
        for n in ("rows_a", "rows_b"):
            spark.sql(f"drop table {n}")


def test_responses_read_back_in_manifest_order(spark, scratch):
    path = scratch("resp")
    ids = [k * k for k in range(500)]  # gaps of growing size
    df = spark.createDataFrame([(i, f"p{i}", f"r{i}" if i % 5 else None) for i in ids], "row_id long, prompt string, response string")
    writers.write_responses(df.repartition(9), path, rows_per_file=60)
    manifest = spark.read.json(f"{path}/_manifest").orderBy("part").collect()
    assert len(manifest) > 4 and sum(r.n_rows for r in manifest) == 500
    lines = [json.loads(line)["prompt"] for r in manifest for line in open(f"{path}/{r.file}".replace("file:", ""), encoding="utf-8")]
    assert lines == [f"p{i}" for i in ids]
    run = spark.newSession()
    run.conf.set("spark.sql.files.maxPartitionBytes", "300")
    back = writers.read_responses(run, path).orderBy("position").collect()
    assert [(r.position, r.prompt, r.response) for r in back] == [(k + 1, f"p{i}", f"r{i}" if i % 5 else None) for k, i in enumerate(ids)]
    empty = scratch("none")
    writers.write_responses(df.limit(0), empty)
    assert writers.read_responses(spark, empty).count() == 0


def test_metrics_written_again_stay_one_set(spark, scratch):
    m = scratch("metrics")
    full = spark.createDataFrame([("r1", "train", "loss", 0.5), ("r1", "train", "acc", float("nan")), ("r1", None, "x", None)], writers.METRICS)
    writers.write_metrics(full.where("metric = 'loss'"), m)
    for _ in range(3):
        writers.write_metrics(full.union(full), m)
    assert spark.read.parquet(m).count() == 3


def test_session_parts_are_kept(spark, scratch):
    path = scratch("parts")
    rows = [("s", 0, "S", MSG), ("s", 1, "S", MSG[:1]), ("t", 0, None, [])]
    df = spark.createDataFrame(rows, f"name string, part long, system_prompt string, messages {MESSAGES.simpleString()}")
    writers.write_sessions(df, path)
    back = readers.read_sessions(spark, path)
    assert sorted((r.name, r.part, len(r.messages)) for r in back.collect()) == [("s", 0, 2), ("s", 1, 1), ("t", 0, 0)]
    whole = {r.name: len(r.messages) for r in sessions.whole_saved(back).collect()}
    assert whole == {"s": 3, "t": 0}
