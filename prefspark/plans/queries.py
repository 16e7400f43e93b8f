"""Registered queries: one per operator key, each with its DuckDB oracle SQL.

Every query reads the given tables (or data Spark derives from them) whole.
Outputs are primitive columns (strings, bigints, doubles rounded to 6
places) so that the Spark result and the oracle compare value for value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefspark.functions.chat import CHATML_END, CHATML_START
from prefspark.operators import generate, judge, objective, ordinal, prompts, rubric_fit, sampling, sessions
from prefspark.plans import fixtures as fx
from prefspark.plans import models
from prefspark.plans.fixtures import SQL_SEP, msg_text, sql_msg_text, sql_str
from prefspark.session import scratch_path
from prefspark.sources import readers, writers
from prefspark.streaming import final_sessions, live_sessions, read_prompts_stream, replay_sessions_stream
from prefspark.streaming.sessions import ROCKSDB
from prefspark.types import SESSION_EVENT

Query = Callable[[SparkSession, str], DataFrame]

# The judge's prompt prefix and suffix, as written in the reference.
JUDGE_PREFIX = (
    '<|im_start|>system\nJudge whether the Document meets the requirements based on the Query and the '
    'Instruct provided. Note that the answer can only be "yes" or "no".<|im_end|>\n<|im_start|>user\n'
)
JUDGE_SUFFIX = "<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n"
TRUNCATE_LENGTH = 128


def r6(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def nan_null(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def big(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("long")


_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


# =========================================================================== C


def _prompt_out(df: DataFrame) -> DataFrame:
    return df.select("conv_id", big(F.size("prompt")).alias("n_prompt"), msg_text(F.col("prompt")).alias("prompt_text"))


def _sql_prompt(where: str) -> str:
    users = "list_filter(messages, lambda m: m.role = 'user')"
    return f"""
with s as ({fx.SQL_MESSAGES.format(where=where)}),
p as (select conv_id, case when len({users}) > 0 then {users}
                           else list_slice(messages, 1, len(messages) - 1) end as prompt from s)
select conv_id, len(prompt)::bigint as n_prompt, {sql_msg_text('prompt')} as prompt_text from p
"""


@register("messages_to_prompt", _sql_prompt(""))
def q_messages_to_prompt(spark, d):
    return _prompt_out(prompts.messages_to_prompt(fx.conversation_messages(spark, d)))


@register("messages_to_prompt_fallback", _sql_prompt("where role <> 'user'"))
def q_messages_to_prompt_fallback(spark, d):
    msgs = fx.conversation_messages(spark, d, F.col("role") != "user")
    return _prompt_out(prompts.messages_to_prompt(msgs))


@register("messages_decode", f"""
with s as ({fx.SQL_MESSAGES.format(where="")})
select conv_id, len(messages)::bigint as n_messages, {sql_msg_text('messages')} as messages_text from s
""")
def q_messages_decode(spark, d):
    encoded = fx.conversation_messages(spark, d).select("conv_id", F.to_json("messages").alias("messages"))
    decoded = prompts.decode_messages(encoded, "messages")
    return decoded.select("conv_id", big(F.size("messages")).alias("n_messages"),
                          msg_text(F.col("messages")).alias("messages_text"))


@register("prompt_rename", "select conv_id, turn, text as prompt from conversations")
def q_prompt_rename(spark, d):
    df = fx.table(spark, d, "conversations").select("conv_id", "turn", "text")
    return prompts.rename_prompt(df, "text").select("conv_id", "turn", "prompt")


@register("instruction_to_prompt", f"""
with {fx.SQL_INSTRUCTIONS},
c as (select doc_id, case when input is not null and length(input) > 0
                          then instruction || chr(10) || chr(10) || input else instruction end as content from ins)
select doc_id, 1::bigint as n_prompt, 'user' as role, md5(content) as content_md5,
       length(content)::bigint as content_len from c
""")
def q_instruction_to_prompt(spark, d):
    df = prompts.instruction_to_prompt(fx.instruction_rows(spark, d))
    first = F.get(F.col("prompt"), 0)
    return df.select("doc_id", big(F.size("prompt")).alias("n_prompt"), first["role"].alias("role"),
                     F.md5(first["content"]).alias("content_md5"), big(F.length(first["content"])).alias("content_len"))


@register("read_parquet_prompts", f"""
select row_id::bigint as row_id, conv_id, turn, text as prompt from ({fx.SQL_CONV_ROWS})
""")
def q_read_parquet_prompts(spark, d):
    df = readers.read_prompts(spark, f"{d.rstrip('/')}/conversations.parquet")
    df = prompts.prepare_prompts(df, "prompt", prompt_column="text")
    return df.select("row_id", "conv_id", "turn", "prompt")


@register("read_json_prompts", _sql_prompt(""))
def q_read_json_prompts(spark, d):
    path = scratch_path(spark, "prompts") + ".jsonl"
    fx.conversation_messages(spark, d).write.json(path)
    schema = "conv_id BIGINT, messages ARRAY<STRUCT<role: STRING, content: STRING>>"
    df = readers.read_prompts(spark, path, schema=schema, row_id=False)
    return _prompt_out(prompts.prepare_prompts(df, "messages"))


@register("read_csv_prompts", "select row_number() over (order by doc_id) as row_id, doc_id, lang, text as prompt from documents")
def q_read_csv_prompts(spark, d):
    path = scratch_path(spark, "prompts") + ".csv"
    docs = fx.table(spark, d, "documents").select("doc_id", "lang", "text")
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "header": True}
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.options(**keep).csv(path)
    df = readers.read_prompts(spark, path, schema="doc_id BIGINT, lang STRING, text STRING")
    df = prompts.prepare_prompts(df, "prompt", prompt_column="text")
    return df.select("row_id", "doc_id", "lang", "prompt")


@register("read_prompts_stream", _sql_prompt(""))
def q_read_prompts_stream(spark, d):
    src = scratch_path(spark, "stream-prompts")
    fx.conversation_messages(spark, d).write.json(src)
    schema = "conv_id BIGINT, messages ARRAY<STRUCT<role: STRING, content: STRING>>"
    stream = read_prompts_stream(spark, src, schema, "json", dataset_format="messages")
    return _prompt_out(_stream_to_table(spark, stream.select("conv_id", "prompt"), "prompts"))


# =========================================================================== D


@register("exact_ordinal", f"""
select doc_id, row_number() over (order by md5(concat_ws(':', 'ord', doc_id::varchar)), doc_id)::bigint as ordinal
from documents
""")
def q_exact_ordinal(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id")
    key = sampling.seed_key("ord", F.col("doc_id"))
    return ordinal.hash_ordinal(docs, key, tie=["doc_id"]).select("doc_id", "ordinal")


def _doc_rows(spark, d) -> DataFrame:
    return ordinal.with_row_id(fx.table(spark, d, "documents")).select("doc_id", "row_id", "lang")


@register("limit_samples", f"""
select doc_id, row_id::bigint as row_id from ({fx.SQL_DOC_ROWS}) where row_id <= 300
""")
def q_limit_samples(spark, d):
    return sampling.limit_samples(_doc_rows(spark, d), 300).select("doc_id", "row_id")


@register("seeded_shuffle", f"""
select doc_id, row_id::bigint as row_id,
  row_number() over (order by md5(concat_ws(':', '42', row_id::varchar)), row_id)::bigint as position
from ({fx.SQL_DOC_ROWS})
""")
def q_seeded_shuffle(spark, d):
    return sampling.seeded_shuffle(_doc_rows(spark, d), 42).select("doc_id", "row_id", "position")


def _sql_split(source: str, fraction: str) -> str:
    return f"""
src as ({source}),
ranked as (select *, row_number() over (order by md5(concat_ws(':', 'split', '42', row_id::varchar)), row_id) as pos,
                  count(*) over () as n from src),
split as (select *, case when pos <= ceil({fraction} * n) then 'eval' else 'train' end as split from ranked)
"""


@register("train_eval_split", f"""
with {_sql_split(fx.SQL_DOC_ROWS, '0.05')}
select doc_id, split from split
""")
def q_train_eval_split(spark, d):
    return sampling.train_eval_split(_doc_rows(spark, d), 0.05, 42).select("doc_id", "split")


@register("split_counts", f"""
with {_sql_split(f"select * from ({fx.SQL_DOC_ROWS}) where row_id <= 800", '0.1')}
select 'loaded' as stage, 'all' as split, (select count(*) from documents)::bigint as n
union all select 'limited', 'all', (select count(*) from src)::bigint
union all select 'split', split, count(*)::bigint from split group by split
""")
def q_split_counts(spark, d):
    rows = _doc_rows(spark, d)
    limited = sampling.limit_samples(rows, 800)
    parts = sampling.train_eval_split(limited, 0.1, 42)
    loaded = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit("loaded").alias("stage"), F.lit("all").alias("split"), "n")
    lim = limited.agg(F.count(F.lit(1)).alias("n")).select(F.lit("limited").alias("stage"), F.lit("all").alias("split"), "n")
    spl = sampling.split_counts(parts).select(F.lit("split").alias("stage"), "split", "n")
    return loaded.unionByName(lim).unionByName(spl)


def _sql_batches(source: str, epochs: int, per_step: int, batch: int) -> str:
    return f"""
src as ({source}),
ep as (select src.*, e.epoch from src cross join (select unnest(range({epochs})) as epoch) e),
ranked as (select *, row_number() over (partition by epoch order by
             md5(concat_ws(':', '42', epoch::varchar, row_id::varchar)), row_id) as epoch_pos,
           (select count(*) from src) as n from ep),
batches as (select *, epoch * ((n + {per_step} - 1) // {per_step}) + (epoch_pos - 1) // {per_step} as step,
           ((epoch_pos - 1) % {per_step}) // {batch} as micro_batch from ranked)
"""


@register("assign_batches", f"""
with {_sql_batches(fx.SQL_DOC_ROWS, 2, 8, 2)}
select doc_id, epoch::bigint as epoch, epoch_pos::bigint as epoch_pos, step::bigint as step,
       micro_batch::bigint as micro_batch from batches
""")
def q_assign_batches(spark, d):
    df = sampling.assign_batches(_doc_rows(spark, d), batch_size=2, grad_accum=4, epochs=2, seed=42)
    return df.select("doc_id", big("epoch").alias("epoch"), big("epoch_pos").alias("epoch_pos"),
                     big("step").alias("step"), big("micro_batch").alias("micro_batch"))


def _sql_permuted(source: str, epochs: int, per_step: int, batch: int) -> str:
    """Batches by the keyed permutation: one round of it a step of the recursion."""
    m1, m2 = sampling.MULTIPLIERS
    low, rounds = sampling.LOW31, sampling.ROUNDS
    return f"""
src as ({source}),
total as (select count(*)::bigint as n, floor(sqrt(count(*)))::bigint as root from src),
shape as (select n, a, (n + a - 1) // a as b from (select n, root, unnest(range((2 * root + 2) // 3, root + 1)) as a from total)
  order by a * ((n + a - 1) // a) - n, root - a limit 1),
walk as (select row_id, epoch, (row_id - 1) // b as x, (row_id - 1) % b as y, a as m, b as o, 0 as r
  from src, shape, (select unnest(range({epochs})) as epoch)
  union all
  select row_id, epoch, y, (x + ((xor(t, t >> 13) >> 4) & {low})) % m, o, m, r + 1 from (
    select *, (xor(t0, t0 >> 15) & {low}) * {m2} as t from (
      select walk.*, (((y & {low}) + ('0x' || substr(md5(concat_ws(':', '42', epoch::varchar, (r % {rounds})::varchar)), 1, 7))::bigint) % {low}) * {m1} as t0
      from walk, shape where r % {rounds} <> 0 or r = 0 or x * b + y >= n))),
placed as (select row_id, epoch, x * b + y + 1 as epoch_pos, n from walk, shape where r > 0 and r % {rounds} = 0 and x * b + y < n),
batches as (select src.*, epoch, epoch_pos, epoch * ((n + {per_step} - 1) // {per_step}) + (epoch_pos - 1) // {per_step} as step,
  ((epoch_pos - 1) % {per_step}) // {batch} as micro_batch from placed join src using (row_id))
"""


@register("assign_batches_permuted", f"""
with recursive {_sql_permuted(fx.SQL_DOC_ROWS, 2, 8, 2)}
select doc_id, epoch::bigint as epoch, epoch_pos::bigint as epoch_pos, step::bigint as step,
       micro_batch::bigint as micro_batch from batches
""")
def q_assign_batches_permuted(spark, d):
    df = sampling.assign_batches(_doc_rows(spark, d), batch_size=2, grad_accum=4, epochs=2, seed=42, order="permutation")
    return df.select("doc_id", big("epoch").alias("epoch"), big("epoch_pos").alias("epoch_pos"),
                     big("step").alias("step"), big("micro_batch").alias("micro_batch"))


# --------------------------------------------------------------------------- files and tables


def _doc_files(spark, d, n_files: int = 16) -> str:
    """The documents in id order as a folder of Parquet files."""
    path = scratch_path(spark, "doc-files") + ".parquet"
    fx.table(spark, d, "documents").select("doc_id", "lang").repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return path


@register("read_first_prompts", f"""
select doc_id, row_id::bigint as row_id from ({fx.SQL_DOC_ROWS}) where row_id <= 150
""")
def q_read_first_prompts(spark, d):
    return readers.read_prompts(spark, _doc_files(spark, d), max_samples=150).select("doc_id", "row_id")


_SQL_TABLE = """
select *, row_number() over (order by md5(concat_ws(':', conv_id::varchar, turn::varchar)), conv_id::varchar, turn::varchar) as row_id
from conversations where conv_id % 2 = 1 and role <> 'system'
"""


@register("read_table_prompts", f"""
with {_sql_batches(_SQL_TABLE, 1, 8, 2)},
shuffled as (select row_id, row_number() over (order by md5(concat_ws(':', '42', row_id::varchar)), row_id) as position from src)
select row_id::bigint as row_id, conv_id, turn, text as prompt, position::bigint as position, step::bigint as step
from batches join shuffled using (row_id) where row_id <= 200
""")
def q_read_table_prompts(spark, d):
    conv = fx.table(spark, d, "conversations")
    kinds = {"config": F.concat(F.lit("c"), (F.col("conv_id") % 2).cast("string")), "split": F.when(F.col("role") == "system", F.lit("other")).otherwise(F.lit("train"))}
    name = f"prompts_{uuid.uuid4().hex}"
    conv.withColumns(kinds).write.partitionBy("config", "split").option("path", scratch_path(spark, "table")).saveAsTable(name)
    df = readers.read_prompts(spark, name, config="c1", key=["conv_id", "turn"])
    df = prompts.prepare_prompts(df, "prompt", prompt_column="text")
    batches = sampling.assign_batches(df.select("row_id"), seed=42).select("row_id", "step")
    out = sampling.limit_samples(sampling.seeded_shuffle(df, 42).join(batches, "row_id"), 200)
    return out.select("row_id", "conv_id", "turn", "prompt", "position", "step")


@register("read_prepared", f"""
with r as ({fx.SQL_DOC_ROWS}), t as (select count(*) as n from r),
k as (select doc_id, row_number() over (order by md5(concat_ws(':', 'split', '42', row_id::varchar)), row_id) as pos from r)
select 'eval' as split, doc_id from k, t where pos <= ceil(0.05 * n) union all select 'train', doc_id from k, t where pos > ceil(0.05 * n)
""")
def q_read_prepared(spark, d):
    path = scratch_path(spark, "prepared")
    writers.write_prepared(sampling.train_eval_split(_doc_rows(spark, d), 0.05, 42), path)
    parts = [readers.read_prompts(spark, path, split=s, row_id=False).select(F.lit(s).alias("split"), "doc_id") for s in ("train", "eval")]
    return parts[0].unionByName(parts[1])


@register("read_prompt_lines", f"""
with {fx.SQL_LINES.strip()},
single as (select unnest(string_split(value, chr(10))) as value from lines),
kept as (select regexp_replace(value, '^{fx.PY_SPACE}+|{fx.PY_SPACE}+\\z', '', 'g') as prompt from single where not regexp_matches(value, '^{fx.PY_SPACE}*\\z'))
select prompt, count(*) as n, min(length(prompt))::bigint as n_chars from kept group by prompt
""")
def q_read_prompt_lines(spark, d):
    path = scratch_path(spark, "lines") + ".txt"
    fx.prompt_line_rows(spark, d).select("value").write.text(path)
    df = readers.read_prompt_lines(spark, path)
    return df.groupBy("prompt").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("prompt")).cast("long").alias("n_chars"))


@register("read_sessions", f"""
with {fx.SQL_SAVED},
parts as (select conv_id, system_prompt, unnest(range(0, greatest(1, (len(messages) + 1) // 2))) as part, messages from saved)
select 's' || conv_id as name, part::bigint as part, system_prompt, {sql_msg_text('messages[2 * part + 1 : 2 * part + 2]')} as messages_text from parts
""")
def q_read_sessions(spark, d):
    """Sessions cut into parts of two messages, written and read again."""
    saved = fx.saved_sessions(spark, d).select(F.concat(F.lit("s"), F.col("conv_id").cast("string")).alias("name"), "system_prompt", "messages")
    n = F.greatest(F.lit(1), F.floor((F.size("messages") + 1) / 2).cast("int"))
    parts = saved.withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).withColumn("part", F.col("part").cast("long"))
    parts = parts.withColumn("messages", F.slice("messages", (F.col("part") * 2 + 1).cast("int"), 2))
    path = scratch_path(spark, "sessions")
    writers.write_sessions(parts, path)
    return readers.read_sessions(spark, path).select("name", "part", "system_prompt", msg_text(F.col("messages")).alias("messages_text"))


@register("write_responses", f"""
select row_id::bigint as position, text as prompt, 'reply ' || (row_id * 3)::varchar as response from ({fx.SQL_CONV_ROWS})
""")
def q_write_responses(spark, d):
    rows = ordinal.with_row_id(fx.table(spark, d, "conversations")).select("row_id", F.col("text").alias("prompt"), F.concat(F.lit("reply "), (F.col("row_id") * 3).cast("string")).alias("response"))
    path = scratch_path(spark, "responses")
    # Ids with gaps, rows in no order.
    spread = rows.withColumn("row_id", F.col("row_id") * 3).repartition(7, "prompt")
    writers.write_responses(spread, path, rows_per_file=100)
    return writers.read_responses(spark, path)


@register("write_metrics", """
select 'run1' as run_id, lang as phase, metric, value from (
  select lang, count(*)::double as n_docs, max(length(text))::double as max_chars from documents group by lang)
unpivot (value for metric in (n_docs, max_chars))
""")
def q_write_metrics(spark, d):
    """A run that writes half of its metrics, fails, and writes all of them twice."""
    docs = fx.table(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).cast("double").alias("n_docs"), F.max(F.length("text")).cast("double").alias("max_chars"))
    rows = docs.unpivot(["lang"], ["n_docs", "max_chars"], "metric", "value").select(F.lit("run1").alias("run_id"), F.col("lang").alias("phase"), "metric", "value")
    path = scratch_path(spark, "metrics")
    writers.write_metrics(rows.where("metric = 'n_docs'"), path)
    for _ in range(2):
        writers.write_metrics(rows, path)
    return spark.read.schema(writers.METRICS).parquet(path)


# =========================================================================== E


@register("sessions_from_turns", f"""
with s as ({fx.SQL_MESSAGES.format(where="")})
select conv_id, len(messages)::bigint as n_messages, {sql_msg_text('messages')} as messages_text from s
""")
def q_sessions_from_turns(spark, d):
    s = fx.conversation_messages(spark, d)
    return s.select("conv_id", big(F.size("messages")).alias("n_messages"), msg_text(F.col("messages")).alias("messages_text"))


_SQL_SYS = f"(case when length(system_prompt) > 0 then system_prompt else {sql_str(fx.DEFAULT_SYSTEM)} end)"


@register("build_messages", f"""
with {fx.SQL_SAVED},
b as (select conv_id, list_concat([struct_pack(role := 'system', content := {_SQL_SYS})], messages) as messages
      from saved)
select conv_id, len(messages)::bigint as n_messages, {sql_msg_text('messages')} as messages_text from b
""")
def q_build_messages(spark, d):
    df = sessions.build_messages(fx.saved_sessions(spark, d), "messages", "system_prompt", fx.DEFAULT_SYSTEM)
    return df.select("conv_id", big(F.size("messages")).alias("n_messages"), msg_text(F.col("messages")).alias("messages_text"))


def _sql_chatml(role: str, content: str) -> str:
    return f"'{CHATML_START}' || {role} || chr(10) || {content} || '{CHATML_END}' || chr(10)"


@register("render_chat", f"""
with r as (select conv_id, string_agg({_sql_chatml('role', 'text')}, '' order by turn)
                  || '{CHATML_START}assistant' || chr(10) as rendered from conversations group by conv_id)
select conv_id, md5(rendered) as rendered_md5, length(rendered)::bigint as rendered_len from r
""")
def q_render_chat(spark, d):
    df = sessions.render_chat(fx.conversation_messages(spark, d))
    return df.select("conv_id", F.md5("rendered").alias("rendered_md5"), big(F.length("rendered")).alias("rendered_len"))


@register("turn_contexts", f"""
with w as (select conv_id, turn, role, text,
  count(*) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as n_context,
  list(role || ':' || text) over (partition by conv_id order by turn
       rows between unbounded preceding and 1 preceding) as ctx from conversations)
select conv_id, turn, n_context::bigint as n_context, md5(coalesce(array_to_string(ctx, {SQL_SEP}), '')) as context_md5,
       md5(text) as reply_md5 from w where role = 'assistant'
""")
def q_turn_contexts(spark, d):
    df = sessions.turn_contexts(fx.table(spark, d, "conversations"))
    return df.select("conv_id", "turn", big(F.size("context")).alias("n_context"),
                     F.md5(msg_text(F.col("context"))).alias("context_md5"), F.md5("reply").alias("reply_md5"))


@register("context_links", f"""
with w as (select conv_id, turn, role, text,
  count(*) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as n_context,
  list(role || ':' || text) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as ctx,
  lag(role || ':' || text) over (partition by conv_id order by turn) as prev from conversations),
k as (select conv_id, turn, n_context, coalesce(array_to_string(ctx, {SQL_SEP}), '') as c,
  case when n_context > 0 then array_to_string(ctx[:-2], {SQL_SEP}) end as p from w)
select conv_id, turn, n_context::bigint as n_context, count(*) over (partition by n_context, c) as n_same_context,
  case when n_context > 0 then count(*) over (partition by n_context, p) end as n_same_parent from k
""")
def q_context_links(spark, d):
    links = sessions.context_links(fx.table(spark, d, "conversations"), reply_role=None)
    same = links.groupBy("context_key").agg(F.count(F.lit(1)).alias("n_same_context"))
    kin = links.where("parent_key is not null").groupBy("parent_key").agg(F.count(F.lit(1)).alias("n_same_parent"))
    return links.join(same, "context_key").join(kin, "parent_key", "left").select("conv_id", "turn", "n_context", "n_same_context", "n_same_parent")


def _replay_out(df: DataFrame) -> DataFrame:
    return df.select("session_id", "system_prompt", big("closed").alias("closed"),
                     big(F.size("messages")).alias("n_messages"), msg_text(F.col("messages")).alias("messages_text"))


_REPLAY_COLS = "session_id, system_prompt, closed, n_messages, messages_text"


@register("replay_sessions", f"""
with ev0 as ({fx.sql_session_events()}),
{fx.SQL_CLASSIFY}
select {_REPLAY_COLS} from replayed
""")
def q_replay_sessions(spark, d):
    return _replay_out(sessions.replay_sessions(fx.session_events(spark, d)))


@register("replay_messages", f"""
with ev0 as ({fx.sql_session_events()}),
{fx.SQL_CLASSIFY}
select session_id, seq, 0::bigint as pos, role, text as content from msgs
""")
def q_replay_messages(spark, d):
    out = sessions.replay_messages(fx.session_events(spark, d))
    return out.select("session_id", "seq", big("pos").alias("pos"), "role", "content")


# Events are dealt to files by hash: each micro-batch has a few of every session, in no order.
STREAM_BATCHES = 4
STREAM_FILES = 4


def _stream_session(spark: SparkSession) -> SparkSession:
    """Session for a stateful stream: state partitions sized to the cluster's cores.

    A stateful query keeps the partition count it starts with, so it is set
    from the default parallelism rather than the batch shuffle setting.
    """
    run = spark.newSession()
    run.conf.set("spark.sql.shuffle.partitions", str(max(1, spark.sparkContext.defaultParallelism)))
    run.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return run


def _replayed_stream(spark: SparkSession, events: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Output table of the stream over ``events``, a few of every session in each micro-batch."""
    src = scratch_path(spark, "stream-events")
    events.repartition(STREAM_BATCHES * STREAM_FILES, "session_id", "seq", "text").write.parquet(src)
    run = _stream_session(spark)
    stream = run.readStream.schema(SESSION_EVENT).option("maxFilesPerTrigger", STREAM_FILES).parquet(src)
    return _stream_to_table(run, replay_sessions_stream(stream, saved=saved), "replay")


def _stream_to_table(spark, stream, name: str):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


@register("replay_sessions_stream", f"""
with ev0 as ({fx.sql_session_events()}),
{fx.SQL_CLASSIFY}
select {_REPLAY_COLS} from replayed
""")
def q_replay_sessions_stream(spark, d):
    return _replay_out(final_sessions(_replayed_stream(spark, fx.session_events(spark, d))))


@register("replay_sessions_load", fx.sql_load_replay())
def q_replay_sessions_load(spark, d):
    return _replay_out(sessions.replay_sessions(fx.load_events(spark, d), saved=fx.named_sessions(spark, d)))


@register("replay_sessions_stream_load", fx.sql_load_replay())
def q_replay_sessions_stream_load(spark, d):
    saved = fx.named_sessions(spark, d)
    return _replay_out(live_sessions(_replayed_stream(spark, fx.load_events(spark, d), saved)))


@register("session_history", f"""
with ev1 as ({fx.sql_session_events()}),
bound as (select session_id, max(seq) // 2 as at_seq from ev1 group by session_id),
ev0 as (select ev1.* from ev1 join bound using (session_id) where ev1.seq <= bound.at_seq),
{fx.SQL_CLASSIFY}
select {_REPLAY_COLS} from replayed
""")
def q_session_history(spark, d):
    ev = fx.session_events(spark, d)
    bound = ev.groupBy("session_id").agg(F.floor(F.max("seq") / 2).cast("long").alias("at_seq"))
    return _replay_out(sessions.session_history(ev, bound))


@register("session_json_roundtrip", f"""
with {fx.SQL_SAVED}
select conv_id, system_prompt, len(messages)::bigint as n_messages, {sql_msg_text('messages')} as messages_text,
       1::bigint as same_json from saved
""")
def q_session_json_roundtrip(spark, d):
    saved = sessions.session_to_json(fx.saved_sessions(spark, d))
    back = sessions.session_from_json(saved.select("conv_id", "json"))
    again = sessions.session_to_json(back, out="json2")
    return again.select("conv_id", "system_prompt", big(F.size("messages")).alias("n_messages"),
                        msg_text(F.col("messages")).alias("messages_text"),
                        big(F.col("json") == F.col("json2")).alias("same_json"))


# =========================================================================== F


@register("judge_query", f"""
with s as ({fx.SQL_MESSAGES.format(where="")}),
k as (select conv_id, 'all' as kind, messages from s
      union all select conv_id, 'no_user', list_filter(messages, lambda m: m.role <> 'user') from s
      union all select conv_id, 'empty', list_filter(messages, lambda m: false) from s),
u as (select *, list_filter(messages, lambda m: m.role = 'user') as users from k)
select conv_id, kind, case when messages is null then 'None' when len(messages) = 0 then '[]'
  when len(users) > 0 then coalesce(users[1].content, '') else coalesce(messages[1].content, '') end as query from u
""")
def q_judge_query(spark, d):
    s = fx.conversation_messages(spark, d)
    kinds = s.select("conv_id", F.lit("all").alias("kind"), F.col("messages").alias("prompt")).unionByName(
        s.select("conv_id", F.lit("no_user").alias("kind"),
                 F.filter("messages", lambda m: m["role"] != "user").alias("prompt"))).unionByName(
        s.select("conv_id", F.lit("empty").alias("kind"), F.filter("messages", lambda m: F.lit(False)).alias("prompt")))
    return judge.judge_query(kinds).select("conv_id", "kind", "query")


_SQL_JUDGE_INPUT = (f"{sql_str('<Instruct>: ' + fx.JUDGE_INSTRUCTION + chr(10) + '<Query>: ')} || coalesce(prompt, 'None') "
                    f"|| chr(10) || '<Document>: ' || coalesce(completion_a, 'None')")


@register("judge_input", f"""
with {fx.SQL_PAIRS}
select pair_id, md5({_SQL_JUDGE_INPUT}) as input_md5, length({_SQL_JUDGE_INPUT})::bigint as input_len from pairs
""")
def q_judge_input(spark, d):
    df = judge.judge_input(fx.completion_pairs(spark, d), fx.JUDGE_INSTRUCTION, "prompt", "completion_a")
    return df.select("pair_id", F.md5("judge_input").alias("input_md5"), big(F.length("judge_input")).alias("input_len"))


_BUDGET = judge.token_budget(TRUNCATE_LENGTH, JUDGE_PREFIX, JUDGE_SUFFIX)
_SQL_TRUNC = (f"{sql_str(JUDGE_PREFIX)} || array_to_string(list_slice(regexp_extract_all({_SQL_JUDGE_INPUT}, "
              f"'{judge.WORD_PIECE}'), 1, {_BUDGET}), '') || {sql_str(JUDGE_SUFFIX)}")


@register("truncate_input", f"""
with {fx.SQL_PAIRS},
t as (select pair_id, {_SQL_TRUNC} as truncated from pairs)
select pair_id, md5(truncated) as truncated_md5, length(truncated)::bigint as truncated_len from t
""")
def q_truncate_input(spark, d):
    df = judge.judge_input(fx.completion_pairs(spark, d), fx.JUDGE_INSTRUCTION, "prompt", "completion_a")
    df = judge.truncate_input(df, "judge_input", TRUNCATE_LENGTH, JUDGE_PREFIX, JUDGE_SUFFIX, out="truncated")
    return df.select("pair_id", F.md5("truncated").alias("truncated_md5"), big(F.length("truncated")).alias("truncated_len"))


@register("judge_score", f"""
with {fx.SQL_PAIRS}, {fx.SQL_LOGITS}
select pair_id, side, round(1.0 / (1.0 + exp(logit_no - logit_yes)), 6) as score from logits
""")
def q_judge_score(spark, d):
    df = judge.judge_score(fx.judge_logits(spark, d))
    return df.select("pair_id", "side", r6("score").alias("score"))


_FEATURES = list(judge.RUBRIC)


def _sql_rubric(text: str) -> tuple[str, str]:
    feats = {n: f"len(regexp_extract_all(lower({text}), {sql_str(p)}))" for n, (p, _) in judge.RUBRIC.items()}
    logit = f"({judge.LENGTH_WEIGHT}::double * length({text}) / {judge.LENGTH_SCALE})"
    for n, (_, w) in judge.RUBRIC.items():
        logit += f" + {w}::double * {feats[n]}"
    cols = ", ".join(f"{e}::bigint as {n}" for n, e in feats.items())
    return cols, f"1.0 / (1.0 + exp(0.0 - ({logit})))"


_RUBRIC_COLS, _RUBRIC_SCORE = _sql_rubric("text")


@register("rubric_score", f"""
with r as ({fx.SQL_RUBRIC_INPUT})
select conv_id, turn, {_RUBRIC_COLS}, round({_RUBRIC_SCORE}, 6) as score from r
""")
def q_rubric_score(spark, d):
    df = judge.rubric_score(fx.rubric_input(spark, d))
    return df.select("conv_id", "turn", *_FEATURES, r6("score").alias("score"))


@register("pair_completions", f"""
with {fx.SQL_PAIRS}
select pair_id, prompt, completion_a, completion_b from pairs
""")
def q_pair_completions(spark, d):
    p = fx.completion_pairs(spark, d)
    return judge.pair_completions(
        p.select("pair_id", "prompt"),
        p.select("pair_id", F.col("completion_a").alias("completion")),
        p.select("pair_id", F.col("completion_b").alias("completion")),
    ).select("pair_id", "prompt", "completion_a", "completion_b")


_SQL_WINNER = "case when isnan(score_a) or isnan(score_b) then 1 when score_a >= score_b then 0 else 1 end"


@register("pick_winner", f"""
with {fx.SQL_PAIRS}, {fx.SQL_SCORED}
select pair_id, round(case when isnan(score_a) then null else score_a end, 6) as score_a,
       round(case when isnan(score_b) then null else score_b end, 6) as score_b, ({_SQL_WINNER})::bigint as winner
from scored
""")
def q_pick_winner(spark, d):
    df = judge.pick_winner(fx.scored_pairs(spark, d))
    return df.select("pair_id", r6(nan_null("score_a")).alias("score_a"), r6(nan_null("score_b")).alias("score_b"),
                     big("winner").alias("winner"))


_SQL_WHOLE = _SQL_TRUNC.replace(f", 1, {_BUDGET})", f", 1, {judge.token_budget(8192, JUDGE_PREFIX, JUDGE_SUFFIX)})")
_SQL_WHOLE_B = _SQL_WHOLE.replace("completion_a", "completion_b")
_SQL_LEN_SCORE = "1.0 / (1.0 + exp(length({t}) / 100.0))"


@register("score_pairs", f"""
with {fx.SQL_PAIRS},
t as (select pair_id, {_SQL_WHOLE} as ta, {_SQL_WHOLE_B} as tb from pairs),
s as (select pair_id, {_SQL_LEN_SCORE.format(t='ta')} as score_a, {_SQL_LEN_SCORE.format(t='tb')} as score_b from t)
select pair_id, round(score_a, 6) as score_a, round(score_b, 6) as score_b, ({_SQL_WINNER})::bigint as winner from s
""")
def q_score_pairs(spark, d):
    p = fx.completion_pairs(spark, d).select("pair_id", "prompt", "completion_a", "completion_b")
    out = judge.score_pairs(p, models.length_scorer, fx.JUDGE_INSTRUCTION, prefix=JUDGE_PREFIX, suffix=JUDGE_SUFFIX)
    return out.select("pair_id", r6("score_a").alias("score_a"), r6("score_b").alias("score_b"),
                      big("winner").alias("winner"))


def _rubric_pairs(spark, d) -> DataFrame:
    """Completion pairs with rubric-dressed sides, both scored by the rubric."""
    p = fx.completion_pairs(spark, d)
    p = p.select("pair_id", "conv_id",
                 fx.rubric_text(F.col("completion_a"), F.col("conv_id"), F.col("turn")).alias("completion_a"),
                 fx.rubric_text(F.col("completion_b"), F.col("conv_id"), F.col("turn_b")).alias("completion_b"))
    p = judge.rubric_score(p, "completion_a", out="score_a", keep_features=False).drop("logit_yes", "logit_no")
    p = judge.rubric_score(p, "completion_b", out="score_b", keep_features=False).drop("logit_yes", "logit_no")
    variant = F.element_at(F.array(*[F.lit(x.strip() or "none") for x in fx.RUBRIC_PREFIXES]),
                           (F.col("conv_id") % 5 + 1).cast("int"))
    return judge.pick_winner(p).withColumn("variant", variant)


_SQL_VARIANT = "case " + " ".join(
    f"when conv_id % 5 = {i} then {sql_str(x.strip() or 'none')}" for i, x in enumerate(fx.RUBRIC_PREFIXES)) + " end"
_SQL_RUBRIC_PAIRS = f"""
rp as (select pair_id, conv_id, {fx.sql_rubric_text('completion_a', 'conv_id', 'turn')} as completion_a,
       {fx.sql_rubric_text('completion_b', 'conv_id', 'turn_b')} as completion_b from pairs),
rs as (select *, {_sql_rubric('completion_a')[1]} as score_a, {_sql_rubric('completion_b')[1]} as score_b,
       {_SQL_VARIANT} as variant from rp),
rw as (select *, ({_SQL_WINNER}) as winner from rs)
"""


@register("preference_pairs", f"""
with {fx.SQL_PAIRS}, {_SQL_RUBRIC_PAIRS}
select pair_id, md5(case when winner = 0 then completion_a else completion_b end) as chosen_md5,
       md5(case when winner = 0 then completion_b else completion_a end) as rejected_md5,
       round(case when winner = 0 then score_a - score_b else score_b - score_a end, 6) as margin from rw
""")
def q_preference_pairs(spark, d):
    df = judge.preference_pairs(_rubric_pairs(spark, d))
    return df.select("pair_id", F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"),
                     r6("margin").alias("margin"))


_REPORT_COLS = """count(*)::bigint as n_pairs, sum(case when winner = 0 then 1 else 0 end)::bigint as wins_a,
  round(avg(case when winner = 0 then 1.0 else 0.0 end), 6) as win_rate_a,
  round(avg(case when score_a = score_b then 1.0 else 0.0 end), 6) as tie_rate,
  round(avg(score_a), 6) as mean_score_a, round(avg(score_b), 6) as mean_score_b"""


def _report_out(df: DataFrame, group: str) -> DataFrame:
    return df.select(group, big("level").alias("level"), "n_pairs", "wins_a", r6("win_rate_a").alias("win_rate_a"),
                     r6("tie_rate").alias("tie_rate"), r6("mean_score_a").alias("mean_score_a"),
                     r6("mean_score_b").alias("mean_score_b"))


@register("fit_rubric_weights")
def q_fit_rubric_weights(spark, d):
    """Weights from pairs of a good and a bad labelled document of one language, and their loss on the other half."""
    docs = fx.table(spark, d, "documents").select("doc_id", "lang", "text").join(fx.table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    ranked = docs.withColumn("k", F.row_number().over(Window.partitionBy("lang", "quality").orderBy("doc_id")))
    side = lambda q, name: ranked.where(f"quality = {q}").select("lang", "k", F.col("text").alias(name))
    pairs = side(1, "good").join(side(0, "bad"), ["lang", "k"])
    swap = F.col("k") % 2 == 0
    pairs = pairs.select("k", F.when(swap, F.col("bad")).otherwise(F.col("good")).alias("completion_a"),
                         F.when(swap, F.col("good")).otherwise(F.col("bad")).alias("completion_b"), swap.cast("int").alias("winner"))
    weights = rubric_fit.fit_rubric_weights(pairs.where("k % 4 < 2"))
    other = rubric_fit.pair_differences(pairs.where("k % 4 >= 2"))
    losses = [round(rubric_fit.pair_loss(other, w), 6) for w in (weights, rubric_fit.DEFAULTS)]
    rows = [(f, round(weights[f], 6), rubric_fit.DEFAULTS[f], *losses) for f in rubric_fit.FEATURES]
    return spark.createDataFrame(rows, "feature string, weight double, default_weight double, held_out_loss double, default_loss double")


@register("rubric_win_report", f"""
with {fx.SQL_PAIRS}, {_SQL_RUBRIC_PAIRS}
select variant, grouping(variant)::bigint as level, {_REPORT_COLS} from rw group by rollup (variant)
""")
def q_rubric_win_report(spark, d):
    return _report_out(judge.win_report(_rubric_pairs(spark, d), ["variant"]), "variant")


@register("win_report", f"""
with lw as (select d.lang, l.quality::double as score_a, l.toxic::double as score_b,
                   case when l.quality >= l.toxic then 0 else 1 end as winner
            from labels l join documents d using (doc_id))
select lang, grouping(lang)::bigint as level, {_REPORT_COLS} from lw group by rollup (lang)
""")
def q_win_report(spark, d):
    lab = fx.table(spark, d, "labels").join(fx.table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    lab = lab.select("lang", F.col("quality").cast("double").alias("score_a"), F.col("toxic").cast("double").alias("score_b"))
    return _report_out(judge.win_report(judge.pick_winner(lab), ["lang"]), "lang")


# =========================================================================== G


@register("batch_prompt_lines", f"""
with {fx.SQL_LINES}
select row_id::bigint as row_id, prompt from clean
""")
def q_batch_prompt_lines(spark, d):
    return generate.clean_lines(fx.prompt_line_rows(spark, d)).select("row_id", "prompt")


_SQL_REQUEST = (f"{_sql_chatml(sql_str('system'), sql_str(fx.DEFAULT_SYSTEM))} || "
                f"{_sql_chatml(sql_str('user'), 'prompt')} || '{CHATML_START}assistant' || chr(10)")


@register("batch_requests", f"""
with {fx.SQL_LINES}
select row_id::bigint as row_id, prompt, {_SQL_REQUEST} as rendered from clean
""")
def q_batch_requests(spark, d):
    lines = generate.clean_lines(fx.prompt_line_rows(spark, d))
    df = generate.batch_requests(lines, "prompt", None, fx.DEFAULT_SYSTEM)
    return df.select("row_id", "prompt", "rendered")


def _sql_candidates(temperature: float, top_k: int | None, top_p: float) -> str:
    limit = f"where rank <= {top_k}" if top_k else ""
    return f"""
with c as (select conv_id as prompt_id, turn as cand_id, length(text) / 300.0 as score from conversations),
r as (select *, row_number() over (partition by prompt_id order by score desc, cand_id) as rank from c),
k as (select * from r {limit}),
p as (select *, exp(score / {temperature} - max(score / {temperature}) over (partition by prompt_id)) as e from k),
q as (select *, e / sum(e) over (partition by prompt_id) as prob from p),
s as (select *, sum(prob) over (partition by prompt_id order by rank rows between unbounded preceding and current row)
                - prob as before from q),
t as (select * from s where before < {top_p})
select prompt_id, cand_id, rank::bigint as rank, round(prob, 6) as prob,
       round(prob / sum(prob) over (partition by prompt_id), 6) as kept_prob from t
"""


def _candidates(spark, d) -> DataFrame:
    return fx.table(spark, d, "conversations").select(
        F.col("conv_id").alias("prompt_id"), F.col("turn").alias("cand_id"), (F.length("text") / F.lit(300.0)).alias("score"))


def _candidates_out(df: DataFrame) -> DataFrame:
    return df.select("prompt_id", "cand_id", big("rank").alias("rank"), r6("prob").alias("prob"),
                     r6("kept_prob").alias("kept_prob"))


@register("select_candidates", _sql_candidates(0.7, 3, 0.9))
def q_select_candidates(spark, d):
    return _candidates_out(generate.select_candidates(_candidates(spark, d), temperature=0.7, top_k=3, top_p=0.9))


@register("select_candidates_nucleus", _sql_candidates(0.9, None, 0.9))
def q_select_candidates_nucleus(spark, d):
    return _candidates_out(generate.select_candidates(_candidates(spark, d), temperature=0.9, top_k=None, top_p=0.9))


@register("batch_generate", f"""
with {fx.SQL_LINES}
select row_id::bigint as row_id, prompt, length({_SQL_REQUEST})::varchar || ':' || (7 + row_id)::varchar as response
from clean
""")
def q_batch_generate(spark, d):
    lines = generate.clean_lines(fx.prompt_line_rows(spark, d))
    out = generate.batch_generate(lines, models.echo_generator, "prompt", "row_id", None, fx.DEFAULT_SYSTEM, seed=7)
    return out.select("row_id", "prompt", "response")


# =========================================================================== H


@register("eos_penalty", """
select conv_id, turn, round(length(text) / 300.0, 6) as score,
       round(case when ends_with(text, '.') then length(text) / 300.0 else length(text) / 300.0 - 1.0 end, 6) as penalized
from conversations where role = 'assistant'
""")
def q_eos_penalty(spark, d):
    c = fx.table(spark, d, "conversations").filter(F.col("role") == "assistant")
    c = c.select("conv_id", "turn", F.col("text").alias("completion"), (F.length("text") / F.lit(300.0)).alias("score"))
    df = objective.eos_penalty(c, eos=".", penalty=1.0, out="penalized")
    return df.select("conv_id", "turn", r6("score").alias("score"), r6("penalized").alias("penalized"))


def _sql_loss(loss_type: str, beta: str, alpha: str) -> str:
    z = "((policy_chosen - ref_chosen) - (policy_rejected - ref_rejected))"
    x = f"({beta} * {z})"
    if loss_type == "sigmoid":
        pref = f"(greatest(-{x}, 0.0) + ln(1.0 + exp(-abs({x}))))"
    else:
        pref = f"power({z} - 1.0 / (2.0 * {beta}), 2)"
    return f"{z} as z, {x} as margin, {pref} as pref_loss, {pref} + {alpha} * policy_explore as loss"


def _loss_out(df: DataFrame) -> DataFrame:
    return df.select("pair_id", r6("z").alias("z"), r6("margin").alias("margin"), r6("pref_loss").alias("pref_loss"),
                     r6("loss").alias("loss"))


for _lt in objective.LOSS_TYPES:
    def _mk(lt):
        def q(spark, d):
            return _loss_out(objective.preference_loss(fx.logged_logprobs(spark, d), 0.1, 1e-5, lt))
        q.__name__ = f"q_preference_loss_{lt}"
        return q

    register(f"preference_loss_{_lt}", f"""
with {fx.SQL_PAIRS}, {fx.SQL_LOGPROBS},
l as (select pair_id, {_sql_loss(_lt, '0.1', '0.00001')} from lp)
select pair_id, round(z, 6) as z, round(margin, 6) as margin, round(pref_loss, 6) as pref_loss,
       round(loss, 6) as loss from l
""")(_mk(_lt))


@register("loss_report", f"""
with {fx.SQL_PAIRS}, {fx.SQL_LOGPROBS},
{_sql_batches("select *, pair_id as row_id from lp", 2, 8, 2)},
bb as (select *, case when epoch = 0 then 0.1 else 0.2 end as beta from batches),
l as (select epoch, step, {_sql_loss('sigmoid', 'beta', '0.00001')} from bb)
select epoch::bigint as epoch, step::bigint as step, count(*)::bigint as n, round(avg(loss), 6) as mean_loss,
       round(avg(margin), 6) as mean_margin, round(avg(case when z > 0 then 1.0 else 0.0 end), 6) as accuracy
from l group by epoch, step
""")
def q_loss_report(spark, d):
    lp = fx.logged_logprobs(spark, d).withColumn("row_id", F.col("pair_id"))
    b = sampling.assign_batches(lp, batch_size=2, grad_accum=4, epochs=2, seed=42)
    rep = objective.loss_report(b, beta=(0.1, 0.2), alpha=(1e-5,))
    return rep.select(big("epoch").alias("epoch"), big("step").alias("step"), "n", r6("mean_loss").alias("mean_loss"),
                      r6("mean_margin").alias("mean_margin"), r6("accuracy").alias("accuracy"))


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_rubric_win_report(spark, sf_dir)
