"""Inputs derived from the given tables, in Spark and as DuckDB SQL.

Each fixture has a Spark builder and the SQL that builds the same rows, so a
query and its oracle start from identical data. The derivations are the ones
listed in FIXTURES.md (edge cases the tables lack are made by key arithmetic,
never by dropping rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.functions.text import PY_NONSPACE, PY_SPACE
from prefspark.operators.ordinal import with_row_id
from prefspark.operators.segments import shift_within
from prefspark.operators.sessions import sessions_from_turns

SEP = "\x1f"
SQL_SEP = "chr(31)"

# Fixed values used by the derived inputs and queries.
DEFAULT_SYSTEM = "You are a helpful assistant."
JUDGE_INSTRUCTION = "Does the answer below help the person who asked?"
RUBRIC_PREFIXES = ["Certainly! ", "As an AI, ", "It's important to note ", "I don't know, ", ""]
LIST_TAIL = "\n1. First point\n- a dash line"
CLOSER_TAIL = " Hope this helps!"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def msg_text(col) -> F.Column:
    """Message list as one comparable string: ``role:content`` joined by 0x1f."""
    return F.array_join(
        F.transform(col, lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit(":"),
                                            F.coalesce(m["content"], F.lit("")))),
        SEP,
    )


def sql_msg_text(expr: str) -> str:
    return (f"coalesce(array_to_string(list_transform({expr}, lambda m: coalesce(m.role, '') || ':' || "
            f"coalesce(m.content, '')), {SQL_SEP}), '')")


SQL_MESSAGES = (
    "select conv_id, list(struct_pack(role := role, content := text) order by turn) as messages "
    "from conversations {where} group by conv_id"
)

# --------------------------------------------------------------------------- conversations


def conversation_messages(spark, d, where=None) -> DataFrame:
    turns = table(spark, d, "conversations")
    if where is not None:
        turns = turns.filter(where)
    return sessions_from_turns(turns)


def conversation_rows(spark, d) -> DataFrame:
    """Conversation turns with their file-order ``row_id``."""
    return with_row_id(table(spark, d, "conversations"))


SQL_CONV_ROWS = "select *, row_number() over (order by conv_id, turn) as row_id from conversations"


def completion_pairs(spark, d) -> DataFrame:
    """Each assistant turn paired with the next assistant turn of its conversation.

    ``pair_id`` is the row id of the first turn; ``prompt`` the turn before it.
    Lag and lead run per conversation part (``shift_within``), so a very long
    conversation is not sorted in one task.
    """
    rows = conversation_rows(spark, d)
    rows = shift_within(rows, "conv_id", "turn", ["text"], 1, ["prompt"])
    asst = rows.filter(F.col("role") == "assistant")
    asst = shift_within(asst, "conv_id", "turn", ["text", "turn"], -1, ["completion_b", "turn_b"])
    return asst.filter(F.col("completion_b").isNotNull()).select(
        F.col("row_id").alias("pair_id"), "conv_id", "turn", "turn_b", "prompt",
        F.col("text").alias("completion_a"), "completion_b",
    )


SQL_PAIRS = f"""
pr as (select *, lag(text) over (partition by conv_id order by turn) as prompt from ({SQL_CONV_ROWS})),
pa as (select *, lead(text) over (partition by conv_id order by turn) as completion_b,
              lead(turn) over (partition by conv_id order by turn) as turn_b
       from pr where role = 'assistant'),
pairs as (select row_id as pair_id, conv_id, turn, turn_b, prompt, text as completion_a, completion_b
          from pa where completion_b is not null)
"""


def rubric_text(text, conv_id, turn) -> F.Column:
    """Assistant text dressed with stock phrases by key (FIXTURES.md)."""
    k = conv_id % 5
    prefix = F.lit("")
    for i, p in enumerate(RUBRIC_PREFIXES):
        prefix = F.when(k == i, F.lit(p)).otherwise(prefix)
    tail = F.when(turn % 3 == 0, F.lit(LIST_TAIL)).otherwise(F.lit(""))
    closer = F.when(conv_id % 4 == 0, F.lit(CLOSER_TAIL)).otherwise(F.lit(""))
    return F.concat(prefix, text, tail, closer)


def sql_rubric_text(text: str, conv_id: str, turn: str) -> str:
    cases = " ".join(f"when {conv_id} % 5 = {i} then {sql_str(p)}" for i, p in enumerate(RUBRIC_PREFIXES))
    return (f"(case {cases} else '' end) || {text} || "
            f"(case when {turn} % 3 = 0 then {sql_str(LIST_TAIL)} else '' end) || "
            f"(case when {conv_id} % 4 = 0 then {sql_str(CLOSER_TAIL)} else '' end)")


def rubric_input(spark, d) -> DataFrame:
    conv = table(spark, d, "conversations").filter(F.col("role") == "assistant")
    return conv.select("conv_id", "turn", rubric_text(F.col("text"), F.col("conv_id"), F.col("turn")).alias("text"))


SQL_RUBRIC_INPUT = (f"select conv_id, turn, {sql_rubric_text('text', 'conv_id', 'turn')} as text "
                    "from conversations where role = 'assistant'")


def scored_pairs(spark, d) -> DataFrame:
    """Pairs scored by length; ties for conv_id % 7 = 0, NaN for % 11 and % 13."""
    p = completion_pairs(spark, d)
    a = F.length("completion_a") / F.lit(300.0)
    b = F.length("completion_b") / F.lit(300.0)
    nan = F.lit(float("nan"))
    a2 = F.when(F.col("conv_id") % 11 == 0, nan).otherwise(a)
    b2 = F.when(F.col("conv_id") % 13 == 0, nan).when(F.col("conv_id") % 7 == 0, a).otherwise(b)
    return p.select("pair_id", "conv_id", "completion_a", "completion_b", a2.alias("score_a"), b2.alias("score_b"))


SQL_SCORED = """
scored as (select pair_id, conv_id, completion_a, completion_b,
  case when conv_id % 11 = 0 then 'NaN'::double else length(completion_a) / 300.0 end as score_a,
  case when conv_id % 13 = 0 then 'NaN'::double when conv_id % 7 = 0 then length(completion_a) / 300.0
       else length(completion_b) / 300.0 end as score_b
  from pairs)
"""


def judge_logits(spark, d) -> DataFrame:
    """(pair_id, side, logit_yes, logit_no): equal, +700 and -700 gaps by key."""
    p = completion_pairs(spark, d)
    sides = p.select("pair_id", "conv_id", F.lit("a").alias("side"), F.col("completion_a").alias("c")).unionByName(
        p.select("pair_id", "conv_id", F.lit("b").alias("side"), F.col("completion_b").alias("c")))
    y = F.length("c") / F.lit(300.0)
    k = F.col("conv_id") % 10
    n = F.when(k == 0, y).when(k == 1, y - 700.0).when(k == 2, y + 700.0).otherwise(F.lit(2.0) - F.length("c") / F.lit(500.0))
    return sides.select("pair_id", "side", y.alias("logit_yes"), n.alias("logit_no"))


SQL_LOGITS = """
sides as (select pair_id, conv_id, 'a' as side, completion_a as c from pairs
          union all select pair_id, conv_id, 'b', completion_b from pairs),
logits as (select pair_id, side, length(c) / 300.0 as logit_yes,
  case when conv_id % 10 = 0 then length(c) / 300.0 when conv_id % 10 = 1 then length(c) / 300.0 - 700.0
       when conv_id % 10 = 2 then length(c) / 300.0 + 700.0 else 2.0 - length(c) / 500.0 end as logit_no
  from sides)
"""


def logged_logprobs(spark, d) -> DataFrame:
    p = completion_pairs(spark, d)
    la, lb = F.length("completion_a"), F.length("completion_b")
    return p.select(
        "pair_id",
        (-la / F.lit(100.0)).alias("policy_chosen"),
        (-lb / F.lit(100.0)).alias("policy_rejected"),
        (-la / F.lit(110.0)).alias("ref_chosen"),
        (-lb / F.lit(105.0)).alias("ref_rejected"),
        (-(la + lb) / F.lit(200.0)).alias("policy_explore"),
    )


SQL_LOGPROBS = """
lp as (select pair_id, -length(completion_a) / 100.0 as policy_chosen, -length(completion_b) / 100.0 as policy_rejected,
  -length(completion_a) / 110.0 as ref_chosen, -length(completion_b) / 105.0 as ref_rejected,
  -(length(completion_a) + length(completion_b)) / 200.0 as policy_explore from pairs)
"""

# --------------------------------------------------------------------------- documents


def instruction_rows(spark, d) -> DataFrame:
    """Every document's text, and rows of their own (negative ids) with a null, empty or blank input."""
    docs = table(spark, d, "documents")
    k = F.col("doc_id") % 5
    edge = F.when(k == 1, F.lit("")).when(k == 2, F.lit(" "))
    instruction = F.concat(F.lit("Summarise, language "), F.col("lang")).alias("instruction")
    whole = docs.select("doc_id", instruction, F.col("text").alias("input"))
    return whole.unionByName(docs.filter(k < 3).select((-F.col("doc_id") - 1).alias("doc_id"), instruction, edge.alias("input")))


SQL_INSTRUCTIONS = """
ins as (select doc_id, 'Summarise, language ' || lang as instruction, text as input from documents
  union all select -doc_id - 1, 'Summarise, language ' || lang, case doc_id % 5 when 1 then '' when 2 then ' ' end
  from documents where doc_id % 5 < 3)
"""

SQL_DOC_ROWS = "select *, row_number() over (order by doc_id) as row_id from documents"

# --------------------------------------------------------------------------- prompt lines

PAD_LEFT = " 　"
PAD_RIGHT = "\t  "
BLANK_LINE = "  \t"


def prompt_line_rows(spark, d) -> DataFrame:
    """User turns as prompt-file lines, padded on even turns, and blank lines (negative ids)."""
    rows = conversation_rows(spark, d).filter(F.col("role") == "user")
    padded = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(PAD_LEFT), F.col("text"), F.lit(PAD_RIGHT))).otherwise(F.col("text"))
    blank = rows.filter(F.col("conv_id") % 7 == 0).select((-F.col("row_id")).alias("row_id"), F.lit(BLANK_LINE).alias("value"))
    return rows.select("row_id", padded.alias("value")).unionByName(blank)


SQL_LINES = f"""
lines as (select row_id, case when turn % 2 = 0 then {sql_str(PAD_LEFT)} || text || {sql_str(PAD_RIGHT)} else text end as value
  from ({SQL_CONV_ROWS}) where role = 'user'
  union all select -row_id, {sql_str(BLANK_LINE)} from ({SQL_CONV_ROWS}) where role = 'user' and conv_id % 7 = 0),
clean as (select row_id, regexp_replace(value, '^{PY_SPACE}+|{PY_SPACE}+\\z', '', 'g') as prompt
  from lines where not regexp_matches(value, '^{PY_SPACE}*\\z'))
"""

# --------------------------------------------------------------------------- session events

# Extra events by key: (modulus, remainder, seq, text).
SESSION_COMMANDS = [
    (4, 1, 3, "/clear"),
    (4, 2, 3, "/system brief"),
    (4, 3, 5, "/quit"),
    (6, 0, 1, "/CLEAR"),
    (5, 0, 7, " /clear"),
    (9, 0, 1, "/help"),
    (10, 3, 9, "   "),
    (8, 4, 5, "/system"),
    (12, 1, 7, "/save notes.json"),
]


def session_events(spark, d) -> DataFrame:
    conv = table(spark, d, "conversations")
    base = conv.select(F.col("conv_id").alias("session_id"), (F.col("turn") * 2).alias("seq"), "role", "text")
    cmds = F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(r).alias("r"), F.lit(seq).cast("long").alias("seq"), F.lit(t).alias("text"))
        for m, r, seq, t in SESSION_COMMANDS
    ])
    ids = conv.select(F.col("conv_id").alias("session_id")).distinct()
    extra = ids.select(
        "session_id",
        F.explode(F.filter(cmds, lambda c: F.col("session_id") % c["m"] == c["r"])).alias("c"),
    ).select("session_id", "c.seq", F.lit("user").alias("role"), "c.text")
    return base.unionByName(extra)


def sql_session_events() -> str:
    parts = ["select conv_id as session_id, 2 * turn as seq, role, text from conversations"]
    for m, r, seq, t in SESSION_COMMANDS:
        parts.append(f"select conv_id, {seq}::bigint, 'user', {sql_str(t)} from "
                     f"(select distinct conv_id from conversations) where conv_id % {m} = {r}")
    return " union all ".join(parts)


SQL_CLASSIFY = f"""
ev as (select session_id, seq, role, text,
  case when role = 'user' and (text is null or regexp_matches(text, '^{PY_SPACE}*\\z')) then 'skip'
       when role = 'user' and starts_with(text, '/') then
         case lower(regexp_extract(text, '^({PY_NONSPACE}+)', 1)) when '/quit' then 'quit' when '/clear' then 'clear'
              when '/system' then 'system' when '/load' then 'load' else 'noop' end
       when role = 'system' then 'system' else 'message' end as kind,
  case when role = 'user' and starts_with(text, '/') then regexp_extract(text, '(?s)^{PY_NONSPACE}+{PY_SPACE}+(.*)\\z', 1)
       when role = 'system' then coalesce(text, '') end as arg
  from ev0),
q as (select session_id, min(seq) as quit_seq from ev where kind = 'quit' group by session_id),
e as (select ev.*, q.quit_seq, (q.quit_seq is null or ev.seq < q.quit_seq) as live from ev left join q using (session_id)),
st as (select session_id,
  max(seq) filter (where live and kind = 'clear') as clear_seq,
  max(seq) filter (where live and kind = 'system') as sys_seq,
  arg_max(arg, seq) filter (where live and kind = 'system') as sys_arg,
  max(quit_seq) as quit_seq from e group by session_id),
msgs as (select e.session_id, e.seq, e.role, e.text from e join st using (session_id)
  where e.live and e.kind = 'message' and (st.clear_seq is null or e.seq > st.clear_seq)),
replayed as (select st.session_id,
  case when st.sys_seq is not null and length(st.sys_arg) > 0 then st.sys_arg end as system_prompt,
  (st.quit_seq is not null)::bigint as closed, coalesce(m.n, 0)::bigint as n_messages,
  coalesce(m.t, '') as messages_text
  from st left join (select session_id, count(*) as n,
    string_agg(role || ':' || text, {SQL_SEP} order by seq) as t from msgs group by session_id) m using (session_id))
"""

# --------------------------------------------------------------------------- /load

# Load commands by key: (modulus, remainder, seq, how far the named conversation lies from the session).
SESSION_LOADS = [(7, 2, 3, 1), (7, 5, 1, 2), (14, 9, 7, 3), (11, 4, 5, -1_000_000)]


def load_events(spark, d) -> DataFrame:
    """``session_events`` plus ``/load`` commands, some of names that were never saved."""
    ids = table(spark, d, "conversations").select(F.col("conv_id").alias("session_id")).distinct()
    loads = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for n, x in zip("mrsd", row)]) for row in SESSION_LOADS])
    extra = ids.select("session_id", F.explode(F.filter(loads, lambda c: F.col("session_id") % c["m"] == c["r"])).alias("c"))
    text = F.concat(F.lit("/load saved-"), (F.col("session_id") + F.col("c.d")).cast("string"))
    return session_events(spark, d).unionByName(extra.select("session_id", F.col("c.s").alias("seq"), F.lit("user").alias("role"), text.alias("text")))


def named_sessions(spark, d) -> DataFrame:
    return saved_sessions(spark, d).select(F.concat(F.lit("saved-"), F.col("conv_id").cast("string")).alias("name"), "system_prompt", "messages")


def sql_load_events() -> str:
    parts = [sql_session_events()]
    for m, r, seq, off in SESSION_LOADS:
        parts.append(f"select conv_id, {seq}::bigint, 'user', '/load saved-' || (conv_id + {off}) from "
                     f"(select distinct conv_id from conversations) where conv_id % {m} = {r}")
    return " union all ".join(parts)


def sql_load_replay() -> str:
    """Replay with loads: the last live load that finds its name is a reset that brings messages along."""
    head = SQL_CLASSIFY[: SQL_CLASSIFY.index("st as (")].strip().rstrip(",")
    return f"""
with {SQL_SAVED.strip()},
ev0 as ({sql_load_events()}),
{head},
found as (select e.session_id, e.seq, s.system_prompt as load_system, s.messages as load_messages
  from e join saved s on e.kind = 'load' and e.live and e.arg = 'saved-' || s.conv_id),
ld as (select session_id, max(seq) as load_seq, arg_max(load_system, seq) as load_system, arg_max(load_messages, seq) as load_messages
  from (select session_id, seq, coalesce(load_system, '') as load_system, load_messages from found) group by session_id),
ctl as (select session_id, max(seq) filter (where live and kind = 'clear') as clear_seq,
  max(seq) filter (where live and kind = 'system') as sys_seq, arg_max(arg, seq) filter (where live and kind = 'system') as sys_arg,
  max(quit_seq) as quit_seq from e group by session_id),
st as (select ctl.*, load_seq, load_system, greatest(clear_seq, load_seq) as reset_seq,
  case when load_seq is not null and load_seq = greatest(clear_seq, load_seq) then load_messages else [] end as base
  from ctl left join ld using (session_id)),
msgs as (select e.session_id, e.seq, e.role, e.text from e join st using (session_id)
  where e.live and e.kind = 'message' and (st.reset_seq is null or e.seq > st.reset_seq)),
listed as (select st.*, list_concat(list_transform(base, lambda m: m.role || ':' || m.content), coalesce(t, [])) as said
  from st left join (select session_id, list(role || ':' || text order by seq) as t from msgs group by session_id) using (session_id))
select session_id, nullif(case when load_seq is not null and (sys_seq is null or load_seq > sys_seq) then load_system else sys_arg end, '') as system_prompt,
  (quit_seq is not null)::bigint as closed, len(said)::bigint as n_messages, array_to_string(said, {SQL_SEP}) as messages_text
from listed
"""


# --------------------------------------------------------------------------- sessions


def saved_sessions(spark, d) -> DataFrame:
    """Sessions with a system prompt: the system turn's text, '' for conv_id % 3 = 0."""
    conv = table(spark, d, "conversations")
    sys = conv.filter(F.col("role") == "system").select("conv_id", F.col("text").alias("sys_text"))
    msgs = sessions_from_turns(conv.filter(F.col("role") != "system"))
    out = msgs.join(sys, "conv_id", "left")
    prompt = F.when(F.col("conv_id") % 3 == 0, F.lit("")).otherwise(F.col("sys_text"))
    return out.select("conv_id", prompt.alias("system_prompt"), "messages")


SQL_SAVED = f"""
sysrows as (select conv_id, text as sys_text from conversations where role = 'system'),
sm as ({SQL_MESSAGES.format(where="where role <> 'system'")}),
saved as (select sm.conv_id, case when sm.conv_id % 3 = 0 then '' else sys_text end as system_prompt, messages
  from sm left join sysrows using (conv_id))
"""

__all__ = [name for name in dir() if not name.startswith("_")]
