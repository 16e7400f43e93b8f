import pytest

from prefspark.operators import sessions
from prefspark.types import MESSAGES

# Edge-case event log: (session, seq, role, text).
EVENTS = [
    (1, 1, "user", "hello"), (1, 2, "assistant", "hi"), (1, 3, "user", "/clear"), (1, 4, "user", "again"),
    (1, 5, "assistant", "ok"),
    (2, 1, "user", "/CLEAR"), (2, 2, "user", "/system be brief"), (2, 3, "user", "q"), (2, 4, "assistant", "a"),
    (3, 1, "user", "/system x"), (3, 2, "user", "/system"), (3, 3, "user", "m"),
    (4, 1, "user", "one"), (4, 2, "user", "/quit"), (4, 3, "user", "after quit"),
    (5, 1, "user", "/unknown cmd"), (5, 2, "user", "   "), (5, 3, "user", " /clear"), (5, 4, "user", "　"),
    (6, 1, "system", "sys text"), (6, 2, "user", "u"), (6, 3, "user", "/history"), (6, 4, "user", "/save f.json"),
    (7, 1, "user", "/quit"),
    (8, 1, "user", "/system  two  words  "), (8, 2, "user", "/clear"),
    (9, 1, "user", "/load saved-a"), (9, 2, "user", "next"), (9, 3, "user", "/load missing"),
    (10, 1, "user", "x"), (10, 2, "user", "/clear"), (10, 3, "user", "/load saved-a"), (10, 4, "user", "/system s2"),
]
SAVED = {"saved-a": {"system_prompt": "from file", "messages": [{"role": "user", "content": "old"},
                                                               {"role": "assistant", "content": "old reply"}]}}


def _events(spark, rows=EVENTS):
    return spark.createDataFrame(rows, "session_id long, seq long, role string, text string")


def _saved(spark):
    rows = [(k, v["system_prompt"], v["messages"]) for k, v in SAVED.items()]
    return spark.createDataFrame(rows, f"name string, system_prompt string, messages {MESSAGES.simpleString()}")


def _said(*texts):
    """Messages written ``role: content``; a text without a role is the user's."""
    return [{"role": r, "content": c} for r, c in (t if isinstance(t, tuple) else ("user", t) for t in texts)]


OLD = [("user", "old"), ("assistant", "old reply")]
#: What EVENTS leave, with SAVED and no default system prompt.
LEFT = {
    1: (None, False, _said("again", ("assistant", "ok"))), 2: ("be brief", False, _said("q", ("assistant", "a"))), 3: (None, False, _said("m")),
    4: (None, True, _said("one")), 5: (None, False, _said(" /clear")), 6: ("sys text", False, _said("u")), 7: (None, True, []),
    8: ("two  words  ", False, []), 9: ("from file", False, _said(*OLD, "next")), 10: ("s2", False, _said(*OLD)),
}
#: After the first two events of every session, without saved sessions.
EARLY = {
    1: (None, False, _said("hello", ("assistant", "hi"))), 2: ("be brief", False, []), 3: (None, False, []), 4: (None, True, _said("one")), 5: (None, False, []),
    6: ("sys text", False, _said("u")), 7: (None, True, []), 8: ("two  words  ", False, []), 9: (None, False, _said("next")), 10: (None, False, []),
}


def _got(df):
    return {r.session_id: (r.system_prompt, r.closed, [m.asDict() for m in r.messages]) for r in df.collect()}


@pytest.mark.parametrize("default", [None, "default sys"])
def test_replay_matches_fold(spark, default):
    got = _got(sessions.replay_sessions(_events(spark), default_system=default, saved=_saved(spark)))
    unset = (1, 4, 5, 7)  # 3 unsets the default by its bare /system
    assert got == {k: (default if k in unset else s, closed, m) for k, (s, closed, m) in LEFT.items()}


def test_replay_without_saved_ignores_load(spark):
    got = _got(sessions.replay_sessions(_events(spark)))
    assert got == LEFT | {9: (None, False, _said("next")), 10: ("s2", False, [])}


def test_replay_long_form_matches_arrays(spark):
    long = sessions.replay_messages(_events(spark), saved=_saved(spark))
    rows = long.orderBy("session_id", "seq", "pos").collect()
    by = {}
    for r in rows:
        by.setdefault(r.session_id, []).append({"role": r.role, "content": r.content})
    exp = {k: v[2] for k, v in LEFT.items() if v[2]}
    assert by == exp


def test_strip_input_option(spark):
    rows = [(1, 1, "user", "a"), (1, 2, "user", " /clear"), (1, 3, "user", "b")]
    plain = _got(sessions.replay_sessions(_events(spark, rows)))
    stripped = _got(sessions.replay_sessions(_events(spark, rows), strip_input=True))
    assert len(plain[1][2]) == 3
    assert [m["content"] for m in stripped[1][2]] == ["b"]


def test_session_history_bound(spark):
    ev = _events(spark)
    got = _got(sessions.session_history(ev, 2))
    assert got == EARLY
    bound = spark.createDataFrame([(1, 3), (4, 1)], "session_id long, at_seq long")
    got = _got(sessions.session_history(ev, bound))
    assert got == {1: (None, False, []), 4: (None, False, _said("one"))}


def test_sessions_from_turns_order(spark):
    turns = spark.createDataFrame([(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "assistant", "b")],
                                  "conv_id long, turn long, role string, text string")
    r = sessions.sessions_from_turns(turns).collect()[0]
    assert [m.content for m in r.messages] == ["a", "b", "c"]


def test_build_messages_truthiness(spark):
    m = [{"role": "user", "content": "q"}]
    df = spark.createDataFrame([(0, None, m), (1, "", m), (2, " ", m), (3, "own", m)],
                               f"id long, sp string, messages {MESSAGES.simpleString()}")
    out = sessions.build_messages(df, "messages", "sp", default=None).orderBy("id").collect()
    assert [len(r.messages) for r in out] == [1, 1, 2, 2]
    out = sessions.build_messages(df, "messages", "sp", default="dflt").orderBy("id").collect()
    assert [r.messages[0].content for r in out] == ["dflt", "dflt", " ", "own"]


def test_render_chat(spark):
    m = [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]
    df = spark.createDataFrame([(0, m)], f"id long, messages {MESSAGES.simpleString()}")
    r = sessions.render_chat(df).collect()[0].rendered
    assert r == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n"
    r = sessions.render_chat(df, add_generation_prompt=False).collect()[0].rendered
    assert not r.endswith("assistant\n")


def test_turn_contexts(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"),
                                   (1, 3, "assistant", "d")], "conv_id long, turn long, role string, text string")
    rows = sessions.turn_contexts(turns).orderBy("turn").collect()
    assert [[m.content for m in r.context] for r in rows] == [["a"], ["a", "b", "c"]]
    assert [r.reply for r in rows] == ["b", "d"]
    rows = sessions.turn_contexts(turns, max_context=2).orderBy("turn").collect()
    assert [[m.content for m in r.context] for r in rows] == [["a"], ["b", "c"]]


def _long_sessions(spark):
    import random
    rnd = random.Random(4)
    rows = [(c, t, rnd.choice(["user", "assistant"]) if t > 40 else "user", f"m{t if c < 3 or t < 30 else -t}") for c in (1, 2, 3, 2**60 + 1) for t in range(90)]
    rows += [(None, t, "assistant", f"m{t}") for t in (3, 1, 2)] + [(9, None, "assistant", "first"), (9, 4, None, None), (9, 4, "assistant", "b"), (9, 4, "assistant", "a")]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_context_links_are_linear_and_unfold_to_the_window(spark):
    rows, turns = _long_sessions(spark)
    plain = sessions.context_links(turns, reply_role=None)
    parts = sessions.context_links(turns, reply_role=None, part_size=16)
    as_set = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert as_set(plain) == as_set(parts) and plain.count() == len(rows)
    ordered = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        ordered.setdefault(c, []).append((r, x))
    # One key per distinct prefix, and the parent's key is the shorter prefix's.
    prefix = {}
    for r in plain.collect():
        history = tuple(ordered[r.conv_id][: r.n_context])
        assert prefix.setdefault(r.context_key, history) == history
        assert (r.parent_key is None) == (r.n_context == 0)
        if r.n_context:
            assert prefix.setdefault(r.parent_key, history[:-1]) == history[:-1]
    assert len(set(prefix.values())) == len(prefix)
    for r in sessions.unfold_contexts(plain, turns).collect():
        assert [(m.role, m.content) for m in r.context] == ordered[r.conv_id][: r.n_context]
    some = sessions.unfold_contexts(plain.filter("conv_id = 2 and n_context in (5, 60)"), turns).collect()
    assert sorted(len(r.context) for r in some) == [5, 60]


def test_session_json_roundtrip_keeps_null(spark):
    m = [{"role": "user", "content": "q"}]
    df = spark.createDataFrame([(0, None, m), (1, "sys", [])], f"id long, system_prompt string, messages {MESSAGES.simpleString()}")
    j = sessions.session_to_json(df).orderBy("id").collect()
    assert '"system_prompt":null' in j[0].json
    back = sessions.session_from_json(spark.createDataFrame([(0, '{"other": 1}')], "id long, json string")).collect()[0]
    assert back.system_prompt is None and back.messages == []


def test_replay_has_no_python_and_no_window(spark):
    df = sessions.replay_sessions(_events(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Window" not in plan


def test_long_sessions_come_in_bounded_parts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(0, 200, 2)] + [(2, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = sessions.sessions_from_turns(turns, part_size=16).orderBy("conv_id", "part").collect()
    long = [r for r in out if r.conv_id == 1]
    assert len(long) > 1 and all(len(r.messages) <= 32 for r in long)
    assert [m.content for r in long for m in r.messages] == [f"m{t}" for t in range(0, 200, 2)]
    assert [r.part for r in out if r.conv_id == 2] == [0]


def test_replay_parts_concatenate_to_whole(spark):
    rows = [(1, s, "user", f"u{s}") for s in range(1, 120)] + [(1, 50, "user", "/clear")] + EVENTS[:5]
    rows = [r for r in rows if not (r[0] == 1 and r[1] in (1, 2, 3, 4, 5) and r[3].startswith("u"))]
    ev = _events(spark, rows)
    parts = sessions.replay_sessions(ev, part_size=8).orderBy("session_id", "part").collect()
    merged = {}
    for r in parts:
        merged.setdefault(r.session_id, []).extend(m.content for m in r.messages)
    assert merged == {1: [f"u{s}" for s in range(51, 120)]}  # u50 and the /clear share a place, in this order


@pytest.mark.parametrize("n", [1, 3, 40])
def test_bounded_contexts_over_hot_sessions(spark, n):
    import random
    rnd = random.Random(n)
    rows = [(1, t * 2 + rnd.randint(0, 1), rnd.choice(["user", "assistant"]), f"a{t}") for t in range(150)]
    rows += [(2, t, "assistant" if t % 2 else "user", f"b{t}") for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sessions.turn_contexts(turns, max_context=n, part_size=10)
    ref = sessions.turn_contexts(turns, max_context=n, part_size=10_000)
    as_list = lambda df: sorted(((r.conv_id, r.turn, [m.content for m in r.context], r.reply) for r in df.collect()))
    assert as_list(got) == as_list(ref)
    assert len(as_list(got)) == sum(1 for r in rows if r[2] == "assistant")


def test_a_session_of_any_length_is_one_row(spark):
    from pyspark.sql import functions as F

    n = 70_000
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    lists = sessions.sessions_from_turns(turns)
    full = sessions.build_messages(lists, system_prompt=F.lit("sys")).select(F.size("messages").alias("n"), F.element_at("messages", -1)["content"].alias("last")).collect()
    assert [tuple(r) for r in full] == [(n + 1, f"t{n - 1}")]
    events = turns.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("seq"), "role", "text")
    out = sessions.replay_sessions(events).select("part", F.size("messages").alias("n")).collect()
    assert [tuple(r) for r in out] == [(0, n)]
    parts = sessions.replay_sessions(events, part_size=30_000).select(F.lit("kept").alias("name"), "part", F.lit("old").alias("system_prompt"), "messages")
    assert parts.count() > 1
    load = spark.createDataFrame([(2, 0, "user", "/load kept"), (2, 1, "user", "more")], "session_id long, seq long, role string, text string")
    got = sessions.replay_sessions(load, saved=parts).select("system_prompt", F.transform("messages", lambda m: m["content"]).alias("m")).collect()
    assert got[0]["system_prompt"] == "old" and got[0]["m"] == [*(f"t{i}" for i in range(n)), "more"]
