"""Chat sessions: message lists from turn rows, rendering, and event-log replay.

Event-log replay (``replay_sessions``) is built from per-session aggregates
(partial aggregation on the map side) and joins on ``session_id``, not from a
running window, so a very long session is not sorted inside one task: the
joins are sort-merge or broadcast as AQE decides at run time, and AQE's
skew-join handling splits a hot session's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefspark.functions.chat import message, render_messages
from prefspark.operators.ordinal import checked_small, join_small, null_safe_join
from prefspark.operators.segments import PART_SIZE, hot_parts, split_hot
from prefspark.functions.text import PY_NONSPACE, PY_SPACE, is_blank, py_strip, truthy
from prefspark.types import MESSAGES, SESSION


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- E1


def chunked_lists(
    df: DataFrame,
    key: str,
    order: str,
    entry: Column,
    part_size: int | None = None,
    out: str = "_l",
    spans: DataFrame | None = None,
) -> DataFrame:
    """Ordered lists of ``entry`` per ``key``: ``(key, part, out)``.

    Every key has one list (``part`` 0), of any length. With ``part_size`` a
    key with more rows comes in parts grouped by separate tasks
    (``segments.hot_parts``), whose lists concatenated in ``part`` order are
    the whole list; operators on message lists do not take such parts.
    """
    if part_size is None:
        parts = df.withColumn("part", F.lit(0).cast("long"))
    else:
        parts = hot_parts(df, key, order, part_size, spans)
    return parts.groupBy(key, "part").agg(F.array_sort(F.collect_list(entry)).alias(out))


def sessions_from_turns(
    turns: DataFrame,
    session: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    out: str = "messages",
    part_size: int | None = None,
) -> DataFrame:
    """Messages of each session ordered by ``order``: ``(session, part, messages)``.

    One row per session, ``part`` 0; only with ``part_size`` a session with
    more messages comes in parts (see ``chunked_lists``).
    """
    entry = F.struct(F.col(order).alias("k"), F.col(role).alias("role"), F.col(text).alias("content"))
    lists = chunked_lists(turns, session, order, entry, part_size)
    return lists.select(
        session, "part", F.transform("_l", lambda e: message(e["role"], e["content"])).alias(out)
    )


# --------------------------------------------------------------------------- E2, E3


def system_prompt_value(system_prompt: Column | str | None, default: str | None = None) -> Column:
    """``system_prompt or default`` with Python truthiness."""
    arg = F.lit(None).cast("string") if system_prompt is None else _c(system_prompt).cast("string")
    return F.when(truthy(arg), arg).otherwise(F.lit(default).cast("string"))


def build_messages(
    df: DataFrame,
    messages: str = "messages",
    system_prompt: Column | str | None = None,
    default: str | None = None,
    out: str | None = None,
) -> DataFrame:
    """Prepend one system message when the system prompt is truthy."""
    sys = system_prompt_value(system_prompt, default)
    m = F.coalesce(F.col(messages), F.array().cast(MESSAGES))
    full = F.when(truthy(sys), F.concat(F.array(message("system", sys)), m)).otherwise(m)
    return df.withColumn(out or messages, full)


def render_chat(
    df: DataFrame,
    messages: str = "messages",
    out: str = "rendered",
    add_generation_prompt: bool = True,
    **template,
) -> DataFrame:
    """Render a message list to model input text (ChatML markers by default)."""
    return df.withColumn(out, render_messages(F.col(messages), add_generation_prompt, **template))


# --------------------------------------------------------------------------- E4


def context_links(
    turns: DataFrame,
    session: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    reply_role: str | None = "assistant",
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Every reply with a link to the history it was generated from: linear in the turns.

    ``(session, order, n_context, context_key, parent_key, reply)``. The context is the session's
    first ``n_context`` turns. ``context_key`` (32 hex digits) names that prefix by its turns
    alone, so sessions that begin alike share it; ``parent_key`` names the prefix one turn
    shorter (null for the empty context). ``unfold_contexts`` makes message lists of chosen rows.
    With ``reply_role`` None every turn is a reply. Turns are ordered by ``order`` (null first),
    then role and text.

    A prefix's name is the exclusive or of two hashes of each (position, role, text), so it is a
    running aggregate: sessions of over ``part_size`` turns are windowed in parts, and each
    part's count and names so far come from a table with a row per part.
    """
    x, hot = split_hot(turns.select(session, order, role, text), session, order, part_size)
    by = Window.partitionBy(session, "part").orderBy(F.asc_nulls_first(order), F.asc_nulls_first(role), F.asc_nulls_first(text))
    earlier = Window.partitionBy(session).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_pos", F.row_number().over(by).cast("long"))
    if hot:
        sizes = x.groupBy(session, "part").agg(F.count(F.lit(1)).alias("_n"))
        sizes = sizes.select(session, "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
        x = join_small(x, sizes.filter("_start > 0"), [session, "part"], "left")
        x = x.withColumn("_pos", F.col("_pos") + F.coalesce("_start", F.lit(0))).drop("_start")
    said = [F.col("_pos"), F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))]
    x = x.withColumns({"_h1": F.xxhash64(*said), "_h2": F.xxhash64(F.lit("second"), *said)})
    own = by.rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({"_k1": F.bit_xor("_h1").over(own), "_k2": F.bit_xor("_h2").over(own)})
    if hot:
        sums = x.groupBy(session, "part").agg(F.bit_xor("_h1").alias("_x1"), F.bit_xor("_h2").alias("_x2"))
        sums = sums.select(session, "part", *[F.bit_xor(f"_x{i}").over(earlier).alias(f"_e{i}") for i in (1, 2)])
        x = join_small(x, sums.filter("_e1 is not null"), [session, "part"], "left")
        x = x.withColumns({f"_k{i}": F.col(f"_k{i}").bitwiseXOR(F.coalesce(f"_e{i}", F.lit(0))) for i in (1, 2)})
    # The turn's own name without its own hash is its context's, and so on to the parent.
    before = [F.col(f"_k{i}").bitwiseXOR(F.col(f"_h{i}")) for i in (1, 2)]
    lag = [F.lag(F.col(f"_h{i}")).over(by) for i in (1, 2)]
    if hot:
        last = x.groupBy(session, "part").agg(F.max_by(F.struct("_h1", "_h2"), "_pos").alias("_last"))
        last = last.select(session, "part", F.lag("_last").over(Window.partitionBy(session).orderBy("part")).alias("_halo"))
        x = join_small(x, last.filter("_halo is not null"), [session, "part"], "left")
        lag = [F.coalesce(g, F.col(f"_halo._h{i}")) for i, g in enumerate(lag, 1)]
    name = lambda a, b: F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
    x = x.withColumns({"_b1": before[0], "_b2": before[1], "_l1": lag[0], "_l2": lag[1]})
    if reply_role is not None:
        x = x.filter(F.col(role) == reply_role)
    parent = name(F.col("_b1").bitwiseXOR(F.col("_l1")), F.col("_b2").bitwiseXOR(F.col("_l2")))
    return x.select(
        session, order, (F.col("_pos") - 1).alias("n_context"), name(F.col("_b1"), F.col("_b2")).alias("context_key"),
        F.when(F.col("_pos") > 1, parent).alias("parent_key"), F.col(text).alias("reply"),
    )


def unfold_contexts(
    links: DataFrame, turns: DataFrame, session: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``links`` (rows of ``context_links``, all or some) plus ``context``, the messages they stand for.

    One list per session that is asked for, and a slice of it per link: turns are shuffled once,
    and only the output grows with the length of the contexts.
    """
    asked = links.groupBy(session).agg(F.max("n_context").alias("_most"))
    entry = F.struct(F.col(order).isNotNull().alias("n"), F.col(order).alias("k"), F.col(role).alias("role"), F.col(text).alias("content"))
    lists = turns.select(session, order, role, text).groupBy(session).agg(F.array_sort(F.collect_list(entry)).alias("_turns"))
    lists = null_safe_join(lists, asked, [session], "inner").select(
        session, F.transform(F.slice("_turns", 1, F.col("_most").cast("int")), lambda e: message(e["role"], e["content"])).alias("_turns"))
    out = null_safe_join(links, lists, [session], "inner")
    return out.withColumn("context", F.slice("_turns", 1, F.col("n_context").cast("int"))).drop("_turns")


def turn_contexts(
    turns: DataFrame,
    session: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    reply_role: str = "assistant",
    max_context: int | None = None,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Every reply with the history it was generated from, as message lists.

    The context is, by definition, the whole earlier session: ``context_links`` unfolded for
    every reply, so the output grows with the square of a session's length, as the model
    input does; keep the links where that is too much. ``max_context`` keeps only the last
    that many turns (a model context window); the output is then linear, and sessions longer
    than ``part_size`` are windowed in parts (``_bounded_contexts_hot``).
    """
    if max_context is not None and max_context < 1:
        raise ValueError("max_context must be positive")
    cols = [session, order, "context", F.col(text).alias("reply")]
    if max_context is None:
        links = context_links(turns, session, order, role, text, reply_role, part_size)
        return unfold_contexts(links, turns, session, order, role, text).select(session, order, "context", "reply")
    x, any_hot = split_hot(turns.select(session, order, role, text), session, order, part_size)
    w = Window.partitionBy(session, "part").orderBy(order).rowsBetween(-int(max_context), -1)
    ctx = F.collect_list(message(F.col(role), F.col(text))).over(w)
    normal = x.filter(~F.col("_hot")) if any_hot else x
    out = (normal.select(session, order, role, text, ctx.alias("context"))
           .filter(F.col(role) == reply_role).select(*cols))
    if not any_hot:
        return out
    hot = _bounded_contexts_hot(x.filter(F.col("_hot")), session, order, role, text, reply_role, int(max_context))
    return out.unionByName(hot.select(*cols))


def _bounded_contexts_hot(x, session, order, role, text, reply_role, n) -> DataFrame:
    """Contexts of the last ``n`` turns for hot sessions, window per part plus a halo.

    Positions are exact (part offsets from per-part counts, a small table).
    The ``n`` rows before a part's first position are copied into that part
    as a halo, so the bounded window of every reply sees the same rows as a
    window over the whole session; halo rows give no output of their own.
    """
    counts = x.groupBy(session, "part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(session).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(session, "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    in_part = Window.partitionBy(session, "part").orderBy(order)
    rows = join_small(x, counts, [session, "part"]).withColumn(
        "_pos", F.col("_start") + F.row_number().over(in_part)).withColumn("_halo", F.lit(False))
    starts = counts.groupBy(session).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_start").alias("s"), F.col("part").alias("p")))).alias("_starts"))
    need = F.filter("_starts", lambda e: (e["s"] >= F.col("_pos")) & (e["s"] < F.col("_pos") + F.lit(n)))
    halo = join_small(rows.drop("_start"), starts, [session]).select(
        session, order, role, text, "_pos", F.explode(need).alias("_t"))
    halo = halo.select(session, F.col("_t.p").alias("part"), order, role, text, "_pos", F.lit(True).alias("_halo"))
    both = rows.select(session, "part", order, role, text, "_pos", "_halo").unionByName(halo)
    w = Window.partitionBy(session, "part").orderBy("_pos").rowsBetween(-n, -1)
    ctx = F.collect_list(message(F.col(role), F.col(text))).over(w)
    return (both.select("*", ctx.alias("context"))
            .filter(~F.col("_halo") & (F.col(role) == reply_role)))


# --------------------------------------------------------------------------- E5, E8

KINDS = ("skip", "quit", "clear", "system", "load", "noop", "message")


def classify_events(
    events: DataFrame,
    session: str = "session_id",
    seq: str = "seq",
    role: str = "role",
    text: str = "text",
    strip_input: bool = False,
) -> DataFrame:
    """Tag each event: ``kind`` (one of KINDS), ``arg`` for commands.

    User text is a command when it starts with ``/``: split once on
    whitespace, the name lower-cased, the rest the argument. Blank user text is
    skipped. A ``system`` role row sets the system prompt like ``/system``.
    """
    t = F.col(text).cast("string")
    if strip_input:
        t = py_strip(t)
    r = F.col(role)
    is_user = r == "user"
    name = F.lower(F.regexp_extract(t, rf"^({PY_NONSPACE}+)", 1))
    arg = F.regexp_extract(t, rf"(?s)^{PY_NONSPACE}+{PY_SPACE}+(.*)\z", 1)
    kind = (
        F.when(is_user & (t.isNull() | is_blank(t)), "skip")
        .when(is_user & t.startswith("/"),
              F.when(name == "/quit", "quit")
              .when(name == "/clear", "clear")
              .when(name == "/system", "system")
              .when(name == "/load", "load")
              .otherwise("noop"))
        .when(r == "system", "system")
        .otherwise("message")
    )
    arg = F.when(is_user & t.startswith("/"), arg).when(r == "system", F.coalesce(t, F.lit("")))
    return events.select(
        F.col(session).alias("session_id"),
        F.col(seq).alias("seq"),
        r.alias("role"),
        t.alias("text"),
        kind.alias("kind"),
        arg.alias("arg"),
    )


def whole_saved(saved: DataFrame) -> DataFrame:
    """Saved sessions ``(name, system_prompt, messages)``, their parts put together.

    A table with a ``part`` column has one row per name and part.
    """
    if "part" not in saved.columns:
        return saved
    m = F.coalesce(F.col("messages"), F.array().cast(MESSAGES))
    parts = saved.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("part", m.alias("m")))).alias("_p"), F.min_by("system_prompt", "part").alias("system_prompt"))
    return parts.select("name", "system_prompt", F.flatten(F.transform("_p", lambda p: p["m"])).alias("messages"))


CONTROL = ("quit", "clear", "system", "load")
LOAD_COLUMNS = ("load_found", "load_system", "load_messages")


def with_loads(controls: DataFrame, saved: DataFrame | None) -> DataFrame:
    """Control events plus what their ``/load`` finds in ``saved``: ``LOAD_COLUMNS``."""
    if saved is None:
        return controls.select("*", F.lit(False).alias("load_found"), F.lit(None).cast("string").alias("load_system"),
                               F.array().cast(MESSAGES).alias("load_messages"))
    target = whole_saved(saved).select(
        F.when(F.col("name").isNotNull(), F.lit("load")).alias("kind"),
        F.col("name").alias("arg"),
        F.lit(True).alias("load_found"),
        F.col("system_prompt").alias("load_system"),
        F.coalesce(F.col("messages"), F.array().cast(MESSAGES)).alias("load_messages"),
    )
    found = controls.join(target, ["kind", "arg"], "left")
    return found.select(*controls.columns, F.coalesce("load_found", F.lit(False)).alias("load_found"), "load_system",
                        F.coalesce("load_messages", F.array().cast(MESSAGES)).alias("load_messages"))


def session_bounds(sessions: DataFrame, controls: DataFrame, default_system: str | None) -> DataFrame:
    """What control events (``with_loads``) come to, for every row of ``sessions(session_id, ...)``.

    Adds ``system_prompt, closed, quit_seq, reset_seq`` (messages count between reset and quit,
    both exclusive) and ``base_messages`` (of a load that is the last reset).
    """
    quits = controls.filter(F.col("kind") == "quit").groupBy("session_id").agg(F.min("seq").alias("quit_seq"))
    ctrl = null_safe_join(controls, quits, ["session_id"], "left")
    live = F.col("quit_seq").isNull() | (F.col("seq") < F.col("quit_seq"))

    def last(kind: str, also=F.lit(True)) -> Column:
        return F.when(live & (F.col("kind") == kind) & also, F.col("seq"))

    found = last("load", F.col("load_found"))
    state = ctrl.groupBy("session_id").agg(
        F.max("quit_seq").alias("quit_seq"),
        F.max(last("clear")).alias("clear_seq"),
        # Of equal seqs the larger argument counts, so a retried task gives the same.
        F.max(F.when(last("system").isNotNull(), F.struct("seq", F.coalesce("arg", F.lit("")).alias("arg")))).alias("_sys"),
        F.max_by(F.struct("load_system", "load_messages"), found).alias("_load"),
        F.max(found).alias("load_seq"),
    )
    state = null_safe_join(sessions, state, ["session_id"], "left")
    reset = F.greatest("clear_seq", "load_seq")
    from_load = F.col("load_seq").isNotNull() & (F.col("load_seq") == reset)
    sys_from_load = F.col("load_seq").isNotNull() & (F.col("_sys").isNull() | (F.col("load_seq") > F.col("_sys.seq")))
    value = (F.when(sys_from_load, F.col("_load.load_system"))
             .when(F.col("_sys").isNotNull(), F.col("_sys.arg"))
             .otherwise(F.lit(default_system).cast("string")))
    return state.select(
        *sessions.columns,
        F.when(truthy(value), value).alias("system_prompt"),
        F.col("quit_seq").isNotNull().alias("closed"),
        "quit_seq",
        reset.alias("reset_seq"),
        F.when(from_load, F.col("_load.load_messages")).otherwise(F.array().cast(MESSAGES)).alias("base_messages"),
    )


def _replay_frames(
    events: DataFrame,
    default_system: str | None,
    saved: DataFrame | None,
    strip_input: bool,
    columns: dict,
) -> tuple[DataFrame, DataFrame, bool]:
    """Per-session state (checkpointed), the kept message events, and whether state is small.

    Only control events (``/quit``, ``/clear``, ``/system``, ``/load``, system
    rows) are aggregated with string values; they are few. Over all events
    there is one hash aggregate (the session list) and one join of the
    message events with the per-session state. A null session id is a
    session of its own.
    """
    ev = classify_events(events, strip_input=strip_input, **columns)
    controls = with_loads(ev.filter(F.col("kind").isin(*CONTROL)), saved)
    listed = ev.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("_c"), F.min("seq").alias("_lo"), F.max("seq").alias("_hi"))
    state, small = checked_small(session_bounds(listed, controls, default_system))
    bounds = state.select("session_id", "quit_seq", "reset_seq")
    said = ev.filter(F.col("kind") == "message")
    kept = (
        null_safe_join(said, F.broadcast(bounds) if small else bounds, ["session_id"], "inner")
        .filter(F.col("quit_seq").isNull() | (F.col("seq") < F.col("quit_seq")))
        .filter(F.col("reset_seq").isNull() | (F.col("seq") > F.col("reset_seq")))
        .select("session_id", "seq", "role", F.col("text").alias("content"))
    )
    return state.drop("quit_seq"), kept, small


_SPANS = ("_c", "_lo", "_hi")


def replay_messages(
    events: DataFrame,
    default_system: str | None = None,
    saved: DataFrame | None = None,
    strip_input: bool = False,
    **columns,
) -> DataFrame:
    """Final messages of every session in long form ``(session_id, seq, pos, role, content)``.

    Loaded base messages (from ``/load``) come first with the load's ``seq``
    and ``pos`` 0..; logged messages have ``pos`` = 0. Order by (seq, pos).
    """
    state, kept, _ = _replay_frames(events, default_system, saved, strip_input, columns)
    base = state.select(
        "session_id", F.col("reset_seq").alias("seq"), F.posexplode("base_messages").alias("pos", "m")
    ).select("session_id", "seq", "pos", "m.role", F.col("m.content").alias("content"))
    return base.unionByName(kept.withColumn("pos", F.lit(0)).select(base.columns))


def replay_sessions(
    events: DataFrame,
    default_system: str | None = None,
    saved: DataFrame | None = None,
    strip_input: bool = False,
    part_size: int | None = None,
    **columns,
) -> DataFrame:
    """Final state per session: ``(session_id, part, system_prompt, closed, messages)``.

    Rules: blank user text is ignored; ``/quit`` ends the session (later
    events do not count); ``/clear`` empties the messages and keeps the system
    prompt; ``/system x`` sets it and a bare ``/system`` clears it; ``/load
    name`` replaces the session when ``saved`` (``name, system_prompt,
    messages``) has ``name``; ``/save``, ``/history`` and unknown commands
    change nothing; any other user text, and every reply, is a message.
    One row per session, of any length; ``replay_messages`` gives the same in
    long form. Only with ``part_size`` a longer session comes in several parts
    (``chunked_lists``). ``saved`` may come in such parts (see ``whole_saved``).
    """
    state, kept, small = _replay_frames(events, default_system, saved, strip_input, columns)
    spans = state.select("session_id", *_SPANS)
    state = state.drop(*_SPANS)
    lists = _lists_with_markers(kept, state, part_size, spans)
    logged = F.transform("_l", lambda e: message(e["role"], e["content"]))
    first = F.col("part") == F.lit(0)
    return null_safe_join(lists, F.broadcast(state) if small else state, ["session_id"], "inner").select(
        "session_id", "part", "system_prompt", "closed",
        F.when(first, F.concat(F.col("base_messages"), logged)).otherwise(logged).alias("messages"),
    )


def _lists_with_markers(kept: DataFrame, state: DataFrame, part_size: int | None,
                        spans: DataFrame | None = None) -> DataFrame:
    """Message lists per (session, part); every session of ``state`` has part 0.

    One marker row per session (null seq, no entry) joins the messages in
    the same aggregate, so sessions without messages need no second pass.
    """
    cols = ["session_id", "seq", "role", "content"]
    marks = state.select("session_id", F.lit(None).cast("long").alias("seq"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("content"),
                         F.lit(True).alias("_mark"))
    rows = kept.select(*cols, F.lit(False).alias("_mark")).unionByName(marks)
    entry = F.when(F.col("_mark"), F.lit(None)).otherwise(F.struct("seq", "role", "content"))
    return chunked_lists(rows, "session_id", "seq", entry, part_size, spans=spans)


def session_history(
    events: DataFrame,
    at: int | DataFrame,
    default_system: str | None = None,
    saved: DataFrame | None = None,
    **columns,
) -> DataFrame:
    """State of each session as ``/history`` shows it at ``seq <= at``.

    ``at`` is one bound for all sessions, or a table ``(session_id, at_seq)``
    with one row per session; a null id there bounds the session of null ids.
    """
    seq = columns.get("seq", "seq")
    sid = columns.get("session", "session_id")
    if isinstance(at, DataFrame):
        bound = at.select(F.col("session_id").alias(sid), F.col("at_seq").alias("_at"))
        cut = null_safe_join(events, bound, [sid], "inner").filter(F.col(seq) <= F.col("_at")).drop("_at")
    else:
        cut = events.filter(F.col(seq) <= F.lit(at))
    return replay_sessions(cut, default_system, saved, **columns)


# --------------------------------------------------------------------------- E7


def session_to_json(
    df: DataFrame, system_prompt: str = "system_prompt", messages: str = "messages", out: str = "json"
) -> DataFrame:
    """``{"system_prompt": ..., "messages": [...]}``; a null prompt is written as null."""
    s = F.struct(F.col(system_prompt).alias("system_prompt"), F.col(messages).alias("messages"))
    return df.withColumn(out, F.to_json(s, {"ignoreNullFields": "false"}))


def session_from_json(df: DataFrame, col: str = "json", strict: bool = True) -> DataFrame:
    """Parse session JSON; missing ``system_prompt`` is null, missing ``messages`` empty."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    parsed = F.from_json(F.col(col), SESSION, {"mode": mode})
    return df.withColumn("system_prompt", parsed["system_prompt"]).withColumn(
        "messages", F.coalesce(parsed["messages"], F.array().cast(MESSAGES))
    )
