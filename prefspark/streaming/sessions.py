"""Incremental session replay over a stream of chat events, in any order of arrival.

The rules are those of ``operators.sessions.replay_sessions``. Every event becomes a row of
the output as it arrives: a ``message`` (with its ``seq``), a ``control`` (``/quit``, ``/clear``,
``/system``, ``/load``, system rows) or ``seen`` (anything else). These rows come straight from
JVM expressions; no message passes through Python or through state.

Only control events are also dealt by session to ``transformWithState``, which keeps them in a
map by (seq, kind) and emits a ``state`` row for each micro-batch that brings a session any:
system prompt, closed flag, the seqs of quit and last reset. A control that arrives late takes its
place by seq, so a state row is what the batch replay gives for the events so far, in whatever
order they came.

* ``final_sessions`` applies the batch rules to the whole output table, by seq. It needs no state
  row, so neither timeouts nor restarts of the stream lose anything.
* ``live_sessions`` reads the newest state row of each session.

State is a session's control events. ``idle_timeout_ms`` sets a timer per session: one without new
controls for so long keeps only what they come to (a few scalars and the loaded session), from
which later ones go on. ``state_ttl_ms`` gives state a time to live; a session that comes back
afterwards has live rows of its new controls only. Both need a ``processingTime`` trigger, since
Spark then keeps running batches for timers.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from prefspark.functions.chat import message
from prefspark.operators.ordinal import checked_small, null_safe_join
from prefspark.operators.sessions import CONTROL, LOAD_COLUMNS, chunked_lists, classify_events, session_bounds, with_loads
from prefspark.session import ship_code
from prefspark.types import MESSAGES

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_EVENT = "kind string, seq long, role string, content string, control string, arg string, load_found boolean, load_system string"
_STATE = "version long, quit_seq long, reset_seq long, system_prompt string, closed boolean, base_messages array<struct<role:string,content:string>>"
_CONTROL_KEY = "seq long, kind string"
_CONTROL_VALUE = "arg string, load_system string, load_messages array<struct<role:string,content:string>>"
# What a session's controls come to: the first quit, and the last clear, system and load before it.
_SUMMARY = f"version long, quit_seq long, clear_seq long, sys_seq long, sys_arg string, load_seq long, load_system string, {_CONTROL_VALUE.split(', ')[-1]}"


def output_schema(session_type: T.DataType) -> T.StructType:
    """Columns of the stream's output; ``session_id`` has the type of the input's."""
    fields = [T.StructField("session_id", session_type)]
    fields += T.StructType.fromDDL(_EVENT).fields + [T.StructField("load_messages", MESSAGES)] + T.StructType.fromDDL(_STATE).fields
    return T.StructType(fields)


def _messages(found) -> list[tuple]:
    return [(m["role"], m["content"]) for m in found or []]


def settle(summary: dict | None, controls: list[tuple]) -> dict:
    """What ``controls`` ``(seq, kind, arg, load_system, load_messages)`` come to, on top of a summary of earlier ones.

    At one seq a quit comes before all else, and a system prompt after a load. A null seq is lowest.
    """
    out = dict(summary) if summary else {"quit_seq": None, "clear_seq": None, "sys_seq": None, "sys_arg": None, "load_seq": None, "load_system": None, "load_messages": []}
    quits = [c[0] for c in controls if c[1] == "quit"] + ([out["quit_seq"]] if out["quit_seq"] is not None else [])
    out["quit_seq"] = min((q for q in quits if q is not None), default=None)
    for seq, kind, arg, load_system, load_messages in controls:
        if seq is None or (out["quit_seq"] is not None and seq >= out["quit_seq"]):
            continue
        if kind == "clear" and (out["clear_seq"] is None or seq > out["clear_seq"]):
            out["clear_seq"] = seq
        elif kind == "system" and (out["sys_seq"] is None or seq >= out["sys_seq"]):
            out["sys_seq"], out["sys_arg"] = seq, arg
        elif kind == "load" and (out["load_seq"] is None or seq >= out["load_seq"]):
            out["load_seq"], out["load_system"], out["load_messages"] = seq, load_system, load_messages
    return out


class SessionState(StatefulProcessor):
    """Control events of one session as keyed state, and the state row they come to."""

    def __init__(self, schema: T.StructType, default_system: str | None, idle_timeout_ms: int | None, state_ttl_ms: int | None):
        self.blank = dict.fromkeys(schema.fieldNames())
        self.default_system, self.idle, self.ttl = default_system, idle_timeout_ms, state_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.controls = handle.getMapState("controls", _CONTROL_KEY, _CONTROL_VALUE, self.ttl)
        self.summary = handle.getValueState("summary", _SUMMARY, self.ttl)

    def _held(self) -> tuple[dict | None, list[tuple]]:
        kept = self.summary.get()
        summary = None if kept is None else dict(zip([f.split()[0] for f in _SUMMARY.split(", ")], kept))
        if summary:
            summary["load_messages"] = _messages(summary["load_messages"])
        log = [(k[0], k[1], v[0], v[1], _messages(v[2])) for k, v in self.controls.iterator()]
        return summary, sorted(log, key=lambda c: (c[0] is not None, c[0] or 0))

    def _keep(self, summary: dict) -> None:
        self.summary.update(tuple(summary[f.split()[0]] for f in _SUMMARY.split(", ")))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        for r in rows:
            if r.kind == "load" and not r.load_found:
                continue
            at = (r.seq, r.kind)
            held = self.controls.getValue(at) if self.controls.containsKey(at) else None
            # Of equal seq and kind the larger argument counts, whichever came first.
            if held is None or (r.arg or "") >= (held[0] or ""):
                self.controls.updateValue(at, (r.arg, r.load_system, _messages(r.load_messages)))
        summary, log = self._held()
        now = settle(summary, log)
        timed = self.idle or self.ttl
        version = (summary["version"] if summary else 0) + 1
        if timed:
            version = max(version, timerValues.getCurrentProcessingTimeInMs())
        # Settled for good only when the session goes idle; until then the log is kept.
        kept = summary or settle(None, [])
        self._keep({**kept, "version": version})
        if self.idle:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._row(key, now, version)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        summary, log = self._held()
        if log:
            self._keep({**settle(summary, log), "version": summary["version"] if summary else 0})
            self.controls.clear()
        return iter([])

    def _row(self, key, now: dict, version: int) -> Row:
        loaded = now["load_seq"] is not None
        from_load = loaded and (now["clear_seq"] is None or now["load_seq"] >= now["clear_seq"])
        if loaded and (now["sys_seq"] is None or now["load_seq"] > now["sys_seq"]):
            system = now["load_system"]
        else:
            system = now["sys_arg"] if now["sys_seq"] is not None else self.default_system
        resets = [s for s in (now["clear_seq"], now["load_seq"]) if s is not None]
        out = dict(self.blank)
        out |= {
            "session_id": key[0],
            "kind": "state",
            "version": version,
            "quit_seq": now["quit_seq"],
            "reset_seq": max(resets, default=None),
            "system_prompt": system or None,
            "closed": now["quit_seq"] is not None,
            "base_messages": now["load_messages"] if from_load else [],
        }
        return Row(**out)

    def close(self) -> None:
        pass


def replay_sessions_stream(
    events: DataFrame,
    default_system: str | None = None,
    saved: DataFrame | None = None,
    strip_input: bool = False,
    idle_timeout_ms: int | None = None,
    state_ttl_ms: int | None = None,
    **columns,
) -> DataFrame:
    """Streaming replay: ``message``, ``control`` and ``seen`` rows of events, ``state`` rows of sessions.

    ``saved`` (``name, system_prompt, messages``, a static table) serves ``/load``: only control
    events are joined with it (stream-static join). ``session_id`` may be of any type. The session
    that starts the query needs the RocksDB state store provider
    (``spark.sql.streaming.stateStore.providerClass``), as ``transformWithState`` does.
    """
    spark = events.sparkSession
    ship_code(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"set spark.sql.streaming.stateStore.providerClass to {ROCKSDB}")
    ev = classify_events(events, strip_input=strip_input, **columns)
    schema = output_schema(ev.schema["session_id"].dataType)
    is_control = F.col("kind").isin(*CONTROL)
    controls = with_loads(ev.filter(is_control), saved)
    timed = idle_timeout_ms or state_ttl_ms
    states = controls.groupBy("session_id").transformWithState(
        SessionState(schema, default_system, idle_timeout_ms, state_ttl_ms), schema, "append", "processingTime" if timed else "none")

    def rows(df: DataFrame, kind, **values) -> DataFrame:
        return df.select(*[({"kind": kind} | values).get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    base = {c: F.col(c) for c in ("session_id", "seq")}
    text = F.when(F.col("kind") == "message", F.col("text"))
    told = rows(ev.filter(~is_control), F.when(F.col("kind") == "message", F.lit("message")).otherwise(F.lit("seen")), role=F.col("role"), content=text, **base)
    logged = rows(controls, F.lit("control"), control=F.col("kind"), arg=F.col("arg"), **{c: F.col(c) for c in LOAD_COLUMNS}, **base)
    return told.unionByName(logged).unionByName(states)


def _sessions(out: DataFrame, states: DataFrame, part_size: int | None) -> DataFrame:
    """Sessions of ``states(session_id, quit_seq, reset_seq, system_prompt, closed, base_messages)`` with their messages."""
    states, small = checked_small(states)
    hint = F.broadcast if small else (lambda df: df)
    said = out.filter(F.col("kind") == "message").select("session_id", "seq", "role", "content")
    kept = null_safe_join(said, hint(states.select("session_id", "quit_seq", "reset_seq")), ["session_id"], "inner")
    kept = kept.filter("(quit_seq is null or seq < quit_seq) and (reset_seq is null or seq > reset_seq)")
    marks = states.select("session_id", *[F.lit(None).cast(t).alias(c) for c, t in (("seq", "long"), ("role", "string"), ("content", "string"))], F.lit(True).alias("_mark"))
    rows = kept.select("session_id", "seq", "role", "content", F.lit(False).alias("_mark")).unionByName(marks)
    entry = F.when(F.col("_mark"), F.lit(None)).otherwise(F.struct("seq", "role", "content"))
    lists = chunked_lists(rows, "session_id", "seq", entry, part_size)
    listed = F.transform("_l", lambda e: message(e["role"], e["content"])).cast(MESSAGES)
    base = F.when(F.col("part") == 0, F.col("base_messages")).otherwise(F.array().cast(MESSAGES))
    return null_safe_join(lists, hint(states), ["session_id"], "inner").select(
        "session_id", "part", "system_prompt", "closed", F.concat(base, listed).alias("messages"))


def final_sessions(out: DataFrame, default_system: str | None = None, part_size: int | None = None) -> DataFrame:
    """Final state per session of the stream's output table: the batch rules over all its rows.

    ``(session_id, part, system_prompt, closed, messages)``, as ``replay_sessions`` gives for the
    same events, whatever their order of arrival and whatever became of the stream's state.
    """
    events = out.filter(F.col("kind").isin("message", "control", "seen"))
    controls = events.filter(F.col("kind") == "control").select("session_id", "seq", F.col("control").alias("kind"), "arg", *LOAD_COLUMNS)
    return _sessions(out, session_bounds(events.select("session_id").distinct(), controls, default_system), part_size)


def live_sessions(out: DataFrame, default_system: str | None = None, part_size: int | None = None) -> DataFrame:
    """The same from the newest ``state`` row of each session, without going through its controls again."""
    newest = out.filter(F.col("kind") == "state").groupBy("session_id").agg(F.max_by(F.struct(*[f.split()[0] for f in _STATE.split(", ")]), "version").alias("s")).select("session_id", "s.*")
    everyone = out.select("session_id").distinct()
    default = F.lit(default_system or None).cast("string")
    states = null_safe_join(everyone, newest, ["session_id"], "left").select(
        "session_id", "quit_seq", "reset_seq",
        F.when(F.col("version").isNull(), default).otherwise(F.col("system_prompt")).alias("system_prompt"),
        F.coalesce("closed", F.lit(False)).alias("closed"),
        F.coalesce("base_messages", F.array().cast(MESSAGES)).alias("base_messages"),
    )
    return _sessions(out, states, part_size)
