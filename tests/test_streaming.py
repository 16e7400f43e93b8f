import random
import time

import pytest
from pyspark.sql import types as T

from prefspark.operators import sessions
from prefspark.plans import fixtures as fx
from prefspark.streaming import final_sessions, live_sessions, read_prompts_stream, replay_sessions_stream
from prefspark.streaming.sessions import ROCKSDB, settle
from prefspark.types import SESSION_EVENT

import test_sessions as ts
from conftest import SF_SMALL

STRING_EVENT = "session_id string, seq long, role string, text string"


@pytest.fixture(scope="module")
def streams(spark):
    """Session for stateful streams."""
    run = spark.newSession()
    run.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    run.conf.set("spark.sql.shuffle.partitions", "3")
    return run


def _stream(streams, src, out, schema=SESSION_EVENT, trigger=None, **kw):
    stream = streams.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    return (replay_sessions_stream(stream, **kw).writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", out + "-ckpt").trigger(**(trigger or {"availableNow": True})).start())


def _replayed(streams, scratch, batches, schema=SESSION_EVENT, **kw):
    """Output of the stream over ``batches`` of rows, one micro-batch each."""
    src, out = scratch("events"), scratch("replay")
    for rows in batches:
        streams.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        assert _stream(streams, src, out, schema, **kw).awaitTermination(300)
    return streams.read.parquet(out)


def _as_dict(df):
    rows = df.collect()
    out = {r.session_id: (r.system_prompt, bool(r.closed), [(m.role, m.content) for m in r.messages]) for r in rows}
    assert len(out) == len(rows)
    return out


def _shuffled(events, n, seed):
    rows = sorted((tuple(r) for r in events), key=repr)
    random.Random(seed).shuffle(rows)
    return [rows[k::n] for k in range(n)]


def test_stream_equals_batch_in_any_order(spark, streams, scratch):
    events = fx.session_events(spark, SF_SMALL)
    out = _replayed(streams, scratch, _shuffled(events.collect(), 3, 1))
    want = _as_dict(sessions.replay_sessions(events))
    assert _as_dict(final_sessions(out)) == want
    assert _as_dict(live_sessions(out)) == want


@pytest.mark.parametrize("seed", [2, 3])
def test_stream_with_loads_equals_batch_in_any_order(spark, streams, scratch, seed):
    saved = ts._saved(spark)
    events = spark.createDataFrame(ts.EVENTS, SESSION_EVENT)
    out = _replayed(streams, scratch, _shuffled(ts.EVENTS, 3, seed), saved=saved, default_system="be kind")
    want = _as_dict(sessions.replay_sessions(events, "be kind", saved))
    assert _as_dict(final_sessions(out, "be kind")) == want
    assert _as_dict(live_sessions(out, "be kind")) == want


# Late quit, clear and prompt, repeated rows, ties, a session of blanks, null ids and seqs.
LATE = [
    [("a", 5, "user", "five"), ("a", 6, "assistant", "six"), ("a", 9, "user", "/clear"), (None, 2, "user", "n2"), ("b", 1, "user", "  ")],
    [("a", 3, "user", "three"), ("a", 7, "user", "/quit"), ("a", 4, "user", "/system old"), (None, 1, "user", "n1"), (None, None, "user", "nowhere")],
    [("a", 6, "assistant", "six"), ("a", 1, "user", "/system older"), ("c", 1, "user", "x"), ("c", 1, "user", "/quit"), (None, 1, "user", "/clear"), (None, None, "user", "/clear")],
]


def test_late_repeated_and_null_events_with_string_ids(spark, streams, scratch):
    out = _replayed(streams, scratch, LATE, STRING_EVENT)
    want = _as_dict(sessions.replay_sessions(spark.createDataFrame([r for b in LATE for r in b], STRING_EVENT)))
    assert want["a"] == ("old", True, [("user", "three"), ("user", "five"), ("assistant", "six"), ("assistant", "six")])
    assert want["b"] == (None, False, []) and want[None] == (None, False, [("user", "n2")]) and want["c"][1:] == (True, [])
    assert _as_dict(final_sessions(out)) == want
    assert _as_dict(live_sessions(out)) == want


@pytest.mark.parametrize("how", [{"idle_timeout_ms": 1}, {"idle_timeout_ms": 3_600_000}, {"state_ttl_ms": 1}])
def test_timeouts_lose_nothing(spark, streams, scratch, how):
    first = [(1, 1, "user", "/system one"), (1, 2, "user", "a"), (1, 4, "user", "/clear"), (2, 1, "user", "b"), (3, 4, "user", "/quit")]
    later = [(1, 5, "user", "c"), (1, 6, "user", "/system two"), (2, 2, "user", "/quit"), (2, 3, "user", "d"), (3, 2, "user", "e"), (3, 5, "user", "/clear")]
    src, out = scratch("idle-events"), scratch("idle-replay")
    streams.createDataFrame(first, SESSION_EVENT).coalesce(1).write.parquet(src)
    query = _stream(streams, src, out, trigger={"processingTime": "100 milliseconds"}, **how)
    try:
        def settled(rows):
            deadline = time.time() + 120
            while time.time() < deadline:
                seen = [p for p in query.recentProgress if p["numInputRows"]]
                if len(seen) >= rows and query.lastProgress["batchId"] > seen[-1]["batchId"] + 1:
                    return
                time.sleep(0.2)
            raise AssertionError("stream did not settle")

        settled(1)
        streams.createDataFrame(later, SESSION_EVENT).coalesce(1).write.mode("append").parquet(src)
        settled(2)
    finally:
        query.stop()
    rows = streams.read.parquet(out)
    want = _as_dict(sessions.replay_sessions(spark.createDataFrame(first + later, SESSION_EVENT)))
    assert _as_dict(final_sessions(rows)) == want
    if "state_ttl_ms" not in how:
        assert _as_dict(live_sessions(rows)) == want


def test_settled_summary_goes_on_like_the_whole_log():
    rng = random.Random(5)
    kinds = ["clear", "system", "load", "system"]
    for _ in range(300):
        log = [(s, rng.choice(kinds), f"arg{s}", f"sys{s}", [("user", str(s))]) for s in sorted(rng.sample(range(30), 8))]
        if rng.random() < 0.5:
            log.append((30 + rng.randrange(3), "quit", "", None, []))
        cut = rng.randrange(len(log) + 1)
        assert settle(settle(None, log[:cut]), log[cut:]) == settle(None, log)


def test_state_holds_control_events_only(streams, scratch):
    """Messages do not go through the stateful operator."""
    out = _replayed(streams, scratch, [[(k, s, "user", "hello") for k in range(5) for s in range(4)]])
    assert out.filter("kind = 'state'").count() == 0 and out.filter("kind = 'message'").count() == 20
    assert out.schema["session_id"].dataType == T.LongType()


def test_provider_is_asked_for(spark, scratch):
    src = scratch("none")
    spark.createDataFrame([], SESSION_EVENT).write.parquet(src)
    with pytest.raises(ValueError, match="stateStore"):
        replay_sessions_stream(spark.readStream.schema(SESSION_EVENT).parquet(src))


def test_prompt_stream_maps_messages(spark, scratch):
    src = scratch("pstream")
    fx.conversation_messages(spark, SF_SMALL).write.json(src)
    schema = "conv_id BIGINT, messages ARRAY<STRUCT<role: STRING, content: STRING>>"
    stream = read_prompts_stream(spark, src, schema, "json", dataset_format="messages")
    q = stream.writeStream.format("memory").queryName("prompt_stream_out").trigger(availableNow=True).start()
    q.awaitTermination(600)
    got = spark.table("prompt_stream_out")
    assert got.count() == fx.conversation_messages(spark, SF_SMALL).count()
    assert "prompt" in got.columns
