"""Structured Streaming operators."""

from prefspark.streaming.prompts import read_prompts_stream
from prefspark.streaming.sessions import final_sessions, live_sessions, replay_sessions_stream

__all__ = ["final_sessions", "live_sessions", "read_prompts_stream", "replay_sessions_stream"]
