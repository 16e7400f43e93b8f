"""Shared Spark types for chat and preference rows."""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType(), True),
        T.StructField("content", T.StringType(), True),
    ]
)
MESSAGES = T.ArrayType(MESSAGE, True)

SESSION = T.StructType(
    [
        T.StructField("system_prompt", T.StringType(), True),
        T.StructField("messages", MESSAGES, True),
    ]
)

SESSION_EVENT = T.StructType(
    [
        T.StructField("session_id", T.LongType(), True),
        T.StructField("seq", T.LongType(), True),
        T.StructField("role", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

SESSION_EVENT_TS = T.StructType(SESSION_EVENT.fields + [T.StructField("ts", T.TimestampType(), True)])
