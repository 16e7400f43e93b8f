"""Expressions over message lists, ``ARRAY<STRUCT<role, content>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def message(role: Column | str, content: Column) -> Column:
    role_c = F.lit(role) if isinstance(role, str) else role
    return F.struct(role_c.cast("string").alias("role"), content.cast("string").alias("content"))


def user_messages(messages: Column) -> Column:
    """Messages whose role is ``user``; a missing role is not a user."""
    return F.filter(messages, lambda m: F.coalesce(m["role"] == "user", F.lit(False)))


def all_but_last(messages: Column) -> Column:
    """``messages[:-1]``; the empty list stays empty."""
    return F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0)))


def first_user_content(messages: Column, turn: str = "first") -> Column:
    """Content of the first (or last) user message, null when there is none."""
    users = user_messages(messages)
    if turn == "first":
        return F.get(users, 0)["content"]
    if turn == "last":
        return F.get(users, F.size(users) - 1)["content"]
    raise ValueError("turn must be 'first' or 'last'")


# ChatML markers, the only chat template written out in the
# reference (the judge's prompt prefix and suffix).
CHATML_START = "<|im_start|>"
CHATML_END = "<|im_end|>"


def render_messages(
    messages: Column,
    add_generation_prompt: bool = True,
    start: str = CHATML_START,
    end: str = CHATML_END,
    generation_role: str = "assistant",
) -> Column:
    """Flatten a message list to prompt text: ``start role\\n content end\\n`` each."""
    body = F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit(start),
                F.coalesce(m["role"], F.lit("")),
                F.lit("\n"),
                F.coalesce(m["content"], F.lit("")),
                F.lit(end + "\n"),
            ),
        ),
        "",
    )
    if add_generation_prompt:
        body = F.concat(body, F.lit(f"{start}{generation_role}\n"))
    return body
