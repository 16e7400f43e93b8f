"""Bring prompt, message-list and instruction rows to one ``prompt`` column.

All steps are column expressions on each row: no shuffle, no Python worker.
Other columns are kept; Catalyst prunes the ones a later step does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefspark.functions.chat import all_but_last, message, user_messages
from prefspark.functions.text import truthy
from prefspark.types import MESSAGES

FORMATS = ("prompt", "messages", "instruction")


def rename_prompt(df: DataFrame, col: str = "prompt") -> DataFrame:
    """Rename ``col`` to ``prompt``; a missing column passes through unchanged."""
    if col == "prompt" or col not in df.columns:
        return df
    if "prompt" in df.columns:
        raise ValueError(f"cannot rename {col!r}: a 'prompt' column already exists")
    return df.withColumnRenamed(col, "prompt")


def decode_messages(df: DataFrame, col: str = "messages", strict: bool = True) -> DataFrame:
    """Decode a JSON-string messages column; arrays pass through.

    ``strict`` fails the job on malformed JSON (as ``json.loads`` raises);
    otherwise a malformed value becomes null.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.ArrayType):
        return df
    if not isinstance(dtype, T.StringType):
        raise TypeError(f"{col!r} must be a string or an array of messages, not {dtype.simpleString()}")
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return df.withColumn(col, F.from_json(F.col(col), MESSAGES, {"mode": mode}))


def messages_prompt(messages: Column, strict: bool = True, what: str = "messages") -> Column:
    """User messages in order; with none, all but the last; empty stays empty."""
    users = user_messages(messages)
    picked = F.when(F.size(users) > 0, users).otherwise(all_but_last(messages))
    if strict:
        return F.when(messages.isNull(), F.raise_error(F.lit(f"null {what} value"))).otherwise(picked)
    return F.coalesce(picked, F.array().cast(MESSAGES))


def messages_to_prompt(
    df: DataFrame, col: str = "messages", out: str = "prompt", strict: bool = True
) -> DataFrame:
    df = decode_messages(df, col, strict=strict)
    return df.withColumn(out, messages_prompt(F.col(col), strict=strict, what=col))


def instruction_to_prompt(
    df: DataFrame,
    instruction: str = "instruction",
    input: str = "input",
    out: str = "prompt",
    strict: bool = True,
) -> DataFrame:
    """One user message: ``instruction + "\\n\\n" + input`` when input is non-empty.

    An absent input column counts as ``""``; a whitespace-only input is kept
    (it is truthy in Python).
    """
    instr = F.col(instruction).cast("string")
    if strict:
        instr = F.when(instr.isNull(), F.raise_error(F.lit(f"null {instruction} value"))).otherwise(instr)
    else:
        instr = F.coalesce(instr, F.lit(""))
    inp = F.col(input).cast("string") if input in df.columns else F.lit(None).cast("string")
    content = F.when(truthy(inp), F.concat(instr, F.lit("\n\n"), inp)).otherwise(instr)
    return df.withColumn(out, F.array(message("user", content)))


def prepare_prompts(
    df: DataFrame,
    format: str = "prompt",
    prompt_column: str = "prompt",
    messages_column: str = "messages",
    instruction_column: str = "instruction",
    input_column: str = "input",
    strict: bool = True,
) -> DataFrame:
    """Dispatch on the dataset format; builds a lazy plan only."""
    if format == "prompt":
        return rename_prompt(df, prompt_column)
    if format == "messages":
        return messages_to_prompt(df, messages_column, strict=strict)
    if format == "instruction":
        return instruction_to_prompt(df, instruction_column, input_column, strict=strict)
    raise ValueError(f"format must be one of {FORMATS}, not {format!r}")
