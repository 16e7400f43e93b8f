"""Column expressions (no shuffles, no Python): building blocks of the operators."""

from prefspark.functions.chat import (
    all_but_last,
    first_user_content,
    message,
    render_messages,
    user_messages,
)
from prefspark.functions.scoring import softplus, yes_probability
from prefspark.functions.text import PY_SPACE, is_blank, py_strip, truthy

__all__ = [
    "PY_SPACE",
    "all_but_last",
    "first_user_content",
    "is_blank",
    "message",
    "py_strip",
    "render_messages",
    "softplus",
    "truthy",
    "user_messages",
    "yes_probability",
]
