"""String expressions that follow Python's str semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, i.e. what
# str.strip() and str.split() treat as whitespace. Written as a regex class that
# Java (Spark) and RE2 (DuckDB) read the same way.
PY_SPACE = (
    r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
PY_NONSPACE = PY_SPACE.replace("[", "[^", 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """``str.strip()``: drop leading and trailing Python whitespace."""
    return F.regexp_replace(_col(c), rf"^{PY_SPACE}+|{PY_SPACE}+\z", "")


def is_blank(c: Column | str) -> Column:
    """``not s.strip()`` for a non-null string."""
    return _col(c).rlike(rf"^{PY_SPACE}*\z")


def truthy(c: Column | str) -> Column:
    """Python truthiness of an optional string: not null and not empty."""
    c = _col(c)
    return c.isNotNull() & (F.length(c) > 0)
