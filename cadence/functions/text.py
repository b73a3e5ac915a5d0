"""String helpers with SQL semantics (NULL handling spelled out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_strict(*parts) -> Column:
    """Concatenation that is NULL when any part is NULL; numbers are cast to text."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def left_chars(c, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_col(c), 1, n)


def blank_if_null(c) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def regex_contains(c, pattern: str) -> Column:
    """True where the regular expression matches anywhere in the value."""
    return _col(c).rlike(pattern)


def literal_contains(c, text: str) -> Column:
    """True where ``text`` occurs literally (a predicate that the scan can take)."""
    return _col(c).contains(text)
