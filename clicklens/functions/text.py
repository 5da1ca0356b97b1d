"""Text helpers built from Spark's native string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicklens.constants import WHITESPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove leading and trailing white space, as Python's ``str.strip()``.

    Uses ``trim(str, chars)``, which stays inside whole-stage codegen.
    """
    return F.trim(_col(c), F.lit(WHITESPACE))


def has_text(c: Column | str) -> Column:
    """True when the value is not NULL and not only white space; never NULL."""
    return F.coalesce(strip_ws(c) != F.lit(""), F.lit(False))


def ws_regex_class() -> str:
    """The white-space set as a Java/RE2 character class of ranges, e.g.
    ``[\\x{9}-\\x{d}...]``. Ranges keep the class short: Java tests a class
    outside Latin-1 member by member."""
    points = sorted(ord(ch) for ch in WHITESPACE)
    runs: list[list[int]] = []
    for p in points:
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    parts = [f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs]
    return "[" + "".join(parts) + "]"
