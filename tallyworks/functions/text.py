"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def root_code(area: Column, department: Column) -> Column:
    """First part of a dotted area code, or of the department code when there is no area."""
    return F.substring_index(F.coalesce(area, department), ".", 1)


def without_quotes(text: Column) -> Column:
    return F.replace(text, F.lit("'"), F.lit(""))


def escaped(text: Column) -> Column:
    """Text in which a bare ``|`` can only be a separator."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("|"), F.lit("\\p"))


def fingerprint(columns: Sequence[Column], null_tag: str = "~") -> Column:
    """MD5 over all columns. A value is written as ``=`` and its text, a NULL as ``null_tag``,
    and separators inside values are escaped: different rows give different input text, also
    when a NULL moves from one column to the next."""
    parts = [
        F.coalesce(F.concat(F.lit("="), escaped(c.cast("string"))), F.lit(null_tag))
        for c in columns
    ]
    return F.md5(F.concat_ws("|", *parts))
