"""Cleaning expressions used by every Silver rule.

All casts are ``try_cast`` so the result never depends on the session's ANSI flag: unparsable text
becomes NULL with ANSI on and off alike. Timestamps are ``timestamp_ntz`` so ``to_date`` and
``datediff`` ignore the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: str | Column) -> Column:
    """ids, codes and zip prefixes: strip surrounding spaces (tabs are kept), keep leading zeros."""
    return F.trim(_c(c))


def clean_text(c: str | Column) -> Column:
    """free categories and cities: ``lower(trim())``; Unicode aware, accents kept."""
    return F.lower(F.trim(_c(c)))


def clean_code(c: str | Column) -> Column:
    """state codes: ``upper(trim())``."""
    return F.upper(F.trim(_c(c)))


def to_int(c: str | Column) -> Column:
    return _c(c).try_cast("int")


def to_double(c: str | Column) -> Column:
    return _c(c).try_cast("double")


def to_ts(c: str | Column) -> Column:
    """text → ``timestamp_ntz`` with Spark's default pattern; bad text and NULL give NULL."""
    return _c(c).try_cast("timestamp_ntz")
