"""Row hashing for the order-independent content checksum (DQ-10).

``xxhash64`` (seed 42) skips NULL arguments, so ``('a', NULL)`` and ``(NULL, 'a')`` hash alike. The
default form therefore hashes ``(col, isnull(col))`` pairs; ``compat=True`` hashes the plain columns.
The per-row hashes are summed as ``decimal(38,0)`` (no overflow, ANSI or not) and folded back to the
two's-complement ``bigint`` a wrapping 64-bit sum would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TWO_63 = 2**63
_TWO_64 = 2**64


def row_hash(cols: Sequence[str | Column], compat: bool = False) -> Column:
    """Per-row ``xxhash64`` of the given columns (names or expressions)."""
    exprs = [F.col(c) if isinstance(c, str) else c for c in cols]
    if compat:
        args = exprs
    else:
        args = [a for e in exprs for a in (e, F.isnull(e))]
    return F.xxhash64(*args)


def checksum_agg(cols: Sequence[str | Column], compat: bool = False) -> Column:
    """Aggregate expression: the folded 64-bit sum of the row hashes (NULL for no rows)."""
    return fold_int64(F.sum(row_hash(cols, compat).cast("decimal(38,0)")))


def fold_int64(dec_sum: Column) -> Column:
    """``((s + 2^63) mod 2^64) - 2^63`` on an exact decimal sum, as ``bigint``."""
    two63 = F.lit(Decimal(_TWO_63)).cast("decimal(38,0)")
    shifted = dec_sum + two63
    folded = F.pmod(shifted, F.lit(Decimal(_TWO_64)).cast("decimal(38,0)")) - two63
    return folded.cast("bigint")


def portable_checksum(df: DataFrame, columns: Sequence[str]) -> Column:
    """Order-independent checksum that any SQL engine can compute: the sum, modulo 2^63 - 1, of the first 60
    bits of each row's md5 over its columns as text (cents, seconds; ``~`` for NULL). NULL without rows."""
    def text(name: str) -> Column:
        kind = df.schema[name].dataType.simpleString()
        c = F.col(name)
        as_text = {"double": c.cast("decimal(18,2)").cast("string"), "timestamp_ntz": F.date_format(c, "yyyy-MM-dd HH:mm:ss")}.get(kind, c.cast("string"))
        return F.coalesce(as_text, F.lit("~"))

    row = F.md5(F.concat_ws("|", *map(text, columns)))
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return F.pmod(F.sum(number), F.lit(Decimal(_TWO_63 - 1)).cast("decimal(38,0)")).cast("bigint")
