"""Column expressions (scalar functions FN-*) shared by the layer rules."""

from lakestrata.functions.clean import (  # noqa: F401
    clean_code,
    clean_id,
    clean_text,
    to_double,
    to_int,
    to_ts,
)
from lakestrata.functions.hashing import checksum_agg, fold_int64, row_hash  # noqa: F401
