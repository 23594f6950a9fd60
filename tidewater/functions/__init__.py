"""Column-expression helpers (all Catalyst expressions, no UDFs)."""

from .columns import (  # noqa: F401
    col_of,
    hot_assign,
    key_bucket,
    oper_rank,
    pad,
    padded_id,
    rate,
    safe_divide,
    typed_nulls,
)
