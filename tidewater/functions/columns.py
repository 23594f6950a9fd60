"""Column-expression helpers. Every helper returns a Catalyst ``Column``: no UDFs.

These are the scalar building blocks the layers share: guarded division,
typed NULL columns, deterministic key buckets (in place of seeded ``rand``),
hot-key assignment, zero-padded ids and the change-operation rank used in
tie-breaks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import OPER_COL


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """``num / den`` with a zero divisor giving NULL instead of an error."""
    d = col_of(den)
    return col_of(num) / F.when(d == 0, F.lit(None)).otherwise(d)


def typed_nulls(columns: Sequence[tuple[str, str]]) -> list[Column]:
    """``NULL AS c`` cast to each declared type (key-only delete rows)."""
    return [F.lit(None).cast(t).alias(c) for c, t in columns]


def pad(num: str | Column, width: int) -> Column:
    """Decimal text of a non-negative integer, zero-padded to ``width`` (never cut).

    Same text as ``format_string('%0<width>d')`` for non-negative numbers, but a
    plain string expression (code-generated), several times cheaper per row.
    """
    s = col_of(num).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def padded_id(prefix: str, num: str | Column, width: int, *parts: tuple[str | Column, int]) -> Column:
    """``prefix`` + padded number [+ '-' + padded part ...]; width 0 means unpadded."""
    pieces = [F.lit(prefix), pad(num, width) if width else col_of(num).cast("string")]
    for c, w in parts:
        pieces += [F.lit("-"), pad(c, w) if w else col_of(c).cast("string")]
    return F.concat(*pieces)


def key_bucket(key: str | Column, n: int, salt: int = 0) -> Column:
    """Deterministic bucket in ``[0, n)`` from a key: ``pmod(xxhash64(salt, key), n)``.

    Same key, same salt, same bucket on every run and executor, unlike
    ``rand(seed)`` whose value depends on partition and row position.
    """
    return F.pmod(F.xxhash64(F.lit(salt), col_of(key)), F.lit(n))


def draw(domain: Sequence[str], key: str | Column, salt: int = 0) -> Column:
    """A value of ``domain`` for each integer key: spread evenly, the same on every run, independent draws by ``salt``.

    Multiplicative hashing in plain integer arithmetic, within 64 bits for any key,
    so that another engine can repeat it.
    """
    spread = F.pmod(col_of(key).cast("bigint") + F.lit(salt), F.lit(1_000_003)) * F.lit(2_654_435_761)
    place = F.pmod(F.floor(F.shiftright(spread, 16)), F.lit(len(domain))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in domain]), place + 1)


def hot_assign(bucket: Column, hot_buckets: int, hot_value: Column, other: Column) -> Column:
    """Send rows whose deterministic ``bucket`` is below ``hot_buckets`` to one value.

    With buckets ``0..99`` and ``hot_buckets=80``, 80% of keys land on the hot
    value, every run and every executor alike.
    """
    if hot_buckets <= 0:
        return other
    return F.when(bucket < F.lit(hot_buckets), hot_value).otherwise(other)


def oper_rank(oper: str | Column = OPER_COL) -> Column:
    """Tie-break rank of a change operation: D over U over I (unknown lowest)."""
    o = col_of(oper)
    return F.when(o == "D", 3).when(o == "U", 2).when(o == "I", 1).otherwise(0)


def rate(flag: Column, denominator: Column, scale: int = 4) -> Column:
    """Rounded share of rows where ``flag`` holds: sum(flag)/denominator."""
    return F.round(F.sum(F.when(flag, 1).otherwise(0)) / denominator, scale)
