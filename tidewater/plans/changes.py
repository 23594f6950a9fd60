"""Change-batch job: derive landed change files from keyed tables.

Given a keyed parent table (claim headers) and its child lines, build one run's
change rows for every registry table: the share of keys that are new, changed
in the header only, adjusted, or reversed follows a ``ChangeMix``; which key
gets which change is a deterministic bucket of the key, so the four sets are
disjoint by construction and identical on every re-evaluation (no sampling, no
``limit``). Sequence numbers are ``run * step + ordinal(key)``: unique per row
within a run, below the next run's base (``check_key_range``), and independent
of partitioning.

Everything is a projection or a union of projections of the inputs: no shuffle
is needed to produce a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import typed_nulls
from ..specs import OPER_COL, SEQ_COL, TS_COL, TableSpec

CHANGE_TYPES = ("new", "header_only", "adjustment", "reversal")

# --- fixed values: claim status written by each change type ------------------
STATUS = {
    "seed": "PAID",
    "new": "SUBMITTED",
    "header_only": "DENIED",
    "adjustment": "ADJUSTED",
    "reversal": "REVERSED",
}
# Which tables a change type touches, and with which operation.
TOUCHES = {
    "new": {"claim": "I", "claim_detail": "I", "claim_attribute": "I", "claim_diagnosis": "I", "claim_audit": "I"},
    "header_only": {"claim": "U", "claim_audit": "I"},
    "adjustment": {"claim": "U", "claim_detail": "U", "claim_payment": "U", "claim_audit": "I"},
    "reversal": {"claim": "U", "claim_detail": "D", "claim_payment": "U", "claim_audit": "I"},
}
AUDIT_EVENT = {"seed": "SUBMIT", "new": "SUBMIT", "header_only": "DENY", "adjustment": "ADJUST", "reversal": "REVERSE"}
SEQ_STEP = 10**15  # sequence block per run: keys up to 10**13
SEQ_PER_KEY = 100  # sequence numbers a key may use in a run
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ChangeMix:
    """Shares of changed keys per change type; must sum to 1."""

    new: float = 0.20
    header_only: float = 0.30
    adjustment: float = 0.35
    reversal: float = 0.15

    def __post_init__(self):
        shares = self.shares()
        if any(s < 0 for s in shares.values()):
            raise ValueError(f"negative share in {shares}")
        if abs(sum(shares.values()) - 1.0) > 1e-9:
            raise ValueError(f"change mix must sum to 1, got {sum(shares.values())}")

    def shares(self) -> dict[str, float]:
        return {t: getattr(self, t) for t in CHANGE_TYPES}

    def bucket_bounds(self, n_buckets: int, touched: float = 1.0) -> list[tuple[str, int, int]]:
        """``[(type, lo, hi)]``: buckets ``lo <= b < hi`` get ``type``.

        ``touched`` is the share of all keys changed by the run; the remaining
        buckets are untouched. Each share must be a whole number of buckets, so
        counts are exact.
        """
        if not 0 <= touched <= 1:
            raise ValueError(f"touched share must be in [0, 1], got {touched}")
        out, lo = [], 0
        for t, s in self.shares().items():
            width = s * touched * n_buckets
            if abs(width - round(width)) > 1e-9:
                raise ValueError(f"share {t}={s} is not a multiple of 1/{n_buckets}; use more buckets")
            hi = lo + int(round(width))
            out.append((t, lo, hi))
            lo = hi
        return out

    def counts(self, n: int) -> dict[str, int]:
        return {t: int(n * s) for t, s in self.shares().items()}


def change_type(bucket: Column, mix: ChangeMix, n_buckets: int, touched: float = 1.0) -> Column:
    """Map a key bucket in ``[0, n_buckets)`` to its change type (NULL: untouched)."""
    expr = None
    for t, lo, hi in mix.bucket_bounds(n_buckets, touched):
        if hi <= lo:
            continue
        cond = (bucket >= lo) & (bucket < hi)
        expr = F.when(cond, F.lit(t)) if expr is None else expr.when(cond, F.lit(t))
    return expr.otherwise(F.lit(None).cast("string")) if expr is not None else F.lit(None).cast("string")


def stamp(df: DataFrame, oper: str | Column, seq: Column, ts: Column) -> DataFrame:
    """Attach change metadata (oper, seq, ts)."""
    o = F.lit(oper) if isinstance(oper, str) else oper
    return df.withColumn(OPER_COL, o).withColumn(SEQ_COL, seq.cast("bigint")).withColumn(TS_COL, ts.cast("timestamp"))


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select and cast to the registry's declared columns (missing ones typed NULL)."""
    declared = list(spec.columns) + [(OPER_COL, "STRING"), (SEQ_COL, "BIGINT"), (TS_COL, "TIMESTAMP")]
    missing = [(c, t) for c, t in declared if c not in df.columns]
    nulls = {c: null for (c, _), null in zip(missing, typed_nulls(missing))}
    return df.select(*[nulls[c] if c in nulls else F.col(c).cast(t).alias(c) for c, t in declared])


def check_key_range(largest_key: int) -> None:
    """Raise unless the keys of a run fit into its block of sequence numbers."""
    if (largest_key + 1) * SEQ_PER_KEY > SEQ_STEP:
        raise ValueError(f"key {largest_key} needs sequence numbers beyond a run's block of {SEQ_STEP}")
