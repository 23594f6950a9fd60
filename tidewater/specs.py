"""Table-specification registry: the single contract every layer reads.

A ``TableSpec`` names a change-logged source table: its business columns and
types, its key, how changes are ordered, which rows are deletes, and its
row-quality rules. Ingest (declared read schema), change apply (keys, order,
delete predicate), quality rules and the layout of written tables all come from
here, so adding a table is a registry entry, not new code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from .sources.buckets import Layout

# --- fixed values: change-metadata columns carried by every landed row -------
OPER_COL = "header__change_oper"  # 'I' | 'U' | 'D'
SEQ_COL = "header__change_seq"  # BIGINT, orders changes per key
TS_COL = "header__change_ts"  # TIMESTAMP, wall clock of the change
CHANGE_COLUMNS = [(OPER_COL, "STRING"), (SEQ_COL, "BIGINT"), (TS_COL, "TIMESTAMP")]
DELETE_PREDICATE = f"{OPER_COL} = 'D'"
# Provenance columns added by ingest; dropped together with the change columns
# when a change log is resolved to current state.
INGESTED_AT_COL = "_ingested_at"
SOURCE_FILE_COL = "_source_file"
RESCUE_COL = "_rescued_data"
INGEST_COLUMNS = [INGESTED_AT_COL, SOURCE_FILE_COL, RESCUE_COL]
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named row-quality rule: a SQL predicate that a good row satisfies.

    ``action`` is ``warn`` (keep the row, count failures) or ``drop`` (remove
    the row, count it, keep it aside as a reject). A NULL predicate result is a
    failure. ``applies_to_deletes`` decides whether key-only delete rows, whose
    payload is NULL by construction, are checked.
    """

    name: str
    predicate: str
    action: str = "warn"
    applies_to_deletes: bool = False

    def __post_init__(self):
        if self.action not in ("warn", "drop"):
            raise ValueError(f"rule {self.name}: action must be warn or drop, got {self.action}")


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    category: str = "transactional"
    cluster_by: tuple[str, ...] = ()
    scd_type: int = 1
    sequence_by: tuple[str, ...] = (SEQ_COL,)
    delete_predicate: str | None = DELETE_PREDICATE
    rules: tuple[Rule, ...] = field(default_factory=tuple)
    layout: Layout = Layout()  # buckets of the stored table; see sources.buckets.layout_for
    watch: tuple[str, ...] = ()  # columns whose heavy hitters are kept with each batch

    @property
    def business_columns(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def all_columns(self) -> list[str]:
        return self.business_columns + [c for c, _ in CHANGE_COLUMNS]

    @property
    def layout_columns(self) -> tuple[str, ...]:
        return self.cluster_by or self.keys

    def business_ddl(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns)

    def change_ddl(self) -> str:
        """Declared read schema of a landed change file: business + change columns."""
        return ", ".join(f"{c} {t}" for c, t in list(self.columns) + CHANGE_COLUMNS)

    def change_schema(self) -> StructType:
        return StructType.fromDDL(self.change_ddl())

    def business_schema(self) -> StructType:
        return StructType.fromDDL(self.business_ddl())

    def warn_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.action == "warn"]

    def drop_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.action == "drop"]


def _key_rule(spec_key: str) -> Rule:
    return Rule(f"valid_{spec_key}", f"{spec_key} IS NOT NULL", "drop", applies_to_deletes=True)


# --- fixed values: the claims data model (names, types, keys, rules) ---------
CLAIMS = {
    "claim": TableSpec(
        name="claim",
        keys=("claim_id",),
        cluster_by=("claim_id",),
        columns=(
            ("claim_id", "STRING"),
            ("member_id", "STRING"),
            ("provider_id", "STRING"),
            ("payer_id", "STRING"),
            ("claim_status", "STRING"),
            ("claim_type", "STRING"),
            ("total_charge_amount", "DECIMAL(12,2)"),
            ("total_paid_amount", "DECIMAL(12,2)"),
            ("service_from_date", "DATE"),
            ("service_to_date", "DATE"),
            ("submitted_date", "TIMESTAMP"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(
            Rule("valid_charge", "total_charge_amount >= 0", "warn"),
            _key_rule("claim_id"),
        ),
    ),
    "claim_detail": TableSpec(
        name="claim_detail",
        keys=("claim_detail_id",),
        watch=("provider_id",),
        cluster_by=("claim_id",),
        columns=(
            ("claim_detail_id", "STRING"),
            ("claim_id", "STRING"),
            ("line_number", "INT"),
            ("procedure_code", "STRING"),
            ("revenue_code", "STRING"),
            ("place_of_service", "STRING"),
            ("provider_id", "STRING"),
            ("units", "INT"),
            ("charge_amount", "DECIMAL(12,2)"),
            ("allowed_amount", "DECIMAL(12,2)"),
            ("paid_amount", "DECIMAL(12,2)"),
            ("adjustment_amount", "DECIMAL(12,2)"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(
            Rule("valid_paid", "paid_amount >= 0", "warn"),
            _key_rule("claim_detail_id"),
        ),
    ),
    "claim_attribute": TableSpec(
        name="claim_attribute",
        keys=("claim_attribute_id",),
        cluster_by=("claim_id",),
        columns=(
            ("claim_attribute_id", "STRING"),
            ("claim_id", "STRING"),
            ("attribute_group", "STRING"),
            ("attribute_name", "STRING"),
            ("attribute_value", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("claim_attribute_id"),),
    ),
    "claim_audit": TableSpec(
        name="claim_audit",
        keys=("claim_audit_id",),
        cluster_by=("claim_id",),
        columns=(
            ("claim_audit_id", "STRING"),
            ("claim_id", "STRING"),
            ("event_type", "STRING"),
            ("event_status", "STRING"),
            ("event_user", "STRING"),
            ("event_timestamp", "TIMESTAMP"),
            ("note", "STRING"),
        ),
        rules=(_key_rule("claim_audit_id"),),
    ),
    "claim_payment": TableSpec(
        name="claim_payment",
        keys=("payment_id",),
        cluster_by=("claim_id",),
        columns=(
            ("payment_id", "STRING"),
            ("claim_id", "STRING"),
            ("payer_id", "STRING"),
            ("payment_method", "STRING"),
            ("payment_amount", "DECIMAL(12,2)"),
            ("payment_date", "DATE"),
            ("check_number", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("payment_id"),),
    ),
    "claim_diagnosis": TableSpec(
        name="claim_diagnosis",
        keys=("claim_diagnosis_id",),
        cluster_by=("claim_id",),
        columns=(
            ("claim_diagnosis_id", "STRING"),
            ("claim_id", "STRING"),
            ("diagnosis_seq", "INT"),
            ("diagnosis_code", "STRING"),
            ("diagnosis_type", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("claim_diagnosis_id"),),
    ),
    "provider": TableSpec(
        name="provider",
        keys=("provider_id",),
        category="dimension",
        cluster_by=("provider_id",),
        columns=(
            ("provider_id", "STRING"),
            ("npi", "STRING"),
            ("provider_name", "STRING"),
            ("specialty", "STRING"),
            ("network_status", "STRING"),
            ("state", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("provider_id"),),
    ),
    "member": TableSpec(
        name="member",
        keys=("member_id",),
        category="dimension",
        cluster_by=("member_id",),
        columns=(
            ("member_id", "STRING"),
            ("member_name", "STRING"),
            ("date_of_birth", "DATE"),
            ("gender", "STRING"),
            ("plan_id", "STRING"),
            ("enrollment_status", "STRING"),
            ("state", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("member_id"),),
    ),
    "payer": TableSpec(
        name="payer",
        keys=("payer_id",),
        category="dimension",
        cluster_by=("payer_id",),
        columns=(
            ("payer_id", "STRING"),
            ("payer_name", "STRING"),
            ("payer_type", "STRING"),
            ("state", "STRING"),
            ("last_updated", "TIMESTAMP"),
        ),
        rules=(_key_rule("payer_id"),),
    ),
}
# -----------------------------------------------------------------------------


def spec(name: str, registry: dict[str, TableSpec] | None = None) -> TableSpec:
    reg = CLAIMS if registry is None else registry
    try:
        return reg[name]
    except KeyError:
        raise KeyError(f"unknown table {name!r}; registered: {sorted(reg)}") from None
