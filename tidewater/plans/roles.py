"""Role map: the driver's TPC-H-style tables as a claims source system.

orders -> claim headers, lineitem -> claim lines, customer -> members,
supplier -> providers, nation/region -> payers, part.p_brand -> diagnosis
codes, plus the generic change logs used to test change application directly:

* ``events_log``: events keyed by ``user_id``, ordered by ``event_id``,
  deleted by an ``error`` event.
* ``line_log``: lineitem keyed by ``(l_orderkey, l_linenumber)`` (not unique),
  ordered by ``l_shipdate`` then ``l_partkey, l_suppkey, l_extendedprice``,
  deleted when returned and final.

The claims world is two runs: a *seed* (every existing claim, all ``I``) and
one *increment* from ``changes.ChangeMix``. Which claim gets which change is the
bucket ``o_orderkey mod n_buckets``; every value is integer or exact-decimal
arithmetic on the inputs, so an SQL engine can rebuild each row and the runs
are identical on every evaluation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import draw, hot_assign, key_bucket, padded_id
from ..operators.cdc import ApplySpec
from ..sources.tables import read_table
from ..specs import CLAIMS
from . import changes as ch

# --- fixed values: change-log definitions over the driver tables -------------
EVENTS_APPLY = ApplySpec(keys=("user_id",), sequence_by=("event_id",), delete_when="event_type = 'error'")
LINE_APPLY = ApplySpec(
    keys=("l_orderkey", "l_linenumber"),
    sequence_by=("l_shipdate",),
    tie_break=("l_partkey", "l_suppkey", "l_extendedprice"),
    delete_when="l_returnflag = 'R' AND l_linestatus = 'F'",
)
# -----------------------------------------------------------------------------


# --- fixed values: domains of drawn attributes --------------------------------
CHANNELS = ("portal", "clearinghouse", "fax", "mail")
REASONS = ("duplicate", "not covered", "out of network", "late", "missing data")
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class RoleMap:
    mix: ch.ChangeMix = field(default_factory=ch.ChangeMix)
    n_buckets: int = 20
    touched: float = 1.0  # share of claims the increment changes
    n_payers: int = 25
    n_providers: int = 100
    hot_share: float = 0.0  # share of the increment's claims on one provider
    hot_provider: int = 1
    # Bucket by xxhash64 of the key instead of the key itself: uniform for any
    # key range and bucket count (the plain modulo is what SQL oracles repeat).
    hashed_buckets: bool = False
    # Later runs of a landing job: new claims get keys from this number on, and the
    # run's sequence numbers start here (default: the run's own block).
    new_key_base: int = 0
    seq_base: int | None = None


SEED, INCREMENT = 0, 1


def claim_key(n: Column) -> Column:
    return padded_id("CLM", n, 12)


def detail_key(n: Column, line: Column) -> Column:
    return padded_id("CLM", n, 12, (line, 2))


def _provider(natural: Column, orderkey: Column, rm: RoleMap, run: int) -> Column:
    """Provider id; in an increment a ``hot_share`` of claims go to one provider."""
    pid = natural
    if run != SEED:
        pid = hot_assign(F.pmod(orderkey, F.lit(100)), int(round(rm.hot_share * 100)), F.lit(rm.hot_provider), natural)
    return padded_id("PRV", pid, 6)


def _ctype(orderkey: Column, rm: RoleMap) -> Column:
    b = key_bucket(orderkey, rm.n_buckets) if rm.hashed_buckets else F.pmod(orderkey, F.lit(rm.n_buckets))
    return ch.change_type(b, rm.mix, rm.n_buckets, rm.touched)


def _status(ctype: Column) -> Column:
    e = None
    for t in ch.CHANGE_TYPES:
        e = F.when(ctype == t, F.lit(ch.STATUS[t])) if e is None else e.when(ctype == t, F.lit(ch.STATUS[t]))
    return e


def _oper(ctype: Column, table: str) -> Column:
    e = None
    for t in ch.CHANGE_TYPES:
        op = ch.TOUCHES[t].get(table)
        if op:
            e = F.when(ctype == t, F.lit(op)) if e is None else e.when(ctype == t, F.lit(op))
    return e


# ---------------------------------------------------------------------------
# claim headers
# ---------------------------------------------------------------------------
def _orders(spark: SparkSession, sf_dir: str, rm: RoleMap) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return _above_mark(o.withColumn("__ctype", _ctype(F.col("o_orderkey"), rm)), "o_orderkey", rm)


def _above_mark(rows: DataFrame, key: str, rm: RoleMap) -> DataFrame:
    if not rm.new_key_base:
        return rows
    return rows.withColumn(key, F.when(F.col("__ctype") == "new", F.col(key) + rm.new_key_base).otherwise(F.col(key)))


def _existing(ctype: Column) -> Column:
    """Claims present before the increment: everything but the new ones."""
    return ~ctype.eqNullSafe(F.lit("new"))


def drawn_attributes(spark: SparkSession, sf_dir: str, rm: RoleMap | None = None) -> DataFrame:
    """(claim_id, channel, reason): attributes that no source column has, drawn from their domains by the claim's key."""
    o = _orders(spark, sf_dir, rm or RoleMap())
    n = F.col("o_orderkey")
    return o.select(claim_key(n).alias("claim_id"), draw(CHANNELS, n).alias("channel"), draw(REASONS, n, salt=17).alias("reason"))


def _claim_rows(o: DataFrame, status: Column, rm: RoleMap, run: int) -> DataFrame:
    n = F.col("o_orderkey")
    charge = F.col("o_totalprice").cast("decimal(12,2)")
    return o.select(
        claim_key(n).alias("claim_id"),
        padded_id("MBR", F.col("o_custkey"), 9).alias("member_id"),
        _provider(F.pmod(n, F.lit(rm.n_providers)) + 1, n, rm, run).alias("provider_id"),
        padded_id("PAY", F.pmod(F.col("o_custkey"), F.lit(rm.n_payers)) + 1, 5).alias("payer_id"),
        status.alias("claim_status"),
        F.col("o_orderpriority").alias("claim_type"),
        charge.alias("total_charge_amount"),
        charge.alias("total_paid_amount"),
        F.to_date("o_orderdate").alias("service_from_date"),
        F.to_date("o_orderdate").alias("service_to_date"),
        F.col("o_orderdate").cast("timestamp").alias("submitted_date"),
        F.col("o_orderdate").cast("timestamp").alias("last_updated"),
        F.col("__ctype"),
        n.alias("__n"),
        F.col("o_orderdate").alias("__ts"),
    )


def _seq(rm: RoleMap, run: int, ordinal: Column) -> Column:
    return F.lit(run * ch.SEQ_STEP if rm.seq_base is None else rm.seq_base) + ordinal


def claim_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    o = _orders(spark, sf_dir, rm)
    spec = CLAIMS["claim"]
    if run == SEED:
        rows = _claim_rows(o.where(_existing(F.col("__ctype"))), F.lit(ch.STATUS["seed"]), rm, run)
        oper = F.lit("I")
    else:
        rows = _claim_rows(o.where(F.col("__ctype").isNotNull()), _status(F.col("__ctype")), rm, run)
        oper = _oper(F.col("__ctype"), "claim")
    stamped = ch.stamp(rows, oper, _seq(rm, run, F.col("__n") * 100), F.col("__ts"))
    return ch.conform(stamped, spec)


# ---------------------------------------------------------------------------
# claim lines
# ---------------------------------------------------------------------------
def _lines(spark: SparkSession, sf_dir: str, rm: RoleMap) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    return _above_mark(li.withColumn("__ctype", _ctype(F.col("l_orderkey"), rm)), "l_orderkey", rm)


def _line_amounts() -> dict[str, Column]:
    ep = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    allowed = F.round(ep * (F.lit(1) - disc), 2).cast("decimal(12,2)")
    paid = F.round(ep * (F.lit(1) - disc) * (F.lit(1) + tax), 2).cast("decimal(12,2)")
    adjustment = (-F.round(ep * disc, 2)).cast("decimal(12,2)")
    return {"charge": ep, "allowed": allowed, "paid": paid, "adjustment": adjustment}


def detail_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    """One run's line changes from a single scan of the lines.

    Seed: every existing line, ``I``. Increment: lines of new claims ``I``,
    of adjusted claims ``U`` (paid becomes the allowed amount), of reversed
    claims ``D`` with every payload column a typed NULL.
    """
    li = _lines(spark, sf_dir, rm)
    ct = F.col("__ctype")
    if run == SEED:
        rows, oper = li.where(_existing(ct)), F.lit("I")
    else:
        rows = li.where(ct.isin("new", "adjustment", "reversal"))
        oper = F.when(ct == "reversal", F.lit("D")).when(ct == "adjustment", F.lit("U")).otherwise(F.lit("I"))
    n, line = F.col("l_orderkey"), F.col("l_linenumber")
    out = rows.select(
        detail_key(n, line).alias("claim_detail_id"),
        claim_key(n).alias("claim_id"),
        *[_line_column(c, rm, run) for c in LINE_PAYLOAD],
        ct.alias("__ctype"),
        (n * 100 + line).alias("__ord"),
        F.col("l_shipdate").alias("__ts"),
    )
    return ch.conform(ch.stamp(out, oper, _seq(rm, run, F.col("__ord")), F.col("__ts")), CLAIMS["claim_detail"])


LINE_PAYLOAD = [c for c in CLAIMS["claim_detail"].business_columns if c not in ("claim_detail_id", "claim_id")]


def _line_column(c: str, rm: RoleMap, run: int) -> Column:
    """Value of line column ``c`` in a run: in an increment NULL on reversal and
    adjusted amounts on adjustment; in the seed the line as it was."""
    a = _line_amounts()
    ct = F.col("__ctype")
    if run == SEED:
        is_del = is_adj = F.lit(False)
    else:
        is_del, is_adj = ct == "reversal", ct == "adjustment"
    n, line = F.col("l_orderkey"), F.col("l_linenumber")
    base = {
        "line_number": line,
        "procedure_code": padded_id("PX", F.col("l_partkey"), 6),
        "revenue_code": F.col("l_returnflag"),
        "place_of_service": F.col("l_linestatus"),
        "provider_id": _provider(F.col("l_suppkey"), n, rm, run),
        "units": F.col("l_quantity").cast("int"),
        "charge_amount": a["charge"],
        "allowed_amount": a["allowed"],
        "paid_amount": F.when(is_adj, a["allowed"]).otherwise(a["paid"]),
        "adjustment_amount": F.when(is_adj, (a["allowed"] - a["paid"]).cast("decimal(12,2)")).otherwise(a["adjustment"]),
        "last_updated": F.col("l_shipdate").cast("timestamp"),
    }[c]
    return F.when(is_del, F.lit(None)).otherwise(base).alias(c)


# ---------------------------------------------------------------------------
# children of the claim: audit, payment, attribute, diagnosis
# ---------------------------------------------------------------------------
def audit_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    o = _orders(spark, sf_dir, rm)
    if run == SEED:
        o = o.where(_existing(F.col("__ctype"))).withColumn("__event", F.lit(ch.AUDIT_EVENT["seed"]))
    else:
        e = None
        for t in ch.CHANGE_TYPES:
            e = F.when(F.col("__ctype") == t, F.lit(ch.AUDIT_EVENT[t])) if e is None else e.when(F.col("__ctype") == t, F.lit(ch.AUDIT_EVENT[t]))
        o = o.where(F.col("__ctype").isNotNull()).withColumn("__event", e)
    n = F.col("o_orderkey")
    rows = o.select(
        # Derived from claim key + run: audit rows of different runs never collide.
        padded_id("AUD", n, 12, (F.lit(run), 2)).alias("claim_audit_id"),
        claim_key(n).alias("claim_id"),
        F.col("__event").alias("event_type"),
        F.col("o_orderstatus").alias("event_status"),
        padded_id("USR", F.col("o_custkey"), 9).alias("event_user"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"),
        F.concat(F.col("__event"), F.lit(" event")).alias("note"),
        n.alias("__n"),
        F.col("o_orderdate").alias("__ts"),
    )
    return ch.conform(ch.stamp(rows, "I", _seq(rm, run, F.col("__n") * 100 + 1), F.col("__ts")), CLAIMS["claim_audit"])


def payment_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    o = _orders(spark, sf_dir, rm)
    if run == SEED:
        o, oper = o.where(_existing(F.col("__ctype"))), F.lit("I")
    else:
        o = o.where(F.col("__ctype").isin("adjustment", "reversal"))
        oper = F.lit("U")  # a new payment key: an update of an unknown key inserts
    n = F.col("o_orderkey")
    rows = o.select(
        padded_id("PMT", n, 12, (F.lit(run), 2)).alias("payment_id"),
        claim_key(n).alias("claim_id"),
        padded_id("PAY", F.pmod(F.col("o_custkey"), F.lit(rm.n_payers)) + 1, 5).alias("payer_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("payment_amount"),
        F.to_date("o_orderdate").alias("payment_date"),
        padded_id("CHK", n, 9).alias("check_number"),
        F.col("o_orderdate").cast("timestamp").alias("last_updated"),
        n.alias("__n"),
        F.col("o_orderdate").alias("__ts"),
    )
    return ch.conform(ch.stamp(rows, oper, _seq(rm, run, F.col("__n") * 100 + 2), F.col("__ts")), CLAIMS["claim_payment"])


def attribute_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    """Three attribute rows per new claim: row multiplication by ``explode(sequence)``."""
    o = _orders(spark, sf_dir, rm)
    o = o.where(_existing(F.col("__ctype"))) if run == SEED else o.where(F.col("__ctype") == "new")
    n = F.col("o_orderkey")
    rows = o.select(n.alias("__n"), F.col("o_orderdate").alias("__ts"), "o_orderpriority", "o_orderstatus", "o_custkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("__i"))
    i = F.col("__i")
    n = F.col("__n")
    out = rows.select(
        padded_id("ATR", n, 12, (i, 0)).alias("claim_attribute_id"),
        claim_key(n).alias("claim_id"),
        F.when(i < 3, "order").otherwise("customer").alias("attribute_group"),
        F.when(i == 1, "priority").when(i == 2, "status").otherwise("number").alias("attribute_name"),
        F.when(i == 1, F.col("o_orderpriority")).when(i == 2, F.col("o_orderstatus")).otherwise(F.col("o_custkey").cast("string")).alias("attribute_value"),
        F.col("__ts").cast("timestamp").alias("last_updated"),
        n, i, F.col("__ts"),
    )
    return ch.conform(ch.stamp(out, "I", _seq(rm, run, n * 100 + 10 + i), F.col("__ts")), CLAIMS["claim_attribute"])


def diagnosis_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    """One diagnosis per line: code = the part's brand; line 1 is PRINCIPAL."""
    li = _lines(spark, sf_dir, rm)
    li = li.where(_existing(F.col("__ctype"))) if run == SEED else li.where(F.col("__ctype") == "new")
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    j = li.join(part, "l_partkey", "left")
    n, line = F.col("l_orderkey"), F.col("l_linenumber")
    rows = j.select(
        padded_id("DX", n, 12, (line, 0)).alias("claim_diagnosis_id"),
        claim_key(n).alias("claim_id"),
        line.alias("diagnosis_seq"),
        F.col("p_brand").alias("diagnosis_code"),
        F.when(line == 1, F.lit("PRINCIPAL")).otherwise(F.lit("SECONDARY")).alias("diagnosis_type"),
        F.col("l_shipdate").cast("timestamp").alias("last_updated"),
        (n * 100 + line).alias("__ord"),
        F.col("l_shipdate").alias("__ts"),
    )
    return ch.conform(ch.stamp(rows, "I", _seq(rm, run, F.col("__ord")), F.col("__ts")), CLAIMS["claim_diagnosis"])


# ---------------------------------------------------------------------------
# dimensions
# ---------------------------------------------------------------------------
def provider_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    k = F.col("s_suppkey")
    if run == SEED:
        status, oper = F.when(F.col("s_acctbal") >= 0, "IN_NETWORK").otherwise("OUT_OF_NETWORK"), F.lit("I")
    else:
        # Small dimension drift: one provider in twenty leaves the network.
        s = s.where(F.pmod(k, F.lit(20)) == 0)
        status, oper = F.lit("OUT_OF_NETWORK"), F.lit("U")
    rows = s.select(
        padded_id("PRV", k, 6).alias("provider_id"),
        padded_id("", k, 10).alias("npi"),
        F.col("s_name").alias("provider_name"),
        F.lit(None).cast("string").alias("specialty"),
        status.alias("network_status"),
        padded_id("ST", F.col("s_nationkey"), 2).alias("state"),
        k.alias("__n"),
    )
    return ch.conform(ch.stamp(rows, oper, _seq(rm, run, F.col("__n")), F.lit("2000-01-01 00:00:00").cast("timestamp")), CLAIMS["provider"])


def member_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    if run != SEED:
        c = c.where(F.lit(False))
    k = F.col("c_custkey")
    rows = c.select(
        padded_id("MBR", k, 9).alias("member_id"),
        F.col("c_name").alias("member_name"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.lit(None).cast("string").alias("gender"),
        F.col("c_mktsegment").alias("plan_id"),
        F.when(F.col("c_acctbal") >= 0, "ACTIVE").otherwise("TERMED").alias("enrollment_status"),
        padded_id("ST", F.col("c_nationkey"), 2).alias("state"),
        k.alias("__n"),
    )
    return ch.conform(ch.stamp(rows, "I", _seq(rm, run, F.col("__n")), F.lit("2000-01-01 00:00:00").cast("timestamp")), CLAIMS["member"])


def payer_changes(spark: SparkSession, sf_dir: str, rm: RoleMap, run: int) -> DataFrame:
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    j = n.join(r, "n_regionkey", "left")
    if run != SEED:
        j = j.where(F.lit(False))
    k = F.col("n_nationkey")
    rows = j.select(
        padded_id("PAY", k + 1, 5).alias("payer_id"),
        F.col("n_name").alias("payer_name"),
        F.col("r_name").alias("payer_type"),
        F.lit(None).cast("string").alias("state"),
        k.alias("__n"),
    )
    return ch.conform(ch.stamp(rows, "I", _seq(rm, run, F.col("__n")), F.lit("2000-01-01 00:00:00").cast("timestamp")), CLAIMS["payer"])


BUILDERS = {
    "claim": claim_changes,
    "claim_detail": detail_changes,
    "claim_attribute": attribute_changes,
    "claim_audit": audit_changes,
    "claim_payment": payment_changes,
    "claim_diagnosis": diagnosis_changes,
    "provider": provider_changes,
    "member": member_changes,
    "payer": payer_changes,
}


def changes(spark: SparkSession, sf_dir: str, table: str, run: int, rm: RoleMap | None = None) -> DataFrame:
    """One run's landed change rows for one registry table."""
    return BUILDERS[table](spark, sf_dir, rm or RoleMap(), run)


def change_log(spark: SparkSession, sf_dir: str, table: str, runs: tuple[int, ...] = (SEED, INCREMENT), rm: RoleMap | None = None) -> DataFrame:
    """Seed and increment rows of one table, as one change log."""
    frames = [changes(spark, sf_dir, table, r, rm) for r in runs]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ---------------------------------------------------------------------------
# generic change logs over the raw driver tables
# ---------------------------------------------------------------------------
def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def line_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem")
