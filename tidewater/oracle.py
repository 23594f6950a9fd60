"""SQL oracles (DuckDB dialect) for the named queries in ``tidewater.queries``.

Written independently of the Spark code: window ``row_number`` instead of the
struct-maximum reduction, integer arithmetic for half-up rounding, explicit
casts to the Spark result types. Views ``orders``, ``lineitem``, ... are the
driver's parquet tables.
"""

from __future__ import annotations

SEQ_STEP = 10**15

# --- fixed values: the default change mix as buckets of o_orderkey mod 20 ----
#   0-3 new, 4-9 header only, 10-16 adjustment, 17-19 reversal


def ctype(k: str, nb: int = 20) -> str:
    """Change type of a key; with ``nb`` > 20 buckets 20.. are untouched (NULL)."""
    return (
        f"CASE WHEN {k} % {nb} < 4 THEN 'new' WHEN {k} % {nb} < 10 THEN 'header_only' "
        f"WHEN {k} % {nb} < 17 THEN 'adjustment' WHEN {k} % {nb} < 20 THEN 'reversal' END"
    )


OPER_RANK = "CASE header__change_oper WHEN 'D' THEN 3 WHEN 'U' THEN 2 WHEN 'I' THEN 1 ELSE 0 END"


def latest(cte: str, keys: str, cols: list[str]) -> str:
    """Rows of ``cte`` ranked first per key by seq, ts, D>U>I, then every column."""
    tail = ", ".join(f"{c} DESC NULLS LAST" for c in cols)
    return (
        f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY "
        f"header__change_seq DESC, header__change_ts DESC NULLS LAST, {OPER_RANK} DESC, {tail}) AS __rn FROM {cte}) WHERE __rn = 1"
    )


CLAIM_COLS = [
    "member_id", "provider_id", "payer_id", "claim_status", "claim_type", "total_charge_amount",
    "total_paid_amount", "service_from_date", "service_to_date", "submitted_date", "last_updated",
    "header__change_oper", "header__change_seq", "header__change_ts",
]
DETAIL_COLS = [
    "claim_id", "line_number", "procedure_code", "revenue_code", "place_of_service", "provider_id", "units",
    "charge_amount", "allowed_amount", "paid_amount", "adjustment_amount", "last_updated",
    "header__change_oper", "header__change_seq", "header__change_ts",
]
DIAG_COLS = [
    "claim_id", "diagnosis_seq", "diagnosis_code", "diagnosis_type", "last_updated",
    "header__change_oper", "header__change_seq", "header__change_ts",
]

def claim_log_sql(nb: int = 20, hot: int = 0) -> str:
    prov = f"CASE WHEN run = 1 AND o_orderkey % 100 < {hot} THEN 1 ELSE o_orderkey % 100 + 1 END"
    return f"""
claim_src AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, {ctype('o_orderkey', nb)} AS ctype FROM orders),
claim_runs AS (
  SELECT 0 AS run, 'I' AS oper, 'PAID' AS status, * FROM claim_src WHERE ctype IS DISTINCT FROM 'new'
  UNION ALL
  SELECT 1, CASE WHEN ctype = 'new' THEN 'I' ELSE 'U' END,
         CASE ctype WHEN 'new' THEN 'SUBMITTED' WHEN 'header_only' THEN 'DENIED'
                    WHEN 'adjustment' THEN 'ADJUSTED' ELSE 'REVERSED' END, *
  FROM claim_src WHERE ctype IS NOT NULL),
claim_log AS (
  SELECT printf('CLM%012d', o_orderkey) AS claim_id, printf('MBR%09d', o_custkey) AS member_id,
         printf('PRV%06d', {prov}) AS provider_id, printf('PAY%05d', o_custkey % 25 + 1) AS payer_id,
         status AS claim_status, o_orderpriority AS claim_type,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_charge_amount, CAST(o_totalprice AS DECIMAL(12,2)) AS total_paid_amount,
         CAST(o_orderdate AS DATE) AS service_from_date, CAST(o_orderdate AS DATE) AS service_to_date,
         o_orderdate AS submitted_date, o_orderdate AS last_updated,
         oper AS header__change_oper, run * {SEQ_STEP} + o_orderkey * 100 AS header__change_seq,
         o_orderdate AS header__change_ts, ctype, run
  FROM claim_runs),
claim_cur AS ({latest('claim_log', 'claim_id', CLAIM_COLS)} AND header__change_oper <> 'D')"""


CLAIM_LOG = claim_log_sql()

def detail_log_sql(nb: int = 20, hot: int = 0) -> str:
    prov = f"CASE WHEN run = 1 AND l_orderkey % 100 < {hot} THEN 1 ELSE l_suppkey END"
    return f"""
line_src AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate,
         {ctype('l_orderkey', nb)} AS ctype,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS ep, CAST(l_discount AS DECIMAL(4,2)) AS disc,
         CAST(l_tax AS DECIMAL(4,2)) AS tax
  FROM lineitem),
line_amt AS (
  SELECT *, CAST(round(ep * (1 - disc), 2) AS DECIMAL(12,2)) AS allowed,
         CAST(round(ep * (1 - disc) * (1 + tax), 2) AS DECIMAL(12,2)) AS paid0,
         CAST(-round(ep * disc, 2) AS DECIMAL(12,2)) AS adj0
  FROM line_src),
line_runs AS (
  SELECT 0 AS run, 'I' AS oper, paid0 AS paid, adj0 AS adj, * FROM line_amt WHERE ctype IS DISTINCT FROM 'new'
  UNION ALL SELECT 1, 'I', paid0, adj0, * FROM line_amt WHERE ctype = 'new'
  UNION ALL SELECT 1, 'U', allowed, CAST(allowed - paid0 AS DECIMAL(12,2)), * FROM line_amt WHERE ctype = 'adjustment'
  UNION ALL SELECT 1, 'D', NULL, NULL, * FROM line_amt WHERE ctype = 'reversal'),
detail_log AS (
  SELECT printf('CLM%012d-%02d', l_orderkey, l_linenumber) AS claim_detail_id,
         printf('CLM%012d', l_orderkey) AS claim_id,
         CASE WHEN oper = 'D' THEN NULL ELSE l_linenumber END AS line_number,
         CASE WHEN oper = 'D' THEN NULL ELSE printf('PX%06d', l_partkey) END AS procedure_code,
         CASE WHEN oper = 'D' THEN NULL ELSE l_returnflag END AS revenue_code,
         CASE WHEN oper = 'D' THEN NULL ELSE l_linestatus END AS place_of_service,
         CASE WHEN oper = 'D' THEN NULL ELSE printf('PRV%06d', {prov}) END AS provider_id,
         CASE WHEN oper = 'D' THEN NULL ELSE CAST(trunc(l_quantity) AS INTEGER) END AS units,
         CASE WHEN oper = 'D' THEN NULL ELSE ep END AS charge_amount,
         CASE WHEN oper = 'D' THEN NULL ELSE allowed END AS allowed_amount,
         paid AS paid_amount, adj AS adjustment_amount,
         CASE WHEN oper = 'D' THEN NULL ELSE l_shipdate END AS last_updated,
         oper AS header__change_oper, run * {SEQ_STEP} + l_orderkey * 100 + l_linenumber AS header__change_seq,
         l_shipdate AS header__change_ts, ctype, run
  FROM line_runs),
detail_cur AS ({latest('detail_log', 'claim_detail_id', DETAIL_COLS)} AND header__change_oper <> 'D')"""


DETAIL_LOG = detail_log_sql()

HEADER_FACT = """
line_tot AS (
  SELECT claim_id, sum(paid_amount) AS p, sum(adjustment_amount) AS a, count(claim_detail_id) AS n
  FROM detail_cur GROUP BY claim_id),
fact AS (
  SELECT h.claim_id, h.member_id, h.provider_id, h.payer_id, h.service_from_date AS service_date_key,
         h.claim_status, h.total_charge_amount,
         CAST(coalesce(t.p, 0) AS DECIMAL(14,2)) AS total_paid_amount,
         CAST(coalesce(t.a, 0) AS DECIMAL(14,2)) AS total_adjustment_amount,
         coalesce(t.n, 0) AS line_count,
         CASE WHEN h.total_charge_amount = 0 THEN NULL ELSE
           CAST(CAST((CAST(coalesce(t.p, 0) * 100 AS BIGINT) * 20000 + CAST(h.total_charge_amount * 100 AS BIGINT))
                     // (2 * CAST(h.total_charge_amount * 100 AS BIGINT)) AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(27,4))
         END AS paid_ratio
  FROM claim_cur h LEFT JOIN line_tot t ON h.claim_id = t.claim_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


def half_up_rate(flag: str, n: str) -> str:
    return f"((20000 * sum(CASE WHEN {flag} THEN 1 ELSE 0 END) + {n}) // (2 * {n})) / 10000.0"


LINE_PAYLOAD = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_LATEST = (
    "SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, "
    + ", ".join(f"{c} DESC NULLS LAST" for c in LINE_PAYLOAD)
    + ") AS __rn FROM lineitem) WHERE __rn = 1"
)
LINE_DELETE = "(l_returnflag = 'R' AND l_linestatus = 'F')"

ORACLE: dict[str, str] = {
    "cdc_scd1_events": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND NOT coalesce(event_type = 'error', false)""",
    "cdc_scd1_lines": f"SELECT * FROM ({LINE_LATEST}) WHERE NOT coalesce({LINE_DELETE}, false)",
    "cdc_tombstones": f"SELECT l_orderkey, l_linenumber, l_shipdate FROM ({LINE_LATEST}) WHERE coalesce({LINE_DELETE}, false)",
    "dim_provider": """
SELECT printf('PRV%06d', s_suppkey) AS provider_id, printf('%010d', s_suppkey) AS npi, s_name AS provider_name,
       CAST(NULL AS VARCHAR) AS specialty,
       CASE WHEN s_suppkey % 20 = 0 THEN 'OUT_OF_NETWORK' WHEN s_acctbal >= 0 THEN 'IN_NETWORK' ELSE 'OUT_OF_NETWORK' END AS network_status,
       printf('ST%02d', s_nationkey) AS state
FROM supplier""",
    "dim_member": """
SELECT printf('MBR%09d', c_custkey) AS member_id, c_name AS member_name, CAST(NULL AS DATE) AS date_of_birth,
       CAST(NULL AS VARCHAR) AS gender, c_mktsegment AS plan_id,
       CASE WHEN c_acctbal >= 0 THEN 'ACTIVE' ELSE 'TERMED' END AS enrollment_status,
       printf('ST%02d', c_nationkey) AS state
FROM customer""",
    "dim_payer": """
SELECT printf('PAY%05d', n_nationkey + 1) AS payer_id, n_name AS payer_name, r_name AS payer_type, CAST(NULL AS VARCHAR) AS state
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_procedure": _with(DETAIL_LOG) + "\nSELECT DISTINCT procedure_code FROM detail_cur WHERE procedure_code IS NOT NULL",
    "dim_diagnosis": f"""
WITH dx_log AS (
  SELECT printf('DX%012d-%d', l_orderkey, l_linenumber) AS claim_diagnosis_id, printf('CLM%012d', l_orderkey) AS claim_id,
         l_linenumber AS diagnosis_seq, p_brand AS diagnosis_code,
         CASE WHEN l_linenumber = 1 THEN 'PRINCIPAL' ELSE 'SECONDARY' END AS diagnosis_type,
         l_shipdate AS last_updated, 'I' AS header__change_oper,
         (CASE WHEN {ctype('l_orderkey')} = 'new' THEN {SEQ_STEP} ELSE 0 END) + l_orderkey * 100 + l_linenumber AS header__change_seq,
         l_shipdate AS header__change_ts
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
dx_cur AS ({latest('dx_log', 'claim_diagnosis_id', DIAG_COLS)})
SELECT DISTINCT diagnosis_code, diagnosis_type FROM dx_cur WHERE diagnosis_code IS NOT NULL""",
    "dim_date": """
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, strftime(d, '%a') AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year
FROM (SELECT make_date(CAST(year(min(o_orderdate)) AS INTEGER), 1, 1) AS lo,
             make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31) AS hi FROM orders) b,
     generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(d)""",
    "fact_line": _with(CLAIM_LOG, DETAIL_LOG)
    + """
SELECT d.claim_detail_id, d.claim_id, h.member_id, d.provider_id, h.payer_id, h.service_from_date AS service_date_key,
       d.procedure_code, h.claim_status, d.units, d.charge_amount, d.allowed_amount, d.paid_amount, d.adjustment_amount
FROM detail_cur d LEFT JOIN claim_cur h ON d.claim_id = h.claim_id""",
    "fact_header": _with(CLAIM_LOG, DETAIL_LOG, HEADER_FACT) + "\nSELECT * FROM fact",
    "agg_daily": _with(CLAIM_LOG, DETAIL_LOG, HEADER_FACT)
    + f"""
SELECT service_date_key, payer_id, provider_id, count(claim_id) AS claim_count,
       CAST(sum(total_paid_amount) AS DECIMAL(24,2)) AS total_paid,
       CAST(sum(total_adjustment_amount) AS DECIMAL(24,2)) AS total_adjustment,
       CAST(CAST((2 * sum(CAST(paid_ratio * 10000 AS BIGINT)) + count(paid_ratio)) // nullif(2 * count(paid_ratio), 0)
            AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(28,4)) AS avg_paid_ratio,
       {half_up_rate("claim_status = 'REVERSED'", 'count(claim_id)')} AS reversal_rate,
       {half_up_rate("claim_status = 'ADJUSTED'", 'count(claim_id)')} AS adjustment_rate
FROM fact GROUP BY service_date_key, payer_id, provider_id""",
}

DETAIL_COMPARED = ", ".join(c for c in ["claim_detail_id"] + DETAIL_COLS[:11])

ORACLE.update({
    "bronze_ingest": _with(DETAIL_LOG)
    + f"""
SELECT {DETAIL_COMPARED}, header__change_oper, header__change_seq,
       CASE WHEN run = 0 THEN 'seed' ELSE 'incr0001' END AS label
FROM detail_log""",
    "cdc_stream_lines": _with(DETAIL_LOG) + f"\nSELECT {DETAIL_COMPARED} FROM detail_cur",
    "cdc_replay_lines": _with(DETAIL_LOG) + f"\nSELECT {DETAIL_COMPARED} FROM detail_cur",
    "fact_line_incremental": _with(CLAIM_LOG, DETAIL_LOG)
    + """
SELECT d.claim_detail_id, d.claim_id, h.member_id, d.provider_id, h.payer_id, h.service_from_date AS service_date_key,
       d.procedure_code, h.claim_status, d.units, d.charge_amount, d.allowed_amount, d.paid_amount, d.adjustment_amount
FROM detail_cur d LEFT JOIN claim_log h ON d.claim_id = h.claim_id AND h.run = d.run""",
    "cdc_stream_events": ORACLE["cdc_scd1_events"],
})


LINE_ASC = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, " + ", ".join(LINE_PAYLOAD)

ORACLE.update({
    "quality_warn_counts": """
SELECT 'value_at_least_10' AS rule, 'warn' AS action,
       count(*) FILTER (WHERE NOT coalesce(value >= 10, false) AND NOT coalesce(event_type = 'error', false)) AS failed_rows
FROM events
UNION ALL
SELECT 'value_at_least_1', 'drop', count(*) FILTER (WHERE NOT coalesce(value >= 1, false))
FROM events""",
    "quality_drop": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
  WHERE coalesce(value >= 1, false))
WHERE rn = 1 AND NOT coalesce(event_type = 'error', false)""",
    "quality_rejects": """
SELECT event_id, user_id, event_type, 'value_at_least_1' AS failed_rules FROM events
WHERE NOT coalesce(value >= 1, false)""",
    "cdc_scd2_events": """
SELECT * EXCLUDE (nxt), nxt AS __end_at FROM (
  SELECT event_id, ts, user_id, event_type, value, props, event_id AS __start_at,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt
  FROM events)
WHERE NOT coalesce(event_type = 'error', false)""",
    "cdc_scd2_lines": f"""
SELECT * EXCLUDE (nxt), nxt AS __end_at FROM (
  SELECT *, l_shipdate AS __start_at,
         lead(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ASC}) AS nxt
  FROM (SELECT DISTINCT * FROM lineitem))
WHERE NOT coalesce({LINE_DELETE}, false)""",
})


def _skew_rows(scenario: str, hot: int) -> str:
    prov = f"CASE WHEN l_orderkey % 100 < {hot} THEN 1 ELSE l_suppkey END"
    return f"""
  SELECT '{scenario}' AS scenario, printf('CLM%012d-%02d', l_orderkey, l_linenumber) AS claim_detail_id,
         CASE WHEN ct = 'reversal' THEN NULL ELSE printf('PRV%06d', {prov}) END AS provider_id
  FROM (SELECT *, {ctype('l_orderkey')} AS ct FROM lineitem) WHERE ct IN ('new', 'adjustment', 'reversal')"""


_DIFF_COLS = [c for c in ["claim_detail_id"] + DETAIL_COLS[:12] if c != "claim_detail_id"]
PARTIAL_NB = 100

ORACLE.update({
    "change_batch_mix": f"""
WITH o AS (SELECT {ctype('o_orderkey')} AS ctype FROM orders),
     l AS (SELECT {ctype('l_orderkey')} AS ctype FROM lineitem)
SELECT 'claim' AS table_name, CASE WHEN ctype = 'new' THEN 'I' ELSE 'U' END AS oper, count(*) AS changes
FROM o WHERE ctype IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'claim_detail', CASE ctype WHEN 'new' THEN 'I' WHEN 'adjustment' THEN 'U' ELSE 'D' END, count(*)
FROM l WHERE ctype IN ('new', 'adjustment', 'reversal') GROUP BY 1, 2
UNION ALL SELECT 'claim_attribute', 'I', 3 * count(*) FROM o WHERE ctype = 'new' GROUP BY 1, 2
UNION ALL SELECT 'claim_audit', 'I', count(*) FROM o WHERE ctype IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'claim_payment', 'U', count(*) FROM o WHERE ctype IN ('adjustment', 'reversal') GROUP BY 1, 2
UNION ALL SELECT 'claim_diagnosis', 'I', count(*) FROM l WHERE ctype = 'new' GROUP BY 1, 2
UNION ALL SELECT 'provider', 'U', count(*) FROM supplier WHERE s_suppkey % 20 = 0 GROUP BY 1, 2""",
    "change_batch_lines": _with(DETAIL_LOG)
    + f"\nSELECT {DETAIL_COMPARED}, header__change_oper, header__change_seq FROM detail_log WHERE run = 1 AND header__change_oper <> 'D'",
    "change_batch_deletes": _with(DETAIL_LOG)
    + f"\nSELECT {DETAIL_COMPARED}, header__change_oper, header__change_seq FROM detail_log WHERE header__change_oper = 'D'",
    "union_changes": _with(CLAIM_LOG)
    + """
SELECT claim_id, member_id, provider_id, payer_id, claim_status, claim_type, total_charge_amount, service_from_date,
       header__change_oper, header__change_seq FROM claim_log""",
    "skew_profile": f"""
WITH inc AS ({_skew_rows('even', 0)} UNION ALL {_skew_rows('hot', 80)}),
per_key AS (
  SELECT scenario, 'claim_detail_id' AS merge_key, claim_detail_id AS k, count(*) AS n FROM inc GROUP BY 1, 2, 3
  UNION ALL
  SELECT scenario, 'provider_id', provider_id, count(*) FROM inc GROUP BY 1, 2, 3)
SELECT scenario, merge_key, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, max(n) AS top_key_rows,
       (max(n) * 10000) // CAST(sum(n) AS BIGINT) AS top_key_share_bp
FROM per_key GROUP BY 1, 2""",
    "snapshot_diff": _with(DETAIL_LOG)
    + f""",
detail_log0 AS (SELECT * FROM detail_log WHERE run = 0),
old_cur AS ({latest('detail_log0', 'claim_detail_id', DETAIL_COLS)} AND header__change_oper <> 'D')
SELECT coalesce(n.claim_detail_id, o.claim_detail_id) AS claim_detail_id,
       CASE WHEN o.claim_detail_id IS NULL THEN 'I' WHEN n.claim_detail_id IS NULL THEN 'D' ELSE 'U' END AS oper,
       CASE WHEN o.claim_detail_id IS NULL OR n.claim_detail_id IS NULL THEN '' ELSE concat_ws(',', {", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in _DIFF_COLS)}) END AS changed_columns
FROM old_cur o FULL OUTER JOIN detail_cur n ON o.claim_detail_id = n.claim_detail_id
WHERE o.claim_detail_id IS NULL OR n.claim_detail_id IS NULL OR {" OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in _DIFF_COLS)}""",
    "twin_reconcile": _with(CLAIM_LOG, DETAIL_LOG)
    + """
SELECT d.claim_detail_id, 'header_drift' AS kind,
       concat_ws(',', CASE WHEN h0.member_id IS DISTINCT FROM h1.member_id THEN 'member_id' END,
                      CASE WHEN h0.payer_id IS DISTINCT FROM h1.payer_id THEN 'payer_id' END,
                      CASE WHEN h0.service_from_date IS DISTINCT FROM h1.service_from_date THEN 'service_date_key' END,
                      CASE WHEN h0.claim_status IS DISTINCT FROM h1.claim_status THEN 'claim_status' END) AS drift_columns
FROM detail_cur d
LEFT JOIN claim_log h0 ON h0.claim_id = d.claim_id AND h0.run = d.run
LEFT JOIN claim_cur h1 ON h1.claim_id = d.claim_id
WHERE h0.member_id IS DISTINCT FROM h1.member_id OR h0.payer_id IS DISTINCT FROM h1.payer_id
   OR h0.service_from_date IS DISTINCT FROM h1.service_from_date OR h0.claim_status IS DISTINCT FROM h1.claim_status""",
    "agg_daily_touched": ORACLE["agg_daily"]
    .replace(CLAIM_LOG.strip(), claim_log_sql(PARTIAL_NB).strip())
    .replace(DETAIL_LOG.strip(), detail_log_sql(PARTIAL_NB).strip()),
    "refresh_choice": _with(claim_log_sql(PARTIAL_NB), detail_log_sql(PARTIAL_NB))
    + """,
counts AS (
  SELECT 'claim' AS table_name, count(*) FILTER (WHERE run = 1) AS changed_rows,
         count(DISTINCT claim_id) FILTER (WHERE run = 0) AS base_rows FROM claim_log
  UNION ALL
  SELECT 'claim_detail', count(*) FILTER (WHERE run = 1), count(DISTINCT claim_detail_id) FILTER (WHERE run = 0) FROM detail_log)
SELECT table_name, changed_rows, base_rows,
       CASE WHEN base_rows > 0 THEN (changed_rows * 10000) // base_rows END AS change_ratio_bp,
       CASE WHEN base_rows = 0 OR (changed_rows * 10000) // base_rows >= 2000 THEN 'full' ELSE 'incremental' END AS strategy
FROM counts""",
})


ORACLE.update({
    "bronze_rescue": _with(DETAIL_LOG)
    + f"""
SELECT {DETAIL_COMPARED.replace("units", "CASE WHEN run = 1 AND line_number = 1 THEN NULL ELSE units END AS units")},
       header__change_oper, header__change_seq,
       CASE WHEN run = 0 THEN NULL
            WHEN line_number = 1 THEN '{{"units":"' || units || ' units","source_system":"legacy"}}'
            ELSE '{{"source_system":"legacy"}}' END AS _rescued_data
FROM detail_log""",
    "bronze_json": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "flows_live_rows": f"""
WITH o AS (SELECT o_orderkey, {ctype('o_orderkey')} AS ct FROM orders),
     l AS (SELECT l_orderkey, l_linenumber, {ctype('l_orderkey')} AS ct FROM lineitem)
SELECT 'claim' AS table_name, count(*) AS live_rows FROM o
UNION ALL SELECT 'claim_detail', count(DISTINCT (l_orderkey, l_linenumber)) FROM l WHERE ct IS DISTINCT FROM 'reversal'
UNION ALL SELECT 'claim_attribute', 3 * count(*) FROM o
UNION ALL SELECT 'claim_audit', count(*) FILTER (WHERE ct IS DISTINCT FROM 'new') + count(*) FILTER (WHERE ct IS NOT NULL) FROM o
UNION ALL SELECT 'claim_payment', count(*) FILTER (WHERE ct IS DISTINCT FROM 'new') + count(*) FILTER (WHERE ct IN ('adjustment', 'reversal')) FROM o
UNION ALL SELECT 'claim_diagnosis', count(DISTINCT (l_orderkey, l_linenumber)) FROM l
UNION ALL SELECT 'provider', count(*) FROM supplier
UNION ALL SELECT 'member', count(*) FROM customer
UNION ALL SELECT 'payer', count(*) FROM nation""",
    "cdc_compact_lines": _with(DETAIL_LOG) + f"\nSELECT {DETAIL_COMPARED} FROM detail_cur",
})

ORACLE["control_runs"] = f"""
WITH o AS (SELECT o_orderkey AS n, {ctype('o_orderkey')} = 'new' AS fresh FROM orders)
SELECT max(n) FILTER (NOT fresh) + 2 * (max(n) FILTER (fresh) + 1) AS max_claim_n, CAST({3 * SEQ_STEP} AS BIGINT) AS seq_base,
       CAST(2 AS BIGINT) AS run_index, count(*) FILTER (NOT fresh) + 2 * count(*) FILTER (fresh) AS live_claims
FROM o"""

ORACLE["cdc_scd2_claims"] = _with(CLAIM_LOG) + """
SELECT claim_id, claim_status, payer_id, header__change_seq AS __start_at,
       lead(header__change_seq) OVER (PARTITION BY claim_id ORDER BY header__change_seq) AS __end_at
FROM claim_log"""

ORACLE["cdc_compact_retry"] = ORACLE["cdc_compact_lines"]
ORACLE["cdc_compact_null_keys"] = """
WITH logged AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS u, CASE WHEN user_id % 5 = 0 THEN NULL ELSE event_type END AS kind, event_id, value
  FROM events)
SELECT u, kind, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY u, kind ORDER BY event_id DESC) AS r FROM logged) WHERE r = 1"""

_GOLD = {
    "fact_claim": "fact_header", "fact_claim_line": "fact_line", "agg_claims_daily": "agg_daily",
    **{d: d for d in ("dim_provider", "dim_member", "dim_payer", "dim_procedure", "dim_diagnosis", "dim_date")},
}
ORACLE["gold_published"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, count(*) AS n_rows FROM ({ORACLE[own].strip()})" for name, own in sorted(_GOLD.items())
)
ORACLE["gold_published_kpis"] = ORACLE["agg_daily"]

_ORDERS = f"WITH o AS (SELECT *, {ctype('o_orderkey')} AS ctype FROM orders)"
ORACLE["change_batch_audit"] = _ORDERS + f"""
SELECT printf('AUD%012d-01', o_orderkey) AS claim_audit_id, printf('CLM%012d', o_orderkey) AS claim_id, e AS event_type,
       o_orderstatus AS event_status, printf('USR%09d', o_custkey) AS event_user, o_orderdate AS event_timestamp, e || ' event' AS note,
       'I' AS header__change_oper, {SEQ_STEP} + o_orderkey * 100 + 1 AS header__change_seq
FROM (SELECT *, CASE ctype WHEN 'new' THEN 'SUBMIT' WHEN 'header_only' THEN 'DENY' WHEN 'adjustment' THEN 'ADJUST' ELSE 'REVERSE' END AS e
      FROM o WHERE ctype IS NOT NULL)"""
ORACLE["change_batch_payments"] = _ORDERS + f"""
SELECT printf('PMT%012d-01', o_orderkey) AS payment_id, printf('CLM%012d', o_orderkey) AS claim_id,
       printf('PAY%05d', o_custkey % 25 + 1) AS payer_id, o_orderpriority AS payment_method,
       CAST(o_totalprice AS DECIMAL(12,2)) AS payment_amount, CAST(o_orderdate AS DATE) AS payment_date,
       printf('CHK%09d', o_orderkey) AS check_number, o_orderdate AS last_updated,
       'U' AS header__change_oper, {SEQ_STEP} + o_orderkey * 100 + 2 AS header__change_seq
FROM o WHERE ctype IN ('adjustment', 'reversal')"""
ORACLE["change_batch_attributes"] = _ORDERS + f"""
SELECT printf('ATR%012d-%d', o_orderkey, i) AS claim_attribute_id, printf('CLM%012d', o_orderkey) AS claim_id,
       CASE WHEN i < 3 THEN 'order' ELSE 'customer' END AS attribute_group,
       CASE i WHEN 1 THEN 'priority' WHEN 2 THEN 'status' ELSE 'number' END AS attribute_name,
       CASE i WHEN 1 THEN o_orderpriority WHEN 2 THEN o_orderstatus ELSE CAST(o_custkey AS VARCHAR) END AS attribute_value,
       o_orderdate AS last_updated, 'I' AS header__change_oper, {SEQ_STEP} + o_orderkey * 100 + 10 + i AS header__change_seq
FROM o, generate_series(1, 3) AS t(i) WHERE ctype = 'new'"""
ORACLE["change_batch_diagnoses"] = f"""
SELECT printf('DX%012d-%d', l_orderkey, l_linenumber) AS claim_diagnosis_id, printf('CLM%012d', l_orderkey) AS claim_id,
       l_linenumber AS diagnosis_seq, p_brand AS diagnosis_code, CASE WHEN l_linenumber = 1 THEN 'PRINCIPAL' ELSE 'SECONDARY' END AS diagnosis_type,
       l_shipdate AS last_updated, 'I' AS header__change_oper, {SEQ_STEP} + l_orderkey * 100 + l_linenumber AS header__change_seq
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE {ctype('l_orderkey')} = 'new'"""

ORACLE["scd2_incremental"] = ORACLE["cdc_scd2_events"]
ORACLE["change_feed"] = ORACLE["snapshot_diff"]
ORACLE["agg_daily_rollup"] = ORACLE["agg_daily_touched"]
# a batch is counted after its reduction: keys that changed, not changes
ORACLE["refresh_choice_log"] = (
    ORACLE["refresh_choice"]
    .replace("count(*) FILTER (WHERE run = 1) AS changed_rows", "count(DISTINCT claim_id) FILTER (WHERE run = 1) AS changed_rows")
    .replace("'claim_detail', count(*) FILTER (WHERE run = 1)", "'claim_detail', count(DISTINCT claim_detail_id) FILTER (WHERE run = 1)")
)

ORACLE["schema_history"] = _with(DETAIL_LOG) + """
SELECT run AS version, run AS batch_id, CASE run WHEN 0 THEN 'seed' ELSE 'incr0001' END AS label,
       CASE run WHEN 0 THEN '' ELSE 'source_system' END AS added, '' AS missing,
       CASE run WHEN 0 THEN '' ELSE 'units: string' END AS retyped, count(*) AS n_rows
FROM detail_log GROUP BY run
"""
ORACLE["bronze_json_rescue"] = """
SELECT CASE WHEN event_id % 10 <> 3 THEN event_id END AS event_id,
       CASE WHEN event_id % 10 <> 3 THEN user_id END AS user_id,
       CASE WHEN event_id % 10 <> 3 THEN event_type END AS event_type,
       CASE WHEN event_id % 10 NOT IN (1, 3) THEN value END AS value,
       CASE WHEN event_id % 10 = 1 THEN '{"value":"about ' || CAST(floor(value) AS BIGINT) || '","origin":"feed ' || user_id || '"}'
            WHEN event_id % 10 = 2 THEN '{"origin":"feed ' || user_id || '"}'
            WHEN event_id % 10 = 3 THEN '{"_corrupt_record":"broken ' || event_id || '"}' END AS _rescued_data
FROM events
"""
ORACLE["fact_line_two_sided"] = ORACLE["fact_line"]
ORACLE["skew_heavy_hitters"] = f"""
WITH inc AS ({_skew_rows('hot', 80)}),
per_key AS (SELECT provider_id AS item, count(*) AS n_rows, CAST(sum(count(*)) OVER () AS BIGINT) AS rows FROM inc GROUP BY 1)
SELECT item, n_rows, rows, n_rows * 10000 // rows AS share_bp FROM per_key WHERE item IS NOT NULL AND n_rows >= 0.1 * rows
"""


def _drawn(domain: tuple[str, ...], salt: int) -> str:
    values = ", ".join(f"'{v}'" for v in domain)
    return f"[{values}][CAST((((o_orderkey + {salt}) % 1000003) * 2654435761 // 65536) % {len(domain)} AS INTEGER) + 1]"


ORACLE["change_batch_draws"] = f"""
SELECT {_drawn(("portal", "clearinghouse", "fax", "mail"), 0)} AS channel,
       {_drawn(("duplicate", "not covered", "out of network", "late", "missing data"), 17)} AS reason,
       count(*) AS claims, 'CLM' || lpad(CAST(min(o_orderkey) AS VARCHAR), 12, '0') AS first_claim
FROM orders GROUP BY 1, 2
"""
