"""Incremental twin of the line fact: cost follows changed lines, not the table.

Streams the *bronze* line log (append-only, still carrying oper and seq),
joins each micro-batch to the header's current state read afresh for that
batch (a stream-static join against a path would freeze the header at query
start), applies the line table's drop rules, and resolves the result by
``claim_detail_id`` with the same reduction as every other flow.

By default the header columns are captured when the *line* changes: a header-only
change does not rewrite lines already in the twin, and ``plans.reconcile`` reports
exactly that drift against the full rebuild. ``refresh_headers`` takes in the
other side as well: the lines of all headers that changed since the last refresh
are written again with the header as of now, and the twin equals the full build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import oper_rank
from ..operators import cdc
from ..plans import gold
from ..sources.buckets import KEY, Layout
from ..specs import CLAIMS, OPER_COL, SEQ_COL, TS_COL
from . import apply as ap
from .ingest import checkpoint_path, read_bronze_stream

TWIN = "fact_claim_line_streaming"
# The line's own columns, as they break ties between its changes; those that the fact hasn't are kept beside it.
LINE_COLUMNS = [c for c in CLAIMS["claim_detail"].business_columns if c != "claim_detail_id"]
LINE_ORDER = [c if (c, "line", c) in gold.LINE_FACT else f"__line_{c}" for c in LINE_COLUMNS]
LINE_REST = [c for c in LINE_ORDER if c not in LINE_COLUMNS]
HEADER_SEQ = "__header_seq"  # of the header that the row was joined to, deleted ones included
# State batches of the twin: one for each stream batch, with room after it for refreshes.
BATCH_STEP = 1_000_000


def twin_apply() -> cdc.ApplySpec:
    """Keyed on the line id; same ordering and tie-break as the registry tables, then the newer header."""
    return cdc.ApplySpec(
        keys=("claim_detail_id",),
        sequence_by=(SEQ_COL,),
        # The line's own columns break ties before the header's, so the twin
        # keeps the same winner as the line table's silver flow.
        tie_break=(TS_COL, oper_rank(OPER_COL).alias("__oper_rank"), *LINE_ORDER, HEADER_SEQ),
        delete_when=f"{OPER_COL} = 'D'",
        except_columns=(OPER_COL, SEQ_COL, TS_COL, *LINE_REST, HEADER_SEQ),
    )


def line_changes_with_header(batch: DataFrame, header: DataFrame) -> DataFrame:
    """Line changes joined to the header as of now, projected to the fact's columns.

    ``header`` has the header's columns and, if known, its sequence number.
    """
    seq = F.col(HEADER_SEQ) if HEADER_SEQ in header.columns else F.lit(None).cast("bigint")
    h = header.select(*gold.HEADER_COLUMNS, seq.alias(HEADER_SEQ))
    return _twin_rows(_line_side(batch).join(h, "claim_id", "left"))


def _line_side(lines: DataFrame) -> DataFrame:
    own = [c for c in lines.columns if c in (*CLAIMS["claim_detail"].all_columns, KEY)]
    rest = [F.col(c).alias(kept) for c, kept in zip(LINE_COLUMNS, LINE_ORDER) if c != kept]
    return lines.select(*own, *rest)


def _twin_rows(joined: DataFrame) -> DataFrame:
    keyed = [KEY] if KEY in joined.columns else []
    return joined.select(*gold.line_fact_projection(joined), OPER_COL, SEQ_COL, TS_COL, *LINE_REST, HEADER_SEQ, *keyed)


def headers_for(spark: SparkSession, root: str, claims: DataFrame, version: int | None = None, whole: bool = False) -> DataFrame:
    """The headers of some claims as of now (or of a version): a deleted one keeps its sequence number and nothing else.

    The key filter runs before the header's reduction, so the lookup shuffles the
    claims asked for, not the header table. ``whole`` says that they are known to be
    much of the table: all its headers come then, without a lookup.
    """
    spec = CLAIMS["claim"]
    rule = cdc.ApplySpec.for_table(spec)
    if ap.contents(spark, root, spec.name, version) is None:
        return spark.createDataFrame([], spec.business_schema())
    if whole:
        rows = ap.reduced_state(spark, root, spec.name, rule, version)
    else:
        rows = ap.reduced_state_for(spark, root, spec.name, rule, claims.select("claim_id"), version)
    rows = cdc.mark_deletes(rows, rule)
    columns = [F.when(~F.col(cdc.DELETED_COL), F.col(c)).alias(c) for c in gold.HEADER_COLUMNS if c != "claim_id"]
    return rows.select("claim_id", *columns, F.col(SEQ_COL).alias(HEADER_SEQ))


def start_twin(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    spec = CLAIMS["claim_detail"]
    source = read_bronze_stream(spark, root, spec, max_files_per_trigger)

    def run(batch: DataFrame, batch_id: int) -> None:
        held = ap.contents(spark, root, "claim")
        now = None if held is None else held["version"]
        # all that the twin holds after its first batch is as of this version of the headers
        first = {} if ap.contents(spark, root, TWIN) is not None else {"claim": now}
        # a batch of more bytes than the headers' table asks for much of it
        whole = held is not None and ap.known_bytes(batch) > ap.stored_bytes(held)
        ap.apply_batch(
            batch,
            batch_id * BATCH_STEP,
            root,
            TWIN,
            twin_apply(),
            rules=spec.drop_rules(),  # the twin honours the line table's drop rules
            delete_when=spec.delete_predicate,
            transform=lambda kept: line_changes_with_header(kept, headers_for(spark, root, kept, now, whole)),
            layout=spec.layout,
            marks=first,
        )

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint_path(root, "twin_fact_claim_line"))
        .queryName(f"twin_{abs(hash(root)) % 10**8}")
        .trigger(availableNow=True)
        .start()
    )


def refresh_headers(spark: SparkSession, root: str) -> int:
    """Write the lines of headers that changed since the last refresh again, with the header as of now; returns their number.

    The headers come from the batches between two versions, their lines from the
    line table's current state. Only the lines' keys and claims are shuffled to the
    headers, and what these say back to the lines; whole lines stay in the buckets they
    are stored in, and the twin's batch is stored in as many. Run it after the silver
    and twin flows.
    """
    from . import feed

    twin, headers = ap.contents(spark, root, TWIN), ap.contents(spark, root, "claim")
    if twin is None or headers is None:
        return 0
    since, now = twin["marks"].get("claim"), headers["version"]
    claims = feed.touched_keys(spark, root, "claim", cdc.ApplySpec.for_table(CLAIMS["claim"]), since, now)
    if claims is None:
        return 0
    share = feed.touched_share(spark, root, "claim", since, now)
    headers = headers_for(spark, root, claims, now, whole=share > 0.2)
    lines = ap.reduced_state(spark, root, "claim_detail", cdc.ApplySpec.for_table(CLAIMS["claim_detail"]), keyed=True)
    said = lines.select(KEY, "claim_id").join(claims, "claim_id", "left_semi").join(headers, "claim_id", "left").drop("claim_id")
    rows = _twin_rows(_line_side(lines).join(said, KEY))
    batch_id = feed.last_batch(twin) + 1
    stored = ap.batch_layout(twin, Layout(), int(share * ap.stored_bytes(twin)))
    if stored is None:
        rows = rows.drop(KEY)
    elif ap.layout_of(ap.contents(spark, root, "claim_detail")).buckets != stored.buckets:
        rows = rows.repartition(stored.buckets, KEY)
    held = ap.append_reduced(spark, root, TWIN, batch_id, rows, twin_apply(), marks={"claim": now}, stored=stored)
    return next((b["rows"] for b in held["batches"] if b["id"] == batch_id), 0)


def read_twin(spark: SparkSession, root: str) -> DataFrame:
    return ap.current_state(spark, root, TWIN, twin_apply()).select(*gold.LINE_FACT_COLUMNS)
