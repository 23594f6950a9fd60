"""Publishing the modelled layer from stored silver, incrementally where that is cheaper.

A publication is one version of a manifest that says, for each dataset, where its
rows are, and which version of each silver table they were made from. A dataset
none of whose inputs changed is carried over by reference. Of the others

* the header fact and the daily KPIs are stored tables that a publication moves by
  the change feeds of headers and lines since the last one: the lines' sums by claim
  by signed rows, the facts of the claims that are touched, and the KPIs' totals by
  the facts' images before and after; or they are rebuilt, when the manifests say
  that too much changed;
* the rest are rewritten as a new folder.

Readers see a publication as a whole, once its manifest version exists.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc
from ..plans import gold
from ..plans.refresh import DEFAULT_FULL_REFRESH_RATIO, decide
from ..sources import files
from ..sources.manifest import Manifest
from ..sources.tables import write_table
from ..specs import CLAIMS
from . import apply as ap
from . import feed, rollup

# The silver tables each dataset is made from.
INPUTS = {
    "dim_provider": ("provider",),
    "dim_member": ("member",),
    "dim_payer": ("payer",),
    "dim_procedure": ("claim_detail",),
    "dim_diagnosis": ("claim_diagnosis",),
    "dim_date": ("claim",),
    "fact_claim_line": ("claim", "claim_detail"),
    "fact_claim": ("claim", "claim_detail"),
    "agg_claims_daily": ("claim", "claim_detail"),
}
LAYOUT = {"dim_provider": ("provider_id",), "dim_member": ("member_id",), "fact_claim_line": ("claim_id",)}

LINE_SUMS = rollup.Rollup(
    "gold_claim_sums",
    ("claim_id",),
    (("paid", "paid_amount", "decimal(22,2)"), ("adjustment", "adjustment_amount", "decimal(22,2)"), ("lines", "CAST(claim_detail_id IS NOT NULL AS INT)", "bigint")),
)
DAILY = rollup.Rollup("gold_daily_totals", tuple(gold.DAILY_KEYS), gold.DAILY_TOTALS)
FACT = "gold_fact_claim"
GONE = "__gone"
FACT_SPEC = cdc.ApplySpec(keys=("claim_id",), sequence_by=(rollup.AS_OF,), delete_when=GONE, except_columns=(rollup.AS_OF, GONE))
STORED = {"fact_claim": FACT, "agg_claims_daily": DAILY.name}


def gold_manifest(spark: SparkSession, root: str) -> Manifest:
    return Manifest(spark, f"{root.rstrip('/')}/gold/_published")


def silver_versions(spark: SparkSession, root: str, tables: Iterable[str]) -> dict[str, dict]:
    """Version and last batch of each silver table that has a commit."""
    out = {}
    for t in tables:
        held = ap.contents(spark, root, t)
        if held is not None:
            out[t] = {"version": held["version"], "batch": feed.last_batch(held), "rows": ap.snapshot_rows(held)}
    return out


def _unchanged(previous: dict | None, dataset: str, sources: dict) -> bool:
    """Whether a dataset was published from the batches that its inputs still consist of."""
    if previous is None or dataset not in previous["datasets"]:
        return False
    made_from = previous["datasets"][dataset]["sources"]
    return all(made_from.get(t, {}).get("batch") == sources.get(t, {}).get("batch") for t in INPUTS[dataset])


def facts_of_claims(headers: DataFrame, sums: DataFrame) -> DataFrame:
    """The header fact of some headers and the stored sums of their lines."""
    sums = sums.select(F.col("claim_id").alias("claim"), F.col("paid").alias("total_paid_amount"), F.col("adjustment").alias("total_adjustment_amount"), F.col("lines").alias("line_count"))
    return gold.fact_of_sums(headers, sums)


def _line_images(changes: DataFrame, image: str) -> DataFrame:
    rows = changes.where(F.col(image).isNotNull()).select(F.col(f"{image}.claim_id").alias("claim_id"), "claim_detail_id", f"{image}.paid_amount", f"{image}.adjustment_amount")
    return rows.where("claim_id IS NOT NULL")


def _silver_at(spark: SparkSession, root: str, table: str, sources: dict) -> DataFrame:
    if table not in sources:
        return spark.createDataFrame([], CLAIMS[table].business_schema())
    return ap.current_state(spark, root, table, cdc.ApplySpec.for_table(CLAIMS[table]), sources[table]["version"])


def rebuild_header_facts(spark: SparkSession, root: str, number: int, sources: dict) -> None:
    """Sums by claim, header fact and KPI totals from the whole of silver, as of the given versions."""
    header, detail = (_silver_at(spark, root, t, sources) for t in INPUTS["fact_claim"])
    rollup.rebuild(spark, root, LINE_SUMS, number, detail.where("claim_id IS NOT NULL"))
    facts = facts_of_claims(header, rollup.totals(spark, root, LINE_SUMS))
    ap.replace(spark, root, FACT, facts.withColumns({GONE: F.lit(False), rollup.AS_OF: F.lit(number).cast("bigint")}), FACT_SPEC, number)
    rollup.rebuild(spark, root, DAILY, number, ap.current_state(spark, root, FACT, FACT_SPEC))


def move_header_facts(spark: SparkSession, root: str, number: int, known: dict, until: dict) -> bool:
    """Move sums, header fact and KPI totals by what changed between the known publication's versions and others; False if nothing did.

    Every step reads fixed versions and skips what it has done, so a run that failed
    half-way can be repeated.
    """
    since = known["sources"]

    def changes(table: str, columns) -> DataFrame | None:
        if table not in until:
            return None
        rule = cdc.ApplySpec.for_table(CLAIMS[table])
        return feed.change_feed(spark, root, table, rule, since.get(table, {}).get("version"), until[table]["version"], columns)

    wanted = [source for _, source in gold.HEADER_FACT]
    headers = changes("claim", wanted)
    lines = changes("claim_detail", ["claim_id", "paid_amount", "adjustment_amount"])
    if headers is None and lines is None:
        return False
    base = f"{root.rstrip('/')}/gold/_changes/{number}"
    touched = None
    if lines is not None:
        # written once: three steps read it, and it tells what the publication did
        write_table(lines, f"{base}/lines")
        lines = spark.read.parquet(f"{base}/lines")
        came, went = _line_images(lines, "after"), _line_images(lines, "before")
        rollup.move(spark, root, LINE_SUMS, number, came, went)
        touched = came.select("claim_id").unionByName(went.select("claim_id"))
    if headers is not None:
        own = headers.select("claim_id")
        touched = own if touched is None else touched.unionByName(own)
    touched = touched.distinct()
    write_table(touched, f"{base}/claims")
    touched = spark.read.parquet(f"{base}/claims")
    header = ap.current_state_for(spark, root, "claim", cdc.ApplySpec.for_table(CLAIMS["claim"]), touched, until["claim"]["version"])
    after = facts_of_claims(header, rollup.totals_for(spark, root, LINE_SUMS, touched))
    before = ap.current_state_for(spark, root, FACT, FACT_SPEC, touched, known["version"])
    cols = [c for c in after.columns if c != "claim_id"]
    write_table(feed.between(before, after, ["claim_id"], cols), f"{base}/facts")
    facts = spark.read.parquet(f"{base}/facts")
    image = F.coalesce("after", "before")
    rows = facts.select("claim_id", *[image[c].alias(c) for c in cols], (F.col("oper") == "D").alias(GONE), F.lit(number).cast("bigint").alias(rollup.AS_OF))
    ap.append_reduced(spark, root, FACT, number, rows, FACT_SPEC)
    sides = [facts.where(F.col(i).isNotNull()).select("claim_id", *[F.col(f"{i}.{c}").alias(c) for c in cols]) for i in ("after", "before")]
    rollup.move(spark, root, DAILY, number, *sides)
    return True


def _compact_stored(spark: SparkSession, root: str, threshold: float) -> None:
    for name, spec in ((LINE_SUMS.name, LINE_SUMS.spec), (FACT, FACT_SPEC), (DAILY.name, DAILY.spec)):
        held = ap.contents(spark, root, name)
        if held and held["batches"] and decide(ap.changed_rows(held), ap.snapshot_rows(held), threshold) == "full":
            ap.compact(spark, root, name, spec)


def _intent(spark: SparkSession, root: str, number: int, sources: dict, strategy: str) -> tuple[dict, str]:
    """What a publication is made from and how, fixed by its first attempt: a later one repeats it, whatever has come since."""
    path = f"{root.rstrip('/')}/gold/_changes/{number}/intent.json"
    if not files.exists(spark, path):
        files.write_text(spark, path, json.dumps({"sources": sources, "strategy": strategy}))
    held = json.loads(files.read_text(spark, path))
    return held["sources"], held["strategy"]


def _strategy(spark: SparkSession, root: str, known: dict | None, sources: dict, threshold: float) -> str:
    """``full`` or ``incremental`` for the header facts, from the manifests' row counts; full if a version to start from has expired."""
    inputs = INPUTS["fact_claim"]
    if known is None or any(known["sources"][t]["version"] not in ap.manifest_of(spark, root, t).versions() for t in inputs if t in known["sources"]):
        return "full"
    changed = sum(_rows_between(spark, root, t, known["sources"].get(t), sources.get(t)) for t in inputs)
    return decide(changed, sum(s["rows"] for t, s in sources.items() if t in inputs), threshold)


def publish(spark: SparkSession, root: str, datasets: dict[str, DataFrame], names: Iterable[str], threshold: float = DEFAULT_FULL_REFRESH_RATIO) -> int:
    """Publish the named ones of ``datasets`` (their full plans); returns the publication's number.

    A publication that failed half-way is done again under the same number and
    from the same versions: stored tables skip what they have, folders are
    overwritten.
    """
    names = list(names)
    m = gold_manifest(spark, root)
    previous = m.latest()
    number = 0 if previous is None else previous["version"] + 1
    sources = silver_versions(spark, root, {t for n in INPUTS for t in INPUTS[n]})
    entries = dict(previous["datasets"]) if previous else {}
    todo = [n for n in names if not _unchanged(previous, n, sources)]
    if any(n in STORED for n in todo):
        known = entries.get("fact_claim") if STORED.keys() <= entries.keys() else None
        at, strategy = _intent(spark, root, number, sources, _strategy(spark, root, known, sources, threshold))
        if strategy == "incremental":
            move_header_facts(spark, root, number, known, at)
        else:
            rebuild_header_facts(spark, root, number, at)
        _compact_stored(spark, root, threshold)
        for n, table in STORED.items():
            entries[n] = {"table": table, "version": ap.contents(spark, root, table)["version"], "sources": _of(at, n), "strategy": strategy}
    for n in todo:
        if n not in STORED:
            folder = f"{root.rstrip('/')}/gold/{n}/v={number}"
            write_table(datasets[n], folder, cluster_by=LAYOUT.get(n, ()))
            entries[n] = {"folder": folder, "sources": _of(sources, n)}
    return m.commit({"datasets": entries}, previous)["version"]


def _of(sources: dict, dataset: str) -> dict:
    return {t: sources[t] for t in INPUTS[dataset] if t in sources}


def _rows_between(spark: SparkSession, root: str, table: str, since: dict | None, until: dict | None) -> int:
    """Rows of the batches between two versions, from the manifests."""
    if until is None:
        return 0
    first = since["batch"] if since else -1
    rows, seen = 0, set()
    m = ap.manifest_of(spark, root, table)
    for v in [v for v in m.versions() if since is None or v > since["version"]]:
        for b in m.at(v)["batches"]:
            if b["id"] > first and b["id"] not in seen:
                seen.add(b["id"])
                rows += b["rows"]
    return rows


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A dataset as published last, or by an earlier publication."""
    m = gold_manifest(spark, root)
    published = m.latest() if version is None else m.at(version)
    if published is None or name not in published["datasets"]:
        raise FileNotFoundError(f"no committed version of gold dataset {name!r}")
    entry = published["datasets"][name]
    if "folder" in entry:
        return spark.read.parquet(entry["folder"])
    if entry["table"] == FACT:
        return ap.current_state(spark, root, FACT, FACT_SPEC, entry["version"])
    return gold.daily_kpis_of_totals(rollup.totals(spark, root, DAILY, entry["version"]).drop(rollup.ROWS))
