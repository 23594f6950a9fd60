"""Layer runner: land -> bronze -> silver -> twin, each layer's flows concurrent.

Every flow is a ``StreamingQuery`` with ``trigger(availableNow=True)`` and its
own checkpoint below the work folder: a run processes what has landed and
stops, and a rerun after a crash resumes from the last committed batch. The
tables' flows are independent, so they are started together and Spark runs
their jobs side by side; the header's silver flow finishes before the twin
starts, so the twin always joins to a header at least as new as its lines.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from ..plans import layers, roles
from ..plans.changes import SEQ_STEP, check_key_range
from ..plans.refresh import DEFAULT_FULL_REFRESH_RATIO
from ..sources import files
from ..sources.control import advance_control, read_control
from ..sources.tables import write_table
from ..session import RUNNER_CONF, SPLIT_CONF, apply_conf
from ..specs import CLAIMS, TableSpec
from . import apply as ap
from . import history, ingest, publish, twin


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query; re-raise the first failure after all have stopped."""
    errors = []
    for q in list(queries):
        try:
            q.awaitTermination()
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    if errors:
        raise errors[0]


class Runner:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        registry: dict[str, TableSpec] | None = None,
        max_files_per_trigger: int = ingest.MAX_FILES_PER_TRIGGER,
    ):
        self.spark = spark
        apply_conf(spark, RUNNER_CONF | SPLIT_CONF)
        self.root = root.rstrip("/")
        self.registry = registry or CLAIMS
        self.max_files = max_files_per_trigger

    # landing ---------------------------------------------------------------
    def land(self, table: str, df: DataFrame, label: str) -> str:
        return ingest.land(df, self.root, table, label)

    def land_roles(self, sf_dir: str, run: int, rm: roles.RoleMap | None = None, tables: Iterable[str] | None = None) -> str:
        """Land one run of the role-mapped claims world (label ``seed`` or ``incrNNNN``)."""
        label = "seed" if run == roles.SEED else f"incr{run:04d}"
        for t in tables or self.registry:
            self.land(t, roles.changes(self.spark, sf_dir, t, run, rm), label)
        return label

    def land_next_run(self, sf_dir: str, rm: roles.RoleMap | None = None, tables: Iterable[str] | None = None) -> int:
        """Land the run after the one in the control row, then advance the control row.

        The control row drives the run: its new claims get keys above the
        high-water mark and its changes sequence numbers from the stored base. A
        label that was landed whole before the control row moved is not landed
        again, so a rerun after a crash adds nothing twice; a partial label is
        replaced (the ingest only ever sees files of finished writes).
        """
        c = read_control(self.spark, self.root)
        run = 0 if c is None else int(c["run_index"]) + 1
        high = 0 if c is None else int(c["max_claim_n"])
        rm = rm or roles.RoleMap()
        if c is not None:
            rm = replace(rm, new_key_base=high + 1, seq_base=int(c["seq_base"]))
        label = "seed" if run == roles.SEED else f"incr{run:04d}"
        for t in tables or self.registry:
            path = ingest.landing_path(self.root, t, label)
            if "_SUCCESS" not in files.children(self.spark, path):
                write_table(roles.changes(self.spark, sf_dir, t, run, rm), path)
        claims = roles.changes(self.spark, sf_dir, "claim", run, rm)
        n = int(claims.agg(F.max(F.regexp_extract("claim_id", r"(\d+)$", 1).cast("bigint"))).head()[0] or 0)
        check_key_range(n)
        advance_control(self.spark, self.root, max(high, n), (run + 1) * SEQ_STEP, run)
        return run

    # layers ----------------------------------------------------------------
    def _with_files(self, tables: Iterable[str] | None, folder) -> list[str]:
        """Tables that have something in ``folder(root, table)`` (others are skipped)."""
        return [t for t in (tables or self.registry) if files.children(self.spark, folder(self.root, t))]

    def ingest(self, tables: Iterable[str] | None = None, fmt: str = "parquet", suffix: str | None = None) -> None:
        todo = self._with_files(tables, ingest.landing_path)
        await_all(ingest.start_bronze(self.spark, self.root, self.registry[t], fmt, self.max_files, suffix) for t in todo)

    def apply(self, tables: Iterable[str] | None = None) -> None:
        todo = self._with_files(tables, ingest.bronze_path)
        flows = [ap.start_silver(self.spark, self.root, self.registry[t], self.max_files) for t in todo]
        flows += [history.start_history(self.spark, self.root, self.registry[t], self.max_files) for t in todo if self.registry[t].scd_type == 2]
        await_all(flows)

    def twin(self, refresh_headers: bool = False) -> None:
        """Run the line fact's twin; ``refresh_headers``: lines of changed headers are written again as well."""
        await_all([twin.start_twin(self.spark, self.root, self.max_files)])
        if refresh_headers:
            twin.refresh_headers(self.spark, self.root)

    def step(self, tables: Iterable[str] | None = None, with_twin: bool = True, refresh_headers: bool = False) -> None:
        """One availableNow pass over every layer, in dependency order."""
        tables = list(tables or self.registry)
        self.ingest(tables)
        self.apply(tables)
        if with_twin and "claim_detail" in tables:
            self.twin(refresh_headers)

    def compact(self, tables: Iterable[str] | None = None) -> dict[str, str | None]:
        """Fold each table's state folders into a new clustered snapshot (tombstones kept); the twin's with the lines'."""
        tables = list(tables or self.registry)
        done = {
            t: ap.compact(self.spark, self.root, t, cdc.ApplySpec.for_table(self.registry[t]), self.registry[t].layout_columns)
            for t in tables
        }
        for t in tables:
            if history.has_history(self.spark, self.root, t):
                done[history.history_name(t)] = history.compact_history(self.spark, self.root, t, cdc.ApplySpec.for_table(self.registry[t]))
        if "claim_detail" in tables and ap.batch_ids(self.spark, self.root, twin.TWIN):
            done[twin.TWIN] = ap.compact(self.spark, self.root, twin.TWIN, twin.twin_apply(), ("claim_id",))
        return done

    def refresh_strategy(self, table: str, threshold: float | None = None) -> str:
        """``full`` (compact now) or ``incremental`` (keep merging on read), by change ratio.

        Both counts come from the manifest, as observed when the rows were written:
        no table is scanned. Before the first snapshot it is always ``full``.
        """
        from ..plans.refresh import decide

        held = ap.contents(self.spark, self.root, table)
        if held is None or held["upto"] is None:
            return "full"
        return decide(ap.changed_rows(held), ap.snapshot_rows(held), DEFAULT_FULL_REFRESH_RATIO if threshold is None else threshold)

    def maybe_compact(self, tables: Iterable[str] | None = None, threshold: float | None = None) -> dict[str, str]:
        """Compact the tables whose change ratio since the last snapshot calls for it."""
        out = {}
        for t in tables or self.registry:
            strategy = self.refresh_strategy(t, threshold)
            if strategy == "full":
                self.compact([t])
            out[t] = strategy
        return out

    # reads -----------------------------------------------------------------
    def current(self, table: str) -> DataFrame:
        return ap.current_state_of(self.spark, self.root, self.registry[table])

    def bronze(self, table: str) -> DataFrame:
        return ingest.read_bronze(self.spark, self.root, self.registry[table])

    def twin_table(self) -> DataFrame:
        return twin.read_twin(self.spark, self.root)

    def history(self, table: str) -> DataFrame:
        """Type-2 history of a table, asked for by ``scd_type=2`` in the registry: as stored by its flow, or rebuilt from the bronze log before that has run."""
        rule = cdc.ApplySpec.for_table(self.registry[table])
        if history.has_history(self.spark, self.root, table):
            return history.read_history(self.spark, self.root, table, rule)
        return cdc.scd2_history(self.bronze(table), rule)

    def table(self, name: str) -> DataFrame:
        """A table the way its registry entry asks for: current state, or history if ``scd_type`` is 2."""
        return self.history(name) if self.registry[name].scd_type == 2 else self.current(name)

    def silver(self) -> dict[str, DataFrame]:
        """Current state of the tables that gold is made from; a table with no state yet is empty."""
        tables = {}
        for t in ("claim", "claim_detail", "claim_diagnosis", "provider", "member", "payer"):
            if ap.contents(self.spark, self.root, t) is not None:
                tables[t] = self.current(t)
            else:
                tables[t] = self.spark.createDataFrame([], self.registry[t].business_schema())
        return tables

    def gold(self, calendar=None) -> dict[str, DataFrame]:
        """Gold datasets over current state."""
        return layers.gold_datasets(self.spark, self.silver(), calendar)

    # gold sink -------------------------------------------------------------
    def publish_gold(self, calendar=None, names: Iterable[str] | None = None, threshold: float = DEFAULT_FULL_REFRESH_RATIO) -> int:
        """Publish gold datasets from stored silver (``streaming.publish``); returns the publication's number.

        A silver table is folded into its snapshot only if it has none yet or if so
        much of it changed that reads are better off for it. Datasets whose inputs
        did not change are carried over; the header fact and the daily KPIs are moved
        by the changes since the last publication if less than ``threshold`` of their
        inputs changed, else rebuilt.
        """
        held = [t for t in self.registry if ap.contents(self.spark, self.root, t) is not None]
        self.maybe_compact(held)
        datasets = self.gold(calendar)
        return publish.publish(self.spark, self.root, datasets, list(names or datasets), threshold)

    def read_gold(self, name: str, version: int | None = None) -> DataFrame:
        return publish.read(self.spark, self.root, name, version)

    # retention -------------------------------------------------------------
    def expire(self, older_than_seconds: float, tables: Iterable[str] | None = None) -> dict[str, dict[str, int]]:
        """Remove batches, slots and versions that only manifest versions of that age refer to (``apply.expire``)."""
        names = list(tables or [*self.registry, twin.TWIN, *[history.history_name(t) for t in self.registry]])
        return {t: ap.expire(self.spark, self.root, t, older_than_seconds) for t in names if ap.contents(self.spark, self.root, t) is not None}
