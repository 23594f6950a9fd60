"""Exact top-k by inner product, with a three-phase uniform threshold.

Vectors are split into ``LISTS`` runs of components; a list holds one run of every
vector and knows only its own part of a score.

1. Every list names each query's best few candidates by partial score. Their
   whole scores give a safe cutoff: no candidate below it can be among the best.
2. A candidate that reaches the cutoff must reach a uniform share of it, cutoff /
   lists, in at least one list. Each list collects the entries that do.
3. The lists add up the whole scores of what was collected.

Queries and candidates come in blocks; a pair of blocks of one list is one unit
of work, so all of it is spread evenly whatever the vectors are. Equal vectors are
folded into one first and only their smallest ids kept, which decide ties.

Defined cases: vectors that are null, or hold null, NaN or an infinity, take no
part; only vectors of the same length meet; a null id is left out; rows that
repeat an id are one candidate for each different vector; scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, text_key

LISTS = 2
QUERY_BLOCK, BLOCK = 512, 2048
_LOWEST = -(1 << 60)


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vec): every usable vector with each component as floor(scale * component)."""
    fine = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return usable.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"))


def folded(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(node, dim, vec, first, asked) for every different vector, and (node, vec_id) with its k + 1 smallest ids."""
    keyed = vectors.withColumn("key", text_key(F.concat_ws(",", "vec")))
    nodes = keyed.groupBy("key").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("first"), F.max("asked").alias("asked"))
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("node"), "key", F.size("vec").alias("dim"), "vec", "first", "asked"), "vectors")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    ids = keyed.select("key", "vec_id").distinct().withColumn("r", rank).where(F.col("r") <= k + 1)
    return nodes, ids.join(nodes.select("key", "node"), "key").select("node", "vec_id")


def _blocks(nodes: DataFrame, size: int, name: str) -> DataFrame:
    """(dim, list, ``name``, nodes, parts): nodes in blocks of about ``size``, a row for each list."""
    many = F.ceil(F.col("all") / size).cast("int")
    counts = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("all"))
    placed = nodes.join(counts, "dim").withColumn(name, F.pmod(F.hash("node"), many))
    cut = [F.floor(F.col("dim") * i / LISTS).cast("int") for i in range(LISTS + 1)]
    lists = F.array(*[F.struct(F.lit(i).alias("list"), F.slice("vec", cut[i] + 1, cut[i + 1] - cut[i]).alias("part")) for i in range(LISTS)])
    rows = placed.select("dim", name, "node", F.explode(lists).alias("l")).select("dim", "l.list", name, "node", "l.part")
    packed = rows.groupBy("dim", "list", name).agg(F.array_sort(F.collect_list(F.struct("node", "part"))).alias("rows"))
    return packed.select("dim", "list", name, F.col("rows.node").alias("nodes"), F.flatten("rows.part").alias("parts"))


def _matrix(batch: pa.RecordBatch, i: int, side: str) -> tuple[np.ndarray, np.ndarray]:
    nodes = batch.column(f"{side}_nodes")[i].values.to_numpy(zero_copy_only=False)
    parts = batch.column(f"{side}_parts")[i].values.to_numpy(zero_copy_only=False)
    return nodes, parts.reshape(len(nodes), -1)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """q @ c.T, exact: in floating point where no sum can leave its integers, else in 64-bit integers."""
    if q.size and c.size and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


_ENTRIES = "dim int, q_block int, c_block int, list int, q_at array<int>, c_at array<int>, score array<long>"
_ENTRY_FIELDS = pa.schema(
    [("dim", pa.int32()), ("q_block", pa.int32()), ("c_block", pa.int32()), ("list", pa.int32())]
    + [("q_at", pa.list_(pa.int32())), ("c_at", pa.list_(pa.int32())), ("score", pa.list_(pa.int64()))]
)


def _entries(batch: pa.RecordBatch, i: int, q_at: np.ndarray, c_at: np.ndarray, score: np.ndarray) -> list:
    return [*(batch.column(n)[i].as_py() for n in ("dim", "q_block", "c_block", "list")), q_at.astype(np.int32), c_at.astype(np.int32), score]


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ENTRY_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ENTRY_FIELDS)], schema=_ENTRY_FIELDS)


def _local_best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                s = _products(_matrix(batch, i, "q")[1], _matrix(batch, i, "c")[1])
                n = min(k, s.shape[1])
                top = np.argpartition(-s, n - 1, axis=1)[:, :n]
                q_at = np.repeat(np.arange(len(s)), n)
                rows.append(_entries(batch, i, q_at, top.ravel(), s[q_at, top.ravel()]))
            yield _batch(rows)

    return run


def _reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            s = _products(_matrix(batch, i, "q")[1], _matrix(batch, i, "c")[1])
            cut = batch.column("cutoffs")[i].values.to_numpy(zero_copy_only=False)
            # s * LISTS >= cutoff, without leaving 64 bits
            q_at, c_at = np.nonzero(s >= -((-cut) // LISTS)[:, None])
            rows.append(_entries(batch, i, q_at, c_at, s[q_at, c_at]))
        yield _batch(rows)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        q_all, c_all, s_all = [], [], []
        for i in range(batch.num_rows):
            (q_nodes, q), (c_nodes, c) = _matrix(batch, i, "q"), _matrix(batch, i, "c")
            at = np.unique(
                batch.column("q_at")[i].values.to_numpy(zero_copy_only=False).astype(np.int64) * len(c_nodes)
                + batch.column("c_at")[i].values.to_numpy(zero_copy_only=False)
            )
            q_at, c_at = at // max(1, len(c_nodes)), at % max(1, len(c_nodes))
            q_all.append(q_nodes[q_at])
            c_all.append(c_nodes[c_at])
            s_all.append(np.concatenate([(q[q_at[j : j + 65536]] * c[c_at[j : j + 65536]]).sum(axis=1) for j in range(0, len(at), 65536)] or [np.empty(0, np.int64)]))
        made = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (q_all, c_all, s_all)]
        yield pa.RecordBatch.from_arrays(made, ["q", "c", "part"])


def top_k(vectors: DataFrame, asked, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``asked`` (a condition on it) selects, the ``k`` best other rows."""
    ship(vectors.sparkSession)
    rows = integer_vectors(vectors, scale)
    rows = rows.withColumn("asked", asked)
    nodes, ids = folded(rows, k)
    nodes_small = nodes.select("node", "first")
    c_blocks = stored(_blocks(nodes, BLOCK, "c_block"), "candidate-blocks")
    q_blocks = stored(_blocks(nodes.where("asked"), QUERY_BLOCK, "q_block"), "query-blocks")
    q_side = q_blocks.withColumnsRenamed({"nodes": "q_nodes", "parts": "q_parts"})
    c_side = c_blocks.withColumnsRenamed({"nodes": "c_nodes", "parts": "c_parts"})
    # which blocks meet; each row of it is one unit of work
    units = q_blocks.select("dim", "q_block").distinct().join(c_blocks.select("dim", "c_block").distinct(), "dim")
    pairs = units.join(q_side, ["dim", "q_block"]).join(c_side, ["dim", "c_block", "list"])

    def whole_scores(entries: DataFrame) -> DataFrame:
        wanted = entries.groupBy("dim", "q_block", "c_block").agg(F.flatten(F.collect_list("q_at")).alias("q_at"), F.flatten(F.collect_list("c_at")).alias("c_at"))
        parts = pairs.join(wanted, ["dim", "q_block", "c_block"]).select("q_nodes", "q_parts", "c_nodes", "c_parts", "q_at", "c_at")
        return parts.mapInArrow(_resolve, "q long, c long, part long").groupBy("q", "c").agg(F.sum("part").alias("score"))

    # phase 1: the lists' own best, and the cutoff from their whole scores
    best = stored(pairs.mapInArrow(_local_best(k + 1), _ENTRIES), "local-best")
    each = best.select("dim", "q_block", "c_block", "list", F.explode(F.arrays_zip("q_at", "c_at", "score")).alias("e")).select("dim", "q_block", "c_block", "list", "e.*")
    rank = F.row_number().over(Window.partitionBy("dim", "q_block", "q_at", "list").orderBy(F.desc("score")))
    each = each.withColumn("r", rank).where(F.col("r") <= k + 1)
    each = each.groupBy("dim", "q_block", "c_block").agg(F.collect_list("q_at").alias("q_at"), F.collect_list("c_at").alias("c_at"))
    scored = whole_scores(each)
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    cutoff = scored.withColumn("r", nth).where(F.col("r") == k + 1).select(F.col("q").alias("node"), F.col("score").alias("cutoff"))
    asked_nodes = q_blocks.where("list = 0").select("dim", "q_block", F.explode("nodes").alias("node"))
    cutoff = asked_nodes.join(cutoff, "node", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(_LOWEST)))
    cutoff = cutoff.groupBy("dim", "q_block").agg(F.array_sort(F.collect_list(F.struct("node", "cutoff"))).alias("c"))
    cutoff = stored(cutoff.select("dim", "q_block", F.col("c.cutoff").alias("cutoffs")), "cutoffs")

    # phases 2 and 3: all that reaches its share of the cutoff, with whole scores
    enough = stored(pairs.join(cutoff, ["dim", "q_block"]).mapInArrow(_reaching, _ENTRIES), "entries")
    scored = whole_scores(enough).join(nodes_small.withColumnRenamed("node", "c"), "c")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))
    winners = scored.withColumn("r", order).where(F.col("r") <= k + 1).select("q", "c", "score")

    # back to ids
    found = winners.join(ids.withColumnRenamed("node", "c"), "c").select("q", "vec_id", "score")
    queries = rows.where("asked").select(F.col("vec_id").alias("query_id"), text_key(F.concat_ws(",", "vec")).alias("key")).distinct()
    queries = queries.join(nodes.select("key", F.col("node").alias("q")), "key").select("query_id", "q")
    found = queries.join(found, "q").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
