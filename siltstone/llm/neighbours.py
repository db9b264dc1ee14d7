"""Nearest neighbours by cosine with a vantage-point tree for each shard.

Distances are chords between unit vectors, sqrt(2 - 2 cos), a metric that ranks
as the cosine does. A tree splits its vectors at the median distance to a vantage
point; a side is passed over if the triangle inequality, with its bound taken
`factor` times, says that nothing nearer is there. Factor 1 is exact search; a
larger one prunes more and may miss neighbours.

Equal vectors are one entry of the tree with their smallest ids, as many as an
answer can hold, so a vector that a third of all rows share is one entry too.
Trees are rows of an index table; queries come in blocks, and each block meets
each tree once. Only the best few of each meeting are shuffled.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import bounded_batches, materialise

LEAF = 64
#: Queries handled at once.
BLOCK = 512


def usable(vector: str) -> Column:
    """Vectors that are not null, empty or zero and hold only finite numbers."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the squares of very large or small numbers stay finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def build_tree(vectors: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes as rows (vantage vector or -1, median distance, children or -1, first and last place in `order`)."""
    unit, order, nodes = _unit(vectors), np.arange(len(vectors)), []
    random = np.random.default_rng(7)

    def split(low: int, high: int) -> int:
        me = len(nodes)
        nodes.append([-1.0, 0.0, -1.0, -1.0, float(low), float(high)])
        if high - low > LEAF:
            pick = low + int(random.integers(high - low))
            order[[low, pick]] = order[[pick, low]]
            rest = order[low + 1 : high]
            far = np.sqrt(np.maximum(0.0, 2 - 2 * unit[rest] @ unit[order[low]]))
            middle = len(rest) // 2
            ranks = np.argpartition(far, middle)
            order[low + 1 : high] = rest[ranks]
            nodes[me][0], nodes[me][1] = float(order[low]), float(far[ranks[middle]])
            nodes[me][2] = split(low + 1, low + 1 + middle)
            nodes[me][3] = split(low + 1 + middle, high)
        return me

    if len(vectors):
        split(0, len(vectors))
    return {"vectors": vectors, "order": order, "nodes": np.array(nodes, np.float64).reshape(-1, 6)}


class Search:
    """The `keep` nearest vectors of one tree for each of some queries."""

    def __init__(self, tree: dict[str, np.ndarray], least_ids: np.ndarray, queries: np.ndarray, keep: int, factor: float):
        self.nodes, self.order, self.factor = tree["nodes"], tree["order"], factor
        self.unit, self.queries, self.ids = _unit(tree["vectors"]), _unit(queries), least_ids
        self.far = np.full((len(queries), keep), np.inf)
        self.at = np.full((len(queries), keep), -1, np.int64)
        self.visited = 0
        if len(self.nodes):
            self.visit(0, np.arange(len(queries)))

    def offer(self, who: np.ndarray, entries: np.ndarray, far: np.ndarray) -> None:
        keep = self.far.shape[1]
        some = np.flatnonzero(far.min(axis=1) <= self.far[who, -1])
        if not len(some):
            return
        who, far = who[some], far[some]
        all_far = np.concatenate([self.far[who], far], axis=1)
        all_at = np.concatenate([self.at[who], np.broadcast_to(entries, far.shape)], axis=1)
        ids = np.where(all_at >= 0, self.ids[all_at], np.iinfo(np.int64).max)
        rank = np.lexsort((ids, all_far), axis=1)[:, :keep]
        self.far[who], self.at[who] = np.take_along_axis(all_far, rank, 1), np.take_along_axis(all_at, rank, 1)

    def distances(self, who: np.ndarray, entries: np.ndarray) -> np.ndarray:
        self.visited += len(who) * len(entries)
        return np.sqrt(np.maximum(0.0, 2 - 2 * self.queries[who] @ self.unit[entries].T))

    def visit(self, node: int, who: np.ndarray) -> None:
        if not len(who):
            return
        vantage, middle, inner, outer, low, high = self.nodes[node]
        if vantage < 0:
            entries = self.order[int(low) : int(high)]
            self.offer(who, entries, self.distances(who, entries))
            return
        entry = np.array([int(vantage)])
        far = self.distances(who, entry)
        self.offer(who, entry, far)
        far = far[:, 0]
        inside = far <= middle
        self.visit(int(inner), who[inside])
        self.visit(int(outer), who[~inside])
        rest = self.factor * np.abs(far - middle) <= self.far[who, -1] + 1e-9
        self.visit(int(outer), who[inside & rest])
        self.visit(int(inner), who[~inside & rest])


def build_index(vectors: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", shard_rows: int = 8192) -> DataFrame:
    """One row for each shard: dim, shard and its tree. Every usable vector is in it; shards have about `shard_rows` entries."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    # k of them and the query's own; each task passes on no more than that of a vector
    entries = rows.distinct().withColumn("r", first).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = materialise(entries, "vectors")
    shards = max(1, -(-entries.count() // shard_rows))

    def build(table: pa.Table) -> pa.Table:
        vs = np.array(table.column("v").to_pylist(), np.float64)
        lists = table.column("ids").to_pylist()
        ids = np.full((len(lists), k + 1), -1, np.int64)
        for i, own in enumerate(lists):
            ids[i, : len(own)] = own
        return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "tree": pa.array([_pack(ids=ids, **build_tree(vs))], pa.binary())})

    placed = entries.withColumns({"dim": F.size("v"), "shard": F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")})
    return materialise(placed.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary"), "trees")


def search(index: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each query, itself left out, ties to the smaller id.

    Vectors that are null, empty, zero or not finite take no part, nor rows with a
    null id; a query meets vectors of its own length only. Rows repeated with their
    id count once. The score is the cosine in double precision.
    """
    bounded_batches(queries.sparkSession)
    rows = queries.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).distinct()
    blocks = max(1, -(-rows.count() // BLOCK))
    blocked = rows.withColumns({"dim": F.size("v"), "block": F.pmod(F.xxhash64("id"), F.lit(blocks))})

    def gather(table: pa.Table) -> pa.Table:
        packed = _pack(ids=table.column("id").to_numpy(), v=np.array(table.column("v").to_pylist(), np.float64))
        return pa.table({"dim": table.column("dim")[:1], "block": table.column("block")[:1], "queries": pa.array([packed], pa.binary())})

    asked = blocked.groupBy("dim", "block").applyInArrow(gather, "dim int, block long, queries binary")
    trees = index.select("dim", "shard")
    meetings = asked.join(trees, "dim").join(index, ["dim", "shard"])  # each block of the stated queries with each tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, packed_tree in zip(batch.column("queries"), batch.column("tree")):
                asked, tree = np.load(io.BytesIO(packed.as_py())), dict(np.load(io.BytesIO(packed_tree.as_py())))
                ids, qs = asked["ids"], asked["v"]
                hits = Search(tree, tree["ids"][:, 0], qs, k + 1, factor).at
                who, place = np.nonzero(hits >= 0)
                entry = hits[who, place]
                a, b = qs[who], tree["vectors"][entry]
                dots = np.einsum("ij,ij->i", a, b)
                score = dots / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
                odd = ~np.isfinite(score)  # squares out of range
                score[odd] = np.einsum("ij,ij->i", _unit(a[odd]), _unit(b[odd]))
                them = tree["ids"][entry]
                mine = np.broadcast_to(ids[who][:, None], them.shape)
                ok = (them >= 0) & (them != mine)
                scores = np.broadcast_to(score[:, None], them.shape)
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(mine[ok]), "vec_id": pa.array(them[ok]), "score": pa.array(scores[ok])})

    found = meetings.select("queries", "tree").mapInArrow(run, "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
