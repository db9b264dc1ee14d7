"""Exact top-k by inner product with vector-approximation files.

Vectors are turned into whole numbers and dealt out to pages. A page holds, beside
the exact vectors, an approximation file: for each component the number of its
cell among cells of about equal population. The ends of the cells bound the inner
product of a query with every vector of the page from both sides. The search scans
these bounds, keeps what may be among the best, and reads exact vectors in order
of their bounds until the kth result is certain.

Pages are written once. Queries come in blocks, and each block meets each page (a
stated set of queries against all rows): a task reads some pages from the shared
folder and a block of about PAGE_QUERIES queries from the tasks that made it.
Neither goes through the driver, and no copies are written. A page passes on no
more than k results of a query.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.centroids import checked, finite, matrix
from siltstone.llm.frames import bounded_batches, ints, materialise, release

#: Vectors of a page, about, and queries of a block.
PAGE_ROWS, PAGE_QUERIES = 16_384, 4_096
#: Cells of a component.
CELLS = 32
#: Queries that meet a page at once, and exact vectors read at once.
QUERIES, READS = 128, 32_768
#: Room for rounding in bounds, as a part of the product of lengths.
ROUNDING = 1e-12


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def approximate(vectors: np.ndarray, cells: int = CELLS) -> dict[str, np.ndarray]:
    """The approximation file of some vectors: codes, and the least and greatest component in each cell."""
    n, dim = vectors.shape
    codes = np.zeros((n, dim), np.uint8)
    low, high = np.zeros((dim, cells), np.int64), np.zeros((dim, cells), np.int64)
    for d in range(dim):
        column = vectors[:, d]
        edges = np.sort(column)[np.arange(1, cells) * n // cells]
        codes[:, d] = np.searchsorted(edges, column, "right")
        low[d], high[d] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        np.minimum.at(low[d], codes[:, d], column)
        np.maximum.at(high[d], codes[:, d], column)
    return {"codes": codes, "low": low, "high": high}


class Page:
    """The `keep` best vectors of a page for each of some queries.

    `order` breaks ties, smaller first. `read` counts exact vectors read.
    """

    def __init__(self, vectors: np.ndarray, codes: np.ndarray, low: np.ndarray, high: np.ndarray, order: np.ndarray):
        self.vectors, self.order, self.read = vectors, order, 0
        at = np.arange(vectors.shape[1])
        a, b = low[at, codes].astype(np.float64), high[at, codes].astype(np.float64)
        self.centre, self.half = (a + b) / 2, (b - a) / 2
        self.longest = np.sqrt(np.einsum("ij,ij->i", self.centre, self.centre).max(initial=0.0)) + np.sqrt(np.einsum("ij,ij->i", self.half, self.half).max(initial=0.0))

    def exact(self, queries: np.ndarray, who: np.ndarray, entries: np.ndarray) -> np.ndarray:
        self.read += len(who)
        out = np.empty(len(who), np.int64)
        for at in range(0, len(who), READS):
            part = slice(at, at + READS)
            out[part] = np.einsum("ij,ij->i", queries[who[part]], self.vectors[entries[part]])
        return out

    def best(self, queries: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, score) of the best entries, by query, score downwards and tie order."""
        keep = min(keep, len(self.vectors))
        q = queries.astype(np.float64)
        middle, spread = q @ self.centre.T, np.abs(q) @ self.half.T
        spread += (ROUNDING * self.longest * np.sqrt(np.einsum("ij,ij->i", q, q)))[:, None]
        upper, lower = middle + spread, middle - spread
        # `keep` vectors score at least this much, so lower upper bounds are out
        certain = np.partition(lower, lower.shape[1] - keep, axis=1)[:, lower.shape[1] - keep]
        who, entries = np.nonzero(upper >= certain[:, None])
        bound = upper[who, entries]
        rank = np.lexsort((-bound, who))
        who, entries, bound = who[rank], entries[rank], bound[rank]
        place = np.arange(len(who)) - np.searchsorted(who, who)  # in its query's order of bounds
        found = [np.zeros(0, np.int64)] * 3
        done, wave = 0, keep
        while len(who):
            now = place < done + wave
            fresh = (who[now], entries[now], self.exact(queries, who[now], entries[now]))
            found = [np.concatenate(x) for x in zip(found, fresh)]
            rank = np.lexsort((self.order[found[1]], -found[2], found[0]))
            rank = rank[np.arange(len(rank)) - np.searchsorted(found[0][rank], found[0][rank]) < keep]
            found = [x[rank] for x in found]
            last = np.full(len(queries), -np.inf)
            many = np.bincount(found[0], minlength=len(queries))
            full = np.flatnonzero(many == keep)
            last[full] = found[2][np.cumsum(many)[full] - 1]
            rest = ~now & (bound >= last[who])  # the kth result is certain once no bound reaches it
            who, entries, bound, place = who[rest], entries[rest], bound[rest], place[rest]
            done, wave = done + wave, 2 * wave
        return tuple(found)


def _rows(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id and floor(scale * x) of the vectors that take part; rows equal in both come once."""
    some = vectors.where(finite(vector) & F.col(key).isNotNull())
    floors = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale))
    return some.select(F.col(key).cast("long").alias("id"), floors.alias("v")).distinct()


def _spread(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """`rows` with `dim` and a `part` of about `size` rows, and how many parts; equal vectors are spread by their ids."""
    parts = max(1, -(-rows.count() // size))
    return rows.withColumns({"dim": F.size("v"), "part": F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int")}), parts


def build_files(vectors: DataFrame, k: int, scale: int = 64, key: str = "vec_id", vector: str = "embedding", page_rows: int = PAGE_ROWS) -> DataFrame:
    """One row for each page: dim, page, and its exact vectors with their approximation file."""
    bounded_batches(vectors.sparkSession)
    placed, _ = _spread(materialise(_rows(vectors, key, vector, scale), "vectors"), page_rows)

    def pack(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        x, ids = checked(matrix(table.column("v"), dim)), table.column("id").to_numpy()
        # Equal vectors are one entry with the k + 1 smallest ids; no answer holds more of them.
        rank = np.lexsort((ids, *x.T[::-1]))
        x, ids = x[rank], ids[rank]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        entry = np.cumsum(new) - 1
        few = np.arange(len(x)) - first[entry] <= k
        bounds = np.searchsorted(entry[few], np.arange(len(first) + 1))
        packed = _pack(vectors=x[first].astype(np.int32), ids=ids[few], bounds=bounds, **approximate(x[first]))
        return pa.table({"dim": table.column("dim")[:1], "page": table.column("part")[:1], "file": pa.array([packed], pa.binary())})

    return materialise(placed.groupBy("dim", "part").applyInArrow(pack, "dim int, page int, file binary"), "pages")


def search(files: DataFrame, queries: DataFrame, k: int, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each query, itself left out, ties to the smaller id.

    Components are floor(`scale` * x). Null vectors, those with null or non-finite
    components and rows with a null id take no part; a zero vector does. Rows
    repeated with their id count once; under one id, different vectors are rows of
    their own, as queries and as results. A query meets vectors of its own length;
    with fewer than k of them it gets all. Empty tables give no rows. Components
    too large for 64-bit products raise an error (`centroids.checked`).
    """
    bounded_batches(queries.sparkSession)
    asked, blocks = _spread(materialise(_rows(queries, key, vector, scale), "queries"), PAGE_QUERIES)

    def gather(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        packed = _pack(ids=table.column("id").to_numpy(), v=checked(matrix(table.column("v"), dim)), names=table.column("q").to_numpy())
        return pa.table({"dim": table.column("dim")[:1], "block": table.column("part")[:1], "queries": pa.array([packed], pa.binary())})

    blocked = asked.withColumn("q", F.xxhash64("v")).groupBy("dim", "part").applyInArrow(gather, "dim int, block int, queries binary")
    # Spark takes a block for a row of about a hundred bytes; left to itself, it broadcasts the blocks by way of the driver.
    meetings = files.join(blocked.repartition(blocks, "dim", "block").hint("shuffle_replicate_nl"), "dim")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for packed, file in zip(batch.column("queries"), batch.column("file")):
                asked, held = np.load(io.BytesIO(packed.as_py())), np.load(io.BytesIO(file.as_py()))
                x, ids, bounds = held["vectors"].astype(np.int64), held["ids"], held["bounds"]
                page = Page(x, held["codes"], held["low"], held["high"], ids[bounds[:-1]])
                for at in range(0, len(asked["ids"]), QUERIES):
                    mine, q, names = (asked[c][at : at + QUERIES] for c in ("ids", "v", "names"))
                    # One more than k entries: any entry but the query's own gives a result.
                    who, entry, score = page.best(q, k + 1)
                    many = bounds[entry + 1] - bounds[entry]
                    copy = np.repeat(np.arange(len(who)), many)
                    them = ids[np.arange(len(copy)) - np.repeat(np.cumsum(many) - many, many) + bounds[entry][copy]]
                    who, entry, score = who[copy], entry[copy], score[copy]
                    own = them == mine[who]
                    own[own] = (x[entry[own]] == q[who[own]]).all(axis=1)
                    who, them, score = who[~own], them[~own], score[~own]
                    rank = np.lexsort((them, -score, who))
                    rank = rank[np.arange(len(rank)) - np.searchsorted(who[rank], who[rank]) < k]
                    who = who[rank]
                    yield pa.RecordBatch.from_pydict({"query_id": ints(mine[who]), "q": ints(names[who]), "vec_id": ints(them[rank]), "score": ints(score[rank])})

    found = meetings.select("queries", "file").mapInArrow(run, "query_id long, q long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
