"""Repeated passages, by MinHash bands over paragraphs that the content itself delimits.

A paragraph begins at a word whose hash is the least of all WINDOW word pairs in
a row, so the cuts inside a passage are the same wherever the passage stands, in
the middle of a line as well. MinHash bands are tuned for the wanted recall,
paragraphs that share a band are compared exactly (Jaccard of their word
shingles), and components of similar paragraphs decide: the smallest document of
a component keeps its paragraph, the others may lose theirs. Only runs of such
paragraphs of at least `least_words` words are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import bounded_batches, ints, materialise
from siltstone.llm.jaccard_join import FILTER_IDS, linked, sketch
from siltstone.llm.text import Words, buffers, code_points_before, mix, owners, slices

#: Word pairs that a cut is the least of: any run of 2 * WINDOW words or so holds a whole paragraph.
WINDOW = 24
SHINGLE = 5


def tuned_bands(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows) of the fewest hashes, at least two rows, that find a pair at the threshold with the wanted chance."""
    choices = [(b * r, -r, b, r) for r in range(2, 9) for b in range(1, 65) if 1 - (1 - threshold**r) ** b >= recall]
    _, _, b, r = min(choices)
    return b, r


def _cuts(words: Words) -> np.ndarray:
    """First word of each paragraph; every text begins one."""
    n = len(words.hashes)
    if not n:
        return np.zeros(0, np.int64)
    pairs = words.hashes.copy()
    pairs[:-1] = mix(words.hashes[:-1] * np.uint64(3) + words.hashes[1:])
    first = np.zeros(n, bool)
    first[words.first[:-1][words.counts() > 0]] = True
    if n >= WINDOW:
        least = np.lib.stride_tricks.sliding_window_view(pairs, WINDOW).argmin(axis=1) + np.arange(n - WINDOW + 1)
        owner = owners(words.first, np.arange(n))
        inside = owner[: n - WINDOW + 1] == owner[WINDOW - 1 :]
        first[least[inside]] = True
    cuts = np.flatnonzero(first)
    begins = np.zeros(n, bool)
    begins[words.first[:-1][words.counts() > 0]] = True
    # A cut less than SHINGLE words after the last one is none, as in runs of one word.
    close = np.flatnonzero((np.diff(cuts) < SHINGLE) & ~begins[cuts[1:]]) + 1
    if not len(close):
        return cuts
    keep = np.ones(len(cuts), bool)
    positions = cuts.tolist()
    for i in close.tolist():
        at = i - 1
        while not keep[at]:
            at -= 1
        keep[i] = positions[i] - positions[at] >= SHINGLE
    return cuts[keep]


class Paragraphs:
    """Paragraphs of some texts with at least SHINGLE words: words, ids and shingles."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.words = Words(data, bounds)
        cuts = _cuts(self.words)
        ends = np.append(cuts[1:], len(self.words.hashes))
        self.text = owners(self.words.first, cuts)
        self.number = np.arange(len(cuts)) - np.searchsorted(self.text, self.text)
        long_ = ends - cuts >= SHINGLE
        self.low, self.high, self.text, self.number = cuts[long_], ends[long_], self.text[long_], self.number[long_]
        shingles, at = self.words.shingles(SHINGLE)
        # Shingles that begin and end in the same paragraph.
        begin = np.searchsorted(at, self.low)
        finish = np.searchsorted(at, self.high - SHINGLE, "right")
        self.counts = finish - begin
        take = np.repeat(begin - np.cumsum(self.counts) + self.counts, self.counts) + np.arange(self.counts.sum())
        self.shingles = shingles[take]
        self.begin = np.cumsum(self.counts) - self.counts
        self.ids = self._ids()

    def _ids(self) -> np.ndarray:
        """One hash for each sequence of words."""
        if not len(self.low):
            return np.zeros(0, np.int64)
        place = np.arange(len(self.shingles)) - np.repeat(self.begin, self.counts)
        sums = np.add.reduceat(mix(self.shingles + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), self.begin)
        return mix(sums + self.counts.astype(np.uint64)).view(np.int64)

    def bands(self, bands: int, rows: int) -> list[np.ndarray]:
        out = []
        for b in range(bands):
            key = np.full(len(self.low), b + 1, np.uint64)
            for r in range(rows):
                seed = np.uint64((b * rows + r + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))
                key = mix(key + np.minimum.reduceat(mix(self.shingles ^ seed), self.begin)) if len(self.low) else key
            out.append(key.view(np.int64))
        return out


def _map(docs: DataFrame, columns: list[str], schema: str, f) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            data, bounds = buffers(batch.column(len(columns) - 1))
            for low, high in slices(bounds):
                own, at = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
                out = f(batch, low, own, at, Paragraphs(own, at), seen)
                if out is not None:
                    yield pa.RecordBatch.from_pydict(out)

    return docs.select(*columns).mapInArrow(run, schema)


def _fresh(ids: np.ndarray, seen: set[int]) -> np.ndarray:
    """Places of ids that this task hasn't met."""
    _, one = np.unique(ids, return_index=True)
    new = [i for i in one.tolist() if (x := int(ids[i])) not in seen and not seen.add(x)]
    return np.array(sorted(new), np.int64)


def _places(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Every paragraph: key, number, words, span in code points, id."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batch, low, own, at, p, _):
        if not len(p.low):
            return None
        points = code_points_before(own)
        origin = points[at[p.text]]
        return {"key": batch.column(0).take(pa.array(low + p.text)), "number": ints(p.number), "words": pa.array((p.high - p.low).astype(np.int32)),
                "start": ints(points[p.words.starts[p.low]] - origin), "end": ints(points[p.words.ends[p.high - 1]] - origin), "c": ints(p.ids)}

    return _map(docs, [key, text], f"key {kind}, number long, words int, start long, end long, c long", rows)


def _banded(docs: DataFrame, text: str, bands: int, rows_: int) -> DataFrame:
    def rows(batch, low, own, at, p, seen):
        new = _fresh(p.ids, seen)
        if not len(new):
            return None
        keys = p.bands(bands, rows_)
        return {"token": ints(np.concatenate([k[new] for k in keys])), "c": ints(np.tile(p.ids[new], bands))}

    return _map(docs, [text], "token long, c long", rows)


def _shingle_sets(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    few = wanted.count() <= FILTER_IDS
    ids = np.sort(wanted.select("c").toArrow().column("c").to_numpy()) if few else None
    shared = docs.sparkSession.sparkContext.broadcast(ids)

    def rows(batch, low, own, at, p, seen):
        new = np.arange(len(p.ids))
        keep = shared.value
        if keep is not None:
            spot = np.minimum(np.searchsorted(keep, p.ids), max(len(keep) - 1, 0))
            new = np.flatnonzero(keep[spot] == p.ids) if len(keep) else new[:0]
        new = new[_fresh(p.ids[new], seen)] if len(new) else new
        if not len(new):
            return None
        sets = [np.unique(p.shingles[p.begin[i] : p.begin[i] + p.counts[i]]) for i in new]
        return {"c": ints(p.ids[new]), "n": ints([len(s) for s in sets]), "own": pa.array([s.tobytes() for s in sets], pa.binary()),
                "sketch": pa.array([sketch(s) for s in sets], pa.binary())}

    sets = _map(docs, [text], "c long, n long, own binary, sketch binary", rows)
    if not few:
        sets = sets.join(wanted.select("c"), "c", "left_semi")
    return materialise(sets.dropDuplicates(["c"]), "paragraph-sets")


def repeated_passages(docs: DataFrame, threshold: float = 0.8, recall: float = 0.98, least_words: int = 18, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, end, words, cluster_id, removed) of each passage that other documents have too.

    Spans are code points of the whole text. `cluster_id` is the smallest key of
    the passage's components; the document of that key keeps its copy (`removed` is
    false), the others lose theirs. A passage repeated inside one document alone is
    not reported. Null and empty texts have none; rows with a null key take no part;
    repeated rows count as one document.
    """
    bands, rows = tuned_bands(threshold, recall)
    docs = docs.where(F.col(key).isNotNull())
    entries = _banded(docs, text, bands, rows).repartition("token")
    common = entries.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    lists = entries.join(common.select("token"), "token").dropDuplicates(["token", "c"])
    lists = materialise(lists.select("token", "c"), "bands")
    sets = _shingle_sets(docs, lists.select("c").distinct(), text)
    lists = materialise(lists.join(sets.select("c", "n"), "c").withColumns({"matches": F.lit(1), "weight": F.col("n")}), "lists")
    percent = round(100 * threshold)

    def compare(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("c").alias("a"), F.col("own").alias("x"))
        right = sets.select(F.col("c").alias("b"), F.col("own").alias("y"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                if any(ok):
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

        return materialise(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "alike")

    roots = materialise(linked(lists, percent, compare, sets.select("c", "sketch")), "components")
    places = materialise(_places(docs, key, text), "paragraphs")
    seen = places.groupBy("c").agg(F.min("key").alias("low"), F.max("key").alias("high")).join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    many = seen.join(roots.select(F.col("root")).distinct().withColumn("linked", F.lit(True)), "root", "left").where(F.col("linked") | (F.col("low") != F.col("high")))
    many = materialise(many.select("c", "root", "low", "high"), "repeats")
    groups = many.groupBy("root").agg(F.min("low").alias("keeper"), F.max("high").alias("last")).where("keeper <> last").select("root", "keeper")
    marked = materialise(many.join(groups, "root").select("c", "keeper"), "keepers")
    found = places.join(marked, "c").distinct().withColumn("removed", F.col("key") != F.col("keeper"))
    by_text = Window.partitionBy("key", "removed").orderBy("number")
    runs = found.withColumn("_run", F.col("number") - F.row_number().over(by_text))  # numbers in a row have one difference
    passages = runs.groupBy("key", "removed", "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").cast("long").alias("words"), F.min("keeper").alias("cluster_id"),
    )
    return passages.where(F.col("words") >= least_words).select(F.col("key").alias(key), "start", "end", "words", "cluster_id", "removed")
