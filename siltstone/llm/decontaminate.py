"""Benchmark passages in documents, by SimHash of windows of the items' sizes.

For every item length, windows of as many words slide over the document. The
SimHash of a window adds up its weighted word shingles. An index cuts the 64 bits
into four blocks; fingerprints within RADIUS bits agree in some block up to
RADIUS // 4 bits, so looking at all block values within that distance finds every
item fingerprint within the radius. Candidates are compared exactly: weighted
Jaccard of the shingles of window and item.

Windows are formed only around words where some item's shingle stands. Elsewhere
no shingle is shared and the exact similarity is zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import bounded_batches, release
from siltstone.llm.pii import TrimmedWords
from siltstone.llm.text import SLICE, buffers, code_points_before, fold_case, slices

#: Words in a shingle; bits that fingerprints may differ in.
SHINGLE, RADIUS = 5, 15
#: Items in one index; more are searched for in further passes.
ITEMS = 20_000


def _near(block: int) -> np.ndarray:
    """The 16-bit values within RADIUS // 4 bits of `block`."""
    masks = [0] + [sum(1 << b for b in bits) for r in range(1, RADIUS // 4 + 1) for bits in combinations(range(16), r)]
    return np.array(masks, np.uint32) ^ np.uint32(block)


class Items:
    """Index of benchmark items: weights of their shingles, and fingerprints by length."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, bounds = buffers(pa.array(texts, pa.string()))
        words = TrimmedWords(fold_case(data), bounds)
        shingles, at = words.shingles(SHINGLE)
        edges = np.searchsorted(at, words.first)
        self.sets = {}
        lengths: dict[int, list[int]] = {}
        for i, n in enumerate(words.counts()):
            if n >= SHINGLE:  # shorter items can't be told from common wording
                self.sets[ids[i]] = shingles[edges[i] : edges[i + 1]]
                lengths.setdefault(int(n), []).append(ids[i])
        distinct = [np.unique(s) for s in self.sets.values()]
        self.known, df = np.unique(np.concatenate(distinct), return_counts=True) if distinct else (np.zeros(0, np.uint64), np.zeros(0))
        self.weights = np.log(1 + len(distinct) / np.maximum(df, 1)).astype(np.float32)
        self.unknown = np.float32(np.log(1 + len(distinct)))
        self.by_length = {}
        for n, own in sorted(lengths.items()):
            prints = np.concatenate([self.fingerprints(self.sets[i], n - SHINGLE + 1) for i in own])
            near = np.zeros((4, 1 << 16), bool)
            for p in prints:
                for b in range(4):
                    near[b][_near(int(p >> np.uint64(16 * b)) & 0xFFFF)] = True
            self.by_length[n] = (np.array(own), prints, np.packbits(near, axis=1))

    def weigh(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.known):
            return np.full(len(shingles), self.unknown), np.zeros(len(shingles), bool)
        spot = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        is_known = self.known[spot] == shingles
        return np.where(is_known, self.weights[spot], self.unknown), is_known

    def sums(self, shingles: np.ndarray) -> np.ndarray:
        """Running sums of the weighted bits, one more row than shingles."""
        bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
        out = np.zeros((len(shingles) + 1, 64))
        np.cumsum((2 * bits - 1) * self.weigh(shingles)[0][:, None], axis=0, out=out[1:])
        return out

    def fingerprints(self, shingles: np.ndarray, size: int) -> np.ndarray:
        return _prints(self.sums(shingles), size)

    def similarity(self, window: np.ndarray, item: np.ndarray) -> float:
        """Weighted Jaccard of two shingle sets."""
        a, b = np.unique(window), np.unique(item)
        both = np.intersect1d(a, b, assume_unique=True)
        shared = float(self.weigh(both)[0].astype(np.float64).sum())
        total = float(self.weigh(a)[0].astype(np.float64).sum()) + float(self.weigh(b)[0].astype(np.float64).sum()) - shared
        return shared / total if total else 0.0

    def search(self, shingles: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """For each item found: similarity, first shingle and number of shingles of its best window."""
        found: dict[int, tuple[float, int, int]] = {}
        if not len(self.known) or not len(shingles):
            return found
        hits = np.flatnonzero(self.weigh(shingles)[1])
        if not len(hits):
            return found
        reach = max(self.by_length)
        cuts = np.flatnonzero(np.diff(hits) > 2 * reach) + 1
        for group in np.split(hits, cuts):
            low, high = max(0, group[0] - reach), min(len(shingles), group[-1] + reach + 1)
            part = shingles[low:high]
            sums = self.sums(part)
            for n, (ids, prints, packed) in self.by_length.items():
                size = min(n - SHINGLE + 1, len(part))
                windows = _prints(sums, size)
                touched = np.zeros(len(part) + 1, np.int64)
                touched[1:] = np.cumsum(np.bincount(group - low, minlength=len(part)) > 0)
                maybe = touched[size:] > touched[: len(touched) - size]
                candidate = np.zeros(len(windows), bool)
                for b in range(4):
                    value = (windows >> np.uint64(16 * b)) & np.uint64(0xFFFF)
                    candidate |= (packed[b][(value >> np.uint64(3)).astype(np.int64)] >> (7 - (value & np.uint64(7)).astype(np.uint8))) & 1 > 0
                starts = np.flatnonzero(candidate & maybe)
                if not len(starts):
                    continue
                bits = np.bitwise_count(windows[starts][:, None] ^ prints[None, :])
                for s, i in zip(*np.nonzero(bits <= RADIUS)):
                    start, item = int(starts[s]), int(ids[i])
                    alike = self.similarity(part[start : start + size], self.sets[item])
                    best = found.get(item)
                    if alike >= threshold and (best is None or (-alike, low + start) < (-best[0], best[1])):
                        found[item] = (alike, low + start, size)
        return found


def _prints(sums: np.ndarray, size: int) -> np.ndarray:
    totals = sums[size:] - sums[: len(sums) - size]
    return np.packbits(totals > 0, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text",
          item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, start, end, similarity) of the best window of each benchmark item found in each document.

    Words are compared in lower case (Latin letters up to U+00DE) without
    punctuation at their ends; start and end are code points of the whole text. Items of fewer than five words
    and null or empty texts take no part; a document shorter than an item is one
    window. Each of equal items is reported. Repeated rows report each. The index
    holds a bounded number of items; more are searched for in further passes.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, {item} long, start long, end long, similarity double"
    items = benchmark.where(F.col(item_text).isNotNull() & F.col(item).isNotNull()).select(F.col(item).cast("long").alias("id"), F.col(item_text).alias("text")).distinct()
    passes = max(1, -(-items.count() // ITEMS))
    out = spark.createDataFrame([], schema)
    for p in range(passes):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == p).orderBy("id").collect()
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in part])
        out = out.union(docs.select(key, text).mapInArrow(_finder(shared, threshold, key, item), schema))
    return out


def _finder(shared, threshold: float, key: str, item: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        rows = shared.value
        index = Items([i for i, _ in rows], [t for _, t in rows])
        for batch in batches:
            data, bounds = buffers(batch.column(1))
            found = []
            for low, high in slices(bounds, SLICE // 4):  # each byte takes many times its size here
                own, at = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
                words = TrimmedWords(fold_case(own), at)
                shingles, places = words.shingles(SHINGLE)
                edges = np.searchsorted(places, words.first)
                _, known = index.weigh(shingles)
                sums = np.concatenate([[0], np.cumsum(known)])
                for i in np.flatnonzero(sums[edges[1:]] > sums[edges[:-1]]):
                    points = code_points_before(own[at[i] : at[i + 1]])
                    for which, (alike, start, size) in index.search(shingles[edges[i] : edges[i + 1]], threshold).items():
                        first = words.first[i] + start
                        a, b = words.starts[first] - at[i], words.ends[first + size + SHINGLE - 2] - at[i]
                        found.append((low + int(i), which, int(points[a]), int(points[b]), alike))
            if found:
                place, which, a, b, alike = zip(*found)
                yield pa.RecordBatch.from_pydict({key: batch.column(0).take(pa.array(place)), item: pa.array(which, pa.int64()), "start": pa.array(a, pa.int64()),
                                                  "end": pa.array(b, pa.int64()), "similarity": pa.array(alike, pa.float64())})

    return run
