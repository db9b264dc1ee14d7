"""Quality by the votes of labelled neighbours in a latent-semantic space.

The terms of a text are the patterns of its writing: runs of three character
classes, words that repeat the one before or any earlier one, and words or lines
that are new. Document frequencies come from all documents. Labelled documents,
a bounded sample, give the latent axes (the largest singular vectors of their
weighted term matrix) and the labelled vectors, which are broadcast. Every text
is projected, its exact cosines with all labelled vectors are worked out in
blocks, and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import bounded_batches, name
from siltstone.llm.text import Words, buffers, slices

# Character classes: letters in lower case (and all beyond ASCII), upper case, digits, space, line ends, and kinds of signs.
_CLASS = np.full(256, 10, np.uint16)
_CLASS[0x61:0x7B] = _CLASS[0x80:] = 0
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[0x20, 0x09]] = 3
_CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 4
for _i, _signs in enumerate((".", ",", "!?;:", "\"'()[]{}-_", "|")):
    _CLASS[[ord(c) for c in _signs]] = 5 + _i
CLASSES = 11
#: Terms: class patterns, then words: same as the one before, seen before, new; lines: seen before, new.
TERMS = CLASSES**3 + 5


def term_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of all terms, one row for each text."""
    rows = len(bounds) - 1
    out = np.zeros((rows, TERMS), np.float32)
    if not len(data):
        return out
    kinds = _CLASS[data].astype(np.int32)
    words = Words(data, bounds)
    codes = kinds[:-2] * CLASSES**2 + kinds[1:-1] * CLASSES + kinds[2:] if len(kinds) > 2 else np.zeros(0, np.int32)
    line_ends = np.flatnonzero(data == 0x0A)
    for i in range(rows):
        low, high = bounds[i], bounds[i + 1]
        if high - low > 2:
            out[i, : CLASSES**3] = np.bincount(codes[low : high - 2], minlength=CLASSES**3)
        own = words.hashes[words.first[i] : words.first[i + 1]]
        if len(own):
            same = int((own[1:] == own[:-1]).sum())
            ordered = np.sort(own)
            new = 1 + int((ordered[1:] != ordered[:-1]).sum())
            out[i, -5:-2] = same, len(own) - new, new
            cuts = line_ends[np.searchsorted(line_ends, low) : np.searchsorted(line_ends, high)] - low
            if len(cuts):
                lines = data[low:high].tobytes().split(b"\n")
                fresh = len(set(lines))
                out[i, -2:] = len(lines) - fresh, fresh
            else:
                out[i, -2:] = 0, 1
    return out


@dataclass(frozen=True)
class NeighbourModel:
    weights: np.ndarray  # of the terms
    axes: np.ndarray  # terms by latent dimensions
    vectors: np.ndarray  # labelled, of unit length
    labels: np.ndarray
    prior: float


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * weights
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _latent(counts: np.ndarray, weights: np.ndarray, axes: np.ndarray) -> np.ndarray:
    x = _weighted(counts, weights) @ axes
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            data, bounds = buffers(batch.column(0))
            n += batch.num_rows
            for low, high in slices(bounds):
                counts += (term_counts(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]) > 0).sum(axis=0)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(used, -1)), "n": pa.array(np.append(counts[used], n))})

    df, total = np.zeros(TERMS, np.int64), 0
    for term, n in docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect():  # a row for each term
        if term < 0:
            total = n
        else:
            df[term] = n
    return df, total


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
          sample: int = 4000, dimensions: int = 32) -> NeighbourModel:
    """Fit on at most `sample` labelled documents, drawn by a hash of their id; null labels are left out.

    Document frequencies are taken over all of `docs`.
    """
    bounded_batches(docs.sparkSession)
    df, total = _frequencies(docs, text)
    weights = np.log((1.0 + total) / (1.0 + df)) + 0.1
    drawn = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, F.col(label).cast("double").alias("_label"))
    drawn = drawn.orderBy(F.xxhash64(F.col(key)), key, "_label").limit(sample)  # the bound of the fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = buffers(batch.column(0))
            rows = [term_counts(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in slices(bounds)]
            packed = pa.array([r.astype(np.float32).tobytes() for r in np.concatenate(rows)], pa.binary()) if rows else pa.array([], pa.binary())
            yield pa.RecordBatch.from_pydict({"terms": packed, "label": batch.column(1)})

    fitted = docs.select(key, text).join(F.broadcast(drawn), key).select(text, "_label").mapInArrow(run, "terms binary, label double").collect()
    fitted.sort(key=lambda r: (bytes(r[0]), r[1]))
    if not fitted:
        return NeighbourModel(weights, np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), 0.5)
    counts = np.frombuffer(b"".join(r[0] for r in fitted), np.float32).reshape(len(fitted), TERMS)
    y = np.array([r[1] for r in fitted])
    x = _weighted(counts, weights)
    _, vectors = np.linalg.eigh(x.T @ x)
    axes = vectors[:, ::-1][:, : min(dimensions, len(fitted))]
    return NeighbourModel(weights, axes, _latent(counts, weights, axes), y, float(y.mean()))


def score(docs: DataFrame, model: NeighbourModel, neighbours: int = 15, text: str = "text") -> DataFrame:
    """`docs` with `score`: the mean label of the nearest labelled vectors, weighted by similarity, from 0 to 1.

    Null and empty texts, or those unlike any labelled one, get the mean label of
    the sample; without labels all get 0.5. A column `score` is replaced.
    """
    docs = docs.drop("score")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.axes, model.vectors, model.labels, model.prior))

    @F.pandas_udf("double")
    def vote(texts):
        import pandas as pd

        weights, axes, vectors, labels, prior = shared.value
        data, bounds = buffers(pa.array(texts, pa.string(), from_pandas=True))
        out = np.full(len(texts), prior)
        k = min(neighbours, len(labels))
        for low, high in slices(bounds) if k else ():
            counts = term_counts(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
            cosines = _latent(counts, weights, axes) @ vectors.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, nearest, 1), 0.0)
            total = weight.sum(axis=1)
            some = (total > 0) & (counts.sum(axis=1) > 0)
            out[low:high] = np.where(some, (weight * labels[nearest]).sum(axis=1) / np.where(some, total, 1.0), prior)
        return pd.Series(np.clip(out, 0.0, 1.0))

    fresh = name(docs, "_score")
    return docs.withColumn(fresh, vote(F.col(text))).select(*docs.columns, F.col(fresh).alias("score"))
