"""Language identification with n-gram filters whose slots are language bitmasks.

Training counts the byte n-grams of each language over all training texts. An
n-gram belongs to every language in which its share reaches a floor and a part
of its largest share in any language. All languages share one Bloom filter: slot
h of n-gram g holds a bitmask, so that one look-up (the AND of a few slots) gives
all languages that contain g at once. A text's hits are counted per language and
corrected for the rate of false positives of that language's bits; the language
with most of them wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import bounded_batches, materialise, name, release
from siltstone.llm.text import SLICE, buffers, fold_case, mix, slices

UNKNOWN = "und"
#: Slots looked up for each n-gram.
HASHES = 3

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def _grams(data: np.ndarray, bounds: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams inside each text, and the place each begins at.

    Letters are in lower case, all else is one space; n-grams with two spaces in
    a row are left out.
    """
    low = fold_case(data)
    low[~_LETTER[low]] = 0x20
    n = len(low) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    code, good = np.zeros(n, np.uint32), np.ones(n, bool)
    for j in range(order):
        code = (code << np.uint32(8)) | low[j : n + j]
        if j:
            good &= (low[j : n + j] != 0x20) | (low[j - 1 : n + j - 1] != 0x20)
    for j in range(1, order):  # not across two texts
        edge = bounds[1:-1] - j
        good[edge[(edge >= 0) & (edge < n)]] = False
    at = np.flatnonzero(good)
    return code[at], at


@dataclass(frozen=True)
class LanguageFilter:
    """Languages in the order of their bits, the slots, and each language's rate of false positives."""

    languages: list[str]
    slots: np.ndarray
    order: int

    @property
    def false_rates(self) -> np.ndarray:
        bits = np.array([((self.slots >> np.uint64(i)) & np.uint64(1)).mean() for i in range(len(self.languages))])
        return bits**HASHES


def _places(codes: np.ndarray, size: int) -> list[np.ndarray]:
    h = mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(j) * step) & np.uint64(size - 1)).astype(np.int64) for j in range(HASHES)]


def train(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = 3, floor: float = 1e-5, part: float = 0.5) -> LanguageFilter:
    """Learn from all rows with a language and a text.

    At most 1/`floor` n-grams of a language reach the floor, and there may be 64
    languages, which bounds the filter. More languages are refused.
    """
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(which: str, codes: np.ndarray, counts: np.ndarray) -> None:
            old = held.get(which, (np.zeros(0, np.uint32), np.zeros(0, np.int64)))
            keys, at = np.unique(np.concatenate([old[0], codes]), return_inverse=True)
            held[which] = keys, np.bincount(at, np.concatenate([old[1], counts]), len(keys)).astype(np.int64)

        def out(which: str) -> pa.RecordBatch:
            codes, counts = held.pop(which)
            return pa.RecordBatch.from_pydict({"lang": pa.array([which] * len(codes), pa.string()), "gram": pa.array(codes.astype(np.int64)), "n": pa.array(counts)})

        for batch in batches:
            names = batch.column(0)
            for which in names.unique().to_pylist():
                mine = batch.filter(pa.compute.equal(names, which))
                data, bounds = buffers(mine.column(1))
                for low, high in slices(bounds):
                    codes, _ = _grams(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low], order)
                    add(which, *np.unique(codes, return_counts=True))
                if len(held[which][0]) > 500_000:
                    yield out(which)
        for which in list(held):
            yield out(which)

    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text))
    counts = known.mapInArrow(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    if totals.count() > 64:
        raise ValueError("a bitmask holds 64 languages")
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    good = shares.where(F.col("share") >= floor).withColumn("most", F.max("share").over(Window.partitionBy("gram"))).where(F.col("share") >= part * F.col("most"))
    rows = good.select("gram", "lang").toArrow()  # 1/floor rows for each language at most
    languages = sorted(set(rows.column("lang").to_pylist()))
    size = 1 << max(10, int(np.ceil(np.log2(8 * max(1, rows.num_rows)))))
    slots = np.zeros(size, np.uint64)
    codes = rows.column("gram").to_numpy().astype(np.uint32)
    bit = np.searchsorted(np.array(languages, object), np.array(rows.column("lang").to_pylist(), object)).astype(np.uint64) if languages else np.zeros(0, np.uint64)
    for at in _places(codes, size):
        np.bitwise_or.at(slots, at, np.uint64(1) << bit)
    return LanguageFilter(languages, slots, order)


def identify(docs: DataFrame, model: LanguageFilter, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score` (the winner's share of all corrected hits) and `known` (its share of all n-grams).

    Whole texts are read. A null text, or one without a letter, is `und` with score
    0. With letters but without a hit, the first language in alphabetical order is
    given with score 0; ties go the same way. Columns of `docs` with these three
    names are replaced; an empty table gives no rows.
    """
    docs = docs.drop("lang_pred", "score", "known")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.slots, model.order))
    rates = model.false_rates

    @F.pandas_udf("lang_pred string, score double, known double")
    def predict(texts, lettered):
        import pandas as pd

        release()
        languages, slots, order = shared.value
        n = len(languages)
        data, bounds = buffers(pa.array(texts, pa.string(), from_pandas=True))
        hits, totals = np.zeros((len(texts), n)), np.zeros(len(texts))
        for low, high in slices(bounds, SLICE // 4):  # each byte takes many times its size here
            own = bounds[low : high + 1] - bounds[low]
            codes, at = _grams(data[bounds[low] : bounds[high]], own, order)
            mask = np.full(len(codes), 2**64 - 1, np.uint64)
            for place in _places(codes, len(slots)):
                mask &= slots[place]
            first = np.searchsorted(at, own)
            totals[low:high] = np.diff(first)
            for i in range(n):
                sums = np.concatenate([[0], np.cumsum((mask >> np.uint64(i)) & np.uint64(1), dtype=np.int64)])
                hits[low:high, i] = np.diff(sums[first])
        if not n:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "known": 0.0})
        clean = np.maximum(0.0, (hits - totals[:, None] * rates) / (1 - rates))
        best = clean.argmax(axis=1)
        most, total = clean.max(axis=1), clean.sum(axis=1)
        ok = lettered.to_numpy(bool)
        return pd.DataFrame({
            "lang_pred": np.where(ok, np.array(languages, object)[best], UNKNOWN),
            "score": np.where(ok, most / np.maximum(total, 1e-300), 0.0),
            "known": np.where(ok, np.minimum(1.0, most / np.maximum(totals, 1.0)), 0.0),
        })

    found = name(docs, "_found")
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(found, predict(F.col(text), lettered)).select(*docs.columns, f"{found}.lang_pred", f"{found}.score", f"{found}.known")
