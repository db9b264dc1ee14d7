"""Packing of token sequences by exact complements.

Documents become pieces of at most `capacity` tokens. Only the number of pieces
of each length matters for the plan, so the plan is made from a histogram of at
most `capacity` counts: the longest length left is taken, and the gap behind it
is filled exactly by one, two or three lengths that are still available, as
often as their counts allow. Where no such combination exists, the best fitting
length goes in and the smaller gap is tried again.

Each task numbers its pieces of each length; counts per task and length, summed
up over the tasks, turn that into a number in the whole table. A sorted table of
runs (length, first number) then gives sequence and offset. No piece meets the
others of its length in one place, so a length of a third of all pieces is fine.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.frames import bounded_batches, kept, materialise, release
from siltstone.llm.text import SLICE, buffers, slices, span_hashes

#: Chunks whose ids a worker remembers, and slots of each of the two tables that find them.
REMEMBERED, SLOTS = 1_000_000, 1 << 21
#: Chunks encoded at once.
ENCODED = 4096

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: ASCII punctuation but the apostrophe, which may begin a token with letters.
_POINT = np.zeros(256, bool)
_POINT[[i for i in range(0x21, 0x7F) if not chr(i).isalnum() and chr(i) != "'"]] = True


class ChunkTokenizer:
    """Token ids of whole texts, each distinct chunk of text encoded once.

    Byte-level BPE never makes one token of a character that isn't white space
    and white space behind it, nor of an ASCII letter and punctuation behind it,
    so texts may be cut there. Chunks repeat often; their ids are looked up by a
    64-bit hash.
    """

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model)
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.forget()

    def forget(self) -> None:
        self.keys, self.entries = np.zeros((2, SLOTS), np.uint64), np.full((2, SLOTS), -1, np.int32)
        self.sizes, self.begins = np.zeros(REMEMBERED, np.int32), np.zeros(REMEMBERED, np.int64)
        self.ids, self.used, self.known = np.zeros(4 * REMEMBERED, np.uint32), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each chunk, -1 where it isn't remembered."""
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        entry = np.where(self.keys[0][slot] == hashes, self.entries[0][slot], np.int32(-1))
        rest = np.flatnonzero(entry < 0)
        slot = (hashes[rest] >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        entry[rest] = np.where(self.keys[1][slot] == hashes[rest], self.entries[1][slot], np.int32(-1))
        return entry

    def learn(self, hashes: np.ndarray, texts: list[str]) -> np.ndarray:
        counts, parts = [], []
        for at in range(0, len(texts), ENCODED):  # an encoding takes many times the memory of its ids
            found = [e.ids for e in self.model.encode_batch_fast(texts[at : at + ENCODED], add_special_tokens=False)]
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(np.fromiter(chain.from_iterable(found), np.uint32, int(counts[-1].sum())))
        sizes, flat = np.concatenate(counts), np.concatenate(parts)
        if self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + len(flat)))
        self.ids[self.used : self.used + len(flat)] = flat
        entries = np.arange(self.known, self.known + len(texts), dtype=np.int32)
        self.begins[entries] = self.used + np.cumsum(sizes) - sizes
        self.sizes[entries] = sizes
        self.used += len(flat)
        self.known += len(texts)
        first = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        second = (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        taken = self.entries[0][first] >= 0
        for table, slot, mine in ((0, first, ~taken), (1, second, taken)):
            self.keys[table][slot[mine]], self.entries[table][slot[mine]] = hashes[mine], entries[mine]
        return entries

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the bounds of each text's ids."""
        before, last = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
        last[1:], before[2:] = data[:-1], data[:-2]
        solid = (last > 0x20) & (last < 0x7F) | (last >= 0x80) & (before >= 0xC3) & (before < 0xE0)
        cut = ((data == 0x20) | (data == 0x0A)) & solid | _POINT[data] & _LETTER[last]
        cut[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes = span_hashes(data, starts, ends)
        entry = self.find(hashes)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, one, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            if self.known + len(new) > REMEMBERED:
                self.forget()
                if len(missing) < len(hashes):
                    return self.encode(data, bounds)
                if len(new) > REMEMBERED:  # one huge text of short chunks
                    return self._unremembered(data, bounds)
            raw, one = data.tobytes(), missing[one]
            entry[missing] = self.learn(new, [raw[a:b].decode() for a, b in zip(starts[one].tolist(), ends[one].tolist())])[which]
        sizes, begins = self.sizes[entry].astype(np.int64), self.begins[entry]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(sums[-1]) + np.repeat(begins - sums[:-1], sizes)]
        return ids, sums[np.searchsorted(starts, bounds)]

    def _unremembered(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:])]
        found = [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found), np.concatenate([[0], np.cumsum([len(x) for x in found])])


def worker_tokenizer(model: str) -> ChunkTokenizer:
    """One tokenizer for all tasks of a Python worker, until another operator's task runs there."""
    held = kept()
    if held.get("model") != model:
        held["model"], held["coder"] = model, ChunkTokenizer(model)
    return held["coder"]


def tokenised(docs: DataFrame, model: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text",
              keep_ids: bool = False) -> DataFrame:
    """Pieces of each document: key, `piece`, `start`, `length`, `ids_crc32` (and `ids`).

    `model` is the JSON text of a byte-level BPE tokenizer. Ids of a document end
    with `end_id`. Only documents of more than `capacity` ids are cut, from their
    end, so only the first piece may be short. `_task` and `_nth` number the
    pieces of a length within the task that made them.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("packing")
        coder, task, seen = worker_tokenizer(shared.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            release("packing")  # what the last batch's encoding left
            keys = batch.column(0)
            data, bounds = buffers(batch.column(1))
            for low, high in slices(bounds, SLICE // 2):  # each byte takes many times its size here
                ids, at = coder.encode(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
                rows: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "crc", "nth", "ids")}
                for i in range(high - low):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    start, piece = 0, 0
                    while start < len(own):
                        length = (len(own) - start - 1) % capacity + 1
                        part = own[start : start + length]
                        for c, v in zip(rows, (low + i, piece, start, length, zlib.crc32(part.tobytes()), int(seen[length]), part if keep_ids else None)):
                            rows[c].append(v)
                        seen[length] += 1
                        start, piece = start + length, piece + 1
                out = {
                    "key": keys.take(pa.array(rows["row"])), "piece": pa.array(rows["piece"], pa.int32()), "start": pa.array(rows["start"], pa.int64()),
                    "length": pa.array(rows["length"], pa.int64()), "ids_crc32": pa.array(rows["crc"], pa.int64()),
                    "_task": pa.array([task] * len(rows["row"]), pa.int32()), "_nth": pa.array(rows["nth"], pa.int64()),
                }
                if keep_ids:
                    out["ids"] = pa.array(rows["ids"], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[key].dataType.simpleString()
    made = docs.select(key, text).mapInArrow(run, f"key {kind}, piece int, start long, length long, ids_crc32 long, _task int, _nth long" + ", ids array<int>" * keep_ids)
    return made.withColumnRenamed("key", key)


def _exact(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that fill `gap` exactly, the smallest of them as long as possible."""
    if left[gap]:
        return [gap]

    def pair(total: int, least: int) -> list[int] | None:
        small = np.arange(total // 2, least - 1, -1)
        fits = (left[small] > 0) & (left[total - small] > np.where(small * 2 == total, 1, 0))
        at = int(fits.argmax()) if len(fits) else 0
        return [total - int(small[at]), int(small[at])] if len(fits) and fits[at] else None

    if found := pair(gap, 1):
        return found
    for third in range(gap // 3, 0, -1):
        if left[third]:
            left[third] -= 1
            found = pair(gap - third, third)
            left[third] += 1
            if found:
                return [*found, third]
    return None


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Combinations of lengths, and how many sequences get each; `counts[n]` pieces have length n."""
    left, out = counts.astype(np.int64).copy(), []
    for longest in range(capacity, 0, -1):
        while left[longest]:
            parts, gap = [longest], capacity - longest
            left[longest] -= 1
            while gap:
                filled = _exact(left, gap)
                if not filled:
                    fitting = np.flatnonzero(left[: gap + 1])
                    filled = [int(fitting[-1])] if len(fitting) else []
                if not filled:
                    break
                for n in filled:
                    left[n] -= 1
                    gap -= n
                parts += filled
            lengths, each = np.unique(parts, return_counts=True)
            more = int((left[lengths] // each).min())
            left[lengths] -= more * each
            out.append((1 + more, parts))
    return out


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """`pieces` as made by `tokenised`, with `sequence_id` and `offset` in it (gapless from 0)."""
    spark = pieces.sparkSession
    totals = pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in totals.groupBy("length").agg(F.sum("_n")).collect():  # `capacity` rows at most
        counts[length] = n
    runs, taken, sequences = [], np.zeros(capacity + 1, np.int64), 0
    for times, parts in plan(counts, capacity):
        offset = 0
        for n in parts:
            runs.append((n, taken[n], sequences, offset))
            taken[n] += times
            offset += n
        sequences += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 4)
    first = (table[:, 0] << 48) + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths, numbers):
        import pandas as pd

        n = numbers.to_numpy(np.int64)
        run = np.searchsorted(first, (lengths.to_numpy(np.int64) << 48) + n, "right") - 1
        return pd.DataFrame({"sequence_id": table[run, 2] + n - table[run, 1], "offset": table[run, 3]})

    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.withColumn("_base", F.coalesce(before, F.lit(0))).drop("_n")
    numbered = pieces.join(bases, ["_task", "length"]).withColumn("_place", place("length", F.col("_base") + F.col("_nth")))
    return numbered.withColumns({"sequence_id": F.col("_place.sequence_id"), "offset": F.col("_place.offset")}).drop("_task", "_nth", "_base", "_place")


def pack_documents(docs: DataFrame, model: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """All documents in as few sequences of `capacity` tokens as the method finds, one row per piece.

    Null and empty texts are the end id alone. Equal rows are packed each on
    their own. Null keys stay null. Other columns are left out; an empty table
    gives no rows.
    """
    pieces = materialise(tokenised(docs, model, capacity, end_id, key, text, keep_ids), "pieces")
    return pack(pieces, capacity)
