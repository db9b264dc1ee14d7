"""Personal data, and the words that give it away.

Emails, IP addresses, cards and phone numbers are found by pattern (the base
spans). Each distinct value is a protected entity. A word discloses an entity
as far as seeing it tells that the entity is there: the pointwise mutual
information of the two, as a part of all the information the entity carries,

    log(p(word, entity) / (p(word) p(entity))) / -log p(entity),

with shares of the distinct texts of the corpus, so copies of a text count once.
It is 1 when the word occurs only with the entity. All words of the texts that
mention an entity are candidates, wherever they stand. Words whose disclosure reaches a threshold are spans as
well: in a sanitised text they are generalised, or removed from a higher one on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import bounded_batches, ints, materialise, name, release
from siltstone.llm.text import Words, buffers, code_points_before, owners, slices, span_hashes
from siltstone.session import small_side

# Kinds and patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
#: Entities or words handled in one pass; more are handled in further passes.
PASS = 500_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the email pattern, found from each @ so that long words cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start; leftmost, not overlapping per kind."""
    found: list[tuple[str, int, int]] = []
    if not text:
        return found
    if "@" in text:
        found += (("email", a, b) for a, b in _emails(text))
    if _DIGIT.search(text):
        found += (("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        found += (("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15)
    return found


def entity(kind: str, value: str) -> str:
    """One value in one writing: lower case; numbers without their separators."""
    return f"{kind}:{value.lower()}" if kind in ("email", "ip") else f"{kind}:{re.sub('[^0-9]', '', value)}"


_SPACE_RUN = re.compile(r"[^\x20\x09-\x0D]+")


def _ascii_lower(word: str) -> str:
    return word.encode().lower().decode()  # bytes.lower changes A to Z only


def _terms(text: str) -> Iterator[tuple[str, int, int]]:
    """Words without punctuation at their ends, A to Z in lower case, with spans."""
    for m in _SPACE_RUN.finditer(text):
        word = m[0]
        left = len(word) - len(word.lstrip(".,;:!?()[]\"'"))
        core = word[left:].rstrip(".,;:!?()[]\"'")
        if core:
            yield _ascii_lower(core), m.start() + left, m.start() + left + len(core)


def mentions(texts: DataFrame) -> DataFrame:
    """(document, entity) once for each entity that a text of (document, text) mentions."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            rows = [(d, who) for d, whole in zip(*(c.to_pylist() for c in batch.columns)) for who in {entity(k, whole[a:b]) for k, a, b in base_spans(whole)}]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string()))], ["document", "entity"])

    return texts.select("document", "text").mapInArrow(run, "document long, entity string")


_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:!?()[]\"'"]] = True


class TrimmedWords(Words):
    """Words without punctuation at their ends; words of punctuation alone get the hash of the empty word."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        super().__init__(data, bounds, hashed=False)
        edge = _EDGE[data]
        body = np.flatnonzero(~edge)
        if len(body):
            self.starts = np.minimum(np.append(body, len(data))[np.searchsorted(body, self.starts)], self.ends)
            self.ends = np.maximum(body[np.searchsorted(body, self.ends) - 1] + 1, self.starts)
        else:
            self.ends = self.starts
        self.hash()


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns, in order of the last column first, and how often each stands there."""
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.append(first, len(order)))


def _document_counts(texts: DataFrame) -> DataFrame:
    """(c, with_word): how many texts have each word, by its hash."""
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            data, at = buffers(batch.column(0))
            for low, high in slices(at):
                w = TrimmedWords(data[at[low] : at[high]], at[low : high + 1] - at[low])
                real = np.flatnonzero(w.ends > w.starts)
                if len(real):
                    (_, words), _ = _distinct(owners(w.first, real), w.hashes[real])
                    (words,), counts = _distinct(words)
                    yield pa.RecordBatch.from_pydict({"c": ints(words.view(np.int64)), "n": ints(counts)})

    return texts.select("text").mapInArrow(run, "c long, n long").groupBy("c").agg(F.sum("n").alias("with_word"))


def _most(with_entity, threshold: float, total: int):
    """In how many texts a word can stand at most to disclose an entity: with all of the entity's texts among them."""
    return total * (with_entity / (total + 1.0)) ** threshold * (1 + 1e-9)


def _pairs(carriers: DataFrame, words: pa.Table, threshold: float, total: int) -> DataFrame:
    """(who, word, with_word, with_entity, both) of the words that may disclose an entity, summed up in parts.

    `carriers`: text and who, an array of its entities (who, with_entity).
    """
    bounded_batches(carriers.sparkSession)
    hashes, counts = words.column("c").to_numpy().view(np.uint64), words.column("with_word").to_numpy()
    order = np.argsort(hashes)
    shared = carriers.sparkSession.sparkContext.broadcast((hashes[order], counts[order]))
    schema = "who long, word string, with_word long, with_entity long, both long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        wanted, with_word = shared.value
        held, names, size = [], {}, 0

        def summed() -> pa.RecordBatch:
            (spots, who, with_entity), both = _distinct(*(np.concatenate(c) for c in zip(*held)))
            return pa.RecordBatch.from_pydict({"who": ints(who), "word": pa.array([names[x] for x in spots.tolist()], pa.string()),
                                               "with_word": ints(with_word[spots]), "with_entity": ints(with_entity), "both": ints(both)})

        for batch in batches:
            data, at = buffers(batch.column(0))
            strings, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high in slices(at):
                own, edges = data[at[low] : at[high]], at[low : high + 1] - at[low]
                w = TrimmedWords(own, edges)
                spot = np.minimum(np.searchsorted(wanted, w.hashes), len(wanted) - 1)
                hit = np.flatnonzero((wanted[spot] == w.hashes) & (w.ends > w.starts))
                bounds = np.searchsorted(hit, w.first)
                for i in np.flatnonzero(np.diff(bounds)):
                    mine, whole = hit[bounds[i] : bounds[i + 1]], strings[low + i]
                    covered = np.zeros(len(whole) + 1, np.int64)
                    for _, a, b in base_spans(whole):
                        covered[a + 1 : b + 1] = 1
                    before, points = np.cumsum(covered), code_points_before(own[edges[i] : edges[i + 1]])
                    mine = mine[before[points[w.starts[mine] - edges[i]]] == before[points[w.ends[mine] - edges[i]]]]
                    spots, one = np.unique(spot[mine], return_index=True)
                    for x, word in zip(spots.tolist(), mine[one].tolist()):
                        if x not in names:
                            names[x] = w.data[w.starts[word] : w.ends[word]].tobytes().decode()
                    for e in lists[low + i]:
                        rare = spots[with_word[spots] <= _most(e["with_entity"], threshold, total)]
                        if len(rare):
                            held.append((rare, np.full(len(rare), e["who"]), np.full(len(rare), e["with_entity"])))
                            size += len(rare)
                        if size >= PASS:
                            yield summed()
                            held, size = [], 0
                if not held:
                    names = {}
        if held:
            yield summed()

    return carriers.select("text", "who").mapInArrow(run, schema)


def disclosing_words(docs: DataFrame, threshold: float = 0.9, support: int = 3, text: str = "text") -> DataFrame:
    """(word, disclosure): words that disclose some entity to at least `threshold`.

    Entities and pairs of a word and an entity need `support` different texts, as
    a share can't be estimated from fewer. All counts are of different texts.
    Disclosure is the largest over a word's entities. Empty when no entity has that
    support.
    """
    spark = docs.sparkSession
    some = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("document"), F.col(text).alias("text"))
    copies = materialise(some.groupBy("document").agg(F.count(F.lit(1)).alias("copies")), "copies")
    total = copies.count()
    repeated = small_side(copies.where("copies > 1").select("document"), max_rows=1_000_000)
    once = materialise(some.join(repeated, "document", "left_semi").dropDuplicates(["document"]), "repeated")
    texts = some.join(repeated, "document", "left_anti").unionByName(once)  # only texts with copies are moved
    found = materialise(mentions(texts), "mentions")
    known = found.groupBy("entity").agg(F.count(F.lit(1)).alias("with_entity")).where(F.col("with_entity") >= support)
    who = F.struct(F.xxhash64("entity").alias("who"), "with_entity")
    lists = materialise(found.join(small_side(known), "entity").groupBy("document").agg(F.collect_list(who).alias("who")), "entities")
    out = spark.createDataFrame([], "word string, disclosure double")
    largest = lists.agg(F.max(F.array_max(F.transform("who", lambda x: x["with_entity"])))).first()[0]
    if largest is None:
        return out
    carriers = texts.join(small_side(lists), "document").select("text", "who")
    candidates = _document_counts(texts).where((F.col("with_word") >= support) & (F.col("with_word") <= _most(largest, threshold, total)))
    candidates = materialise(candidates, "words")
    passes = -(-candidates.count() // PASS)
    for p in range(passes):  # a bounded part of the candidates at a time
        part = F.pmod(F.xxhash64("c"), F.lit(passes)) == p
        words = candidates.where(part).toArrow()
        if not words.num_rows:
            continue
        joint = _pairs(carriers, words, threshold, total).groupBy("who", "word", "with_word", "with_entity").agg(F.sum("both").alias("both"))
        mutual = F.log(F.col("both") * total / (F.col("with_word") * F.col("with_entity")))
        share = mutual / -F.log(F.col("with_entity") / (total + 1.0))
        joint = joint.where(F.col("both") >= support).groupBy("word").agg(F.max(share).alias("disclosure"))
        out = out.union(joint.where(F.col("disclosure") >= threshold))
    return out


def _parts(words: DataFrame | None) -> Iterator[list[tuple[str, float]]]:
    """The disclosing words, at most about `PASS` at a time."""
    if words is None:
        return
    passes = -(-words.count() // PASS)
    for p in range(passes):
        part = F.pmod(F.xxhash64("word"), F.lit(passes)) == p
        yield [tuple(r) for r in words.where(part).select("word", "disclosure").collect()]


def _spans_in(texts, terms: frozenset[str], base: bool) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in each text: of the base kinds if asked for, then of the terms."""
    marked = _marked(texts, terms) if terms else np.zeros(len(texts), bool)
    out = []
    for whole, has_term in zip(texts, marked):
        found = base_spans(whole) if base or has_term else []
        own = list(found) if base else []
        if has_term:
            own += [("term", a, b) for w, a, b in _terms(whole) if w in terms and not any(a < y and x < b for _, x, y in found)]
        out.append(own)
    return out


def _span_udf(spark, terms: frozenset[str], base: bool):
    shared = spark.sparkContext.broadcast(terms)

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def spans(texts):
        import pandas as pd

        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in own] for own in _spans_in(texts, shared.value, base)])

    return spans


def find_spans(docs: DataFrame, words: DataFrame | None = None, text: str = "text") -> DataFrame:
    """`docs` with `pii`: an array of (kind, start, end), base kinds in their order, then `term` for disclosing words.

    `words` as given by `disclosing_words`; they travel as broadcasts of a bounded
    number of words each. Offsets are code points of the whole text, end
    exclusive; null texts have no spans. A column `pii` is replaced.
    """
    docs = docs.drop("pii")
    parts = [frozenset(w for w, _ in part) for part in _parts(words)]
    fresh = name(docs, "_spans")
    found = _with_spans(docs, parts or [frozenset()], text, fresh)
    return found.select(*docs.columns, F.col(fresh).alias("pii"))


def _with_spans(docs: DataFrame, parts: list[frozenset[str]], text: str, fresh: str) -> DataFrame:
    """`docs` with the spans of base kinds and of all parts' words in a column `fresh`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    found = docs.withColumn(fresh, _span_udf(spark, parts[0], True)(F.col(text)))
    for i, part in enumerate(parts[1:]):  # later parts only add words, which stand behind the base kinds
        more = name(found, f"_more{i}")
        found = found.withColumn(more, _span_udf(spark, part, False)(F.col(text)))
        words_of = F.array_sort(F.concat(F.filter(fresh, lambda s: s["kind"] == "term"), F.col(more)))
        found = found.withColumn(fresh, F.concat(F.filter(fresh, lambda s: s["kind"] != "term"), words_of)).drop(more)
    return found


def _marked(texts, terms: frozenset[str]) -> np.ndarray:
    """Which texts have any of the words."""
    encoded = [w.encode() for w in terms]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in encoded])])
    wanted = np.sort(span_hashes(np.frombuffer(b"".join(encoded), np.uint8), bounds[:-1], bounds[1:]))
    data, at = buffers(pa.array(texts, pa.string(), from_pandas=True))
    out = np.zeros(len(texts), bool)
    for low, high in slices(at):
        w = TrimmedWords(data[at[low] : at[high]], at[low : high + 1] - at[low])
        spot = np.minimum(np.searchsorted(wanted, w.hashes), len(wanted) - 1)
        hit = np.flatnonzero(wanted[spot] == w.hashes)
        out[low + np.unique(owners(w.first, hit))] = True
    return out


def sanitise(docs: DataFrame, threshold: float = 0.9, removal: float = 0.97, support: int = 3, text: str = "text") -> DataFrame:
    """`docs` with base spans replaced by [KIND], disclosing words by [TERM], and those from `removal` on taken out.

    Null texts stay null; texts without a span are unchanged.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    words = materialise(disclosing_words(docs, threshold, support, text), "disclosing")
    parts = list(_parts(words))
    *earlier, last = [frozenset(w for w, _ in part) for part in parts] or [frozenset()]
    gone = [spark.sparkContext.broadcast(frozenset(w for w, d in part if d >= removal)) for part in parts]
    terms, base = spark.sparkContext.broadcast(last), not earlier

    @F.pandas_udf("string")
    def rewrite(texts, *before):
        import pandas as pd

        out = []
        # the last part's spans are found here, so that a task with one part needs one Python worker
        for i, (whole, spans) in enumerate(zip(texts, _spans_in(texts, terms.value, base))):
            for column in before:
                if column.iloc[i] is not None:
                    spans = [*((s["kind"], s["start"], s["end"]) for s in column.iloc[i]), *spans]
            if whole is None or not spans:
                out.append(whole)
                continue
            parts, at = [], 0
            for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                if a < at:  # inside a longer span of another kind
                    if b > at:
                        at = b
                    continue
                parts.append(whole[at:a])
                if kind != "term":
                    parts.append(f"[{kind.upper()}]")
                elif not any(_ascii_lower(whole[a:b]) in part.value for part in gone):
                    parts.append("[TERM]")
                at = b
            out.append("".join([*parts, whole[at:]]))
        return pd.Series(out, dtype=object)

    fresh, clean = name(docs, "_spans"), name(docs, "_clean")
    found = _with_spans(docs, earlier, text, fresh) if earlier else docs
    found = found.withColumn(clean, rewrite(F.col(text), *([F.col(fresh)] if earlier else [])))
    return found.select(*[F.col(clean).alias(c) if c == text else F.col(c) for c in docs.columns])
