"""Similarity join on word shingles with adaptive prefixes that must match several times.

All sets are put in one order of shingles (those of many documents last). If two
sets meet the threshold, then for any l the first n - ceil(t n) + l shingles of
both have l in common. A longer prefix has longer candidate lists but asks for
more matches; each set takes the l whose estimated cost is least, and a pair must
match min(l, l') times before its whole sets are compared. Of two sets, the one
whose prefix ends first in that order has in common with the other no shingle of
its prefix that no other prefix has. That bounds the overlap of the two from
above, so copies with edits of their own are not offered to each other.

Equal sets are one class. Lists are not turned into all pairs: each list first
offers its members to one hub only, or to the one that their sketches show as the
nearest, and members already linked, by any path, need no pair of their own. What
remains are pairs across components, which are all
compared. So no link between different texts that matters to a component is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.frames import bounded_batches, discard, ints, materialise, release
from siltstone.llm.text import Words, buffers, mix, slices

#: The longest extension of a prefix, in matches asked for.
MOST_MATCHES = 4
#: A compared pair costs about as much as so many list entries for each shingle.
COMPARE_COST = 0.05
#: One class in SAMPLE tells which shingles are frequent. That decides their order alone, which any choice leaves exact.
SAMPLE = 16
#: Shingles in at least HOT of those go last, if they are no more than HOT_MANY (then HOT rises). Bits that tell them.
HOT, HOT_MANY, HOT_BITS = 3, 300_000, 1 << 23
#: Bits of the sketch of a set; lists of more than SMALL members are compared by it, in blocks of BLOCK members.
SKETCH, SMALL, BLOCK = 1024, 32, 2048
#: Hubs that offer less than one pair for so many list entries end the rounds.
FEW_PAIRS = 1000
#: From so many possible pairs for a list entry on, members of long lists are first offered to their nearest one.
DENSE = 16
#: Ids that a filter on the workers may hold (8 bytes each).
FILTER_IDS = 4_000_000


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle."""
    data, bounds = buffers(column)
    for low, high in slices(bounds):
        words = Words(data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        shingles, at = words.shingles(k)
        edges = np.searchsorted(at, words.first)
        counts = words.counts()
        for i in range(high - low):
            if counts[i] >= k:
                own = np.sort(shingles[edges[i] : edges[i + 1]])
                keep = np.ones(len(own), bool)
                keep[1:] = own[1:] != own[:-1]
                yield own[keep]
            elif counts[i]:
                total = counts[i : i + 1].astype(np.uint64)
                for h in words.hashes[words.first[i] : words.first[i + 1]]:
                    total = mix(total + h)
                yield total
            else:
                yield np.zeros(0, np.uint64)


def set_id(own: np.ndarray) -> int:
    """A 64-bit name of a set; equal sets have equal names."""
    both = np.array([own.sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64), len(own)], np.uint64)
    return int(mix(mix(mix(both[:1]) + both[1:2]) + both[2:])[0].astype(np.int64))


def _needed(n: int, percent: int) -> int:
    return (percent * n + 99) // 100


def _hot(shingles: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.ones(len(shingles), bool)
    for j in range(4):
        at = (shingles >> np.uint64(j * 13)) & np.uint64(HOT_BITS - 1)
        out &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def _rows(docs: DataFrame, columns: list[str], f: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for out in f(batch):
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(*columns).mapInArrow(run, schema)


def sketch(own: np.ndarray) -> bytes:
    """Bits of the shingles' hashes. Two sets differ in at least as many shingles as their sketches in bits."""
    bits = np.zeros(SKETCH, bool)
    bits[(own >> np.uint64(20)).astype(np.int64) & (SKETCH - 1)] = True
    return np.packbits(bits).tobytes()


def _lists(sets: list[np.ndarray]) -> pa.Array:
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat.view(np.int64)))


def _signed(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """key, n and class of each row, and the whole set of some classes."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ids, sizes, drawn = [], [], []
        for own in shingle_sets(batch.column(1), k):
            ids.append(set_id(own) if len(own) else None)
            sizes.append(len(own))
            drawn.append(own if len(own) and ids[-1] % SAMPLE == 0 else own[:0])
        yield {"key": batch.column(0), "n": ints(sizes), "c": pa.array(ids, pa.int64()), "drawn": _lists(drawn)}

    return _rows(docs, [key, text], rows, f"key {kind}, n long, c long, drawn array<long>")


def _hot_bits(lists: DataFrame) -> np.ndarray:
    """A Bloom filter of the frequent shingles; its size is fixed."""
    counts = materialise(lists.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= HOT), "frequent")
    many, least = 0, HOT
    for df, n in counts.groupBy("df").count().orderBy(F.desc("df")).collect():  # one row for each count that occurs
        many += n
        if many > HOT_MANY:
            least = df + 1
            break
    bits = np.zeros(HOT_BITS >> 3, np.uint8)
    hot = counts.where(F.col("df") >= least).select("token").toArrow().column("token").to_numpy().astype(np.int64).view(np.uint64)
    for j in range(4):
        at = (hot >> np.uint64(j * 13)) & np.uint64(HOT_BITS - 1)
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)))
    return bits


def _prefixes(docs: DataFrame, text: str, k: int, percent: int, bits: np.ndarray) -> DataFrame:
    """c, n, the longest prefix, the sketch, and the rank of the prefix's end of each class, once for each task that meets it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        release()
        for batch in batches:
            ids, sizes, prefixes, sketches, ends = [], [], [], [], []
            for own in shingle_sets(batch.column(0), k):
                c = set_id(own) if len(own) else None
                if c is None or c in seen:
                    continue
                seen.add(c)
                hot = _hot(own, shared.value)
                ids.append(c)
                sizes.append(len(own))
                sketches.append(sketch(own))
                many = len(own) - _needed(len(own), percent) + MOST_MATCHES
                prefixes.append(np.concatenate([own[~hot], own[hot]])[:many])
                is_hot = int(len(own) - hot.sum() < len(prefixes[-1]))
                ends.append((is_hot << 62) + (int(prefixes[-1][-1]) >> 2))
            if ids:
                yield pa.RecordBatch.from_pydict({"c": ints(ids), "n": ints(sizes), "prefix": _lists(prefixes), "sketch": pa.array(sketches, pa.binary()), "end": ints(ends)})

    return docs.select(text).mapInArrow(run, "c long, n long, prefix array<long>, sketch binary, end long")


def _whole_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """c and the whole set (as bytes) of the wanted classes, each from the row of its smallest key (c, row: a hash of it)."""
    few = wanted.count() <= FILTER_IDS
    table = wanted.select("c", "row").orderBy("c").toArrow() if few else None
    shared = docs.sparkSession.sparkContext.broadcast(few and tuple(table.column(i).to_numpy() for i in range(2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, seen = shared.value, set()
        release()
        for batch in batches:
            found = []
            rows = batch.column(1).to_numpy()
            if keep:  # only rows that hold some class
                mine = np.isin(rows, keep[1])
                batch, rows = batch.filter(pa.array(mine)), rows[mine]
            for row, own in zip(rows, shingle_sets(batch.column(0), k)):
                c = set_id(own) if len(own) else None
                if c is None or c in seen:
                    continue
                if keep:
                    at = int(np.searchsorted(keep[0], c))
                    if at == len(keep[0]) or keep[0][at] != c or keep[1][at] != row:
                        continue
                seen.add(c)
                found.append((c, int(row), own.tobytes()))
            if found:
                ids, rows, sets = zip(*found)
                yield pa.RecordBatch.from_pydict({"c": ints(ids), "row": ints(rows), "own": pa.array(sets, pa.binary())})

    bounded_batches(docs.sparkSession)
    sets = docs.select(text, F.xxhash64(key).alias("row")).mapInArrow(run, "c long, row long, own binary")
    if not few:
        sets = sets.join(wanted.select("c", "row"), ["c", "row"], "left_semi")
    return materialise(sets.select("c", "own"), "sets")


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose whole sets meet the threshold."""
    left = sets.select(F.col("c").alias("a"), F.col("own").alias("x"))
    right = sets.select(F.col("c").alias("b"), F.col("own").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            if ok.any():
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialise(joined.mapInArrow(run, "a long, b long").distinct(), "similar")


def _offered(percent: int) -> Column:
    """Whether n and m shingles, with at most so many in common, can meet the threshold at all."""
    n, m = F.col("n"), F.col("m")
    # Ends of equal rank may stand in either order.
    common = F.when(F.col("end") < F.col("dend"), F.col("live")).when(F.col("end") > F.col("dend"), F.col("dlive")).otherwise(F.greatest("live", "dlive"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (100 * common >= percent * (n + m - common))


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): key, n and class c of each row; the root of each class that links with another.

    Pairs are compared as far as components need it: between classes already
    joined by links, further ones are left out.
    """
    signed = materialise(_signed(docs, key, text, k), "signed")
    drawn = signed.where("size(drawn) > 0").select("c", "drawn").dropDuplicates(["c"])
    bits = _hot_bits(drawn.select(F.explode("drawn").alias("token")))
    rows = materialise(signed.drop("drawn"), "rows")
    discard(signed)
    lists = materialise(_prefixes(docs, text, k, percent, bits), "prefixes")
    entries = lists.select("c", F.posexplode("prefix").alias("place", "token")).repartition("token")
    # Both sides of the join ask for all columns of the entries, so that these are shuffled once.
    common = entries.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max("place").alias("far"), F.count(F.lit(1)).alias("df")).where("low <> high")
    shared = materialise(entries.join(common.select("token", "far", "df"), "token").where("place <= far").drop("far").dropDuplicates(["token", "c"]), "lists")

    # The matches that each class asks for: the cheapest prefix, by list entries read and pairs compared.
    sizes = materialise(lists.select("c", "n", "end", F.size("prefix").alias("long")).dropDuplicates(["c"]), "sizes")
    base = F.col("n") - F.ceil(F.col("n") * percent / 100.0)
    reach = [F.sum(F.when(F.col("place") <= base + m, F.col("df")).otherwise(0)).alias(f"s{m}") for m in range(MOST_MATCHES)]
    sums = shared.join(sizes.select("c", "n"), "c").groupBy("c", "n").agg(*reach, F.count(F.lit(1)).alias("met"))
    costs = [F.struct((F.col(f"s{m}") * (1 + COMPARE_COST * F.col("n") / (m + 1))).alias("cost"), F.lit(m + 1).alias("matches")) for m in range(MOST_MATCHES)]
    allowed = [F.when(F.ceil(F.col("n") * percent / 100.0) >= m + 1, costs[m]) for m in range(MOST_MATCHES)]
    asked = sums.join(sizes.select("c", "end", "long"), "c").select(
        "c", "n", F.array_min(F.array_compact(F.array(*allowed))).getField("matches").alias("matches"), F.col("s0").alias("weight"),
        "end", (F.col("n") - (F.col("long") - F.col("met"))).alias("live"),
    )
    kept = materialise(shared.join(asked, "c").where(F.col("place") <= base + F.col("matches") - 1).drop("place", "df"), "asked")
    sketches = materialise(lists.join(kept.select("c").distinct(), "c", "left_semi").select("c", "sketch").dropDuplicates(["c"]), "sketches")
    discard(shared, sizes, lists)
    classes = rows.where("c is not null").groupBy("c").agg(F.xxhash64(F.min("key")).alias("row"))

    def compare(pairs: DataFrame) -> DataFrame:
        wanted = materialise(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct().join(classes, "c"), "wanted")
        sets = _whole_sets(docs, wanted, key, text, k)
        similar = _similar(pairs, sets, percent)
        discard(wanted, sets)
        return similar

    return rows, linked(kept, percent, compare, sketches)


def _across(here: DataFrame, mixed: DataFrame, percent: int, sketches: DataFrame | None) -> DataFrame:
    """Pairs of members of different components in short lists: token, a, b and the matches asked for."""
    short = mixed.where(F.col("size") <= SMALL).select("token", "main")
    sides = here.join(short, "token")
    other = here.select("token", F.col("c").alias("d"), F.col("n").alias("m"), F.col("root").alias("droot"), F.col("matches").alias("dmatches"), F.col("live").alias("dlive"), F.col("end").alias("dend"))
    outside = sides.where("root <> main.root").drop("main")
    few = outside.join(other, "token").where((F.col("root") != F.col("droot")) & _offered(percent))
    pairs = few.select("token", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), F.least("matches", "dmatches").alias("asked"))
    return pairs.union(_across_long(here, mixed, percent, sketches))


def _across_long(here: DataFrame, mixed: DataFrame, percent: int, sketches: DataFrame | None, nearest: bool = False) -> DataFrame:
    """The same for long lists, in pairs of bounded blocks; only pairs that their sketches allow come out.

    With `nearest`, each member comes with one other of its block only, the one
    whose sketch is nearest, and need share no further list with it.
    """
    members = here.join(mixed.where(F.col("size") > SMALL).select("token", "size"), "token")
    members = members.join(sketches, "c") if sketches is not None else members.withColumn("sketch", F.lit(None).cast("binary"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = members.withColumn("mine", F.pmod(F.xxhash64("c"), blocks).cast("int"))
    members = members.withColumn("other", F.col("mine") if nearest else F.explode(F.sequence(F.lit(0), blocks - 1)))
    members = members.select("token", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "c", "n", "root", "matches", "live", "end", "sketch")

    def compare(table: pa.Table) -> pa.Table:
        c, n, root, asked, mine, live, end = (table.column(x).to_numpy() for x in ("c", "n", "root", "matches", "mine", "live", "end"))
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        left, right = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
        right = right[np.argsort(c[right])]
        raw = table.column("sketch").to_pylist()
        bits = np.frombuffer(b"".join(raw), np.uint64).reshape(len(c), -1) if raw[0] is not None else None
        found = []
        for at in range(0, len(left), 64):
            i = left[at : at + 64]
            ok = (root[i][:, None] != root[right]) & (c[i][:, None] != c[right])
            ok &= 100 * np.minimum(n[i][:, None], n[right]) >= percent * np.maximum(n[i][:, None], n[right])
            first, later = end[i][:, None], end[right]
            common = np.where(first < later, live[i][:, None], np.where(first > later, live[right], np.maximum(live[i][:, None], live[right])))
            ok &= 100 * common >= percent * (n[i][:, None] + n[right] - common)
            if low == high and not nearest:
                ok &= c[i][:, None] < c[right]
            if bits is not None:
                apart = sum(np.bitwise_count(bits[i, w][:, None] ^ bits[right, w]).astype(np.int32) for w in range(bits.shape[1]))
                ok &= (100 + percent) * apart <= (100 - percent) * (n[i][:, None] + n[right])
            if nearest:
                x = np.flatnonzero(ok.any(axis=1))
                y = np.where(ok, apart, SKETCH + 1).argmin(axis=1)[x]  # the smaller of two that are as near
            else:
                x, y = np.nonzero(ok)
            found.append((i[x], right[y]))
        x, y = (np.concatenate(f) for f in zip(*found)) if found else (left[:0], right[:0])
        out = {"token": pa.array(np.full(len(x), table.column("token")[0].as_py(), np.int64)), "a": pa.array(np.minimum(c[x], c[y])),
               "b": pa.array(np.maximum(c[x], c[y])), "asked": pa.array(np.ones(len(x), np.int32) if nearest else np.minimum(asked[x], asked[y]).astype(np.int32))}
        return pa.table(out)

    return members.groupBy("token", "low", "high").applyInArrow(compare, "token long, a long, b long, asked int")


def _to_hubs(sides: DataFrame, percent: int) -> DataFrame:
    """Each member with the weightiest member of its list's largest component."""
    hub = [F.col(f"main.best.{x}").alias(y) for x, y in (("c", "d"), ("n", "m"), ("matches", "dmatches"), ("live", "dlive"), ("end", "dend"))]
    both = sides.select("token", "c", "n", "root", "matches", "live", "end", F.col("main.root").alias("droot"), *hub)
    both = both.where((F.col("root") != F.col("droot")) & _offered(percent))
    return both.select("token", F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"), F.least("matches", "dmatches").alias("asked"))


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """`labels` (c, root) with the components that the links (a, b) join made one."""
    left, right = (labels.select(F.col("c").alias(x), F.col("root").alias(f"root_{x}")) for x in ("a", "b"))
    between = found.join(left, "a").join(right, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    roots = components(between).select(F.col("node").alias("root"), F.col("root").alias("next"))
    return labels.join(roots, "root", "left").select("c", F.coalesce("next", "root").alias("root"))


def _several(labels: DataFrame) -> DataFrame:
    """The labels of components of two members or more."""
    others = labels.where("c <> root")
    return others.unionByName(others.select(F.col("root").alias("c"), "root").distinct())


def linked(kept: DataFrame, percent: int, compare: Callable[[DataFrame], DataFrame], sketches: DataFrame | None = None) -> DataFrame:
    """(c, root): the components of all pairs that share a list and compare as similar, without single members.

    The root is the component's smallest member.

    `kept`: token (the list), c (the member), n (its size), matches (lists a pair
    must share, by either side) and weight; if known, `live` (its shingles that
    another member may have) and `end` (see `_offered`). `compare` gives those of the pairs (a,
    b) that are similar. As long as the pairs across components are many, lists
    only offer their members to a hub, and then long lists only to the member whose
    sketch is nearest; at last all pairs across components are compared. A round's
    links join the components of the round before, so no link is gone through twice.
    """
    tried = kept.sparkSession.createDataFrame([], "a long, b long")
    if "live" not in kept.columns:
        kept = kept.withColumns({"live": F.col("n"), "end": F.lit(0).cast("long")})
    members = materialise(kept.select("c").distinct(), "members")
    labels = members.select("c", F.col("c").alias("root"))
    before = old = None
    ways = ["hubs", "nearest", "all"] if sketches is not None else ["hubs", "all"]

    def offered(way: str) -> DataFrame:
        if way == "hubs":
            return _to_hubs(here.join(mixed.select("token", "main"), "token"), percent)
        return _across(here, mixed, percent, sketches) if way == "all" else _across_long(here, mixed, percent, sketches, nearest=True)

    def untried(both: DataFrame) -> DataFrame:
        pairs = both.distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("same"), F.min("asked").alias("asked")).where("same >= asked").select("a", "b")
        return materialise(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")

    while True:
        here = materialise(kept.join(labels, "c"), "labelled")
        if old is not None:
            discard(*old)
        by_root = here.groupBy("token", "root").agg(F.count(F.lit(1)).alias("members"), F.max(F.struct("weight", "c", "n", "matches", "live", "end")).alias("best"))
        by_list = by_root.groupBy("token").agg(F.count(F.lit(1)).alias("roots"), F.sum("members").alias("size"), F.max(F.struct("members", "root", "best")).alias("main"))
        mixed = materialise(by_list.where("roots > 1"), "mixed")
        rest, entries = mixed.agg(F.sum((F.col("size") - F.col("main.members")) * F.col("size")), F.sum("size")).first()
        if rest is None:
            return _several(labels)
        # Hubs, or nearest members, that hardly save any more.
        if ways[0] != "all" and before is not None and rest > 0.8 * before:
            ways.pop(0)
        good = None
        while good is None:
            if ways[0] == "hubs" and rest <= 4 * entries:  # few pairs are left
                ways.pop(0)
            if ways[0] == "nearest" and rest <= DENSE * entries:
                ways.pop(0)
            pairs = untried(offered(ways[0]))
            if ways[0] == "all" or pairs.count() * FEW_PAIRS >= entries:
                tried, good = tried.union(pairs), compare(pairs)
            if ways[0] != "all" and (good is None or good.isEmpty()):  # they have hardly any pair to offer, or no similar one
                ways.pop(0)
                good = None
        before = rest
        if not good.isEmpty():
            labels = materialise(_joined(labels, good), "roots")
        if ways[0] == "all":
            discard(here, mixed)
            return _several(labels)
        # A list of one component stays so, and takes no part in what follows.
        kept, old = here.drop("root").join(mixed.select("token"), "token", "left_semi"), (here, mixed)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """key, `n_shingles` and `component_id` (the smallest key reachable by links, itself included) for each row.

    Null and empty texts have no shingles and link with nothing: their component
    is their own key. Equal texts are one class; repeated rows come back each. Rows
    with a null key get the component of their class, which is null only if all its
    keys are. Other columns are left out; an empty table gives no rows.
    """
    rows, roots = links(docs, key, text, k, percent)
    classes = rows.where("c is not null").groupBy("c").agg(F.min("key").alias("low"))
    named = classes.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = materialise(named.join(lowest, "root").select("c", "component_id"), "classes")
    out = rows.select("key", "n", "c").join(classes, "c", "left")
    component = F.when(F.col("c").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
