"""Each operator against a brute-force version, and on odd tables."""

import re
import tracemalloc
import types
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from siltstone import files
from siltstone.llm import decontaminate, jaccard_join, language, licenses, neighbours, packing, pii, quality, sharding, substring_dedup
from siltstone.llm.components import components
from siltstone.llm.queries import tokenizer_model

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, pii int, c long, key string"
LONG = "word" * 50_000 + " " + "lorem ipsum dolor sit amet " * 2_000


def table(spark, rows):
    """A table of documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, "s", None, "x", 1, 2, "k") for i, t, lang in rows], SCHEMA)


ODD = [(1, None, "en"), (2, "", None), (3, " \n ", "en"), (4, "a", "en"), (5, "Ünïcode çafé 漢字", "fr"), (6, LONG, "en"), (6, LONG, "en"),
       (7, "same old text of seven words here", "en"), (8, "same old text of seven words here", "en"), (None, "an id is missing in this row", "de"), (9, "!!! ... 123", "es")]


def every(spark):
    items = spark.createDataFrame([(1, "same old text of seven words here"), (2, None), (3, "x")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 0), (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    return {
        "decontaminate": lambda d: decontaminate.leaks(d, items),
        "licenses": lambda d: licenses.license_spans(d),
        "sharding": lambda d: sharding.shard_documents(d, shards=3),
        "language": lambda d: language.identify(d, language.train(d)),
        "pii": lambda d: pii.find_spans(d, pii.disclosing_words(d)),
        "sanitise": lambda d: pii.sanitise(d),
        "packing": lambda d: packing.pack_documents(d, tokenizer_model(), capacity=64),
        "jaccard_join": lambda d: jaccard_join.near_duplicates(d),
        "quality": lambda d: quality.score(d, quality.train(d, labels)),
        "substring_dedup": lambda d: substring_dedup.repeated_passages(d),
    }


NAMES = ["decontaminate", "licenses", "sharding", "language", "pii", "sanitise", "packing", "jaccard_join", "quality", "substring_dedup"]
PER_ROW = {"sharding", "language", "pii", "sanitise", "jaccard_join", "quality"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, name):
    out = every(spark)[name](table(spark, ODD))
    rows = out.collect()
    if name in PER_ROW:
        assert len(rows) == len(ODD)
    if name == "decontaminate":
        assert {(r.doc_id, r.item_id) for r in rows} == {(7, 1), (8, 1)}
    if name == "language":
        assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 9}
    if name == "jaccard_join":
        assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 7), (None, None), (9, 9)}


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert every(spark)[name](table(spark, [])).collect() == []


def test_shards_hold_equal_bytes_and_gapless_slots(spark):
    rows = [(i, "hot copy " * 20 if i % 3 == 0 else f"text {i} " * (i % 37), "en") for i in range(3000)]
    out = sharding.shard_documents(table(spark, rows), shards=7, task_bytes=4000).collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in out:
        assert r.size == len((r.text or "").encode()) + 1
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(out) == 3000 and set(size) == set(range(7))
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in out)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("repeated", ["a row that comes very often", None])
def test_repeated_rows_are_split_over_shards(spark, repeated):
    rows = [(5, repeated, "en")] * 8000 + [(i, f"text {i} " * (i % 9), "en") for i in range(1000, 3000)] + [(None, "x", "en")] * 50
    out = sharding.shard_documents(table(spark, rows), shards=16, task_bytes=3000).collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in out:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(out) == len(rows) and set(size) == set(range(16))
    share = sum(size.values()) / 16
    assert all(abs(s - share) <= 0.15 * share for s in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_language_held_out(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    out = language.identify(docs.where(held), language.train(docs.where(~held))).collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) >= 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_bitmask_gives_all_languages(spark):
    docs = table(spark, [(1, "alpha beta", "xx"), (2, "alpha gamma", "yy")])
    model = language.train(docs)
    codes = np.frombuffer(b"hpla", np.uint8)  # "alph" as two trigrams: alp, lph
    for gram, wanted in ((b"alp", 3), (b"bet", 1), (b"gam", 2)):
        code = np.array([int.from_bytes(gram, "big")], np.uint32)
        mask = np.uint64(2**64 - 1)
        for place in language._places(code, len(model.slots)):
            mask &= model.slots[place][0]
        assert int(mask) & wanted == wanted
    assert len(codes) == 4


def test_trees_find_what_brute_force_finds(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(400, 8)).astype(np.float32)
    base[100:200] = base[7]  # a vector that a quarter of all rows share
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000, None), (1001, [0.0] * 8), (1002, [1.0, None]), (1003, [float("nan")] * 8), (1004, []), (1005, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = neighbours.build_index(vectors, shard_rows=100)
    got = defaultdict(list)
    for r in neighbours.search(index, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    x = base.astype(float)
    cos = (x @ x.T) / np.sqrt((x**2).sum(1))[:, None] / np.sqrt((x**2).sum(1))[None, :]
    for q in range(0, 400, 50):
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-round(cos[q, i], 12), i))
        assert got[q] == order[:5]
    assert set(got) == set(range(0, 400, 50))


def test_relaxed_pruning_keeps_recall():
    random = np.random.default_rng(2)
    x = random.normal(size=(3000, 6))
    tree, ids = neighbours.build_tree(x), np.arange(3000)
    exact = neighbours.Search(tree, ids, x[::30], 6, 1.0)
    relaxed = neighbours.Search(tree, ids, x[::30], 6, 1.5)
    assert relaxed.visited < exact.visited < 3000 * 100
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(exact.at, relaxed.at)]) >= 0.9


PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            if kind == "ip" and max(int(p) for p in m[0].split(".")) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_base_spans(seed):
    random = np.random.default_rng(seed)
    for _ in range(3000):
        text = "".join(random.choice(list("a.@-+% ()019é\n256"), size=random.integers(0, 60)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_disclosing_words(spark):
    filler = [f"plain words number {i} of an ordinary text about nothing at all" for i in range(40)]
    leaks = [f"note {i} the zanzibarian agent wrote from a@b.com today" for i in range(4)]
    docs = table(spark, [(i, t, "en") for i, t in enumerate(filler + leaks)])
    words = {r.word: r.disclosure for r in pii.disclosing_words(docs, threshold=0.9).collect()}
    df = 4  # documents with the entity, and with the word
    assert words["zanzibarian"] == pytest.approx(np.log(44 * df / (df * df)) / -np.log(df / 45))
    assert "of" not in words and "at" not in words
    texts = [r.text for r in pii.sanitise(docs, removal=2.0).orderBy("doc_id").collect()]
    assert texts[:40] == filler
    assert "zanzibarian" not in texts[41] and "[EMAIL]" in texts[41] and "[TERM]" in texts[41]


def test_sanitising_in_parts_changes_nothing(spark, monkeypatch):
    filler = [f"plain words number {i} of an ordinary text about nothing at all" for i in range(40)]
    leaks = [f"note {i} the zanzibarian agent and the corvidian clerk wrote from a@b.com to +49 30 1234567" for i in range(4)]
    docs = table(spark, [(i, t, "en") for i, t in enumerate([*filler, *leaks, None])])
    whole = [r.text for r in pii.sanitise(docs, removal=2.0).orderBy("doc_id").collect()]
    monkeypatch.setattr(pii, "PASS", 2)
    parts = [r.text for r in pii.sanitise(docs, removal=2.0).orderBy("doc_id").collect()]
    assert whole == parts and whole[44] is None and whole[41].count("[TERM]") > 2


def test_pieces_are_the_tokenizer_s(spark, sf):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    odd = ["", "a  b\n\n c d 　 x", "don't  'tis <|endoftext|> it's!\nNew ,.", "1 2\t3 \r\n é è ñ's", "  z", "漢字 かな 1,5%"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = packing.pack_documents(docs, tokenizer_model(), capacity=128, keep_ids=True).collect()
    ids, places = defaultdict(dict), defaultdict(list)
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= 128
        ids[r.doc_id][r.start] = r.ids
        places[r.sequence_id].append((r.offset, r.length))
    for i, text in texts.items():
        whole = [t for start in sorted(ids[i]) for t in ids[i][start]]
        assert whole == model.encode(text, add_special_tokens=False).ids + [2], text
        assert all(len(p) == 128 for s, p in ids[i].items() if s)
    for spots in places.values():
        spots.sort()
        assert [o for o, _ in spots] == [sum(n for _, n in spots[:k]) for k in range(len(spots))] and sum(n for _, n in spots) <= 128
    total = sum(r.length for r in out)
    assert len(places) <= 1.02 * total / 128 + 1


def test_plan_fills_gaps_exactly():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 15, 10, 5]] = 10, 4, 3, 3, 6, 6
    made = packing.plan(counts, 100)
    used = np.zeros(101, np.int64)
    for times, parts in made:
        assert sum(parts) <= 100
        np.add.at(used, parts, times)
    assert (used == counts).all()
    assert sum(t for t, p in made if sum(p) == 100) >= 7


def brute_components(docs, k=4, percent=85):
    parent, sets = {i: i for i, _ in docs}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("small", [32, 2])
def test_join_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [list(random.choice(words, 60)) for _ in range(6)]
    docs = []
    for i in range(240):  # copies with few to many changes, and a passage that many share
        text = list(base[i % 6])
        for at in random.integers(0, 60, random.integers(0, 5)):
            text[at] = str(random.choice(words))
        if i % 4 == 0:
            text = [*base[0][:20], *random.choice(words, 12)]
        docs.append((i, " ".join(text)))
    docs += [(500, "one two"), (501, "One TWO"), (502, "two one"), (503, ""), (504, None)]
    got = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(docs)


def test_no_link_is_gone_through_twice(spark, monkeypatch):
    random, given = np.random.default_rng(4), []
    words = [f"w{i}" for i in range(300)]
    base, docs = list(random.choice(words, 80)), []
    for i in range(300):  # one large group of near copies
        text = list(base)
        for at in random.integers(0, 80, random.integers(0, 4)):
            text[at] = str(random.choice(words))
        docs.append((i, " ".join(text)))

    def counted(links):
        given.append({tuple(sorted(r)) for r in links.collect()})
        return components(links)

    monkeypatch.setattr(jaccard_join, "components", counted)
    got = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(docs)
    assert sum(map(len, given)) == len(set().union(*given))


def test_near_copies_make_few_pairs_though_hubs_link_none(spark, monkeypatch):
    random, made, real = np.random.default_rng(6), [], (jaccard_join._to_hubs, jaccard_join._across)
    words = [f"w{i}" for i in range(300)]
    base, docs = list(random.choice(words, 80)), []
    for i in range(300):
        text = list(base)
        for at in random.integers(0, 80, random.integers(0, 3)):
            text[at] = str(random.choice(words))
        docs.append((i, " ".join(text)))

    monkeypatch.setattr(jaccard_join, "_to_hubs", lambda sides, percent: real[0](sides, percent).where("a % 50 = 0"))
    monkeypatch.setattr(jaccard_join, "_across", lambda *given: made.append(real[1](*given).count()) or real[1](*given))
    got = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == brute_components(docs)
    assert sum(made) < 10 * len(docs)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(50)] + [(100 + i, 100) for i in range(30)] + [(200, 200)]
    got = {tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(51)} | {(100 + i, 100) for i in range(30)}


def test_fingerprints_within_the_radius_are_candidates():
    random = np.random.default_rng(5)
    for _ in range(300):
        a = int(random.integers(0, 2**63))
        flips = random.choice(64, decontaminate.RADIUS, replace=False)
        b = a
        for f in flips:
            b ^= 1 << int(f)
        blocks = [((a >> 16 * j) & 0xFFFF, (b >> 16 * j) & 0xFFFF) for j in range(4)]
        assert any(y in decontaminate._near(x) for x, y in blocks)


def test_the_search_for_leaks_takes_little_memory():
    random, words = np.random.default_rng(6), [f"word{i}" for i in range(3000)]
    texts = pa.array([" ".join(random.choice(words, 200)) for _ in range(2000)])
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(2000)), "text": texts})
    find = decontaminate._finder(types.SimpleNamespace(value=[(1, " ".join(words[:30]))]), 0.8, "doc_id", "item_id")
    list(find(iter([batch])))
    tracemalloc.start()
    try:
        list(find(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 8 * batch.nbytes
    finally:
        tracemalloc.stop()


def test_leaks_against_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")

    def plain(text):
        return " " + " ".join(w.strip(".,;:!?()[]\"'") for w in text.lower().split()) + " "

    texts, wanted = {r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in items.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in wanted.items() if plain(x) in plain(t)}
    got = decontaminate.leaks(docs, items).collect()
    assert exact <= {(r.doc_id, r.item_id) for r in got}
    for r in got:
        a, b = plain(texts[r.doc_id][r.start : r.end]).split(), plain(wanted[r.item_id]).split()
        same = {tuple(a[k : k + 5]) for k in range(len(a) - 4)} & {tuple(b[k : k + 5]) for k in range(len(b) - 4)}
        assert r.similarity >= 0.8 and len(same) >= 0.7 * (len(b) - 4)


def test_altered_passage_is_found(spark):
    words = [f"term{i}" for i in range(60)]
    changed = [*words[:30], "other", *words[31:]]
    docs = table(spark, [(1, "before " * 50 + " ".join(changed) + " after" * 50, "en"), (2, "nothing to see here " * 30, "en")])
    items = spark.createDataFrame([(9, " ".join(words))], "item_id long, text string")
    got = decontaminate.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 9)] and 0.8 <= got[0].similarity < 1


def test_licences(spark):
    rows = [(1, "x\nLicensed under the Apache License, Version 2.0.\ny", "en"), (2, "Released under the MIT license", "en"),
            (3, "This work is licensed under the GNU General Public License, version 2.", "en"), (4, "a licence to drive a car is needed here", "en")]
    got = {r.doc_id: (r.license_id, r.start, r.end) for r in licenses.license_spans(table(spark, rows)).collect()}
    assert got == {1: ("Apache-2.0", 2, 49), 2: ("MIT", 0, 30), 3: ("GPL-2.0", 0, 70)}


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.train(docs, labels.where(~held))
    out = quality.score(docs, model).join(labels.where(held), "doc_id").collect()
    assert np.mean([(r.score >= 0.3) == r.quality for r in out]) >= 0.93


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.98), (0.5, 0.9)):
        b, r = substring_dedup.tuned_bands(threshold, recall)
        assert r >= 2 and 1 - (1 - threshold**r) ** b >= recall


def test_passages_in_the_middle_of_lines(spark):
    random = np.random.default_rng(4)

    def words(n):
        return [f"v{x}" for x in random.integers(0, 10**6, n)]

    docs = []
    for i in range(20):
        passage = words(70)
        for j in range(2):
            docs.append((2 * i + j, " ".join([*words(int(random.integers(5, 80))), *passage, *words(40)]), "en"))
    docs += [(100 + i, " ".join(words(150)), "en") for i in range(20)]
    got = substring_dedup.repeated_passages(table(spark, docs)).collect()
    assert {r.doc_id for r in got} == set(range(40))
    assert all(r.removed == (r.doc_id % 2 == 1) and r.cluster_id == r.doc_id // 2 * 2 for r in got)


def test_pipeline_drops_and_keeps(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in kept.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    leaking = {r.doc_id for r in decontaminate.leaks(docs, items).collect()}
    losers = {i for i, _, root in brute_components(sorted(texts.items())) if i != root}
    silent = {i for i, t in texts.items() if not re.search(r"[^\W\d_]", t or "")}
    assert set(rows) == set(texts) - leaking - losers - silent
    assert all(not plain_spans(r.text) for r in rows.values())
    packed = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    assert packed == set(rows)


def test_pipeline_drops_copies_and_leaks_of_rows_without_an_id(spark, folder):
    import corpus_pipeline

    words = [f"w{i}" for i in range(100)]
    texts = [(3, " ".join(words)), (None, " ".join([*words, *(f"x{i}" for i in range(22))])),  # 96 of 118 five-word shingles
             (None, "one text that two rows without an id have word for word"), (None, "one text that two rows without an id have word for word"),
             (5, "a first text under an id that comes twice here"), (5, "and the second, unlike the first in all of its words"),
             (None, "before " * 20 + "the passage of the benchmark that must not be learned by heart" + " after" * 20), (8, None), (8, None), (9, "")]
    docs = table(spark, [(i, t, "en") for i, t in texts])
    copies = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert copies.columns == docs.columns
    got = sorted(((r.doc_id or 0), r.text or "") for r in copies.collect())
    assert got == sorted(((i or 0), t or "") for i, t in {x: None for k, x in enumerate(texts) if k != 1})
    sf = folder()
    spark.createDataFrame([(1, "the passage of the benchmark that must not be learned by heart")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    left = corpus_pipeline.drop_contaminated(spark, docs, sf).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == sorted((i or 0, t or "") for k, (i, t) in enumerate(texts) if k != 6)


def test_pipeline_writes_no_copy_of_the_documents(spark, folder, monkeypatch):
    import corpus_pipeline

    docs = table(spark, [(i, f"some text of {i} that is like no other {i * i} at all", "en") for i in range(20)] + [(None, "one that has no id", "en")] * 2)
    written = []
    monkeypatch.setattr(corpus_pipeline, "materialise", lambda df, label: written.append(df) or df)
    sf = folder()
    spark.createDataFrame([(1, "some text of 7 that is like no other 49 at all")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.drop_near_duplicates(spark, docs, sf).count() == 21
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, sf).collect()} == {None, *range(20)} - {7}
    assert written and all("text" not in df.columns for df in written)


def test_join_reads_its_entries_once_and_drops_prefixes(spark, monkeypatch):
    plans, held, real = {}, {}, jaccard_join.materialise

    def noted(df, label="stage"):
        plans[label], out = df, real(df, label)
        held[label] = out._folder
        return out

    monkeypatch.setattr(jaccard_join, "materialise", noted)
    docs = [(i, " ".join(f"w{j + i % 3}" for j in range(40))) for i in range(30)]
    rows, roots = jaccard_join.links(spark.createDataFrame(docs, "doc_id long, text string"))
    columns = re.findall(  # one set of columns for both sides, so that they share one shuffle
        r"Project \[c#\d+L, (?:place#\d+, )?token#\d+L\]|Generate .*", plans["lists"]._jdf.queryExecution().optimizedPlan().toString()
    )
    assert len({re.sub(r"#\d+", "", c) for c in columns}) == 1
    assert not any(files.exists(spark, held[x]) for x in ("prefixes", "signed", "lists"))
    assert rows.count() == 30


def test_pipeline_components_against_brute_force(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()}
    assert kept == {i for i, _, root in brute_components(sorted(texts.items()), k=5, percent=80) if i == root}


def brute_disclosure(texts, support=3):
    """Largest disclosure of each word over the entities, from all words of all distinct texts."""
    with_word, with_entity, both, total = defaultdict(int), defaultdict(int), defaultdict(int), len(set(texts))
    for text in set(texts):
        spans = pii.base_spans(text)
        terms = list(pii._terms(text))
        words = {w for w, a, b in terms if not any(a < y and x < b for _, x, y in spans)}
        entities = {pii.entity(k, text[a:b]) for k, a, b in spans}
        for w in {w for w, _, _ in terms}:
            with_word[w] += 1
        for e in entities:
            with_entity[e] += 1
            for w in words:
                both[w, e] += 1
    out = defaultdict(lambda: -9.0)
    for (w, e), n in both.items():
        if n >= support and with_entity[e] >= support:
            out[w] = max(out[w], np.log(n * total / (with_word[w] * with_entity[e])) / -np.log(with_entity[e] / (total + 1)))
    return dict(out)


@pytest.mark.parametrize("small", [500_000, 7])
def test_disclosure_counts_copies_once_and_reads_whole_texts(spark, monkeypatch, small):
    monkeypatch.setattr(pii, "PASS", small)
    random = np.random.default_rng(6)
    texts = [" ".join(f"p{x}" for x in random.integers(0, 60, 12)) for _ in range(120)]
    leaks = [f"Zanzibaré {i} {'and on ' * 20}wrote from a@b.com, seen (nearby) {'or so ' * 20} the corvidian p{i}" for i in range(4)]
    more = [f"the corvidian clerk {i} called +49 30 1234567 or mailed a@b.com\nvesperal" for i in range(3)]
    texts += [*leaks, *[leaks[0]] * 200, *more, *[texts[0]] * 50]
    docs = table(spark, [(i, t, "en") for i, t in enumerate([*texts, None])])
    for threshold in (0.9, 0.3):
        got = {r.word: r.disclosure for r in pii.disclosing_words(docs, threshold=threshold).collect()}
        assert got == pytest.approx({w: d for w, d in brute_disclosure(texts).items() if d >= threshold})
        assert small == 7 or {"vesperal", "Zanzibaré".replace("Z", "z"), "corvidian", "nearby"} <= set(got)
        if small == 7:
            break
