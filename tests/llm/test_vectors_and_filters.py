"""The filter audit, the vector-approximation search and the clustering against brute force and on odd tables."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import approximation_files, centroids, filter_audit

DOCS = "doc_id long, text string, source string, part string, fails int, docs long, edge int, good int"
LABELS = "doc_id long, quality int, toxic int, good int"
VECTORS = "vec_id long, embedding array<float>, id int, v int, page int, cluster int, rank int"


def documents(spark, rows):
    """Extra columns clash with the operator's own names."""
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3, 4) for i, t, s in rows], DOCS)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], VECTORS)


def audited(spark, docs, labels):
    failures = filter_audit.standard_failures(F.coalesce(F.col("text"), F.lit("")))
    labelled = spark.createDataFrame([(*r, 7) for r in labels], LABELS)
    return filter_audit.audit(filter_audit.failure_sets(documents(spark, docs), labelled, failures), "ABCDE").collect()


def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    rows = []
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}.items() if bad}
        rows.append((s or "", fails, i is not None and i in good, i is not None and i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left, gone = [r for r in rows if r[0] == part], []
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                redundant = sum(f in r[1] for r in gone)
                gone += removed
                shapley[part, f] += len(removed)
                unique = sum(r[0] == part and r[1] == {f} for r in rows)
                out[part, "".join(order), step] = [len(left), len(removed), redundant, unique, sum(r[2] for r in removed), sum(r[3] for r in removed)]
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_audit_against_brute_force(spark):
    random = np.random.default_rng(1)
    docs = []
    for i in range(150):
        words = [f"w{x}" for x in random.integers(0, int(random.choice([20, 5000])), int(random.choice([30, 199, 200, 400])))]
        if random.random() < 0.3:
            words[:20] = ["ABC"] * 20
        if random.random() < 0.3:
            words[3] = str(random.choice(list("#$%&*|")))
        docs.append((i, "\n".join([" ".join(words[:9]), "\t".join(words[9:])]), str(random.choice(["a", "a", "a", "b", ""]))))
    docs += [(1000 + i, docs[i % 7][1], "hot") for i in range(60)] + [(2, docs[2][1], "b"), (2, docs[2][1], docs[2][2])]
    docs += [(2000, None, None), (2001, "", "a"), (2002, "Ünï 　 " + "é" * 400, None), (None, docs[0][1], "a"), (None, docs[0][1], "a"), (2003, "x" * 300_000 + " y" * 30_000, "long")]
    labels = [(i, int(random.integers(2)), int(random.integers(2))) for i in range(0, 150, 2)] + [(1003, 1, None), (1003, 0, 1), (None, 1, 1), (2000, None, 1)]
    got = audited(spark, docs, labels)
    assert {tuple(r) for r in got} == brute_audit(docs, labels) and len(got) == 600 * 5


def test_audit_of_nothing(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    rows = audited(spark, [(1, None, None)], [])
    assert {r.part for r in rows} == {""} and len(rows) == 600 and sum(r.removed for r in rows) == 120


def test_paths_of_the_lattice():
    for n in range(1, 6):
        uses = Counter()
        for order in itertools.permutations(range(n)):
            for i, f in enumerate(order):
                uses[sum(1 << g for g in order[:i]), f] += 1
        assert uses == {(state, f): reach * leave for state, f, reach, leave in filter_audit.edges(n)}


ODD_VECTORS = [(1000, None), (1020, [1.0, None]), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (1080, []), (1100, []), (1120, [1.0]), (None, [0.1] * 8), (1140, [0.0] * 8)]


def mixed(random, n=400, dim=8):
    base = np.round(random.normal(size=(n, dim)), 1).astype(np.float32)  # many ties
    base[n // 4 : n // 2] = base[7]  # a vector that a quarter of all rows share
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    return rows + [rows[20], rows[20], rows[30], (20, base[50].tolist()), (21, base[20].tolist())]


def whole(v, scale):
    return None if v is None or any(x is None or not np.isfinite(x) for x in v) else tuple(int(np.floor(scale * x)) for x in v)


def brute_search(rows, k, scale=64):
    rows = {(i, whole(v, scale)) for i, v in rows if i is not None and whole(v, scale) is not None}
    out = Counter()
    for q in rows:
        if q[0] % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q[1], c[1])), c[0]) for c in rows if c != q and len(c[1]) == len(q[1]))
            out.update((q[0], rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1))
    return out


@pytest.mark.parametrize("page_rows", [10_000, 60])
def test_search_against_brute_force(spark, monkeypatch, page_rows):
    monkeypatch.setattr(approximation_files, "PAGE_QUERIES", 7)
    rows = mixed(np.random.default_rng(2)) + ODD_VECTORS
    table = vectors(spark, rows)
    files = approximation_files.build_files(table, k=5, page_rows=page_rows)
    got = approximation_files.search(files, table.where("vec_id % 20 = 0"), k=5).collect()
    assert Counter(tuple(r) for r in got) == brute_search(rows, 5)


def test_search_sends_neither_blocks_nor_pages_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(approximation_files, "PAGE_QUERIES", 7)
    rows = mixed(np.random.default_rng(6))
    table = vectors(spark, rows)
    found = approximation_files.search(approximation_files.build_files(table, k=5, page_rows=60), table.where("vec_id % 20 = 0"), k=5)
    assert Counter(tuple(r) for r in found.collect()) == brute_search(rows, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert "Generate" not in plan  # nor are blocks copied for each page


def test_search_of_nothing_and_of_too_much(spark):
    empty = vectors(spark, [])
    some = vectors(spark, [(0, [1.0, 2.0]), (20, [-1.0, 0.5])])
    assert approximation_files.search(approximation_files.build_files(empty, k=3), some, k=3).collect() == []
    files = approximation_files.build_files(some, k=3)
    assert approximation_files.search(files, empty, k=3).collect() == []
    assert {tuple(r) for r in approximation_files.search(files, some, k=3).collect()} == {(0, 1, 20, 0), (20, 1, 0, 0)}
    with pytest.raises(Exception, match="64 bits"):
        approximation_files.build_files(vectors(spark, [(1, [3e38] * 4)]), k=3)


@pytest.mark.parametrize("cells", [2, 8, 32, 256])
def test_bounds_hold_and_exact_reads_are_few(cells):
    random = np.random.default_rng(3)
    x = np.floor(64 * random.normal(size=(3000, 24)) / 5).astype(np.int64)
    q = x[::30]
    file = approximation_files.approximate(x, cells)
    assert (file["low"][np.arange(24), file["codes"]] <= x).all() and (x <= file["high"][np.arange(24), file["codes"]]).all()
    page = approximation_files.Page(x, order=np.arange(3000), **file)
    who, entry, score = page.best(q, 10)
    exact = q @ x.T
    for i in range(len(q)):
        best = sorted(range(3000), key=lambda j: (-exact[i, j], j))[:10]
        assert entry[who == i].tolist() == best and score[who == i].tolist() == exact[i, best].tolist()
    assert page.read < (1.0 if cells == 2 else 0.25 if cells == 8 else 0.05) * exact.size


def brute_clusters(rows, clusters, rounds, width, scale=1024):
    kept = [(i, whole(v, scale)) for i, v in rows if v is not None and len(v) == width and whole(v, scale) is not None]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres, x = [list(v) for _, v in order[:clusters]], np.array([v for _, v in kept], object).reshape(len(kept), width)

    def nearest():
        far = np.array([((x - np.array(c, object)) ** 2).sum(axis=1) for c in centres]).T
        return far.argmin(axis=1), far.min(axis=1)

    for _ in range(rounds):
        own, _ = nearest()
        for j in range(len(centres)):
            if (own == j).any():
                centres[j] = [int(s) // int((own == j).sum()) for s in x[own == j].sum(axis=0)]
    own, far = nearest()
    inertia = defaultdict(int)
    for j, d in zip(own, far):
        inertia[j] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, int(j), d, inertia[j], sum(inertia.values()), names[j]) for (i, _), j, d in zip(kept, own, far))


@pytest.mark.parametrize("rounds", [0, 1, 10])
def test_clusters_against_brute_force(spark, rounds):
    rows = mixed(np.random.default_rng(4), dim=12) + ODD_VECTORS + [(None, [0.5] * 12), (None, [0.5] * 12), (7, [-0.5] * 12)]
    got = centroids.cluster(vectors(spark, rows), clusters=8, rounds=rounds, width=12, sample=100).collect()
    assert Counter(tuple(r) for r in got) == brute_clusters(rows, 8, rounds, 12)


def test_clusters_of_few_vectors(spark):
    assert centroids.cluster(vectors(spark, ODD_VECTORS[:4]), width=64).collect() == []
    few = [(1, [0.25, -0.3]), (2, [0.25, -0.3]), (3, [5.0, 1.0]), (None, [1.0, 1.0])]
    got = centroids.cluster(vectors(spark, few), clusters=8, width=2).collect()
    assert Counter(tuple(r) for r in got) == brute_clusters(few, 8, 10, 2)
    same = [(i, [1.5, 2.5, 3.5]) for i in range(50)]
    got = centroids.cluster(vectors(spark, same), clusters=4, width=3).collect()
    assert Counter(tuple(r) for r in got) == brute_clusters(same, 4, 10, 3)


def test_apexes_bound_distances_and_pass_over_centroids():
    random = np.random.default_rng(5)
    centres = random.integers(-1000, 1000, (8, 16))
    x = centres[random.integers(0, 8, 4000)] + random.integers(-100, 100, (4000, 16))
    pivots = np.concatenate([centres[:5] + 40, centres[:1] + 40, np.zeros((1, 16), int)])  # one comes twice
    simplex = centroids.Simplex(pivots)
    assert simplex.size == 6
    nearest = centroids.Nearest(simplex, centres)
    exact = centroids.Simplex._squares(x, centres)
    own = nearest(x, simplex.apexes(x))
    assert (own == exact.argmin(axis=1)).all()
    assert nearest.compared < 0.3 * exact.size
    a, c = simplex.apexes(x), nearest.apexes
    low = ((a[:, None] - c[None]) ** 2).sum(-1)
    assert (low <= exact * (1 + 1e-9) + 1e-3).all()
