"""The registered queries of the operators: whole tables in, digests of the results out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import approximation_files, centroids, filter_audit
from siltstone.llm.decontaminate import leaks
from siltstone.llm.frames import crc32_of_id, materialise, read_table
from siltstone.llm.jaccard_join import near_duplicates
from siltstone.llm.language import identify, train
from siltstone.llm.licenses import license_spans
from siltstone.llm.neighbours import build_index, search
from siltstone.llm.packing import pack_documents
from siltstone.llm.pii import KINDS, disclosing_words, find_spans
from siltstone.llm.quality import score
from siltstone.llm.quality import train as train_votes
from siltstone.llm.sharding import shard_documents
from siltstone.llm.substring_dedup import repeated_passages


#: One is exact search; see the README for recall and work at larger factors.
PRUNING_FACTOR = 1.0


def tokenizer_model() -> str:
    """The tokenizer as text; it travels to the executors as a broadcast."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op1_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op2_conditional_compression(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices in all documents."""
    return license_spans(read_table(spark, folder, "documents"))


def op3_histogram_sort(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes."""
    return shard_documents(read_table(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_language_bitmask(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = read_table(spark, folder, "documents")
    held_out = crc32_of_id("doc_id") % 3 == 1
    model = train(docs.where(~held_out))
    return identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op5_vantage_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest neighbours of every fiftieth vector."""
    vectors = read_table(spark, folder, "embeddings")
    return search(build_index(vectors, k=5), vectors.where("vec_id % 50 = 0"), k=5, factor=PRUNING_FACTOR)


def op6_disclosure(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data and disclosing words in every document."""
    docs = read_table(spark, folder, "documents")
    found = find_spans(docs.select("doc_id", "text"), materialise(disclosing_words(docs), "disclosing"))
    base = F.filter("pii", lambda s: s.kind != "term")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def of_kind(kind):
        return F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(of_kind, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


def op7_exact_complement(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack_documents(read_table(spark, folder, "documents"), tokenizer_model(), capacity=1024, end_id=2).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    )


def op8_adaptive_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 85 in 100 of their four-word shingles."""
    return near_duplicates(read_table(spark, folder, "documents"), k=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op9_neighbour_votes(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by its labelled neighbours, learned from four fifths of the labels."""
    docs = read_table(spark, folder, "documents")
    held_out = crc32_of_id("doc_id") % 5 == 0
    model = train_votes(docs.select("doc_id", "text"), read_table(spark, folder, "labels").where(~held_out))
    scored = score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_paragraph_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Passages that several documents have."""
    return repeated_passages(read_table(spark, folder, "documents"))


def op11_path_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes in every order of application, by source."""
    failures = filter_audit.standard_failures(F.coalesce(F.col("text"), F.lit("")))
    sets = filter_audit.failure_sets(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), failures)
    return filter_audit.audit(sets, "ABCDE")


def op12_vector_approximation(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty greatest integer inner products of every twentieth vector."""
    vectors = read_table(spark, folder, "embeddings")
    return approximation_files.search(approximation_files.build_files(vectors, k=20), vectors.where("vec_id % 20 = 0"), k=20)


def op13_simplex_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of the vectors after ten rounds."""
    return centroids.cluster(read_table(spark, folder, "embeddings"), clusters=8, rounds=10)


QUERIES = {
    q.__name__: q
    for q in (
        op1_simhash_windows, op2_conditional_compression, op3_histogram_sort, op4_language_bitmask, op5_vantage_trees,
        op6_disclosure, op7_exact_complement, op8_adaptive_prefixes, op9_neighbour_votes, op10_paragraph_bands,
        op11_path_counts, op12_vector_approximation, op13_simplex_centroids,
    )
}
_FINITE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0"


def _rounds_sql(rounds: int) -> str:
    """One assignment after another, each over the centroids that the one before it left."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
            SELECT r, min(vec_id) AS vec_id, any_value(v) AS v, min({{'distance': distance, 'cluster': cluster}}) AS best FROM (
                SELECT r, vec_id, v, cluster, list_sum([(t[1] - t[2]) * (t[1] - t[2]) FOR t IN list_zip(v, c)])::BIGINT AS distance FROM kept, c{i}
            ) GROUP BY r
        )""")
        if i < rounds:
            parts.append(f"""m{i} AS (
            SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
                SELECT best.cluster AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, range(1, 65) t(i) GROUP BY ALL
            ) GROUP BY cluster
        ), c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return ",\n        ".join(parts)


SQL = {
    "op11_path_counts": r"""
        WITH RECURSIVE orders(o) AS (
            SELECT '' UNION ALL SELECT o || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) t(l) WHERE strpos(o, l) = 0
        ), docs AS (
            SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t,
                   [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents
        ), failing AS (
            SELECT part, doc_id, CASE WHEN len(words) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
            FROM docs
        ), marks AS (
            SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), sets AS (
            SELECT part, fails, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
            FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails
        ), steps AS (
            SELECT o, step::INT AS step, substr(o, step, 1) AS letter, substr(o, 1, step - 1) AS before FROM orders, range(1, 6) t(step) WHERE length(o) = 5
        ), met AS (
            SELECT *, strpos(fails, letter) > 0 AS fails_this, translate(fails, before, '') <> fails AS fails_before FROM sets, steps
        ), counted AS (
            SELECT part, o AS filter_order, step, letter,
                   coalesce(sum(docs) FILTER (NOT fails_before AND NOT fails_this), 0)::BIGINT AS kept,
                   coalesce(sum(docs) FILTER (fails_this AND NOT fails_before), 0)::BIGINT AS removed,
                   coalesce(sum(docs) FILTER (fails_this AND fails_before), 0)::BIGINT AS redundant,
                   coalesce(sum(docs) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (fails_this AND NOT fails_before), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (fails_this AND NOT fails_before), 0)::BIGINT AS toxic_lost
            FROM met GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM counted
    """,
    "op12_vector_approximation": f"""
        WITH v AS (
            SELECT DISTINCT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}
        ), pairs AS (
            SELECT q.vec_id AS query_id, q.e AS own, c.vec_id, coalesce(list_sum([t[1] * t[2] FOR t IN list_zip(q.e, c.e)]), 0)::BIGINT AS score
            FROM v q JOIN v c ON len(q.e) = len(c.e) AND (q.vec_id <> c.vec_id OR q.e <> c.e) WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id, own ORDER BY score DESC, vec_id)::INT AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op13_simplex_centroids": f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}
        ), c0 AS MATERIALIZED (
            SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1)::INT AS cluster, v AS c FROM kept QUALIFY cluster < 8
        ),
        {_rounds_sql(10)}
        SELECT vec_id, best.cluster AS cluster, best.distance AS distance, (sum(best.distance) OVER (PARTITION BY best.cluster))::BIGINT AS cluster_inertia,
               (sum(best.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a10 JOIN c10 ON c10.cluster = best.cluster
    """,
    "op5_vantage_trees": """
        WITH v AS (
            SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
              AND len([x FOR x IN embedding IF x <> 0]) > 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_dot_product(q.e, c.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
}
