"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import decontaminate, jaccard_join, language, packing, pii
from siltstone.llm.frames import crc32_of_id, materialise, read_table
from siltstone.llm.frames import name as fresh_name
from siltstone.llm.queries import tokenizer_model
from siltstone.session import small_side

#: A text of at least so many characters is in no known language if the best one has less than this share of its n-grams.
LONG_ENOUGH, LEAST_KNOWN = 40, 0.1
#: Near duplicates share so many in 100 of their shingles of so many words.
SHINGLE, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts that are null, without letters or like no learned language go."""
    model = language.train(docs.where(crc32_of_id("doc_id") % 3 != 1))
    found = language.identify(docs, model)
    foreign = (F.length("text") >= LONG_ENOUGH) & (F.col("known") < LEAST_KNOWN)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & ~foreign).select(docs.columns)


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a name for each row, in the order of ids, null last; only repeated rows have the same.

    It follows from the row, so it stays the same without a copy of the documents.
    """
    row = fresh_name(docs, "_row")
    every = F.xxhash64(*[x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))])
    return docs.withColumn(row, F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), every.alias("every"))), row


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates, the one with the smallest id, null last; repeated rows stay once."""
    rows, row = _named(docs)
    groups = materialise(jaccard_join.near_duplicates(rows, key=row, k=SHINGLE, percent=PERCENT).select(row, "component_id"), "groups")
    stays = F.col(row) == F.col("component_id")
    losers = materialise(groups.where(~stays).select(row).distinct(), "losers")
    twice = materialise(groups.where(stays).groupBy(row).count().where("count > 1").select(row), "twice")
    kept = rows.join(small_side(losers), row, "left_anti")
    if twice.isEmpty():
        return kept.select(docs.columns)
    twice = small_side(twice)
    once, again = kept.join(twice, row, "left_anti"), kept.join(twice, row, "left_semi")
    return once.select(docs.columns).unionByName(again.select(docs.columns).dropDuplicates())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    rows, row = _named(docs)
    found = decontaminate.leaks(rows.select(row, "text"), read_table(spark, sf_dir, "benchmark"), key=row)
    leaking = materialise(found.select(row).distinct(), "leaking")
    return rows.join(small_side(leaking), row, "left_anti").select(docs.columns)


def sanitise_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and disclosing words replaced; `n_chars` follows the text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, placed in sequences of 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_model(), capacity=1024, end_id=2)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", sanitise_personal_data),
    ("packing", pack),
]

#: The stages learn, cluster and tokenise; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
