"""Update policies: new rows of a source table, transformed into target tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import schema as schemas
from ..operators.lifecycle import INGESTION_TIME, with_ingestion_time
from ..plans.stored import Functions, Query, run_query
from ..sources.tables import Table, commit_together

log = logging.getLogger(__name__)
TAGS = "_tags"


@dataclass(frozen=True)
class UpdatePolicy:
    """`query` reads the new rows as ``{source}`` (or by the argument `source`)."""

    source: str
    target: str
    query: Query
    enabled: bool = True
    transactional: bool = False
    propagate: bool = False


class Ingestion:
    """Tables with update policies. A target may be the source of other policies;
    cycles are refused."""

    def __init__(self, spark: SparkSession, root: str, policies: Sequence[UpdatePolicy], functions: Functions | None = None):
        self.spark, self.root, self.functions = spark, root, functions
        self.policies = [p for p in policies if p.enabled]
        feeds: dict[str, set[str]] = {}
        for p in policies:
            feeds.setdefault(p.target, set()).add(p.source)
            feeds.setdefault(p.source, set())
        try:
            self.order = list(TopologicalSorter(feeds).static_order())
        except CycleError as error:
            raise ValueError(f"update policies form a cycle: {error.args[1]}") from None

    def table(self, name: str) -> Table:
        return Table(self.spark, f"{self.root}/{name}")

    def ingest(self, rows: DataFrame, source: str, batch_id: str, *, as_of: datetime | str | None = None,
               tags: Sequence[str] = ()) -> list[str]:
        """Take one batch into `source` and on through the policies.

        All parts are written before any is committed, and the source and all
        targets are one commit. A failing transactional policy, and a crash at any
        time, therefore leave every table as it was; a failing other policy is
        logged and its target left out. Commits carry the batch id, so a batch
        replayed after a crash only adds what is not there yet. Gives the
        targets that failed.
        """
        stamped = with_ingestion_time(rows, as_of=as_of).withColumn(TAGS, F.lit(",".join(tags)))
        staged: dict[str, list[tuple[str, str]]] = {}
        failed: list[str] = []
        fresh: dict[str, list[DataFrame]] = {}

        def stage(name: str, label: str, df: DataFrame) -> None:
            table = self.table(name)
            schema = table.schema if table.exists() else fresh[name][0].schema if name in fresh else None
            if schema is not None:
                schemas.refuse_extra_columns(schema, df.schema)
                df = schemas.conform(df, schema)
            part = table.stage(df)
            staged.setdefault(name, []).append((label, part))
            # Policies read what was written; the batch is computed once.
            written = self.spark.read.schema(df.schema).parquet(f"{table.path}/{part}")
            fresh.setdefault(name, []).append(written)

        stage(source, f"{batch_id}", stamped)
        for name in self.order:
            for policy in (p for p in self.policies if p.target == name):
                for i, new_rows in enumerate(fresh.get(policy.source, [])):
                    try:
                        stage(name, f"{batch_id}/{policy.source}/{i}", self._transform(policy, new_rows, as_of))
                    except Exception:
                        if policy.transactional:
                            raise
                        log.exception("update policy %s -> %s failed; source rows are kept", policy.source, policy.target)
                        failed.append(policy.target)
        pending = []
        for name, parts in staged.items():
            table = self.table(name)
            have = set(table.batches) if table.exists() else set()
            new = {label: part for label, part in parts if label not in have}
            if new:
                pending.append((table, new, table.schema if table.exists() else fresh[name][0].schema))
        if pending:
            commit_together(self.spark, self.root, pending)
        return failed

    def _transform(self, policy: UpdatePolicy, rows: DataFrame, as_of) -> DataFrame:
        result = run_query(self.spark, policy.query, self.functions, source=rows)
        if policy.propagate:
            lost = [c for c in (INGESTION_TIME, TAGS) if c not in result.columns]
            if lost:
                # Both are constant within a batch.
                first = rows.select(*lost).first()
                result = result.withColumns(
                    {c: F.lit(first[c] if first else None).cast(rows.schema[c].dataType) for c in lost}
                )
            return result
        return with_ingestion_time(result.drop(INGESTION_TIME, TAGS), as_of=as_of).withColumn(TAGS, F.lit(""))

    def start(self, stream: DataFrame, source: str, checkpoint: str, **trigger) -> StreamingQuery:
        """Run as a stream; each micro-batch is one ingested batch."""
        return (
            stream.writeStream.foreachBatch(lambda df, batch_id: self.ingest(df, source, str(batch_id)))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
