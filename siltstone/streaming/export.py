"""Continuous export: each run writes the rows that are new since the last."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import files
from ..functions.types import parse_timespan
from ..operators.lifecycle import INGESTION_TIME, before, ntz
from ..plans.stored import Functions, Query, run_query
from ..sources.external import ExternalTable
from ..sources.tables import SNAPSHOT_EVERY, Table


@dataclass(frozen=True)
class ContinuousExport:
    """`query` reads the new rows as ``{source}`` (or by the argument `source`)."""

    query: Query
    external: ExternalTable
    interval: str = "10h"
    forced_latency: str | None = None
    size_limit: int = 100_000_000
    distributed: bool = True
    row_group_rows: int = 100_000
    disabled: bool = False
    time: str = INGESTION_TIME

    def __post_init__(self):
        if parse_timespan(self.interval) < parse_timespan("1m"):
            raise ValueError("the interval between runs is at least one minute")
        if not 100_000_000 <= self.size_limit <= 1_000_000_000:
            raise ValueError("the size limit lies between 100 MB and 1 GB")

    def _progress(self, spark: SparkSession, state: str, runs: list[str]) -> tuple[set[str], dict[str, str]]:
        """Batches that are out, and for those that are out in part the time reached.
        Every SNAPSHOT_EVERY runs all batches are written down, so few files are read."""
        whole = max((n for n in files.names(spark, state) if n.endswith(".snapshot")), default="")
        done = set(json.loads(files.read_text(spark, f"{state}/{whole}"))["batches"]) if whole else set()
        partly: dict[str, str] = {}
        for run in (r for r in runs if r.split(".")[0] >= whole.split(".")[0]):
            found = json.loads(files.read_text(spark, f"{state}/{run}"))
            done.update(found.get("batches", []))
            partly = found.get("partly", {})
        return done, partly

    def _due(self, source: Table, done: set[str], partly: dict[str, str], upto: Column) -> tuple[DataFrame, dict[str, datetime | None]]:
        """Rows that are due, and the latest time in each batch that is not out whole.

        Under a forced latency a batch gives the rows that have waited long enough;
        its others, and they alone, wait for a later run."""
        waiting = [b for b in source.batches if b not in done]
        if self.forced_latency is None:
            return source.read_batches(waiting), dict.fromkeys(waiting)
        time, rows = F.col(self.time), source.read_batches([])
        for reached in {partly.get(b) for b in waiting}:  # one for each run that left rows behind
            some = source.read_batches([b for b in waiting if partly.get(b) == reached])
            rows = rows.unionByName(some.where((time <= upto) | time.isNull() if reached is None else (time <= upto) & (time > ntz(reached))))
        ends = {r["part"]: r["last"] for r in source.part_ends(self.time, waiting).collect()}  # one for each batch that waits
        return rows, {b: ends.get(part) for part, held in source.folders.items() for b in held if b in set(waiting)}

    def run(self, spark: SparkSession, source: DataFrame | Table, state: str, as_of: datetime | str,
            functions: Functions | None = None) -> bool:
        """One run. Rows that arrived within the forced latency wait for a later
        run. A run that died is repeated into the same folder.

        The batches of a :class:`Table` that were exported are kept in `state`, so
        rows that come late, at equal times or without a time are written once. A
        plain DataFrame has no batches; there the reached time is kept, and rows
        stamped before it that appear later are not seen."""
        if self.disabled:
            return False
        runs = [n for n in files.names(spark, state) if n.endswith(".json")]
        last = json.loads(files.read_text(spark, f"{state}/{max(runs)}"))["upto"] if runs else None
        upto = ntz(as_of) if self.forced_latency is None else before(as_of, self.forced_latency)
        batches, partly = None, {}
        if isinstance(source, Table):
            done, partly = self._progress(spark, state, runs)
            rows, ends = self._due(source, done, partly, upto)
        else:
            rows = source.where(F.col(self.time) <= upto)
            if last is not None:
                rows = rows.where(F.col(self.time) > ntz(last))
        folder = f"{self.external.path_list[0]}/run={len(runs):012d}"
        if files.exists(spark, folder):
            files.rename(spark, folder, f"{self.external.path_list[0]}/_left-{len(runs):012d}-{datetime.now():%Y%m%d%H%M%S%f}")
        result = run_query(spark, self.query, functions, source=rows)
        self.external.write(
            result, folder, distributed=self.distributed, size_limit=self.size_limit,
            row_group_rows=self.row_group_rows if self.external.data_format == "parquet" else None,
        )
        reached = spark.range(1).select(upto.cast("string")).first()[0]
        if isinstance(source, Table):
            limit = datetime.fromisoformat(reached)
            late = set() if self.forced_latency is None else {b for b, end in ends.items() if end is not None and end > limit}
            batches = sorted(ends.keys() - late)
            partly = {b: max(reached, partly.get(b, reached)) for b in sorted(late)}
        if last is not None:
            reached = max(reached, last)
        known = {} if batches is None else {"batches": batches, "partly": partly}
        files.write_new_text(spark, f"{state}/{len(runs):012d}.json", json.dumps({"upto": reached, **known}))
        if batches is not None and len(runs) % SNAPSHOT_EVERY == SNAPSHOT_EVERY - 1:
            files.write_new_text(spark, f"{state}/{len(runs):012d}.snapshot", json.dumps({"batches": sorted(done.union(batches))}))
        return True

    def start(self, stream: DataFrame, checkpoint: str, functions: Functions | None = None, **trigger) -> StreamingQuery:
        """Export a stream through the file sink, which keeps its own record of
        what was written. What the sink cannot do is refused and needs :meth:`run`.
        File sizes follow the source's batches."""
        if self.forced_latency is not None:
            raise ValueError("a forced latency needs run(), which remembers the rows held back")
        result = run_query(stream.sparkSession, self.query, functions, source=stream)
        if self.external.path_format:
            raise ValueError("a custom path format needs run(), which moves files into place")
        spark_format = "csv" if self.external.data_format == "tsv" else self.external.data_format
        table, default = self.external, type(self).size_limit
        unable = {
            "name_prefix": table.name_prefix, "file_extension": table.file_extension, "size_limit": self.size_limit != default,
            "encoding": spark_format == "csv" and table.encoding == "UTF8BOM", "include_headers": spark_format == "csv" and table.include_headers == "FirstFile",
        }
        if refused := [name for name, given in unable.items() if given]:
            raise ValueError(f"the file sink has no {', '.join(refused)}; use run()")
        if not self.distributed:
            result = result.coalesce(1)
        writer = (
            result.select(*self.external.struct.fieldNames())
            .writeStream.format(spark_format)
            .options(**self.external._options)
            .option("checkpointLocation", checkpoint)
            .option("path", self.external.path_list[0])
        )
        if spark_format == "csv":
            writer = writer.option("header", self.external.include_headers == "All")
        if spark_format in ("csv", "json"):
            writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        if spark_format == "parquet":
            writer = writer.option("parquet.block.row.count.limit", self.row_group_rows)
        elif table.compressed:
            writer = writer.option("compression", "gzip")
        if self.external.partitions:
            writer = writer.partitionBy(*self.external.partitions)
        seconds = parse_timespan(self.interval) // 1_000_000
        return writer.trigger(**(trigger or {"processingTime": f"{seconds} seconds"})).start()
