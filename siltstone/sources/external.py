"""External tables: files described by a schema, a format and a path layout."""

from __future__ import annotations

import gzip
import posixpath
import re
import uuid
from collections.abc import Mapping as Map, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, types as T
from pyspark.sql import functions as F

from .. import files
from ..functions.types import parse_schema
from .tables import CSV_OPTIONS, sized_writer

# Formats and header modes.
READABLE = ("csv", "tsv", "json", "parquet", "orc", "text")
WRITABLE = ("csv", "tsv", "json", "parquet")
HEADERS = ("All", "FirstFile", "None")
ENCODINGS = ("UTF8NoBOM", "UTF8BOM")


def _decoded(part: Column) -> Column:
    """A partition value as Spark escapes it in a folder name. A plus sign is no space here."""
    return F.coalesce(F.try_url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))), part)


def _value(name: Column) -> Column:
    return _decoded(F.nullif(name, F.lit("__HIVE_DEFAULT_PARTITION__")))


def _value_in_uri(part: Column) -> Column:
    """The same of a folder name inside a URI, which is escaped once more."""
    part = F.nullif(part, F.lit("__HIVE_DEFAULT_PARTITION__"))
    return _decoded(F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B"))))


def _layout_pattern(layout: str) -> str:
    return re.sub(r"\\\{(\w+)\\\}", r"([^/]+)", re.escape(layout))


@dataclass(frozen=True)
class ExternalTable:
    """`paths` may be one comma-separated text. `partitions` lists the columns
    that live in the path: hive style (``year=1996``) by default, or in the
    order and style of `path_format`, such as ``{year}/m-{month}``."""

    schema: str
    data_format: str
    paths: str | Sequence[str]
    partitions: Sequence[str] = ()
    path_format: str | None = None
    name_prefix: str = ""
    file_extension: str = ""
    include_headers: str = "All"
    encoding: str = "UTF8NoBOM"
    compressed: bool = False
    options: Map[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.data_format not in READABLE:
            raise ValueError(f"unknown format {self.data_format!r}")
        if self.include_headers not in HEADERS:
            raise ValueError(f"include_headers must be one of {HEADERS}")
        if self.encoding not in ENCODINGS:
            raise ValueError(f"encoding must be one of {ENCODINGS}")

    @property
    def struct(self) -> T.StructType:
        return parse_schema(self.schema)

    @property
    def path_list(self) -> list[str]:
        paths = self.paths.split(",") if isinstance(self.paths, str) else self.paths
        return [p.strip().rstrip("/") for p in paths if p.strip()]

    @property
    def _spark_format(self) -> str:
        return "csv" if self.data_format == "tsv" else self.data_format

    @property
    def _options(self) -> dict[str, str]:
        options = dict(CSV_OPTIONS) if self._spark_format == "csv" else {}
        if self.data_format == "tsv":
            options["sep"] = "\t"
        return {**options, **self.options}

    def _glob(self, spark: SparkSession, wanted: Map[str, object]) -> list[str]:
        """Paths narrowed to the wanted partition values of a custom layout, at
        the top or, for exports, in the folder of each run. Values are compared as
        the column's type, so ``m-1`` and ``m-01`` are both month 1."""
        if not self.path_format:
            return self.path_list
        found = []
        for path in self.path_list:
            tops = [n for n in files.names(spark, path) if not n.startswith(("_", "."))]
            runs = [n for n in tops if n.startswith("run=")]
            if not self._columns(self.path_format).isdisjoint(wanted):
                for base in [path, *[f"{path}/{n}" for n in runs]]:
                    found += self._narrowed(spark, base, wanted)
                continue
            pattern = re.sub(r"\{\w+\}", "*", self.path_format)
            if runs:
                found.append(f"{path}/run=*/{pattern}")
            if len(runs) < len(tops) or not tops:
                found.append(f"{path}/{pattern}")
        return found

    @staticmethod
    def _columns(layout: str) -> set[str]:
        return set(re.findall(r"\{(\w+)\}", layout))

    def _narrowed(self, spark: SparkSession, base: str, wanted: Map[str, object]) -> list[str]:
        """Globs below `base`. Folders are listed level by level, as far down as a value is wanted."""
        levels = self.path_format.strip("/").split("/")
        last = max(i for i, level in enumerate(levels) if not self._columns(level).isdisjoint(wanted))
        found = [(base, base)]  # as listed, and as a glob
        for level in levels[: last + 1]:
            hidden = ("_", ".", "run=") if found == [(base, base)] else ("_", ".")
            listed = [(f, g, n) for f, g in found for n in files.names(spark, f) if not n.startswith(hidden)]
            fit = self._fitting(spark, sorted({n for _, _, n in listed}), level, wanted)
            found = [(f"{f}/{n}", f"{g}/" + re.sub(r"([\\{}\[\]*?])", r"\\\1", n)) for f, g, n in listed if n in fit]
        rest = [re.sub(r"\{\w+\}", "*", level) for level in levels[last + 1 :]]
        return ["/".join([g, *rest]) for _, g in found]

    def _fitting(self, spark: SparkSession, names: list[str], level: str, wanted: Map[str, object]) -> set[str]:
        """Those folder names of a level that hold the wanted values."""
        pattern = f"^{_layout_pattern(level)}$"
        fits = F.col("name").rlike(pattern)
        for i, column in enumerate(re.findall(r"\{(\w+)\}", level)):
            if column in wanted:
                value = _value(F.regexp_extract("name", pattern, i + 1)).try_cast(self.struct[column].dataType)
                fits = fits & (value == F.lit(wanted[column]))
        return {r["name"] for r in spark.createDataFrame([(n,) for n in names], "name string").where(fits).collect()}

    def _load(self, spark: SparkSession, paths: list[str], header: bool) -> DataFrame:
        struct = self.struct
        if not paths:  # no folder has the wanted values
            return spark.createDataFrame([], struct)
        if self.path_format:
            struct = T.StructType([f for f in struct if f.name not in self.partitions])
        reader = spark.read.schema(struct).format(self._spark_format).options(**self._options)
        if self._spark_format == "csv":
            reader = reader.option("header", header)
        reader = self._named(reader)
        if not self.path_format and len(self.path_list) == 1:
            reader = reader.option("basePath", self.path_list[0])
        df = reader.load(paths)
        if not self.path_format:
            return df
        return df.select("*", *self._parts_of_path())

    def _named(self, reader: DataFrameReader) -> DataFrameReader:
        """Only files with the names that the table asks for."""
        if not (self.name_prefix or self.file_extension):
            return reader
        packed = "{,.gz}" if self.file_extension else ""
        return reader.option("pathGlobFilter", f"{self.name_prefix}*{self.file_extension}{packed}")

    def _parts_of_path(self) -> list[Column]:
        """The partition columns, from the path of a file."""
        if self.path_format:  # anchored at the end: the layout is what lies just above the file
            layout = _layout_pattern(self.path_format) + r"/[^/]*$"
            found = [(name, layout, i + 1) for i, name in enumerate(re.findall(r"\{(\w+)\}", self.path_format))]
        else:
            found = [(name, f"/{re.escape(name)}=([^/]*)/", 1) for name in self.partitions]
        return [_value_in_uri(F.regexp_extract("_metadata.file_path", pattern, i)).try_cast(self.struct[name].dataType).alias(name) for name, pattern, i in found]

    def _listed(self, spark: SparkSession) -> DataFrame:
        """The files that would be read, by their metadata alone: none is opened."""
        reader = self._named(spark.read.format("binaryFile"))
        if not self.path_format:
            reader = reader.option("recursiveFileLookup", True)
        return reader.load(self._glob(spark, {}))

    def read(self, spark: SparkSession, **wanted: object) -> DataFrame:
        """Rows of the table. Filters on hive partitions prune by themselves;
        for a custom layout, give partition values to list only their files."""
        paths = self._glob(spark, wanted)
        if self._spark_format != "csv" or self.include_headers != "FirstFile":
            df = self._load(spark, paths, self.include_headers == "All")
        else:
            # The listing is the one Spark keeps for the scan anyway.
            found = sorted(unquote(f) for f in self._load(spark, paths, False).inputFiles())
            firsts: dict[str, str] = {}
            for path in found:
                firsts.setdefault(posixpath.dirname(path), path)
            headed = set(firsts.values())
            rest = [p for p in found if p not in headed]
            df = self._load(spark, sorted(headed), True)
            if rest:
                df = df.unionByName(self._load(spark, rest, False))
        if self.path_format:
            for name, value in wanted.items():
                df = df.where(F.col(name) == F.lit(value))
        return df.select(*self.struct.fieldNames())

    def write(self, df: DataFrame, path: str | None = None, *, distributed: bool = True,
              size_limit: int | None = None, row_group_rows: int | None = None) -> str:
        """Write rows in the table's layout below `path` (its first path by default)."""
        if self.data_format not in WRITABLE:
            raise ValueError(f"{self.data_format} files can be read but not written")
        spark, path = df.sparkSession, (path or self.path_list[0]).rstrip("/")
        df = df.select(*self.struct.fieldNames())
        columns = [c for c in df.columns if c not in self.partitions]
        is_csv, header = self._spark_format == "csv", self.include_headers
        if is_csv and self.encoding == "UTF8BOM":
            if header == "None":
                raise ValueError("a byte order mark is written with the header; headers are off")
            if header == "All":  # the mark goes in front of the first header name
                df = df.withColumnRenamed(columns[0], "\ufeff" + columns[0])
        # A custom layout is written hive style beside its target, then moved.
        staged = f"{path}/_staged-{uuid.uuid4().hex}" if self.path_format else path
        # Few files per folder; a folder with many rows still gets several tasks.
        writer = sized_writer(
            df, distributed=distributed, size_limit=size_limit, row_group_rows=row_group_rows, near=self.partitions
        ).format(self._spark_format).options(**self._options)
        if is_csv:
            writer = writer.option("header", header == "All")
        if self._spark_format in ("csv", "json"):  # Spark's default keeps milliseconds only
            writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        if self.compressed and self.data_format != "parquet":
            writer = writer.option("compression", "gzip")
        if self.name_prefix:
            writer = writer.option("mapreduce.output.basename", f"{self.name_prefix}part")
        if self.partitions:
            writer = writer.partitionBy(*self.partitions)
        writer.mode("append" if not self.path_format else "errorifexists").save(staged)
        self._place(spark, staged, path, columns, header == "FirstFile" and is_csv)
        return path

    def _place(self, spark: SparkSession, staged: str, path: str, columns: list[str], head: bool) -> None:
        """Give folders the custom layout, files their extension, and each folder
        its header file. Only names change; no rows move."""
        if not (self.path_format or self.file_extension or head):
            return
        # Decoded: the listing gives URIs.
        written = [
            unquote(f)
            for f in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(staged).inputFiles()
        ]
        folders: dict[str, str] = {}
        for folder in {posixpath.dirname(f) for f in written}:
            folders[folder] = folder
            if self.path_format:
                values = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
                folders[folder] = f"{path}/" + re.sub(r"\{(\w+)\}", lambda m: values[m.group(1)], self.path_format)
        moved = set()
        for old, new in folders.items():
            if old != new and not files.exists(spark, new):
                files.make_dirs(spark, posixpath.dirname(new))
                files.rename(spark, old, new)
                moved.add(old)
        for old in written:
            folder, name = posixpath.split(old)
            at, target = (folders[folder] if folder in moved else folder), folders[folder]
            wanted = name
            given = re.match(r"(.*[-.]c\d{3,})\.(?:csv|json|(?:\w+\.)?parquet)(\.gz)?$", name)  # Spark's names
            if self.file_extension and given:
                wanted = given.group(1) + self.file_extension + (given.group(2) or "")
            if (at, name) != (target, wanted):
                files.rename(spark, f"{at}/{name}", f"{target}/{wanted}")
        if head:
            mark = "\ufeff" if self.encoding == "UTF8BOM" else ""
            line = (mark + self._options.get("sep", ",").join(columns) + "\n").encode("utf-8")
            ending = (self.file_extension or ".csv") + (".gz" if self.compressed else "")
            for folder in set(folders.values()):
                # Sorts before Spark's own part-... names, so it is the first file.
                name = f"{folder}/{self.name_prefix}header{ending}"
                if not files.exists(spark, name):
                    files.write_new_bytes(spark, name, gzip.compress(line) if self.compressed else line)

    def sample_uris(self, spark: SparkSession) -> DataFrame:
        """The folder of each distinct combination of partition values, from the paths of the files."""
        base = self.path_list[0]
        if not self.partitions:
            return spark.createDataFrame([(base,)], "uri string").limit(1)
        rows = self._listed(spark).select(*self._parts_of_path())
        if self.path_format:
            pieces = re.split(r"(\{\w+\})", self.path_format)
            parts = [F.col(p[1:-1]).cast("string") if p.startswith("{") else F.lit(p) for p in pieces if p]
            uri = F.concat(F.lit(base + "/"), *parts)
        else:
            uri = F.concat_ws("/", F.lit(base), *[F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in self.partitions])
        return rows.select(*self.partitions).distinct().select(uri.alias("uri"))

    def files_preview(self, spark: SparkSession) -> DataFrame:
        """Path, size and modification time of each file that would be read; no file is opened."""
        return self._listed(spark).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")

    def check_not_empty(self, spark: SparkSession) -> None:
        if self.read(spark).isEmpty():
            raise ValueError("the external table has no rows")

    def dry_run(self, spark: SparkSession) -> T.StructType:
        """Analyse only: the schema the table would have."""
        return self.read(spark).schema
