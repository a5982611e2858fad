"""Incremental file sources (CSV, tab-delimited text, JSON, parquet).

One description, :class:`FileSource`, yields either a streaming DataFrame (the
built-in file stream: each file read once, progress in the checkpoint) or a
batch DataFrame over an explicit list of files (used by the changed-file
ledger).  Landed columns are strings, as a schema-inferring loader produces:
CSV is read without type inference and JSON with ``primitivesAsString``.

Options understood from a feed config:

* ``glob_filter``      -- ``pathGlobFilter`` on file names
* ``include_existing`` -- when false, files that are there at the first run are skipped
* ``schema`` / ``schema_hints`` / ``schema_location`` -- fixed, hinted or remembered schema
* ``rescued_data_column`` -- what does not fit the schema, as text.  JSON (lines,
  or whole files with ``multiLine``) keeps, as JSON, the fields that the schema
  lacks and the values that could not be converted, in structs, array elements and
  maps as well; a line that is no JSON is kept whole.  Parquet batches keep
  columns and nested fields that the schema lacks.  CSV keeps the whole line when
  it does not parse (feed jobs turn Spark's CSV column pruning off for such runs,
  so every column of the line is checked), and columns that the schema lacks.

Inference reads every file that no inference has seen, without a limit on their
number or age.  CSV columns are matched by header name: a batch reads the files
of each distinct header together and lines their columns up.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.headers import first_lines
from landfall.sources.ledger import listing
from landfall.sources.rescue import json_documents, rescue_columns, rescue_json
from landfall.sources.schemas import SchemaMemory, apply_hints
from landfall.tables import conform, evolve_schema

# Reader defaults per configured format.  "tsv" and "text" name the
# tab-delimited drop; all delimited formats carry a header row.
_DELIMITED = {"csv": ",", "tsv": "\t", "text": "\t"}


def spark_format(file_format: str) -> str:
    f = file_format.lower()
    return "csv" if f in _DELIMITED else f


def reader_options(file_format: str, options: dict | None = None) -> dict:
    f = file_format.lower()
    opts: dict[str, str] = {}
    if f in _DELIMITED:
        opts.update({"header": "true", "sep": _DELIMITED[f], "inferSchema": "false",
                     # a header that does not match the schema must fail, not misassign
                     "enforceSchema": "false",
                     # header names keep their spaces ("User Division ")
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    elif f == "json":
        opts.update({"primitivesAsString": "true"})
    for k, v in (options or {}).items():
        opts[k] = str(v).lower() if isinstance(v, bool) else str(v)
    return opts


@dataclass
class FileSource:
    input_path: str
    file_format: str
    glob_filter: str | None = None
    options: dict = field(default_factory=dict)
    schema: T.StructType | str | None = None
    schema_hints: str | None = None
    schema_location: str | None = None
    new_columns: str = "add"                 # remembered schema: add | ignore | rescue
    rescued_data_column: str | None = None
    include_existing: bool = True
    existing: str | None = None              # set by the feed: listing of the files to leave out
    max_files_per_trigger: int | None = 1000
    max_bytes_per_trigger: str | None = None
    infer_batch: int = 1000                   # later inferences name this many files at a time

    # ---- schema ----------------------------------------------------------
    def _opts(self) -> dict:
        opts = reader_options(self.file_format, self.options)
        if self.glob_filter:
            opts["pathGlobFilter"] = self.glob_filter
        return opts

    def resolve_schema(self, spark: SparkSession) -> T.StructType:
        """Fixed schema, or inferred (once, remembered at ``schema_location``)
        with hints applied on top.  With ``new_columns="add"`` later runs
        infer from every file that no inference has seen and merge what they
        find into the remembered schema."""
        if self.schema is not None:
            base = T.StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema
            return apply_hints(base, self.schema_hints)
        memory = SchemaMemory(spark, self.schema_location) if self.schema_location else None
        remembered = memory.load() if memory else None
        if remembered is not None and self.new_columns in ("ignore", "rescue"):
            return apply_hints(remembered, self.schema_hints)
        files = listing(spark, self.input_path, self.glob_filter)
        if memory is not None:
            # listed once: what arrives from here on is unseen
            files = memory.listed(files)
        if remembered is None:
            inferred = self._infer(spark, None)
            if inferred is None:
                raise FileNotFoundError(
                    f"no file matching {self.glob_filter or '*'} in {self.input_path} to infer a schema from")
        else:
            files = memory.unseen(files)
            inferred = self._infer_new(spark, files)
            if inferred is None:
                return apply_hints(remembered, self.schema_hints)
        schema = apply_hints(inferred, self.schema_hints)
        if remembered is not None:
            schema = apply_hints(evolve_schema(remembered, schema), self.schema_hints)
        if memory is not None:
            memory.save(schema, files)
        return schema

    def infers(self) -> bool:
        """Whether files can bring new columns into the schema."""
        return self.schema is None and self.new_columns == "add"

    def _infer_new(self, spark: SparkSession, files: DataFrame) -> T.StructType | None:
        """Schema of the listed files, from ``infer_batch`` names at a time."""
        n = files.count()
        schema, batches = None, -(-n // self.infer_batch)
        for k in range(batches):
            paths = [r.path for r in files.where(F.pmod(F.xxhash64("path"), F.lit(batches)) == k).select("path").collect()]
            found = self._infer(spark, paths) if paths else None
            if found is not None:
                schema = found if schema is None else evolve_schema(schema, found)
        return schema

    def _infer(self, spark: SparkSession, paths: list[str] | None) -> T.StructType | None:
        """Schema of some files, or of all files of the folder."""
        fmt, opts = spark_format(self.file_format), self._opts()
        where = [escape_glob(p) for p in paths] if paths is not None else self.input_path
        if paths is not None:
            opts.pop("pathGlobFilter", None)
        if fmt == "csv" and opts.get("header") == "true":
            columns: list[str] = []
            files = listing(spark, self.input_path, self.glob_filter) if paths is None else spark.createDataFrame([(p,) for p in paths], "path string")
            # a row for each layout
            for r in first_lines(files, opts.get("encoding", "utf-8")).select("line").distinct().orderBy("line").collect():
                columns += [c for c in header_columns(r.line, opts) if c.lower() not in {x.lower() for x in columns}]
            return T.StructType([T.StructField(c, T.StringType(), True) for c in columns]) if columns else None
        if fmt == "parquet":
            opts.setdefault("mergeSchema", "true")
        try:
            schema = spark.read.format(fmt).options(**opts).load(where).schema
        except AnalysisException as exc:
            if "UNABLE_TO_INFER_SCHEMA" in str(exc):
                return None
            raise
        fields = [f for f in schema.fields if f.name != "_corrupt_record"]
        return T.StructType(fields) if fields else None

    # ---- readers ----------------------------------------------------------
    def stream(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """Streaming DataFrame over the folder (each file read once, however
        old its time stamp is: the stream's own age limit is out of the way).
        A CSV stream needs one header layout; ``batch`` takes any."""
        schema = schema or self.resolve_schema(spark)
        opts = self._opts()
        opts.setdefault("maxFileAge", "36500d")
        if self.max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
        if self.max_bytes_per_trigger:
            opts["maxBytesPerTrigger"] = self.max_bytes_per_trigger
        return self._read(spark.readStream, schema, opts, self.input_path)

    def batch(self, spark: SparkSession, paths: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """Batch DataFrame over the folder or over an explicit file list."""
        schema = schema or self.resolve_schema(spark)
        opts = self._opts()
        where = self.input_path
        if paths is not None:
            opts.pop("pathGlobFilter", None)     # the list is already filtered
            where = [escape_glob(p) for p in paths]
        if spark_format(self.file_format) != "csv" or opts.get("header") != "true":
            return self._read(spark.read, schema, opts, where)
        out = None
        files = listing(spark, self.input_path, self.glob_filter) if paths is None else spark.createDataFrame([(p,) for p in paths], "path string")
        layouts: dict[str, list[str]] = {}
        for r in first_lines(files, opts.get("encoding", "utf-8")).orderBy("path").toLocalIterator():
            layouts.setdefault(r.line, []).append(escape_glob(r.path))
        for line, files in sorted(layouts.items()):
            part = self._of_header(spark, schema, opts, header_columns(line, opts), files)
            out = part if out is None else out.unionByName(part)
        return out if out is not None else spark.createDataFrame([], self._with_rescue(schema))

    def _rescue(self) -> str | None:
        return self.rescued_data_column or ("_rescued_data" if self.new_columns == "rescue" else None)

    def _with_rescue(self, schema: T.StructType) -> T.StructType:
        rescue = self._rescue()
        return T.StructType(schema.fields + ([T.StructField(rescue, T.StringType(), True)] if rescue else []))

    def _of_header(self, spark: SparkSession, schema: T.StructType, opts: dict, columns: list[str], files: list[str]) -> DataFrame:
        """CSV files of one header layout, their columns lined up with ``schema`` by name."""
        types = {f.name.lower(): f.dataType for f in schema.fields}
        have = T.StructType([T.StructField(c, types.get(c.lower(), T.StringType()), True) for c in columns])
        df = self._read(spark.read, have, {k: v for k, v in opts.items() if k != "pathGlobFilter"}, files)
        rescue = self._rescue()
        extra = [c for c in columns if c.lower() not in types]
        if rescue and extra:
            values = F.map_filter(F.create_map(*(x for c in extra for x in (F.lit(c), F.col(f"`{c}`")))), lambda _, v: v.isNotNull())
            df = df.withColumn(rescue, F.coalesce(rescue, F.when(F.size(values) > 0, F.to_json(values))))
        return conform(df, self._with_rescue(schema))

    def _read(self, reader, schema: T.StructType, opts: dict, path) -> DataFrame:
        fmt, rescue = spark_format(self.file_format), self._rescue()
        if rescue and fmt == "parquet" and isinstance(reader, DataFrameReader):
            whole = self._arrived(reader.format(fmt).options(**{**opts, "mergeSchema": "true"}).load(path))
            return rescue_columns(whole, schema, rescue)
        if rescue and fmt not in ("json", "csv"):
            raise ValueError(f"rescued data needs JSON, CSV or batches of parquet, not {self.file_format}")
        if rescue and fmt == "json":
            # parsed twice on the JVM: into the schema, and into a tree to find what the schema lacks
            text_opts = {k: v for k, v in opts.items() if k in ("pathGlobFilter", "maxFilesPerTrigger", "maxFileAge",
                                                                 "maxBytesPerTrigger", "encoding")}
            whole = opts.get("multiLine", "false").lower() == "true"
            raw = self._arrived(reader.format("text").options(**text_opts, wholetext=str(whole).lower()).load(path))
            json_opts = {k: v for k, v in opts.items() if k not in text_opts and k != "multiLine"}
            return rescue_json(json_documents(raw, "value") if whole else raw, "value", schema, rescue, json_opts)
        if rescue:
            opts = {**opts, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescue}
            schema = self._with_rescue(schema)
        return self._arrived(reader.format(fmt).options(**opts).schema(schema).load(path))

    def _arrived(self, df: DataFrame) -> DataFrame:
        """Rows of files that were not there at the feed's first run."""
        if self.existing is None:
            return df
        old = df.sparkSession.read.schema("_lf_path string").parquet(self.existing)
        return df.withColumn("_lf_path", F.col("_metadata.file_path")).join(old, "_lf_path", "left_anti").drop("_lf_path")


def escape_glob(path: str) -> str:
    """A listed path for a reader that takes glob patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def header_columns(line: str, opts: dict) -> list[str]:
    """Column names of a header line; a nameless one is ``_c<i>``, a repeated one gets its place appended."""
    names = next(csv.reader([line.lstrip("\ufeff")], delimiter=opts.get("sep", ","), quotechar=opts.get("quote", '"')))
    names = [n or f"_c{i}" for i, n in enumerate(names)]
    low = [n.lower() for n in names]
    return [n if low.count(n.lower()) == 1 else f"{n}{i}" for i, n in enumerate(names)]
