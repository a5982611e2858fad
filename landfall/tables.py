"""Tables in Spark's catalog.

A :class:`Table` is an external parquet table of the session's catalog; every
publish is a statement of that catalog, and readers use ``spark.table(name)``.

* Snapshots (``whole``): an unpartitioned table.  A run writes its batches into
  a folder of its own, and ``ALTER TABLE ... SET LOCATION`` makes that folder the
  table: readers see the old run or the new one.
* Appends, audit rows and merges (``parts``): a table partitioned by ``lf_part``.
  An append adds a run's folders in one ``ADD IF NOT EXISTS PARTITION``, so a run
  published twice is there once; a merge moves the parts that it rewrote, one by
  one (``PARTITION ... SET LOCATION``; a key never changes its part, so readers
  find each key once at any moment), and adds one for what is new.

Columns that later rows bring are added to the catalog's schema, and types grow
where parquet can read the old files as the new type (int to long, float to
double, wider decimals): :func:`evolve_schema`.

The folders that a publish replaces are listed in ``_replaced`` and deleted by
the next publish, so a reader that has planned against them has until then.  A
table has one writer of snapshots or merges at a time; appends don't disturb each
other.  A table lives as long as the session's catalog does: clusters bring a
lasting one.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall import fs

PART = "lf_part"
DEFAULT_SCHEMA = "landfall"
HOME, NOTES = "landfall.home", "landfall.notes"
REPLACED = "_replaced"
STATEMENT_PARTS = 500       # partitions named by one statement


class SchemaConflict(ValueError):
    """A column arrived with a type that the table's cannot grow into."""


# ---------------------------------------------------------------- schemas
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}


def widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, if parquet files of either can
    be read as it; ``None`` if there is none."""
    if old in _INTEGERS and new in _INTEGERS:
        return max(old, new, key=_INTEGERS.index)
    floats = (T.FloatType(), T.DoubleType())
    if old in floats and new in floats:
        return T.DoubleType()
    for a, b in ((old, new), (new, old)):
        if a == T.DoubleType() and b in _INTEGERS[:3]:
            return a
        if isinstance(a, T.DecimalType) and (b in _INTEGERS or isinstance(b, T.DecimalType)):
            digits, scale = (_DIGITS[b], 0) if b in _INTEGERS else (b.precision - b.scale, b.scale)
            scale, digits = max(scale, a.scale), max(digits, a.precision - a.scale)
            return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else None
    return None


def _merge_type(old: T.DataType, new: T.DataType, path: str) -> T.DataType:
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolve_schema(old, new, path)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merge_type(old.elementType, new.elementType, f"{path}[]"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, _merge_type(old.valueType, new.valueType, f"{path}{{}}"), True)
    wide = widened(old, new)
    if wide is None:
        raise SchemaConflict(f"column {path}: table has {old.simpleString()}, rows have {new.simpleString()}")
    return wide


def evolve_schema(current: T.StructType | None, incoming: T.StructType, path: str = "") -> T.StructType:
    """Table schema after adding rows of ``incoming``: existing columns keep
    their place, new columns are added at the end, nested structs gain new
    fields the same way (names compared case-insensitively, as Spark resolves
    them), and types grow (:func:`widened`).  Other type changes are a conflict."""
    if current is None:
        return incoming
    by_name = {f.name.lower(): f for f in incoming.fields}
    fields = []
    for f in current.fields:
        inc = by_name.pop(f.name.lower(), None)
        dt = f.dataType if inc is None else _merge_type(f.dataType, inc.dataType, f"{path}{f.name}")
        fields.append(f if dt == f.dataType else T.StructField(f.name, dt, True))
    fields.extend(T.StructField(f.name, f.dataType, True) for f in incoming.fields if f.name.lower() in by_name)
    out = T.StructType(fields)
    return current if out == current else out


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same order, missing columns as NULL."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        cols.append((F.col(f"`{src}`") if src else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _stored(schema: T.StructType) -> T.StructType:
    """Columns of no type yet are text."""
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.NullType) else f.dataType, True) for f in schema.fields])


# ---------------------------------------------------------------- SQL text
def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _part(name: str) -> str:
    return f"PARTITION (`{PART}` = {text(name)})"


class Table:
    """The catalog table ``name`` (``schema.table``), its files below ``location``.
    Without a name it gets one made from its location."""

    def __init__(self, spark: SparkSession, location: str, name: str | None = None):
        self.spark = spark
        self.location = location.rstrip("/")
        self.name = name or f"{DEFAULT_SCHEMA}.t_{hashlib.md5(fs.qualify(spark, self.location).encode()).hexdigest()}"

    # ---- the catalog's entry -------------------------------------------
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def _properties(self) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {quoted(self.name)}").collect()}

    def notes(self) -> dict:
        """Small values kept with the table: merge keys, the part that is being filled, tracked maxima."""
        return json.loads(self._properties().get(NOTES, "{}")) if self.exists() else {}

    def note(self, **values) -> None:
        body = text(json.dumps({**self.notes(), **values}))
        self.spark.sql(f"ALTER TABLE {quoted(self.name)} SET TBLPROPERTIES ({text(NOTES)} = {body})")

    @property
    def in_parts(self) -> bool:
        return PART in self.spark.table(self.name).columns

    @property
    def schema(self) -> T.StructType | None:
        if not self.exists():
            return None
        return T.StructType([f for f in self.spark.table(self.name).schema.fields if f.name != PART])

    def _entry(self):
        catalog = self.spark._jsparkSession.sessionState().catalog()
        return catalog, self.spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(quoted(self.name))

    def prepare(self, schema: T.StructType, parts: bool) -> T.StructType:
        """Create the table empty, or let its columns grow to hold ``schema``; the columns it has then."""
        spark, home = self.spark, fs.qualify(self.spark, self.location)
        if not self.exists():
            schema = _stored(schema)
            namespace = self.name.rpartition(".")[0]
            if namespace and not spark.catalog.databaseExists(namespace):
                spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(namespace)}")
            columns = schema.toDDL() + (f", `{PART}` STRING" if parts else "")
            how = f"PARTITIONED BY (`{PART}`)" if parts else "OPTIONS (recursiveFileLookup 'true')"
            empty = f"{home}/_empty"
            fs.mkdirs(spark, empty)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(self.name)} ({columns}) USING parquet {how} LOCATION {text(empty)} "
                      f"TBLPROPERTIES ({text(HOME)} = {text(home)})")
            return schema
        if self._properties().get(HOME) != home:
            raise ValueError(f"{self.name} is in the catalog with its files elsewhere than {home}")
        if self.in_parts != parts:
            raise ValueError(f"{self.name} is loaded {'by parts' if self.in_parts else 'whole'}: a feed keeps its mode")
        current = self.schema
        grown = _stored(evolve_schema(current, schema))
        if grown != current:
            catalog, identifier = self._entry()
            catalog.alterTableDataSchema(identifier, spark._jvm.org.apache.spark.sql.types.DataType.fromJson(grown.json()))
            spark.catalog.refreshTable(self.name)
        return grown

    def add_columns(self, incoming: T.StructType) -> T.StructType:
        """``ALTER TABLE ADD COLUMNS`` for every column of ``incoming`` the table lacks."""
        return self.prepare(incoming, self.in_parts)

    # ---- folders -------------------------------------------------------
    def new_run(self, tag: str = "run") -> str:
        return f"{tag}-{uuid.uuid4().hex[:16]}"

    def path(self, folder: str) -> str:
        return f"{self.location}/{folder}"

    def whole_location(self) -> str:
        catalog, identifier = self._entry()
        return str(catalog.getTableMetadata(identifier).location().toString()).rstrip("/")

    def part_location(self, part: str) -> str | None:
        """Where a part's files are; ``None`` if the table has no such part."""
        catalog, identifier = self._entry()
        spec = self.spark._jvm.org.apache.spark.api.python.PythonUtils.toScalaMap({PART: part})
        if catalog.listPartitionNames(identifier, self.spark._jvm.scala.Option.apply(spec)).isEmpty():
            return None
        return str(catalog.getPartition(identifier, spec).location().toString()).rstrip("/")

    def parts(self) -> list[str]:
        return [r.partition.split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {quoted(self.name)}").collect()]

    def _retire(self, paths: list[str]) -> None:
        """Delete what the publish before this one replaced; ``paths`` go at the next."""
        where = self.path(REPLACED)
        for old in (fs.read_text(self.spark, where) or "").splitlines():
            if old not in paths:
                fs.delete(self.spark, old)
        fs.write_text(self.spark, where, "\n".join(paths))

    # ---- publishing ----------------------------------------------------
    def publish_whole(self, folder: str, schema: T.StructType) -> None:
        """Make the files below ``folder`` the table's contents."""
        self.prepare(schema, parts=False)
        old, new = self.whole_location(), fs.qualify(self.spark, folder)
        fs.mkdirs(self.spark, folder)
        if old != new:
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} SET LOCATION {text(new)}")
            self._retire([old])
        self.spark.catalog.refreshTable(self.name)

    def publish_parts(self, folders: dict[str, str], schema: T.StructType) -> None:
        """Add parts (name -> folder); those that the table has stay as they are."""
        self.prepare(schema, parts=True)
        names = sorted(folders)
        for k in range(0, len(names), STATEMENT_PARTS):
            added = " ".join(f"{_part(n)} LOCATION {text(fs.qualify(self.spark, folders[n]))}" for n in names[k:k + STATEMENT_PARTS])
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} ADD IF NOT EXISTS {added}")
        self.spark.catalog.refreshTable(self.name)

    def move_parts(self, folders: dict[str, str]) -> None:
        """Point existing parts at the folders that hold them now."""
        old = []
        for n in sorted(folders):
            where, new = self.part_location(n), fs.qualify(self.spark, folders[n])
            if where != new:
                self.spark.sql(f"ALTER TABLE {quoted(self.name)} {_part(n)} SET LOCATION {text(new)}")
                old.append(where)
        self._retire(old)
        self.spark.catalog.refreshTable(self.name)

    def truncate(self) -> None:
        """``TRUNCATE TABLE``: no rows, the same columns."""
        if not self.exists():
            raise FileNotFoundError(f"no table {self.name}")
        if not self.in_parts:
            self.publish_whole(self.path(self.new_run("none")), self.schema)
            return
        names = self.parts()
        self._retire([self.part_location(n) for n in names])
        for k in range(0, len(names), STATEMENT_PARTS):
            self.spark.sql(f"ALTER TABLE {quoted(self.name)} DROP IF EXISTS " + ", ".join(_part(n) for n in names[k:k + STATEMENT_PARTS]))
        self.spark.catalog.refreshTable(self.name)

    # ---- reads ---------------------------------------------------------
    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table {self.name}")
        return self.spark.table(self.name).drop(PART)

    def register_view(self, name: str) -> None:
        """Expose the current contents to SQL as a temporary view."""
        self.read().createOrReplaceTempView(name)
