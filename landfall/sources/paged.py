"""Paged REST API as a Spark data source.

The API returns pages ``Page=1, 2, ...`` of at most ``limit`` records under
one key (``deviceResponseData``); an empty list or HTTP 204 ends paging.
Instead of a driver loop, the source has ``numPartitions`` input partitions:
partition ``i`` requests pages ``i+1, i+1+n, i+1+2n, ...`` until its first
page without records, so pages are fetched in parallel on the executors.

The source yields one row per request outcome, ``(page, outcome, body, error,
records)``:

* ``page``         -- a body with records, ``records`` of them
* ``end``          -- HTTP 204, no list or an empty list: the partition stops
* ``retry``        -- a failed attempt that was tried again
* ``failed``       -- the last attempt failed, 401, or the body is not a JSON
  object: the partition stops

Outcomes are rows, not exceptions: an exception would make Spark repeat the
task and with it every request of the partition.  The caller lands the rows
first, so the API is called once, and then asks :func:`stopped_by` whether a
page before the end is missing.  Whether a page has records is decided here,
from the parsed body, and nowhere else; how many it has is counted here, and
:func:`unread` finds the pages of which Spark read another number.

Requests are retried: 200 -> body, 204 -> no more data, 401 -> fail at once,
anything else (also 206) or an error -> wait ``2**attempt`` seconds and try again, up to
``retries`` attempts, no wait after the last.

Transports: ``http`` (GET with ``limit``, ``Page``, ``modifiedDate`` and basic
auth) and ``files`` (a folder with one ``page=<n>`` sub-folder per page, to
replay captured pages).  A subclass of the source may bring others.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "page INT, outcome STRING, body STRING, error STRING, records INT"

# ---- fixed values: the API's request parameters and the key of its records ----
PARAM_LIMIT, PARAM_PAGE, PARAM_SINCE = "limit", "Page", "modifiedDate"
DATA_KEY = "deviceResponseData"
BATCH_BYTES, ROW_BYTES = 1 << 20, 64        # of a batch handed to Spark; what a row costs beside its texts
# ------------------------------------------------------------------------------


class Options(dict):
    """Reader options; Spark may hand their names over in lower case."""

    def __init__(self, options: dict):
        super().__init__({k.lower(): v for k, v in options.items()})

    def get(self, name, default=None):
        return super().get(name.lower(), default)

    def __getitem__(self, name):
        return super().__getitem__(name.lower())


class ApiError(RuntimeError):
    pass


class Unauthorized(ApiError):
    pass


def http_transport(options: dict):
    url = options["url"]
    timeout = float(options.get("timeout", 120))
    headers = {"Accept": "application/json"}
    if options.get("username") is not None:
        token = base64.b64encode(f"{options['username']}:{options.get('password', '')}".encode()).decode()
        headers["Authorization"] = f"Basic {token}"

    def get(params: dict) -> tuple[int, str | None]:
        req = urllib.request.Request(f"{url}?{urllib.parse.urlencode(params)}", headers=headers)
        try:
            with urllib.request.urlopen(req, timeout=timeout) as resp:
                return resp.status, resp.read().decode("utf-8")
        except urllib.error.HTTPError as err:
            return err.code, None

    return get


def files_transport(options: dict):
    """Captured pages in ``<path>/page=<n>/``: any file system ``pyarrow.fs``
    resolves from the URI (local paths, s3://, gs://, hdfs://)."""
    from pyarrow import fs as pafs

    path = options["path"]
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    filesystem, root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    key = options.get("dataKey", DATA_KEY)

    def get(params: dict) -> tuple[int, str | None]:
        page = params[PARAM_PAGE]
        infos = filesystem.get_file_info(pafs.FileSelector(f"{root.rstrip('/')}/page={page}", allow_not_found=True))
        files = sorted(i.path for i in infos
                       if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_")))
        if not files:
            return 204, None
        parts = []
        for f in files:
            with filesystem.open_input_stream(f) as fh:
                parts.extend(line for line in fh.read().decode("utf-8").splitlines() if line.strip())
        if len(parts) == 1:
            return 200, parts[0]
        # a page captured as several JSON lines: one body with the lists joined
        return 200, json.dumps({key: [r for p in parts for r in (json.loads(p).get(key) or [])]})

    return get


TRANSPORTS = {"http": http_transport, "files": files_transport}


def fetch(get, params: dict, retries: int = 3, sleep=time.sleep, on_error=None) -> tuple[int, str | None]:
    """Status and body of one page; raises after ``retries`` failed attempts.
    ``on_error(text)`` hears about each failed attempt that is retried."""
    last: Exception | None = None
    for attempt in range(retries):
        try:
            status, body = get(params)
        except Exception as exc:        # network error, time-out
            status, body, last = None, None, exc
        if status in (200, 204):
            return status, body
        if status == 401:
            raise Unauthorized(f"401 Unauthorized for page {params.get(PARAM_PAGE)}")
        if status is not None:
            last = ApiError(f"HTTP {status} for page {params.get(PARAM_PAGE)}")
        if attempt + 1 < retries:
            if on_error is not None:
                on_error(f"attempt {attempt + 1}: {type(last).__name__}: {last}")
            sleep(2 ** attempt)
    raise ApiError(f"page {params.get(PARAM_PAGE)} failed after {retries} attempts: {last}")


def outcome_of(status: int, body: str | None, key: str) -> tuple[str, str | None, int | None]:
    """Outcome of an answered request, what is wrong with it, and how many
    records it has."""
    if status == 204 or body is None:
        return "end", None, None
    try:
        parsed = json.loads(body)
    except ValueError:
        parsed = None
    except RecursionError:
        return "failed", "ApiError: the body is nested too deeply", None
    if not isinstance(parsed, dict):
        return "failed", "ApiError: the body is not a JSON object", None
    records = parsed.get(key)
    if isinstance(records, list) and records:
        return "page", None, len(records)
    return "end", None, None


class PagedApiDataSource(DataSource):
    """``spark.read.format("paged_api").option(...)``.  Options: ``transport``
    (http|files), ``url`` or ``path``, ``limit`` (1000), ``modifiedDate``,
    ``dataKey`` (deviceResponseData), ``numPartitions`` (4), ``retries`` (3),
    ``timeout`` (120), ``username``, ``password``."""

    transports = TRANSPORTS

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PagedApiBatches(Options(dict(self.options)), self.transports)


class PagedApiReader(DataSourceReader):
    def __init__(self, options: dict, transports: dict = TRANSPORTS):
        self.options, self.transports = options, transports

    def partitions(self):
        n = int(self.options.get("numPartitions", 4))
        return [InputPartition(i) for i in range(n)]

    def read(self, partition):
        o = self.options
        n = int(o.get("numPartitions", 4))
        get = self.transports[o.get("transport", "http")](o)
        key = o.get("dataKey", DATA_KEY)
        retries = int(o.get("retries", 3))

        page = partition.value + 1
        outcome = None
        while outcome in (None, "page"):
            params = {PARAM_LIMIT: int(o.get("limit", 1000)), PARAM_PAGE: page}
            if o.get("modifiedDate"):
                params[PARAM_SINCE] = o["modifiedDate"]
            errors: list[str] = []
            body, error, records = None, None, None
            try:
                status, body = fetch(get, params, retries, on_error=errors.append)
                outcome, error, records = outcome_of(status, body, key)
            except ApiError as exc:
                outcome, error = "failed", f"{type(exc).__name__}: {exc}"
            for err in errors:              # retried attempts, for the audit log
                yield (page, "retry", None, err, None)
            yield (page, outcome, body, error, records)
            page += n


class PagedApiBatches(PagedApiReader):
    """The same rows as Arrow batches of about ``BATCH_BYTES`` of bodies: Spark would
    gather ten thousand rows, whole pages here, before it makes a batch of them."""

    def read(self, partition):
        import pyarrow as pa

        schema = pa.schema([("page", pa.int32()), ("outcome", pa.string()), ("body", pa.string()), ("error", pa.string()),
                            ("records", pa.int32())])
        rows, size = [], 0
        for row in super().read(partition):
            rows.append(row)
            size += len(row[2] or "") + len(row[3] or "") + ROW_BYTES
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def register(spark, source: type[DataSource] = PagedApiDataSource) -> None:
    """Register the source (or one that extends it).  Its modules are shipped to
    the Python workers by value, so executors need no installed copy of them."""
    import sys

    from pyspark import cloudpickle

    for cls in source.__mro__:
        if issubclass(cls, PagedApiDataSource):
            cloudpickle.register_pickle_by_value(sys.modules[cls.__module__])
    spark.dataSource.register(source)


def _before_end(rows, pages):
    """Rows of the pages before the first end over all partitions, which is
    what one sequential loop would have read: one global ``min`` (one row, broadcast)."""
    from pyspark.sql import functions as F

    stop = pages.where(F.col("outcome") == "end").agg(F.min("page").alias("_stop"))
    return rows.join(F.broadcast(stop), F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))).drop("_stop")


def page_records(pages, data_key: str = DATA_KEY):
    """Landed outcome rows -> ``(page, position, record)`` of the pages before
    the first end.  Splitting is done on the JVM: ``from_json`` into
    ``array<string>`` keeps each record as its JSON text.  A body that the JVM's
    parser refuses gives no rows here; :func:`unread` finds it."""
    from pyspark.sql import functions as F

    records = F.from_json("body", f"struct<`{data_key}`: array<string>>")[data_key]
    return _before_end(pages.where(F.col("outcome") == "page").select("page", F.posexplode(records).alias("position", "record")), pages)


def unread(pages, rows):
    """``(page, records, found)`` of the landed pages before the first end of
    which ``rows`` (with their ``page``) holds another number of records than
    the reader counted when it parsed the body.  ``rows`` is aggregated by page
    before the join; bodies are not read."""
    from pyspark.sql import functions as F

    sent = _before_end(pages.where(F.col("outcome") == "page").groupBy("page").agg(F.sum("records").alias("records")), pages)
    found = rows.groupBy("page").agg(F.count("*").alias("found"))
    both = sent.join(found, "page", "full_outer").select(
        "page", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.where("records <> found")


def stopped_by(pages) -> str | None:
    """What keeps the landed pages from being complete: the first failure on a
    page before the first end.  Failures past the end do not matter, a
    sequential loop would never have asked for those pages."""
    from pyspark.sql import functions as F

    row = pages.agg(F.min(F.when(F.col("outcome") == "end", F.col("page"))).alias("end"),
                    F.min(F.when(F.col("outcome") == "failed", F.struct("page", "error"))).alias("failed")).first()
    if row["failed"] is None or (row["end"] is not None and row["end"] < row["failed"]["page"]):
        return None
    return f"page {row['failed']['page']}: {row['failed']['error']}"
