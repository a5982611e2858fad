"""Drop folders derived from the given tables.

Test and scenario inputs are written by Spark from the parquet tables (so
they grow with the scale factor) into a folder of the workspace.  Spark names
output files ``part-<uuid>``; :func:`stage_files` renames them to stable
names (``<prefix>-00000.csv`` ...), so a later call with the same prefix
rewrites the same paths -- the "file overwritten in place" case.
"""

from __future__ import annotations

import functools
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from landfall import fs
from landfall.sources import paged

STAGING_SECONDS = [0.0]     # time spent building inputs (read by bench.py)
_DEPTH = [0]


def timed(fn):
    """Count the wrapped fixture builder's time in ``STAGING_SECONDS``
    (outermost call only, so nested builders are not counted twice)."""
    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        t0 = time.perf_counter()
        _DEPTH[0] += 1
        try:
            return fn(*args, **kwargs)
        finally:
            _DEPTH[0] -= 1
            if _DEPTH[0] == 0:
                STAGING_SECONDS[0] += time.perf_counter() - t0
    return wrapper


MANY_FILES, FULL_FILE = 32, 2_000_000
EXT = {"csv": ".csv", "tsv": ".tsv", "json": ".json", "parquet": ".parquet", "text": ".txt"}


@timed
def stage_files(df: DataFrame, fmt: str, dest: str, prefix: str, n_files: int, options: dict | None = None) -> list[str]:
    """Write ``df`` as ``n_files`` files named ``<prefix>-<i>`` into ``dest``."""
    spark = df.sparkSession
    tmp = f"{dest.rstrip('/')}__staging-{uuid.uuid4().hex[:8]}"
    opts = dict(options or {})
    writer_fmt = "csv" if fmt == "tsv" else fmt
    if fmt == "tsv":
        opts.setdefault("sep", "\t")
    if writer_fmt == "csv":
        opts.setdefault("header", "true")
        # keep header names and values exactly (the TSV headers end in a space)
        opts.setdefault("ignoreLeadingWhiteSpace", "false")
        opts.setdefault("ignoreTrailingWhiteSpace", "false")
    df.repartition(n_files).write.format(writer_fmt).options(**opts).save(tmp)
    parts = [n for n in fs.list_names(spark, tmp) if n.startswith("part-")]
    fs.mkdirs(spark, dest)
    out = []
    for i, name in enumerate(parts):
        target = f"{dest.rstrip('/')}/{prefix}-{i:05d}{EXT.get(fmt, '')}"
        if fs.exists(spark, target):
            fs.delete(spark, target, recursive=False)
        fs.rename(spark, f"{tmp}/{name}", target)
        out.append(target)
    fs.delete(spark, tmp)
    return out


def sf_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def files_for(rows: int, rows_per_file: int = 20_000, at_least: int = 2) -> int:
    """File count that grows with the data: a file per ~20k rows up to
    ``MANY_FILES``, then files that grow to ``FULL_FILE`` rows, then more of them."""
    return max(at_least, min(-(-rows // rows_per_file), max(MANY_FILES, -(-rows // FULL_FILE))))


# ---------------------------------------------------------------- a faulty API
def faulty_transport(options: dict):
    """Captured pages of which some requests fail: ``failPages="3:2"`` answers
    the first two requests for page 3 with ``failStatus`` (503)."""
    get = paged.files_transport(options)
    failing = {int(p): int(n) for p, n in (x.split(":") for x in options.get("failPages", "").split(",") if x)}

    def answer(params: dict) -> tuple[int, str | None]:
        page = params[paged.PARAM_PAGE]
        if failing.get(page, 0) > 0:
            failing[page] -= 1
            return int(options.get("failStatus", 503)), options.get("failBody")
        return get(params)

    return answer


class FaultyApi(paged.PagedApiDataSource):
    transports = {"files": faulty_transport}

    @classmethod
    def name(cls) -> str:
        return "faulty_api"
