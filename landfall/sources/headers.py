"""First lines of files, from their first bytes.

The file names are rows; each task opens its files through ``pyarrow.fs`` and reads
until the first line with text is complete, so what is read does not grow
with the files.  Compressed files are recognised by their name, as Spark does.
This module is sent to the Python workers by value, so executors need no
installed copy of the package.
"""

from __future__ import annotations

import codecs
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame

STEP = 1 << 14
LINE_ENDS = re.compile(r"\r\n|\n|\r")


def open_file(path: str, opened: dict) -> pa.NativeFile:
    """``path`` as Spark lists it: a URI, or a local path after ``file:``."""
    scheme = path.partition(":")[0] if "://" in path else "file"
    if scheme == "file" or path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    root = "/".join(path.split("/")[:3])
    if root not in opened:
        opened[root] = pafs.FileSystem.from_uri(root + "/")[0]
    inside = path.removeprefix(root)
    # object stores name a file bucket/key, others by its path
    return opened[root].open_input_stream(inside if scheme in ("hdfs", "viewfs") else root.partition("://")[2] + inside)


def first_line(stream: pa.NativeFile, encoding: str) -> tuple[str, int]:
    """The first line that is not blank, and how many bytes were read."""
    decoder, text, read = codecs.getincrementaldecoder(encoding)(errors="replace"), "", 0
    while True:
        block = stream.read(STEP)
        read += len(block)
        text += decoder.decode(block, final=not block)
        lines = LINE_ENDS.split(text)
        for line in lines[:-1] if block else lines:     # the last one may go on
            if line.strip():
                return line, read
        if not block:
            return "", read


def first_lines(files: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """``files`` (path) -> (path, line, bytes_read); files without text are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with open_file(path, opened) as stream:
                    rows.append((path, *first_line(stream, encoding)))
            rows = [r for r in rows if r[1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.int64())], names=["path", "line", "bytes_read"])

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return files.select("path").mapInArrow(run, "path string, line string, bytes_read long")
