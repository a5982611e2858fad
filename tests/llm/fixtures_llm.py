import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from landfall.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    ship(spark)


def nasty_rows():
    """Rows with nulls in any column, empty and long texts, ties, repeats and odd characters."""
    base = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 70").fetchall()
    long = " ".join(t for _, t, *_ in base[:20]) * 6
    extra = [
        (1000, None, "en", "src1", None), (1001, "", "en", None, 0), (1002, " \t\n ", None, "src1", 4), (1003, "12 34 | 56", "fr", "src2", 10),
        (None, "a row without an id and a few words", "en", "src3", 35), (None, None, None, None, None),
        (1004, "twice the same row here", "en", "src1", 23), (1004, "twice the same row here", "en", "src1", 23),
        (1005, "one id but", "en", "src1", 10), (1005, "two texts of it", "en", "src1", 15),
        (1006, "one", "en", "src1", 3), (1007, "ONE", "en", "src1", 3), (1008, long, "en", "src1", len(long)),
        (1009, long[:-40] + " changed at the end", "en", "src1", len(long)), (1010, "a" * 3000, "en", "src1", 3000),
        (1011, "ñandú café 漢字 😀 " * 60, "es", "src4", 900), (1012, "x" + "ñandú café 漢字 😀 " * 60, "es", "src4", 901),
        (1013, base[3][1], base[3][2], "src9", base[3][4]), (-5, base[4][1] + " .", "en", "src9", 1),
    ]
    return base + extra


@pytest.fixture(scope="module")
def nasty(tmp_path_factory):
    """A folder of tables like the real ones, with nasty documents and columns whose names the operators use themselves."""
    top = str(tmp_path_factory.mktemp("nasty"))
    rows = nasty_rows()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    docs = pa.table(list(map(list, zip(*rows))), schema=schema)
    for name in ("id", "u", "v", "n", "key", "spans", "score", "kept", "token_ids", "items", "chunk", "_u", "host", "low"):
        docs = docs.append_column(name, pa.array([None] * len(rows), pa.string()))
    pq.write_table(docs, f"{top}/documents.parquet")
    words = rows[5][1].split()
    items = [(1, " ".join(words[2:30])), (1, " ".join(words[40:60])), (2, " ".join(words[5:18])), (3, None), (4, ""), (None, rows[8][1][:200]),
             (5, "café 漢字"), (6, "||| --"), (10, "row without")]
    pq.write_table(pa.table(list(map(list, zip(*items))), schema=pa.schema([("item_id", pa.int64()), ("text", pa.string())])), f"{top}/benchmark.parquet")
    for name in ("labels", "embeddings", "conversations"):
        os.symlink(f"{SF}/{name}.parquet", f"{top}/{name}.parquet")
    return top, rows


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    """The tables without rows."""
    top = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        pq.write_table(pq.read_table(f"{SF}/{name}.parquet").slice(0, 0), f"{top}/{name}.parquet")
    return top
