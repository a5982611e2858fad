"""Fill-in-the-middle by piece tables.

A document is a list of descriptors (buffer, begin, end) over immutable buffers: the
text's own bytes, as Arrow hands them over, and the bytes of the three sentinels.

* Cutting splits descriptors at two places; no text is copied.
* An arrangement permutes the three descriptors that the cuts leave and puts a sentinel's
  descriptor before each: prefix-suffix-middle or suffix-prefix-middle.
* Restoring makes a piece table of the output, cuts it at the sentinels, drops their
  descriptors and applies the inverse permutation.
* Hashes stream the descriptors; the output's bytes are joined once, for the column.

Places, arrangement and whether a document takes part come from
sha256(seed ``:`` key) alone, so a rerun after a lost executor gives the same rows.  A
document is one row of one task and there is no shuffle.

Defined results: a null text is empty; empty texts and texts that hold a sentinel stay
plain (the output is the text); a null key draws as an empty string would; repeated rows
are transformed each, rows of one key and different texts too; a text may be as long as
a row can be (only arrays over ``SLICE_BYTES`` of it are held beside it); no rows give
no rows; a column of the input whose name an operator adds is replaced, all others but
the text pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import SLICE_BYTES, slices, table, text_buffers, without

#: Sentinels before prefix, middle and suffix.
MARKS = ("<P>", "<M>", "<S>")
#: The parts (0 prefix, 1 middle, 2 suffix) in the order of the output.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
PLAIN = "plain"
ADDED = (T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
         T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()), T.StructField("output_sha256", T.StringType()))


class PieceTable:
    """Descriptors (buffer, begin, end) over buffers that are never written to."""

    def __init__(self, buffers: list[memoryview], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    @classmethod
    def over(cls, text: memoryview, *others: memoryview) -> PieceTable:
        return cls([text, *others], [(0, 0, len(text))])

    def cut(self, places: list[int]) -> PieceTable:
        """Descriptors split at ascending offsets of the document; an empty part is a descriptor too."""
        out, at, waiting = [], 0, list(places)
        for buffer, begin, end in self.pieces:
            start, at = at, at + end - begin
            while waiting and waiting[0] <= at:
                middle = begin + waiting.pop(0) - start
                out.append((buffer, begin, middle))
                start, begin = start + middle - begin, middle
            out.append((buffer, begin, end))
        return PieceTable(self.buffers, out)

    def arrange(self, order: tuple[int, ...], before: int | None = None) -> PieceTable:
        """The descriptors in another order, each after the whole buffer ``before`` + its number, if that is given."""
        out = []
        for i in order:
            if before is not None:
                out.append((before + i, 0, len(self.buffers[before + i])))
            out.append(self.pieces[i])
        return PieceTable(self.buffers, out)

    def stream(self) -> Iterator[memoryview]:
        for buffer, begin, end in self.pieces:
            yield self.buffers[buffer][begin:end]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for part in self.stream():
            h.update(part)
        return h.hexdigest()

    def join(self) -> bytes:
        return b"".join(self.stream())


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(order.index(i) for i in range(len(order)))


def sentinels(marks: tuple[str, str, str]) -> list[bytes]:
    """The sentinels' bytes.  Those that could be found across the edge of one another are refused: texts without
    them would not be enough to tell where they are."""
    raw = [m.encode() for m in marks]
    if not all(raw) or len(set(raw)) < 3:
        raise ValueError("three different sentinels are needed")
    for a, b in product(raw, raw):
        if (a is not b and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
            raise ValueError(f"sentinels {a!r} and {b!r} overlap")
    return raw


def stretches(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of SLICE_BYTES and where they begin."""
    for at in range(0, len(data), SLICE_BYTES):
        yield at, data[at:at + SLICE_BYTES]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets after each line ``[^\\n]*\\n|[^\\n]+``."""
    ends = [at + np.flatnonzero(part == 10) + 1 for at, part in stretches(data)]
    if len(data) and data[-1] != 10:
        ends.append(np.array([len(data)]))
    return np.concatenate(ends) if ends else np.zeros(0, np.int64)


def code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero((part & 0xC0) != 0x80)) for _, part in stretches(data))


def draws(seed: int, key: str) -> list[int]:
    """The first four groups of eight hexadecimal digits of sha256(seed:key)."""
    raw = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(raw[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm_share: int = 50,
              marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` without ``text`` and with n (lines), form (plain, psm, spm), prefix_chars, middle_chars, output, output_sha256.

    ``rate``: percent of documents that take part; ``spm_share``: percent of those whose suffix comes first.
    """
    raw = sentinels(marks)
    docs = docs.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))
    added = [f.name for f in ADDED]
    names = [c for c in without(docs, added).columns if c != text]
    schema = T.StructType([*(docs.schema[c] for c in names), *ADDED])
    # the two columns that the task reads come last, whatever the names of the others
    ready = docs.select(*(F.col(c) for c in names), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_draw"), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = [memoryview(m) for m in raw]
        for batch in (piece for whole in batches for piece in slices(whole, "_text")):
            data, at = text_buffers(batch.column(batch.num_columns - 1))
            out: list[list] = [[] for _ in ADDED]
            for i, drawn in enumerate(batch.column(batch.num_columns - 2).to_pylist()):
                mine = data[at[i]:at[i + 1]]
                whole = mine.tobytes()
                doc = PieceTable.over(memoryview(whole), *views)
                ends = line_ends(mine)
                n, (h1, h2, h3, h4) = len(ends), draws(seed, drawn)
                form, first, second = PLAIN, None, None
                if n and h3 % 100 < rate and not any(m in whole for m in raw):
                    form = "spm" if h4 % 100 < spm_share else "psm"
                    cuts = [int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
                    first, second = code_points(mine[:cuts[0]]), code_points(mine[cuts[0]:cuts[1]])
                    doc = doc.cut(cuts).arrange(ORDERS[form], before=1)
                for column, value in zip(out, (n, form, first, second, doc.join(), doc.sha256())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary()).cast(pa.string()), pa.array(out[5], pa.string())], schema.names)

    return ready.mapInArrow(run, schema)


def opened(output: bytes, form: str, raw: list[bytes]) -> PieceTable:
    """The piece table of the text that ``output`` was made from."""
    doc = PieceTable.over(memoryview(output))
    if form == PLAIN:
        return doc
    places, at = [], 0
    for part in ORDERS[form]:
        at = output.find(raw[part], at)
        if at < 0:
            raise ValueError(f"an output of form {form} without its sentinels")
        places += [at, at + len(raw[part])]
        at = places[-1]
    pieces = doc.cut(places).pieces[2::2]  # what follows each sentinel
    return PieceTable(doc.buffers, pieces).arrange(inverse(ORDERS[form]))


def restore(outputs: DataFrame, output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS, texts: bool = True) -> DataFrame:
    """Add restored (the text; not with ``texts=False``, which hashes the descriptors and builds nothing) and restored_sha256,
    from output and form alone.  A null output is empty, a null form plain."""
    raw = sentinels(marks)
    added = [T.StructField("restored", T.StringType())] * texts + [T.StructField("restored_sha256", T.StringType())]
    outputs = without(outputs, ["restored", "restored_sha256"])
    names = outputs.columns if texts else [c for c in outputs.columns if c != output]
    schema = T.StructType([*(outputs.schema[c] for c in names), *added])
    ready = outputs.select(*names, F.coalesce(form, F.lit(PLAIN)).alias("_form"), F.col(output).alias("_output"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in slices(whole, "_output")):
            data, at = text_buffers(batch.column(batch.num_columns - 1))
            forms = batch.column(batch.num_columns - 2).to_pylist()
            docs = [opened(data[at[i]:at[i + 1]].tobytes(), form, raw) for i, form in enumerate(forms)]
            columns = [pa.array([d.join() for d in docs], pa.binary()).cast(pa.string())] if texts else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns, pa.array([d.sha256() for d in docs], pa.string())], schema.names)

    return ready.mapInArrow(run, schema)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, seed 7, every text that can take part, half of them suffix first."""
    made = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return restore(made, texts=False).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents),
numbers AS (
    SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a,
           ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b, ('0x' || substr(h, 17, 8))::BIGINT % 100 AS c,
           ('0x' || substr(h, 25, 8))::BIGINT % 100 AS d
    FROM drawn),
parts AS (
    SELECT doc_id, t, n,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 100 THEN 'plain'
                WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
           coalesce(array_to_string(u[1:least(a, b)], ''), '') AS p,
           coalesce(array_to_string(u[least(a, b) + 1:greatest(a, b)], ''), '') AS m,
           coalesce(array_to_string(u[greatest(a, b) + 1:n], ''), '') AS s
    FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                   ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
