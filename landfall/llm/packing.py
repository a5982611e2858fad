"""Token ids in fixed-width bit-packed files.

Each id takes the fewest bits that hold the vocabulary.  A shard file is a run
of records in ascending document order::

    block   b"TBLK" | bits u8 | n_docs u32 | n_ids u32 | doc ids i64[n_docs] | lengths u32[n_docs] | packed ids
    footer  b"TIDX" | n_blocks u32 | block offsets u64[n_blocks+1] | first ids u64[n_blocks+1] | footer bytes u32

(little-endian; one line feed after each record, which is part of the format).
The block offsets in the footer give random access: ``Shard.ids(a, b)`` unpacks
only the blocks that hold ids a to b, and ``unpack`` is vectorised.  A document
never spans shards but may span blocks of the same shard: a long one takes a
block of its own length, cut every ``block_ids`` ids.

Writing is one Spark job: documents are dealt out in ranges of doc_id, sorted,
encoded and packed in Arrow batches, and written by Spark's text writer with its
commit protocol, so that a lost executor leaves no half-written shard and the
files can be in any store that Spark writes to.  Reading back goes through
Spark's binary file source, a shard at a time.

Ids are those of the tokenizers library's plain call, in which the strings of the
vocabulary's special tokens, where a text holds them, get the special ids; with
``special_as_text`` they are ordinary text.

Defined results: a null or empty text has the end id only; rows with the same
doc_id stay separate documents, next to each other, in the order of a hash of their
texts, so that the rows of one id (null too) may take any number of shards; a null
doc_id sorts first and reads back as null; no rows give no shards with documents and
no result rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landfall.llm.common import Workspace, slices, table

#: Ids in a block, and bytes of text that one shard takes on average.
BLOCK_IDS = 1 << 16
SHARD_BYTES = 16 << 20
#: Word-to-ids entries that a Python worker remembers; a full memory keeps the last slice's.
MEMORY_WORDS = 400_000
PIECE_BYTES = 1 << 20
NULL_ID = -(1 << 63)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits for each id, little-endian, padded to a whole byte."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    wide = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(wide.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if bits == 16:
        return raw[:2 * n].view("<u2").astype(np.uint32)
    flat = np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits)
    return flat.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Blocks:
    """Collects documents and gives out records of a shard."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.docs: list[tuple[int, int]] = []
        self.parts: list[np.ndarray] = []
        self.held, self.at, self.first = 0, 0, 0
        self.offsets, self.firsts = [0], [0]

    def add(self, doc_id: int, ids: np.ndarray) -> Iterator[bytes]:
        """A document that goes on in the next block stands in each with its share of ids."""
        while True:
            take = ids[:self.block_ids - self.held]
            self.docs.append((doc_id, len(take) | (1 << 31 if len(take) < len(ids) else 0)))
            self.parts.append(take)
            self.held += len(take)
            ids = ids[len(take):]
            if self.held == self.block_ids:
                yield self.block()
            if not len(ids):
                return

    def block(self) -> bytes:
        ids = np.concatenate(self.parts)
        out = struct.pack("<4sBII", b"TBLK", self.bits, len(self.docs), len(ids))
        out += np.array([d for d, _ in self.docs], "<i8").tobytes() + np.array([n for _, n in self.docs], "<u4").tobytes()
        out += pack(ids, self.bits)
        self.at, self.first = self.at + len(out) + 1, self.first + len(ids)
        self.offsets.append(self.at)
        self.firsts.append(self.first)
        self.docs, self.parts, self.held = [], [], 0
        return out

    def close(self) -> Iterator[bytes]:
        if self.docs:
            yield self.block()
        body = struct.pack("<4sI", b"TIDX", len(self.offsets) - 1)
        body += np.array(self.offsets, "<u8").tobytes() + np.array(self.firsts, "<u8").tobytes()
        yield body + struct.pack("<I", len(body) + 4)


class Shard:
    """One shard's bytes; only the footer is parsed at once."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        size, = struct.unpack_from("<I", data, len(data) - 5)
        foot = len(data) - 1 - size
        magic, n = struct.unpack_from("<4sI", data, foot)
        if magic != b"TIDX":
            raise ValueError("not a shard of packed ids")
        self.offsets = np.frombuffer(data, "<u8", n + 1, foot + 8).astype(np.int64)
        self.firsts = np.frombuffer(data, "<u8", n + 1, foot + 8 + 8 * (n + 1)).astype(np.int64)

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document ids, ids of each in this block, whether each goes on in the next, and the token ids."""
        at = int(self.offsets[k])
        magic, bits, docs, n = struct.unpack_from("<4sBII", self.data, at)
        if magic != b"TBLK":
            raise ValueError(f"block {k} is damaged")
        at += 13
        ids = np.frombuffer(self.data, "<i8", docs, at)
        lengths = np.frombuffer(self.data, "<u4", docs, at + 8 * docs)
        packed = self.data[at + 12 * docs:int(self.offsets[k + 1]) - 1]
        return ids, (lengths & 0x7FFFFFFF).astype(np.int64), lengths >> 31 == 1, unpack(packed, n, bits)

    def ids(self, a: int, b: int) -> np.ndarray:
        """Token ids a to b (exclusive) of the shard, from the blocks that hold them."""
        first, last = np.searchsorted(self.firsts, [a, b], "right") - 1
        parts = [self.block(k)[3][max(0, a - self.firsts[k]):b - self.firsts[k]]
                 for k in range(int(first), min(int(last) + 1, len(self.firsts) - 1))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, first id in the shard, ids) of each document."""
        open_parts: list[np.ndarray] = []
        for k in range(len(self.firsts) - 1):
            docs, lengths, goes_on, ids = self.block(k)
            ends = np.cumsum(lengths)
            for d, n, more, end in zip(docs.tolist(), lengths.tolist(), goes_on.tolist(), ends.tolist()):
                open_parts.append(ids[end - n:end])
                if not more:
                    whole = open_parts[0] if len(open_parts) == 1 else np.concatenate(open_parts)
                    yield d, int(self.firsts[k]) + end - len(whole), whole
                    open_parts = []


#: A-Z to a-z and line feeds to spaces: the normaliser lower-cases, and any white space parts pieces alike.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 10 else b for b in range(256))
#: Between an ASCII letter and an ASCII mark or digit a run of letters ends (but an apostrophe may go on).
LETTER, LETTERS_END = np.zeros(256, bool), np.zeros(256, bool)
LETTER[97:123] = LETTERS_END[:128] = True
LETTERS_END[[*range(97, 123), 39, 32]] = False
#: Units that normalising leaves as they are and that are one piece: lower-case Latin-1 letters.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def pieces(text: bytes, limit: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in pieces of at least ``limit`` bytes, cut at spaces (in one if it has none)."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(b" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class WordIds:
    """Ids of the units of texts, by the tokenizers library.

    A unit is what stands between spaces, line feeds and ``LETTERS_END``: places that
    no piece of the vocabulary's pre-tokenizer crosses, so a text's ids are those of
    its units one after the other.  Units recur and are remembered; new ones go to
    the library, those that are one plain piece straight to its model.  A special
    token's string parts a text as the library does it, before anything else, and
    is a unit in upper case: the folded text has no such letters.

    Numpy cuts the texts, Arrow finds the different units, so Python sees each unit
    once a slice, and numpy puts the ids together.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items() if not special_as_text}
        self.special = re.compile(b"(" + b"|".join(map(re.escape, sorted(special, key=len, reverse=True))) + b")") if special else None
        self.fixed = {x.upper(): struct.pack("<I", i) for x, i in special.items()}
        # the parts that go to the library hold none of those strings but as text
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.memory: dict[bytes, bytes] = dict(self.fixed)
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: The letters of PLAIN as the model sees them: a character for each byte.
        self.plain = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if PLAIN.fullmatch(c)}

    def fold(self, text: bytes) -> bytes:
        if self.special is None or not self.special.search(text):
            return text.translate(FOLD)
        parts = self.special.split(text)
        return b" ".join(x.upper() if k % 2 else x.translate(FOLD) for k, x in enumerate(parts))

    def learn(self, units: set[bytes]) -> None:
        odd = []
        for unit in units:
            text = unit.decode()
            if PLAIN.fullmatch(text):
                ids = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.plain))]
                self.memory[unit] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                odd.append(text)
        for text, encoded in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            self.memory[text.encode()] = struct.pack(f"<{len(encoded.ids)}I", *encoded.ids)

    def units(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The texts' units, and the n+1 places among them where a text begins."""
        folded = [self.fold(x) for x in texts]
        edges = np.cumsum([0, *map(len, folded)])
        data = np.frombuffer(b"".join(folded), np.uint8)
        inside = data != 32
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | (LETTER[data[:-1]] & LETTERS_END[data[1:]])
        first = edges[:-1][edges[:-1] < len(data)]
        begins[first] = inside[first]
        at = np.flatnonzero(begins)
        kept = np.concatenate([[0], np.cumsum(inside)])
        offsets = np.append(kept[at], kept[-1])
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        return cut.dictionary_encode(), np.searchsorted(at, edges)

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        units, ends = self.units(texts)
        different = units.dictionary.to_pylist()
        new = set(different).difference(self.memory)
        self.learn(new)
        known = [self.memory[x] for x in different]
        for unit in new:
            if len(unit) > 64:
                self.memory.pop(unit, None)
        if len(self.memory) > MEMORY_WORDS:  # what this slice has is likely to come again
            self.memory = {**self.fixed, **{x: v for x, v in zip(different, known) if len(x) <= 64}}
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(size) - size
        which = units.indices.to_numpy()
        n = size[which]
        at = np.concatenate([[0], np.cumsum(n)])
        flat = np.frombuffer(b"".join(known), "<u4")[np.arange(at[-1]) + np.repeat(first[which] - at[:-1], n)]
        cuts = at[ends].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def word_ids(path: str, special_as_text: bool = False) -> WordIds:
    return WordIds(path, special_as_text)


def write_packed(docs: DataFrame, where: str, tokenizer_path: str, end_id: int, shards: int, text: str = "text",
                 key: str = "doc_id", block_ids: int = BLOCK_IDS, special_as_text: bool = False) -> None:
    """Encode and write ``docs`` as packed shards under ``where``, in ascending ``key`` order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer_path, special_as_text)
        out = Blocks(encoder.bits, block_ids)
        end = np.array([end_id], np.uint32)

        def records() -> Iterator[bytes]:
            for batch in (part for whole in batches for part in slices(whole, "text", PIECE_BYTES)):
                texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
                # a slice of one long text is encoded in pieces
                whole = encoder.ids(texts) if len(texts) > 1 else [np.concatenate([x for p in pieces(texts[0]) for x in encoder.ids([p])])]
                for d, ids in zip(batch.column("doc_id").to_pylist(), whole):
                    yield from out.add(NULL_ID if d is None else d, np.concatenate([ids, end]))
            yield from out.close()

        for record in records():
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["record"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    # the cast keeps the bytes as they are, and the text writer writes them so
    rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.text(where)


def read_packed(spark: SparkSession, where: str, workspace: Workspace) -> DataFrame:
    """Per document of the shards under ``where``: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(data.as_py())
                rows = [(d, a, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, a, x in shard.documents()]
                if rows:
                    ids, starts, n, crc = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(rows), pa.string()), pa.array([None if d == NULL_ID else d for d in ids], pa.int64()),
                         *(pa.array(v, pa.int64()) for v in (starts, n, crc))],
                        names=["shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(where)
    names = F.element_at(F.split("path", "/"), -1)
    found = workspace.keep(
        files.select(names.alias("shard"), "content").mapInArrow(
            run, "shard string, doc_id long, local long, n_tokens long, ids_crc32 long"), "read")
    # one row a shard: shards are numbered in the order of doc_id
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as packed shards (end id 2) and read back."""
    import public_tokenizers as vocab

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ws = Workspace(spark, "packed")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    where = ws.path("shards")
    write_packed(docs, where, vocab.path("word_bpe_49k.json"), 2, 1 + size // SHARD_BYTES)
    return read_packed(spark, where, ws)
