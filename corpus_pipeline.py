"""A training-corpus pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a frame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.

1. language_id: documents without a letter or without a clear language go; the
   others keep their label, and get the predicted one where it is null.
2. jaccard_join: of documents that are linked by five-word shingles (similarity
   0.8) the one with the smallest id stays.  Rows that repeat an id with the same
   text are one document (of other columns that differ, the smallest lang, source and
   n_chars stay), with different texts they are documents of their own.
3. suffix_dedup: strings of 256 bytes or more that start elsewhere too, and passages
   of over fifty words, however few bytes they take, that are there again without
   overlap, are cut out (byte for byte, with what is between the words); a document
   that consists of them goes.
4. decontamination: runs of ten words or more of a benchmark item (or a shorter
   whole item) are cut out; a document with more than half of its words in them goes.
5. byte_bpe: token ids of each text, with the result of decoding them again.

Where a text changes, n_chars changes with it; other columns pass through the
filtering stages.  Null ids are kept (as documents of
their own), null texts go in the first stage, empty inputs give empty outputs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import bytebpe, decontam, jaccard, langid, suffix
from landfall.llm.common import Workspace, semi, ship, table
from landfall.session import session_conf

#: How far the best language must be ahead of the next (shares of the soft minimum).
MIN_LEAD = 0.05
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)
REPEAT_BYTES, REPEAT_WORDS = 256, 51
WINDOW, MAX_COVERAGE = 10, 0.5
BATCH_BYTES = str(4 << 20)
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def filtering(stage: Stage) -> Stage:
    """Columns beyond those of documents travel under names of their own, so that none clashes with an operator's."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        aside = {c: f"_extra{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in aside.items()}).select(docs.columns)

    return run


@filtering
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = langid.identify(spark, docs, langid.train(docs), min_lead=MIN_LEAD)
    sure = found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous"))
    return sure.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


@filtering
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline-jaccard")
    again = ws.keep(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        groups = ws.keep(jaccard.near_duplicates(spark, docs, k=SHINGLE_WORDS, threshold=SIMILARITY), "groups")
        gone = groups.where("doc_id != component_id").select("doc_id").distinct()
        return semi(docs, gone, "doc_id", how="left_anti")
    # rows of one id: those of one text are one document, those of different texts are documents of their own
    several = semi(docs.where("doc_id IS NOT NULL"), again, "doc_id").withColumn("_vertex", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    several = several.groupBy("_vertex").agg(F.min_by(F.struct(*docs.columns), F.struct("lang", "source", "n_chars")).alias("row"))
    once = semi(docs, again, "doc_id", how="left_anti").withColumn("_vertex", F.col("doc_id"))
    rows = ws.keep(once.unionByName(several.select("_vertex", "row.*")), "rows")
    groups = ws.keep(jaccard.near_duplicates(spark, rows, key="_vertex", k=SHINGLE_WORDS, threshold=SIMILARITY), "groups")
    named = groups.join(rows.select("_vertex", "doc_id"), "_vertex")
    best = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "_vertex")).alias("best")).select("component_id", F.col("best._vertex").alias("kept"))
    gone = groups.join(best, "component_id").where("_vertex != kept").select("_vertex")
    return semi(rows, gone, "_vertex", how="left_anti").select(docs.columns)


@filtering
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = suffix.dedup(spark, docs, length=REPEAT_BYTES, words=REPEAT_WORDS)
    found = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S"))
    cut = F.col("n_removed") > 0
    return found.withColumn("text", F.when(cut, F.col("kept")).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(docs.columns)


@filtering
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    before = docs.withColumn("_n", F.length("text"))
    clean = decontam.decontaminate(spark, before, table(spark, sf_dir, "benchmark"), WINDOW, MAX_COVERAGE)
    n = F.length("text")
    return clean.withColumn("n_chars", F.when(n.eqNullSafe(F.col("_n")), F.col("n_chars")).otherwise(
        n.cast(docs.schema["n_chars"].dataType))).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    ship(spark)
    ranks = vocab.path("byte_bpe_50k.tiktoken")
    coded = bytebpe.round_trip(docs.select("doc_id", "lang", "source", "text"), ranks, vocab.PATTERN)
    same = F.col("raw") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "token_ids")


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The language classifier, the suffix arrays and the encoder have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    ship(spark)
    # a batch of long texts is bounded by its bytes, not only by its rows
    with session_conf(spark, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        for name, stage in STAGES[:-1]:
            docs = ws.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
