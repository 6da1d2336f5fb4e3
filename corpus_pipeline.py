"""Corpus pipeline: from raw documents to token ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and calls one operator.  All but the
last return the columns of their input, for the documents that stay.  ``run`` writes what
a stage returns to the shared checkpoint folder and hands the stored table to the next.

Defined cases: rows repeating id and text are copies, of which exact deduplication leaves
one; two rows that share an id but not their text are different documents; a null id is a
value like any other; an empty table stays empty through every stage; further columns,
whatever their names, come back unchanged from every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.op1_exact_dedup import SPACE, exact_dedup
from opsanalytics.llm.op3_quality_crf import SAMPLE, learn, score, training_rows
from opsanalytics.llm.op5_latent_decontamination import decontaminate
from opsanalytics.llm.op6_pieces import encode
from opsanalytics.llm.op7_jaccard_join import heads, linked_rows
from opsanalytics.llm.store import column, row_key, saved, table, text_of

# The classifier's curve, the band hashes and the latent basis are not SQL; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose line-level quality score reaches the cut stay."""
    model = learn(training_rows(docs, table(spark, sf_dir, "labels"), "quality", 4, 2, {0: SAMPLE, 1: SAMPLE}))
    return score(docs, model, keep_text=True).where("predicted = 1").select("row.*")


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the caller's row as one struct beside the columns worked with, so that no name of theirs is in the way."""
    return docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), "doc_id", text_of().alias("text"))


def _stay(rows: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys (null-safe) are in ``ids``."""
    named = ids.select(*[F.col(k).alias(f"stay_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"stay_{k}")) for k in keys]
    return rows.join(named, on, "left_semi")


def _one(rows: DataFrame, *keys: str) -> DataFrame:
    """Of the rows that share the keys, the one with the longest text, then the least text and content."""
    order = F.struct(-F.length("text"), "text", F.xxhash64("row"))
    return rows.groupBy(*keys).agg(F.min_by("row", order).alias("row"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest original, then the smallest id, then the least text."""
    kept = saved(exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows")), "kept")
    rows = _rows(docs).withColumn("text_sha256", F.sha2(F.regexp_replace("text", SPACE, ""), 256))
    rows = _stay(rows, kept, "doc_id", "text_sha256")
    if not kept.where("rows > 1").isEmpty():
        rows = _one(rows, "doc_id", "text_sha256")
    return rows.select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id, then the least row key, of each group linked by shingle similarity stays."""
    found = saved(heads(linked_rows(docs)), "heads")
    rows = _rows(docs).withColumn("key", row_key())
    stay = _stay(rows, found.where("heads = rows"), "doc_id", "key").select("row.*")
    copies = found.where("heads < rows")  # rows repeating id and text, in one group
    if not copies.isEmpty():
        stay = stay.unionByName(_one(_stay(rows, copies, "doc_id", "key"), "doc_id", "key").select("row.*"))
    return stay


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrase of one, go."""
    rows = _rows(docs).select("row", "text")
    return decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col="row").where("not contaminated").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(docs).select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_duplicates", near),
    ("decontamination", clean_of_benchmark),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
