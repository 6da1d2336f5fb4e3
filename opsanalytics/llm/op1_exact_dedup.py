"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

Each normalised text is cut into content-defined chunks: a chunk ends where three
characters from fixed classes follow each other, at least ``MIN_CHUNK`` characters after
its start, or after ``MAX_CHUNK`` characters at the latest.  Equal texts therefore
have equal chunk sequences, and an edit changes only the chunks near it.

1. Every distinct (digest, chunk) pair is shuffled once, after partial aggregation,
   so a chunk shared by a third of all documents moves once per map task.
2. A digest is a verified identifier when it stands for one chunk content.  If any
   digest stands for several, the whole step is repeated with the next digest of
   ``LADDER``; its last rung is the chunk itself, which always verifies.
3. Documents are grouped by their ordered identifier lists; documents themselves
   never move, only their recipes.

Defined cases: a null text counts as empty; an empty normalised text has an empty
recipe, so all of them form one group; rows with equal id and text are separate
members of their group (each counts in ``group_size``, and each is marked kept when
it carries the id that stays); a null id sorts after all others; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import saved, table, text_of

SPACE = r"[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 512, 4096
# In Latin-script prose some dozens of characters lie between two places that can end a
# chunk; other scripts end chunks at their sentence marks.
CUT = r"(?:[a-m0-4][b-np-z][ckmuvwxyz13579.]|[\u3002\uFF01\uFF1F\u0964\u061F])"
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?{CUT}|.{{1,{MAX_CHUNK}}}"

Digest = Callable[[Column], Column]
LADDER: Sequence[Digest] = (F.md5, lambda c: F.sha2(c, 256), lambda c: c)


def recipes(docs: DataFrame, id_col: str, text_col: str, ladder: Sequence[Digest]) -> DataFrame:
    """One row per document: id, length, SHA-256 of the normalised text and ordered chunk identifiers."""
    base = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    base = base.select("doc_id", F.length("t").alias("n"), F.regexp_replace("t", SPACE, "").alias("t"))
    base = base.select("doc_id", "n", F.sha2("t", 256).alias("text_sha256"),
                       F.regexp_extract_all("t", F.lit(CHUNK), F.lit(0)).alias("chunks"))
    for digest in ladder:
        chunks = base.select(F.explode("chunks").alias("chunk")).select(digest(F.col("chunk")).alias("d"), "chunk")
        if chunks.distinct().groupBy("d").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("no digest of the ladder tells all chunks apart")
    return saved(base.select("doc_id", "n", "text_sha256", F.transform("chunks", digest).alias("recipe")), "recipes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ladder: Sequence[Digest] = LADDER) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, id_col, text_col, ladder)
    # Longest original first, then smallest id; a null id loses against every other.
    order = F.struct(-F.col("n").cast("long"), F.col("doc_id").isNull(), F.col("doc_id"))
    groups = rows.groupBy("recipe").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    # Written first, so that the join reads both sides from exchanges and a hot recipe's rows can be split.
    groups = saved(groups.select("recipe", "group_size", F.col("best.doc_id").alias("keep_id")), "groups")
    return rows.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
       text_sha256
FROM n
"""


@corpus_query("op1_exact_dedup", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
