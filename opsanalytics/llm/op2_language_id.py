"""Language identification by language-bitmask n-gram filters.

N-grams are ``GRAM`` consecutive bytes of the lower-cased text, ASCII non-letters as spaces.
Learning counts them per language over all training rows.  A language's filter holds every
n-gram with at least ``SHARE`` of the language's n-grams (so at most 1 / ``SHARE`` of them,
which bounds the filter) whose rate is not below ``NOISE`` of its rate in another language
(a few mislabelled or mixed texts do not put one language's n-grams into another's filter).

The Bloom filters of all languages are bit-sliced: one table of ``SLOTS`` words, bit L of a
word belonging to language L, built by a shuffle on the slot with ``bit_or``.  One lookup
(the AND of ``HASHES`` words) returns all languages that contain an n-gram.  Per text, the
hits of each language are counted and corrected by the filter's false-positive rate, which
follows from how full its slice is; the largest corrected count decides.

Defined cases: a null text or one without a letter is ``und`` with score 0; a text whose
n-grams are in no filter gets the language with the most training rows, score 0; ties go to
the language that sorts first; without training rows everything is ``und``; rows repeating
an id are predicted each; at most 64 languages (an error beyond); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm import textvec as tv
from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import held_out, packed, saved, table, with_row

GRAM = 5
SHARE, NOISE = 1e-5, 0.02
SLOTS, HASHES = 1 << 21, 4
FLUSH = 1 << 20

_SPACED = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)
_BLANK = tv.U(int.from_bytes(b" " * GRAM, "big"))


def grams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, n-grams as integers, offsets per text); each text has two spaces around it."""
    two = pa.scalar("  ", pa.large_string())
    padded = pc.binary_join_element_wise(two, tv.folded(column), two, pa.scalar("", pa.large_string()))
    for i, j, data, off in tv.slices(padded):
        data = _SPACED[data].astype(tv.U)
        codes = np.zeros(max(len(data) - GRAM + 1, 0), tv.U)
        for k in range(GRAM):
            codes = (codes << tv.U(8)) | data[k:k + len(codes)]
        inside = np.zeros(len(data) + 1, np.int32)
        np.add.at(inside, off[:-1], 1)
        np.add.at(inside, np.maximum(off[1:] - GRAM + 1, off[:-1]), -1)
        good = (np.cumsum(inside)[:len(codes)] > 0) & (codes != _BLANK)
        at = np.concatenate([[0], np.cumsum(good)])
        yield i, j, codes[good], at[np.minimum(off, len(codes))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

    def out(lang: str) -> pa.RecordBatch:
        codes, n = merged(held.pop(lang))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(n)],
                                          names=["lang", "gram", "n"])

    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            for _, _, codes, _ in grams(batch.filter(pc.equal(langs, lang)).column("text")):
                parts = held.setdefault(lang, [])
                parts.append(np.unique(codes, return_counts=True))
                if len(parts) >= 16:
                    parts[:] = [merged(parts)]
                    if len(parts[0][0]) > FLUSH:
                        yield out(lang)
    for lang in list(held):
        yield out(lang)


@dataclass
class Filters:
    languages: list[str]
    most: str
    words: np.ndarray
    false_rate: np.ndarray


def slots(codes: np.ndarray, k: int) -> np.ndarray:
    """Where the k-th hash puts each n-gram."""
    return (tv.mix(codes * tv.U(tv.ODD[0]) + tv.U(k + 1)) & tv.U(SLOTS - 1)).astype(np.int64)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("gram").to_numpy().view(tv.U)
        for k in range(HASHES):
            yield pa.RecordBatch.from_arrays([pa.array(slots(codes, k)), batch.column("mask")], names=["slot", "mask"])


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters | None:
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null")
    counts = rows.groupBy("lang").count().orderBy("lang").limit(65).collect()
    if not counts:
        return None
    languages = [r["lang"] for r in counts]
    if len(languages) > 64:
        raise ValueError("at most 64 languages")
    seen = saved(rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = seen.groupBy("lang").agg(F.sum("n").alias("total")).collect()  # one row per language, 64 at most
    total = {r["lang"]: r["total"] for r in totals}
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for kv in total.items() for x in kv]), F.col("lang")) if total else F.lit(0.0)
    bit = F.element_at(F.create_map(*[x for k, v in enumerate(languages) for x in (F.lit(v), F.lit(1 << k if k < 63 else -(1 << 63)).cast("bigint"))]), F.col("lang"))
    rated = seen.withColumn("rate", rate).withColumn("bit", bit)
    best = rated.groupBy("gram").agg(F.max("rate").alias("best")).where(F.col("best") >= SHARE)
    masks = (rated.where(F.col("rate") >= SHARE).join(best, "gram").where(F.col("rate") >= NOISE * F.col("best"))
             .groupBy("gram").agg(F.bit_or("bit").alias("mask")))
    filled = masks.mapInArrow(_fill, "slot bigint, mask bigint").groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    got = filled.toArrow()  # SLOTS rows at most
    words = np.zeros(SLOTS, tv.U)
    words[got.column("slot").to_numpy()] = got.column("mask").to_numpy().view(tv.U)
    fill = np.array([np.count_nonzero(words >> tv.U(k) & tv.U(1)) / SLOTS for k in range(len(languages))])
    most = max(counts, key=lambda r: (r["count"], [-ord(c) for c in r["lang"]]))["lang"]
    return Filters(languages, most, words, fill**HASHES)


def _predict(model: Filters | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            lettered = np.array(pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False), bool)
            named, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for i, j, codes, off in grams(text) if model else ():
                found = np.full(len(codes), np.iinfo(np.uint64).max, tv.U)
                for k in range(HASHES):
                    found &= model.words[slots(codes, k)]
                n = np.diff(off)
                corrected = np.zeros((j - i, len(model.languages)))
                for k, rate in enumerate(model.false_rate):
                    total = np.concatenate([[0], np.cumsum((found >> tv.U(k)) & tv.U(1), dtype=np.int64)])
                    hits = total[off[1:]] - total[off[:-1]]
                    corrected[:, k] = np.maximum(hits - n * rate, 0) / (1 - rate)
                best = corrected.argmax(1)
                top = corrected[np.arange(j - i), best]
                pick = np.where(top > 0, np.array(model.languages, object)[best], model.most)
                named[i:j] = np.where(lettered[i:j], pick, "und")
                score[i:j] = np.where(lettered[i:j], top / np.maximum(corrected.sum(1), 1e-300), 0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(named, pa.string()), pa.array(np.clip(score, 0, 1))],
                                             names=["row", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Filters | None, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): ``row`` holds the columns of ``docs`` without the text."""
    src = packed(docs, text_col)
    return src.mapInArrow(_predict(model), with_row(src, "lang_pred string, score double"))


@corpus_query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    model = learn(docs.where("not held_out"))
    return predict(docs.select("doc_id", "text", "held_out"), model).select("row.*", "lang_pred", "score")
