"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its own characters and words and of both neighbouring lines.
The field labels lines good or bad; forward-backward marginals, weighted by line length,
are averaged into one figure per document, and a logistic curve fitted on the training
sample turns its log-odds into the score.

The field is fitted on a bounded sample of labelled training rows: about ``SAMPLE`` documents of
each label, chosen by a hash of the id, each with all its lines, and of these, in the order of a
hash of the text, as many as have ``SAMPLE_LINES`` lines together (a text of more lines than that is
not in the sample).  Lines carry their document's label.  Scoring reads every line of every document.

Defined cases: a null text is empty; an empty text is one empty line; without training
rows of both labels every score is the share of label 1 (0.5 without any); rows repeating
an id are scored each; labels that are null are not learnt from; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsanalytics.llm import crf
from opsanalytics.llm import textvec as tv
from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import held_out, packed, table, with_row

SAMPLE, SAMPLE_LINES, CUT = 2500, 250_000, 0.7
_UPPER, _LOWER, _DIGIT, _SPACE, _STOP, _MARK, _OTHER = range(7)


def _kind(b: int) -> int:
    c = chr(b)
    if b >= 128:
        return _LOWER
    if c.isupper():
        return _UPPER
    if c.islower():
        return _LOWER
    if c.isdigit():
        return _DIGIT
    if c in " \t\r\v\f":
        return _SPACE
    if c in ".,;:?'\"-()":
        return _STOP
    return _OTHER if b < 32 or b == 127 else _MARK


KINDS = np.array([_kind(b) for b in range(256)], np.uint8)
OWN = 17


def lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line, and line offsets of the texts; a text has one line more than line feeds."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([off[:-1], feeds + 1]), kind="stable")
    before = np.searchsorted(feeds, off, "left")
    loff = before + np.arange(len(off))
    ends = np.empty(len(starts), np.int64)
    last = loff[1:] - 1
    rest = np.ones(len(starts), bool)
    rest[last] = False
    ends[last] = off[1:]
    ends[rest] = feeds
    return starts, ends, loff


def line_features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(own features per line, line lengths, line offsets)."""
    starts, ends, loff = lines(data, off)
    length = (ends - starts).astype(np.float64)
    kinds = KINDS[data]
    share = np.zeros((len(starts), 7))
    for k in range(7):
        at = np.concatenate([[0], np.cumsum(kinds == k)])
        share[:, k] = at[ends] - at[starts]
    same = np.concatenate([[0], np.cumsum((data[1:] == data[:-1]) & (KINDS[data[1:]] == _MARK))]) if len(data) else np.zeros(1, np.int64)
    same = np.concatenate([same, same[-1:]])
    runs = same[np.maximum(ends - 1, starts)] - same[starts]
    w_lo, w_hi, _ = tv.words(data, np.unique(np.concatenate([off, starts])), tv.SPACES)
    hashes = tv.word_hashes(data, w_lo, w_hi)
    first, stop = np.searchsorted(w_lo, starts), np.searchsorted(w_lo, ends)
    count = (stop - first).astype(np.float64)

    def per_line(flag: np.ndarray) -> np.ndarray:
        at = np.concatenate([[0], np.cumsum(flag)])
        return (at[stop] - at[first]).astype(np.float64)

    line_of = np.searchsorted(starts, w_lo, "right")
    again = np.zeros(len(w_lo), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    tail_mark = KINDS[data[w_hi - 1]] == _MARK if len(w_lo) else np.zeros(0, bool)
    alone = (w_hi - w_lo == 1) & (KINDS[data[w_lo]] == _MARK) if len(w_lo) else np.zeros(0, bool)
    distinct = np.zeros(len(starts))
    if len(w_lo):
        pairs = np.unique(np.stack([line_of.astype(tv.U), hashes]), axis=1)[0] if len(w_lo) < 64 else _distinct(line_of, hashes)
        np.add.at(distinct, (pairs - 1).astype(np.int64), 1)
    chars, some = np.maximum(length, 1), np.maximum(count, 1)
    letters = np.maximum(share[:, _UPPER] + share[:, _LOWER], 1)
    own = np.column_stack([
        share[:, _UPPER] / letters, share[:, _DIGIT] / chars, share[:, _SPACE] / chars, share[:, _STOP] / chars,
        share[:, _MARK] / chars, share[:, _OTHER] / chars, runs / chars, per_line(again) / some, per_line(tail_mark) / some,
        per_line(alone) / some, np.minimum(chars / some, 40) / 10, np.log1p(length) / 8, np.log1p(count) / 6,
        1 - np.minimum(distinct / some, 1), (count >= 8) * (1 - np.minimum(distinct / some, 1)), length == 0, share[:, _UPPER] > share[:, _LOWER],
    ]).astype(np.float64)
    return own, length, loff


def _distinct(line_of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    order = np.lexsort((hashes, line_of))
    a, b = line_of[order], hashes[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new]


def with_neighbours(own: np.ndarray, loff: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero past a text's ends), and a constant."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    full = np.diff(loff) > 0
    before[loff[:-1][full]] = 0
    after[loff[1:][full] - 1] = 0
    return np.column_stack([own, before, after, np.ones(len(own))])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    slope: float
    shift: float
    constant: float | None = None

    def evidence(self, own: np.ndarray, length: np.ndarray, loff: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the marginals of "good", as log-odds, per text."""
        x = with_neighbours((own - self.mean) / self.scale, loff)
        p = crf.marginals(np.stack([np.zeros(len(x)), x @ self.weights], 1), loff, self.trans)[0][:, 1]
        weight = length + 1
        mean = np.add.reduceat(p * weight, loff[:-1]) / np.add.reduceat(weight, loff[:-1])
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def score(self, own: np.ndarray, length: np.ndarray, loff: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(loff) - 1, self.constant)
        return 1 / (1 + np.exp(-(self.slope * self.evidence(own, length, loff) + self.shift)))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, off in tv.slices(batch.column("text")):
            own, length, loff = line_features(data, off)
            for k in range(j - i):
                lo, hi = loff[k], loff[k + 1]
                yield pa.RecordBatch.from_pydict({
                    "label": batch.column("label").slice(i + k, 1), "length": [length[lo:hi]], "own": [own[lo:hi].ravel()]})


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(weight * (y - p) * x).sum() - 1e-3 * (a - 1), (weight * (y - p)).sum() - 1e-3 * b])
        r = weight * p * (1 - p)
        h = np.array([[(r * x * x).sum() + 1e-3, (r * x).sum()], [(r * x).sum(), r.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


def within_lines(rows: DataFrame, most: int) -> DataFrame:
    """Rows of a bounded sample, per label in the order of a hash of the text, up to ``most`` lines together."""
    breaks = F.length("text") - F.length(F.translate("text", "\n", ""))
    sized = rows.withColumns({"place": F.xxhash64("text"), "lines": F.coalesce(breaks, F.lit(0)) + 1})
    upto = Window.partitionBy("label").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)  # numbers only, bounded by the sample
    sums = sized.where(F.col("lines") <= most).select("label", "place", F.sum("lines").over(upto).alias("upto"))
    last = {r["label"]: r["last"] for r in sums.where(F.col("upto") <= most).groupBy("label").agg(F.max("place").alias("last")).collect()}
    fits = [(F.col("label") == k) & (F.col("place") <= v) for k, v in last.items()]
    return sized.where((F.col("lines") <= most) & reduce(lambda a, b: a | b, fits, F.lit(False))).select(*rows.columns)


def learn(rows: DataFrame, most_lines: int = SAMPLE_LINES) -> Model:
    """``rows`` is a bounded sample with text and label (0 or 1)."""
    rows = within_lines(rows.where("label in (0, 1)").select("label", "text"), most_lines)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(OWN), np.ones(OWN), np.zeros(0), np.zeros((2, 2)), 1, 0, float(next(iter(counts), 0.5)))
    got = rows.mapInArrow(
        _sample_features, "label int, length array<double>, own array<double>").toArrow()
    label = got.column("label").to_numpy()
    n = got.column("length").combine_chunks().value_lengths().to_numpy()
    loff = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    own = got.column("own").combine_chunks().flatten().to_numpy().reshape(-1, OWN)
    length = got.column("length").combine_chunks().flatten().to_numpy()
    mean, scale = own.mean(0), own.std(0) + 1e-3
    weight = np.where(label == 1, 0.5 / (label == 1).mean(), 0.5 / (label == 0).mean())
    x = with_neighbours((own - mean) / scale, loff)
    w, trans = crf.fit(x, loff, np.repeat(label, n), weight)
    model = Model(mean, scale, w, trans, 1, 0)
    model.slope, model.shift = _logistic(model.evidence(own, length, loff), label, weight)
    return model


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, j, data, off in tv.slices(batch.column("text")):
                score[i:j] = model.score(*line_features(data, off))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """(row, score, predicted): ``row`` holds the columns of ``docs``, without the text unless it is to be kept."""
    src = packed(docs, text_col, keep_text)
    return src.mapInArrow(_score(model), with_row(src, "score double")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: dict[int, int]) -> DataFrame:
    """(text, label) of a sample of the labelled documents outside the held-out fold: about ``most[label]``
    of each label at most, chosen by a hash of the id.  The sample's ids are bounded by that, so they are
    broadcast and no text is shuffled.  An id with several labels has the least."""
    known = labels.groupBy("doc_id").agg(F.min(label).alias("label")).where("label in (0, 1)")
    known = known.where(~held_out("doc_id", modulus, remainder))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1_000_000))
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, int(1e6 * min(1.0, most[value] / n))).otherwise(share)
    return docs.select("doc_id", "text").join(F.broadcast(known.where(place < share)), "doc_id").select("text", "label")


@corpus_query("op3_quality_crf")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(training_rows(docs, table(spark, sf_dir, "labels"), "quality", 4, 2, {0: SAMPLE, 1: SAMPLE}))
    scored = score(docs.select("doc_id", "text", held_out("doc_id", 4, 2).alias("held_out")), model)
    return scored.select("row.doc_id", "row.held_out", "score", "predicted")
