"""Removal of repeated byte strings by a run-length index.

Super-windows of ``LENGTH`` bytes (see ``repeats``) gather, under one anchor hash, all
places where a string of that length can repeat.  Per bucket of groups the operator
builds the Burrows-Wheeler transform of the distinct contents, keeps its runs, and
samples the text positions at both ends of every run with their longest common prefix
with the neighbouring suffix.  Inside a run the next position's value is one less than
the last one's, so streaming over the text from sample to sample gives the matching
statistics of every position against all others; those of ``LENGTH`` or more are marked.

Contents found twice or more anywhere are collapsed to one reference before that.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` bytes lose nothing;
strings may overlap themselves; cuts may fall inside a character, so results carry the
digest of the remaining bytes; rows repeating id and text are separate documents; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.ranks import common_prefixes, suffix_ranks
from opsanalytics.llm.repeats import Units, byte_units, with_spans
from opsanalytics.llm.store import table

LENGTH, GRAM = 400, 64
WIDTHS = (20, 5, 1)
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


class RunIndex:
    """Run-length compressed BWT of several texts, with sampled run ends."""

    def __init__(self, units: np.ndarray, off: np.ndarray):
        n = len(units)
        self.n = n
        # Full order: values carry over inside a run only if equal first symbols keep the order of what follows.
        order, levels = suffix_ranks(units, off, int(np.diff(off).max()))
        before = units[order - 1].astype(np.int64)
        heads = np.zeros(n, bool)
        heads[off[:-1][np.diff(off) > 0]] = True
        opening = heads[order]
        before[opening] = 256 + order[opening]  # a text's first position has its own symbol
        change = np.flatnonzero(before[1:] != before[:-1])
        self.runs = len(change) + 1
        # First suffix of a run against the one above it; last suffix against the one below.
        lcp = common_prefixes(order[change], order[change + 1], off, levels)  # the same seen from either side
        self.starts, self.start_lcp = self._sample(order[change + 1], lcp, order[0])
        self.ends, self.end_lcp = self._sample(order[change], lcp, order[-1])

    @staticmethod
    def _sample(at: np.ndarray, lcp: np.ndarray, alone: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in text order with their common prefix; ``alone`` has no neighbour on this side."""
        lcp, at = np.append(lcp, 0), np.append(at, alone)
        by = np.argsort(at)
        return at[by], lcp[by]

    def matching_statistics(self) -> np.ndarray:
        """Per position, the longest match that starts at another position."""
        best = np.zeros(self.n, np.int64)
        for at, lcp in ((self.starts, self.start_lcp), (self.ends, self.end_lcp)):
            if len(at):
                reach = np.full(self.n, -1, np.int64)
                reach[at] = at + lcp
                last = np.maximum.accumulate(np.where(reach >= 0, np.arange(self.n), -1))
                best = np.maximum(best, np.where(last >= 0, reach[last], 0) - np.arange(self.n))
        return best


def repeated_bytes(units: np.ndarray, off: np.ndarray, window: int) -> np.ndarray:
    flags = np.zeros(len(units), bool)
    if len(units):
        flags = RunIndex(units, off).matching_statistics() >= window
        left = np.repeat(off[1:], np.diff(off)) - np.arange(len(units))
        flags &= left >= window
    return flags


def cut_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text, spans in zip(*(batch.column(c) for c in ("doc_id", "text", "spans")), strict=True):
            raw = text.as_py().encode()
            keep, removed, runs, end, tail = [], 0, 0, 0, -1
            for s in sorted((s["at"], s["at"] + s["m"] - 1 + LENGTH) for s in spans.as_py() or []):
                if s[0] > tail:
                    keep.append(raw[end:s[0]])
                    runs += 1
                    removed += s[1] - s[0]
                    end = tail = s[1]
                elif s[1] > tail:
                    removed += s[1] - tail
                    end = tail = s[1]
            kept = b"".join([*keep, raw[end:]])
            rows.append((doc_id.as_py(), len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = list(zip(*rows, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes)."""
    marked = with_spans(docs, id_col, text_col, Units(LENGTH, GRAM, byte_units, WIDTHS), repeated_bytes, **limits)
    return marked.mapInArrow(cut_bytes, RESULT)


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, s, md5_number(substr(h, 2 * s + 1, 800)) AS k
      FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS s FROM d WHERE length(h) >= 800)),
c AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
m AS (SELECT r, s FROM w SEMI JOIN c USING (k)),
e AS (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS p FROM m),
g AS (SELECT r, s, sum((p IS NULL OR s - p > 399 + 1)::INT) OVER (PARTITION BY r ORDER BY s) AS run FROM e),
spans AS (SELECT r, run, min(s) AS a, max(s) + 400 AS b FROM g GROUP BY r, run),
cuts AS (SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM spans
         UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r),
kept AS (SELECT d.r, string_agg(substr(d.h, 2 * cuts.a + 1, 2 * (coalesce(cuts.b, length(d.h) // 2) - cuts.a)), '' ORDER BY cuts.a) AS h
         FROM cuts JOIN d USING (r) GROUP BY d.r),
n AS (SELECT r, sum(b - a)::BIGINT AS removed, count(*) AS spans FROM spans GROUP BY r)
SELECT doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(n.spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""


@corpus_query("op4_run_index", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
