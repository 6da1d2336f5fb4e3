"""Removal of repeated word sequences by suffix trees over partitioned windows.

A window is ``LENGTH`` consecutive words.  The suffixes placed are a sample that every window
holds one of: those that start at the least-hash gram of ``GRAM`` words of some window
(see ``repeats``), each with the words before it that its windows need.  They are grouped by a
prefix of ``GRAM`` words.  Groups too large for memory get longer prefixes, of ``PREFIXES``
words: the windows of a suffix split by whether they hold its first 18 words, or start that much
earlier and hold the first 18 words of an earlier suffix, and so on with 27 and 32; a prefix of
35 words is a window, whose group is one node.  Words are compared by 64-bit hash, prefixes and
whole copies by 128 bits.  Each task builds the suffix subtrees of its groups: suffixes in order,
longest common prefixes between neighbours, and the internal nodes as the intervals of
that array.  Nodes at depth ``LENGTH`` or more are maximal repeats; all their leaves are
marked.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` unchanged; a null text has none; texts of
fewer than ``LENGTH`` words lose nothing; sequences may overlap themselves; rows repeating
id and text are separate documents; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from opsanalytics.llm import textvec as tv
from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.ranks import common_prefixes, suffix_ranks
from opsanalytics.llm.repeats import Units, with_spans, word_units
from opsanalytics.llm.store import table

LENGTH, GRAM = 35, 8
PREFIXES = (18, 27, 32, 35)
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string"


def subtree_nodes(units: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order and the internal nodes at ``depth`` or deeper, topmost ones, as (first, end) intervals of it."""
    order, levels = suffix_ranks(units, off, depth)
    lcp = common_prefixes(order[:-1], order[1:], off, levels)
    deep = np.concatenate([[False], lcp >= depth, [False]])
    edge = np.diff(deep.astype(np.int8))
    return order, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1


def repeated_words(units: np.ndarray, off: np.ndarray, window: int) -> np.ndarray:
    flags = np.zeros(len(units), bool)
    if len(units) > 1:
        order, first, end = subtree_nodes(units, off, window)
        leaf = np.zeros(len(units) + 1, np.int32)
        np.add.at(leaf, first, 1)
        np.add.at(leaf, end, -1)
        flags[order[np.cumsum(leaf[:-1]) > 0]] = True
        left = np.repeat(off[1:], np.diff(off)) - np.arange(len(units))
        flags &= left >= window
    return flags


def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, spans = batch.column("doc_id"), batch.column("spans")
        for i, j, data, off in tv.slices(batch.column("text")):
            starts, ends, woff = tv.words(data, off, tv.SPACES)
            gone = np.zeros(len(starts) + 1, np.int32)
            for k in range(i, j):
                for s in spans[k].as_py() or ():
                    gone[woff[k - i] + s["at"]] += 1
                    gone[woff[k - i] + s["at"] + s["m"] + LENGTH - 1] -= 1
            gone = np.cumsum(gone[:-1]) > 0
            # Each kept word with one space before it; a text's first space is taken off below.
            raw = data.tobytes()
            n, removed, digest, kept = [], [], [], []
            for k in range(j - i):
                lo, hi = woff[k], woff[k + 1]
                out = gone[lo:hi]
                if out.any():
                    text = b" ".join([raw[a:b] for a, b in zip(starts[lo:hi][~out].tolist(), ends[lo:hi][~out].tolist(), strict=True)])
                else:
                    text = b" ".join(raw[off[k]:off[k + 1]].split())
                n.append(int(hi - lo))
                removed.append(int(out.sum()))
                digest.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode())
            yield pa.RecordBatch.from_arrays([
                ids.slice(i, j - i), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (the words left, one space between)."""
    marked = with_spans(docs, id_col, text_col, Units(LENGTH, GRAM, word_units, tuple(LENGTH - p + 1 for p in PREFIXES)), repeated_words, **limits)
    return marked.mapInArrow(cut_words, RESULT)


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, s, md5_number(array_to_string(ws[s:s + 34], ' ')) AS k
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS s FROM d WHERE len(ws) >= 35)),
c AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS i FROM w SEMI JOIN c USING (k)),
x AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
k AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM x ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@corpus_query("op8_suffix_trees", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
