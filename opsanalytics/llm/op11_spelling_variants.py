"""Spelling variants: words one edit apart, by dynamic programming over sorted lists.

1. Tasks count the words of whole texts and add up their counts before the shuffle.
2. Two words one edit apart, the shorter of ``m`` code points, share all letters before and
   behind the edit.  A list holds the words of m and m + 1 code points that agree in their
   first ``lo`` and last ``m - hi`` letters, and answers for the pairs whose common prefix
   has at least ``lo`` and fewer than ``hi`` letters.  A word starts in the lists (0, m / 2)
   and (m / 2, m); a list of more than ``LIST_LIMIT`` words is split at the middle of its
   [lo, hi), again and again.  A list of one place ends this: its words differ in at most two
   letters, so it holds no more than the alphabet squared, whatever the corpus repeats.
   The common prefix of a pair is one number, so each pair is found in exactly one list.
3. A task takes many lists, sorted.  All words of one list are matched in one scan of it:
   a state is a word and a range of the list with a common prefix, with the banded row
   (three cells) of the edit matrix for that prefix.  The row is computed once for the range
   and reused by all its words; the adjacent common prefixes (LCP) give where the range
   splits at the next letter; a range whose row has no cell of one edit or less is skipped.
4. Per word a list returns one row (near words, the most frequent of them), so no pairs
   leave a task.  Forms are followed to their roots by pointer doubling.

Defined cases: a null text has no words; a null id counts as the empty text in the hash that
deletes letters; words of equal count tie by code-point order; a word is not near itself;
rows repeating id and text count twice; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import saved, table, text_of

LEAST, TWICE, RATIO, MODULUS = 7, 2, 10, 31
LIST_LIMIT = 4096
BUCKET_ROWS = 100_000
HELD_WORDS = 200_000  # distinct words a task counts before it hands them on
QUERIES_AT_ONCE = 1 << 14

# ---------------------------------------------------------------------------
# Words and counts
# ---------------------------------------------------------------------------


def damaged(doc: str, run: str) -> str:
    """The run without one letter, if the hash of document and run says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _counting(least: int):
    # A shorter run gives no word of that length: runs are maximal and letters only go.
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                low = text.as_py().encode().lower().decode()  # bytes: only A-Z change
                for word, n in Counter(runs.findall(low)).items():
                    seen[damaged(doc, word)] += n
                if len(seen) > HELD_WORDS:
                    yield _counted(seen, least)
                    seen.clear()
        yield _counted(seen, least)
    return run


def _counted(seen: Counter, least: int) -> pa.RecordBatch:
    kept = [(w, n) for w, n in seen.items() if len(w) >= least]
    return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(word, n) of the words with at least ``least`` code points and two occurrences."""
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), text_of(text_col).alias("text"))
    counts = src.mapInArrow(_counting(least), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= TWICE)


# ---------------------------------------------------------------------------
# Lists
# ---------------------------------------------------------------------------


def _key() -> Column:
    """Names a list; a clash only joins two lists in one task, which keeps them apart."""
    return F.xxhash64("m", "lo", "hi", F.expr("left(word, lo)"), F.expr("right(word, m - hi)"))


def lists(words: DataFrame, least: int = LEAST, limit: int = LIST_LIMIT) -> DataFrame:
    """(key, m, lo, hi, word, n): every word in the lists that may hold a near word of it."""
    size = F.length("word")
    m = F.when(size > least, F.array(size - 1, size)).otherwise(F.array(size))
    rows = words.select("word", "n", F.explode(m).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    window = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("m").alias("hi")))
    rows = rows.select("word", "n", "m", F.inline(window)).withColumn("key", _key())
    done = []
    while True:
        large = saved(rows.groupBy("key").agg(F.count("*").alias("c"), F.max(F.col("hi") - F.col("lo")).alias("width"))
                      .where(f"c > {limit} and width > 1").select("key"), "large_lists")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, done, rows)
        done.append(rows.join(large, "key", "left_anti"))
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi"))
        split = rows.join(large, "key", "left_semi").select("word", "n", "m", F.inline(halves)).where("lo < hi")
        rows = saved(split.withColumn("key", _key()), "split_lists")


# ---------------------------------------------------------------------------
# Scan of sorted lists
# ---------------------------------------------------------------------------


class SortedLists:
    """Words in list order, then code-point order, with adjacent common prefixes."""

    def __init__(self, part: pd.DataFrame):
        part = part.sort_values(["key", "m", "lo", "hi", "word"], ignore_index=True)
        self.words = part["word"].to_numpy()
        self.n = part["n"].to_numpy(np.int64)
        self.m, self.lo, self.hi = (part[c].to_numpy(np.int64) for c in ("m", "lo", "hi"))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.size)])
        # Two zeros behind the last word stand for positions past an end.
        self.code = np.append(np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32), [0, 0])
        same = np.ones(max(len(part) - 1, 0), bool)
        for c in ("key", "m", "lo", "hi"):
            v = part[c].to_numpy()
            same &= v[1:] == v[:-1]
        head = np.append(True, ~same)[:len(part)]
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(part))
        which = np.cumsum(head) - 1
        self.first, self.end = starts[which], ends[which]
        self.lcp = self._prefixes(head)
        order = np.argsort(self.lcp, kind="stable")
        self.splits, self.split_lcp = order, self.lcp[order]

    def at(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < self.size[row])
        return np.where(inside, self.code[np.where(inside, self.off[row] + place, 0)], 0)

    def _prefixes(self, head: np.ndarray) -> np.ndarray:
        """Common prefix of each word with the one before it in its list; -1 at a list's head."""
        lcp = np.where(head, -1, 0)
        row = np.flatnonzero(~head)
        p = 0
        while len(row):
            a, b = self.at(row, np.full(len(row), p)), self.at(row - 1, np.full(len(row), p))
            row = row[(a == b) & (a > 0)]
            p += 1
            lcp[row] = p
        return lcp

    def children(self, l: np.ndarray, r: np.ndarray, p: int):
        """Each range [l, r) with a common prefix of ``p`` letters, split by the next letter: (state, start, end)."""
        b = self.splits[np.searchsorted(self.split_lcp, p, "left"):np.searchsorted(self.split_lcp, p, "right")]
        lo, hi = np.searchsorted(b, l, "right"), np.searchsorted(b, r, "left")
        k = hi - lo + 1
        state = np.repeat(np.arange(len(l)), k)
        j = np.arange(len(state)) - np.repeat(np.cumsum(k) - k, k)
        if not len(b):
            return state, l, r
        start = np.where(j == 0, l[state], b[np.minimum(lo[state] + j - 1, len(b) - 1)])
        end = np.where(j == k[state] - 1, r[state], b[np.minimum(lo[state] + j, len(b) - 1)])
        return state, start, end

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query row, near row) of all words one edit apart for which the list of the query answers."""
        queries = queries[np.argsort(self.lo[queries], kind="stable")]
        starts = self.lo[queries]
        q = np.zeros(0, np.int64)
        l = r = q
        band = np.zeros((3, 0), np.int8)
        out = []
        p = int(starts[0]) if len(queries) else 0
        waiting = 0
        while len(q) or waiting < len(queries):
            if not len(q):
                p = int(starts[waiting])
            upto = int(np.searchsorted(starts, p, "right"))
            if upto > waiting:  # lists that share p letters join the scan: no edit so far
                new = queries[waiting:upto]
                waiting = upto
                q, l, r = np.append(q, new), np.append(l, self.first[new]), np.append(r, self.end[new])
                cells = np.stack([np.full(len(new), 1 if p else 2), np.zeros(len(new)), np.where(p + 1 <= self.size[new], 1, 2)]).astype(np.int8)
                band = np.concatenate([band, cells], axis=1)
            state, l, r = self.children(l, r, p)
            q, band = q[state], band[:, state]
            c = self.at(l, np.full(len(l), p))
            left = self.size[q] - p
            # The edit must stand in the list's own places.
            here = self.at(q, np.full(len(q), p))
            own = (p < self.hi[q]) | (self.hi[q] == self.m[q])
            fits = (band[1] > 0) | own | ((c == here) & (c > 0))
            done = (c == 0) & (np.abs(left) <= 1)
            edits = np.where(done, np.take_along_axis(band, np.clip(left + 1, 0, 2)[None], 0)[0], 2)
            hit = (edits == 1) & fits
            out.append((q[hit], l[hit]))
            go = (c > 0) & fits
            q, l, r, c, left, band = q[go], l[go], r[go], c[go], left[go], band[:, go]
            b0, b1, b2 = band
            here = self.at(q, np.full(len(q), p))
            n0 = np.minimum(b0 + (c != self.at(q, np.full(len(q), p - 1))), b1 + 1)
            n0 = np.where(left >= 0, n0, 2)
            n1 = np.where(left >= 1, np.minimum(np.minimum(b1 + (c != here), b2 + 1), n0 + 1), 2)
            n2 = np.where(left >= 2, np.minimum(b2 + (c != self.at(q, np.full(len(q), p + 1))), n1 + 1), 2)
            band = np.minimum(np.stack([n0, n1, n2]), 2).astype(np.int8)
            go = band.min(axis=0) <= 1
            q, l, r, band = q[go], l[go], r[go], band[:, go]
            p += 1
        if not out:
            return q, q
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def near_counts(part: pd.DataFrame) -> pd.DataFrame:
    """(word, near, best_n, best) per word and list with near words."""
    s = SortedLists(part)
    # The shorter length asks; a longer near word is told of it as well.
    asking = np.flatnonzero((s.size == s.m) & (s.end - s.first > 1))
    out = []
    for i in range(0, len(asking), QUERIES_AT_ONCE):
        a, b = s.near(asking[i:i + QUERIES_AT_ONCE])
        longer = s.size[b] > s.m[a]
        out.append((np.append(a, b[longer]), np.append(b, a[longer])))
    if not out:
        return pd.DataFrame({"word": [], "near": [], "best_n": [], "best": []})
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((b, -s.n[b], a))  # rows of a list are in code-point order
    a, b = a[order], b[order]
    head = np.flatnonzero(np.diff(a, prepend=-1))
    count = np.diff(np.append(head, len(a)))
    return pd.DataFrame({"word": s.words[a[head]], "near": count, "best_n": s.n[b[head]], "best": s.words[b[head]]})


def neighbours(words: DataFrame, least: int = LEAST, limit: int = LIST_LIMIT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words with near words; best is the most frequent, then the least."""
    rows = lists(words, least, limit)
    buckets = words.count() * 4 // bucket_rows + 1
    found = (rows.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets))).groupBy("bucket")
             .applyInPandas(lambda pdf: near_counts(pdf), "word string, near bigint, best_n bigint, best string"))
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word reached.  Counts grow along forms, so there are no cycles;
    each step doubles what was followed."""
    at = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(at.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                           F.col("further").isNotNull().alias("went")), "roots")
        at = step.select("word", "root")
        if step.where("went").isEmpty():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, ratio: int = RATIO,
             limit: int = LIST_LIMIT, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = saved(vocabulary(docs, id_col, text_col, least), "words")
    near = neighbours(words, least, limit, bucket_rows)
    clear = F.col("best_n") >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(clear, F.col("best")).alias("form"), F.when(clear, F.col("best_n")).alias("form_n"))
    rows = saved(rows, "forms")
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = f"""
WITH runs AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, count(*) AS n
              FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
              WHERE length(w) >= {LEAST} GROUP BY ALL),
crc AS (SELECT list(x ORDER BY i) AS t FROM (
          SELECT i, list_reduce(list_prepend(i::BIGINT, range(0, 8)),
                                lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS x
          FROM range(0, 256) AS r(i))),
hashed AS (SELECT w, n, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(range(0, octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i::INTEGER + 1, 2))::BIGINT)),
                   lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
           FROM runs, crc),
counted AS (SELECT CASE WHEN h % {MODULUS} = 0 THEN substr(w, 1, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word,
                   sum(n)::BIGINT AS n FROM hashed GROUP BY 1),
words AS (SELECT word, n, encode(word) AS b FROM counted WHERE n >= {TWICE} AND length(word) >= {LEAST}),
shorter AS (SELECT word, n, b, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT *, unnest(range(0, length(word)))::INTEGER AS i FROM words)),
pairs AS (SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS m, y.b AS b FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
          UNION SELECT x.word, x.n, y.word, y.n, y.b FROM words x JOIN shorter y ON x.word = y.rest
          UNION SELECT y.word, y.n, x.word, x.n, x.b FROM words x JOIN shorter y ON x.word = y.rest),
best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY m DESC, b) AS other, max(m) AS m FROM pairs GROUP BY word, n),
forms AS (SELECT word, other AS form, m AS form_n FROM best WHERE m >= {RATIO} * n),
chain AS (WITH RECURSIVE c AS (SELECT word, word AS reached, 0 AS d FROM words
          UNION ALL SELECT c.word, f.form, d + 1 FROM c JOIN forms f ON c.reached = f.word) SELECT word, arg_max(reached, d) AS root FROM c GROUP BY word)
SELECT w.word, f.form, c.root, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, f.form_n
FROM words w JOIN chain c USING (word) LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word
"""


@corpus_query("op11_spelling_variants", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
