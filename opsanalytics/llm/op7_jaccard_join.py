"""Similarity join on word n-grams: MinHash banding, then exact Jaccard on the full sets.

Words are runs of letters and digits in lower case (all bytes beyond ASCII count as letters),
shingles are ``N`` consecutive words; a text of one to ``N - 1`` words is one
shingle.  Two documents are linked when their shingle sets have a Jaccard similarity of
``threshold`` or more.

1. Documents with equal shingle sets form a class; one representative goes on.
2. Bands: ``choose_bands`` takes the fewest hashes with which a pair at the threshold
   collides in some band with probability ``recall``, while a pair at half of it rarely does.
   A shuffle on band hashes connects every member of a band bucket with the bucket's
   least member (one edge each, never all pairs).
3. Small groups of connected candidates share tasks and are verified whole, so pairs that missed
   every band by chance are still seen.  Large groups are cut into blocks of at most ``BLOCK``
   documents or ``BLOCK_BYTES`` of text, in the order of the least hub of a document's buckets, which
   keeps documents of the same buckets side by side.  Two blocks meet in a task only if
   a band bucket has documents of both, so a chain of boilerplate costs its neighbours, and only
   what really shares a hot bucket is compared all with all.  A task computes the intersection
   sizes as matrix products and emits one row per document.
4. Verified links give the number of links (counting copies) and the connected groups.

Defined cases: a null or wordless text has no shingle and no link, not even with another
one; rows repeating id and text are copies of each other; a null id never names a group
that has another member; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm import textvec as tv
from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.components import components
from opsanalytics.llm.store import row_key, saved, table, text_of
from opsanalytics.operators.ordering import with_ranks

N, THRESHOLD, RECALL = 5, 0.8, 0.9995
BLOCK, BLOCK_BYTES = 1500, 2 << 20
COLUMNS = 4096


def choose_bands(threshold: float, recall: float, noise: float = 0.1) -> tuple[int, int]:
    """(bands, rows): fewest hashes with collision probability of at least ``recall`` at the
    threshold and of at most ``noise`` at half of it; without the second if none has both."""
    options = []
    for rows in range(1, 13):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows))) if threshold < 1 else 1
        quiet = 1 - (1 - (threshold / 2) ** rows) ** bands <= noise
        options.append((not quiet, bands * rows, bands, rows))
    return min(options)[2:]


def shingles(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each lower-cased text, distinct and sorted, and their offsets."""
    starts, ends, woff = tv.words(data, off, tv.NOT_ALNUM)
    units = tv.word_hashes(data, starts, ends)
    spans = tv.Spans(units)
    grams = spans.grams(n)
    sets = []
    for lo, hi in zip(woff[:-1].tolist(), woff[1:].tolist(), strict=True):
        if hi - lo >= n:
            sets.append(tv.distinct(grams[lo:hi - n + 1]))
        elif hi > lo:
            sets.append(spans(np.array([lo]), np.array([hi])))
        else:
            sets.append(np.zeros(0, tv.U))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


SIGNATURE = "doc_id bigint, key bigint, bytes bigint, n bigint, c1 bigint, c2 bigint, bands array<bigint>"


def signatures(n: int, bands: int, rows: int):
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * tv.U(2) + tv.U(1)
    shifts = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, off in tv.slices(tv.folded(batch.column("text"))):
                sets, soff = shingles(data, off, n)
                count = np.diff(soff)
                full = np.flatnonzero(count)
                at = soff[:-1][full]
                c1, c2 = np.zeros(j - i, tv.U), np.zeros(j - i, tv.U)
                band = np.zeros((len(full), bands), tv.U)
                if len(full):
                    c1[full] = np.add.reduceat(tv.mix(sets), at)
                    c2[full] = np.add.reduceat(tv.mix(sets ^ tv.U(tv.ODD[1])), at)
                    for k in range(bands * rows):
                        least = np.minimum.reduceat(sets * factors[k] + shifts[k], at)
                        b = k // rows
                        band[:, b] = tv.mix(band[:, b] * tv.U(tv.ODD[0]) + least + tv.U(b + 1))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(count > 0, bands, 0))]).astype(np.int32)),
                    pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), batch.column("key").slice(i, j - i),
                    pa.array(np.diff(off)), pa.array(count.astype(np.int64)), pa.array(c1.view(np.int64)),
                    pa.array(c2.view(np.int64)), lists], names=["doc_id", "key", "bytes", "n", "c1", "c2", "bands"])
    return run


def links_between(sets: np.ndarray, soff: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (left x right) of sets reach the threshold; intersections as matrix products in column blocks."""
    members = np.concatenate([left, right]) if left is not right else left
    rows = np.concatenate([np.full(soff[m + 1] - soff[m], k) for k, m in enumerate(members)])
    values = np.concatenate([sets[soff[m]:soff[m + 1]] for m in members])
    _, column, df = np.unique(values, return_inverse=True, return_counts=True)
    shared = df[column] > 1  # what one set alone holds counts in its size only
    rows, column = rows[shared], np.unique(column[shared], return_inverse=True)[1]
    inter = np.zeros((len(left), len(right)), np.float32)
    by = np.argsort(column, kind="stable")
    rows, column = rows[by], column[by]
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        x = np.zeros((len(members), min(COLUMNS, width - lo)), np.float32)
        x[rows[a:b], column[a:b] - lo] = 1
        inter += x[:len(left)] @ (x.T if left is right else x[len(left):].T)
    size = np.diff(soff).astype(np.float64)
    union = size[left][:, None] + size[right][None, :] - inter
    return inter >= threshold * union - 1e-9


def verify(n: int, threshold: float):
    """Per candidate group, or pair of blocks of one: links of each document, and the least document it is connected with."""
    def run(t: pa.Table) -> pa.Table:
        by_rid = np.unique(t.column("rid").to_numpy(), return_index=True)[1]
        t = t.take(pa.array(by_rid)).combine_chunks()
        comp, rid, weight, block = (t.column(c).to_numpy() for c in ("component", "rid", "weight", "block"))
        cross = t.column("cross").to_numpy(zero_copy_only=False)
        parts = [shingles(data, off, n) for _, _, data, off in tv.slices(tv.folded(t.column("text").chunk(0)), 1 << 40)]
        sets, soff = parts[0]
        linked, root = np.zeros(len(rid), np.int64), rid.copy()
        order = np.argsort(comp, kind="stable")
        for idx in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            first, last = block[idx].min(), block[idx].max()
            if cross[idx[0]] and first == last:  # the pair's other block is empty
                continue
            left, right = idx[block[idx] == first], idx[block[idx] == last]
            if first == last:
                right = left
            ok = links_between(sets, soff, left, right, threshold)
            if first == last:
                np.fill_diagonal(ok, False)
            linked[left] += ok @ weight[right]
            if first != last:
                linked[right] += ok.T @ weight[left]
            while True:  # least connected document, through links on either side
                before = root[idx].copy()
                big = np.iinfo(np.int64).max
                root[left] = np.minimum(root[left], np.where(ok, root[right][None, :], big).min(1, initial=big))
                root[right] = np.minimum(root[right], np.where(ok, root[left][:, None], big).min(0, initial=big))
                if (before == root[idx]).all():
                    break
        return pa.table({"rid": rid, "linked": linked, "root": root, "blocks": t.column("blocks")})
    return run


def meeting_blocks(large: DataFrame, shared: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the documents (component, rid, cost) of large groups, and which blocks meet.

    ``shared`` has the buckets (rid, h, hub) of all documents.  Returns (component, rid, block) and
    (component, block, other): a block meets itself and every block that shares a bucket with it, in
    both directions.  Documents follow each other by the least hub of their buckets; a block is full at ``block_bytes``
    of summed cost, so only its last document may pass it."""
    wide = saved(shared.join(large, "rid").select("component", "rid", "cost", "h", "hub"), "wide")
    spots = wide.groupBy("component", "rid", "cost").agg(F.min("hub").alias("spot"))
    ranked = with_ranks(spots, ["spot", "rid"], by=["component"], sums={"before": "cost"})
    spread = saved(ranked.select("component", "rid", F.expr(f"int(before div {block_bytes})").alias("block")), "spread")
    seen = saved(wide.select("rid", "h").join(spread, "rid").select("component", "h", "block").distinct(), "seen")
    pairs = seen.join(seen.withColumnRenamed("block", "other"), ["component", "h"]).select("component", "block", "other").distinct()
    return spread, saved(pairs, "pairs")


def linked_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD,
                recall: float = RECALL, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, key (``row_key``), rid (its number), root (a rid that names its connected group), n_links."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"),
                      row_key(id_col, text_col).alias("key"))
    bands, rows = choose_bands(threshold, recall)
    sig = saved(src.mapInArrow(signatures(n, bands, rows), SIGNATURE).withColumn("rid", F.monotonically_increasing_id()), "signatures")
    classes = saved(sig.where("n > 0").groupBy("c1", "c2").agg(F.min("rid").alias("rep"), F.count("*").alias("size")), "classes")
    reps = saved(sig.join(classes.select("rep", "size"), sig.rid == F.col("rep"))
                 .select("rid", "doc_id", "key", "bytes", "size", "bands"), "reps")

    banded = reps.select("rid", F.explode("bands").alias("h"))
    hubs = saved(banded.groupBy("h").agg(F.min("rid").alias("hub"), F.count("*").alias("c")).where("c > 1").select("h", "hub"), "hubs")
    shared = banded.join(hubs, "h")
    found = components(shared.where("rid != hub").select(F.col("rid").alias("u"), F.col("hub").alias("v")))

    # A document's part of a block that holds up to ``block`` documents and ``block_bytes`` of text.
    cost = F.greatest("bytes", F.lit(-(-block_bytes // block)).cast("bigint")).alias("cost")
    members = saved(found.join(reps.drop("bands"), found.node == reps.rid)
                    .select("rid", "doc_id", "key", cost, "size", "component"), "members")
    plan = saved(members.groupBy("component").agg(F.sum("cost").alias("total")).select(
        "component", "total", F.ceil(F.col("total") / block_bytes).cast("int").alias("blocks")), "plan")
    tasks = int((plan.agg(F.sum("total")).first()[0] or 0) // block_bytes) + 1
    members = members.join(plan.drop("total"), "component")
    # A group of one block shares a task with others; each pair of meeting blocks of a larger one has its own.
    small = members.where("blocks = 1").withColumns({"block": F.lit(0), "cross": F.lit(False), "task": F.struct(
        F.lit(-1).cast("bigint").alias("c"), F.pmod(F.xxhash64("component"), F.lit(tasks)).cast("int").alias("a"), F.lit(0).alias("b"))})
    spread, pairs = meeting_blocks(members.where("blocks > 1").select("component", "rid", "cost"), shared, block_bytes)
    large = (members.where("blocks > 1").join(spread.select("rid", "block"), "rid").join(pairs, ["component", "block"])
             .withColumns({"cross": F.col("block") != F.col("other"), "task": F.struct(
                 F.col("component").alias("c"), F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))}))
    placed = small.unionByName(large.drop("other")).withColumnRenamed("size", "weight").drop("cost")
    with_text = (src.join(placed, [src.doc_id.eqNullSafe(placed.doc_id), src.key == placed.key])
                 .select("task", "rid", "component", "weight", "block", "blocks", "cross", "text"))
    checked = saved(with_text.groupBy("task").applyInArrow(
        _dropping("task", verify(n, threshold)), "rid bigint, linked bigint, root bigint, blocks int"), "verified")

    linked = checked.groupBy("rid").agg(F.sum("linked").alias("linked"), F.min("root").alias("root"), F.max("blocks").alias("blocks"))
    joined = components(checked.where("blocks > 1 and rid != root").select(F.col("rid").alias("u"), F.col("root").alias("v")))
    linked = linked.join(joined, linked.rid == joined.node, "left").select(
        linked.rid.alias("rep"), "linked", F.when(F.col("blocks") > 1, F.coalesce("component", "rid")).otherwise(F.col("root")).alias("root"))
    by_class = classes.join(linked, "rep", "left").select(
        "c1", "c2", "rep", F.coalesce("root", "rep").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    by_class = saved(by_class, "by-class")
    rows_ = sig.select("doc_id", "key", "rid", "n", "c1", "c2").join(by_class, ["c1", "c2"], "left")
    rows_ = rows_.select("doc_id", "key", "rid", F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("rid")).alias("root"),
                         F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).alias("n_links"))
    return saved(rows_, "links")


def jaccard_join(docs: DataFrame, *args, **options) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its connected group), n_links (documents linked to it).

    Takes the arguments of ``linked_rows``."""
    rows_ = linked_rows(docs, *args, **options)
    names = saved(rows_.groupBy("root").agg(F.min("doc_id").alias("class_id")), "names")
    return rows_.join(names, "root").select("doc_id", "class_id", F.col("n_links").cast("bigint").alias("n_links"))


def heads(rows: DataFrame) -> DataFrame:
    """Of ``linked_rows``, by (doc_id, key): all rows, and the heads among them.  One row heads each group:
    the least id, null last, then the least key; rows repeating id and text are alike, so any one of them."""
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    best = rows.groupBy("root").agg(F.min(order).alias("best")).groupBy("best.doc_id", "best.key").agg(F.count("*").alias("heads"))
    every = rows.groupBy("doc_id", "key").agg(F.count("*").alias("rows")).select(F.col("doc_id").alias("i"), F.col("key").alias("k"), "rows")
    return best.join(every, [F.col("i").eqNullSafe(best.doc_id), F.col("k") == best.key]).select("doc_id", "key", "heads", "rows")


def _dropping(column: str, run):
    def inner(t: pa.Table) -> pa.Table:
        return run(t.drop_columns([column]))
    return inner


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT r, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n x ON x.r = p.a JOIN n y ON y.r = p.b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
near AS (SELECT r AS a, r AS b FROM d UNION SELECT near.a, l.b FROM near JOIN l ON l.a = near.b)
SELECT d.doc_id,
       (SELECT min(o.doc_id) FROM near JOIN d o ON o.r = near.b WHERE near.a = d.r) AS class_id,
       (SELECT count(*) FROM l WHERE l.a = d.r) AS n_links
FROM d
"""


@corpus_query("op7_jaccard_join", SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
