"""Benchmark decontamination by latent semantic retrieval.

Texts are lower-cased words (runs of letters and digits) in blocks of ``BLOCK``;
a passage is two neighbouring blocks, so any ``BLOCK`` words lie whole in some passage.

1. Document frequencies of the hashed words (``FEATURES`` buckets) over all blocks give the
   inverse document frequencies.
2. Randomised SVD of the TF-IDF matrix A of all disjoint passages in one pass (Nystroem):
   every task adds its share of A'(A G) for one random G, a shuffle sums the shares by
   feature, and the driver gets FEATURES x ``SKETCH`` numbers, whatever the corpus holds.
3. Every passage is folded in (projected, each direction over its singular value); benchmark
   passages within cosine ``COSINE`` are its candidates, if the words they share can cover
   ``COVER`` of the benchmark passage at all (by inverse document frequency).
   Retrieval in ``RANK`` dimensions misses some short or rewritten items, so candidates also
   come from the words themselves, without a cosine: an item's commonest words hold less than
   what step 4 asks for, so a passage it accepts has some of the others, the item's anchors, in
   its surroundings.  Every passage with enough of them is a candidate, so no passage that
   step 4 accepts without a cosine is lost.
4. A candidate counts if the item's words are covered in its surroundings and the
   longest common subsequence of item and surroundings, in words, is at least ``STRICT`` of the
   item; between ``LOOSE`` and that, the item's answer must be there too: what follows
   "answer" in the item, else its last words.  A paraphrase keeps less of the order.  Around a
   passage within cosine ``NEAR`` of one of the item's passages, ``REWRITTEN`` of the item in order is enough,
   if the answer is there or ``SPREAD`` of the words' weight, in whatever order.  Items of fewer
   than ``BLOCK`` words have too few words for their vector to tell, and keep the first rule.

Benchmark items are handled about ``ITEMS`` or ``ITEM_BYTES`` of text at a time, whichever is less, so what
the driver and the tasks carry grows with one batch (at least one whole item), not with the benchmark.

Defined cases: null and wordless texts are clean, null and wordless items match nothing; rows
repeating an id are judged each; an empty benchmark leaves everything clean; an empty table
gives an empty result; of items tying in a document's best share, the least id is named;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsanalytics.llm import textvec as tv
from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import column, saved, table, text_of

BLOCK, FEATURES, RANK, SKETCH = 16, 1 << 13, 64, 72
COSINE, COVER, LOOSE, STRICT = 0.45, 0.5, 0.6, 0.8
NEAR, REWRITTEN, SPREAD = 0.5, 0.4, 0.7
ANSWER_WORDS = 5
ITEMS, ITEM_BYTES = 2000, 4 << 20
PASSAGES = 8192  # of a batch compared at once
SLICE = 1 << 18


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, woff = tv.words(data, off, tv.NOT_ALNUM)
    return tv.word_hashes(data, starts, ends), woff


def blocks(woff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word offsets of all blocks, and block offsets of the texts; a text's last block may be short."""
    n = -(-np.diff(woff) // BLOCK)
    boff = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(n)), n)
    start = woff[:-1][text] + (np.arange(boff[-1]) - boff[:-1][text]) * BLOCK
    return np.append(start, woff[-1]), boff


def features(units: np.ndarray) -> np.ndarray:
    return (units & tv.U(FEATURES - 1)).astype(np.int64)


def weighted_sums(values: np.ndarray, rows: np.ndarray, head: np.ndarray, matrix: np.ndarray, width: int) -> np.ndarray:
    """Per segment (starting at ``head``) the sum of values * matrix[rows], as small products of ``width`` terms."""
    count = np.diff(np.append(head, len(values)))
    lines = -(-count // width)
    first = np.cumsum(lines) - lines
    within = np.arange(len(values)) - np.repeat(head, count)
    slot = np.repeat(first, count) * width + within
    v, r = np.zeros(lines.sum() * width, np.float32), np.zeros(lines.sum() * width, np.int64)
    v[slot], r[slot] = values, rows
    parts = np.einsum("lw,lws->ls", v.reshape(-1, width), matrix[r.reshape(-1, width)])
    return np.add.reduceat(parts, first) if len(first) < len(parts) else parts


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, total = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, _, data, off in tv.slices(tv.folded(batch.column("text")), SLICE):
            units, woff = tokens(data, off)
            start, _ = blocks(woff)
            block = np.repeat(np.arange(len(start) - 1), np.diff(start))
            cell = tv.distinct(block * FEATURES + features(units))
            df += np.bincount(cell % FEATURES, minlength=FEATURES)
            total += len(start) - 1
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(FEATURES), -1)), pa.array(np.append(df, total))], names=["f", "n"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    got = docs.mapInArrow(_frequencies, "f bigint, n bigint").groupBy("f").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(FEATURES + 1)
    n[got.column("f").to_numpy()] = got.column("n").to_numpy()
    return np.log((n[-1] + 1) / (n[:-1] + 1)).clip(0).astype(np.float32)


def _sketch(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = np.random.default_rng(5).standard_normal((FEATURES, SKETCH)).astype(np.float32)
        total = np.zeros((FEATURES, SKETCH))
        for batch in batches:
            for _, _, data, off in tv.slices(tv.folded(batch.column("text")), SLICE):
                units, woff = tokens(data, off)
                if not len(units):
                    continue
                start, boff = blocks(woff)
                odd = (np.arange(boff[-1]) - np.repeat(boff[:-1], np.diff(boff))) % 2 == 1
                passage = np.cumsum(~odd) - 1  # a block of odd rank joins the one before it
                p = np.repeat(passage, np.diff(start))
                cell, tf = np.unique(p * FEATURES + features(units), return_counts=True)
                p, f = cell // FEATURES, cell % FEATURES
                value = tf.astype(np.float32) * idf[f]
                head = np.flatnonzero(np.diff(p, prepend=-1))
                value /= np.sqrt(np.add.reduceat(value * value, head) + 1e-9)[p]
                y = weighted_sums(value, f, head, test, 2 * BLOCK)
                by = np.argsort(f, kind="stable")
                f, value, p = f[by], value[by], p[by]
                head = np.flatnonzero(np.diff(f, prepend=-1))
                total[f[head]] += weighted_sums(value, p, head, y, 8)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES)), *(pa.array(total[:, k]) for k in range(SKETCH))],
                                         names=["f", *(f"s{k}" for k in range(SKETCH))])
    return run


def latent_basis(docs: DataFrame, idf: np.ndarray) -> np.ndarray:
    """FEATURES x RANK: right singular vectors of the passages' TF-IDF matrix over their singular values."""
    names = [f"s{k}" for k in range(SKETCH)]
    parts = docs.mapInArrow(_sketch(idf), "f bigint, " + ", ".join(f"{n} double" for n in names))
    got = parts.groupBy("f").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    y = np.zeros((FEATURES, SKETCH))
    y[got.column("f").to_numpy()] = np.column_stack([got.column(n).to_numpy() for n in names])
    test = np.random.default_rng(5).standard_normal((FEATURES, SKETCH)).astype(np.float32).astype(float)
    core = test.T @ y
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > value.max(initial=0) * 1e-10
    if not good.any():
        return np.zeros((FEATURES, RANK), np.float32)
    u, size, _ = np.linalg.svd(y @ (vector[:, good] / np.sqrt(value[good])), full_matrices=False)
    rank = min(RANK, int((size > size[0] * 1e-6).sum()))
    basis = np.zeros((FEATURES, RANK), np.float32)
    basis[:, :rank] = u[:, :rank] / size[:rank] * size[0]
    return basis


@dataclass
class Item:
    item_id: int
    words: list[int]
    answer: list[int]
    weight: dict[int, float]  # of each distinct word


@dataclass
class Bench:
    items: list[Item]
    vectors: np.ndarray  # of all passages of all items
    owner: np.ndarray
    cover_at: np.ndarray  # passage * (FEATURES + 1) + feature, sorted, for the features it has
    cover: np.ndarray  # of each, its share of the passage's weight
    cover_marks: np.ndarray
    anchors: Anchors


@dataclass
class Anchors:
    words: np.ndarray  # distinct anchor words of all items, sorted
    marks: np.ndarray
    first: np.ndarray  # of each, its first posting
    owner: np.ndarray  # per posting
    weight: np.ndarray
    length: np.ndarray  # per item: words, and the weight and number of anchors needed around a passage
    least: np.ndarray
    count: np.ndarray


_ANSWER = tv.word_hashes(np.frombuffer(b"answer", np.uint8), np.array([0]), np.array([6]))[0]


def marks_of(keys: np.ndarray) -> np.ndarray:
    """A table of 8 to 16 places a key, marked at the keys: most other keys are told apart without a search."""
    table = np.zeros(max(64, 1 << (8 * len(keys)).bit_length()), bool)
    table[_place(table, keys)] = True
    return table


def _place(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (keys.view(tv.U) * tv.U(tv.ODD[0])) >> tv.U(65 - len(table).bit_length())


def project(units: np.ndarray, start: np.ndarray, boff: np.ndarray, mapped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit latent vectors of all passages, and the block each starts with; a text of one block has one passage."""
    if len(start) > 1:
        total = weighted_sums(np.ones(len(units), np.float32), features(units), start[:-1], mapped, BLOCK)
    else:
        total = np.zeros((0, RANK), np.float32)
    last = np.zeros(len(total), bool)
    last[boff[1:][np.diff(boff) > 0] - 1] = True
    single = np.zeros(len(total), bool)
    single[boff[:-1][np.diff(boff) == 1]] = True
    pair = total.copy()
    pair[:-1][~last[:-1]] += total[1:][~last[:-1]]
    at = np.flatnonzero(~last | single)
    v = pair[at]
    return v / np.sqrt((v * v).sum(1, keepdims=True) + 1e-12), at


def bench_of(rows: list, idf: np.ndarray, mapped: np.ndarray) -> Bench:
    items, vectors, owner, cover, cover_at, passages = [], [], [], [], [], 0
    for r in rows:
        raw = (r["text"] or "").lower().encode()
        units, woff = tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if not len(units):
            continue
        marks = np.flatnonzero(units == _ANSWER)
        answer = units[marks[-1] + 1:] if len(marks) and marks[-1] + 1 < len(units) else units[-ANSWER_WORDS:]
        start, boff = blocks(woff)
        v, at = project(units, start, boff, mapped)
        for f in passage_features(units, start, boff, at):
            f = np.unique(f[f < FEATURES])
            cover.append((idf[f] + 1e-3) / (idf[f] + 1e-3).sum())
            cover_at.append(passages * (FEATURES + 1) + f)
            passages += 1
        owner += [len(items)] * len(v)
        vectors.append(v)
        weight = dict(zip(units.tolist(), (idf[features(units)] + 1e-3).tolist(), strict=True))
        items.append(Item(r["item_id"], units.tolist(), answer.tolist(), weight))
    cover_at = np.concatenate([np.zeros(0, np.int64), *cover_at])
    return Bench(items, np.concatenate([np.zeros((0, RANK), np.float32), *vectors]), np.array(owner, np.int64),
                 cover_at, np.concatenate([np.zeros(0, np.float32), *cover]), marks_of(cover_at), anchors_of(items))


def covered(bench: Bench, q: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Per benchmark passage ``q``: the share of its weight that the features ``found`` (a row each) have."""
    key = (q[:, None] * (FEATURES + 1) + found).ravel()
    i = np.flatnonzero(bench.cover_marks[_place(bench.cover_marks, key)])
    at = np.minimum(np.searchsorted(bench.cover_at, key[i]), len(bench.cover_at) - 1)
    has = bench.cover_at[at] == key[i]
    return np.bincount(i[has] // found.shape[1], bench.cover[at[has]], len(q))


def latent_pairs(v: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, benchmark passage, cosine) within the cosine, ``PASSAGES`` of the benchmark at a time."""
    found = []
    for k in range(0, len(vectors), PASSAGES):
        cosine = v @ vectors[k:k + PASSAGES].T
        p, q = np.nonzero(cosine >= COSINE)
        found.append((p, q + k, cosine[p, q]))
    p, q, cosine = zip(*found, strict=True)
    return np.concatenate(p), np.concatenate(q), np.concatenate(cosine)


def anchors_of(items: list[Item]) -> Anchors:
    """Each item's rarer words: the commonest ones, with up to half of what ``share`` asks for in weight and number, are left out."""
    words, owner, weight, needs = [], [], [], []
    for k, item in enumerate(items):
        w = np.array(list(item.weight.values()))
        n = np.unique(np.array(item.words, tv.U), return_counts=True)
        n = dict(zip(n[0].tolist(), n[1].tolist(), strict=True))
        n = np.array([n[x] for x in item.weight])
        by = np.argsort(w, kind="stable")  # the commonest first
        wsum, nsum = np.cumsum(w[by]), np.cumsum(n[by])
        cut = int(np.argmax((wsum > COVER / 2 * wsum[-1]) | (nsum > LOOSE / 2 * nsum[-1])))
        rest_w, rest_n = (wsum[cut - 1], nsum[cut - 1]) if cut else (0, 0)
        words.append(np.array(list(item.weight), tv.U)[by[cut:]])
        weight.append(w[by[cut:]])
        owner.append(np.full(len(by) - cut, k))
        needs.append((nsum[-1], (COVER * wsum[-1] - rest_w) * (1 - 1e-6), LOOSE * nsum[-1] - rest_n - 1e-6))
    if not items:
        none = np.zeros(0)
        return Anchors(none.astype(tv.U), marks_of(none.astype(tv.U)), np.zeros(1, np.int64), none.astype(np.int64), none, none.astype(np.int64), none, none)
    word, owner, weight = np.concatenate(words), np.concatenate(owner), np.concatenate(weight)
    by = np.argsort(word, kind="stable")
    distinct, first = np.unique(word[by], return_index=True)
    length, least, count = np.array(needs).T
    return Anchors(distinct, marks_of(distinct), np.append(first, len(word)), owner[by], weight[by], length.astype(np.int64), least, count)


def anchored(a: Anchors, units: np.ndarray, woff: np.ndarray, start: np.ndarray, boff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first block, item) of all passages with enough of the item's anchors around them, each once."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(a.words):
        return none
    place = np.flatnonzero(a.marks[_place(a.marks, units)])
    w = np.minimum(np.searchsorted(a.words, units[place]), len(a.words) - 1)
    there = a.words[w] == units[place]
    place, w = place[there], w[there]
    n = a.first[w + 1] - a.first[w]
    posting = np.repeat(a.first[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    p, o = np.repeat(place, n), a.owner[posting]
    by = np.argsort(o, kind="stable")
    p, o = p[by], o[by]
    upto = np.concatenate([[0], np.cumsum(a.weight[posting[by]])])
    key = o * (len(units) + 1) + p

    def enough(i: np.ndarray, end: np.ndarray) -> np.ndarray:
        last = np.searchsorted(key, o[i] * (len(units) + 1) + end)
        return (upto[last] - upto[i] >= a.least[o[i]]) & (last - i >= a.count[o[i]])

    # Surroundings that hold enough hold it from their first anchor on.
    text = np.searchsorted(woff, p, "right") - 1
    i = np.arange(len(p))
    i = i[enough(i, np.minimum(p + 2 * BLOCK + 2 * a.length[o], woff[text + 1]))]
    if not len(i):
        return none
    t, size = text[i], a.length[o[i]]
    before = np.where((i > 0) & (o[i - 1] == o[i]) & (text[i - 1] == t), p[i - 1] + size, -1)
    low = np.maximum(np.maximum(before, p[i] - 2 * BLOCK - size) - woff[t], -1) // BLOCK + 1  # starts after these
    high = np.minimum((p[i] + size - woff[t]) // BLOCK, np.maximum(boff[t + 1] - boff[t] - 2, 0))
    n = np.maximum(high - low + 1, 0)
    b = np.repeat(boff[t] + low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    i, t, size = np.repeat(i, n), np.repeat(t, n), np.repeat(size, n)
    good = enough(i, np.minimum(start[b] + 2 * BLOCK + size, woff[t + 1]))
    return b[good], o[i[good]]


def passage_features(units: np.ndarray, start: np.ndarray, boff: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Features of the passages that start with blocks ``at``, one row each, filled up with ``FEATURES``."""
    text = np.searchsorted(boff, at, "right") - 1
    end = start[np.minimum(at + 2, boff[text + 1])]
    place = start[at][:, None] + np.arange(2 * BLOCK)
    return np.where(place < end[:, None], features(units)[np.minimum(place, len(units) - 1)], FEATURES)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit per element of ``a``."""
    place: dict[int, int] = {}
    for k, x in enumerate(a):
        place[x] = place.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & place.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def share(item: Item, around: list[int], near: bool = False) -> float:
    """Share of the item found in order in ``around``; 0 if it does not count as a leak.

    Around a passage whose latent vector is ``near`` the item's, less order is asked for: ``REWRITTEN`` of the
    item, and besides ``SPREAD`` of its words' weight, in any order, or its answer."""
    near = near and len(item.words) >= BLOCK
    there = set(around)
    cover = sum(w for x, w in item.weight.items() if x in there) / sum(item.weight.values())
    if cover < COVER:
        return 0.0
    part = common_subsequence(item.words, around) / len(item.words)
    if part >= STRICT or (near and part >= REWRITTEN and cover >= SPREAD):
        return part
    if part >= (REWRITTEN if near else LOOSE) and common_subsequence(item.answer, around) >= STRICT * len(item.answer):
        return part
    return 0.0


def _search(mapped: np.ndarray, bench: Bench):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks: list[list[tuple[int, float]]] = [[] for _ in range(batch.num_rows)]
            for i, _, data, off in tv.slices(tv.folded(batch.column("text")), SLICE):
                units, woff = tokens(data, off)
                if not len(units) or not len(bench.owner):
                    continue
                start, boff = blocks(woff)
                v, at = project(units, start, boff, mapped)
                p, q, cosine = latent_pairs(v, bench.vectors)
                # A word counts once per occurrence here, so this is never less than the true cover.
                most = covered(bench, q, passage_features(units, start, boff, at[p]))
                p, q, cosine = p[most >= COVER], q[most >= COVER], cosine[most >= COVER]
                first, item = anchored(bench.anchors, units, woff, start, boff)
                block, owner = np.append(at[p], first), np.append(bench.owner[q], item)
                close = set(zip(at[p][cosine >= NEAR].tolist(), bench.owner[q][cosine >= NEAR].tolist(), strict=True))
                text = np.searchsorted(boff, block, "right") - 1
                found: dict[tuple[int, int], float] = {}
                for b, t, o in sorted(set(zip(block.tolist(), text.tolist(), owner.tolist(), strict=True))):
                    item = bench.items[o]
                    margin = len(item.words)
                    lo, hi = max(woff[t], start[b] - margin), min(woff[t + 1], start[b] + 2 * BLOCK + margin)
                    part = share(item, units[lo:hi].tolist(), (b, o) in close)
                    if part > found.get((t, o), 0.0):
                        found[t, o] = part
                for (t, o), part in found.items():
                    leaks[i + t].append((bench.items[o].item_id, part))
            rest = [c for c in batch.schema.names if c != "text"]
            struct = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array([[{"item_id": a, "share": s} for a, s in sorted(x)] for x in leaks], struct)],
                names=[*rest, "leaks"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  items_at_once: int = ITEMS, bytes_at_once: int = ITEM_BYTES) -> DataFrame:
    """One row per document: its id (any column, also a struct), contaminated, leaks (item_id, share) in order of item_id."""
    src = docs.select(column(id_col).alias("id"), text_of(text_col).alias("text"))
    bench = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    n, size = bench.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if not n:
        none = F.array().cast("array<struct<item_id:bigint,share:double>>")
        return src.select(F.col("id").alias(id_col), F.lit(False).alias("contaminated"), none.alias("leaks"))
    idf = inverse_frequencies(src.select("text"))
    mapped = np.ascontiguousarray(latent_basis(src.select("text"), idf) * idf[:, None])
    parts = max(-(-n // items_at_once), -(-size // bytes_at_once))
    schema = T.StructType([src.schema["id"], *T.StructType.fromDDL("leaks array<struct<item_id:bigint,share:double>>").fields])
    found = []
    for k in range(parts):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()  # about one batch
        out = src.mapInArrow(_search(mapped, bench_of(rows, idf, mapped)), schema)
        if parts > 1:  # stored at once, so the driver lets go of the batch; the same scan each time, so row numbers agree
            out = out.withColumn("rid", F.monotonically_increasing_id()).where(F.size("leaks") > 0)
            found.append(saved(out.select("rid", "leaks"), "leaks"))
    if found:
        leaks = reduce(DataFrame.unionByName, found).groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
        every = src.select("id").withColumn("rid", F.monotonically_increasing_id())
        out = every.join(leaks, "rid", "left").select("id", F.coalesce("leaks", F.array().cast(leaks.schema["leaks"].dataType)).alias("leaks"))
    return out.select(F.col("id").alias(id_col), (F.size("leaks") > 0).alias("contaminated"), "leaks")


@corpus_query("op5_latent_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return done.select("doc_id", "contaminated", "leaks")
