"""Windows of fixed length that start at two or more places of a corpus.

A window is ``window`` consecutive units (bytes or words) of one document.  Sending
every window is far too much, so windows travel in *super-windows*: consecutive
windows whose least gram (``gram`` units, by hash, the rightmost of ties) is the same
occurrence.  Equal windows have equal least grams, so all places of a window meet
under one anchor hash.

1. Per document, super-windows with anchor hash and a 128-bit hash of their content.
2. Super-windows whose anchor occurs once hold no repeated window and go.
3. Super-windows with equal content collapse into one with its number of copies; two
   copies or more are repeated throughout, and stay in their group as one reference.
4. Groups (anchors) with several contents are resolved from the text itself by the
   operator's own index, many groups per task and at most ``GROUP_LIMIT`` contents per
   group.  Larger groups (a passage in a third of all documents, each time between
   other neighbours) are split by the operator's ``widths``: that many windows, at fixed places
   relative to the anchor, form a cell, named by the hash of what all its windows
   have in common: the first ``window - width + 1`` units of the cell's last window.  Equal windows
   share their cell, contents collapse again, and what is still too large goes down the
   widths to cells of one window, where equal names are equal windows.
5. Marked windows go back to the documents by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsanalytics.llm import textvec as tv
from opsanalytics.llm.store import row_key, saved, text_of

GROUP_LIMIT = 1000
BUCKET_BYTES = 1 << 20

OCCURRENCES = ("doc_id bigint, key bigint, lo int, n int, byte_lo int, byte_n int, "
               "anchor bigint, h1 bigint, h2 bigint")


@dataclass(frozen=True)
class Units:
    """What a window is made of: ``cut`` gives unit hashes, unit offsets of the texts, and unit starts and ends in bytes.
    ``widths`` are the cells of oversize groups, in windows; the last is 1."""

    window: int
    gram: int
    cut: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]]
    widths: tuple[int, ...]


def byte_units(data: np.ndarray, off: np.ndarray):
    return data, off, None, None


def word_units(data: np.ndarray, off: np.ndarray):
    starts, ends, woff = tv.words(data, off, tv.SPACES)
    return tv.word_hashes(data, starts, ends), woff, starts, ends


def super_windows(units: np.ndarray, off: np.ndarray, window: int, gram: int):
    """(first window, last window, anchor hash, h1, h2, anchor place) of every super-window; positions in units."""
    n = len(units)
    if n < window:
        return None
    first, second = tv.Spans(units), tv.Spans(units, 1)
    grams = first.grams(gram)
    place = np.arange(len(grams), dtype=np.uint64)
    keyed = (grams & tv.U(0xFFFFFFFF00000000)) | (tv.U(0xFFFFFFFF) - place)
    least = tv.sliding_min(keyed, window - gram + 1)
    anchor = (tv.U(0xFFFFFFFF) - (least & tv.U(0xFFFFFFFF))).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    lengths = np.diff(off)
    whole = lengths >= window
    np.add.at(valid, off[:-1][whole], 1)
    np.add.at(valid, off[1:][whole] - window + 1, -1)
    valid = np.cumsum(valid[:len(anchor)]) > 0
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    lo = np.flatnonzero(valid & new)
    if not len(lo):
        return None
    stop = np.ones(len(anchor), bool)
    stop[:-1] = new[1:] | ~valid[1:]
    hi = np.flatnonzero(valid & stop)
    return lo, hi, grams[anchor[lo]], first(lo, hi + window), second(lo, hi + window), anchor[lo]


def occurrences(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key").to_numpy(zero_copy_only=False)
            for i, j, data, off in tv.slices(batch.column("text")):
                u, uoff, starts, ends = units.cut(data, off)
                found = super_windows(u, uoff, units.window, units.gram)
                if found is None:
                    continue
                lo, hi, anchor, h1, h2, _ = found
                doc = np.searchsorted(uoff, lo, "right") - 1
                last = hi + units.window - 1
                b_lo = lo if starts is None else starts[lo]
                b_hi = last + 1 if ends is None else ends[last]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(i + doc)), pa.array(keys[i + doc]),
                    pa.array((lo - uoff[doc]).astype(np.int32)), pa.array((hi - lo + 1).astype(np.int32)),
                    pa.array((b_lo - off[doc]).astype(np.int32)), pa.array((b_hi - b_lo).astype(np.int32)),
                    pa.array(anchor.view(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                ], names=["doc_id", "key", "lo", "n", "byte_lo", "byte_n", "anchor", "h1", "h2"])
    return run


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "h1", "h2", "copies", "contents"]
    for batch in batches:
        lists = batch.column("pieces")
        for i, j, data, off in tv.slices(batch.column("text")):
            part = lists.slice(i, j - i)
            flat = part.flatten()
            fields = dict(zip([f.name for f in flat.type], flat.flatten(), strict=True))
            row = np.repeat(np.arange(j - i), part.value_lengths().to_numpy(zero_copy_only=False))
            lo = off[row] + fields["byte_lo"].to_numpy()
            raw = data.tobytes()
            cut = [raw[a:b] for a, b in zip(lo.tolist(), (lo + fields["byte_n"].to_numpy()).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(fields[n] for n in names), pa.array(cut, pa.binary())], names=[*names, "piece"])


CELLS = ("anchor bigint, h1 bigint, h2 bigint, copies bigint, base int, at int, n int, "
         "g bigint, c1 bigint, c2 bigint, rest int, piece binary")


def _cells(units: Units, width: int):
    """Cells of ``width`` windows of oversize groups' contents; ``rest`` is the anchor's place after the cell's first window."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 256):
                part = pdf.iloc[i:i + 256].reset_index(drop=True)
                off = np.concatenate([[0], np.cumsum(part["piece"].map(len).to_numpy())]).astype(np.int64)
                raw = b"".join(part["piece"])
                u, uoff, starts, ends = units.cut(np.frombuffer(raw, np.uint8), off)
                count = np.diff(uoff) - units.window + 1
                if "rest" in part:
                    rest = part["rest"].to_numpy()
                else:
                    lo, _, _, _, _, place = super_windows(u, uoff, units.window, units.gram)
                    rest = place[np.searchsorted(lo, uoff[:-1])] - uoff[:-1]
                # The cell of a window follows from how far before the anchor it starts.
                row = np.repeat(np.arange(len(part)), count)
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                before = rest[row] - at
                cell = before // width
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (cell[1:] != cell[:-1])
                head = np.flatnonzero(new)
                n = np.diff(np.append(head, len(row)))
                row, at, cell, before = row[head], at[head], cell[head], before[head]
                anchor = uoff[row] + rest[row]
                common_lo, common_hi = anchor - cell * width, anchor - (cell * width + width - 1) + units.window
                first, second = tv.Spans(u), tv.Spans(u, 1)
                lo, hi = uoff[row] + at, uoff[row] + at + n - 1 + units.window
                out = part[["anchor", "h1", "h2", "copies"]].iloc[row].reset_index(drop=True)
                out["base"] = (part["base"].to_numpy()[row] if "base" in part else 0)
                out["at"], out["n"] = at.astype(np.int32), n.astype(np.int32)
                out["g"] = tv.mix(first(common_lo, common_hi) + cell.astype(tv.U)).view(np.int64)
                out["c1"], out["c2"] = first(lo, hi).view(np.int64), second(lo, hi).view(np.int64)
                out["rest"] = before.astype(np.int32)
                b_lo, b_hi = (lo, hi) if starts is None else (starts[lo], ends[hi - 1])
                out["piece"] = [raw[a:b] for a, b in zip(b_lo.tolist(), b_hi.tolist(), strict=True)]
                yield out
    return run


def ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    lo = np.flatnonzero(edge == 1)
    return lo, np.flatnonzero(edge == -1) - lo


def resolver(units: Units, repeated: Callable[[np.ndarray, np.ndarray, int], np.ndarray]):
    """Runs ``repeated(units, offsets, window) -> flag per unit position`` on one bucket of groups."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        pdf = pdf.sort_values(["anchor", "h1", "h2"], ignore_index=True)
        off = np.concatenate([[0], np.cumsum(pdf["piece"].map(len).to_numpy())]).astype(np.int64)
        u, uoff, _, _ = units.cut(np.frombuffer(b"".join(pdf["piece"]), np.uint8), off)
        flags = repeated(u, uoff, units.window)
        for k in np.flatnonzero(pdf["copies"].to_numpy() == 1):
            lo, n = ranges(flags[uoff[k]:uoff[k + 1]])
            out.append(pd.DataFrame({"anchor": pdf["anchor"][k], "h1": pdf["h1"][k], "h2": pdf["h2"][k],
                                     "at": lo.astype(np.int32), "m": n.astype(np.int32)}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "h1": [], "h2": [], "at": [], "m": []})
    return run


def repeated_windows(docs: DataFrame, units: Units, repeated, group_limit: int = GROUP_LIMIT,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, key, spans): runs of repeated windows as (first window, number of windows), per document with any."""
    ids = ["anchor", "h1", "h2"]
    src = docs.select("doc_id", "key", "text")
    occ = saved(src.mapInArrow(occurrences(units), OCCURRENCES), "occurrences")
    # Written first: the join then reads exchanges on both sides, and a hot anchor's rows can be split.
    again = saved(occ.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "again")
    occ = saved(occ.join(again, "anchor", "left_semi"), "anchored")
    pieces = occ.groupBy(*ids).agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("doc_id", "key", "n", "byte_lo", "byte_n")])
    contents = F.count("*").alias("contents")
    pieces = saved(pieces, "contents")
    several = saved(pieces.groupBy("anchor").agg(contents).where("contents > 1"), "several")
    unclear = pieces.join(several, "anchor")
    wanted = unclear.groupBy("doc_id", "key").agg(F.collect_list(
        F.struct(*ids, "copies", "contents", "byte_lo", "byte_n")).alias("pieces"))
    cut = (src.join(wanted, [src.doc_id.eqNullSafe(wanted.doc_id), src.key == wanted.key])
           .select("text", "pieces")
           .mapInArrow(_cut_pieces, "anchor bigint, h1 bigint, h2 bigint, copies bigint, contents bigint, piece binary"))
    # Rows that repeat id and text share their key: each piece once again.
    cut = saved(cut.dropDuplicates(ids), "pieces")

    def resolved(groups: DataFrame) -> DataFrame:
        """Marks (anchor, h1, h2, at, m) within the single contents of ``groups``."""
        total = groups.agg(F.sum(F.length("piece"))).first()[0] or 0
        bucket = F.pmod(F.xxhash64("anchor"), F.lit(int(total // bucket_bytes) + 1))
        return groups.select(*ids, "copies", "piece").withColumn("bucket", bucket).groupBy("bucket").applyInPandas(
            _dropping("bucket", resolver(units, repeated)), "anchor bigint, h1 bigint, h2 bigint, at int, m int")

    marks = [resolved(cut.where(F.col("contents") <= group_limit))]
    large = cut.where(F.col("contents") > group_limit).drop("contents")
    for width in units.widths:
        cells = saved(large.mapInPandas(_cells(units, width), CELLS), "cells")
        if cells.isEmpty():
            break
        named = cells.groupBy("g", "c1", "c2").agg(F.sum("copies").alias("total"))
        named = saved(named, "named")
        sizes = saved(named.groupBy("g").agg(contents), "sizes")
        cells = saved(cells.join(named, ["g", "c1", "c2"]).join(sizes, "g"), "placed")
        marks.append(cells.where("copies = 1 and total > 1").select(*ids, (F.col("base") + F.col("at")).alias("at"), F.col("n").alias("m")))
        if width > 1:
            several_ = cells.where(F.col("contents").between(2, group_limit))
            groups = several_.dropDuplicates(["g", "c1", "c2"]).select(
                F.col("g").alias("anchor"), F.col("c1").alias("h1"), F.col("c2").alias("h2"), F.col("total").alias("copies"), "piece")
            inner = resolved(groups).select(F.col("anchor").alias("g"), F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.col("at").alias("i"), "m")
            marks.append(several_.where("total = 1").join(inner, ["g", "c1", "c2"]).select(
                *ids, (F.col("base") + F.col("at") + F.col("i")).cast("int").alias("at"), "m"))
            large = cells.where((F.col("total") == 1) & (F.col("contents") > group_limit)).select(
                *ids, "copies", (F.col("base") + F.col("at")).cast("int").alias("base"), "rest", "piece")
            # What is repeated inside an oversize cell must still be met by the others: one reference of each.
            known = cells.where((F.col("total") > 1) & (F.col("contents") > group_limit)).dropDuplicates(["g", "c1", "c2"])
            large = large.unionByName(known.select(*ids, F.col("total").alias("copies"), F.lit(0).alias("base"), "rest", "piece"))

    whole = pieces.where("copies > 1").select(*ids, F.lit(0).alias("at"), F.col("n").alias("m"))
    found = reduce(DataFrame.unionByName, marks, whole)
    spans = occ.join(found, ids).select("doc_id", "key", F.struct((F.col("lo") + F.col("at")).alias("at"), "m").alias("span"))
    return spans.groupBy("doc_id", "key").agg(F.collect_list("span").alias("spans"))


def _dropping(column: str, run):
    def inner(pdf: pd.DataFrame) -> pd.DataFrame:
        return run(pdf.drop(columns=column))
    return inner


def with_spans(docs: DataFrame, id_col: str, text_col: str, units: Units, repeated, **limits) -> DataFrame:
    """All documents as (doc_id, text, spans); spans is null where nothing repeats."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"), row_key(id_col, text_col).alias("key"))
    spans = repeated_windows(src, units, repeated, **limits)
    return (src.join(spans, [src.doc_id.eqNullSafe(spans.doc_id), src.key == spans.key], "left")
            .select(src.doc_id, "text", "spans"))
