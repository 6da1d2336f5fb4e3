"""Random forest whose trees grow in tasks (M7): no grown tree passes through the driver.

Spark's own forest grows level by level, with every node of all trees as an object on the driver and a histogram per
open node and partition, so that deep trees over many rows fit neither the driver nor the time.  The model is the same
here (bins from weighted quantiles of a sample, Poisson bootstrap, a draw of features per node, weighted Gini gain, least
leaf size, leaves that predict alike merged, importances by gain); its steps are dealt otherwise:

1. rows are stored in blocks of bin numbers, a byte for each feature;
2. nodes with more than ``part_rows`` rows are split by histograms that tasks make per block and others add up; the
   driver holds these top nodes, at most two per tree for each ``part_rows`` rows;
3. the rows of a smaller node (of a whole tree, if the table is small) meet in one task, which grows the rest;
4. grown parts are stored as packed arrays; scoring streams blocks of rows past the parts a task holds.

Every draw is seeded by tree, node and block, so a repeated task draws the same.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsanalytics.session import checkpoint_dir, cut_lineage

CELLS = 1 << 19   # histogram cells that a task fills at a time


def candidate_splits(values, weights, n_splits: int):
    """Thresholds of one feature: midpoints of neighbouring values, at equal shares of the weight if there are too many."""
    known = ~np.isnan(values)
    v, at = np.unique(values[known], return_inverse=True)
    if len(v) < 2:
        return np.zeros(0)
    mid = v[:-1] / 2 + v[1:] / 2
    if len(mid) <= n_splits:
        return mid
    count = np.cumsum(np.bincount(at, weights[known]))
    stride, out = count[-1] / (n_splits + 1), []
    target = stride
    for i in range(1, len(v)):
        if abs(count[i - 1] - target) < abs(count[i] - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


def to_bins(x, thresholds):
    """Number of thresholds below each value (NaN: all of them): a row goes left at threshold j if its bin is at most j."""
    most = max((len(t) for t in thresholds), default=0)
    out = np.zeros(x.shape, np.uint8 if most < 256 else np.uint16)
    for j, t in enumerate(thresholds):
        out[:, j] = np.searchsorted(t, x[:, j])
    return out


def draw_features(rng, nodes: int, features: int, m: int):
    """``m`` different features for each node, in their order (which decides between equal gains)."""
    if m >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return np.sort(np.argpartition(rng.random((nodes, features), np.float32), m - 1, axis=1)[:, :m], axis=1)


def best_splits(cells, c, w0, w1, total, m: int, width: int, min_leaf: int):
    """Best (draw, bin, gain) of each node from the filled ``cells`` (ascending; (node * m + draw) * width + bin) of its
    histogram; gain 0 where no split is allowed or gains anything.  ``total``: rows and weights of each node."""
    n = len(total[0])
    draw, gain_of = np.zeros(n, np.int64), np.zeros(n)
    bins = np.zeros(n, np.int64)
    if not len(cells):
        return draw, bins, gain_of
    seg = cells // width
    first = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    size = np.diff(np.r_[first, len(seg)])
    node = seg // m

    def left_of(x):
        run = np.cumsum(x)
        return run - np.repeat(run[first] - x[first], size)

    lc, l0, l1 = left_of(c), left_of(w0), left_of(w1)
    rc, r0, r1 = total[0][node] - lc, total[1][node] - l0, total[2][node] - l1
    ok = (lc >= min_leaf) & (rc >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = total[1] * total[2] / (total[1] + total[2])
        gain = spread[node] - l0 * l1 / (l0 + l1) - r0 * r1 / (r0 + r1)
    gain = np.where(ok & (gain > 1e-12 * spread[node]), gain, 0.0)  # twice that is the gain times the node's weight
    start = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    most = np.maximum.reduceat(gain, start)
    hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.r_[start, len(node)])))
    hit = hit[np.r_[True, node[hit][1:] != node[hit][:-1]]]
    at = node[hit]
    draw[at], bins[at], gain_of[at] = seg[hit] % m, cells[hit] % width, 2.0 * most
    return draw, bins, gain_of


def histogram(keys, c, w0, w1, size: int):
    """Filled cells, and rows and weights in them."""
    count = np.bincount(keys, c, size)
    cells = np.flatnonzero(count)
    return cells, count[cells], np.bincount(keys, w0, size)[cells], np.bincount(keys, w1, size)[cells]


def grow(bins, y, w, times, width: int, m: int, min_leaf: int, depth: int, rng):
    """The tree over the rows of ``bins`` (each ``times`` times, weight ``w``, class ``y`` 0 or 1), level by level.

    Arrays by node: ``feat`` (-1: leaf), ``bin``, ``left`` (the right child follows), ``w0``, ``w1``, ``gain`` (times weight)."""
    features = bins.shape[1]
    rows = np.flatnonzero(times)
    flat, t = bins.ravel(), times[rows].astype(float)
    w1 = np.where(y[rows] == 1, w[rows] * t, 0.0)
    w0 = w[rows] * t - w1
    at, pos = rows * features, t * (y[rows] == 1)
    levels, first = [], 0
    starts = np.zeros(1, np.int64) if len(rows) else np.zeros(0, np.int64)
    for level in range(depth + 1):
        n = len(starts)
        if not n:
            break
        c, t0, t1 = (np.add.reduceat(x, starts) for x in (t, w0, w1))
        feat, cut, gain = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n)
        left = np.full(n, -1)
        ends = np.r_[starts[1:], len(t)]
        open_ = np.zeros(n, bool)
        if level < depth:
            p = np.add.reduceat(pos, starts)
            open_ = (p > 0) & (p < c) & (c >= 2 * min_leaf)
        go = np.flatnonzero(open_)
        if len(go):
            keep = np.repeat(open_, ends - starts)
            if not keep.all():
                at, t, w0, w1, pos = at[keep], t[keep], w0[keep], w1[keep], pos[keep]
            sizes = (ends - starts)[go]
            slot = np.repeat(np.arange(len(go)), sizes)
            bounds = np.r_[0, np.cumsum(sizes)]
            picked = draw_features(rng, len(go), features, m)
            per = max(1, CELLS // (m * width))
            for a in range(0, len(go), per):
                b = min(len(go), a + per)
                i, j = bounds[a], bounds[b]
                s = slot[i:j] - a
                keys = flat[at[i:j, None] + picked[slot[i:j]]] + (s[:, None] * m + np.arange(m)) * width
                found = histogram(keys.ravel(), *(np.repeat(x[i:j], m) for x in (t, w0, w1)), (b - a) * m * width)
                d, cut[go[a:b]], gain[go[a:b]] = best_splits(*found, [x[go[a:b]] for x in (c, t0, t1)], m, width, min_leaf)
                feat[go[a:b]] = np.where(gain[go[a:b]] > 0, picked[np.arange(a, b), d], -1)
            split = feat[go] >= 0
            left[go[split]] = first + n + 2 * np.arange(split.sum())
            if not split.all():
                keep = np.repeat(split, sizes)
                at, t, w0, w1, pos, sizes = at[keep], t[keep], w0[keep], w1[keep], pos[keep], sizes[split]
            go = go[split]
        levels.append((feat, cut, left, t0, t1, gain))
        first += n
        if not len(go):
            break
        # Rows stay in the order of their nodes: left ones before right ones in each.
        f, k = np.repeat(feat[go], sizes), np.repeat(cut[go], sizes)
        is_left = flat[at + f] <= k
        begin = np.r_[0, np.cumsum(sizes)[:-1]]
        run = np.cumsum(is_left)
        before = run[begin] - is_left[begin]
        lefts = np.add.reduceat(is_left.astype(np.int64), begin)
        rank = run - np.repeat(before, sizes)
        here = np.arange(len(at)) - np.repeat(begin, sizes)
        to = np.repeat(begin, sizes) + np.where(is_left, rank - 1, np.repeat(lefts, sizes) + here - rank)
        order = np.empty(len(at), np.int64)
        order[to] = np.arange(len(at))
        at, t, w0, w1, pos = at[order], t[order], w0[order], w1[order], pos[order]
        starts = np.empty(2 * len(go), np.int64)
        starts[0::2], starts[1::2] = begin, begin + lefts
    names = ("feat", "bin", "left", "w0", "w1", "gain")
    tree = {k: np.concatenate([x[i] for x in levels]) if levels else np.zeros(0) for i, k in enumerate(names)}
    return prune(tree, np.cumsum([0] + [len(x[0]) for x in levels]))


def prune(tree, offsets):
    """Two leaves that predict the same class become their parent's leaf, from the deepest level up, as Spark prunes."""
    feat, left = tree["feat"], tree["left"]
    says = tree["w1"] > tree["w0"]
    for a, b in zip(offsets[-2::-1], offsets[:0:-1]):
        inner = a + np.flatnonzero(feat[a:b] >= 0)
        x, z = left[inner], left[inner] + 1
        merged = inner[(feat[x] < 0) & (feat[z] < 0) & (says[x] == says[z])]
        feat[merged], left[merged] = -1, -1
    kept = np.zeros(len(feat), bool)
    kept[:1] = True
    for a, b in zip(offsets[:-1], offsets[1:]):
        inner = a + np.flatnonzero(kept[a:b] & (feat[a:b] >= 0))
        kept[left[inner]] = kept[left[inner] + 1] = True
    number = np.cumsum(kept) - 1
    out = {k: v[kept] for k, v in tree.items()}
    out["left"] = np.where(out["feat"] >= 0, number[out["left"]], -1)
    out["gain"] = np.where(out["feat"] >= 0, out["gain"], 0.0)
    return out


# ---------------------------------------------------------------------------
# The forest over Spark tables
# ---------------------------------------------------------------------------
PART_ROWS = 1_000_000     # rows of a node whose subtree one task grows
BLOCK_ROWS = 20_000       # rows of a stored block
SAMPLE_ROWS = 10_000      # rows that the candidate splits are taken from, as Spark does
ARRAYS = {"feat": np.int32, "bin": np.int32, "left": np.int32, "w0": np.float64, "w1": np.float64, "gain": np.float64}
PART_SCHEMA = "tree int, node int, leaf boolean, says boolean, " + ", ".join(f"{k} binary" for k in ARRAYS)


def _splits_of(n_splits: int):
    """Thresholds of every feature from the rows of one task, the sample."""
    import pandas as pd

    def run(batches):
        pdf = pd.concat(batches)
        x, w = np.stack(pdf["x"].to_numpy()).astype(float), pdf["w"].to_numpy()
        yield pd.DataFrame({"feat": range(x.shape[1]), "thr": [candidate_splits(x[:, j], w, n_splits) for j in range(x.shape[1])]})

    return run


def _blocks_of(thresholds, extra):
    """Rows as blocks: bin numbers, and the columns ``extra`` (name -> type) as packed arrays."""
    import pandas as pd

    def run(batches):
        from pyspark import TaskContext

        task, held, n, made = TaskContext.get().partitionId(), [], 0, 0

        def packed():
            pdf = pd.concat(held)
            x = to_bins(np.stack(pdf["x"].to_numpy()).astype(float), thresholds)
            return pd.DataFrame([{"block": (task << 24) + made, "n": len(pdf), "bins": x.tobytes(),
                                  **{c: pdf[c].to_numpy().astype(t).tobytes() for c, t in extra.items()}}])

        for pdf in batches:
            for i in range(0, len(pdf), BLOCK_ROWS):
                held.append(pdf.iloc[i:i + BLOCK_ROWS])
                n += len(held[-1])
                if n >= BLOCK_ROWS:
                    yield packed()
                    held, n, made = [], 0, made + 1
        if n:
            yield packed()

    return run


def _unpacked(block, thresholds):
    """Bin numbers of a stored block."""
    kind = np.uint8 if max((len(t) for t in thresholds), default=0) < 256 else np.uint16
    return np.frombuffer(block.bins, kind).reshape(block.n, len(thresholds))


def _times(seed: int, tree: int, block: int, n: int):
    """How often the bootstrap of ``tree`` draws each row of a block."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n)


def _reached(top, bins):
    """The node of a tree's top that each row ends in."""
    at = np.zeros(len(bins), np.int64)
    idx = np.arange(len(bins)) if len(top["feat"]) else np.zeros(0, np.int64)
    while True:
        idx = idx[top["feat"][at[idx]] >= 0]
        if not len(idx):
            return at
        f = top["feat"][at[idx]]
        at[idx] = top["left"][at[idx]] + (bins[idx, f] > top["bin"][at[idx]])


def _part_row(tree: int, node: int, t) -> dict:
    return {"tree": tree, "node": node, "leaf": len(t["feat"]) == 1, "says": bool(t["w1"][0] > t["w0"][0]) if len(t["feat"]) else False,
            **{k: t[k].astype(kind).tobytes() for k, kind in ARRAYS.items()}}


def _one_per_task(spark, n: int) -> list[int]:
    """``n`` numbers that ``repartition(n, ...)`` deals to as many tasks, one each (Spark deals by this hash)."""
    found = spark.range(30 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("k")).orderBy("p").collect()
    keys = [r["k"] for r in found]
    return keys + [30 * n + i for i in range(n - len(keys))]


def _grow_groups(thresholds, seed, trees, keys, width, m, min_leaf, depth):
    """Small tables: a task holds all rows in blocks and grows the trees of its group."""
    import pandas as pd

    def run(batches):
        group, blocks = None, []

        def grown():
            bins = np.concatenate([_unpacked(b, thresholds) for b in blocks])
            y = np.concatenate([np.frombuffer(b.y, np.uint8) for b in blocks])
            w = np.concatenate([np.frombuffer(b.w, np.float64) for b in blocks])
            for tree in range(keys.index(group), trees, len(keys)):
                times = np.concatenate([_times(seed, tree, b.block, b.n) for b in blocks])
                t = grow(bins, y, w, times, width, m, min_leaf, depth, np.random.default_rng([seed, tree, 0, 1]))
                yield pd.DataFrame([_part_row(tree, 0, t)])

        for pdf in batches:
            for b in pdf.itertuples(index=False):
                if blocks and b.group != group:
                    yield from grown()
                    blocks = []
                group = b.group
                blocks.append(b)
        if blocks:
            yield from grown()

    return run


def _node_draw(seed: int, tree: int, node: int, features: int, m: int):
    return draw_features(np.random.default_rng([seed, tree, node, 2]), 1, features, m)[0]


def _top_histograms(thresholds, seed, tops, wanted, width, m):
    """Histograms of the wanted top nodes (tree -> nodes) over the blocks of a task."""
    import pandas as pd

    def run(batches):
        sums = {}
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                bins, y, w = _unpacked(b, thresholds), np.frombuffer(b.y, np.uint8), np.frombuffer(b.w, np.float64)
                for tree, nodes in wanted.items():
                    times, at = _times(seed, tree, b.block, b.n), _reached(tops[tree], bins)
                    for node in nodes:
                        rows = np.flatnonzero((at == node) & (times > 0))
                        picked = _node_draw(seed, tree, node, len(thresholds), m)
                        keys = (bins[rows][:, picked] + np.arange(len(picked)) * width).ravel()
                        t = times[rows].astype(float)
                        w1 = np.where(y[rows] == 1, w[rows] * t, 0.0)
                        h = np.stack([np.bincount(keys, np.repeat(v, len(picked)), len(picked) * width)
                                      for v in (t, w[rows] * t - w1, w1, t * (y[rows] == 1))])
                        sums[tree, node] = sums.get((tree, node), 0.0) + h
        for (tree, node), h in sums.items():
            yield pd.DataFrame([{"tree": tree, "node": node, "h": h.tobytes()}])

    return run


def _top_split(seed, features, width, m, min_leaf):
    """The split of one top node from the histograms of all tasks."""
    import pandas as pd

    def run(pdf):
        tree, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        picked = _node_draw(seed, tree, node, features, m)
        h = sum(np.frombuffer(x, np.float64).reshape(4, -1) for x in pdf["h"])
        c, w0, w1, pos = h
        total = [x[:width].sum()[None] for x in (c, w0, w1)]
        cells = np.flatnonzero(c)
        draw, cut, gain = (x[0] for x in best_splits(cells, c[cells], w0[cells], w1[cells], total, len(picked), width, min_leaf))
        lo = slice(draw * width, draw * width + cut + 1)
        left = [x[lo].sum() for x in h]
        return pd.DataFrame([{"tree": tree, "node": node, "feat": int(picked[draw]) if gain > 0 else -1, "bin": int(cut), "gain": float(gain),
                              "total": [float(x[:width].sum()) for x in h], "lefts": [float(x) for x in left]}])

    return run


def _rows_of_parts(thresholds, seed, tops, parts):
    """The drawn rows of every open part (tree -> nodes), a packed row for each block."""
    import pandas as pd

    def run(batches):
        for pdf in batches:
            for b in pdf.itertuples(index=False):
                bins, y, w = _unpacked(b, thresholds), np.frombuffer(b.y, np.uint8), np.frombuffer(b.w, np.float64)
                for tree, nodes in parts.items():
                    times, at = _times(seed, tree, b.block, b.n), _reached(tops[tree], bins)
                    for node in nodes:
                        rows = np.flatnonzero((at == node) & (times > 0))
                        if len(rows):
                            yield pd.DataFrame([{"tree": tree, "node": node, "block": b.block, "n": len(rows), "bins": bins[rows].tobytes(),
                                                 "y": y[rows].tobytes(), "w": w[rows].tobytes(), "times": times[rows].astype(np.int32).tobytes()}])

    return run


def _grow_part(thresholds, seed, tops_depth, width, m, min_leaf, depth):
    import pandas as pd

    def run(pdf):
        blocks = list(pdf.sort_values("block").itertuples(index=False))
        tree, node = int(blocks[0].tree), int(blocks[0].node)
        bins = np.concatenate([_unpacked(b, thresholds) for b in blocks])
        y, w, times = (np.concatenate([np.frombuffer(getattr(b, c), kind) for b in blocks])
                       for c, kind in (("y", np.uint8), ("w", np.float64), ("times", np.int32)))
        t = grow(bins, y, w, times, width, m, min_leaf, depth - tops_depth[tree][node], np.random.default_rng([seed, tree, node, 1]))
        return pd.DataFrame([_part_row(tree, node, t)])

    return run


def _grown_tops(blocks, thresholds, seed, trees, width, m, min_leaf, depth):
    """Splits of all nodes with more than ``PART_ROWS`` rows, a job per level: (tops by tree, depth of their nodes, open parts)."""
    names = ("feat", "bin", "left", "w0", "w1", "gain", "final", "level")
    tops = {t: {k: [v] for k, v in zip(names, (-1, 0, -1, 0.0, 0.0, 0.0, False, 0))} for t in range(trees)}
    wanted = {t: [0] for t in tops}
    while wanted:
        packed = {t: _as_arrays(tops[t]) for t in wanted}
        made = blocks.mapInPandas(_top_histograms(thresholds, seed, packed, wanted, width, m), "tree int, node int, h binary")
        splits = made.groupBy("tree", "node").applyInPandas(
            _top_split(seed, len(thresholds), width, m, min_leaf),
            "tree int, node int, feat int, bin int, gain double, total array<double>, lefts array<double>").collect()
        wanted = {}
        for s in sorted(splits, key=lambda r: (r["tree"], r["node"])):
            top, node = tops[s["tree"]], s["node"]
            top["w0"][node], top["w1"][node] = s["total"][1:3]
            if s["feat"] < 0:
                top["final"][node] = True
                continue
            level = top["level"][node] + 1
            top["feat"][node], top["bin"][node], top["left"][node], top["gain"][node] = s["feat"], s["bin"], len(top["feat"]), s["gain"]
            for c, w0, w1, pos in (s["lefts"], [a - b for a, b in zip(s["total"], s["lefts"])]):
                done = not 0 < pos < c or level == depth
                if not done and c > PART_ROWS:
                    wanted.setdefault(s["tree"], []).append(len(top["feat"]))
                for k, v in zip(names, (-1, 0, -1, w0, w1, 0.0, done, level)):
                    top[k].append(v)
    parts = {t: [i for i, (f, d) in enumerate(zip(x["feat"], x["final"])) if f < 0 and not d] for t, x in tops.items()}
    return {t: _as_arrays(x) for t, x in tops.items()}, {t: x["level"] for t, x in tops.items()}, {t: p for t, p in parts.items() if p}


def _as_arrays(top):
    return {k: np.array(v) for k, v in top.items()}


def _pruned_tops(tops, parts):
    """Top nodes whose two sides are leaves of the same class become leaves; ``parts``: those that are a single leaf."""
    says = {(r["tree"], r["node"]): r["says"] for r in parts}
    for tree, t in tops.items():
        for node in range(len(t["feat"]) - 1, -1, -1):
            if t["final"][node]:
                says[tree, node] = bool(t["w1"][node] > t["w0"][node])
            elif t["feat"][node] >= 0:
                a, b = (says.get((tree, int(t["left"][node]) + i)) for i in (0, 1))
                if a is not None and a == b:
                    t["feat"][node], t["left"][node], t["gain"][node], t["final"][node] = -1, -1, 0.0, True
                    says[tree, node] = bool(t["w1"][node] > t["w0"][node])
    return tops


class DealtForestClassifier(RandomForestClassifier):
    """Spark's random forest classifier for two classes and ordered features, grown in tasks (see the module)."""

    def _fit(self, dataset):
        x = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"),
                           (F.col(self.getWeightCol()).cast("double") if self.isSet("weightCol") else F.lit(1.0)).alias("w"))
        odd = F.coalesce(~F.col("y").isin(0.0, 1.0) | (F.col("w") < 0) | F.isnan("w"), F.lit(True))
        seen = x.agg(F.count("*").alias("n"), F.max("y").alias("most"), F.count_if(odd).alias("odd")).first()
        attrs = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        usual = (self.getImpurity() == "gini" and self.getBootstrap() and self.getSubsamplingRate() == 1.0 and self.getMinInfoGain() == 0.0
                 and self.getMinWeightFractionPerNode() == 0.0 and self.getFeatureSubsetStrategy() in ("auto", "sqrt", "all")
                 and not self.isSet("thresholds") and not self.getLeafCol())
        if seen["odd"] or seen["most"] != 1.0 or not usual or {"nominal", "binary"} & set(attrs):
            return super()._fit(dataset)  # several classes, category splits and the like are Spark's own
        spark, n, trees, seed = dataset.sparkSession, seen["n"], self.getNumTrees(), self.getSeed() & (2**63 - 1)
        sample = (x if n <= SAMPLE_ROWS else x.sample(False, SAMPLE_ROWS / n, seed)).select("x", "w")
        found = sample.repartition(1).mapInPandas(_splits_of(min(self.getMaxBins(), n) - 1), "feat int, thr array<double>").collect()
        thresholds = [np.array(r["thr"], float) for r in sorted(found, key=lambda r: r["feat"])]
        features = len(thresholds)
        every = self.getFeatureSubsetStrategy() == "all" or (self.getFeatureSubsetStrategy() == "auto" and trees == 1)
        width = max(len(t) for t in thresholds) + 1
        how = (width, features if every else int(np.ceil(np.sqrt(features))), self.getMinInstancesPerNode(), self.getMaxDepth())
        blocks = cut_lineage(x.mapInPandas(_blocks_of(thresholds, {"y": np.uint8, "w": np.float64}),
                                           "block long, n int, bins binary, y binary, w binary"))
        tops = {t: _as_arrays({"feat": [-1], "bin": [0], "left": [-1], "w0": [0.0], "w1": [0.0], "gain": [0.0], "final": [False]})
                for t in range(trees)}
        if n <= PART_ROWS:
            groups = min(trees, 4 * spark.sparkContext.defaultParallelism)
            keys = _one_per_task(spark, groups)
            dealt = blocks.withColumn("group", F.explode(F.array(*[F.lit(k).cast("long") for k in keys]))).repartition(groups, "group")
            grown = dealt.sortWithinPartitions("group", "block").mapInPandas(
                _grow_groups(thresholds, seed, trees, keys, *how), PART_SCHEMA)
        else:
            tops, depths, parts = _grown_tops(blocks, thresholds, seed, trees, *how)
            rows = blocks.mapInPandas(_rows_of_parts(thresholds, seed, tops, parts),
                                      "tree int, node int, block long, n int, bins binary, y binary, w binary, times binary")
            grown = rows.groupBy("tree", "node").applyInPandas(_grow_part(thresholds, seed, depths, *how), PART_SCHEMA)
        path = f"{checkpoint_dir(spark)}/forests/{uuid.uuid4().hex}"
        grown.write.parquet(path)
        if n > PART_ROWS:
            tops = _pruned_tops(tops, spark.read.parquet(path).filter("leaf").select("tree", "node", "says").collect())
        return DealtForestModel(spark, path, tops, thresholds, self.getFeaturesCol())


GROUP_NODES = 2_000_000   # nodes of the trees that a task walks
WALKED = ("feat", "bin", "left", "w0", "w1")


def _array(part, name: str):
    return np.frombuffer(getattr(part, name), ARRAYS[name])


def _share(w0, w1):
    """Positive share of the weight (0 without weight)."""
    total = w0 + w1
    return np.divide(w1, total, out=np.zeros(np.shape(total)), where=total > 0)


def _walkable(part) -> dict:
    t = {k: _array(part, k) for k in WALKED}
    return {"feat": t["feat"], "bin": t["bin"], "left": t["left"], "p1": _share(t["w0"], t["w1"])}


def _reachable(top) -> list[int]:
    """Nodes of a tree's top that pruning left."""
    out, todo = [], [0]
    while todo:
        node = todo.pop()
        out.append(node)
        if top["feat"][node] >= 0:
            todo += [int(top["left"][node]), int(top["left"][node]) + 1]
    return out


def _down(t, bins, rows, v, contributions: bool):
    """Rows go down one part from its root; returns the node each ends in, and adds what changes on the way."""
    at, idx = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while True:
        idx = idx[t["feat"][at[idx]] >= 0]
        if not len(idx):
            return at
        node = at[idx]
        f = t["feat"][node]
        child = t["left"][node] + (bins[rows[idx], f] > t["bin"][node])
        if contributions:
            v[rows[idx], f] += t["p1"][child] - t["p1"][node]
        at[idx] = child


def _walk(top, parts, bins, v, contributions: bool) -> None:
    """One tree over a block: adds the leaf's positive share, or each feature's steps of it, to the rows of ``v``."""
    every = np.arange(len(bins))
    if len(top["feat"]) == 1 and not top["final"][0]:
        ends = {0: every}
    else:
        upper = {k: top[k] for k in ("feat", "bin", "left")} | {"p1": _share(top["w0"], top["w1"])}
        at = _down(upper, bins, every, v, contributions)
        ends = {int(i): np.flatnonzero(at == i) for i in np.unique(at)}
        if not contributions:
            for i, rows in ends.items():
                if top["final"][i]:
                    v[rows, 0] += upper["p1"][i]
    for i, t in parts.items():
        if len(rows := ends.get(i, ())):
            at = _down(t, bins, rows, v, contributions)
            if not contributions:
                v[rows, 0] += t["p1"][at]


class DealtForestModel(Model):
    """A grown forest: its parts in the shared folder, on the driver only the top nodes and the thresholds."""

    numClasses = 2

    def __init__(self, spark, path, tops, thresholds, features):
        super().__init__()
        self.spark, self.path, self.tops, self.thresholds, self.features = spark, path, tops, thresholds, features

    @property
    def numFeatures(self) -> int:
        return len(self.thresholds)

    @property
    def getNumTrees(self) -> int:
        return len(self.tops)

    def parts(self) -> DataFrame:
        """The grown parts whose place in the tops was not pruned."""
        parts = self.spark.read.parquet(self.path)
        pruned = [(t, i) for t, x in self.tops.items() for i in set(range(len(x["feat"]))) - set(_reachable(x))]
        if not pruned:
            return parts
        gone = self.spark.createDataFrame(pruned, "tree int, node int")
        return parts.join(F.broadcast(gone), ["tree", "node"], "left_anti")

    @property
    def featureImportances(self):
        """Gain by feature, of every tree in equal shares, summing to 1."""
        import pandas as pd

        def gains(batches):
            for pdf in batches:
                for p in pdf.itertuples(index=False):
                    feat, gain = _array(p, "feat"), _array(p, "gain")
                    f = np.bincount(feat[feat >= 0], gain[feat >= 0])
                    yield pd.DataFrame({"tree": p.tree, "feat": np.arange(len(f)), "gain": f})

        found = self.parts().mapInPandas(gains, "tree int, feat int, gain double").groupBy("tree", "feat").agg(F.sum("gain").alias("gain"))
        per = np.zeros((len(self.tops), self.numFeatures))
        for r in found.collect():
            per[r["tree"], r["feat"]] += r["gain"]
        for t, x in self.tops.items():
            kept = np.array([i for i in _reachable(x) if x["feat"][i] >= 0], int)
            np.add.at(per[t], x["feat"][kept], x["gain"][kept])
        size = per.sum(1, keepdims=True)
        total = np.divide(per, size, out=np.zeros_like(per), where=size > 0).sum(0)
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def _transform(self, dataset):
        x = cut_lineage(dataset.withColumn("_row", F.monotonically_increasing_id()))
        p = F.col("v")[0] / F.lit(float(len(self.tops)))
        found = self.walked(x, self.features, False).select("_row", p.alias("_p"))
        pair = F.array(1.0 - F.col("_p"), F.col("_p"))
        raw = F.transform(pair, lambda v: v * F.lit(float(len(self.tops))))
        return x.join(found, "_row").withColumns({"rawPrediction": array_to_vector(raw), "probability": array_to_vector(pair),
                                                  "prediction": (F.col("_p") > 0.5).cast("double")}).drop("_row", "_p")

    def bias(self) -> float:
        """Mean over the trees of the positive share at the root."""
        roots = {}
        for p in self.parts().filter("node = 0").select("tree", F.substring("w0", 1, 8).alias("w0"), F.substring("w1", 1, 8).alias("w1")).collect():
            roots[p["tree"]] = (np.frombuffer(p["w0"])[0], np.frombuffer(p["w1"])[0])
        w0, w1 = np.array([roots.get(t, (x["w0"][0], x["w1"][0])) for t, x in self.tops.items()]).T
        return float(np.mean(_share(w0, w1)))

    def walked(self, x: DataFrame, features: str, contributions: bool) -> DataFrame:
        """For each ``_row`` of the stored table ``x`` the sum ``v`` over the trees: of leaf shares, or of contributions by feature."""
        import pandas as pd

        spark, thresholds, tops = self.spark, self.thresholds, self.tops
        parts, wide = self.parts(), len(thresholds) if contributions else 1
        rows, nodes = x.count(), parts.agg(F.sum(F.octet_length("feat")) / 4).first()[0] or 0
        groups = min(len(tops), max(2 * spark.sparkContext.defaultParallelism, int(-(-nodes // GROUP_NODES))))
        keys = _one_per_task(spark, groups)
        listed = F.array(*[F.lit(k).cast("long") for k in keys])
        blocks = x.select(F.col("_row").alias("ids"), vector_to_array(F.col(features)).alias("x")).repartition(max(1, -(-rows // BLOCK_ROWS)), "ids").mapInPandas(
            _blocks_of(thresholds, {"ids": np.int64}), "block long, n int, bins binary, ids binary")
        asked = blocks.withColumn("group", F.explode(listed))
        held = parts.select("tree", "node", *WALKED).withColumn("group", F.get(listed, F.col("tree") % F.lit(groups)))
        both = held.unionByName(asked, allowMissingColumns=True).repartition(groups, "group").sortWithinPartitions("group", F.col("block").asc_nulls_first())

        def run(batches):
            group, trees, queue, n = None, {}, [], 0

            def flushed():
                bins = np.concatenate([_unpacked(b, thresholds) for b in queue])
                v = np.zeros((len(bins), wide))
                for t in range(keys.index(group), len(tops), len(keys)):
                    _walk(tops[t], trees.get(t, {}), bins, v, contributions)
                return pd.DataFrame([{"block": queue[0].block, "group": group, "ids": b"".join(b.ids for b in queue), "v": v.tobytes()}])

            for pdf in batches:
                for b in pdf.itertuples(index=False):
                    if b.group != group:
                        if queue:
                            yield flushed()
                        group, trees, queue, n = b.group, {}, [], 0
                    if b.bins is None:
                        trees.setdefault(int(b.tree), {})[int(b.node)] = _walkable(b)
                        continue
                    b = b._replace(n=int(b.n), block=int(b.block))
                    queue.append(b)
                    n += b.n
                    if n >= BLOCK_ROWS:
                        yield flushed()
                        queue, n = [], 0
            if queue:
                yield flushed()

        def added(pdf):
            pdf = pdf.sort_values("group")
            v = sum(np.frombuffer(b).reshape(-1, wide) for b in pdf["v"])
            return pd.DataFrame({"_row": np.frombuffer(pdf["ids"].iloc[0], np.int64), "v": list(v)})

        sums = both.mapInPandas(run, "block long, group long, ids binary, v binary")
        return sums.groupBy("block").applyInPandas(added, "_row long, v array<double>")
