"""Benchmark leaks: planted items and paraphrases, and the parts by brute force."""

import pickle
import random

import numpy as np
import pytest

from opsanalytics.llm import op5_latent_decontamination as op5

from .conftest import prose


@pytest.fixture(scope="module")
def tables(spark):
    items = [(k, prose(900 + k, 15 + 4 * k)) for k in range(12)] + [(50, None), (51, ""), (52, "what is it? Answer: " + prose(77, 12))]
    rows, want = [], {}
    for k in range(150):
        words = prose(2000 + k, 20 + 7 * k).split()
        if k % 5 == 0:
            i, text = items[(k // 5) % 12]
            at = random.Random(k).randrange(len(words))
            inside = text.split()
            if k % 10 == 0 and len(inside) > 25:  # a paraphrase: one word in nine replaced
                inside = [f"other{n}" if n % 9 == 4 else w for n, w in enumerate(inside)]
            words[at:at] = [w.upper() for w in inside] if k % 3 == 0 else inside
            want[k] = i
        rows.append((k, " ".join(words), k, "x"))
    rows += [(900, None, 0, "x"), (901, "", 0, "x"), (902, "short", 0, "x"), (903, rows[5][1], 0, "x"), (903, rows[5][1], 0, "x")]
    want[903] = want[5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, leaks int, kept string")
    return docs, spark.createDataFrame([(*i, 1) for i in items], "item_id bigint, text string, doc_id int"), want


@pytest.mark.parametrize("at_once", [op5.ITEMS, 4])
def test_planted(tables, at_once):
    docs, bench, want = tables
    rows = op5.decontaminate(docs, bench, items_at_once=at_once).collect()
    assert len(rows) == docs.count()
    assert {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in rows if r["contaminated"]} == {k: [i] for k, i in want.items()}


def test_empty(tables):
    docs, bench, _ = tables
    assert op5.decontaminate(docs.limit(0), bench).count() == 0
    assert op5.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert op5.decontaminate(docs, bench.where("item_id in (50, 51)")).where("contaminated").count() == 0


def test_common_subsequence():
    r = random.Random(0)
    for _ in range(100):
        a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert op5.common_subsequence(a, b) == table[-1][-1]


def test_weighted_sums():
    r = np.random.default_rng(0)
    head = np.array([0, 1, 20, 21])
    v, rows, m = r.random(50).astype(np.float32), r.integers(0, 9, 50), r.random((9, 4)).astype(np.float32)
    want = [(v[a:b, None] * m[rows[a:b]]).sum(0) for a, b in zip(head, [1, 20, 21, 50], strict=True)]
    assert np.allclose(op5.weighted_sums(v, rows, head, m, 8), want, atol=1e-4)


def every_passage(docs, items, idf, basis):
    """Brute force: each passage of each text against each item by the final rule, without retrieval."""
    mapped = np.ascontiguousarray(basis * idf[:, None])
    bench = op5.bench_of(items, idf, mapped)
    out = {}
    for d, text in docs:
        raw = text.lower().encode()
        units, woff = op5.tokens(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        start, boff = op5.blocks(woff)
        vectors, at = op5.project(units, start, boff, mapped)
        cosine = vectors @ bench.vectors.T
        for k, item in enumerate(bench.items):
            n, own, best = len(item.words), np.flatnonzero(bench.owner == k), 0.0
            for p, b in enumerate(start[:max(1, len(start) - 2)].tolist()):
                words = op5.passage_features(units, start, boff, np.repeat(at[p:p + 1], len(own)))
                near = ((cosine[p, own] >= op5.NEAR) & (op5.covered(bench, own, words) >= op5.COVER)).any()
                best = max(best, op5.share(item, units[max(0, b - n):b + 2 * op5.BLOCK + n].tolist(), bool(near)))
            if best:
                out.setdefault(d, {})[item.item_id] = best
    return out


@pytest.fixture(scope="module")
def by_length(spark):
    """Items of 6 to 60 words in random documents: whole, and with one word in five or in four replaced."""
    r = random.Random(3)
    common = [f"c{k}" for k in range(60)]

    def text(n):
        return [r.choice(common) if r.random() < 0.7 else f"w{r.randrange(4000)}" for _ in range(n)]

    items, docs, planted = [], [], []
    for k in range(96):
        size = (6, 8, 10, 12, 15, 20, 33, 60)[k % 8]
        words = text(size)
        items.append((k, " ".join(words)))
        for every in (0, 5, 4):
            inside = [f"new{r.randrange(999)}" if every and n % every == 1 else w for n, w in enumerate(words)]
            around = text(r.randrange(60, 400))
            at = r.randrange(len(around))
            planted.append((len(docs), k, size, every))
            docs.append((len(docs), " ".join([*around[:at], *inside, *around[at:]])))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), planted


def test_recall_by_length(by_length):
    docs, bench, planted = by_length
    got = {r["doc_id"]: {x["item_id"]: x["share"] for x in r["leaks"]} for r in op5.decontaminate(docs, bench).collect() if r["contaminated"]}
    texts = docs.select("text")
    idf = op5.inverse_frequencies(texts)
    want = every_passage([tuple(r) for r in docs.collect()], bench.collect(), idf, op5.latent_basis(texts, idf))
    assert got == want
    assert all(k in got.get(d, {}) for d, k, _, every in planted if not every)


def rewritten(words, kind, r):
    if kind == "halves swapped":
        return words[len(words) // 2:] + words[:len(words) // 2]
    if kind == "neighbours swapped":
        return [words[min(n ^ 1, len(words) - 1)] for n in range(len(words))]
    return [f"new{r.randrange(999)}" if n % 2 and n < len(words) - 5 else w for n, w in enumerate(words)]  # "half replaced", answer kept


def test_paraphrases_come_through_the_latent_route(spark, monkeypatch):
    """Reordered and half replaced items are found by their cosine only, and no document without an item is flagged."""
    r = random.Random(8)
    topics = [[f"t{t}x{k}" for k in range(60)] for t in range(24)]
    common = [f"c{k}" for k in range(40)]

    def text(topic, n):
        return [r.choice(common) if r.random() < 0.4 else r.choice(topic) for _ in range(n)]

    items = [(k, text(topics[k], r.randrange(30, 60))) for k in range(24)]
    docs, kinds = [], ("halves swapped", "neighbours swapped", "half replaced")
    for kind in kinds:
        for k, words in items:
            host = text(topics[(k + 7) % 24], 120)
            docs.append((f"{kind}:{k}", " ".join([*host[:50], *rewritten(words, kind, r), *host[50:]])))
    docs += [(f"clean:{k}", " ".join(text(topics[k % 24], 150))) for k in range(240)]
    table = spark.createDataFrame(docs, "doc_id string, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id bigint, text string")

    def hits():
        rows = op5.decontaminate(table, bench).where("contaminated").collect()
        found = {(*x["doc_id"].split(":"), leak["item_id"]) for x in rows for leak in x["leaks"]}
        assert not any(kind == "clean" for kind, _, _ in found)
        return {kind: sum((kind, str(k), k) in found for k, _ in items) for kind in kinds}

    now = hits()
    monkeypatch.setattr(op5, "NEAR", 2.0)  # no passage is near
    before = hits()
    assert all(now[kind] >= 0.9 * len(items) for kind in kinds[:2]), now
    assert all(before[kind] < now[kind] for kind in kinds), (before, now)


def test_batches_are_bounded(by_length, monkeypatch):
    """Long items make more batches, each of a size in proportion to its words, with the same result."""
    docs, bench, _ = by_length
    sizes, build = [], op5.bench_of

    def watched(rows, *args):
        out = build(rows, *args)
        sizes.append((sum(len(i.words) for i in out.items), len(pickle.dumps(out))))
        return out

    want = {r["doc_id"]: r["leaks"] for r in op5.decontaminate(docs, bench).collect()}
    monkeypatch.setattr(op5, "bench_of", watched)
    size = sum(len(r["text"]) for r in bench.collect())
    rows = op5.decontaminate(docs, bench, bytes_at_once=size // 3).collect()
    assert len(sizes) > 2 and len(rows) == len(want) and {r["doc_id"]: r["leaks"] for r in rows} == want
    assert all(held < 300 * words + 5000 for words, held in sizes)  # a dense row of all features is 32 KB a passage
