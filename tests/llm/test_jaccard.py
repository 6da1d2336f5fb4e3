"""Similarity join against all pairs."""

import re
from collections import Counter
from itertools import combinations

import pytest

from opsanalytics.llm import op7_jaccard_join as op7

from .conftest import corpus


def want(rows, n=5, threshold=0.8):
    sets = []
    for _, t in rows:
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[x][0] for x in range(len(rows)) if find(x) == find(k) and rows[x][0] is not None]
        out.append((i, min(ids, default=None), links[k]))
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"block": 3, "block_bytes": 3000}, {"threshold": 0.5}])
def test_links(docs, limits):
    got = op7.jaccard_join(docs, **limits)
    assert Counter(map(tuple, got.collect())) == want(corpus(), threshold=limits.get("threshold", 0.8))


def test_empty(no_docs):
    assert op7.jaccard_join(no_docs).count() == 0


def test_bands_reach_their_recall():
    for t in (0.5, 0.8, 0.9):
        bands, rows = op7.choose_bands(t, 0.999)
        assert 1 - (1 - t**rows) ** bands >= 0.999


def chain(length, step=6, n=150):
    """Each text shares all but ``step`` words with the next one; far ones share nothing."""
    words = [f"w{k}" for k in range(length * step + n)]
    return [(k, " ".join(words[k * step:k * step + n])) for k in range(length)]


@pytest.mark.parametrize("hot", [0, 25])
def test_a_chain_compares_neighbouring_blocks_only(spark, monkeypatch, hot):
    """One connected group of many blocks, with and without a bucket of near copies that fills several of them."""
    rows = chain(160)
    for k in range(hot):
        words = rows[70][1].split()
        words[3 * k + 1] = f"edit{k}"
        rows.append((1000 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    met = []
    real = op7.meeting_blocks

    def spy(*args):
        met.append(real(*args))
        return met[0]

    monkeypatch.setattr(op7, "meeting_blocks", spy)
    got = op7.jaccard_join(docs, block=4, block_bytes=4 * 600)
    assert Counter(map(tuple, got.collect())) == want(rows)
    spread, pairs = met[0]
    assert spread.count() == len(rows) and spread.select("component").distinct().count() == 1
    blocks = spread.select("block").distinct().count()
    assert blocks > 25 and pairs.count() < blocks * blocks / 2
    # Meeting goes both ways, and every block meets itself.
    links = {tuple(r) for r in pairs.select("block", "other").collect()}
    assert all((b, a) in links for a, b in links) and all((b, b) in links for b in range(blocks))
