"""Removal of repeated byte strings and word sequences against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from opsanalytics.llm import op4_run_index as op4
from opsanalytics.llm import op8_suffix_trees as op8

from .conftest import corpus


def covered(seqs: list, window: int) -> list[list[bool]]:
    seen = Counter(s[i:i + window] for s in seqs for i in range(len(s) - window + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[s[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        out.append(gone)
    return out


def want_bytes(rows):
    raw = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), s, gone in zip(rows, raw, covered(raw, 400), strict=True):
        kept = bytes(b for b, g in zip(s, gone, strict=True) if not g)
        runs = sum(g and not p for g, p in zip(gone, [False, *gone], strict=False))
        out.append((i, len(s), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def want_words(rows):
    words = [tuple(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    out = []
    for (i, _), s, gone in zip(rows, words, covered(words, 35), strict=True):
        kept = " ".join(w for w, g in zip(s, gone, strict=True) if not g)
        out.append((i, len(s), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"group_limit": 2, "bucket_bytes": 4000}])
def test_bytes(docs, limits):
    got = op4.remove_repeats(docs, **limits)
    assert Counter(tuple(r)[:5] for r in got.collect()) == want_bytes(corpus())


@pytest.mark.parametrize("limits", [{}, {"group_limit": 2, "bucket_bytes": 4000}])
def test_words(docs, limits):
    got = op8.remove_repeats(docs, **limits)
    assert Counter(tuple(r)[:4] for r in got.collect()) == want_words(corpus())


def test_empty(no_docs):
    assert op4.remove_repeats(no_docs).count() == 0
    assert op8.remove_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(40))
def test_indexes_on_random_sequences(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, r.integers(1, 5) + 1, 60)
    texts = []
    for _ in range(r.integers(1, 6)):
        at = r.integers(0, 40)
        x = base[at:at + r.integers(0, 40)].copy()
        if len(x) and r.random() < 0.5:
            x[r.integers(0, len(x))] = 7
        texts.append(bytes(x.tolist()))
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    units = np.frombuffer(b"".join(texts), np.uint8)
    window = int(r.integers(1, 12))
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    want = [i + window <= len(t) and seen[t[i:i + window]] > 1 for t in texts for i in range(len(t))]
    assert op4.repeated_bytes(units, off, window).tolist() == want
    assert op8.repeated_words(units.astype(np.uint64), off, window).tolist() == want


def test_hot_passage_goes_down_the_ladder(spark, monkeypatch):
    """A passage in more documents than a group may hold, each time between other neighbours: cells, then single windows."""
    import random

    r = random.Random(9)
    passage = "".join(r.choice("abcdefgh ") for _ in range(700))
    rows = []
    for k in range(op4_limit() + 300):
        head, tail = ("".join(r.choice("abcdefghijkl ") for _ in range(r.randrange(250))) for _ in "ab")
        cut = passage if k % 3 else passage[r.randrange(60):]
        rows.append((k, head + cut + tail))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    steps = []
    from opsanalytics.llm import repeats

    cells = repeats._cells
    monkeypatch.setattr(repeats, "_cells", lambda units, width: steps.append(width) or cells(units, width))
    got = op4.remove_repeats(docs)
    assert Counter(tuple(x)[:5] for x in got.collect()) == want_bytes(rows)
    assert len(steps) >= 2


def test_long_groups_get_longer_prefixes(spark, monkeypatch):
    """A passage of words in more documents than a group may hold: prefixes of 18, 27, 32 and 35 words, subtrees in between."""
    import random

    r = random.Random(3)

    def words(n):
        return [r.choice("ab cd ef gh ij kl mn op".split()) + str(r.randrange(40)) for _ in range(n)]

    passage = words(60)
    rows = [(k, " ".join([*words(r.randrange(12)), *passage[r.randrange(20) if k % 4 else 0:r.randrange(40, 61)], *words(r.randrange(9))]))
            for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    steps = []
    from opsanalytics.llm import repeats

    cells = repeats._cells
    monkeypatch.setattr(repeats, "_cells", lambda units, width: steps.append(width) or cells(units, width))
    for limit in (3, 60, 250):
        steps.clear()
        got = op8.remove_repeats(docs, group_limit=limit)
        assert Counter(tuple(x)[:4] for x in got.collect()) == want_words(rows)
        assert steps == [18, 9, 4, 1][:len(steps)] and steps


def op4_limit() -> int:
    from opsanalytics.llm.repeats import GROUP_LIMIT

    return GROUP_LIMIT
