"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from opsanalytics.llm import op11_spelling_variants as op11

from .conftest import corpus


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def want(rows, least=7, ratio=10):
    n = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2 and len(w) >= least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), form[w] and n[form[w]]))
    return Counter(out)


def vocabulary_rows(seed: int) -> list[tuple]:
    """Families of words with edits at every place, chains of counts, hot prefixes and letters beyond ASCII."""
    r = random.Random(seed)
    letters = "abcxyzéßÿ×"
    rows = [(None, None), (3, ""), (5, "Ünïcode " * 9 + "ünïcode ünïcodes " * 2)]
    for k in range(30):
        base = "common" + "".join(r.choice(letters) for _ in range(r.randrange(1, 9))) if k % 3 else "".join(r.choice("ab") for _ in range(9))
        rows.append((k, (base + " ") * r.choice([2, 3, 30, 400])))
        for _ in range(12):
            i, c = r.randrange(len(base) + 1), r.choice(letters)
            word = r.choice([base[:i] + c + base[i:], base[:i] + c + base[i + 1:], base[:i] + base[i + 1:]])
            rows.append((100 + k, f"{word.capitalize()}, {word}! " * r.choice([1, 2, 40])))
            base = word if r.random() < 0.3 else base
    rows += [(900 + k, "chainword " + "chainwordy " * 15 + "chainwordyz " * 200) for k in range(3)]
    long = "a" * 3000
    return [*rows, (7, f"{long} {long} {long}b {long}b b{long} b{long}"), (7, f"{long} {long}")]


@pytest.mark.parametrize("limits", [{}, {"limit": 3, "bucket_rows": 50}])
@pytest.mark.parametrize("seed", [1, 2])
def test_variants(spark, seed, limits):
    rows = vocabulary_rows(seed)
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id bigint, text string, word string, n int").repartition(3)
    got = Counter(tuple(r) for r in op11.variants(docs, **limits).collect())
    assert got == want(rows)
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of two


def test_short_words(spark):
    rows = vocabulary_rows(3) + corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(tuple(r) for r in op11.variants(docs, least=2, limit=10).collect()) == want(rows, least=2)


def test_empty(no_docs):
    assert op11.variants(no_docs).count() == 0
