"""Encoding equals the library's; chunks never change it; decoding restores every text."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from opsanalytics.llm import op6_pieces as op6

from .conftest import corpus

ALPHABET = ["the", "ing", " ", "  ", "\n", "é", "ß", "日本", "▁", "\0", "a", "b", "in", "er", "🙂", "\t", "tion", "xyz", "AAAA", "0", "12", "   ", "_", " "]


@pytest.fixture(scope="module")
def model():
    return op6.pieces(op6.MODEL)


def chunked(m, text, size):
    whole, margin = " " + text, m.longest
    cuts = range(0, len(whole), size)
    rows = [(k, a - max(0, a - margin), min(a + size, len(whole)) - max(0, a - margin), op6.marked(whole[max(0, a - margin):a + size + margin]))
            for k, a in enumerate(cuts)]
    last = len(rows) - 1
    pairs = [sum([[a, x, b, y] for (a, x), (b, y) in op6.transfer(m, t, lo, hi, k == 0, k == last)], []) for k, lo, hi, t in rows]
    states = op6.scan(pd.DataFrame({"rid": 0, "chunk": range(len(rows)), "pairs": pairs}))
    return np.concatenate([
        op6.backtrace(m, t, lo, hi, (s.in_token, s.in_over), (s.out_token, s.out_over), k == last)
        for (k, lo, hi, t), s in zip(rows, states.itertuples(), strict=True)]).tolist()


@pytest.mark.parametrize("seed", range(60))
def test_random_texts(model, seed):
    r = random.Random(seed)
    text = "".join(r.choice(ALPHABET) for _ in range(r.randint(1, 60)))
    if seed % 3 == 0:
        text = text.replace(" ", "").replace("\n", "") or "a"
    ids = model.encode(text).tolist()
    assert model.decode(ids) == text
    if "▁" not in text:
        assert ids == model.sp.encode(text)
    for size in (7, 20, 33):
        assert chunked(model, text, size) == ids


def test_products_are_associative(model):
    r = random.Random(1)
    a, b, c = (frozenset(((r.randrange(4), 0), (r.randrange(4), 0)) for _ in range(6)) for _ in range(3))
    assert op6.product(op6.product(a, b), c) == op6.product(a, op6.product(b, c))


@pytest.mark.parametrize("chunk", [op6.CHUNK, 60])
def test_table(docs, model, chunk):
    got = op6.decode(op6.encode(docs, chunk=chunk)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in corpus())
    for r in got:
        assert r["decoded"] == r["text"]
        assert r["ids"] == model.sp.encode(r["text"])


def test_empty(no_docs):
    assert op6.decode(op6.encode(no_docs)).count() == 0
