"""Suffix order by prefix doubling: equal to sorting, and only shared ranks are ordered again."""

import numpy as np
import pytest

from opsanalytics.llm import op4_run_index as op4
from opsanalytics.llm.ranks import common_prefixes, suffix_ranks


def texts(rng, dtype, alphabet):
    base = rng.integers(0, alphabet, 300).astype(dtype)
    cut = [base[a:a + m] for a, m in zip(rng.integers(0, 200, 12), rng.integers(0, 100, 12), strict=True)]
    return np.concatenate(cut), np.concatenate([[0], np.cumsum([len(t) for t in cut])]).astype(np.int64)


@pytest.mark.parametrize("dtype", [np.uint8, np.uint64])
@pytest.mark.parametrize("alphabet", [1, 2, 30])
def test_order_and_prefixes_equal_sorting(dtype, alphabet):
    units, off = texts(np.random.default_rng(alphabet), dtype, alphabet)
    end = np.repeat(off[1:], np.diff(off))
    suffix = [tuple(units[i:end[i]].tolist()) for i in range(len(units))]
    order, levels = suffix_ranks(units, off, int(np.diff(off).max()))
    assert order.tolist() == sorted(range(len(units)), key=lambda i: (suffix[i], i))
    for a, b, n in zip(order[:-1], order[1:], common_prefixes(order[:-1], order[1:], off, levels), strict=True):
        same = next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b], strict=False)) if x != y), None)
        assert n == same if same is not None else n >= min(len(suffix[a]), len(suffix[b]))


def test_no_level_past_the_one_where_all_ranks_differ():
    units = np.random.default_rng(5).integers(0, 256, 5_000).astype(np.uint8)
    _, levels = suffix_ranks(units, np.array([0, 2_500, 5_000]), 2_500)
    assert [w for w, _ in levels] == [1, 2, 4, 7]


def test_common_prefixes_are_counted_once(monkeypatch):
    calls = []
    monkeypatch.setattr(op4, "common_prefixes", lambda *a: calls.append(1) or common_prefixes(*a))
    units, off = texts(np.random.default_rng(2), np.uint8, 3)
    op4.RunIndex(units, off)
    assert len(calls) == 1
