"""Exact deduplication against brute force."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opsanalytics.llm import op1_exact_dedup as op1

from .conftest import corpus, prose


def want():
    groups = defaultdict(list)
    for i, t in corpus():
        t = t or ""
        groups[re.sub(r"[\x20\x09-\x0D]+", "", t)].append((-len(t), i is None, i))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest()) for _, _, i in members]
    return sorted(map(str, out))


LADDERS = {
    "ordinary": op1.LADDER,
    "first digest always clashes": (F.length, lambda c: F.substring(c, 1, 3), F.md5),
    "chunks themselves": (F.length, lambda c: c),
}


@pytest.mark.parametrize("ladder", LADDERS.values(), ids=LADDERS)
def test_groups(docs, ladder):
    got = op1.exact_dedup(docs, ladder=ladder)
    assert got.columns[:5] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == want()


def test_no_verified_digest(docs):
    with pytest.raises(ValueError, match="ladder"):
        op1.exact_dedup(docs, ladder=(F.length,))


def test_empty(no_docs):
    assert op1.exact_dedup(no_docs).count() == 0


def test_chunks_follow_content():
    whole = re.compile(op1.CHUNK)
    text = prose(5, 6000).replace(" ", "")
    a, b = ({m.group() for m in whole.finditer(t)} for t in (text, "prefix" + text))
    assert "".join(m.group() for m in whole.finditer(text)) == text
    assert len(a & b) > len(a) / 2


def test_native_plan(docs):
    plan = op1.exact_dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
