"""Secret scan against brute force over all pairs of parts."""

import random
import re
from collections import Counter

import pytest

from opsanalytics.llm import op12_secret_scan as op12

from .conftest import corpus

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|"""
                    r"""(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""")
BASES = [(0, ASSIGN, 2, 8), (1, re.compile("AKIA[A-Z0-9]+"), 0, 16), (2, re.compile("[0-9a-f]+"), 0, 32)]


def base_of(text):
    return sorted((m.start(), k, m.end()) for k, p, g, least in BASES for m in p.finditer(text) if m.end(g) - m.start(g) >= least)


def want_spans(text):
    """Base spans by the plain patterns, candidates by a look at every other span."""
    every = base_of(text) + [s for s in op12.spans_of(text) if s[1] >= 3]
    breaks = [m.start() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = {s: sum(b <= s[0] for b in breaks) for s in every}
    out = []
    for a, k, b in every:
        near = {op12.ROLE[j] for x, j, y in every if scope[x, j, y] == scope[a, k, b] and x <= b + op12.REACH and y >= a - op12.REACH}
        if all(role in near for role in (1, 2) if op12.NEEDS[k] & role):
            out.append((a, k, b))
    return sorted(out)


SECRET = "wJalrXUtnFEMI0K7MDENGbPxRfiCYEXAMPLEKEY"
CASES = [
    ('password = "hunter2hunter2"', ["assign"]),
    ("password: short", []),
    ("TOKEN==abcdefgh", ["assign"]),
    ("token=passwd:abcdefgh1", []),  # the failing match is consumed
    ("paſſword=abcdefghij Key", []),  # letters that only fold to ASCII
    ("AKIA" + "Q" * 11 + " AKIA" + "Q" * 12, ["access"]),
    ("f" * 31 + "g" + "0" * 32, ["hex"]),
    ("key " + SECRET, []),
    ("user: bob", []),
    ("see https://example.org/a", []),
    (f"user: bob, key {SECRET}", ["login", "key"]),
    (f"AKIA{'Q' * 12} {SECRET} https://example.org/a", ["access", "key", "endpoint"]),
    (f"AKIA{'Q' * 12}\n \n{SECRET}", ["access"]),  # another paragraph
    (f"AKIA{'Q' * 12}{' ' * 200}{SECRET}", ["access", "key"]),
    (f"AKIA{'Q' * 12}{' ' * 201}{SECRET}", ["access"]),
    ("user=ann https://example.org password=longenough1", ["login", "endpoint", "assign"]),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_brute_force_cases(k):
    text, kinds = CASES[k]
    assert [op12.KINDS[s[1]] for s in want_spans(text)] == kinds


def mixed(seed: int) -> str:
    r = random.Random(seed)
    parts = ["user: bob", "client_id=abc.def", SECRET, SECRET[::-1], "AKIA" + "Z" * 14, "https://h.example/x", "ftp://a", "secret='abcdefgh.1'",
             "0123456789abcdef" * 2, "\n\n", "\n \t\n", " x" * 40, "é日本🙂" * 20, "passwd:short", " "]
    return "".join(r.choice(parts) + r.choice([" ", ", ", "\n"]) for _ in range(r.randrange(60)))


def test_scan(spark):
    rows = corpus() + [(1000 + k, t) for k, (t, _) in enumerate(CASES)] + [(2000 + k, mixed(k)) for k in range(60)]
    rows += [(2001, mixed(1)), (None, mixed(2)), (None, mixed(2)), (3000, mixed(3) * 300)]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id bigint, text string, key string, start int").repartition(3)
    got = Counter((r.doc_id, tuple(map(tuple, r.base)), tuple(map(tuple, r.spans))) for r in op12.scan(docs).collect())
    assert got == Counter((i, tuple(base_of(t or "")), tuple(want_spans(t or ""))) for i, t in rows)


def test_empty(no_docs):
    assert op12.scan(no_docs).count() == 0
