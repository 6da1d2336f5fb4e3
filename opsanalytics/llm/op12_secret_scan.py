"""Secret scan with multipart credential linking.

A task reads each text once and returns its spans (code points, end exclusive):

* base kinds, always reported: ``assign`` (a named value), ``access`` (an access
  identifier), ``hex`` (a long hexadecimal run);
* weak candidates, reported only next to what completes them: ``login`` (a named user or
  client) needs a secret, ``key`` (an unnamed random-looking run outside all base spans)
  needs an identifier, ``endpoint`` (an address with a scheme) needs both.

Identifiers are access and login, secrets are assign, hex and key.  Parts complete each
other within one scope (a paragraph: text without an empty line) at a distance of at most
``REACH`` code points.  That is an interval join: both sides are dealt into bins of
``REACH`` code points of their scope, the candidates to the neighbouring bins as well, and
a left semi join on the bin keeps a candidate as soon as one part lies near, so a bin's
pairs are never listed and no bin holds more than its code points allow.

Defined cases: a null text is empty and has no spans; spans of one kind never overlap,
those of different kinds may; spans are ordered by start, then kind as listed, then end;
rows that repeat id and text have equal results, each its own row; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import row_key, saved, table, text_of

KINDS = ("assign", "access", "hex", "login", "key", "endpoint")
BASE = 3  # the first kinds are reported always
IDENTIFIER, SECRET = 1, 2
ROLE = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, 0)
NEEDS = (0, 0, 0, SECRET, IDENTIFIER, IDENTIFIER | SECRET)
REACH = 200

# Fixed patterns of the base kinds; a match that fails its length is dropped after it was consumed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
# Runs are maximal, so their least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LOGIN = r"""(client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})"""
KEY = r"[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x20\x09-\x0D"'<>]+"""
BLANK = r"\n[\x20\x09\x0D]*\n"

_ASSIGN, _LOGIN = (re.compile(p, re.ASCII | re.IGNORECASE) for p in (ASSIGN, LOGIN))
_ACCESS, _HEX, _KEY, _ENDPOINT, _BLANK = (re.compile(p) for p in (ACCESS, HEX, KEY, ENDPOINT, BLANK))
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LOGINS = ("client", "user", "login", "account")
_MIXED = [re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]")]

Span = tuple[int, int, int]


def spans_of(text: str) -> list[Span]:
    """All spans of a text as (start, kind, end): base ones, and candidates not yet linked."""
    out: list[Span] = []
    low = text.lower()
    named = "=" in text or ":" in text
    if named and any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base = sorted((a, b) for a, _, b in out)
    if named and any(n in low for n in _LOGINS):
        out += [(m.start(), 3, m.end()) for m in _LOGIN.finditer(text)]
    for m in _KEY.finditer(text):
        run = m.group()
        if all(p.search(run) for p in _MIXED) and not _meets(base, m.start(), m.end()):
            out.append((m.start(), 4, m.end()))
    if "://" in text:
        out += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    return sorted(out)


def _meets(base: list[tuple[int, int]], a: int, b: int) -> bool:
    return any(x < b and a < y for x, y in base)


FOUND = "doc_id bigint, key bigint, spans array<struct<start:int,kind:int,end:int,scope:int>>"
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("scope", pa.int32())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = []
        for text in batch.column("text"):
            whole = text.as_py()
            spans = spans_of(whole)
            breaks = [m.start() for m in _BLANK.finditer(whole)] if len(spans) > 1 else []
            lists.append([{"start": a, "kind": k, "end": b, "scope": bisect_right(breaks, a)} for a, k, b in spans])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(lists, pa.list_(_SPAN))],
                                         names=["doc_id", "key", "spans"])


def _table(values: tuple[int, ...], kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), kind + 1)


def _bins(start: Column, end: Column, reach: int) -> Column:
    return F.explode(F.sequence(F.floor(start / reach).cast("int"), F.floor(end / reach).cast("int")))


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, key, added): the weak candidates that have all the parts they need, per document with any."""
    roles = F.transform("spans", lambda s: _table(ROLE, s["kind"]))
    hopeful = found.where(F.exists("spans", lambda s: s["kind"] >= BASE) & F.array_contains(roles, IDENTIFIER) & F.array_contains(roles, SECRET))
    # Rows that repeat id and text have the same parts: each once.
    parts = saved(hopeful.select("doc_id", "key", F.inline("spans")).distinct(), "parts")
    weak = parts.where(F.col("kind") >= BASE).select(
        "*", _table(NEEDS, F.col("kind")).alias("needs"), _bins(F.col("start") - reach, F.col("end") + reach, reach).alias("bin"))
    others = parts.select("doc_id", "key", "scope", F.col("start").alias("a"), F.col("end").alias("b"),
                          _table(ROLE, F.col("kind")).alias("role"), _bins(F.col("start"), F.col("end"), reach).alias("bin")).alias("o")
    met = None
    for role in (IDENTIFIER, SECRET):
        w = weak.where(F.col("needs").bitwiseAND(role) > 0).alias("w")
        near = [F.col("w.doc_id").eqNullSafe(F.col("o.doc_id")), *[F.col(f"w.{c}") == F.col(f"o.{c}") for c in ("key", "scope", "bin")],
                F.col("o.a") <= F.col("w.end") + reach, F.col("o.b") >= F.col("w.start") - reach]
        hit = (w.join(others.where(F.col("role") == role), near, "left_semi")
               .select("doc_id", "key", "start", "kind", "end", "needs").distinct().withColumn("role", F.lit(role)))
        met = hit if met is None else met.unionByName(hit)
    whole = met.groupBy("doc_id", "key", "start", "kind", "end", "needs").agg(F.sum("role").alias("met")).where("met = needs")
    return whole.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, base and spans as arrays of (start, kind, end), kind an index into ``KINDS``."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), row_key(id_col, text_col).alias("key"), text_of(text_col).alias("text"))
    found = saved(src.mapInArrow(_scan, FOUND), "spans")
    plain = F.transform(F.filter("spans", lambda s: s["kind"] < BASE), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    rows = found.select(found.doc_id, "key", plain.alias("base")).alias("f")
    added = linked(found, reach).alias("l")
    on = [F.col("f.doc_id").eqNullSafe(F.col("l.doc_id")), F.col("f.key") == F.col("l.key")]
    both = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return rows.join(added, on, "left").select(F.col("f.doc_id"), "base", both.alias("spans"))


def _sql() -> str:
    """Positions by marking every match, cutting the text at the marks and adding up the lengths."""
    def matches(kind: int, pattern: str, least: str = "") -> str:
        mark = f"regexp_replace(text, '{pattern}', chr(57344) || '\\0' || chr(57345), 'g')".replace("''", "''")
        return f"""
p{kind} AS (SELECT r, unnest(x[2:]) AS piece, unnest(range(1, len(x))) AS i, x[1] AS opening
       FROM (SELECT r, string_split({mark}, chr(57344)) AS x FROM d) WHERE len(x) > 1),
q{kind} AS (SELECT r, i, strpos(piece, chr(57345)) - 1 AS n, substr(piece, 1, strpos(piece, chr(57345)) - 1) AS hit,
       length(opening) + sum(length(piece) - 1) OVER (PARTITION BY r ORDER BY i) - (length(piece) - 1) AS a FROM p{kind}),
s{kind} AS (SELECT r, a::INTEGER AS a, {kind} AS kind, (a + n)::INTEGER AS b, hit FROM q{kind} {least})"""

    def quoted(pattern: str) -> str:
        return pattern.replace("'", "''")

    value = quoted("^[^:=]*[:=] *[\"']?")
    named = [f"WHERE length(regexp_replace(hit, '{value}', '')) >= {ASSIGN_LEAST}"]
    blocks = [matches(0, "(?i:" + quoted(ASSIGN[:ASSIGN.index("[\"")]) + ")" + quoted(ASSIGN[ASSIGN.index("[\""):]), named[0]),
              matches(1, ACCESS), matches(2, HEX),
              matches(3, "(?i:" + quoted(LOGIN[:LOGIN.index("[\"")]) + ")" + quoted(LOGIN[LOGIN.index("[\""):])),
              matches(4, KEY, """WHERE regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]')
       AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = q4.r AND base.a < q4.a + q4.n AND q4.a < base.b)"""),
              matches(5, quoted(ENDPOINT))]
    breaks = matches(9, quoted(BLANK))
    return ("WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)," + ",".join(blocks[:3]) + """,
base AS (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2),""" + ",".join([*blocks[3:], breaks]) + f""",
every AS (SELECT * FROM base UNION ALL SELECT * FROM s3 UNION ALL SELECT * FROM s4 UNION ALL SELECT * FROM s5),
placed AS (SELECT r, a, kind, b, (SELECT count(*) FROM s9 WHERE s9.r = every.r AND s9.a <= every.a) AS scope,
       kind IN (1, 3) AS identifier, kind IN (0, 2, 4) AS secret FROM every),
near AS (SELECT w.r, w.a, w.kind, w.b, bool_or(o.identifier) AS identifier, bool_or(o.secret) AS secret
       FROM placed w JOIN placed o ON w.r = o.r AND w.scope = o.scope AND o.a <= w.b + {REACH} AND o.b >= w.a - {REACH}
       WHERE w.kind >= 3 GROUP BY ALL),
told AS (SELECT r, a, kind, b FROM base UNION ALL SELECT r, a, kind, b FROM near
       WHERE (kind = 3 AND secret) OR (kind = 4 AND identifier) OR (kind = 5 AND identifier AND secret)),
out AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       string_agg(t, ',' ORDER BY a, kind, b) FILTER (kind < 3) AS base, string_agg(t, ',' ORDER BY a, kind, b) AS spans
       FROM (SELECT *, ['{"','".join(KINDS)}'][kind + 1] || ':' || a || ':' || b AS t FROM told) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN out USING (r)
""")


@corpus_query("op12_secret_scan", _sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    counts = [_count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return rows.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
