"""SentencePiece encoding and decoding of whole texts, giant ones as a max-plus scan over chunks.

The result is the library's own for the given model.  A byte-pair encoding is the only
token sequence of a text in which every two neighbours are *compatible*, that is, in which
encoding the two tokens' text gives just these two.  (The first merge across a token
border of the whole text would also be the first one when the two tokens stand alone.)
So the encoding is the best path through the token lattice with weight 0 for compatible
neighbours and minus infinity otherwise, and the max-plus products below hold exactly the
pairs of weight 0.

- A text of at most ``chunk`` characters is encoded in one step, word by word: no piece
  crosses from a non-space to a space, and a character without a piece of its own stands
  alone as its bytes, so words are independent and are looked up once each.
- A longer text is cut into chunks.  The state at a cut is the token that starts before it
  and how far it reaches past it.  Each chunk by itself gives its transfer matrix between
  the states at its two cuts; only characters up to the first and from the last word border
  matter.  The matrices of a text, some dozens of entries each, are combined associatively
  from both sides; where forward and backward vectors meet lies each chunk's entry and exit
  state, and every chunk is backtraced by itself.

Defined cases: null and empty texts have no token; the character U+2581 (the library's own
space mark) is encoded as its three bytes, so that decoding always restores the text; rows
repeating id and text are encoded separately; an empty table gives an empty result; further
columns are ignored by ``encode``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import saved, table, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 16
SPACE = "▁"
LITERAL = "\ud800"
BORDER = -1  # the state at a word border: compatible with every token
CACHED = 400_000


class Pieces:
    """A byte-pair SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(size)]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(pieces) if self.sp.is_byte(i)}
        normal = [i for i in range(size) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i))]
        self.id_of = {pieces[i]: i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of) or self.sp.encode("\n")[1:] != [self.byte_id[10]]:
            raise ValueError("pieces of this model cross word borders")
        self.longest = max(map(len, self.id_of))
        self.raw = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, i in self.byte_id.items():
            self.raw[i] = bytes([b])
        self.words: dict[str, bytes] = {}
        self.compatible_pairs: dict[tuple[int, int], bool] = {}

    def bare(self, text: str) -> list[int]:
        """Ids of ``text`` (spaces as spaces) without the space that encoding puts first."""
        return self.sp.encode("\n" + text)[2:]

    def _word(self, word: str) -> bytes:
        """Ids, as int32 bytes, of one space and ``word``; ``word`` may start with more spaces and hold line breaks."""
        if SPACE in word:
            mark = np.array([self.byte_id[b] for b in SPACE.encode()], np.int32).tobytes()
            head, *rest = word.split(SPACE)
            return self._word(head) + b"".join(mark + np.array(self.bare(r), np.int32).tobytes() for r in rest)
        head, *rest = word.split("\n")
        out = self._look_up(" " + head)
        if rest:
            line = np.int32(self.byte_id[10]).tobytes()
            out += b"".join(line + self._look_up(r) for r in rest)
        return out

    def _look_up(self, part: str) -> bytes:
        ids = self.words.get(part)
        if ids is None:
            ids = np.array(self.bare(part), np.int32).tobytes() if part else b""
            if len(self.words) >= CACHED:
                self.words.clear()
            self.words[part] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, or of a stretch between word borders that starts with a space left out here."""
        if not text:
            return np.zeros(0, np.int32)
        parts = text.split(" ")
        if "" in parts:
            parts = [p[1:] for p in re.findall(" +[^ ]*", " " + text)]
        known = self.words
        out = [known.get(" " + p) or self._word(p) for p in parts]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids])[1:].decode()

    # Lattice of a stretch without word border. Tokens are ids; a character without a piece is -2 - code point.

    def tokens_at(self, text: str, at: int, end: int) -> list[tuple[int, int]]:
        found = [(i, k) for k in range(1, min(self.longest, end - at) + 1)
                 if (i := self.id_of.get(text[at:at + k])) is not None]
        if not found or found[0][1] != 1:
            found.append((-2 - ord(text[at]), 1))
        return found

    def compatible(self, a: int, b: int) -> bool:
        if a < 0 or b < 0:
            return True
        ok = self.compatible_pairs.get((a, b))
        if ok is None:
            ok = self.bare((self.raw[a] + self.raw[b]).decode()) == [a, b]
            self.compatible_pairs[a, b] = ok
        return ok

    def expand(self, tokens: list[int]) -> list[int]:
        out = []
        for t in tokens:
            out += [t] if t >= 0 else [self.byte_id[b] for b in chr(-2 - t).replace(LITERAL, SPACE).encode()]
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


State = tuple[int, int]  # token that starts before a cut, characters it reaches past it


def marked(text: str) -> str:
    """Spaces as the space mark, and a literal space mark as a lone surrogate, which no text holds."""
    return text.replace(SPACE, LITERAL).replace(" ", SPACE)


def states_at(m: Pieces, text: str, cut: int) -> list[State]:
    """Every token that can start before ``cut`` and end at or after it."""
    out = []
    for start in range(max(0, cut - m.longest), cut):
        out += [(t, start + k - cut) for t, k in m.tokens_at(text, start, len(text)) if start + k >= cut]
    return out


def walk(m: Pieces, text: str, lo: int, hi: int, starts: list[State], end: int):
    """Per position and last token, the starts (as bits) that reach it, over tokens that start before ``hi``."""
    reach: dict[int, dict[int, int]] = {}
    back: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for bit, (t, over) in enumerate(starts):
        at = reach.setdefault(lo + over, {})
        at[t] = at.get(t, 0) | 1 << bit
    for p in range(lo, hi):
        for t, k in m.tokens_at(text, p, end) if p in reach else ():
            bits = 0
            for last, b in reach[p].items():
                if last == BORDER or m.compatible(last, t):
                    bits |= b
                    back.setdefault((p + k, t), []).append((p, last))
            if bits:
                at = reach.setdefault(p + k, {})
                at[t] = at.get(t, 0) | bits
    return reach, back


def borders(text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """First and last word border (a space after a non-space) in [lo, hi)."""
    first = re.compile(f"(?<=[^{SPACE}]){SPACE}").search(text, max(lo, 1), hi)
    if first is None:
        return None
    last = hi - 1
    while not (text[last] == SPACE and text[last - 1] != SPACE):
        last -= 1
    return first.start(), last


def transfer(m: Pieces, text: str, lo: int, hi: int, first: bool, last: bool) -> list[tuple[State, State]]:
    """State pairs of weight 0 between the cuts at ``lo`` and ``hi``; ``text`` reaches past both."""
    ins = [(BORDER, 0)] if first else states_at(m, text, lo)
    cut = borders(text, lo, hi)

    def outs(reach) -> list[tuple[State, int]]:
        return [((t, p - hi) if not last else (BORDER, 0), bits) for p, at in reach.items() if p >= hi for t, bits in at.items()]

    if cut is None:
        ends = outs(walk(m, text, lo, hi, ins, len(text))[0])
        return sorted({(s, o) for o, bits in ends for k, s in enumerate(ins) if bits >> k & 1})
    head = walk(m, text, lo, cut[0], ins, cut[0])[0].get(cut[0], {})
    ok = 0
    for bits in head.values():
        ok |= bits
    tail = outs(walk(m, text, cut[1], hi, [(BORDER, 0)], len(text))[0])
    return sorted({(s, o) for k, s in enumerate(ins) if ok >> k & 1 for o, _ in tail})


def path(m: Pieces, text: str, lo: int, hi: int, start: State, exit_: State | None, end: int) -> list[int]:
    """Tokens that start in [lo, hi) on the path from ``start`` to ``exit_`` (any token ending at ``hi`` if None)."""
    reach, back = walk(m, text, lo, hi, [start], end)
    if exit_ is None:
        (node,) = [(hi, t) for t in reach.get(hi, {})]
    else:
        node = (hi + exit_[1], exit_[0])
    out = []
    begin = (lo + start[1], start[0])
    while node != begin:
        out.append(node[1])
        (node,) = [x for x in back[node] if reach[x[0]].get(x[1])]
    return out[::-1]


def backtrace(m: Pieces, text: str, lo: int, hi: int, start: State, exit_: State, last: bool) -> np.ndarray:
    """Ids of the tokens that start in the chunk, given its entry and exit states."""
    target = None if last else exit_
    cut = borders(text, lo, hi)
    if cut is None:
        return np.array(m.expand(path(m, text, lo, hi, start, target, len(text))), np.int32)
    plain = text.replace(SPACE, " ").replace(LITERAL, SPACE)
    head = m.expand(path(m, text, lo, cut[0], start, None, cut[0]))
    middle = m.encode(plain[cut[0] + 1:cut[1]]) if cut[1] > cut[0] else np.zeros(0, np.int32)
    tail = m.expand(path(m, text, cut[1], hi, (BORDER, 0), target, len(text)))
    return np.concatenate([np.array(head, np.int32), middle, np.array(tail, np.int32)])


def _ids_array(parts: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


def _encode_whole(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [m.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, _ids_array(ids)], names=[*part.schema.names, "ids"])
    return run


CHUNKS = "rid bigint, chunk int, chunks int, lo int, hi int, text string"


def _cut(chunk: int, margin: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text"), strict=True):
                whole = " " + text.as_py()
                n = -(-len(whole) // chunk)
                for k in range(n):
                    a, b = k * chunk, min((k + 1) * chunk, len(whole))
                    lo = max(0, a - margin)
                    yield pa.RecordBatch.from_pydict({
                        "rid": [rid], "chunk": pa.array([k], pa.int32()), "chunks": pa.array([n], pa.int32()),
                        "lo": pa.array([a - lo], pa.int32()), "hi": pa.array([b - lo], pa.int32()),
                        "text": [whole[lo:b + margin]]})
    return run


def _transfers(model: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = pieces(model)
        for pdf in batches:
            rows = [[[a, x, b, y] for (a, x), (b, y) in transfer(m, marked(r.text), r.lo, r.hi, r.chunk == 0, r.chunk == r.chunks - 1)]
                    for r in pdf.itertuples()]
            yield pd.DataFrame({"rid": pdf["rid"], "chunk": pdf["chunk"], "pairs": [sum(r, []) for r in rows]})
    return run


def product(a: frozenset, b: frozenset) -> frozenset:
    """Max-plus product of two transfer matrices given by their pairs of weight 0."""
    by_start: dict[State, list[State]] = {}
    for s, o in b:
        by_start.setdefault(s, []).append(o)
    return frozenset((s, o) for s, mid in a for o in by_start.get(mid, ()))


def scan(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of every chunk of one text."""
    pdf = pdf.sort_values("chunk")
    matrices = []
    for flat in pdf["pairs"]:
        q = np.asarray(flat, np.int64).reshape(-1, 4).tolist()
        matrices.append(frozenset(((a, x), (b, y)) for a, x, b, y in q))
    ahead = [{o for _, o in p} for p in accumulate(matrices, product)]
    behind = [{s for s, _ in p} for p in accumulate(matrices[::-1], lambda b, a: product(a, b))][::-1]
    exits = [next(iter(f & b)) for f, b in zip(ahead, [*behind[1:], ahead[-1]], strict=True)]
    entries = [(BORDER, 0), *exits[:-1]]
    return pd.DataFrame({"rid": pdf["rid"], "chunk": pdf["chunk"], "in_token": [s[0] for s in entries], "in_over": [s[1] for s in entries],
                         "out_token": [s[0] for s in exits], "out_over": [s[1] for s in exits]})


def _backtraces(model: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = pieces(model)
        for pdf in batches:
            ids = [backtrace(m, marked(r.text), r.lo, r.hi, (r.in_token, r.in_over), (r.out_token, r.out_over), r.chunk == r.chunks - 1)
                   for r in pdf.itertuples()]
            yield pd.DataFrame({"rid": pdf["rid"], "chunk": pdf["chunk"], "ids": ids})
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, text, ids."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    schema = "doc_id bigint, text string, ids array<int>"
    short = src.where(F.length("text") < chunk).mapInArrow(_encode_whole(model), schema)
    long = saved(src.where(F.length("text") >= chunk).withColumn("rid", F.monotonically_increasing_id()), "long-texts")
    cut = saved(long.select("rid", "text").mapInArrow(_cut(chunk, pieces(model).longest), CHUNKS), "chunks")
    moves = cut.mapInPandas(_transfers(model), "rid bigint, chunk int, pairs array<int>")
    states = saved(moves.groupBy("rid").applyInPandas(
        scan, "rid bigint, chunk int, in_token int, in_over int, out_token int, out_over int"), "states")
    traced = cut.join(states, ["rid", "chunk"]).mapInPandas(_backtraces(model), "rid bigint, chunk int, ids array<int>")
    ids = traced.groupBy("rid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    return short.unionByName(long.join(ids, "rid").select("doc_id", "text", "ids"))


def _decode(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [m.decode(x) if x else "" for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])
    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of ``ids``; null ids give an empty text."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), "decoded string"])
    return encoded.mapInArrow(_decode(model), schema)


@corpus_query("op6_pieces")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decode(encode(table(spark, sf_dir, "documents")))
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.col("text")).alias("restored"))
