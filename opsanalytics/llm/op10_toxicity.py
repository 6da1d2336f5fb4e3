"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are mapped to symbols by a lexicon; a cascade of finite-state transducers rewrites the
symbol sequence, and their composition, built once as one machine, runs over every text:

- negation marks an insult or threat that stands within two words after a negation;
- reported speech marks what follows a verb of saying, or stands in quotation marks;
- target marks an insult in a clause that has named a target before it, and a target that
  follows an insult;
- threat marks a threat word only together with a target in its clause.

Each match adds its word's learnt weight times the factor of its marks; clause scores
(largest, and sum) go through a logistic curve fitted on the training sample.

Insults are learnt: words, and word beginnings shared by several words, whose presence in
toxic training documents, in different surroundings, is far beyond chance (``EVIDENCE``).
Threat words are learnt in the same way from what insults leave unexplained: clauses that name a
target and hold no insult, where a word must also stand out more than it does elsewhere
(``LIFT``).  A short list of threats starts with the weight ``SEED``, as two documents' worth of
evidence that the sample can outweigh.  The factors of the marks are fitted on the sample, drawn to
their start values by ``PULL``.  Functional words (targets, negations, verbs of saying) are short fixed
lists in four languages.  Learning uses a bounded sample of labelled training rows, about ``SAMPLE``
toxic and three times as many other documents, chosen by a hash of the id.  Scoring reads every text
whole.

Defined cases: a null or empty text has no match; without training rows of both labels
every score is the share of label 1 (0.5 without any); rows repeating an id are scored
each; labels that are null are not learnt from; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import held_out, packed, saved, table, with_row

SAMPLE, CUT = 8000, 0.7
STEMS = range(4, 8)
EVIDENCE, RATIO, FAMILY = 20.0, 3.5, 4

TARGETS = "you your yours yourself they them their he she him her du dich dir ihr euch sie tu toi te vous ils elles tú ti usted ustedes ellos ellas"
NEGATIONS = "not never no nobody isn't aren't wasn't don't nicht nie kein keine niemals ne pas jamais aucun nunca jamás ningún"
SAYING = "said says say called calls wrote writes claimed claims sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió"
# Where threats start; the sample changes their weights and adds others.
THREATS = "kill hurt destroy murder shoot stab burn töten umbringen verletzen vernichten tuer blesser détruire frapper matar herir destruir golpear"
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[.!?;:\n\"“”„«»]")

END, QUOTE = "end", "quote"
# Start values of the factors and the range of each: negated, reported, both, with a target, with a target after it, threat.
MARKS = ("", "~", "^", "~^")
FACTORS = {"~": 0.4, "^": 0.6, "~^": 0.3, "+": 1.5, "after": 0.5, "threat": 1.0}
RANGES = {"~": (0.05, 1.0), "^": (0.05, 1.0), "~^": (0.05, 1.0), "+": (1.0, 4.0), "after": (0.05, 2.0), "threat": (0.1, 5.0)}
SLOTS = 3 * len(MARKS) + 1
PULL, SEED, SEED_DOCS, LIFT = 2.0, 2.0, 2, 1.0


@dataclass
class Transducer:
    """``rules[state, symbol] = (next state, output)``; other symbols keep the state and pass."""

    rules: dict[tuple, tuple]
    start: object = 0

    def step(self, state, symbol):
        return self.rules.get((state, symbol), (state, symbol))

    def symbols(self) -> set:
        return {s for _, s in self.rules} | {o for _, o in self.rules.values()}


def compose(first: Transducer, second: Transducer, alphabet: set[str]) -> Transducer:
    """One machine that feeds the first one's output to the second."""
    rules, todo, seen = {}, [(first.start, second.start)], {(first.start, second.start)}
    while todo:
        a, b = todo.pop()
        for symbol in alphabet:
            a2, mid = first.step(a, symbol)
            b2, out = second.step(b, mid)
            if ((a2, b2), out) != ((a, b), symbol):
                rules[(a, b), symbol] = ((a2, b2), out)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(rules, (first.start, second.start))


def grammar() -> Transducer:
    words = ("insult", "threat")
    negation = {(s, "negation"): (2, "word") for s in range(3)}
    for s in (1, 2):
        negation |= {(s, x): (s - 1, x) for x in ("word", "target", "saying")}
        negation |= {(s, x): (0, x + "~") for x in words} | {(s, END): (0, END)}
    negated = [x + n for x in words for n in ("", "~")]
    # 0 plain, 1 after a verb of saying, 2 in quotation marks
    reported = {(0, "saying"): (1, "word"), (1, "saying"): (1, "word"), (2, "saying"): (2, "word"), (1, END): (0, END), (2, "line"): (0, END),
                (1, "line"): (0, END), (0, "line"): (0, END), (0, QUOTE): (2, "word"), (1, QUOTE): (2, "word"), (2, QUOTE): (0, "word")}
    for s in (1, 2):
        reported |= {(s, x): (s, x + "^") for x in negated}
    marked = [x + r for x in negated for r in ("", "^")]
    insults, threats = [x for x in marked if x.startswith("insult")], [x for x in marked if x.startswith("threat")]
    target = {(s, "target"): (t, out) for s, t, out in ((0, 1, "target"), (1, 1, "target"), (2, 1, "after"))}
    target |= {(0, x): (2, x) for x in insults} | {(1, x): (1, x + "+") for x in insults} | {(s, END): (0, END) for s in (1, 2)}
    threat = {(1, x): (1, "threat+") for x in threats if x == "threat"} | {(0, "threat"): (2, "word")}
    threat |= {(0, "target"): (1, "target"), (0, "after"): (1, "after"), (2, "target"): (1, "threat+"), (2, "after"): (1, "threat+")}
    threat |= {(s, END): (0, END) for s in (1, 2)}
    cascade = Transducer(negation)
    alphabet = {"word", "insult", "threat", "target", "negation", "saying", QUOTE, END, "line"}
    for rules in (reported, target, threat):
        cascade = compose(cascade, Transducer(rules), alphabet)
    return cascade


FIXED = {w: symbol for symbol, ws in (("target", TARGETS), ("negation", NEGATIONS), ("saying", SAYING)) for w in ws.split()}
FIXED |= {c: END for c in ".!?;:"} | {"\n": "line"} | {c: QUOTE for c in '"“”„«»'}


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS.split(), SEED))
    known: dict[str, tuple[str, float]] = field(default_factory=dict)

    def look_up(self, token: str) -> tuple[str, float]:
        found = self.known.get(token)
        if found is None:
            weight = self.words.get(token) or max((self.stems.get(token[:k], 0.0) for k in STEMS if k < len(token)), default=0.0)
            if weight:
                found = ("insult", weight)
            elif token in self.threats:
                found = ("threat", self.threats[token])
            else:
                found = (FIXED.get(token, "word"), 0.0)
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[token] = found
        return found


def slot_values(factors: dict[str, float]) -> np.ndarray:
    """What one unit of weight counts in each slot: insults by mark, the same with a target, with a target after, threats."""
    base = np.array([1.0, *(factors[m] for m in MARKS[1:])])
    return np.concatenate([base, base * factors["+"], base * factors["after"], [factors["threat"]]])


SLOT = {f"insult{m}{t}": k + len(MARKS) * bool(t) for k, m in enumerate(MARKS) for t in ("", "+")}


def matched_clauses(text: str, lexicon: Lexicon, machine: Transducer) -> list[list[tuple[int, float]]]:
    """(slot, weight) of every match, one list per clause with any."""
    look_up = lexicon.look_up
    symbols = [look_up(t) for t in TOKEN.findall(text.lower())]
    if not any(s == "insult" or s == "threat" for s, _ in symbols):
        return []
    state, rules = machine.start, machine.rules
    clauses, clause, last, threat = [], [], None, 0.0
    for symbol, weight in [*symbols, (END, 0.0)]:
        state, out = rules.get((state, symbol), (state, symbol))
        if symbol == "threat" and out in ("word", "threat+"):
            threat = weight
        if out == "word":
            continue
        if out == END:
            if clause:
                clauses.append(clause)
                clause = []
        elif out.startswith("insult"):
            slot = SLOT[out]
            clause.append((slot, weight))
            last = (2 * len(MARKS) + slot % len(MARKS), weight)
        elif out == "after":
            clause.append(last)
        elif out == "threat+":
            clause.append((SLOTS - 1, threat))
    return clauses


def clause_scores(text: str, lexicon: Lexicon, machine: Transducer, values: np.ndarray | None = None) -> tuple[float, float]:
    """(largest, sum) of the clause scores of a text."""
    value = (slot_values(FACTORS) if values is None else values).tolist()
    scores = [sum(value[k] * w for k, w in clause) for clause in matched_clauses(text, lexicon, machine)]
    return max(scores, default=0.0), float(sum(scores))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tallies = (Counter(), Counter())
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = {w for w in TOKEN.findall((text or "").lower()) if w.isalpha()}
            tallies[label].update(words)
            tallies[label].update({w[:k] + "*" for w in words for k in STEMS if k < len(w)})
    for label, tally in enumerate(tallies):
        names = list(tally)
        for i in range(0, len(names), 100_000):
            part = names[i:i + 100_000]
            n = pa.array([tally[w] for w in part], pa.int64())
            zero = pa.array(np.zeros(len(part), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *((zero, n) if label else (n, zero))], names=["term", "other", "toxic"])


def open_clauses(tokens: list[str], lexicon: Lexicon) -> list[bool]:
    """For each token, whether its clause names a target and holds no insult."""
    kinds = [lexicon.look_up(t)[0] for t in tokens] + [END]
    out, lo = [], 0
    for hi, kind in enumerate(kinds):
        if kind in (END, "line"):
            part = set(kinds[lo:hi + 1])
            out += ["target" in part and "insult" not in part] * (hi + 1 - lo)
            lo = hi + 1
    return out[:-1]


def _threat_tally(lexicon: Lexicon):
    """Documents by label that hold a word in an open clause, or anywhere; the empty term counts those with any open clause."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"{x}{k}" for x in ("near", "all") for k in (0, 1)]
        tally = Counter()
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tokens = TOKEN.findall((text or "").lower())
                is_open = open_clauses(tokens, lexicon)
                near = {t for t, o in zip(tokens, is_open, strict=True) if o and t.isalpha() and t not in FIXED}
                tally.update((t, f"near{label}") for t in (near | {""} if any(is_open) else near))
                tally.update((t, f"all{label}") for t in set(tokens) if t.isalpha() and t not in FIXED)
        terms = sorted({t for t, _ in tally})
        for i in range(0, len(terms), 100_000):
            part = terms[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([tally[t, n] for t in part], pa.int64()) for n in names)],
                                             names=["term", *names])
    return run


def _contexts(terms: set[str], lexicon: Lexicon | None = None):
    """Each place of a candidate term as (term, the words around it); with a lexicon, only places in open clauses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column("text").to_pylist():
                words = ["", *TOKEN.findall((text or "").lower()), ""]
                wanted = [True] * (len(words) - 2) if lexicon is None else open_clauses(words[1:-1], lexicon)
                for before, w, after, here in zip(words, words[1:], words[2:], wanted, strict=False):
                    if not here:
                        continue
                    for term in (w, *(w[:k] + "*" for k in STEMS if k < len(w))):
                        if term in terms:
                            found.add((term, f"{before} {after}"))
            term, around = (list(x) for x in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.string()), pa.array(around, pa.string())], names=["term", "around"])
    return run


@dataclass
class Model:
    lexicon: Lexicon
    coef: np.ndarray
    constant: float | None = None
    factors: dict[str, float] = field(default_factory=lambda: dict(FACTORS))

    def score(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(best), self.constant)
        return 1 / (1 + np.exp(-np.clip(features(best, total) @ self.coef, -30, 30)))


def features(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(best)), best, np.log1p(total)])


def _clauses(lexicon: Lexicon, factors: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, values = grammar(), slot_values(factors)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                got = np.array([clause_scores(t or "", lexicon, machine, values) for t in part.column("text").to_pylist()]).reshape(-1, 2)
                rest = [c for c in batch.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(got[:, 0]), pa.array(got[:, 1])],
                                                 names=[*rest, "best", "total"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    coef, ridge = np.zeros(x.shape[1]), np.array([1e-6, 1e-2, 1e-2]) * weight.sum()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        r = np.maximum(weight * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * r[:, None]).T @ x + np.diag(ridge * 0.01 + 1e-9), x.T @ (weight * (y - p)) - ridge * 0.01 * coef)
        coef = coef + step
        if np.abs(step).max() < 1e-6:
            break
    coef[1:] = np.maximum(coef[1:], 0)
    return coef


def _evidence(lexicon: Lexicon):
    """Per document with a match its weights by slot, summed, and its different clauses as such vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = grammar()
        for batch in batches:
            labels, clauses, sums = [], [], []
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = matched_clauses(text or "", lexicon, machine)
                if not found:
                    continue
                total, different = np.zeros(SLOTS), set()
                for clause in found:
                    vector = np.zeros(SLOTS)
                    for k, w in clause:
                        vector[k] += w
                    total += vector
                    different.add(tuple(vector.tolist()))
                labels.append(label)
                clauses.append([x for v in sorted(different) for x in v])
                sums.append(total.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(clauses, pa.list_(pa.float64())), pa.array(sums, pa.list_(pa.float64()))],
                                             names=["label", "clauses", "sums"])
    return run


def fit(clauses: list[np.ndarray], sums: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, float], np.ndarray]:
    """Factors and curve of the smallest weighted loss, the factors drawn to their start values; one factor changes at a time."""
    have = [len(c) for c in clauses]
    rows, doc = np.concatenate(clauses) if sum(have) else np.zeros((0, SLOTS)), np.flatnonzero(have)
    first = np.concatenate([[0], np.cumsum(have)])[:-1][doc]

    def loss(factors: dict[str, float]) -> tuple[float, np.ndarray]:
        values, best = slot_values(factors), np.zeros(len(y))
        if len(doc):
            best[doc] = np.maximum.reduceat(rows @ values, first)
        x = features(best, sums @ values)
        coef = _logistic(x, y, weight)
        z = np.clip(x @ coef, -30, 30)
        pull = sum(np.log(factors[k] / FACTORS[k]) ** 2 for k in FACTORS)
        return float(weight @ (np.log1p(np.exp(z)) - y * z)) + PULL * pull, coef

    factors, seen = dict(FACTORS), sums.any(axis=0)
    least, coef = loss(factors)
    for step in (2.0, 2.0, 1.4, 1.4, 1.2):
        for name, (low, high) in RANGES.items():
            for move in (step, 1 / step):
                tried = factors | {name: float(np.clip(factors[name] * move, low, high))}
                if not seen[slot_values(tried) != slot_values(factors)].any():
                    continue
                value, c = loss(tried)
                if value < least - 1e-6:
                    factors, least, coef = tried, value, c
    return factors, coef


def learn_threats(chosen: DataFrame, lexicon: Lexicon) -> dict[str, float]:
    """Weights of threat words: those of the start list, and words that stand out in the open clauses of toxic documents."""
    tally = saved(chosen.mapInArrow(_threat_tally(lexicon), "term string, near0 bigint, near1 bigint, all0 bigint, all1 bigint").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("near0", "near1", "all0", "all1")]), "threats")
    n = tally.where("term = ''").select("near0", "near1").first()
    other_n, toxic_n = (max(1, v) for v in (n or (1, 1)))
    counts = {r["term"]: (r["near1"], r["near0"]) for r in tally.where(F.col("term").isin(THREATS.split())).collect()}
    seeds = {}
    for word in THREATS.split():
        toxic, other = counts.get(word, (0, 0))
        start = SEED_DOCS * other_n / toxic_n * np.exp(-SEED)
        value = float(np.log(((toxic + SEED_DOCS) / toxic_n) / ((other + start) / other_n)))
        if value > 0:
            seeds[word] = value
    near = F.log((F.col("near1") / toxic_n) / ((F.col("near0") + 0.5) / (other_n + 1)))
    size = chosen.agg(F.count_if(F.col("label") == 0).alias("other"), F.count_if(F.col("label") == 1).alias("toxic")).first()
    anywhere = F.log((F.col("all1") / size["toxic"]) / ((F.col("all0") + 0.5) / (size["other"] + 1)))
    # The evidence test bounds these as it bounds the insults.
    kept = tally.where("term <> '' and near1 > 2").withColumn("ratio", near).where(
        (F.col("ratio") >= RATIO) & (F.col("near1") * F.col("ratio") >= EVIDENCE) & (F.col("ratio") - anywhere >= LIFT)).collect()
    around = chosen.where("label = 1").mapInArrow(_contexts({r["term"] for r in kept}, lexicon), "term string, around string")
    places = {r["term"]: r["n"] for r in around.groupBy("term").agg(F.count_distinct("around").alias("n")).collect()} if kept else {}
    learnt = {}
    for r in kept:
        n_toxic = min(r["near1"], places.get(r["term"], 0))
        value = float(np.log((n_toxic / toxic_n) / ((r["near0"] + 0.5) / (other_n + 1)))) if n_toxic else 0.0
        if value >= RATIO and n_toxic * value >= EVIDENCE:
            learnt[r["term"]] = value
    return seeds | learnt


def learn(rows: DataFrame) -> Model:
    """``rows`` is a bounded sample with text and label (0 or 1)."""
    chosen = saved(rows.where("label in (0, 1)").select("label", "text"), "labelled")
    n = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    if len(n) < 2:
        return Model(Lexicon({}, {}), np.zeros(3), float(next(iter(n), 0.5)))
    toxic_n, other_n = n[1], n[0]
    tally = chosen.mapInArrow(_tally, "term string, other bigint, toxic bigint").groupBy("term").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") / toxic_n) / ((F.col("other") + 0.5) / (other_n + 1)))
    # The evidence test bounds these: each kept term takes part of the sample's toxic documents' words.
    kept = tally.where("toxic > 2").withColumn("ratio", ratio).where((F.col("ratio") >= RATIO) & (F.col("toxic") * F.col("ratio") >= EVIDENCE)).collect()
    # Copies of a toxic document repeat all its words, but always between the same two: evidence counts different surroundings.
    around = chosen.where("label = 1").mapInArrow(_contexts({r["term"] for r in kept}), "term string, around string")
    places = {r["term"]: r["n"] for r in around.groupBy("term").agg(F.count_distinct("around").alias("n")).collect()}
    weight_of = {}
    for r in kept:
        n_toxic = min(r["toxic"], places.get(r["term"], 0))
        value = float(np.log((n_toxic / toxic_n) / ((r["other"] + 0.5) / (other_n + 1)))) if n_toxic else 0.0
        if value >= RATIO and n_toxic * value >= EVIDENCE:
            weight_of[r["term"]] = value
    words = {t: v for t, v in weight_of.items() if not t.endswith("*")}
    stems = {t[:-1]: v for t, v in weight_of.items() if t.endswith("*")}
    family = Counter(w[:k] for w in words for k in STEMS if k < len(w))
    stems = {s: w for s, w in stems.items() if family[s] >= FAMILY}
    lexicon = Lexicon(words, stems)
    lexicon = Lexicon(words, stems, learn_threats(chosen, lexicon))
    got = chosen.mapInArrow(_evidence(lexicon), "label int, clauses array<double>, sums array<double>").toArrow()
    # Both labels weigh the same; documents without a match count as one row of each label.
    y = np.append(got.column("label").to_numpy().astype(float), [0, 1])
    each = np.array([0.5 / n[0], 0.5 / n[1]]) * (n[0] + n[1])
    weight = each[y.astype(int)]
    weight[-2:] = [each[v] * (n[v] - (y[:-2] == v).sum()) for v in (0, 1)]
    clauses = [np.array(c, float).reshape(-1, SLOTS) for c in got.column("clauses").to_pylist()] + [np.zeros((0, SLOTS))] * 2
    sums = np.vstack([np.array(got.column("sums").to_pylist(), float).reshape(-1, SLOTS), np.zeros((2, SLOTS))])
    factors, coef = fit(clauses, sums, y, weight)
    return Model(lexicon, coef, factors=factors)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, best, total, score, predicted): ``row`` holds the columns of ``docs`` without the text; best and
    total are the clause scores."""
    src = packed(docs, text_col)
    found = src.mapInArrow(_clauses(model.lexicon, model.factors), with_row(src, "best double, total double"))
    if model.constant is not None:
        value = F.lit(model.constant)
    else:
        a, b, c = (float(v) for v in model.coef)
        value = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("best") + F.lit(c) * F.log1p("total"))))
    return found.withColumn("score", value).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@corpus_query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from opsanalytics.llm.op3_quality_crf import training_rows

    docs = table(spark, sf_dir, "documents")
    model = learn(training_rows(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1, {0: 3 * SAMPLE, 1: SAMPLE}))
    marked = score(docs.select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out")), model)
    return marked.select("row.doc_id", "row.held_out", "score", "predicted")
