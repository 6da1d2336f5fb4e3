"""Language filters, the line field and the clause grammar: brute force and held-out accuracy."""

from itertools import product

import numpy as np
import pytest

from opsanalytics.llm import crf
from opsanalytics.llm import op2_language_id as op2
from opsanalytics.llm import op3_quality_crf as op3
from opsanalytics.llm import op10_toxicity as op10

from .conftest import corpus, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_language_held_out_accuracy(spark):
    got = op2.op2(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    rows = got.collect()
    assert len(rows) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark, docs, no_docs):
    model = op2.learn(docs.select("text", "lang"))
    got = {r["row"]["doc_id"]: r for r in op2.predict(docs.select("doc_id", "text", "key"), model).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == got[3]["lang_pred"] == "und" and got[1]["score"] == 0
    assert got[4]["lang_pred"] == "en" and got[10]["row"]["key"] == "clash"
    assert op2.learn(no_docs) is None
    assert {r["lang_pred"] for r in op2.predict(docs.select("doc_id", "text"), None).collect()} == {"und"}
    assert op2.predict(no_docs, model).count() == 0


def test_language_counts_are_exact(spark, docs):
    import pyarrow as pa

    texts = ["Aé b", "", "longer text, with 3 words"]
    got = [c.tolist() for _, _, codes, off in op2.grams(pa.array(texts)) for c in np.split(codes, off[1:-1])]
    for t, codes in zip(texts, got, strict=True):
        raw = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in f"  {t.lower()}  ".encode())
        want = [raw[k:k + 5] for k in range(len(raw) - 4) if raw[k:k + 5] != b"     "]
        assert [int(c).to_bytes(5, "big") for c in codes] == want


def test_marginals_by_enumeration():
    r = np.random.default_rng(2)
    off = np.array([0, 3, 3, 8, 9])
    unary, trans = r.normal(size=(9, 2)), r.normal(size=(2, 2))
    p, pairs, norm = crf.marginals(unary, off, trans)
    want_pairs = np.zeros((2, 2))
    for k in range(4):
        n = off[k + 1] - off[k]
        if not n:
            continue
        weight, single = 0.0, np.zeros((n, 2))
        joint = np.zeros((2, 2))
        for path in product((0, 1), repeat=int(n)):
            w = np.exp(sum(unary[off[k] + t, s] for t, s in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
            weight += w
            for t, s in enumerate(path):
                single[t, s] += w
            for a, b in zip(path, path[1:], strict=False):
                joint[a, b] += w
        assert np.allclose(p[off[k]:off[k + 1]], single / weight)
        assert np.isclose(norm[k], np.log(weight))
        want_pairs += joint / weight
    assert np.allclose(pairs, want_pairs)


def test_lines_cover_every_byte():
    texts = ["", "\n", "a", "a\n", "\n\nb\nlong line here", "x"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    starts, ends, loff = op3.lines(np.frombuffer(b"".join(raw), np.uint8), off)
    whole = b"".join(raw)
    got = [[whole[a:b] for a, b in zip(starts[x:y], ends[x:y], strict=True)] for x, y in zip(loff, loff[1:], strict=False)]
    assert got == [t.split(b"\n") for t in raw]


def test_quality_held_out_accuracy(spark, labels):
    rows = op3.op3(spark, SF).where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 60
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_quality_edges(spark, docs, no_docs):
    model = op3.learn(spark.createDataFrame([(1, "good line\nmore of it", 1), (2, "BAD!! BAD!!", 0), (3, None, 1), (4, "x", None)],
                                            "id bigint, text string, label int"))
    got = op3.score(docs, model, keep_text=True)
    rows = got.collect()
    assert len(rows) == len(corpus()) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["row"]["key"] for r in rows} == {"clash"}
    one = op3.learn(spark.createDataFrame([(1, "a", 1)], "id bigint, text string, label int"))
    assert {r["score"] for r in op3.score(docs, one).collect()} == {1.0}
    assert op3.score(no_docs, model).count() == 0


def test_quality_learns_from_whole_texts(spark):
    def clean(seed, n):
        return [prose(seed * 1000 + k, 9).capitalize() + "." for k in range(n)]

    def junk(seed, n):
        return [f"$$ {seed * k} || >> {k} %% ##" for k in range(n)]

    rows = [("\n".join(clean(k, 250)), 1) for k in range(6)] + [("\n".join(clean(50 + k, 210) + junk(k + 1, 600)), 0) for k in range(6)]
    model = op3.learn(spark.createDataFrame(rows, "text string, label int"))
    new = spark.createDataFrame([(1, "\n".join(clean(90, 250))), (0, "\n".join(clean(91, 210) + junk(9, 600)))], "good int, text string")
    got = {r["row"]["good"]: r["score"] for r in op3.score(new, model).collect()}
    assert got[1] > 0.7 and got[0] < 0.3


def score(text, words=("vile",)):
    return op10.clause_scores(text, op10.Lexicon(dict.fromkeys(words, 4.0), {"scul": 3.0}), op10.grammar())[0]


def test_grammar():
    plain = score("this vile thing")
    assert plain == 4.0
    assert score("not a vile thing") < plain
    assert score("he wrote vile things") < plain
    assert score('some "vile" thing') < plain
    assert score("you are vile") > plain
    assert score("vile you") > plain
    assert score("not here. a vile thing") == plain
    assert score("we kill time") == 0 and score("they will kill you") > 0
    assert score("scullery") == 3.0 and score("scul") == 0
    assert score("") == 0 and score("quite clean text") == 0


def test_composition_equals_the_cascade():
    from random import Random

    a = op10.Transducer({(0, "x"): (1, "y"), (1, "y"): (0, "x"), (1, "x"): (1, "z")})
    b = op10.Transducer({(0, "y"): (1, "w"), (1, "z"): (0, "v"), (1, "x"): (1, "x")})
    both = op10.compose(a, b, {"x", "y", "z"})
    r, s, t, st = Random(4), 0, 0, (0, 0)
    for _ in range(200):
        c = r.choice("xyz")
        s, mid = a.step(s, c)
        t, out = b.step(t, mid)
        st, got = both.step(st, c)
        assert (st, got) == ((s, t), out)


def test_toxicity_held_out(spark, labels):
    rows = op10.op10(spark, SF).where("held_out").join(labels, "doc_id").collect()
    clean = [r for r in rows if r["toxic"] == 0]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)


def brute_clauses(text, lexicon, factors):
    """(largest, sum) of the clause scores by rules over the tokens, without machines."""
    scores, clause, last, target, threat, negated, reported = [0.0], 0.0, None, False, None, 0, ""
    insult_before = False
    for token in [*op10.TOKEN.findall(text.lower()), "."]:
        kind, weight = lexicon.look_up(token)
        mark = ("~" if negated else "") + ("^" if reported else "")
        if kind == "negation":
            negated = 2
            continue
        if kind in ("insult", "threat"):
            negated = 0
        elif kind in ("word", "target", "saying"):
            negated = max(0, negated - 1)
        if kind == "quote":
            reported = "" if reported == "quote" else "quote"
        elif kind == "saying":
            reported = reported or "said"
        elif kind in ("end", "line"):
            if kind == "end":
                negated = 0
            reported = "quote" if reported == "quote" and kind == "end" else ""
            scores.append(clause)
            clause, target, threat, insult_before = 0.0, False, None, False
        elif kind == "insult":
            factor = factors[mark] if mark else 1.0
            last = weight * factor
            clause += last * (factors["+"] if target else 1)
            insult_before = insult_before or not target
        elif kind == "threat" and not mark:
            if threat == "named":
                clause += weight * factors["threat"]
            elif threat is None:
                threat = weight
        elif kind == "target":
            if isinstance(threat, float):
                clause += threat * factors["threat"]
            elif insult_before:
                clause += last * factors["after"]
            target, insult_before, threat = True, False, "named"
    return max(scores), sum(scores)


def test_toxicity_equals_plain_rules(spark):
    """All rows of the table, with the learnt lexicon, factors and curve, against rules without machines."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = op3.training_rows(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic", 3, 1, {0: 24000, 1: 8000})
    model = op10.learn(train)
    got = {r["row"]["doc_id"]: r for r in op10.score(docs, model).collect()}
    for d in docs.select("doc_id", "text").collect():
        best, total = brute_clauses(d["text"] or "", model.lexicon, model.factors)
        r = got[d["doc_id"]]
        assert (r["best"], r["total"]) == pytest.approx((best, total))
        assert r["score"] == pytest.approx(float(model.score(np.array([best]), np.array([total]))[0]))
    r = np.random.default_rng(5)
    pool = [*"you they not never said vile sculling kill we a the house to".split(), ".", '"', "\n"]
    lexicon, machine = op10.Lexicon({"vile": 4.0}, {"scul": 3.0}, {"kill": 2.0, "house": 0.7}), op10.grammar()
    for _ in range(3000):
        text = " ".join(r.choice(pool, r.integers(1, 14)))
        assert op10.clause_scores(text, lexicon, machine) == pytest.approx(brute_clauses(text, lexicon, op10.FACTORS)), text


def test_threats_are_learnt(spark):
    """A word that is harmless elsewhere and stands with targets in toxic documents only."""
    def row(k):
        head, tail = prose(k, 5), prose(k + 4000, 5)
        if k % 4 == 0:
            return f"{head}. {prose(k + 9000, 1)} zorch {prose(k + 8000, 1)} you. {tail}", 1
        return f"{head}. zorch {prose(k + 8000, 1)} it. {prose(k + 9000, 2)} you {tail}", 0

    rows = [(k, *row(k)) for k in range(400)]
    model = op10.learn(spark.createDataFrame(rows, "id bigint, text string, label int"))
    assert "zorch" in model.lexicon.threats and "zorch" not in model.lexicon.words
    assert set(model.lexicon.threats) - {"zorch"} <= set(op10.THREATS.split())
    new = spark.createDataFrame([(1, "we zorch you"), (2, "we zorch wood"), (3, "you and wood")], "id int, text string")
    assert {r["row"]["id"]: r["predicted"] for r in op10.score(new, model).collect()} == {1: 1, 2: 0, 3: 0}


def test_factors_follow_the_sample(spark):
    """Quoted insults in clean documents weigh less than at the start; what the sample says nothing against stays."""
    def row(k):
        head, tail = prose(k, 4), prose(k + 4000, 4)
        middle = ("vile", "vile", "not vile", '"vile"')[k % 4] if k < 900 else "plain"
        return f"{head} {middle} {tail}", int(k < 900 and k % 4 < 3)

    rows = [(k, *row(k)) for k in range(9000)]
    model = op10.learn(spark.createDataFrame(rows, "id bigint, text string, label int"))
    assert model.factors["^"] < op10.FACTORS["^"]
    assert {k: v for k, v in model.factors.items() if k != "^"} == {k: v for k, v in op10.FACTORS.items() if k != "^"}
    new = spark.createDataFrame([(1, "so vile"), (2, "not vile"), (3, 'so "vile"'), (4, "so")], "id int, text string")
    assert {r["row"]["id"]: r["predicted"] for r in op10.score(new, model).collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


def test_toxicity_edges(spark, docs, no_docs):
    rows = [(k, f"{prose(k, 4)} {'kind' if k % 6 else 'vile'} {prose(k + 500, 4)}", int(k % 6 == 0)) for k in range(180)]
    # Copies of one toxic text say nothing about its words.
    rows += [(300 + k, "onlyhere and evermore", 1) for k in range(60)]
    model = op10.learn(spark.createDataFrame([*rows, (999, None, 0), (998, "vile", None)], "id bigint, text string, label int"))
    assert set(model.lexicon.words) == {"vile"}
    got = {r["row"]["doc_id"]: r for r in op10.score(docs, model).collect()}
    assert got[1]["predicted"] == got[2]["predicted"] == 0 and got[1]["total"] == 0
    assert op10.score(spark.createDataFrame([(1, "so vile")], "doc_id bigint, text string"), model).first()["predicted"] == 1
    assert op10.score(no_docs, model).count() == 0
    assert op10.learn(no_docs.selectExpr("text", "1 as label")).constant == 0.5


CLASHING = ["score", "best", "total", "row", "lang_pred", "predicted", "text_sha256", "key", "key_of_row", "stay_doc_id", "id", "leaks", "a b", "c`d"]


def with_clashes(docs):
    """Rows with columns named as the operators' own, a space and a backtick among them."""
    from pyspark.sql import functions as F

    return docs.select("doc_id", "text", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])


def test_predictors_keep_every_caller_column(spark, docs):
    rows = with_clashes(docs)
    want = sorted((str(tuple(r)) for r in rows.drop("text").collect()))
    texts = spark.createDataFrame([("good line\nmore", 1), ("BAD!! BAD!!", 0)], "text string, label int")
    for got in (op2.predict(rows, None), op3.score(rows, op3.learn(texts)), op10.score(rows, op10.learn(texts))):
        assert got.select("row.*").columns == ["doc_id", *CLASHING]
        assert sorted(str(tuple(r["row"])) for r in got.collect()) == want


def test_training_lines_are_bounded(spark):
    rows = spark.createDataFrame([(k % 2, f"line {k}\n" * (k % 7)) for k in range(60)] + [(1, "x\n" * 500), (0, None)], "label int, text string")
    kept = op3.within_lines(rows, 40).collect()
    lines = {v: [(r["text"] or "").count("\n") + 1 for r in kept if r["label"] == v] for v in (0, 1)}
    assert all(20 < sum(x) <= 40 for x in lines.values())
    assert len(op3.within_lines(rows, 10_000).collect()) == 62


def test_long_chain_trains_quickly():
    import time

    r = np.random.default_rng(4)
    off = np.concatenate([[0, 100_000], np.arange(100_010, 110_001, 10)])
    y = np.repeat(r.integers(0, 2, len(off) - 1), np.diff(off))
    x = r.normal(size=(off[-1], 3 * op3.OWN)) + y[:, None]
    start = time.time()
    w, _ = crf.fit(x, off, y, np.ones(len(off) - 1))
    assert time.time() - start < 60 and w.mean() > 0
