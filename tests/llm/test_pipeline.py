"""The pipeline's stages against brute force, each on the input it gets."""

import re

import corpus_pipeline
from opsanalytics.llm import op6_pieces
from opsanalytics.llm.op3_quality_crf import op3
from opsanalytics.llm.store import saved

from .conftest import prose
from .test_jaccard import want as all_pairs

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "exact_dedup", "near_duplicates", "decontamination", "tokens"]
    good = saved(steps["quality"](spark, documents, SF), "good")
    assert good.columns == COLUMNS
    assert {r[0] for r in good.select("doc_id").collect()} == {r[0] for r in op3(spark, SF).where("predicted = 1").select("doc_id").collect()}

    single = saved(steps["exact_dedup"](spark, good, SF), "single")
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t), []).append((-len(t), i))
    assert single.columns == COLUMNS
    assert {r[0] for r in single.select("doc_id").collect()} == {min(g)[1] for g in groups.values()}

    apart = saved(steps["near_duplicates"](spark, single, SF), "apart")
    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert {r[0] for r in apart.select("doc_id").collect()} == {i for i, c, _ in all_pairs(rows) if i == c}

    clean = saved(steps["decontamination"](spark, apart, SF), "clean")
    items = [" " + " ".join(re.findall(r"[^\W_]+", r["text"].lower())) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in apart.collect() if any(i in " " + " ".join(re.findall(r"[^\W_]+", r["text"].lower())) + " " for i in items)}
    assert {r["doc_id"] for r in apart.collect()} - {r["doc_id"] for r in clean.collect()} == leaks

    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    m = op6_pieces.pieces(op6_pieces.MODEL)
    got = steps["tokens"](spark, clean, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {i: m.sp.encode(t) for i, t in texts.items()}
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_repeated_rows_and_empty_tables(spark, docs, no_docs):
    exact = corpus_pipeline.exact(spark, docs, SF)
    assert exact.columns == docs.columns
    assert exact.where("doc_id = 14").count() <= 1
    near = corpus_pipeline.near(spark, docs, SF)
    assert near.where("doc_id between 300 and 305").count() == 1
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name


def test_one_of_each_group_with_repeated_and_null_ids(spark):
    def near_copies(seed):
        words = prose(seed, 150).split()
        return [" ".join([*words[:k], f"changed{k}", *words[k + 1:]]) for k in (9, 60, 120)]

    a, b, c, d = (near_copies(s) for s in (501, 502, 503, 504))
    rows = [(7, a[0]), (7, a[1]),  # an id repeated inside a group
            (1, b[0]), (2, b[1]), (2, c[0]), (3, c[1]),  # an id that heads one group and not the other
            (None, d[0]), (None, prose(505, 80)), (9, d[1]), (None, d[2]),
            (11, prose(506, 90)), (11, prose(506, 90)), (12, ""), (12, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near(spark, docs, SF).collect()]
    assert sum(r in got for r in ((7, a[0]), (7, a[1]))) == 1
    left = [r for r in got if r[0] != 7]
    want = [(1, b[0]), (2, c[0]), (9, d[1]), (None, prose(505, 80)), (11, prose(506, 90)), (12, ""), (12, "")]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_exact_keeps_the_longest_original_of_one_id(spark):
    docs = spark.createDataFrame([(1, "a b c"), (1, "a  b  c"), (1, "a b  c"), (2, "a b c")], "doc_id bigint, text string")
    for n in (1, 3):
        assert [tuple(r) for r in corpus_pipeline.exact(spark, docs.repartition(n), SF).collect()] == [(1, "a  b  c")]


def test_stages_keep_every_caller_column(spark, docs):
    from .test_models import with_clashes

    rows = saved(with_clashes(docs), "clashes")
    want = {str(tuple(r)) for r in rows.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, rows, SF)
        assert got.columns == rows.columns, name
        assert {str(tuple(r)) for r in got.collect()} <= want, name
        assert name == "quality" or got.count() > 0
    assert corpus_pipeline.tokens(spark, rows, SF).count() == rows.count()
