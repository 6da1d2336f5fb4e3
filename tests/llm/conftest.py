"""Small tables shared by the corpus tests: every awkward row in one place."""

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau ypsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text): nulls, empty, tiny and long texts, exact and near copies, shared passages, repeated rows."""
    passage = prose(1, 90)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (None, "lost id " + prose(3, 30)), (None, None),
        (10, prose(10, 200)), (11, prose(10, 200)), (12, prose(10, 200).replace(" ", "\n", 7)), (13, prose(10, 199)),
        (14, prose(10, 200)), (14, prose(10, 200)),
        (20, "x " * 700), (21, "ab" * 900), (22, "ß日本🙂" * 150), (23, "é" + "ß日本🙂" * 150),
        (30, prose(30, 3000)), (31, prose(31, 500) + " " + prose(30, 3000)[400:9000]),
    ]
    for k in range(12):
        rows.append((100 + k, prose(100 + k, 40) + " " + passage + " " + prose(200 + k, 30)))
    for k in range(6):
        words = prose(7, 150).split()
        words[10 * k + 3] = "changed"
        rows.append((300 + k, " ".join(words)))
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", 0, "clash") for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
