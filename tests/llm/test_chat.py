"""Chat formatting: reversibility, loss mask, order check."""

import hashlib
import re

from opsanalytics.llm import op9_chat_format as op9

ROWS = [
    (1, 0, "system", "be <|im_start|> kind"), (1, 1, "user", "a <\\| b <\\\\| c <|"), (1, 2, "assistant", "<|im_end|>\n<|im_start|>assistant ok"),
    (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, 1, "assistant", "late"), (3, 0, "user", "ß🙂 <"), (3, 2, "user", "| open end"),
    (4, 0, "assistant", "starts wrong"), (5, 0, "user", "q"), (5, 1, "user", "q"), (5, 2, "assistant", "x"),
    (6, 0, "user", "tie b"), (6, 0, "user", "tie a"), (6, 1, "assistant", "same"), (6, 1, "assistant", "same"),
    (7, None, "user", "no turn"), (7, 3, "assistant", "x" * 50000), (8, 0, None, "no role"), (9, 0, "odd|\n\\role <|", "t"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "y"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, valid string")


def test_digests_are_read_back(spark):
    got = {r["conv_id"]: r for r in op9.digests(op9.format_chat(frame(spark))).collect()}
    convs: dict = {}
    for c, turn, role, text in ROWS:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss)), c
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest(), c
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest(), c
    assert {c for c in got if got[c]["valid"]} == {1, 2, 7, None}


def test_texts_hold_no_control_string(spark):
    for r in op9.format_chat(frame(spark)).collect():
        for s in r["segments"]:
            if s["kind"] == "text":
                assert "<|" not in s["text"]
        n = sum(s["kind"] == "text" for s in r["segments"])
        assert r["formatted"].count(op9.START) == r["formatted"].count(op9.END) == n
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_empty(spark):
    assert op9.digests(op9.format_chat(frame(spark).limit(0))).count() == 0


def test_native_plan(spark):
    plan = op9.digests(op9.format_chat(frame(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_turns_are_formatted_row_by_row(spark):
    turns = op9.turn_segments(frame(spark))
    assert "Exchange" not in turns._jdf.queryExecution().executedPlan().toString()
    got = turns.collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert [x["kind"] for x in r["segments"]] == ["start", "text", "end"]
        assert [x["loss"] for x in r["segments"]] == [False, r["role"] == "assistant", False]


def test_one_long_conversation(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(4000)] + [(2, k, "user", "u") for k in range(3)]
    assert {r["conv_id"]: r["valid"] for r in op9.role_order(frame(spark, rows).repartition(5)).collect()} == {1: True, 2: False}
    bad = [*rows, (1, 2000, "system", "late")]
    assert {r["conv_id"]: r["valid"] for r in op9.role_order(frame(spark, bad).repartition(5)).collect()} == {1: False, 2: False}
