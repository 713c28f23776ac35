"""Chat formatting: round trips, merging, mask, odd rows."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitals.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, mask int, turns int"
CONTROL = ["<|turn|>", "<|and|>", "<|end|>\n", "\\", "\\\\", "<\\|", "</s>", "[INST]", "[/INST]", "<s>", "<", "[", "\n", "é🎉", "a", ""]


def back(spark, rows):
    frame = spark.createDataFrame([(*r, "f", 1, 1) for r in rows], SCHEMA)
    return {r["id"]: r for r in chat.read_back(chat.formatted(frame)).collect()}


def test_template_and_merging(spark):
    got = back(spark, [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b<|end|>"), (1, 3, "assistant", "d")])[1]
    assert got["formatted"] == "<|turn|>user\na<|and|>b<\\|end|><|end|>\n<|turn|>assistant\nc<|and|>d<|end|>\n"
    assert [tuple(t) for t in got["turns"]] == [("user", "a"), ("user", "b<|end|>"), ("assistant", "c"), ("assistant", "d")]
    assert got["loss_texts"] == ["c", "d"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", "x\\", ""]), st.lists(st.sampled_from(CONTROL), max_size=6).map("".join)), min_size=1, max_size=40))
def test_round_trip(spark, turns):
    got = back(spark, [(i // 5, i, r, t) for i, (r, t) in enumerate(turns)])
    for conv, row in got.items():
        own = turns[conv * 5 : conv * 5 + 5]
        assert [tuple(t) for t in row["turns"]] == own
        assert "".join(row["loss_texts"]) == "".join(t for r, t in own if r == "assistant")


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", None), (None, 0, "user", "x"), (2, 0, "user", "t"), (2, 0, "user", "t"), (2, 0, "assistant", "s")]
    got = back(spark, [*rows, (3, 0, "assistant", "long " * 50_000)])
    assert [tuple(t) for t in got[1]["turns"]] == [("", ""), ("user", "")]
    assert [tuple(t) for t in got[2]["turns"]] == [("assistant", "s"), ("user", "t"), ("user", "t")]
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "x")] and len(got[3]["loss_texts"][0]) == 250_000
    assert chat.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_probe_conversation(spark):
    row = [r for r in chat.op7_chat(spark, "/root/testdata/sf0.001").collect() if r["conv_id"] == chat.PROBE_ID]
    text = chat.PROBE_TEXT
    assert [r["turns_sha256"] for r in row] == [hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()]
    assert [(r["n_turns"], r["loss_chars"], r["loss_sha256"]) for r in row] == [(2, len(text), hashlib.sha256(text.encode()).hexdigest())]


def test_main_path_is_native(spark):
    plan = chat.op7_chat(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
