"""Quality rules: measurements against plain Python, policies, ablations."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitals.llm import rules


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
        "n_upper": len(re.findall("[A-Z]", text)), "n_exclamations": text.count("!"), "n_stops": len(re.findall("[.!?]", text)),
    }


WORDS = st.sampled_from(["a", "b", "c", "é", "#", "!", ".", "\n", "\t", "\x0b", "\xa0", "A|", "dd "])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(WORDS, max_size=60).map(" ".join), min_size=1, max_size=40))
def test_measurements(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in rules.ledger(docs).collect():
        assert {k: r[k] for k in plain("")} == plain(texts[r["doc_id"]])


def test_overlapping_windows(spark):
    text = "x " * 30_000 + "a b c d e f a b c d e f g"
    got = rules.ledger(spark.createDataFrame([(text,)], "text string")).first()
    assert got["n_repeat_words"] == plain(text)["n_repeat_words"]


def test_policies_and_ablations(spark):
    docs = spark.createDataFrame([("one two",), ("word " * 40,), ("A fine text has more than ten words, as this one does. " * 1,), ("x # " * 40,)], "text string")
    rows = rules.ledger(docs)
    kept = {p: [r[0] for r in rows.select(rules.passes(p)).collect()] for p in rules.POLICIES}
    assert kept["base-1"] == [False, False, True, False] and kept["web-2"] == [False, False, True, False]
    want = {}
    bits = [r["fail_bits"] for r in rows.collect()]
    for name in rules.RULES:
        bit = 1 << list(rules.RULES).index(name)
        want[name] = (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits), sum(b & ~bit == 0 for b in bits))
    got = {r["rule"]: (r["failed"], r["only_this"], r["kept_without"]) for r in rules.ablations(rows, "web-2").collect()}
    assert got == want


def test_odd_rows(odd_docs, empty_docs):
    found = rules.ledger(odd_docs)
    assert found.columns[: len(odd_docs.columns)] == odd_docs.columns and found.count() == odd_docs.count()
    for r in found.collect():
        assert {k: r[k] for k in plain("")} == plain(r["text"] or "")
    assert rules.ledger(empty_docs).count() == 0


def test_main_path_is_native(spark):
    plan = rules.op9_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_windows_with_clashing_hashes_are_told_apart(spark, monkeypatch):
    real = rules.F.xxhash64
    # two hashes only, in the bits that the place does not take
    monkeypatch.setattr(rules.F, "xxhash64", lambda *words: rules.F.shiftleft(rules.F.pmod(real(*words), rules.F.lit(2)), 40))
    texts = [" ".join(f"w{i}" for i in range(300)), "a b c d e f g h a b c d e x y z", "one two three four five six " * 9 + "and so on to the end"]
    for r in rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect():
        assert r["n_repeat_words"] == plain(texts[r["doc_id"]])["n_repeat_words"]
