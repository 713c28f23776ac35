"""Language identification: held-out accuracy, rejection, odd rows."""

import zlib

import numpy as np

from vitals.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in langid.op2_language(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = held = 0
    languages = {d["lang"] for d in docs}
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in languages and 0 <= r["score"] <= 1
        if r["held_out"]:
            held += 1
            right += r["lang_pred"] == d["lang"]
    assert held > 200 and right / held > 0.97


def plain_subwords(word):
    marked = f"\x02{word}\x03"
    return [marked[i : i + n] for n in langid.LENGTHS for i in range(len(marked) - n + 1)]


def test_subwords_are_counted_once_each():
    words = ["a", "straße", "naïve" * 3, "🎉x"]
    seen = {}
    for word, at in langid.subwords(words):
        for w in word:
            seen[int(w)] = seen.get(int(w), 0) + 1
    assert seen == {i: len(plain_subwords(w)) for i, w in enumerate(words)}


def test_blocks_do_not_change_a_long_word(monkeypatch):
    word = "abcdefghij" * 50
    whole = sorted(np.concatenate([at for _, at in langid.subwords([word, "x"])]).tolist())
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert sorted(np.concatenate([at for _, at in langid.subwords([word, "x"])]).tolist()) == whole


def test_rejection_is_calibrated_on_noisy_labels():
    random = np.random.default_rng(1)
    rows = []
    for _ in range(800):
        kind = random.integers(0, 2)
        label = "xy"[kind] if random.random() < 0.9 else "xy"[1 - kind]  # a tenth of the labels is wrong
        words = ["".join(random.choice(list(("abcd", "wxyz")[kind]), 5)) for _ in range(20)]
        rows.append((label, *langid._counted(" ".join(words))))
    model = langid.train(rows, accuracy=0.99)
    assert model.least > 0.5  # such labels allow no accuracy of 0.99, so weak scores are rejected
    scorer, right, accepted = langid.Scorer(model), [], []
    for kind in [0, 1] * 100:
        words = ["".join(random.choice(list(("abcd", "wxyz")[kind]), 5)) for _ in range(8)]
        language, _, rejected = scorer(" ".join(words))
        right.append(language == "xy"[kind])
        if not rejected:
            accepted.append(right[-1])
    assert np.mean(right) > 0.85 and accepted and np.mean(accepted) >= np.mean(right)


def test_odd_rows(spark, odd_docs, empty_docs):
    labelled = spark.createDataFrame(
        [(i, "the quick brown fox" if i % 2 else "el zorro marrón", "en" if i % 2 else "es") for i in range(40)], "doc_id bigint, text string, lang string"
    )
    model = langid.learned(labelled)
    found = langid.predicted(odd_docs, model, keep=["doc_id"]).collect()
    texts = [r["text"] for r in odd_docs.collect()]
    for text, r in zip(texts, found):
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text or "")))
    assert langid.predicted(empty_docs, model, keep=["doc_id"]).count() == 0


def test_nothing_to_learn_from(empty_docs, odd_docs):
    model = langid.learned(empty_docs)
    assert {(r["lang_pred"], r["score"]) for r in langid.predicted(odd_docs, model, keep=[]).collect()} == {("und", 0.0)}


def test_half_numbers_are_no_letters():
    model = langid.train([("a", [1], [1.0]), ("b", [2], [1.0])])
    assert langid.Scorer(model)("½ ² 12")[0] == "und"


def test_sample_is_bounded_whatever_repeats(spark):
    rows = [("copy of one text", "aa")] * 600 + [(f"text {i} {'abcdefghij'[i % 10]}", "aa") for i in range(600)] + [(f"word {i}", "bb") for i in range(50)]
    df = spark.createDataFrame(rows + [(None, "aa"), ("x", None)], "text string, lang string")
    got = langid.sampled(df, "text", "lang", 100, 1000, 10).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {"aa": 100, "bb": 50}
    assert langid.sampled(df, "text", "lang", 100, 60, 10).count() == 60
    assert [r["label"] for r in langid.sampled(df, "text", "lang", 1, 10, 1).collect()] == ["aa"]


def test_five_hundred_labels(spark):
    rows = [(f"{chr(0x4E00 + 7 * k)}{chr(0x4E03 + 7 * k)} " * 3 + str(i), f"l{k:03}") for k in range(501) for i in range(3)]
    df = spark.createDataFrame(rows + [("x y", "l500")], "text string, lang string")
    model = langid.learned(df, per_language=3)
    assert len(model.languages) == 500 and "l500" in model.languages and "l499" not in model.languages
    assert set(r["lang_pred"] for r in langid.predicted(df, model).collect()) <= {*model.languages, "und"}
