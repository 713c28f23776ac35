"""Substring dedup against a table of all windows; planted passages, odd rows, long texts."""

import hashlib
import random
import re
from collections import Counter

import pytest

from vitals.llm.substrings import without_repeats


def plain(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, window, bits=20, parts=5):
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id bigint, text string, row int, Digest string, spans int")
    result = without_repeats(docs.repartition(parts), window, bits=bits)
    got = result.collect()
    for r in got:
        spans = [(s["start"], s["words"]) for s in r["spans"]]
        assert sum(n for _, n in spans) == r["n_removed"]
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:]))
    return sorted(((r["id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=repr)


@pytest.mark.parametrize(("window", "bits", "words"), [(5, 20, 3), (5, 6, 6), (16, 20, 40), (35, 20, 3), (13, 20, 2)])
def test_equals_a_table_of_all_windows(spark, window, bits, words):
    draw = random.Random(window * 100 + words)
    vocabulary = ["a", "b", "é", "x\xa0y", "日本", "A"][:words] if words < 7 else [f"w{i}" for i in range(words)]
    passages = [[draw.choice(vocabulary) for _ in range(draw.randrange(window - 2, 3 * window))] for _ in range(6)]
    rows = [(None, None), (1, None), (1, ""), (2, " \t\n"), (3, "one"), (4, " ".join(["same"] * 100)), (5, "x y " * 60)]
    for i in range(60):
        text: list[str] = []
        for _ in range(draw.randrange(4)):
            text += [f"u{draw.random()}" if draw.random() < 0.5 else draw.choice(vocabulary) for _ in range(draw.randrange(30))]
            own = draw.choice(passages)
            cut = draw.randrange(len(own)) if draw.random() < 0.4 else 0
            text += own[cut:] if draw.random() < 0.7 else own[: cut or None]
        joined = "".join(w + draw.choice([" ", "\n", "  ", "\x0b"]) for w in text)
        rows += [(i, joined)] * draw.choice([1, 1, 1, 2])
    assert found(spark, rows, window, bits) == plain(rows, window)


def test_one_word_more_or_less(spark):
    draw = random.Random(1)
    passage = [f"p{i}" for i in range(35)]

    def doc(middle):
        own = [f"q{draw.random()}" for _ in range(50)]
        return " ".join([*own[:25], *middle, *own[25:]])

    rows = [(1, doc(passage)), (2, doc(passage)), (3, doc(passage[:34])), (4, doc(passage[1:])), (5, doc([*passage[:17], "other", *passage[17:]]))]
    result = {r[0]: r[2] for r in found(spark, rows, 35)}
    assert result == {1: 35, 2: 35, 3: 0, 4: 0, 5: 0}


def test_long_texts_copies_and_empty_table(spark, empty_docs):
    draw = random.Random(2)
    long = " ".join(f"w{draw.randrange(10**6)}" for _ in range(300_000))
    rows = [(1, long), (2, "start " + long), (3, "0" * 2_000_000), (4, "again " * 50_000), *[(10 + i, long[:2000]) for i in range(50)]]
    assert found(spark, rows, 35, parts=7) == plain(rows, 35)
    assert without_repeats(empty_docs).collect() == []
