"""Phrase mining against counting everything, with maps so small that they leave nothing out."""

import random
import re
from collections import Counter

import pytest

from vitals.llm.phrases import LONGEST, collocations


def plain(rows, support, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, LONGEST + 1):
                for i in range(len(words) - size + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        inside = {
            (p[i : i + size], a) for p, a in found.items() for size in range(2, len(p)) for i in range(len(p) - size + 1)
        }
        ranked = []
        for p, a in found.items():
            if (p, a) not in inside:
                score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def random_rows():
    draw = random.Random(7)
    words = ["The", "the", "cat", "sat", "on", "mat", "É", "é", "日本", "x\xa0y", "a-b", "#1"]
    rows = [(None, "en"), ("", "en"), (" \t\n", None), ("... !!", "de"), ("cat " * 3000, "en"), ("one two\x0bthree four\rfive", "en")]
    for _ in range(150):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(draw.randrange(60)))
        rows += [(text, draw.choice(["en", "de", None, "und", "DE"]))] * draw.choice([1, 1, 1, 4])
    return rows


@pytest.mark.parametrize(("support", "top", "bits"), [(3, 2000, 20), (4, 5, 6), (9, 30, 20)])
def test_equals_counting_everything(spark, support, top, bits):
    rows = random_rows()
    docs = spark.createDataFrame([(t, x, "k", 1, 2) for t, x in rows], "text string, lang string, phrase string, n int, Score int").repartition(6)
    found = collocations(docs, support=support, top=top, bits=bits)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, support, top)


def test_many_words_of_one_text_and_products_beyond_64_bits(spark):
    rows = [("new york " * 200_000, "en"), ("York new", "en")]
    found = collocations(spark.createDataFrame(rows, "text string, lang string"), bits=20)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 100, 2000)


def test_empty_table(spark, empty_docs):
    assert collocations(empty_docs, bits=10).collect() == []


def test_odd_docs(spark, odd_docs):
    from pyspark.sql import functions as F

    found = collocations(odd_docs.withColumn("lang", F.lit("xx")), support=2, bits=16)
    rows = [(r["text"], "xx") for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, 2, 2000)
