"""Greedy string tiling against a plain implementation, and planted passages."""

import re
import time
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vitals.llm import decontaminate as d


def plain_tiles(doc, item, width):
    """Greedy string tiling from its definition: the longest unmarked match, earliest first."""
    doc_free, item_free, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = None
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and doc_free[a + n] and item_free[b + n]:
                    n += 1
                if n >= width and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return out
        a, b, n = best
        doc_free[a : a + n] = item_free[b : b + n] = [False] * n
        out.append(best)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=25), st.lists(st.integers(1, 3), max_size=16))
def test_tiles(doc, item):
    assert d.tiles(np.array(doc, np.int64), np.array(item, np.int64), 3) == plain_tiles(doc, item, 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcx"), max_size=40), st.lists(st.lists(st.sampled_from("abc"), max_size=20), min_size=1, max_size=4))
def test_tiled_items(doc, items):
    block = d.Benchmark([(f"i{k}", " ".join(words)) for k, words in enumerate(items)])
    want = []
    for k, words in enumerate(items):
        lengths = [n for _, _, n in plain_tiles(doc, words, min(5, len(words)))] if words else []
        if lengths:
            want.append((f"i{k}", sum(lengths) / len(words), len(lengths), max(lengths)))
    assert block.tiled(" ".join(doc)) == want
    assert [row for row in block.tiled(" ".join(doc), 0.8) if row[1] >= 0.8] == [row for row in want if row[1] >= 0.8]


def test_equal_hashes_of_other_words_do_not_match():
    turns = np.array([bin(k).count("1") % 2 for k in range(1 << 11)]) + 1  # the two halves' hashes meet modulo 2 ** 64
    assert [n for _, _, n in d.tiles(turns, 3 - turns, 5)][0] < 1 << 11
    half = np.array(turns[: 1 << 10])
    got = d.tiles(half, 3 - half, 700)
    assert got == plain_tiles(half.tolist(), (3 - half).tolist(), 700)


def test_one_word_repeated_on_both_sides():
    block = d.Benchmark([(1, "yes " * 2000), (2, "yes " * 1990 + "no " * 500), (3, "no")])
    tracemalloc.start()
    began = time.perf_counter()
    assert block.tiled("yes " * 20000) == [(1, 1.0, 1, 2000), (2, 1990 / 2490, 1, 1990)]
    assert time.perf_counter() - began < 5 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_ids_of_items_may_be_texts(spark):
    benchmark = spark.createDataFrame([("a", ITEM), ("b", OTHER), (None, ITEM)], "item_id string, text string")
    docs = spark.createDataFrame([("x", f"say {ITEM} twice")], "doc_id string, text string")
    got = d.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"] or "") for r in got) == [("x", ""), ("x", "a")]


ITEM = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree"
OTHER = "pack my box with five dozen liquor jugs and bring it home before the rain begins to fall"


def frames(spark, docs):
    benchmark = spark.createDataFrame([(7, ITEM), (8, OTHER), (9, "too short"), (10, None)], "item_id bigint, text string")
    return spark.createDataFrame(docs, "doc_id bigint, text string"), benchmark


def test_planted_passages(spark):
    words = ITEM.split()
    moved = " ".join(words[10:]) + " ... " + " ".join(words[:10])
    docs, benchmark = frames(spark, [
        (1, f"Before. {ITEM.upper()}! After."), (2, f"x {moved} y"), (3, " ".join(words[:9])), (4, "clean words only, nothing else here at all"),
        (5, f"{ITEM}\n\n{OTHER}"), (6, ITEM.replace("seven", "nine")), (1, ITEM), (None, OTHER),
    ])
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in d.leaks(docs, benchmark).collect())
    assert got == [(0, 8), (1, 7), (1, 7), (2, 7), (5, 7), (5, 8), (6, 7)]
    blocks = d.leaks(docs, benchmark, block_bytes=60)
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in blocks.collect()) == got
    left = d.decontaminated(docs, benchmark, block_bytes=60)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4]


def test_query_finds_whole_items(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r["doc_id"], r["item_id"]) for r in d.op10_decontaminate(spark, sf).collect()}
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r["doc_id"], words(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == {(i, j) for i, t in docs for j, s in items if s in t}


def test_odd_rows(spark, odd_docs, empty_docs):
    _, benchmark = frames(spark, [(1, "x")])
    assert d.leaks(odd_docs, benchmark).count() == 0
    left = d.decontaminated(odd_docs, benchmark)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()
    assert d.leaks(empty_docs, benchmark).count() == 0
    assert d.leaks(odd_docs, benchmark.limit(0)).count() == 0


def test_short_items_and_scripts_without_blanks(spark):
    benchmark = spark.createDataFrame(
        [(1, "Too short, really"), (2, "今日は天気がいいですね"), (3, "..."), (4, "one"), (5, ITEM), (6, "สวัสดีครับ")], "item_id bigint, text string"
    )
    docs = spark.createDataFrame(
        [(1, "It is too short; really too short really."), (2, "Too really short."), (3, "昨日、今日は天気がいいですね、と言った"), (4, "One, and one more"),
         (5, "x " + ITEM), (6, "someone"), (7, "เขาพูดว่าสวัสดีครับแล้วไป"), (8, "too short")],
        "doc_id bigint, text string",
    )
    got = sorted((r["doc_id"], r["item_id"], r["cover"], r["n_tiles"]) for r in d.leaks(docs, benchmark).collect())
    assert got == [(1, 1, 1.0, 1), (3, 2, 1.0, 1), (4, 4, 1.0, 1), (5, 5, 1.0, 1), (7, 6, 1.0, 1)]
    assert sorted(r["doc_id"] for r in d.decontaminated(docs, benchmark).collect()) == [2, 6, 8]
