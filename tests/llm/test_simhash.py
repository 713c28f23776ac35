"""SimHash near-duplicates against brute force."""

import numpy as np
import pytest
import xxhash

from tests.conftest import SF_SMALL
from vitals.llm import simhash


def plain_print(text):
    """The fingerprint bit by bit, from its definition."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def plain_groups(prints, distance=3):
    least = {p: p for p in prints}
    values = np.array(sorted(least), dtype=np.uint64)
    changed = True
    near = {int(v): values[np.bitwise_count(values ^ v) <= distance].tolist() for v in values}
    while changed:
        changed = False
        for v, others in near.items():
            low = min(least[o] for o in others)
            changed |= low < least[v]
            least[v] = min(low, least[v])
    return least


def test_fingerprints_and_groups_on_a_table(spark):
    got = simhash.op1_simhash(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    prints = {i: plain_print(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    least = plain_groups(set(prints.values()))
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(least[p], i)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: first[least[p]] for i, p in prints.items()}


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5])
def test_no_link_is_missed(spark, distance):
    random = np.random.default_rng(distance)
    values = set()
    for _ in range(60):  # clusters that differ in few bits, in every segment
        centre = int(random.integers(0, 1 << 63))
        for _ in range(6):
            flips = random.choice(64, int(random.integers(0, 6)), replace=False)
            values.add(centre ^ sum(1 << int(b) for b in flips))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), distance).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance}
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)


def test_distances_that_three_segments_cannot_decide(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), 6)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 300)]
    star = [(1, i) for i in range(2, 60)]
    got = simhash.components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in got} == {**dict.fromkeys(range(100, 301), 100), **dict.fromkeys(range(1, 60), 1)}


def test_odd_rows(odd_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["id"]: r for r in got if r["id"] is not None}
    assert by_id[2]["fp"] == by_id[3]["fp"] == by_id[4]["fp"] == 0
    assert {r["component_id"] for r in got if r["fp"] == 0} == {2}
    assert {r["component_id"] for r in got if r["id"] in (1, 8)} == {1}  # A-Z only differ


def test_deduplicated_keeps_one_of_each_group(odd_docs):
    kept = simhash.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(rows) == len(set(rows)) == 6  # 1+1+8; 2+3+4+null; the null id with a text; 5; 6; 7
    assert {i for i, _ in rows} == {1, 2, 5, 6, 7, None}


def test_same_id_with_other_texts(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "x y z w"), (2, "x y z w"), (1, "a b c d")], "doc_id bigint, text string")
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.deduplicated(docs).collect())
    assert kept == [(1, "a b c d"), (1, "x y z w")]


def test_empty(empty_docs):
    assert simhash.near_duplicates(empty_docs).count() == 0
    assert simhash.deduplicated(empty_docs).count() == 0
