"""Conversation repair: the search against dynamic programming, blocks of any size, odd rows."""

import hashlib
import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from vitals.llm.repair import LEGAL_END, START, cheapest, digests, op11_repair, repaired, symbol

FOLLOWING = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def plain(rows, start=0, ends=(0, 3)):
    """Least (cost, audit) for (initial, fault) rows by trying all edits row by row."""

    def insertions(states):
        for _ in range(4):
            for s, (cost, audit) in list(states.items()):
                found = (cost + 2, audit + "I")
                if found < states.get(FOLLOWING[s], (10**9, "")):
                    states[FOLLOWING[s]] = found
        return states

    states = insertions({start: (0, "")})
    for initial, fault in rows:
        following = {}
        for s, (cost, audit) in states.items():
            ways = [(s, cost + 3, audit + "D")]
            if fault != 1:
                extra = fault == 2
                ways.append((FOLLOWING[s], cost + 2 + extra, audit + "R"))
                if (s, initial) in KEPT:
                    ways.append((KEPT[s, initial], cost + extra, audit + "K"))
            for to, c, a in ways:
                if (c, a) < following.get(to, (10**9, "")):
                    following[to] = (c, a)
        states = insertions(following)
    return min((states[s] for s in ends if s in states), default=None)


def test_search_equals_dynamic_programming():
    draw = random.Random(3)
    for _ in range(4000):
        rows = [(draw.choice("suuaax") if draw.random() < 0.97 else "", draw.choice([0, 0, 0, 1, 2])) for _ in range(draw.randrange(12))]
        start, ends = (START, LEGAL_END) if draw.random() < 0.5 else (draw.randrange(4), (draw.randrange(4),))
        symbols = "".join(symbol(*r) for r in rows)
        assert cheapest(symbols, start, ends) == plain(rows, start, ends), rows


def test_search_on_a_long_conversation():
    draw = random.Random(4)
    rows = [(draw.choice("suuaa"), draw.choice([0, 0, 0, 0, 1, 2])) for _ in range(700)]
    assert cheapest("".join(symbol(*r) for r in rows), START, LEGAL_END) == plain(rows)


def by_hand(rows):
    """The contract's row for one conversation of (turn, role, text), in plain Python."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    )
    seen, faults, counts = set(), [], {1: 0, "d": 0, 2: 0}
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        fault = 1 if not words else "d" if (role, text) in seen else 2 if words[-1] not in ".!?" else 0
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        faults.append(1 if fault == "d" else fault)
    cost, audit = plain([(r[1][:1], f) for r, f in zip(rows, faults)])
    out, state, i = [], 0, 0
    for edit in audit:
        if edit == "D":
            i += 1
        elif edit == "I":
            state = FOLLOWING[state]
            out.append(("user:", "assistant:")[state == 3])
        else:
            _, role, text = rows[i]
            i += 1
            state = KEPT[state, role[:1]] if edit == "K" else FOLLOWING[state]
            out.append(f"{role if edit == 'K' else ('user', 'assistant')[state == 3]}:{text}")
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, counts[1], counts["d"], counts[2], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def found_rows(turns, block_rows):
    conversations, pieces = repaired(turns, block_rows=block_rows)
    joined = conversations.join(digests(pieces).withColumnRenamed("id", "other"), F.col("id").eqNullSafe(F.col("other")), "left").drop("other")
    return {tuple(r)[0]: tuple(r)[1:] for r in joined.collect()}


def random_turns():
    draw = random.Random(5)
    texts = ["Yes.", "No!", "so", "", " \n", "Why?", None, "Es ist gut.  ", "é", "a:b\nc."]
    out = []
    for conv in [None, *range(40)]:
        for _ in range(draw.choice([1, 2, 5, 8, 30]) if conv != 7 else 400):
            turn = None if draw.random() < 0.05 else draw.randrange(12) if conv != 7 else draw.randrange(900)
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            out.append((conv, turn, role, draw.choice(texts) if conv != 7 or draw.random() < 0.5 else f"line {draw.random()}."))
    return out


@pytest.mark.parametrize("block_rows", [256, 3])
def test_blocks_give_the_same_as_plain_code(spark, block_rows):
    given = random_turns()
    turns = spark.createDataFrame([(*r, "x", 1) for r in given], "conv_id bigint, turn bigint, role string, text string, id string, place int")
    expected = {}
    for conv, *row in given:
        expected.setdefault(conv, []).append(row)
    found = found_rows(turns.repartition(5), block_rows)
    assert found.keys() == expected.keys()
    for conv, rows in expected.items():
        assert found[conv] == by_hand(rows), conv


def test_long_texts_and_empty_table(spark):
    schema = "conv_id string, turn int, role string, text string"
    rows = [("a", 1, "user", "word " * 400_000 + "end."), ("a", 2, "assistant", "x" * 1_000_000), ("a", 3, "assistant", " " * 1_000_000)]
    assert found_rows(spark.createDataFrame(rows, schema), 256)["a"] == by_hand([r[1:] for r in rows])
    assert found_rows(spark.createDataFrame([], schema), 256) == {}


def test_query_on_odd_rows(spark, tmp_path):
    given = random_turns() + [(99, t, "user", "gone") for t in range(2000) if crc32(f"99:{t}".encode()) % 20 == 0][:2]
    spark.createDataFrame(given, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    expected = {r[0]: [] for r in given}
    for conv, turn, role, text in given:
        role, text = " " if role is None else role, " " if text is None else text
        damage = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if damage:
            text = "" if damage == 1 else text.translate(str.maketrans("", "", ".!?")) if damage == 2 else text
            expected[conv] += [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1)
    found = {r[0]: tuple(r)[1:] for r in op11_repair(spark, str(tmp_path)).collect()}
    assert found == {c: by_hand(rows) for c, rows in expected.items()}
    assert found[99] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
