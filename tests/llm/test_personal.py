"""Personal data: base spans against the contract's patterns, votes, estimation, scores."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from vitals.llm import personal as p

FIND = p.Finder()


def digits(text):
    return "".join(c for c in text if c in "0123456789")


def brute(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in reversed(digits(m[0]))]
        total = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


PIECES = st.sampled_from(["a.b", "@", "x-1.de", ".", "1", "255", "256", "1.2.3", "0", "4111 1111 1111 1111", "-", " ", "+1", "(0)", "555-0123", "é", "\n", "79927398713"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_match_the_patterns(text):
    assert [s for s in FIND.spans(text) if s[0] in p.BASE] == brute(text)


def test_added_kinds():
    text = "Dear Anna Müller, IBAN DE89370400440532013000, SSN 123-45-6789. Mr. John Smith wrote."
    assert {(k, text[a:b]) for k, a, b in FIND.spans(text)} == {
        ("name", "Anna Müller"), ("name", "John Smith"), ("iban", "DE89370400440532013000"), ("ssn", "123-45-6789"),
    }
    votes = {k: FIND.votes(text, k, a, b) for k, a, b in FIND.spans(text)}
    assert votes["iban"][:2] == "++" and votes["ssn"][3] == "+"
    assert FIND.votes("x DE00370400440532013000 y", "iban", 2, 24)[1] == "-"
    assert FIND.votes("release 1.2.3.4", "ip", 8, 15)[3] == "-"


def test_estimation_finds_the_unreliable_labeller():
    # five labellers agree with the hidden truth, the second is noise, the last is mostly wrong
    patterns = [("+++++0-", 300), ("+-+++0-", 300), ("-+---0+", 200), ("-----0+", 200), ("+++++0+", 30), ("-----0-", 20)]
    posterior, reliable = p.estimate(patterns)
    assert posterior["+-+++0-"] > 0.9 and posterior["-+---0+"] < 0.1
    assert reliable[0] > 0.95 and reliable[6] < 0.2


def test_query_on_a_table(spark):
    got = {r["doc_id"]: r for r in p.op5_personal(spark, SF_SMALL).collect()}
    for row in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        spans = brute(row["text"] or "")
        mine = got.pop(row["doc_id"])
        assert [mine[f"n_{k}"] for k in p.BASE] == [sum(s[0] == k for s in spans) for k in p.BASE]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert mine["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(mine["spans"].split(","))
    assert not got


def test_odd_rows(odd_docs, empty_docs):
    found = p.personal_data(odd_docs)
    assert found.columns == ["doc_id", "spans"] and found.count() == odd_docs.count()
    assert all(r["spans"] == [] for r in found.collect())
    assert p.personal_data(empty_docs).count() == 0


def test_the_classifier_drops_added_spans_that_labellers_reject(spark):
    good = [(i, f"account iban DE89370400440532013000 of customer {i}") for i in range(40)]
    bad = [(100 + i, f"part XX99{'ABCDEFGHIJK' * 2}/{i} in stock") for i in range(40)]
    docs = spark.createDataFrame([*good, *bad], "doc_id bigint, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in p.personal_data(docs).collect()}
    assert all(got[i] == ["iban"] for i, _ in good) and all(got[i] == [] for i, _ in bad)
