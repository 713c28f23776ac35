"""Secret spans against the contract's patterns run over whole texts."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from vitals.llm import secret_scan as s

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


PIECES = st.sampled_from(
    ["token", "TOKEN", "api_key", "apikey", "password", "=", ": ", '"', "AKIA", "ABCDEFGH01", "deadbeef", "0123456789abcdef", "x", " ", "é", "ſecret", "abcdefghijkl"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_spans_match_the_patterns(text):
    assert [x for x in SCAN(text) if x[1] < 3] == brute(text)


SCAN = s.Scanner()


def test_checksums():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    good = f"ghp_{body}{s.checksum(body)}"
    assert SCAN(f"x {good} y") == [(2, s.KINDS.index("github"), 2 + len(good))]
    assert SCAN(f"x {good[:-1]}{'a' if good[-1] != 'a' else 'b'} y") == []
    assert SCAN("npm_" + body + s.checksum(body))[0][1] == s.KINDS.index("npm")
    assert SCAN("-----BEGIN RSA PRIVATE KEY-----\nMIIB\n-----END RSA PRIVATE KEY-----")[0][1] == s.KINDS.index("pem")


def test_masking_joins_overlaps():
    text = 'a token="0123456789abcdef0123" z'
    assert s.masked(text, SCAN(text)) == 'a [secret]" z'


def test_query_on_a_table(spark):
    got = {r["doc_id"]: r for r in s.op4_secrets(spark, SF_SMALL).collect()}
    for row in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        spans = brute(row["text"] or "")
        mine = got.pop(row["doc_id"])
        assert [mine[f"n_{k}"] for k in s.BASE] == [sum(x[1] == i for x in spans) for i in range(3)]
        joined = ",".join(f"{s.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert mine["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(mine["spans"].split(","))
    assert not got


def test_odd_rows(spark, odd_docs, empty_docs):
    found = s.secrets(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert [(r["starts"], r["ends"]) for r in found if r["doc_id"] == 7] == [([0], [70_000])]
    assert all(r["kinds"] == [] for r in found if not r["text"])
    clean = s.without_secrets(odd_docs)
    assert clean.columns == odd_docs.columns
    assert [r["text"] for r in clean.collect() if r["doc_id"] == 7] == ["[secret]"]
    assert s.secrets(empty_docs).count() == 0 and s.without_secrets(empty_docs).columns == empty_docs.columns
    docs = spark.createDataFrame([(1, "AKIA" + "A" * 16, 20), (2, "fine", 4)], "doc_id bigint, text string, n_chars bigint")
    assert [tuple(r) for r in s.without_secrets(docs).collect()] == [(1, "[secret]", 8), (2, "fine", 4)]


def test_private_keys_with_headers_and_in_strings():
    body = "\nMIIEpAIBAAKCAQEA7\nq+/Z0==\n"
    blocks = [
        f"-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0F3A\n{body}-----END RSA PRIVATE KEY-----",
        f"-----BEGIN PGP PRIVATE KEY BLOCK-----\r\nVersion: GnuPG v2.0.22 (GNU/Linux)\r\nComment: a_b <c@d>\r\n{body}=aB3x\n-----END PGP PRIVATE KEY BLOCK-----",
        f"-----BEGIN PRIVATE KEY-----{body}-----END PRIVATE KEY-----",
    ]
    blocks += [b.replace("\r", "\\r").replace("\n", "\\n") for b in blocks]
    blocks.append('-----BEGIN EC PRIVATE KEY-----\\n" +\n  "MIIE/q0\\n" +\n  "-----END EC PRIVATE KEY-----')
    for block in blocks:
        text = f'key = "{block}\\n" and -----END PRIVATE KEY-----'
        assert [x for x in SCAN(text) if x[1] == s.KINDS.index("pem")] == [(7, s.KINDS.index("pem"), 7 + len(block))]
    for other in ("-----BEGIN PUBLIC KEY-----\nMIIB\n-----END PUBLIC KEY-----", "-----BEGIN PRIVATE KEY-----\nno end - and so on", "-----BEGIN PRIVATE KEY-----" + body * 50_000):
        assert [x for x in SCAN(other) if x[1] == s.KINDS.index("pem")] == []
