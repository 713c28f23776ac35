"""Secrets in texts: keyword prefilter, anchored patterns near the hits, checksums.

An Aho-Corasick automaton reads a text once and reports where a keyword stands.
Only there is the pattern of that keyword tried, anchored at the keyword's first
letter, so the patterns never run over a whole text. A run of hex digits has no
keyword; a run of 16 covers one of the places 15, 31, 47 and so on, so every
sixteenth character is probed, and the pattern runs at the start of the run there.

Kinds: ``assign``, ``access`` and ``hex`` are matched as their contract says, the
leftmost without overlap of a kind, failing matches dropped without another try.
``github`` and ``npm`` tokens carry a checksum, the CRC-32 of their random part in six
base-62 digits: a match counts only if it holds. ``pem`` is a private key block, with any header
lines ("DEK-Info: ..."), also inside a string literal, where line breaks are escaped.

Defined results: a null or empty text has no spans; spans are half-open in code
points, by start, then kind; repeated rows give repeated results; an empty table
gives an empty result. Only the text reaches the tasks, and rows are independent.
"""

import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import applied, fresh, table, text_map

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "pem")

# The patterns of the contract and of public token formats
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
CHECKED = r"[A-Za-z0-9]+_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
_PEM_HEADER = r"""(?:[\r\n]|\\[rn])[\x20\t"']*[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)*:[\x20\t](?:(?!-----)[^\r\n\\])*"""
_PEM_NAME = r"(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
PEM = rf"""-----BEGIN {_PEM_NAME}(?:{_PEM_HEADER}|[A-Za-z0-9+/=\s:,\\"'])++-----END {_PEM_NAME}"""
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "pem": ("-----begin ",),
}
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16


def checksum(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    rest, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        out = DIGITS62[digit] + out
    return out


class Scanner:
    """Finds the spans (start, kind number, end) of one text."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word, (KINDS.index(kind), len(word)))
        self.automaton.make_automaton()
        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE).match
        self.access = re.compile(ACCESS).match
        self.checked = re.compile(CHECKED).match
        self.pem = re.compile(PEM).match
        self.hex_run = re.compile(r"[0-9a-f]+").match
        self.hex_probe = re.compile(r"[0-9a-f]").finditer

    def _ends(self, kind: int, text: str, start: int) -> tuple[int, bool] | None:
        """End of the match at ``start`` and whether it counts; None if nothing matches."""
        name = KINDS[kind]
        if name == "assign":
            found = self.assign(text, start)
            return found and (found.end(), len(found[2]) >= LEAST_VALUE)
        if name == "access":
            found = self.access(text, start)
            return found and (found.end(), found.end() - start >= LEAST_ACCESS)
        if name == "pem":
            found = self.pem(text, start)
            return found and (found.end(), True)
        found = self.checked(text, start)
        return found and (found.end(), checksum(found[1]) == found[2])

    def _hex(self, text: str) -> list[tuple[int, int, int]]:
        spans, done = [], 0
        for hit in self.hex_probe(text[LEAST_HEX - 1 :: LEAST_HEX]):
            start = LEAST_HEX * hit.start() + LEAST_HEX - 1
            if start < done:
                continue
            done = self.hex_run(text, start).end()
            low = start - LEAST_HEX + 1  # the place probed before was no hex digit, or its run has ended
            while start > low and text[start - 1] in "0123456789abcdef":
                start -= 1
            if done - start >= LEAST_HEX:
                spans.append((start, KINDS.index("hex"), done))
        return spans

    def __call__(self, text: str) -> list[tuple[int, int, int]]:
        lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: places stay
        spans = self._hex(text)
        done = dict.fromkeys(range(len(KINDS)), 0)
        starts = sorted((end - size + 1, kind) for end, (kind, size) in self.automaton.iter(lower))
        for start, kind in starts:
            if start >= done[kind] and (found := self._ends(kind, text, start)):
                done[kind] = found[0]
                if found[1]:
                    spans.append((start, kind, found[0]))
        return sorted(spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span, or union of overlapping spans, replaced by ``[secret]``."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join(parts) + text[at:] if parts else text


def secrets(df: DataFrame, text: str | Column = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and the spans: ``kinds``, ``starts``,
    ``ends`` (arrays of equal length), and ``masked``, the text without them."""

    def make():
        scan = Scanner()

        def one(value: str | None):
            spans = scan(value or "")
            starts, kinds, ends = zip(*spans) if spans else ((), (), ())
            return [KINDS[k] for k in kinds], list(starts), list(ends), value if value is None else masked(value, spans)

        return one

    schema = "kinds array<string>, starts array<int>, ends array<int>, masked string"
    return applied(df, text_map(df.sparkSession, schema, make), text, df.columns if keep is None else keep)


def span_text(base: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of all spans (or the kinds in ``base``), comma-joined."""
    zipped = F.arrays_zip("kinds", "starts", "ends")
    if base:
        zipped = F.filter(zipped, lambda s: s["kinds"].isin(*base))
    return F.array_join(F.transform(zipped, lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"])), ",")


def count_kind(kind: str) -> Column:
    return F.size(F.filter("kinds", lambda k: k == kind)).cast("bigint")


def without_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret in the text masked, and the length column (if the
    table has it) set anew where the text changed."""
    found = docs.withColumn(fresh(docs, "scan"), text_map(docs.sparkSession, "masked string", _masking)(F.col(text_col)))
    masked_text = F.col(fresh(docs, "scan"))["masked"]
    out = []
    for column in docs.columns:
        if column == text_col:
            out.append(masked_text.alias(column))
        elif column == length_col:
            same = masked_text.eqNullSafe(F.col(text_col))
            kind = docs.schema[column].dataType
            out.append(F.when(same, F.col(column)).otherwise(F.char_length(masked_text).cast(kind)).alias(column))
        else:
            out.append(F.col(column))
    return found.select(*out)


def _masking():
    scan = Scanner()
    return lambda value: (value if value is None else masked(value, scan(value)),)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id",
        *(count_kind(k).alias(f"n_{k}") for k in BASE),
        F.sha2(span_text(BASE), 256).alias("base_sha256"),
        span_text().alias("spans"),
    )
