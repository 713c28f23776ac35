"""Personal data by weak supervision.

Candidate spans come from patterns: ``email``, ``ip``, ``card`` and ``phone`` as their
contract says (the base), and besides ``iban``, ``ssn`` and ``name``, which are looser.
Labellers vote on each candidate, yes (+), no (-) or nothing (0): strict shapes,
checksums, gazetteers, cue words before it, what touches it, placeholders, and digits
around it. Candidates are counted by kind and vote pattern in Spark (at most 3 ** 7 rows
a kind), and expectation-maximisation estimates how reliable each labeller is for
each kind. The posteriors label a bounded sample of candidates (``sample_rows`` a kind in
expectation), on which a logistic span classifier over hashed features of the span and
its neighbours is trained. It scores every candidate. Base spans stay whatever it says;
the others count from a score of ``least`` on.

Texts are read once: candidates, votes and features go to a table in the shared folder.

Defined results: a null or empty text has no spans; spans are half-open in code points,
by kind as listed, then start; spans of different kinds may overlap; repeated rows give
repeated results; an empty table gives an empty result; other columns are not read.
"""

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import table, text_map, written

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "name")
LABELLERS = ("shape", "checksum", "gazetteer", "cue", "touching", "placeholder", "digits")
SAMPLE_ROWS = 2000
LEAST_SCORE = 0.5
BUCKETS = 1 << 12

# The contract's character sets and patterns, made possessive where that changes nothing
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
NAME = r"(?:[A-ZÀ-Þ][\w'’-]+)(?:[ ][A-ZÀ-Þ][\w'’-]+){0,2}"
SHAPES = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,24}",
    "ip": r"(?:[1-9][0-9]{0,2}|0)(?:\.(?:[1-9][0-9]{0,2}|0)){3}",
    "card": r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,5}){1,4}",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}",
    "ssn": r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}",
    "name": r"[^ ]+(?: [^ ]+){1,2}",
}
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Sr", "Sra", "Mme", "Mlle", "Name")
FIRST_NAMES = frozenset(
    "Alice Andrea Anna Antonio Carlos Carmen Claire David Elena Emma Francisco Hans Helga Isabel James Jean Jennifer John Jose "
    "Juan Julia Klaus Laura Linda Louis Lucia Luis Manuel Marie Maria Martin Mary Michael Miguel Monika Patricia Paul Peter "
    "Petra Pierre Robert Sabine Sarah Sophie Stefan Susan Thomas Ursula William Wolfgang".split()
)
DOMAIN_ENDS = frozenset("at be biz br ca ch co com de edu es eu fr gov info int io it jp mx net nl org pl ru se uk us".split())
CALLING_CODES = ("1", "7", "20", "27", "3", "4", "5", "6", "8", "9")
CARD_STARTS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35")
CUES = {
    "email": r"mail|contact|write|reach|kontakt|correo|courriel", "ip": r"\bip\b|address|server|host|login|adresse",
    "card": r"card|visa|master|credit|kredit|tarjeta|carte", "phone": r"phone|tel|call|mobile|fax|telefon|tél|llam",
    "iban": r"iban|account|konto|cuenta|compte|bank", "ssn": r"ssn|social|security|tax|sozial",
    "name": r"contact|name|dear|signed|regards|kontakt|liebe|querid|cher",
}
COUNTER_CUES = r"version|release|build|order|invoice|isbn|article|section|chapter|page|\bv\.?$|\bno\.?$|#$"
PLACEHOLDERS = r"^(?:test|example|noreply|no-reply|user|foo)@|0{6}|1234567|(\d)\1{6}|^0\.0\.0\.0$|^127\.|John Doe|Jane Doe"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


class Finder:
    """Candidates of one text, with their votes and features."""

    def __init__(self):
        import ahocorasick

        self.domain = re.compile(DOMAIN).match
        self.patterns = [(k, re.compile(p).finditer) for k, p in (("ip", IP), ("card", CARD), ("phone", PHONE), ("iban", IBAN), ("ssn", SSN))]
        self.name = re.compile(NAME).match
        self.shapes = {k: re.compile(p).fullmatch for k, p in SHAPES.items()}
        self.cues = {k: re.compile(p, re.IGNORECASE).search for k, p in CUES.items()}
        self.counter = re.compile(COUNTER_CUES, re.IGNORECASE).search
        self.placeholder = re.compile(PLACEHOLDERS).search
        self.names = ahocorasick.Automaton()
        for word in (*TITLES, *FIRST_NAMES):
            self.names.add_word(word, (len(word), word in FIRST_NAMES))
        self.names.make_automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out = self._emails(text)
        for kind, find in self.patterns:
            out += [(kind, m.start(), m.end()) for m in find(text) if self._counts(kind, m[0])]
        return out + self._names(text)

    def _emails(self, text: str) -> list[tuple[str, int, int]]:
        out, done, at = [], 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            found = self.domain(text, at + 1) if start < at else None
            if found:
                done = found.end()
                out.append(("email", start, done))
            at = text.find("@", found.end() if found else at + 1)
        return out

    @staticmethod
    def _counts(kind: str, found: str) -> bool:
        if kind == "ip":
            return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
        if kind in ("card", "phone"):
            digits = "".join(c for c in found if c.isdigit())
            return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15
        return True

    def _names(self, text: str) -> list[tuple[str, int, int]]:
        out, done = [], 0
        for last, (size, first_name) in self.names.iter(text):
            start, end = last - size + 1, last + 1
            if start < done or start and text[start - 1].isalnum() or text[end : end + 1].isalnum():
                continue
            if not first_name:  # a title: the name follows it
                start = end
                while text[start : start + 1] in (".", ":", " ") and start - end < 3:
                    start += 1
                if start == end:
                    continue
            found = self.name(text, start)
            if found and (not first_name or " " in found[0]):
                done = found.end()
                out.append(("name", start, done))
        return out

    def votes(self, text: str, kind: str, start: int, end: int) -> str:
        found, before = text[start:end], text[max(0, start - 30) : start]
        digits = "".join(c for c in found if c.isdigit())
        marks = ["+" if self.shapes[kind](found) else "-"]
        if kind == "iban":
            moved = "".join(str(int(c, 36)) for c in found[4:] + found[:4])
            marks.append("+" if int(moved) % 97 == 1 else "-")
        else:
            marks.append("+" if kind == "card" else "0")
        marks.append(self._listed(kind, found, digits))
        marks.append("-" if self.counter(before.rstrip()) else "+" if self.cues[kind](before) else "0")
        left, right = text[start - 1 : start] if start else "", text[end : end + 1]
        marks.append("-" if left.isalnum() or left in "_-/=" and left or right.isalnum() or right in "_/=" and right else "+")
        marks.append("-" if self.placeholder(found) else "0")
        around = before + text[end : end + 30]
        marks.append("-" if sum(c.isdigit() for c in around) > len(around) / 3 else "+")
        return "".join(marks)

    @staticmethod
    def _listed(kind: str, found: str, digits: str) -> str:
        if kind == "email":
            return "+" if found.rpartition(".")[2].lower() in DOMAIN_ENDS else "0"
        if kind == "ip":
            parts = [int(p) for p in found.split(".")]
            private = parts[0] in (0, 10, 127) or parts[:2] == [192, 168] or parts[0] >= 224
            return "-" if private else "+"
        if kind == "card":
            return "+" if CARD_STARTS.match(digits) else "-"
        if kind == "phone":
            return "+" if digits.startswith(CALLING_CODES) else "-"
        if kind == "name":
            return "+" if found.split(" ")[0] in FIRST_NAMES else "0"
        return "0"

    @staticmethod
    def features(text: str, kind: str, start: int, end: int) -> str:
        found = text[start:end]
        shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", found)))
        left = re.split(r"\s", text[max(0, start - 20) : start].rstrip())[-1].lower()
        right = re.split(r"\s", text[end : end + 20].lstrip())[0].lower()
        parts = [kind, f"{kind}:{shape[:24]}", f"{kind}:{min(len(found), 40) // 4}", f"<{kind}:{left}", f">{kind}:{right}"]
        parts += [f"<{text[max(0, start - 1) : start]}", f">{text[end : end + 1]}", f"{kind}:first:{found[:3]}", f"{kind}:last:{found[-3:]}"]
        return " ".join(str(zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS) for p in parts)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``found`` (array of structs kind, start, end, votes, features) of every row."""

    def make():
        finder = Finder()

        def one(text: str | None):
            text = text or ""
            spans = finder.spans(text)
            return (
                [k for k, _, _ in spans], [s for _, s, _ in spans], [e for _, _, e in spans],
                [finder.votes(text, *s) for s in spans], [finder.features(text, *s) for s in spans],
            )

        return one

    schema = "kind array<string>, start array<int>, end array<int>, votes array<string>, features array<string>"
    udf = text_map(docs.sparkSession, schema, make)
    rows = docs.select(F.col(id_col).alias("doc_id"), udf(F.col(text_col)).alias("r"))
    return rows.select("doc_id", F.arrays_zip("r.kind", "r.start", "r.end", "r.votes", "r.features").alias("found"))


def estimate(patterns: list[tuple[str, int]], rounds: int = 100) -> tuple[dict[str, float], list[float]]:
    """Posterior of each vote pattern of one kind, and the labellers' reliabilities.

    The rounds begin with the majority of the votes, a checksum counting three times.
    """
    patterns = sorted(patterns)
    cast = np.array([[{"-": -1, "0": 0, "+": 1}[v] for v in p] for p, _ in patterns])
    weight = np.array([n for _, n in patterns], float)
    yes = 1 / (1 + np.exp(-(cast * [1, 3, 1, 1, 1, 1, 1]).sum(1)))
    for _ in range(rounds):
        log = []
        for own in (yes, 1 - yes):
            mass = weight * own
            counts = np.stack([(mass[:, None] * (cast == v)).sum(0) + 1 for v in (-1, 0, 1)], 1)
            part = np.log(counts / counts.sum(1, keepdims=True))
            log.append(np.log((mass.sum() + 1) / (weight.sum() + 2)) + sum(part[k, cast[:, k] + 1] for k in range(cast.shape[1])))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        moved, yes = np.abs(new - yes).max(), new
        if moved < 1e-9:
            break
    right = (weight[:, None] * ((cast == 1) * yes[:, None] + (cast == -1) * (1 - yes[:, None]))).sum(0)
    reliable = right / np.maximum((weight[:, None] * (cast != 0)).sum(0), 1e-9)
    return {p: float(y) for (p, _), y in zip(patterns, yes)}, reliable.tolist()


def fit(rows: list[tuple[str, float]], epochs: int = 20, rate: float = 0.5, seed: int = 5) -> np.ndarray:
    """Weights of the span classifier, by stochastic gradient descent on soft labels."""
    weights = np.zeros(BUCKETS)
    data = [(np.array(sorted({int(f) for f in features.split()})), label) for features, label in sorted(rows)]
    random, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        for i in random.permutation(len(data)):
            at, label = data[i]
            slope = rate * (1 - step / (epochs * len(data)))
            step += 1
            weights[at] -= slope * (1 / (1 + np.exp(-np.clip(weights[at].sum(), -30, 30))) - label)
    return weights


def learned(found: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """The span classifier's weights, from the votes on all candidates of ``found``."""
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.start", "c.votes", "c.features")
    counted = each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    by_kind: dict[str, list[tuple[str, int]]] = {}
    for row in counted:
        by_kind.setdefault(row["kind"], []).append((row["votes"], row["n"]))
    posterior = {kind: estimate(patterns)[0] for kind, patterns in by_kind.items()}
    draw, chosen = F.pmod(F.xxhash64("kind", "features", "start"), F.lit(1 << 30)) / float(1 << 30), F.lit(False)
    for kind, patterns in by_kind.items():
        share = min(1.0, sample_rows / sum(n for _, n in patterns))
        chosen = chosen | ((F.col("kind") == kind) & (draw < share))
    sample = each.filter(chosen).select("kind", "votes", "features").collect()
    return fit([(r["features"], posterior[r["kind"]][r["votes"]]) for r in sample])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SCORE, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id`` and ``spans`` (array of structs kind, start, end, score) of every row."""
    found = written(candidates(docs, id_col, text_col), "candidates")
    weights = learned(found, sample_rows)

    def make():
        def one(features):
            sums = [weights[list({int(x) for x in f.split()})].sum() for f in features]
            return ([float(1 / (1 + np.exp(-np.clip(s, -500, 500)))) for s in sums],)

        return one

    udf = text_map(docs.sparkSession, "scores array<double>", make)
    scored = found.select("doc_id", "found", udf(F.col("found.features"))["scores"].alias("scores"))
    spans = F.transform(
        F.arrays_zip("found", "scores"),
        lambda z: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), z["found"]["kind"]).alias("order"), z["found"]["start"].alias("start"),
            z["found"]["end"].alias("end"), z["found"]["kind"].alias("kind"), z["scores"].alias("score"),
        ),
    )
    counted = F.filter(spans, lambda s: (s["order"] <= len(BASE)) | (s["score"] >= least))
    return scored.select("doc_id", F.sort_array(counted).alias("s")).select(
        "doc_id", F.transform("s", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"))).alias("spans")
    )


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
