"""Quality classifier from weak labels.

Heuristic labellers vote good (+1), bad (-1) or nothing (0) on every text. Their
votes overlap and err. All texts are counted by vote pattern in Spark (at most
3 ** labellers rows), and expectation-maximisation over the patterns estimates how
often each labeller is right, given either class, and how likely each pattern is to be
good. These posteriors are the labels of a linear scorer on hashed features: the
frequencies of runs of three character classes, and the bins of the measurements.
It is fitted on a bounded sample (``sample_rows`` texts in expectation, drawn by a
hash from all rows), and scores every whole text. Given labels are not used.

Defined results: a null text, or one without a word, has score 0 and is rejected; so
is nothing else if no text has a word. Equal texts have equal scores; repeated rows
give repeated results; an empty table gives an empty result; other columns are neither
read nor touched.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import applied, fresh, table, text_map

SAMPLE_ROWS = 4000
BUCKETS = 1 << 10
LEAST_SCORE = 0.5
# What the estimation begins with: a vote for bad names a fault, a vote for good only the absence of one
BAD_VOTE, GOOD_VOTE = -3.0, 0.3
BLOCK = 1 << 20  # characters whose classes are counted at once

# Labellers: measurement, bad beyond, good below (or the reverse where bad is the smaller)
LABELLERS: dict[str, tuple[str, float, float]] = {
    "symbols": ("symbols_per_word", 0.2, 0.02),
    "exclamations": ("exclamations_per_word", 0.3, 0.05),
    "shouting": ("upper_per_letter", 0.5, 0.2),
    "letters": ("letters_per_mark", 0.75, 0.92),
    "variety": ("distinct_words", 0.3, 0.5),
    "repetition": ("distinct_pairs", 0.5, 0.8),
    "line_ends": ("ended_lines", 0.4, 0.9),
    "line_copies": ("distinct_lines", 0.5, 0.9),
}
FEW = 10  # letters that a text is taken to have besides its own, so that short texts aren't judged by one mark
# Character classes: 1 lower, 2 upper, 3 other letter, 4 digit, 5 blank, 6 line break, 7 stop, 8 pause, 9 symbol, 0 other
_CLASSES = {
    1: "abcdefghijklmnopqrstuvwxyz", 2: "ABCDEFGHIJKLMNOPQRSTUVWXYZ", 4: "0123456789", 5: " \t\x0b\f\r", 6: "\n",
    7: ".!?", 8: ",;:'\"()-", 9: "#*$%&|<>",
}


def _table() -> np.ndarray:
    classes = np.zeros(256, np.uint8)
    classes[128:] = 3
    for number, letters in _CLASSES.items():
        for c in letters:
            classes[ord(c)] = number
    return classes


@dataclass
class Measured:
    """The measurements of a text and the counts of its runs of three classes."""

    values: dict[str, float]
    runs: np.ndarray


def measure(text: str, classes: np.ndarray) -> Measured | None:
    """None for a text without a word."""
    words = text.split()
    if not words:
        return None
    runs = np.zeros(1000)
    counts = np.zeros(10)
    exclamations = text.count("!")
    for at in range(0, len(text), BLOCK):
        part = np.frombuffer(text[at : at + BLOCK + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes[np.minimum(part, 255)].astype(np.int64)
        counts += np.bincount(kind[:BLOCK], minlength=10)
        if len(kind) > 2:
            runs += np.bincount(kind[:-2] * 100 + kind[1:-1] * 10 + kind[2:], minlength=1000)
    letters = counts[1] + counts[2] + counts[3]
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    pairs = len(words) - 1
    return Measured(
        {
            "symbols_per_word": counts[9] / len(words),
            "exclamations_per_word": exclamations / len(words),
            "upper_per_letter": counts[2] / (letters + FEW),
            "letters_per_mark": (letters + counts[4] + FEW) / (len(text) - counts[5] - counts[6] + FEW),
            # long texts use words again: as if the text had 100 words at most
            "distinct_words": min(1.0, len(set(words)) / min(len(words), 100)),
            "distinct_pairs": len(set(zip(words, words[1:]))) / pairs if pairs else 1.0,
            "ended_lines": (sum(x[-1] in ".!?" for x in lines) + 1) / (len(lines) + 1),
            "distinct_lines": len(set(lines)) / len(lines),
        },
        runs,
    )


def votes(measured: Measured | None) -> tuple[int, ...]:
    out = []
    for name, bad, good in LABELLERS.values():
        value = measured.values[name] if measured else None
        sign = 1 if bad > good else -1
        out.append(0 if value is None else -1 if sign * (value - bad) >= 0 else 1 if sign * (value - good) <= 0 else 0)
    return tuple(out)


def features(measured: Measured) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of the hashed features."""
    used = np.flatnonzero(measured.runs)
    rate = np.sqrt(measured.runs[used] / max(measured.runs.sum(), 1))
    at = [(used.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)]
    binned = [(i + 1) * 4096 + min(int(v * 10), 20) for i, v in enumerate(measured.values.values())]
    at.append(np.array(binned, np.uint64) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32))
    buckets = (np.concatenate(at) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([rate, np.full(len(binned), 0.3)])


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[dict[tuple[int, ...], float], np.ndarray]:
    """Posterior of good for each vote pattern, and the labellers' accuracies where they vote.

    Patterns without a vote do not teach; the classes keep the
    names that the weighted vote, with which the rounds begin, gives them.
    """
    patterns = sorted(p for p in patterns if any(p[0]))
    if not patterns:
        return {}, np.zeros(len(LABELLERS))
    cast = np.array([p for p, _ in patterns])
    weight = np.array([n for _, n in patterns], float)
    good = 1 / (1 + np.exp(-(BAD_VOTE * (cast == -1) + GOOD_VOTE * (cast == 1)).sum(1)))
    for _ in range(rounds):
        chance = []
        for own in (good, 1 - good):
            mass = weight * own
            counts = np.stack([(mass[:, None] * (cast == v)).sum(0) + 0.1 for v in (-1, 0, 1)], 1)
            log = np.log(counts / counts.sum(1, keepdims=True))
            chance.append(np.log((mass.sum() + 1) / (weight.sum() + 2)) + sum(log[k, cast[:, k] + 1] for k in range(cast.shape[1])))
        new = 1 / (1 + np.exp(np.clip(chance[1] - chance[0], -500, 500)))
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    right = (weight[:, None] * ((cast == 1) * good[:, None] + (cast == -1) * (1 - good[:, None]))).sum(0)
    accuracy = right / np.maximum((weight[:, None] * (cast != 0)).sum(0), 1e-9)
    return {p: float(g) for (p, _), g in zip(patterns, good)}, accuracy


def fit(rows: list[tuple[list[int], list[float], float]], epochs: int = 30, rate: float = 2.0, seed: int = 3) -> np.ndarray:
    """Weights (the last one is the bias) by stochastic gradient descent on soft labels."""
    weights = np.zeros(BUCKETS + 1)
    data = [(np.array([*at, BUCKETS]), np.array([*values, 1.0]), label) for at, values, label in sorted(rows)]
    random, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        for i in random.permutation(len(data)):
            at, values, label = data[i]
            slope = rate * (1 - step / (epochs * len(data)))
            step += 1
            error = 1 / (1 + np.exp(-np.clip(weights[at] @ values, -30, 30))) - label
            np.subtract.at(weights, at, slope * error * values)
    return weights


def _hash_draw(column: str, share: float):
    return F.pmod(F.xxhash64(F.lit("quality"), column), F.lit(1 << 30)) < int(share * (1 << 30))


@dataclass
class Model:
    """Posteriors by pattern, accuracies of the labellers, and the scorer's weights."""

    posterior: dict[tuple[int, ...], float]
    accuracy: np.ndarray
    weights: np.ndarray


def learned(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Estimate the labellers on all texts, and fit the scorer on a bounded sample."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))

    def voting():
        classes = _table()
        return lambda text: (list(votes(measure(text or "", classes))),)

    cast = applied(texts, text_map(spark, "votes array<int>", voting), "text", [])
    counted = [(tuple(r["votes"]), r["n"]) for r in cast.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    posterior, accuracy = estimate(counted)
    total = sum(n for _, n in counted)

    def describing():
        classes = _table()

        def one(text: str | None):
            measured = measure(text or "", classes)
            if measured is None:
                return [], [], []
            at, values = features(measured)
            return list(votes(measured)), at.tolist(), values.tolist()

        return one

    sample = texts.filter(_hash_draw("text", min(1.0, sample_rows / max(total, 1))))
    described = applied(sample, text_map(spark, "votes array<int>, at array<int>, worth array<double>", describing), "text", [])
    # copies of one text are drawn together: it teaches once, and they are merged before they reach the driver
    rows = {(tuple(r["votes"]), tuple(r["at"]), tuple(r["worth"])) for r in described.distinct().toLocalIterator()}
    rows = [(list(at), list(worth), posterior[v]) for v, at, worth in rows if v in posterior]
    return Model(posterior, accuracy, fit(rows))


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The columns ``keep`` (all by default), ``score`` (0 to 1), ``kept``, ``p_weak``."""
    return applied(docs, _scorer(docs.sparkSession, model, least), text_col, docs.columns if keep is None else keep)


def _scorer(spark: SparkSession, model: Model, least: float):
    def make():
        classes = _table()

        def one(text: str | None):
            measured = measure(text or "", classes)
            if measured is None:
                return 0.0, False, None
            at, values = features(measured)
            score = 1 / (1 + np.exp(-np.clip(model.weights[at] @ values + model.weights[-1], -500, 500)))
            return float(score), bool(score >= least), model.posterior.get(votes(measured))

        return one

    return text_map(spark, "score double, kept boolean, p_weak double", make)


def filtered(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the rejected ones; all columns are kept as they are."""
    verdict = fresh(docs, "verdict")
    model = learned(docs, text_col, sample_rows)
    judged = docs.withColumn(verdict, _scorer(docs.sparkSession, model, least)(F.col(text_col)))
    return judged.filter(F.col(verdict)["kept"]).select(*docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, learned(docs), keep=["doc_id"])
