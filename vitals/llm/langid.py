"""Language identification with averaged hashed subword embeddings.

A text is the mean of the embeddings of its subwords: the runs of 2 to 4 letters
in its lower-case words, word ends marked, hashed to a fixed number of buckets. A
linear softmax on that mean gives the languages' probabilities. Embeddings and
softmax are trained by stochastic gradient descent in numpy on a bounded sample
(at most ``per_language`` different texts of each language, drawn by a hash of the text
from all labelled rows; ``sample_rows`` in all; the ``most_languages`` labels with the most rows). A fifth of the sample is held back: on it a temperature
is fitted, and the least score is chosen above which ``accuracy`` of the predictions
hold; predictions below it are marked as rejected.

Prediction covers whole texts, on Spark's tasks. As the model is linear, each bucket
has one row of logits, and each word one sum of such rows, kept in the task.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and
rejected; so is every text if there is no labelled row to learn from. Ties go to the
language that sorts first. Labels with null text are not learned from. Repeated rows
give repeated results; an empty table gives an empty result; other columns are
neither read nor touched.
"""

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import applied, table, text_map

BUCKETS = 1 << 14
LENGTHS = (2, 3, 4)
DIMENSIONS = 16
PER_LANGUAGE = 400
SAMPLE_ROWS = 80_000
MOST_LANGUAGES = 500
DRAWN = 4  # times the texts wanted, since copies teach once
KEPT_WORDS = 300_000  # words whose sums a task keeps
BLOCK = 1 << 18  # letters hashed at once
UNKNOWN = "und"
_WORDS = r"[^\W\d_]+"


def subwords(words: list[str], buckets: int = BUCKETS):
    """Blocks of (word numbers, buckets) of all subwords of ``words``."""
    letters = np.frombuffer("".join([f"\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(w) + 2 for w in words])
    for low in range(0, len(letters), BLOCK):
        high = min(low + BLOCK, len(letters))
        place = np.arange(low, high)
        word = np.searchsorted(ends, place, side="right")
        room = ends[word] - place
        value = np.zeros(high - low, np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            following = np.zeros(high - low, np.uint64)
            part = letters[low + n - 1 : high + n - 1]
            following[: len(part)] = part
            value = value * np.uint64(0x9E3779B97F4A7C15) + following + np.uint64(n)
            if n in LENGTHS:
                fits = room >= n
                mixed = value[fits]
                mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
                yield word[fits], (mixed >> np.uint64(40)).astype(np.int64) % buckets


@dataclass
class Model:
    """Logits per bucket, bias, temperature and the least score that is accepted."""

    languages: list[str]
    logits: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    least: float


def train(rows: list[tuple[str, list[int], list[float]]], epochs: int = 12, rate: float = 0.5, accuracy: float = 0.99, seed: int = 7) -> Model:
    """Fit the model to rows of (language, buckets, counts) by gradient descent.

    The order of ``rows`` does not matter: they are sorted, then shuffled by ``seed``.
    """
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 1.0)
    random = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(languages)}
    data = []
    for language, at, counts in sorted(rows, key=lambda r: (r[0], list(r[1]), list(r[2]))):
        weights = np.asarray(counts, np.float64)
        data.append((number[language], np.asarray(at, np.int64), weights / max(weights.sum(), 1.0)))
    order = random.permutation(len(data))
    held = {int(i) for i in order[: len(order) // 5]}
    vectors = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    softmax = np.zeros((len(languages), DIMENSIONS))
    bias = np.zeros(len(languages))
    steps, step = epochs * (len(data) - len(held)), 0
    for _ in range(epochs):
        for i in random.permutation(len(data)):
            if int(i) in held:
                continue
            label, at, weights = data[i]
            slope = rate * (1 - step / steps)
            step += 1
            mean = weights @ vectors[at]
            error = _softmax(softmax @ mean + bias)
            error[label] -= 1
            back = softmax.T @ error
            softmax -= slope * np.outer(error, mean)
            bias -= slope * 0.1 * error
            vectors[at] -= slope / (weights @ weights + 0.05) * np.outer(weights, back)  # short texts weigh each subword more
    logits = vectors @ softmax.T
    seen = [data[i] for i in (held or range(len(data)))]
    scores = np.array([weights @ logits[at] + bias for _, at, weights in seen])
    labels = np.array([label for label, _, _ in seen])
    temperature = min(np.geomspace(0.05, 20, 121), key=lambda t: -np.log(_softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).sum())
    chances = _softmax(scores / temperature)
    right, best = chances.argmax(1) == labels, chances.max(1)
    least = 0.0
    if right.mean() < accuracy:
        order = np.argsort(-best)
        fine = np.flatnonzero(np.cumsum(right[order]) >= accuracy * np.arange(1, len(order) + 1))
        least = float(best[order][fine[-1]]) if len(fine) else 1.0
    return Model(languages, logits.astype(np.float32), bias, float(temperature), least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Scorer:
    """Predicts the languages of texts; keeps the sums of the words it has seen."""

    def __init__(self, model: Model):
        self.model, self.find = model, re.compile(_WORDS).findall
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.sums = np.zeros((1024, len(self.model.languages) + 1), np.float32)

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if len(self.number) + len(new) > KEPT_WORDS:
            self._clear()
            new = list(dict.fromkeys(words))
        first = len(self.number)
        while first + len(new) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        own = np.zeros((len(new), self.sums.shape[1]))
        for word, at in subwords(new):
            for k in range(len(self.model.languages)):
                own[:, k] += np.bincount(word, self.model.logits[at, k], len(new))
            own[:, -1] += np.bincount(word, minlength=len(new))
        self.sums[first : first + len(new)] = own
        self.number.update(zip(new, range(first, first + len(new))))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        model = self.model
        if not text or not model.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        words = self.find(text.lower())
        try:
            at = [self.number[w] for w in words]
        except KeyError:
            self._learn(words)
            at = [self.number[w] for w in words]
        total = self.sums[at].sum(0, dtype=np.float64)
        chances = _softmax((total[:-1] / max(total[-1], 1.0) + model.bias) / model.temperature)
        best = int(chances.argmax())
        return model.languages[best], float(chances[best]), bool(chances[best] < model.least)


def _counted(text: str | None) -> tuple[list[int], list[float]]:
    words = re.findall(_WORDS, (text or "").lower())
    counts = np.zeros(BUCKETS)
    for _, at in subwords(words):
        counts += np.bincount(at, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used.tolist(), counts[used].tolist()


def learned(
    labelled: DataFrame, text_col: str = "text", label_col: str = "lang", per_language: int = PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS, most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Train on a bounded sample of ``labelled``, drawn from all of its rows."""
    rows = sampled(labelled, text_col, label_col, per_language, sample_rows, most_languages).collect()
    return train([(r["label"], r["at"], r["times"]) for r in rows])


def sampled(labelled: DataFrame, text_col: str, label_col: str, per_language: int, sample_rows: int, most_languages: int) -> DataFrame:
    """``label`` and the hashed counts ``at``, ``times`` of the rows to learn from.

    There are at most ``per_language`` for each label and ``sample_rows`` in all: copies of a text are
    merged before the shuffle, and the drawn texts of a label are cut at the least hashes. A
    row's size is bounded by the number of buckets, not by its text.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("label")).filter(
        F.col("label").isNotNull() & F.col("text").isNotNull()
    )
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(most_languages)
    wanted = F.least(F.lit(per_language), F.greatest(F.lit(1), F.floor(sample_rows / F.count(F.lit(1)).over(Window.partitionBy()))))
    shares = counts.select("label", "n", wanted.alias("wanted"))  # at most most_languages rows
    draw = F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.withColumn("draw", draw).join(F.broadcast(shares), "label").filter(F.col("draw") < DRAWN * F.col("wanted") / F.col("n"))
    texts = chosen.select("label", "draw", "wanted", "text").distinct()
    place = F.row_number().over(Window.partitionBy("label").orderBy("draw", "text"))
    udf = text_map(labelled.sparkSession, "at array<int>, times array<double>", lambda: _counted)
    return applied(texts.withColumn("place", place).filter(F.col("place") <= F.col("wanted")), udf, "text", ["label"])


def predicted(df: DataFrame, model: Model, text: str | Column = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), ``lang_pred``, ``score``, ``rejected``."""
    udf = text_map(df.sparkSession, "lang_pred string, score double, rejected boolean", lambda: Scorer(model))
    return applied(df, udf, text, df.columns if keep is None else keep)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = learned(docs.filter(~held_out))
    found = predicted(docs.select("doc_id", "text", held_out.alias("held_out")), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
