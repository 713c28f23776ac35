"""Phrase collocation mining by SON partitioning.

Texts are cut at punctuation and line breaks into pieces of words; a phrase is 2 to
``LONGEST`` adjacent words of a piece. Per language, phrases that occur ``support`` times or
more are scored by their weakest cut: of all ways to part the words in two, the least of
``1000 * a * n / (l * r)``, for a, l, r occurrences of the phrase and its parts among n words.

1. *Words.* All words are counted; a phrase of enough occurrences has only words of enough.
2. *Shards.* A document belongs to one of ``SHARDS`` shards by a hash of its text. In each
   shard a phrase is locally frequent if its occurrences reach the support in proportion
   to the shard's share of the language's words. If a phrase fell short of that in every
   shard it would fall short of the support in all, so none is lost. A shard is mined
   completely: first pairs of frequent words, then longer phrases whose adjacent pairs
   are all locally frequent. Shards are mined by all tasks together, not one in each, so
   a shard may be far larger than a task.
3. *Union.* The phrases that are locally frequent anywhere are the candidates.
4. *Exact count.* Candidates are counted in all texts, now by their words and not by hashes,
   and those below the support go. Then they are scored, and phrases that lie inside a longer
   one as frequent as they are go too.

Mining works on 64-bit hashes, which can only add candidates; exact counts compare the words. What tasks need to know of
frequent words, pairs and candidates is broadcast as membership maps of a fixed size: they
leave out what cannot count, and never anything else. All counts are combined in the tasks
before the shuffle, so a hot word, text or language is a few rows of each task. Scores are
integer quotients of decimals with 38 digits, the last 2,000 of a language are a ranking that
tasks cut down before the shuffle.

Defined results: a null text has no words; a null language is ``und``; ties of a score go by
occurrences, then phrase (bytes); repeated rows count each time; an empty table gives no
rows. Very long texts: time and memory of a row are linear in its words. Only text and
language are read, so columns of any name do no harm.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import table, written
from vitals.llm.hashing import Windows, byte_set, contained, gathered, membership, mixed, pieces, word_bounds

SUPPORT = 100
LONGEST = 5
TOP = 2000
SHARDS = 8
MAP_BITS = 27  # 16 MB
CHUNK_BYTES = 2_000_000  # bytes of texts that are looked at together

# What ends a piece, what is between words
PIECE_ENDS = byte_set(b".,;:!?\n\x0b\x0c\r")
BETWEEN = PIECE_ENDS | byte_set(b" \t")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def salt_of(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode())


class Chunk:
    """Words of texts: hashes (different in each language), their texts' languages and shards, and
    whether a word goes on with the piece of the word before it."""

    def __init__(self, rows: pa.RecordBatch, texts: list[bytes], windows: Windows, salts: dict[str, int]):
        data, self.starts, self.ends, counts = word_bounds(texts, BETWEEN)
        self.data = LOWER[data]
        langs = rows["lang"].dictionary_encode()
        self.langs, codes = langs.dictionary, langs.indices.to_numpy()
        for lang in self.langs.to_pylist():
            if lang not in salts:
                salts[lang] = salt_of(lang)
        own = np.array([salts[x] for x in self.langs.to_pylist()], np.uint64)
        self.lang = np.repeat(codes, counts)
        shards = rows["shard"].to_numpy()
        self.places = np.repeat(places_of(own[codes], shards), counts)
        self.shards = np.repeat(shards, counts)
        self.hashes = mixed(windows.words(self.data, self.starts, self.ends) ^ own[self.lang])
        cuts = np.cumsum(PIECE_ENDS[data], dtype=np.int32)[self.starts]
        text = np.repeat(np.arange(len(texts)), counts)
        self.joined = np.r_[False, (cuts[1:] == cuts[:-1]) & (text[1:] == text[:-1])] if len(cuts) else np.zeros(0, bool)

    def pairs(self, good: np.ndarray) -> np.ndarray:
        """Where a pair of ``good`` words of one piece begins."""
        return good & np.r_[(self.joined & good)[1:], False]

    def grown(self, keys: np.ndarray, size: int) -> np.ndarray:
        """Keys of the phrases of ``size`` words from those of one word less."""
        return mixed(keys * np.uint64(0x9E3779B97F4A7C15) + np.r_[self.hashes[size - 1 :], np.zeros(min(size - 1, len(keys)), np.uint64)])

    def lang_names(self, at: np.ndarray) -> pa.Array:
        return pa.DictionaryArray.from_arrays(pa.array(self.lang[at], pa.int32()), self.langs).cast(pa.string())

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The words of the phrases that begin ``at`` words, joined by a space."""
        each = (at[:, None] + np.arange(size)).ravel()
        # a word and the byte behind it, which becomes the space; the last one of a phrase without
        last = np.tile(np.arange(size) == size - 1, len(at))
        data, offsets = gathered(self.data, self.starts[each], self.ends[each] + ~last)
        data[offsets[1:][~last] - 1] = ord(" ")
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets[::size].astype(np.int32)), pa.py_buffer(data))

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """A number for each word, equal for equal words of one language only, and each number's first word."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        same, _ = gathered(self.data, self.starts, self.ends)
        other, _ = gathered(self.data, self.starts[first[number]], self.ends[first[number]])
        if len(same) == len(other) and np.array_equal(self.ends - self.starts, (self.ends - self.starts)[first[number]]) and np.array_equal(same, other):
            return number, first
        known: dict = {}  # two words of one hash
        number = np.array([known.setdefault((c, self.data[a:b].tobytes()), len(known)) for c, a, b in zip(self.lang.tolist(), self.starts, self.ends)], np.int64)
        return number, np.unique(number, return_index=True)[1]


def places_of(salts: np.ndarray, shards: np.ndarray) -> np.ndarray:
    """One number for a language and a shard."""
    return (salts & ~np.uint64(SHARDS - 1) | shards.astype(np.uint64)).view(np.int64)


def _both(x: np.ndarray) -> np.ndarray:
    """Where ``x`` holds here and at the next place."""
    return x & np.r_[x[1:], False]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    windows, salts = Windows(), {}
    for rows, texts in pieces(batches, CHUNK_BYTES):
        chunk = Chunk(rows, texts, windows, salts)
        if len(chunk.starts):
            yield chunk


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    text = F.col(text_col).cast("binary")
    shard = F.pmod(F.xxhash64(text), F.lit(SHARDS)).cast("bigint")
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), shard.alias("shard"), text.alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``shard``, ``n``: occurrences of each word (``shard`` null), and the number
    of words of each shard (``word`` null)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            number, first = chunk.numbers()
            data, offsets = gathered(chunk.data, chunk.starts[first], chunk.ends[first])
            words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
            columns = [chunk.lang_names(first), words, pa.nulls(len(first), pa.int64()), pa.array(np.bincount(number))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "shard", "n"])
            _, first, n = np.unique(chunk.places, return_index=True, return_counts=True)
            columns = [chunk.lang_names(first), pa.nulls(len(n), pa.string()), pa.array(chunk.shards[first]), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "shard", "n"])

    listed = texts.mapInArrow(count, "lang string, word string, shard bigint, n bigint")
    return listed.groupBy("lang", "word", "shard").agg(F.sum("n").alias("n"))


def word_keys(words: DataFrame) -> DataFrame:
    """``key``: the hash that tasks use for a word of a language."""

    @F.pandas_udf("bigint")
    def key(words: pd.Series, langs: pd.Series) -> pd.Series:
        windows, salts = Windows(), {x: salt_of(x) for x in langs.unique()}
        data = b" ".join([b"", *(w.encode() for w in words), b""])
        lengths = np.array([len(w.encode()) for w in words], np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        hashes = windows.words(np.frombuffer(data, np.uint8), starts, starts + lengths)
        return pd.Series(mixed(hashes ^ np.array([salts[x] for x in langs], np.uint64)).view(np.int64))

    return words.select(key("word", "lang").alias("key"))


def local_support(shards: DataFrame, totals: DataFrame, support: int) -> DataFrame:
    """``place`` (language and shard) and ``need``: the occurrences that are frequent there."""

    @F.pandas_udf("bigint")
    def place(langs: pd.Series, shards: pd.Series) -> pd.Series:
        return pd.Series(places_of(np.array([salt_of(x) for x in langs], np.uint64), shards.to_numpy()))

    need = F.ceil(F.lit(support).cast("decimal(18,0)") * F.col("shard_words") / F.col("n")).cast("bigint")
    return shards.join(totals, "lang").select(place("lang", "shard").alias("place"), need.alias("need"))


def _counted(chunk: Chunk, keys: list[np.ndarray], at: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (place, key, n) for the phrases with ``keys`` that begin ``at`` words."""
    own, places = np.concatenate([k[i] for k, i in zip(keys, at)]), chunk.places[np.concatenate(at)]
    # one language and shard at a time: few, and then a sort of plain numbers
    out = [(p, *np.unique(own[places == p], return_counts=True)) for p in np.unique(places)]
    columns = [
        pa.array(np.concatenate([np.full(len(k), p) for p, k, _ in out]) if out else [], pa.int64()),
        pa.array(np.concatenate([k for _, k, _ in out]).view(np.int64) if out else [], pa.int64()),
        pa.array(np.concatenate([n for _, _, n in out]) if out else [], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["place", "key", "n"])


def locally_frequent(texts: DataFrame, need: DataFrame, frequent_words, frequent_pairs=None) -> DataFrame:
    """``place``, ``key`` of the phrases that are frequent in a shard: pairs of frequent words, or,
    with ``frequent_pairs``, phrases of three words and more whose pairs are in that map."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            good = chunk.pairs(contained(frequent_words.value, chunk.hashes))
            keys = chunk.grown(chunk.hashes, 2)
            if frequent_pairs is None:
                yield _counted(chunk, [keys], [np.flatnonzero(good)])
                continue
            good[good] = contained(frequent_pairs.value, in_place(keys[good], chunk.places[good]))
            all_keys, at = [], []
            for size in range(3, LONGEST + 1):
                keys, good = chunk.grown(keys, size), _both(good)
                all_keys.append(keys)
                at.append(np.flatnonzero(good))
            yield _counted(chunk, all_keys, at)

    counted = texts.mapInArrow(mine, "place bigint, key bigint, n bigint").groupBy("place", "key").agg(F.sum("n").alias("n"))
    return counted.join(need, "place").where("n >= need").select("place", "key")


def in_place(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """One key for a phrase in a shard."""
    return mixed(keys ^ mixed(places.view(np.uint64)))


def place_keys(pairs: DataFrame) -> DataFrame:
    @F.pandas_udf("bigint")
    def both(keys: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series(in_place(keys.to_numpy().view(np.uint64), places.to_numpy()).view(np.int64))

    return pairs.select(both("key", "place").alias("key"))


def exact_counts(texts: DataFrame, candidates, support: int) -> DataFrame:
    """``lang``, ``phrase`` (words joined by a space), ``size``, ``a`` of the candidates that reach the support."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            words, _ = chunk.numbers()
            keys, names, good = chunk.hashes, words, np.ones(len(words), bool)
            for size in range(2, LONGEST + 1):
                keys, good = chunk.grown(keys, size), chunk.pairs(good) if size == 2 else _both(good)
                good[good] = contained(candidates.value, keys[good])
                at = np.flatnonzero(good)
                if not len(at):
                    break
                # a phrase is numbered by its words but the last, and the last: equal numbers, equal words
                _, first, number, n = np.unique(names[at] << 32 | words[at + size - 1], return_index=True, return_inverse=True, return_counts=True)
                columns = [chunk.lang_names(at[first]), chunk.phrases(at[first], size), pa.array(np.full(len(n), size)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "size", "n"])
                names = np.zeros(len(words), np.int64)
                names[at] = number

    listed = texts.mapInArrow(count, "lang string, phrase string, size bigint, n bigint")
    return listed.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).where(F.col("a") >= support)


def _big(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def scored(phrases: DataFrame, counts: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of the weakest cut, and n; parts are looked up in ``counts`` and ``words``."""
    parts = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")).unionByName(
        words.select("lang", F.col("word").alias("part"), F.col("n").alias("f"))
    )
    own = F.split("phrase", " ")
    cut = phrases.select("*", own.alias("w"), F.explode(F.sequence(F.lit(1), (F.col("size") - 1).cast("int"))).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"),
    )
    cut = cut.join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(parts.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cut = cut.join(totals, "lang")
    top = F.lit(1000).cast("decimal(4,0)") * _big("a") * F.col("n").cast("decimal(15,0)")
    score = F.call_function("div", top.cast("decimal(38,0)"), (_big("l") * _big("r")).cast("decimal(38,0)")).cast("bigint")
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def without_contained(counts: DataFrame) -> DataFrame:
    """``counts`` without the phrases that lie inside a longer one with as many occurrences."""
    own = F.col("w")
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), (F.col("size") - 1).cast("int")),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size").cast("int") - n + 1), lambda s: F.array_join(F.slice(own, s, n), " ")),
        )
    )
    longer = counts.where("size > 2").select("lang", "a", F.split("phrase", " ").alias("w"), "size")
    inside = longer.select("lang", F.col("a"), F.explode(spans).alias("phrase")).distinct()
    return counts.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, text_col: str = "text", lang_col: str = "lang", bits: int = MAP_BITS
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    texts = _texts(docs, text_col, lang_col)
    counted = written(word_counts(texts), "words")
    words = counted.where(F.col("word").isNotNull() & (F.col("n") >= support)).select("lang", "word", "n")
    shards = counted.where(F.col("word").isNull()).select("lang", "shard", F.col("n").alias("shard_words"))
    totals = shards.groupBy("lang").agg(F.sum("shard_words").alias("n"))
    need = written(local_support(shards, totals, support), "need")
    frequent_words = membership(word_keys(words), "key", bits)
    pairs = written(locally_frequent(texts, need, frequent_words), "pairs")
    longer = locally_frequent(texts, need, frequent_words, membership(place_keys(pairs), "key", bits))
    candidates = pairs.select("key").union(longer.select("key"))
    counts = written(exact_counts(texts, membership(candidates, "key", bits), support), "counts")
    ranked = scored(without_contained(counts), counts, words, totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), pieces AS (
  SELECT lang, list_filter(string_split_regex(unnest(pieces), '[\x20\x09]+'), lambda x: x <> '') AS w FROM texts
), words AS (
  SELECT lang, unnest(w) AS word FROM pieces
), totals AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM pieces
), grams AS (
  SELECT lang, size, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE s + size - 1 <= len(w)
), f AS (
  SELECT lang, phrase, size, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), cands AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n, (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cands) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN totals t ON t.lang = c.lang
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM weakest x WHERE NOT EXISTS (
    SELECT 1 FROM cands y WHERE y.lang = x.lang AND y.size > len(string_split(x.phrase, ' '))
      AND 100 * y.a >= 100 * x.a AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
