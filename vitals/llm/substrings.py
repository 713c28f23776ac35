"""Substring dedup: passages of words that occur again, anywhere in the corpus.

A passage is repeated if a window of ``window`` words of it starts at another place too, in
the same document or in another one. Windows are the edges of a De Bruijn graph, each from
its first ``window - 1`` words to its last. Repeated edges make paths; a node where all
occurrences go on alike does not branch, and a path without branches is one unit however
often it occurs. In steps, each over tables in the shared folder:

1. *Seeds.* Equal windows share the least hash of their ``SEED`` word pieces (a minimizer). Only
   windows whose minimizer occurs at two places can be repeated; a membership map of a fixed
   size tells most others, and loses none.
2. *Edges.* The remaining windows are counted by hash, with a mark of the words around them
   and their first coordinates (row, position). Counts are combined before the shuffle.
3. *Compaction.* An edge whose surrounding words are always the same goes on alike at all its
   occurrences, so the edges of a path without branches follow each other at their first
   coordinates too: runs along these coordinates are the paths. The first edge of a path
   is joined to its occurrences, which gives a span of words for each traversal.
4. *Verification.* The words of each span are read at their source coordinates. A span is
   removed if the same words, by a digest of 128 bits, stand at another traversal of its path.
   Two windows of one hash have different words around them, so they are paths of their own
   here, and only equal words count.

Windows are judged on the input, so all occurrences of a passage are removed, the first one
too. No step gathers a path's or a passage's occurrences: what is collected belongs to one
row (its own spans).

Defined results: a null or empty text has no words; repeated rows (equal ids included) are
rows of their own, and repeat each other if they are long enough; a text below ``window``
words keeps all; an empty table gives no rows. Very long texts: time and memory of a row are
linear in its words. Only id and text are read, so columns of any name do no harm.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import table, written
from vitals.llm.hashing import Windows, contained, membership, mixed, pieces, sliding, word_bounds

WINDOW = 35
SEED = 12  # words of the pieces whose least hash stands for a window
MAP_BITS = 27  # 16 MB
PLACE_BITS = 40  # words of a task at most
STRETCH_BITS = 16  # places whose paths are followed together
CHUNK_BYTES = 2_000_000  # bytes of texts that are hashed at once


class Chunk:
    """Word hashes of consecutive texts; ``starts`` and ``ends`` are the bounds of each text."""

    def __init__(self, texts: list[bytes], windows: Windows):
        data, starts, ends, self.counts = word_bounds(texts)
        self.hashes = windows.words(data, starts, ends)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.text = np.repeat(np.arange(len(texts)), self.counts)

    def minimizers(self, window: int, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all seeds, and of each window's least seed (0: it leaves its text)."""
        seed = min(SEED, window)
        seeds = windows(self.hashes, seed) | np.uint64(1)
        if len(self.hashes) < window:
            return seeds, np.zeros(0, np.uint64)
        least = sliding(seeds, window - seed + 1)
        least[self.text[: len(least)] != self.text[window - 1 :]] = 0
        return seeds, least

    def candidates(self, window: int, windows: Windows, repeated: np.ndarray) -> np.ndarray:
        """Starts of the windows whose minimizer is in the map ``repeated``."""
        _, least = self.minimizers(window, windows)
        return np.flatnonzero((least != 0) & contained(repeated, least))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def repeated_seeds(docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """``seed``: hashes of the minimizers that occur at two places or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows()
        for _, texts in pieces(batches, CHUNK_BYTES):
            seeds, least = Chunk(texts, windows).minimizers(window, windows)
            if len(least):
                reach = window - min(SEED, window)
                edge = np.zeros(reach, np.uint64)
                found = seeds[sliding(np.r_[edge, least, edge], reach + 1, np.maximum) == seeds]
                keys, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(n)], ["seed", "n"])

    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "seed bigint, n bigint")
    return counted.groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed")


def numbered(docs: DataFrame, id_col: str, text_col: str, window: int, repeated) -> DataFrame:
    """``id``, ``n_words``, ``digest`` (of all words), ``row`` (the number of words before it, from a start of
    each task's own, which the written table fixes) and, only where a window may be repeated, ``text``."""

    @F.pandas_udf("row bigint, n_words bigint, digest string, open boolean")
    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows, row = Windows(), TaskContext.get().partitionId() << PLACE_BITS
        for texts in batches:
            parts = []
            for _, own in pieces([pa.RecordBatch.from_arrays([pa.array(texts, pa.binary(), from_pandas=True)], ["text"])], CHUNK_BYTES):
                chunk = Chunk(own, windows)
                open_ = np.zeros(len(own), bool)
                open_[chunk.text[chunk.candidates(window, windows, repeated.value)]] = True
                digests = ["" if o else hashlib.sha256(b" ".join(t.split())).hexdigest() for t, o in zip(own, open_)]
                parts.append(pd.DataFrame({"row": row + chunk.starts, "n_words": chunk.counts, "digest": digests, "open": open_}))
                row += int(chunk.counts.sum())
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"row": [], "n_words": [], "digest": [], "open": []})

    text = F.col(text_col).cast("binary")
    seen = docs.select(F.col(id_col).alias("id"), text.alias("text"), look(text).alias("seen"))
    return seen.select("seen.row", "id", "seen.n_words", "seen.digest", F.when(F.col("seen.open"), F.col("text")).alias("text"))


def repeated_edges(opened: DataFrame, window: int, repeated) -> DataFrame:
    """``edge`` (hash of a window that occurs twice or more), ``steady`` (the words before and
    after it are always the same) and its first coordinate ``place`` (row and position, added)."""

    def list_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows()
        for own, texts in pieces(batches, CHUNK_BYTES):
            rows = own["row"].to_numpy()
            chunk = Chunk(texts, windows)
            at = chunk.candidates(window, windows, repeated.value)
            if not len(at):
                continue
            text = chunk.text[at]
            h = np.r_[chunk.hashes, np.uint64(0)]
            before = np.where(at > chunk.starts[text], h[at - 1], np.uint64(1))
            after = np.where(at + window < chunk.ends[text], h[np.minimum(at + window, len(h) - 1)], np.uint64(2))
            around = mixed(mixed(before) + np.uint64(3) * after)
            edges = windows(chunk.hashes, window)[at]
            place = rows[text] + at - chunk.starts[text]
            order = np.argsort(edges, kind="stable")  # equal edges by place: the first is the least
            edges, around, place = edges[order], around[order].view(np.int64), place[order]
            starts = np.flatnonzero(np.r_[True, edges[1:] != edges[:-1]])
            n = np.diff(np.r_[starts, len(edges)])
            columns = [
                _signed(edges[starts]), pa.array(n), pa.array(np.minimum.reduceat(around, starts)),
                pa.array(np.maximum.reduceat(around, starts)), pa.array(place[starts]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["edge", "n", "low", "high", "place"])

    listed = opened.select("row", "text").mapInArrow(list_edges, "edge bigint, n bigint, low bigint, high bigint, place bigint")
    counted = listed.groupBy("edge").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("place").alias("place")
    )
    return counted.where("n > 1").select("edge", (F.col("low") == F.col("high")).alias("steady"), "place")


def paths(edges: DataFrame) -> DataFrame:
    """``path`` (its first edge) and ``n`` (its edges) of the paths without branches. Places are looked
    at in stretches of a fixed length, at whose ends a path is cut."""
    edges = edges.withColumn("stretch", F.shiftright("place", STRETCH_BITS))
    along = Window.partitionBy("stretch").orderBy("place")
    inner = F.col("steady") & F.lag("steady").over(along) & (F.lag("place").over(along) == F.col("place") - 1)
    marked = edges.withColumn("begins", F.when(F.coalesce(inner, F.lit(False)), 0).otherwise(1))
    own = marked.withColumn("number", F.sum("begins").over(along))
    first = F.max(F.when(F.col("begins") == 1, F.col("edge")))
    return own.groupBy("stretch", "number").agg(first.alias("path"), F.count(F.lit(1)).alias("n")).select("path", "n")


def traversals(opened: DataFrame, found: DataFrame, window: int, repeated, bits: int) -> DataFrame:
    """``row``, ``pos``, ``path``, ``n_words``: where each path of ``found`` is in the texts."""
    heads = membership(found, "path", bits)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows()
        for own, texts in pieces(batches, CHUNK_BYTES):
            rows = own["row"].to_numpy()
            chunk = Chunk(texts, windows)
            at = chunk.candidates(window, windows, repeated.value)
            edges = windows(chunk.hashes, window)[at]
            hit = contained(heads.value, edges)
            at, edges = at[hit], edges[hit]
            text = chunk.text[at]
            columns = [pa.array(rows[text]), pa.array(at - chunk.starts[text]), _signed(edges)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "pos", "edge"])

    hits = opened.select("row", "text").mapInArrow(look, "row bigint, pos bigint, edge bigint")
    joined = hits.join(found, F.col("edge") == F.col("path"))
    return joined.select("row", "pos", "path", (F.col("n") + window - 1).alias("n_words"))


def verified(opened: DataFrame, spans: DataFrame) -> DataFrame:
    """The ``spans`` whose words stand at another traversal of their path: ``row``, ``spans``."""

    @F.pandas_udf("array<binary>")
    def digests(texts: pd.Series, places: pd.Series, lengths: pd.Series) -> pd.Series:
        import xxhash

        out = []
        for text, starts, counts in zip(texts, places, lengths):
            words = text.split()
            out.append([xxhash.xxh3_128_digest(b" ".join(words[a : a + n])) for a, n in zip(starts, counts)])
        return pd.Series(out, dtype=object)

    own = spans.groupBy("row").agg(F.collect_list(F.struct("pos", "n_words", "path")).alias("own"))
    read = opened.select("row", "text").join(own, "row").select("row", "own", digests("text", "own.pos", "own.n_words").alias("digests"))
    each = written(read.select("row", F.explode(F.arrays_zip("own", "digests")).alias("one")).select("row", "one.own.*", F.col("one.digests").alias("digest")), "spans")
    single = written(each.groupBy("path", "digest").agg(F.count(F.lit(1)).alias("times")).where("times = 1").select("path", "digest"), "single")
    return each.join(single, ["path", "digest"], "left_anti").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "n_words"))).alias("spans"))


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", bits: int = MAP_BITS) -> DataFrame:
    """``id``, ``n_words``, ``n_removed``, ``spans`` (start and number of words of the passages removed,
    merged) and ``kept_sha256`` (of the words kept, joined by a space) of every row."""

    @F.pandas_udf("n_removed bigint, spans array<struct<start bigint, words bigint>>, digest string")
    def removed(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        out = []
        for text, places, counts in zip(texts, starts, lengths):
            merged: list[list[int]] = []
            for a, n in zip(() if places is None else places, () if counts is None else counts):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], a + n)
                else:
                    merged.append([a, a + n])
            words, kept, end = text.split(), [], 0
            for a, b in merged:
                kept += words[end:a]
                end = b
            kept += words[end:]
            spans = [{"start": a, "words": b - a} for a, b in merged]
            out.append((len(words) - len(kept), spans, hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(out, columns=["n_removed", "spans", "digest"])

    repeated = membership(repeated_seeds(docs, text_col, window), "seed", bits)
    rows = written(numbered(docs, id_col, text_col, window, repeated), "rows")
    opened = rows.where(F.col("text").isNotNull())
    edges = written(repeated_edges(opened, window, repeated), "edges")
    found = written(paths(edges), "paths")
    spans = written(traversals(opened, found, window, repeated, bits), "traversals")
    sure = written(verified(opened, spans), "sure")
    last = opened.join(sure, "row", "left").select("id", "n_words", removed("text", "spans.pos", "spans.n_words").alias("done"))
    kept = rows.where(F.col("text").isNull()).select(
        "id", "n_words", F.lit(0).cast("bigint").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,words:bigint>>").alias("spans"), F.col("digest").alias("kept_sha256"),
    )
    return kept.unionByName(last.select("id", "n_words", "done.n_removed", "done.spans", F.col("done.digest").alias("kept_sha256")))


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP13_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT r, s, md5(array_to_string(w[s : s + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) AS s FROM texts)
), again AS (
  SELECT r, s FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), words AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM texts
), covered AS (
  SELECT words.r, words.i, word,
    words.i - max(again.s) OVER (PARTITION BY words.r ORDER BY words.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) < {WINDOW} AS gone
  FROM words LEFT JOIN again ON again.r = words.r AND again.s = words.i
), kept AS (
  SELECT r, count(*) FILTER (gone IS TRUE) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone IS NOT TRUE) AS text
  FROM covered GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
