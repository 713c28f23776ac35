"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are cut into lower-case words (runs of letters and
digits; single characters in scripts written without blanks). A running Karp-Rabin hash
over five words finds the seeds, the places of a document whose five words also stand in an
item, so each document knows the items it shares a seed with. Then, for each of these
whose shared seeds reach far enough, the longest match of unmarked words is found by
running hashes, compared word by word and marked, and so on while five words match. Places
are never paired: memory is linear in both texts, however often a word is repeated. An item of fewer
than five words has all its words as its only seed. The tiles do not
overlap, and their order does not matter, so reordered passages count in full. A
document leaks an item if its tiles cover at least ``least_cover`` of the item's words.

The document side is never shuffled: the seed join looks words and hashes up in a
broadcast table of the benchmark. Its size is summed first; a benchmark larger than
``block_bytes`` is joined in several blocks of that size, each against all documents.

Defined results: null and empty texts match nothing, nor do items without a word; an item repeated in the benchmark is reported each time, and so is a repeated
document; a document may leak several items; empty tables give empty results; other
columns are neither read nor touched; very long texts cost time by their words and by the
lengths of their tiles; ties go to the earliest place of the document, then of the item.
"""

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import applied, fresh, table, text_map

SEED_WORDS = 5
LEAST_COVER = 0.8
BLOCK_BYTES = 32 << 20
# Thai, Lao, Burmese, Khmer, kana and Chinese characters
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_WORDS = rf"[^\W_{_UNSPACED}]+|(?!\W)[{_UNSPACED}]"
_BASE = 0x9E3779B97F4A7C15


def running_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2 ** 64) of all windows of ``width`` ids."""
    n = len(ids) - width + 1
    value = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        value = value * np.uint64(_BASE) + ids[k : k + len(value)].astype(np.uint64)
    return value


def under(places: np.ndarray, width: int) -> np.ndarray:
    """The words that lie in a window of ``width`` that starts at a true place."""
    steps = np.zeros(len(places) + width, np.int64)
    steps[:-width] += places
    steps[width:] -= places
    return np.cumsum(steps[:-1]) > 0


class _Words:
    """Words with marks, and the running hashes of their unmarked windows of any length."""

    def __init__(self, ids: np.ndarray, marked: np.ndarray):
        self.ids, self.marked = ids, marked
        powers = np.full(len(ids) + 1, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(len(ids) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids.astype(np.uint64) * np.cumprod(powers)[:-1])])

    def longest(self) -> int:
        """The longest stretch without a mark."""
        at = np.flatnonzero(np.concatenate([[True], self.marked, [True]]))
        return int(np.diff(at).max()) - 1

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the unmarked windows of ``width`` words."""
        marks = np.concatenate([[0], np.cumsum(self.marked)])
        places = np.flatnonzero(marks[width:] == marks[:-width])
        return places, (self.sums[places + width] - self.sums[places]) * self.inverse[places]


def tiles(doc: np.ndarray, item: np.ndarray, width: int, doc_marked: np.ndarray | None = None, item_marked: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Mark the longest match of unmarked words (document place, item place, length) again and
    again, while ``width`` words match; ties go to the earliest places. Words may be marked before.

    The greatest length at which hashes of both sides meet is found by bisection, since a match
    holds shorter ones; then all matches of that length are marked in order. Each length
    takes linear memory, and there are fewer than the root of twice the item's words of them.
    Equal hashes are compared word by word.
    """
    docs = _Words(doc, np.zeros(len(doc), bool) if doc_marked is None else doc_marked.copy())
    items = _Words(item, np.zeros(len(item), bool) if item_marked is None else item_marked.copy())
    out: list[tuple[int, int, int]] = []
    above = min(len(doc), len(item)) + 1  # no match has so many words
    while True:
        least, above = width - 1, min(above, docs.longest() + 1, items.longest() + 1)
        length = above - 1  # the longest stretch is tried first
        while above - least > 1:
            if np.isin(docs.windows(length)[1], items.windows(length)[1]).any():
                least = length
            else:
                above = length
            length = (least + above) // 2
        if least < width:
            return out
        length = above = least
        at, hashes = items.windows(length)
        waiting: dict[int, list[int]] = {}
        for place, value in zip(at[::-1].tolist(), hashes[::-1].tolist()):
            waiting.setdefault(value, []).append(place)  # the earliest is last
        at, hashes = docs.windows(length)
        met = np.isin(hashes, items.windows(length)[1])
        free = 0
        for place, value in zip(at[met].tolist(), hashes[met].tolist()):
            if place < free:
                continue
            left = waiting[value]
            while left and (items.marked[left[-1]] or items.marked[left[-1] + length - 1]):
                left.pop()
            for start in reversed(left):
                # marks of this round have this length, so they reach a window's first or last word
                if items.marked[start] or items.marked[start + length - 1]:
                    continue
                if np.array_equal(doc[place : place + length], item[start : start + length]):
                    free = place + length
                    docs.marked[place:free] = items.marked[start : start + length] = True
                    out.append((place, start, length))
                    break


class Benchmark:
    """Word numbers and seeds of a block of items (id, text).

    Seeds are sorted hashes, each with the items that have it, by seed width (fewer words for short items).
    """

    def __init__(self, items: list[tuple[object, str]], width: int = SEED_WORDS):
        self.width = width
        self.number: dict[str, int] = {}
        self.items: list[tuple[object, np.ndarray, np.ndarray]] = []
        found: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for item_id, text in items:
            words = re.findall(_WORDS, (text or "").lower())
            ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int64)
            own = min(width, len(words))
            hashes = running_hashes(ids, own) if words else np.zeros(0, np.uint64)
            if words:
                distinct = np.unique(hashes)
                found.setdefault(own, []).append(distinct)
                owners.setdefault(own, []).append(np.full(len(distinct), len(self.items), np.int32))
            self.items.append((item_id, ids, hashes))
        self.seeds = {}
        for own in found:
            hashes, of = np.concatenate(found[own]), np.concatenate(owners[own])
            order = np.argsort(hashes, kind="stable")
            values, first = np.unique(hashes[order], return_index=True)
            self.seeds[own] = values, np.append(first, len(order)), of[order]

    def tiled(self, text: str, least_cover: float = 0.0) -> list[tuple[object, float, int, int]]:
        """Item id, share of its words covered, tiles and longest tile, for items with a tile.

        Items whose seeds in the text cannot cover ``least_cover`` of their words are not tiled.
        """
        get = self.number.get
        ids = np.array([get(w, 0) for w in re.findall(_WORDS, text.lower())], np.int64)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        out = []
        for width, (values, first, of) in self.seeds.items():
            if len(ids) < width:
                continue
            places = np.flatnonzero(known[width:] - known[:-width] == width)
            if not len(places):
                continue
            hashes = running_hashes(ids, width)[places]
            at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
            met = values[at] == hashes
            if not met.any():
                continue
            places, hashes = places[met], hashes[met]
            shared = np.unique(at[met])
            for item in np.unique(np.concatenate([of[first[k] : first[k + 1]] for k in shared.tolist()])).tolist():
                item_id, words, own = self.items[item]
                covered = under(np.isin(own, values[shared]), width)
                if covered.sum() / len(words) < least_cover:
                    continue
                # only words under a seed of both can match: the document is cut down to them
                starts = np.zeros(len(ids) - width + 1, bool)
                starts[places[np.isin(hashes, own)]] = True
                near = under(starts, width)
                keep = np.flatnonzero(near | np.concatenate([[False], near[:-1]]))  # and one word after each stretch
                lengths = [n for _, _, n in tiles(ids[keep], words, width, ~near[keep], ~covered)]
                if lengths:
                    out.append((item, item_id, sum(lengths) / len(words), len(lengths), max(lengths)))
        return [row[1:] for row in sorted(out, key=lambda row: row[0])]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark's items, in blocks that the driver and a task can hold."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r["id"], r["text"]) for r in part.collect()]


def tilings(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES, least_cover: float = 0.0,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``cover``, ``n_tiles``, ``longest`` of every document and
    item that share a tile and whose cover is ``least_cover`` at least. Ids may have any type."""
    spark, out = docs.sparkSession, None
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        held = spark.sparkContext.broadcast(items)

        def make(held=held):
            block = Benchmark(held.value, width)

            def one(text: str | None):
                found = [row for row in block.tiled(text, least_cover) if row[1] >= least_cover] if text else []
                return tuple(map(list, zip(*found))) if found else ([], [], [], [])

            return one

        schema = f"items array<{benchmark.schema[item_col].dataType.simpleString()}>, covers array<double>, counts array<int>, longests array<int>"
        hit = applied(rows, text_map(spark, schema, make), "text", ["doc_id"]).filter(F.size("items") > 0)
        pairs = hit.select("doc_id", F.explode(F.arrays_zip("items", "covers", "counts", "longests")).alias("p"))
        part = pairs.select(
            "doc_id", F.col("p.items").alias("item_id"), F.col("p.covers").alias("cover"),
            F.col("p.counts").alias("n_tiles"), F.col("p.longests").alias("longest"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, least_cover: float = LEAST_COVER, **columns) -> DataFrame:
    """The tilings that cover at least ``least_cover`` of their item."""
    return tilings(docs, benchmark, least_cover=least_cover, **columns)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least_cover: float = LEAST_COVER, width: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns are kept as they are."""
    spark = docs.sparkSession
    for items in _blocks(benchmark, item_col, item_text_col, block_bytes):
        held = spark.sparkContext.broadcast(items)

        def make(held=held):
            block = Benchmark(held.value, width)
            return lambda text: (any(cover >= least_cover for _, cover, _, _ in (block.tiled(text, least_cover) if text else [])),)

        leaked = fresh(docs, "leaked")
        columns = docs.columns
        found = docs.withColumn(leaked, text_map(spark, "leaked boolean", make)(F.col(text_col))["leaked"])
        docs = found.filter(~F.col(leaked)).select(*columns)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
