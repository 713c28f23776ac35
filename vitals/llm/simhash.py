"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A text's fingerprint has 64 bits. Two texts are linked if their fingerprints
differ in at most ``max_distance`` bits, and groups are the connected components.

Links are found without comparing all pairs. The fingerprint is cut into three
segments of 23, 23 and 18 bits. The perfect [23, 12, 7] code puts exactly one
codeword within 3 bits of any segment, and up to six within 4 bits. If two
segments differ in one bit, the codeword nearest to the one is within 4 bits of
the other. So a segment is stored under one codeword index and looked up under
at most six. A segment has two or more errors in at most ``max_distance // 2``
of the three places (pigeonhole), so among any ``3 - max_distance // 2`` segments
that are joined into one key, some choice has at most one error in each. Every
hit is verified by the true bit distance: nothing is missed, nothing is wrong.

Defined results: a null text, or one without a word, has fingerprint zero, and is
linked like any other; a null id takes part, but never names a component unless
all ids of the component are null (then the component is null); repeated rows
are returned as often as they come; an empty table gives an empty result. Only
the id and text columns are read, so other columns of any name do no harm.
"""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.llm.common import fresh, table, text_map, written

SEED = 42
SEGMENTS = (23, 23, 18)
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code


def fingerprint(text: str | None, words: int = 3) -> int:
    """The signed 64-bit SimHash of a text's shingles of ``words`` words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    elif words == 1:
        shingles = tokens
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(s, SEED) for s in shingles], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory on very long texts
        block = np.ascontiguousarray(hashes[at : at + (1 << 16)])
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def golay() -> tuple[np.ndarray, np.ndarray]:
    """Tables of the Golay code: syndromes of single bits, and for each syndrome
    the error patterns of weight up to 4 (six places, padded with -1, the lightest first)."""
    unit = np.zeros(23, np.int64)
    for bit in range(23):
        rest = 1 << bit
        for top in range(22, 10, -1):  # remainder by the generator polynomial
            if rest >> top & 1:
                rest ^= GENERATOR << (top - 11)
        unit[bit] = rest
    patterns: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= int(unit[b])
            patterns[syndrome].append(sum(1 << b for b in bits))
    width = max(map(len, patterns))
    return unit, np.array([p + [-1] * (width - len(p)) for p in patterns], np.int64)


def codewords(segment: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Indices (the upper 12 bits) of all codewords within 4 bits of each 23-bit
    value, the nearest first; -1 fills the places that are left."""
    unit, patterns = tables
    syndrome = np.zeros(len(segment), np.int64)
    for bit in range(23):
        syndrome ^= np.where(segment >> bit & 1, unit[bit], 0)
    errors = patterns[syndrome]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def keys(prints: np.ndarray, max_distance: int, near: bool, tables: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """The keys of each fingerprint: all nearby codewords (``near``) or the nearest."""
    bits = prints.astype(np.int64).view(np.uint64)
    parts, shift = [], np.uint64(0)
    for width in SEGMENTS:
        value = (bits >> shift & np.uint64((1 << width) - 1)).astype(np.int64)
        found = codewords(value, tables)
        parts.append(found if near else found[:, :1])
        shift += np.uint64(width)
    out = []
    for number, chosen in enumerate(combinations(range(len(SEGMENTS)), len(SEGMENTS) - max_distance // 2)):
        key = np.full((len(bits), 1), number, np.int64)
        for part in (parts[i] for i in chosen):
            joint = (key[:, :, None] << 12) | part[:, None, :]
            joint[(key[:, :, None] < 0) | (part[:, None, :] < 0)] = -1
            key = joint.reshape(len(bits), -1)
        out.append(key)
    full = np.concatenate(out, axis=1)
    return [row[row >= 0] for row in full]


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``mark`` (a hash of the text) and ``fp`` (signed 64 bits) of every row."""

    def make():
        return lambda text: (fingerprint(text, words),)

    udf = text_map(docs.sparkSession, "fp bigint", make)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("mark"), udf(F.col(text_col))["fp"].alias("fp"))


def links(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp`` of ``prints``, each
    once) that differ in at most ``max_distance`` bits."""
    if not 0 <= max_distance <= 5:
        raise ValueError("three segments decide distances from 0 to 5")
    tables = golay()

    @F.pandas_udf("array<bigint>")
    def near(fp: pd.Series) -> pd.Series:
        return pd.Series(keys(fp.to_numpy(), max_distance, True, tables), dtype=object)

    @F.pandas_udf("array<bigint>")
    def nearest(fp: pd.Series) -> pd.Series:
        return pd.Series(keys(fp.to_numpy(), max_distance, False, tables), dtype=object)

    asked = prints.select(F.col("fp").alias("a"), F.explode(near("fp")).alias("key"))
    stored = prints.select(F.col("fp").alias("b"), F.explode(nearest("fp")).alias("stored_key"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = asked.join(stored, (F.col("key") == F.col("stored_key")) & (F.col("a") != F.col("b")) & (distance <= max_distance))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Connected components of ``pairs`` (a, b): ``node``, ``root`` (the smallest
    node reachable), for the nodes that have a link.

    Each round every node takes the smallest grandparent among its neighbours and
    passes it to its parent, so that trees hook onto each other and flatten: about
    log(n) rounds. A round reads tables in the shared folder only. Minima are
    combined before each shuffle, and the joins have a plain shuffle on both sides, which
    adaptive execution can split where a root has very many members.
    """
    edges = written(pairs.select("a", "b").union(pairs.select("b", "a")), "edges")
    trees = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "trees")
    while True:
        up = trees.select(F.col("node").alias("parent"), F.col("root").alias("top"))
        grand = written(trees.join(up, F.col("root") == F.col("parent")).select("node", "root", "top"), "grand")
        other = grand.select(F.col("node").alias("b"), F.col("top").alias("seen"))
        said = edges.join(other, "b").groupBy("a").agg(F.min("seen").alias("seen"))
        mine = grand.join(said, F.col("node") == F.col("a"), "left").select("node", "root", F.least("top", "seen").alias("least"))
        given = mine.select("node", F.col("root").alias("old"), F.col("least").alias("new")).union(
            mine.select(F.col("root"), F.lit(None).cast("bigint"), "least")
        )
        following = written(given.groupBy("node").agg(F.min("old").alias("old"), F.min("new").alias("root")), "trees")
        trees = following.select("node", "root")
        if not following.filter(F.col("old") != F.col("root")).limit(1).count():
            return trees


def near_duplicates(
    docs: DataFrame, words: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``mark``, ``fp``, ``root`` (a fingerprint that names the group) and
    ``component_id`` (the smallest id reachable, its own included) of every row."""
    prints = written(fingerprints(docs, words, id_col, text_col), "prints")
    groups = written(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "groups")
    linked = components(links(groups.select("fp"), max_distance))
    rooted = groups.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    rooted = written(rooted, "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    named = written(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "named")
    return prints.join(named, "fp").select("id", "mark", "fp", "root", "component_id")


def deduplicated(
    docs: DataFrame, words: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group: one with the smallest id (a null id only
    if the group has no other). Of several rows with this id the one with the
    smallest text hash stays, and of equal rows one. All columns are kept as they are.
    """
    found = near_duplicates(docs, words, max_distance, id_col, text_col)
    heads = found.filter(F.col("id").eqNullSafe(F.col("component_id")))
    best = heads.groupBy("root").agg(F.first("id").alias("id"), F.min("mark").alias("mark"))
    key, mark, place = fresh(docs, "kept_id"), fresh(docs, "kept_mark"), fresh(docs, "place")
    best = written(best.select(_text_key(F.col("id")).alias("best_id"), F.col("mark").alias("best_mark")), "best")
    best = best.toDF(f"_best_{key}", f"_best_{mark}")
    marked = docs.withColumn(key, _text_key(F.col(id_col))).withColumn(mark, F.xxhash64(F.col(text_col)))
    kept = marked.join(best, (F.col(key) == F.col(f"_best_{key}")) & (F.col(mark) == F.col(f"_best_{mark}")), "left_semi")
    once = kept.withColumn(place, F.row_number().over(Window.partitionBy(key, mark).orderBy(mark))).filter(F.col(place) == 1)
    return once.select(*docs.columns)


def _text_key(column: Column) -> Column:
    return F.when(column.isNull(), "null").otherwise(F.concat(F.lit("="), column.cast("string")))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, max_distance=3)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
