"""Byte-pair encoding and decoding with a public tokenizer's vocabulary.

Merges of a word run on a segment tree over its adjacent pairs: a leaf holds the
pair's rank and place, an inner node the smaller of its two children, so the root
yields the leftmost pair of the lowest rank. A merge changes three leaves, each
updated in logarithmic time, until no pair is left that can be merged. A word of n
bytes costs n log n, however long it is.

Texts come in batches. The words of a batch that are not known yet are merged together: their
trees are rows of one array for each size of tree, and a round takes the root of every
tree and updates its three leaves, for all words at once (``merge_together``). Only words of
more than ``LONGEST_TOGETHER`` bytes have a tree of their own (``merged``).

The vocabulary (1.7 MB) is broadcast; a Python worker reads it once and keeps it, and the
results of frequent words in dictionaries of bounded size, for all its tasks. Rows are
independent: nothing is shuffled, and a lost task is simply run again.

Defined results: a null or empty text has no ids and decodes to an empty text;
repeated rows give repeated results; an empty table gives an empty result. Only the
text column reaches the tasks, other columns of any name are kept or left alone.
"""

import json
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import applied, table

# Fixed values of the vocabulary file's format
WORD_END = "</w>"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+"
# White space of Unicode; unlike Python's, without the separators U+001C to U+001F
NOT_SPACE = "[^\t-\r \x85\xa0  -     　]+"

# Letters of the library's Unicode table that Python's own may lack, and capitals whose small letters it may
# lack (ranges, and what is added)
NEWER_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 "
    "113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0"
)
NEWER_CAPITALS = (
    ("1C89-1C89", 1), ("A7CB-A7CB", 0x264 - 0xA7CB), ("A7CC-A7CC", 1), ("A7CE-A7CE", 1), ("A7D2-A7D2", 1), ("A7D4-A7D4", 1), ("A7DA-A7DA", 1),
    ("A7DC-A7DC", 0x19B - 0xA7DC), ("10D50-10D65", 0x20), ("16EA0-16EB8", 0x1B),
)

AGREED = "\u0370"  # letters and numbers below are the same in all tables

CACHED = 250_000  # entries of each half of a worker's cache, about 160 MB in all
CACHED_LENGTH = 40  # characters of the longest text that is cached
LONGEST_TOGETHER = 33  # bytes of the longest words that are merged together
TOGETHER = 30_000  # words that are merged together at most
BATCH_BYTES = 4_000_000  # characters of texts that are looked at together


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters, spare = [], 0x100
    for byte in range(256):
        letters.append(chr(byte if byte in shown else spare))
        spare += byte not in shown
    return letters


def merged(ids: list[int], ranks: dict[int, int], results: list[int]) -> list[int]:
    """Merge adjacent ids, always the leftmost pair of the lowest rank."""
    n = len(ids)
    if n < 2:
        return ids
    size = 1
    while size < n - 1:
        size *= 2
    never = len(results) * size
    tree = [never] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(ids[i] << 20 | ids[i + 1])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(place: int, value: int) -> None:
        node = size + place
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while tree[1] < never:
        rank, i = divmod(tree[1], size)
        gone = after[i]
        ids[i] = results[rank]
        if gone < n - 1:
            put(gone, never)
        follower = after[i] = after[gone]
        new = None
        if follower < n:
            before[follower] = i
            new = ranks.get(ids[i] << 20 | ids[follower])
        put(i, never if new is None else new * size + i)
        if i:
            leader = before[i]
            new = ranks.get(ids[leader] << 20 | ids[i])
            put(leader, never if new is None else new * size + leader)
    out, i = [], 0
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


def merge_together(ids: np.ndarray, lengths: np.ndarray, rank_of, results: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``merged`` for all rows of ``ids`` (words by a power of two, and one; each filled up to its
    length). ``rank_of`` gives the ranks of pairs, or ``len(results)`` for none. Returns
    the ids of all words one after the other and how many each word has."""
    words, width = ids.shape
    size, shift = width - 1, (width - 1).bit_length() - 1
    never = len(results) << shift
    places = np.arange(width)
    alive = places < lengths[:, None]

    def leaves(left: np.ndarray, right: np.ndarray, place: np.ndarray, real: np.ndarray) -> np.ndarray:
        rank = rank_of(left << 20 | right)
        return np.where(real & (rank < len(results)), rank << shift | place, never)

    tree = np.empty((words, 2 * size), np.int64)
    tree[:, size:] = leaves(ids[:, :-1], ids[:, 1:], places[:-1], alive[:, 1:])
    half = size // 2
    while half:
        tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
        half //= 2
    after, before = np.tile(places + 1, (words, 1)), np.tile(places - 1, (words, 1))
    # all arrays are addressed as flat ones: by a word's offset and a place
    flat, tree, after, before, living = ids.reshape(-1), tree.reshape(-1), after.reshape(-1), before.reshape(-1), alive.reshape(-1)
    rows = np.flatnonzero(tree[1 :: 2 * size] < never)
    while len(rows):
        root, own = rows * (2 * size), rows * width
        top = tree[root + 1]
        i = top & (size - 1)
        gone = after[own + i]
        flat[own + i] = results[top >> shift]
        living[own + gone] = False
        follower = after[own + gone]
        after[own + i] = follower
        real = follower < lengths[rows]
        next_place = np.where(real, follower, i)
        before[(own + follower)[real]] = i[real]
        tree[root + size + i] = leaves(flat[own + i], flat[own + next_place], i, real)
        leader = np.where(i > 0, before[own + i], 0)
        led = np.where(i > 0, leaves(flat[own + leader], flat[own + i], leader, i > 0), tree[root + size + i])
        tree[root + size + leader] = led
        gone = np.where(gone < size, gone, i)  # the last id begins no pair
        tree[(root + size + gone)[gone != i]] = never
        for place in (gone, leader, i):
            node = size + place
            for _ in range(shift):
                node >>= 1
                tree[root + node] = np.minimum(tree[root + 2 * node], tree[root + 2 * node + 1])
        rows = rows[tree[root + 1] < never]
    return flat[living], alive.sum(1)


def codes_of(ranges: str) -> list[int]:
    return [c for part in ranges.split() for a, b in [part.split("-")] for c in range(int(a, 16), int(b, 16) + 1)]


def letter_classes() -> dict[str, str]:
    """Letters and numbers as ranges for a regular expression: those of Python's own Unicode table and
    ``NEWER_LETTERS``. (Tables of other packages know more letters than the library.)"""
    out, newer = {"L": [], "N": []}, set(codes_of(NEWER_LETTERS))
    for code in range(sys.maxunicode + 1):
        kind = "L" if code in newer else unicodedata.category(chr(code))[0]
        if kind in out:
            ranges = out[kind]
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return {kind: "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges) for kind, ranges in out.items()}


class Codec:
    """Encoder and decoder of one vocabulary file (its JSON text)."""

    def __init__(self, text: str):
        import regex

        spec = json.loads(text)
        vocabulary = spec["model"]["vocab"]
        self.tokens = {i: t for t, i in vocabulary.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens.update((i, t) for t, i in self.special.items())
        self.names = {i: str(i) for i in self.tokens}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.results = [vocabulary[a + b] for a, b in pairs]
        self.ranks = {vocabulary[a] << 20 | vocabulary[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.pairs = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[k] for k in self.pairs.tolist()] + [len(pairs)], np.int64)
        self.result_ids = np.array(self.results, np.int64)
        letters = byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int64)
        self.final = np.array([vocabulary[x + WORD_END] for x in letters], np.int64)
        classes = letter_classes()
        self.any_pieces = regex.compile(PIECES.replace("{L}", classes["L"]).replace("{N}", classes["N"])).findall
        # where all tables agree: the same classes by name, which are looked up and not searched through
        self.old_pieces = regex.compile(PIECES.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}")).findall
        self.chunks = regex.compile(NOT_SPACE).findall
        self.capitals = {c: c + more for ranges, more in NEWER_CAPITALS for c in codes_of(ranges)}
        self.has_capital = regex.compile("[" + "".join(map(chr, self.capitals)) + "]").search
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def rank_of(self, pairs: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.pairs, pairs)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], len(self.results))

    def word(self, piece: str) -> list[int]:
        return self.words([piece])[0]

    def words(self, given: list[str]) -> list[list[int]]:
        """Ids of each word."""
        data = [w.encode("utf-8", "surrogatepass") for w in given]
        out: list[list[int]] = [[]] * len(given)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(data):
            by_size.setdefault(max(len(w) - 2, 0).bit_length() if len(w) <= LONGEST_TOGETHER else -1, []).append(i)
        for size, places in by_size.items():
            if size < 0:
                for i in places:
                    ids = self.inner[list(data[i])].tolist()
                    ids[-1] = int(self.final[data[i][-1]])
                    out[i] = merged(ids, self.ranks, self.results)
                continue
            width = 2**size + 1
            for start in range(0, len(places), TOGETHER):
                own = places[start : start + TOGETHER]
                lengths = np.array([len(data[i]) for i in own])
                table = np.frombuffer(b"".join([data[i].ljust(width, b"\0") for i in own]), np.uint8).reshape(-1, width)
                ids = self.inner[table]
                last = np.arange(len(own)), lengths - 1
                ids[last] = self.final[table[last]]
                flat, counts = merge_together(ids, lengths, self.rank_of, self.result_ids)
                found, end = flat.tolist(), np.cumsum(counts).tolist()
                for i, a, b in zip(own, [0, *end], end):
                    out[i] = found[a:b]
        return out

    def pieces(self, text: str) -> list[str]:
        return self.old_pieces(text) if text.isascii() or max(text) < AGREED else self.any_pieces(text)

    def cut(self, text: str) -> list[str]:
        """The words of a lower-case text without white space."""
        return [text] if text.isalpha() and text.isascii() else self.pieces(text)

    def chunk(self, text: str) -> list[int]:
        return [i for ids in self.words(self.cut(text)) for i in ids]

    def parts(self, text: str) -> Iterable[str | int]:
        """The chunks between white space, lower-case and composed, and special ids."""
        if not any(mark in text for mark in self.special):
            return self._split(text)
        out, at = [], 0
        for mark in self.marks.finditer(text):
            out += [*self._split(text[at : mark.start()]), self.special[mark[0]]]
            at = mark.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[str]:
        # each letter by itself: no rule for a sigma at the end of a word
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.has_capital(text):
                text = text.translate(self.capitals)
        text = text.lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.chunks(text)
        return text.split()

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for part in self.parts(text or ""):
            if isinstance(part, int):
                ids.append(part)
            else:
                ids += self.chunk(part)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by a space (the file names no other decoder), special ones included."""
        return " ".join([self.tokens[i] for i in ids])


Entry = tuple[int, str, str]  # number of ids, ids, what they decode to


class TextCodec:
    """Encodes and decodes whole texts, with the results of frequent words and chunks kept."""

    def __init__(self, codec: Codec):
        self.codec = codec
        # two halves: a full one becomes the old one, so that what is frequent stays known
        self.known: dict[str | int, Entry] = {}
        self.old: dict[str | int, Entry] = {}

    def __call__(self, text: str | None) -> Entry:
        return self.batch([text])[0]

    def batch(self, texts: list[str | None]) -> list[Entry]:
        codec, known, old = self.codec, self.known, self.old
        parts = [codec.parts(text or "") for text in texts]
        found: dict[str | int, Entry | None] = {}
        for own in parts:
            for part in own:
                if part not in found:
                    found[part] = known.get(part) or old.get(part)
        cuts = {part: codec.cut(part) for part, entry in found.items() if entry is None and isinstance(part, str)}
        words = {w: known.get(w) or old.get(w) for own in cuts.values() for w in own}
        new = [w for w, entry in words.items() if entry is None]
        names, tokens = codec.names, codec.tokens
        for word, ids in zip(new, codec.words(new)):
            words[word] = (len(ids), " ".join([names[i] for i in ids]), " ".join([tokens[i] for i in ids]))
        for part, entry in found.items():
            if isinstance(part, int):
                found[part] = (1, names[part], tokens[part])
            elif entry is None:
                own = cuts[part]
                found[part] = words[own[0]] if len(own) == 1 else self._joined([words[w] for w in own])
        out = [self._joined([found[part] for part in own]) for own in parts]
        for part, entry in (words | found).items():
            if isinstance(part, int) or len(part) <= CACHED_LENGTH:
                known[part] = entry
        if len(known) > CACHED:
            # a batch may bring many at once: what is over goes with the old half
            self.old = dict(list(known.items())[-CACHED:])
            self.known = {}
        return out

    @staticmethod
    def _joined(entries: list[Entry]) -> Entry:
        if not entries:
            return 0, "", ""
        counts, ids, decoded = zip(*entries)
        return sum(counts), " ".join(ids), " ".join(decoded)


def kept(name: str, make):
    """``make()`` of this Python worker: the first task makes it, later ones find it."""
    store = sys.modules.setdefault("vitals_worker_store", types.ModuleType("vitals_worker_store"))
    if name not in store.__dict__:
        store.__dict__[name] = make()
    return store.__dict__[name]


def vocabulary(spark: SparkSession, path: str):
    """Broadcast a vocabulary file of the driver (a few MB, by its kind)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded(df: DataFrame, path: str, text: str | Column = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), ``n_tokens``, ``ids`` (decimal, separated
    by a space) and ``decoded`` (the text that these ids decode to)."""
    spec = vocabulary(df.sparkSession, path)
    name = f"{df.sparkSession.sparkContext.applicationId}:{path}"

    @F.pandas_udf("n_tokens bigint, ids string, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = kept(name, lambda: TextCodec(Codec(spec.value)))
        for texts in batches:
            start = size = 0
            given = [t if isinstance(t, str) else None for t in texts]
            for i, t in enumerate(given, 1):
                size += len(t or "")
                if size >= BATCH_BYTES or i == len(given):
                    yield pd.DataFrame(codec.batch(given[start:i]), columns=["n_tokens", "ids", "decoded"])
                    start, size = i, 0

    return applied(df, encode, text, df.columns if keep is None else keep)


def id_array(ids: Column) -> Column:
    """The ids of an ``ids`` text as an array of integers."""
    return F.when(ids == "", F.array().cast("array<int>")).otherwise(F.split(ids, " ").cast("array<int>"))


def op8_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    found = encoded(table(spark, sf_dir, "documents"), path or default_path(), keep=["doc_id"])
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
