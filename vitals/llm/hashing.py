"""Word hashes, window hashes and membership maps for the operators on word sequences."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SLICE = 1_000_000  # bytes that are hashed at once


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Windows:
    """Hashes of stretches of a sequence, by differences of one running sum."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _running(self, values: np.ndarray) -> np.ndarray:
        n = len(values)
        if len(self.up) <= n:
            inverse = pow(BASE, -1, 2**64)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)], dtype=np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.down[:n], out=total[1:])
        return total

    def __call__(self, hashes: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all windows of ``width`` values."""
        n = len(hashes)
        if n < width:
            return np.zeros(0, np.uint64)
        total = self._running(hashes)
        return mixed((total[width:] - total[:-width]) * self.up[: n - width + 1])

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes ``data[start:end]`` of each word; words are in order."""
        out, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            origin = starts[i]
            j = max(i + 1, int(np.searchsorted(ends, origin + SLICE, "right")))
            total = self._running(data[origin : ends[j - 1]].astype(np.uint64) + np.uint64(1))
            a, b = starts[i:j] - origin, ends[i:j] - origin
            out[i:j] = mixed((total[b] - total[a]) * self.up[a] + (b - a).astype(np.uint64))
            i = j
        return out


def byte_set(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


SPACES = byte_set(b" \t\n\x0b\x0c\r")


def word_bounds(texts: list[bytes], between: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one array of bytes, the bounds of their words (runs of bytes that are not in
    ``between``), and the number of words of each text."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    outside = between[data]
    starts = np.flatnonzero(outside[:-1] & ~outside[1:]) + 1
    ends = np.flatnonzero(~outside[:-1] & outside[1:]) + 1
    borders = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return data, starts, ends, np.diff(np.searchsorted(starts, borders))


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the words one after the other, and their offsets."""
    lengths = ends - starts
    offsets = np.r_[0, np.cumsum(lengths)]
    return data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])], offsets


def pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with their texts (column ``text``, null as empty), of about ``size`` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        cuts = np.cumsum(lengths, dtype=np.int64) // size
        borders = np.flatnonzero(np.diff(cuts)) + 1
        for a, b in zip([0, *borders], [*borders, batch.num_rows]):
            if b > a:
                own = batch.slice(a, b - a)
                yield own, [t or b"" for t in own["text"].to_pylist()]


def sliding(x: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """The least (or by ``np.maximum`` the largest) of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = least(x[:-span], x[span:])
        span *= 2
    return x if span == width else least(x[: len(x) - (width - span)], x[width - span :])


def membership(keys: DataFrame, key: str, bits: int):
    """A broadcast map of 2**bits bits in which the bit of each key is set. Its size depends on
    ``bits`` alone: a key is always found, and with very many keys others are found too, so it
    serves to leave out what cannot match, before an exact step."""
    index = F.pmod(F.col(key), F.lit(2**bits).cast("bigint"))
    words = keys.select(F.shiftright(index, 6).alias("word"), index.alias("bit")).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("set")
    )
    found = words.toArrow()
    table = np.zeros(max(2**bits // 64, 1), np.int64)
    table[found["word"].to_numpy()] = found["set"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint8))


def contained(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (uint64, as stored signed) have their bit in a ``membership`` map."""
    index = keys & np.uint64(len(table) * 8 - 1)
    return (table[(index >> np.uint64(3)).astype(np.int64)] >> (index & np.uint64(7)).astype(np.uint8)) & 1 > 0
