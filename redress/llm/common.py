"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redress.sources.workers import map_batches as map_batches

#: The white space of the contracts, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MASK = (1 << 64) - 1


# -- columns ----------------------------------------------------------------------


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expression that a lambda refers to is evaluated again for each element;
    one that is bound as a lambda's variable is not.
    """
    return F.transform(F.array(value), lambda x: body(x)).getItem(0)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    return df.drop(*names)


def same_row(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality of the named columns, a NULL being equal to a NULL."""
    condition = F.lit(True)
    for name in names:
        condition &= left[name].eqNullSafe(right[name])
    return condition


# -- rows within tasks --------------------------------------------------------------


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small parts, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\x20\x09-\x0D]+`` with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class Memo(dict):
    """Remembers results by key, within two generations of bounded size."""

    def __init__(self, compute: Callable, entries: int = 100_000, longest: int = 64):
        super().__init__()
        self.compute, self.entries, self.longest, self.old = compute, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value


def word_hashes() -> Memo:
    """64-bit hash of a word, the same in every process."""
    return Memo(xxhash.xxh3_64_intdigest)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words, in order; fewer words make one run."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    out = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - size + 1 + k])
    return out


def bucket(id_column: str, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; -1 for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus, F.lit(-1))
