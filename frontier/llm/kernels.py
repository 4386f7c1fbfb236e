"""Vectorised byte-level text helpers shared by the operators of this package.

Everything here works on one Arrow batch inside a task: the text column is viewed
as one UTF-8 byte array with row offsets, words are found with a 256-entry class
table, and every word gets a 64-bit polynomial hash. Nothing here knows about Spark
except :func:`text_map`, which turns such a helper into a ``mapInArrow`` job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from frontier.session import ship_package

U64 = np.uint64
#: Odd multiplier of the polynomial hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
#: Bytes of text that one inner step handles; longer single words enlarge a step.
BLOCK = 1 << 20

_ALL = np.arange(256)
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)
SAME = _ALL.astype(np.uint8)
#: Word characters: ASCII digits and letters, and every byte of a non-ASCII character.
ALNUM = (_ALL >= 0x80) | ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A))
#: Word characters: everything but space and 0x09-0x0D.
NONSPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (every input bit reaches every output bit)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table of a process only grows."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


@dataclass
class Words:
    """Words of consecutive texts: byte spans, hashes, and per text its first word.

    ``first`` has one more entry than there are texts; text ``i`` owns the words
    ``first[i]:first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; ``fold`` maps bytes before hashing.

    Runs over blocks that end outside a word, so memory beside the result is bounded
    by the block and the longest word."""
    n, at = int(offsets[-1]), int(offsets[0])
    starts, ends, hashes = [], [], []
    while at < n:
        to = min(n, at + BLOCK)
        while to < n:
            tail = np.flatnonzero(~is_word[data[max(at, to - 4096):to]])
            if len(tail):
                to = max(at, to - 4096) + int(tail[-1]) + 1
                break
            to = min(n, to + 4096)
        part = data[at:to]
        word = is_word[part]
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        cuts = offsets[(offsets > at) & (offsets < to)] - at
        start[cuts] |= word[cuts]
        end[cuts - 1] |= word[cuts - 1]
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        total = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum((fold[part].astype(U64) + U64(1)) * powers(_BASE, len(part)), out=total[1:])
        hashes.append(mix((total[e] - total[s]) * powers(_BASE_INV, len(part))[s] + (e - s).astype(U64)))
        starts.append(s + at)
        ends.append(e + at)
        at = to
    join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
    s = join(starts, np.int64)
    return Words(s, join(ends, np.int64), join(hashes, U64), np.searchsorted(s, offsets))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and whether it stays inside one text."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, bool)
    out = np.zeros(n, dtype=U64)
    for j in range(size):
        out *= U64(_BASE)
        out += words.hashes[j:j + n]
    doc = words.doc
    return mix(out + U64(size)), doc[:n] == doc[size - 1:]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as UTF-8 bytes and offsets; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def row_groups(offsets: np.ndarray, budget: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``budget`` bytes; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + budget, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def bounded_batches(spark: SparkSession) -> None:
    """Before a job with Python functions: the package goes to the workers, and Arrow batches
    stay small, so that a task's memory doesn't follow the text length."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def text_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``df``: one batch in, one batch out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
