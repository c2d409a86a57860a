"""Reading, storing and cutting text into words: helpers of the operators beside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import configure, work_dir

# Fixed: a word is a run of characters other than the six ASCII blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
SHINGLE = 5


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here and a lost
    executor costs only the tasks that were running on it."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_name(df: DataFrame) -> str:
    """A name that no column of ``df`` has."""
    return max(df.columns, key=len) + "_"


class IdFilter:
    """A bitmap of hashed ids, to set apart the rows that a join with them cannot concern.

    It has no false negatives; false positives go through the join. At most 2**28 bits,
    32 MB, whatever the number of ids; the rows of the join are the same at any size.
    """

    def __init__(self, ids: DataFrame):
        spark, (name,) = ids.sparkSession, ids.columns
        self.size = 1 << min(28, max(18, (16 * ids.count()).bit_length()))
        place = self._slot(name) + 1  # the bitmap functions count from 1
        rows = ids.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow()
        bits = np.zeros((-(-self.size // 32768), 4096), np.uint8)
        for bucket, data in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
            bits[bucket - 1] = np.frombuffer(data, np.uint8)
        self.bits = spark.sparkContext.broadcast(bits.ravel())

    def _slot(self, name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name)), F.lit(self.size))

    def split(self, df: DataFrame, name: str, inside: bool) -> DataFrame:
        """The rows of ``df`` whose id may be among the ids, or those whose id is not."""
        bits, own = self.bits, new_name(df)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                slot = b.column(own).to_numpy()
                found = (bits.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1) == int(inside)
                yield b.drop_columns([own]).filter(pa.array(found))

        return df.withColumn(own, self._slot(name)).mapInArrow(keep, df.schema)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text leaves the remainder ``fold``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000,
           rows: int = 5_000) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``limit`` bytes of ``column``.

    A longer text makes a piece of its own, so memory follows the longest text
    and not the number of rows in a batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
            upto = min(max(upto, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, upto - at)
            at = upto


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column end to end, and the bounds of its rows (null: empty)."""
    texts = column.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


@dataclass
class Words:
    """The words of some texts: byte spans into ``data`` and the bounds of each text's words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def words_of(column: pa.Array, lower: bool = True) -> Words:
    data, bounds = utf8(column)
    if lower:
        data = LOWER[data]
    solid = ~BLANKS[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = np.unique(bounds[1:-1])  # neighbours in the buffer, but of two texts
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64 over all others (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit numbers, the same on every machine."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed)) | np.uint64(1)


BYTE_VALUES = np.where(BLANKS, np.uint64(0), numbers(256, 11))
RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)


def powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), RADIX))])[:max(n, 1)]


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial over its bytes, well mixed."""
    starts = words.starts
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = words.data[starts[0]:]
    at = starts - starts[0]
    lengths = np.diff(np.append(at, len(data)))
    place = np.arange(len(data)) - np.repeat(at, lengths)
    value = BYTE_VALUES[data] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, at))


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE,
            ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word windows of each text and their bounds.

    A text with fewer words, but at least one, has its whole sequence as its only window.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    ends = np.concatenate([[0], np.cumsum(made)])
    at = np.repeat(bounds[:-1] - ends[:-1], made) + np.arange(ends[-1])
    length = np.repeat(np.minimum(counts, size), made)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    factor, total = numbers(size, 23), np.zeros(len(at), np.uint64)
    for k in range(size):
        total += np.where(length > k, padded[at + k] * factor[k], np.uint64(0))
    return mix(total + length.astype(np.uint64)), ends


def sorted_sets(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, ascending, and their bounds."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(bounds)))
