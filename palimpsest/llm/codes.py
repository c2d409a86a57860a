"""Vector codes: every part of a vector is the number of its nearest entry in a small codebook.

Vectors become whole numbers, are cut into equal consecutive parts, and each part position
learns its entries over all rows: assign every part to its nearest entry, move every entry
to the mean of its parts, again. A round is one pass over the input that sends one partial
sum per task, entry and dimension; the codebooks (parts x entries x dimensions, whatever the
data) go back to the tasks in the closure of the next pass.

The nearest entry is found by slices and intersections. Per dimension the entries' coordinates
are sorted, and a prefix mask says which entries are among the first k of them: two binary
searches and one XOR give the entries within the radius of a coordinate as bits of one word.
The words of all dimensions ANDed leave the candidates, which contain every entry whose
distance is at most the radius; their distances are computed exactly. A row without an entry
that near goes on with the distance of its best candidate as radius, or with twice the radius
when it has none. The result is that of comparing with all entries, the lowest index first.

Defined cases: a row is dropped if its vector is null or holds a null, NaN or infinite
component. The vectors are as long as the longest kept one, rounded up to whole parts; shorter
ones end in zeros. Rows without an id count as rows with the largest ids; rows with equal ids
start the codebook in the order of their vectors. With fewer rows than entries the codebook has
fewer entries. Components beyond 2**27 in whole numbers are cut there, so that 64 bits hold
every distance. Labels that are null are a group of their own. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import stored

SCALE = 4096
LARGEST = 2**27
BATCH_ROWS = 8_192


class Slices:
    """Nearest entries of one part position; at most 64 entries, one bit each."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        size, dims = entries.shape
        if size > 64:
            raise ValueError("a word has bits for 64 entries")
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, order, axis=0)
        bits = np.uint64(1) << order.astype(np.uint64)
        self.masks = np.zeros((size + 1, dims), np.uint64)
        self.masks[1:] = np.bitwise_or.accumulate(bits, axis=0)
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        near = np.where(apart > 0, apart, np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        known = near[near < np.iinfo(np.int64).max]
        # where a part lies between two neighbouring entries, half their distance is enough
        self.first = math.isqrt(int(np.median(known))) // 2 + 1 if len(known) else 1

    def candidates(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A word a row: entries that are within the radius in every dimension."""
        word = np.full(len(parts), ~np.uint64(0))
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            word &= self.masks[high, d] ^ self.masks[low, d]
        return word

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of every row's nearest entry, ties to the lower index."""
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.zeros(len(parts), np.int64)
        rows = np.arange(len(parts))
        radius = np.full(len(parts), self.first, np.int64)
        while len(rows):
            mine = parts[rows]
            word = self.candidates(mine, radius)
            found, at = np.full(len(rows), np.iinfo(np.int64).max), np.zeros(len(rows), np.int64)
            for e in range(len(self.entries)):
                some = np.flatnonzero(word >> np.uint64(e) & np.uint64(1))
                away = ((mine[some] - self.entries[e]) ** 2).sum(1)
                nearer = away < found[some]
                found[some[nearer]], at[some[nearer]] = away[nearer], e
            best[rows], index[rows] = found, at
            any_ = word > 0
            open_ = found > radius * radius  # an entry outside the slices may be nearer
            reach = np.ceil(np.sqrt(np.where(any_, found, 0).astype(np.float64))).astype(np.int64) + 1
            rows, radius = rows[open_], np.where(any_, reach, 2 * radius)[open_]
        return index, best


@dataclass(frozen=True)
class Codebooks:
    """Whole-number entries by part position, entry and position within the part."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def dims(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The vectors (rows x dims) that codes (rows x parts) stand for."""
        parts = np.arange(self.entries.shape[0])
        return self.entries[parts, codes].reshape(len(codes), -1) / self.scale


def usable(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def whole_numbers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Rows x dims of floor(scale * x); shorter vectors end in zeros."""
    ends = np.asarray(column.offsets)
    flat = np.asarray(column.values, np.float64)[ends[0]:ends[-1]]
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), dims), np.float64)
    out[np.arange(dims) < lengths[:, None]] = np.floor(flat * scale)
    return np.clip(out, -LARGEST, LARGEST).astype(np.int64)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def assigned(books: Codebooks, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances, rows x parts."""
    count, _, width = books.entries.shape
    both = [Slices(books.entries[p]).nearest(vectors[:, p * width:(p + 1) * width]) for p in range(count)]
    return np.stack([i for i, _ in both], 1), np.stack([d for _, d in both], 1)


def _round(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry at the mean of its parts, rounded down; an unused one stays."""
    count, size, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(books.entries.shape, np.int64)
        used = np.zeros((count, size), np.int64)
        for batch in pieces(batches):
            vectors = whole_numbers(batch.column(0), books.dims, books.scale)
            codes, _ = assigned(books, vectors)
            for p in range(count):
                np.add.at(total[p], codes[:, p], vectors[:, p * width:(p + 1) * width])
                used[p] += np.bincount(codes[:, p], minlength=size)
        each = np.repeat(used.ravel(), width)
        some = np.flatnonzero(each)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(total.ravel()[some]), pa.array(each[some])], ["place", "total", "used"])

    wide = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    moved = rows.select("vector").mapInArrow(sums, "place long, total long, used long").groupBy(
        "place").agg(wide("total"), wide("used")).collect()  # parts x entries x dimensions of a part at most
    entries = books.entries.ravel().copy()
    for row in moved:
        entries[row["place"]] = int(row["total"]) // int(row["used"])
    return Codebooks(entries.reshape(books.entries.shape), books.scale)


def fitted(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int = SCALE) -> Codebooks | None:
    """Codebooks over all rows (id, vector); None without rows."""
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    width = max(-(-longest // parts), 1)
    start = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    first = whole_numbers(start.column(0).combine_chunks(), width * parts, scale)
    books = Codebooks(first.reshape(len(first), parts, width).transpose(1, 0, 2).copy(), scale)
    for _ in range(rounds):
        books = _round(rows, books)
    return books


def compressed(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 8, entries: int = 16, rounds: int = 6,
) -> tuple[DataFrame, Codebooks | None]:
    """(key, label, codes, error) of every usable row, stored, and the codebooks.

    ``codes`` has an entry number a part, ``error`` is the squared distance to the entries in
    units of 1/4096, summed over the parts.
    """
    rows = table.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"),
    ).filter(usable(F.col("vector")))
    books = fitted(rows, parts, entries, rounds)
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            codes, away = assigned(books, whole_numbers(batch.column(2), books.dims, books.scale))
            ends = pa.array(np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.ListArray.from_arrays(ends, pa.array(codes.astype(np.int32).ravel())),
                 pa.array(away.sum(1))], ["id", "label", "codes", "error"])

    coded = rows.limit(0).selectExpr("id", "label", "array(0) AS codes", "0L AS error") if books is None \
        else rows.mapInArrow(code, schema)
    return stored(coded, "codes").select(F.col("id").alias(key), F.col("label").alias(label), "codes", "error"), books


def by_label(coded: DataFrame, label: str = "label", error: str = "error", out: str = "label_error") -> DataFrame:
    """``coded`` with the errors summed over equal labels; a sum beyond 64 bits stays at their end.

    The sums are aggregated before they are joined, so a hot label is one row on that side;
    rows are split by the adaptive skew join when the sums are too many to be sent around.
    """
    sums = coded.groupBy(F.col(label).alias("__label")).agg(
        F.least(F.sum(F.col(error).cast("decimal(38,0)")), F.lit(2**63 - 1)).cast("long").alias(out))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
