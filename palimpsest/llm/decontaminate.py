"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item has a 128-bit SimHash of its five-word shingles, weighted by
how often they occur. Windows of each item's size slide over the documents one
word at a time; a multi-index over sixteen 8-bit blocks returns every item whose
fingerprint is within RADIUS bits (16 blocks share at most 47 wrong bits only if
one of them has two or fewer), and the exact weighted similarity of the shingles
decides. A window can pass only if ``threshold`` of its shingles occur in the
benchmark, so the fingerprints of the others need not be made. A text shorter than
an item is one window, the whole text, for the items it may still be like.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import SHINGLE, mix, slices, windows, word_hashes, words_of

BLOCKS, RADIUS = 16, 47
BLOCK_BYTES = 4 << 20  # benchmark text in one pass over the documents
ROWS = 2048  # windows whose fingerprints are made at a time
MATCH = pa.schema([
    ("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()),
    ("hamming", pa.int64()), ("similarity", pa.float64())])
SALTS = [np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)]
NEAR = [np.array([v for v in range(256) if bin(v ^ b).count("1") <= RADIUS // BLOCKS])
        for b in range(256)]


def simhash(shingles: np.ndarray) -> np.ndarray:
    """Fingerprints (rows x 16 bytes) of rows of shingle hashes; repeats weigh by number."""
    halves = [mix(shingles ^ salt)[..., None].view(np.uint8) for salt in SALTS]
    bits = np.unpackbits(np.concatenate(halves, axis=-1), axis=-1)
    return np.packbits(2 * bits.sum(axis=1, dtype=np.int32) > shingles.shape[1], axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two multisets of shingles: sum of minima over sum of maxima."""
    values, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(inverse[:len(a)], minlength=len(values))
    y = np.bincount(inverse[len(a):], minlength=len(values))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


@dataclass
class Items:
    """The benchmark items of one size (in words), with their multi-index."""

    words: int
    ids: list[int] = field(default_factory=list)
    shingles: list[np.ndarray] = field(default_factory=list)

    def close(self) -> Items:
        self.prints = simhash(np.stack(self.shingles))
        self.known = np.unique(np.concatenate(self.shingles))
        self.index = []
        for block in range(BLOCKS):
            lists: list[list[int]] = [[] for _ in range(256)]
            for item, value in enumerate(self.prints[:, block]):
                for near in NEAR[value]:
                    lists[near].append(item)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            self.index.append((starts, np.array([i for x in lists for i in x], np.int64)))
        return self

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, distance) of all pairs at most RADIUS bits apart."""
        pairs = []
        for block, (starts, lists) in enumerate(self.index):
            value = prints[:, block].astype(np.int64)
            n = starts[value + 1] - starts[value]
            row = np.repeat(np.arange(len(prints)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[value], n)
            pairs.append(row * len(self.ids) + lists[at])
        row, item = np.divmod(np.unique(np.concatenate(pairs)), len(self.ids))
        bits = np.unpackbits(prints[row] ^ self.prints[item], axis=1).sum(axis=1, dtype=np.int64)
        near = bits <= RADIUS
        return row[near], item[near], bits[near]


def index_items(rows: list[tuple[int, str | None]]) -> list[Items]:
    """Items by size; an item without words has no windows and matches nothing."""
    words = words_of(pa.array([t for _, t in rows], pa.string()))
    shingles, ends = windows(word_hashes(words), words.bounds)
    sizes: dict[int, Items] = {}
    for i, (item, _) in enumerate(rows):
        n = int(words.counts[i])
        if n:
            group = sizes.setdefault(n, Items(n))
            group.ids.append(item)
            group.shingles.append(shingles[ends[i]:ends[i + 1]])
    return [sizes[n].close() for n in sorted(sizes)]


def marks(shingles: np.ndarray, ends: np.ndarray, whole: np.ndarray, groups: list[Items],
          threshold: float) -> Iterator[tuple[int, Items, np.ndarray]]:
    """(text, group, places of the group's shingles in the text) wherever they are enough
    for one window to reach ``threshold``."""
    known = np.concatenate([g.known for g in groups])
    owner = np.repeat(np.arange(len(groups)), [len(g.known) for g in groups])
    order = np.argsort(known, kind="stable")
    known, owner = known[order], owner[order]
    slot = np.uint64((1 << 20) - 1)
    table = np.zeros(1 << 20, bool)
    table[(known & slot).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(shingles & slot).astype(np.int64)])
    first = np.searchsorted(known, shingles[maybe], "left")
    n = np.searchsorted(known, shingles[maybe], "right") - first
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    place, group = np.repeat(maybe, n), owner[at]
    row = np.searchsorted(ends, place, "right") - 1
    pair = row * len(groups) + group
    order = np.argsort(pair, kind="stable")
    place, pair = place[order], pair[order]
    cuts = np.flatnonzero(np.diff(pair, prepend=-1))
    for begin, upto in zip(cuts, np.append(cuts[1:], len(pair))):
        i, g = divmod(int(pair[begin]), len(groups))
        windows_of = groups[g].words - min(groups[g].words, SHINGLE) + 1
        if whole[i] and upto - begin >= threshold * windows_of - 1e-9:
            yield i, groups[g], place[begin:upto]


def matches(texts: pa.Array, groups: list[Items], threshold: float,
            ) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(row, item_id, start_word, n_words, hamming, similarity) of the best window
    of each text and item: the most similar one, then the first."""
    words = words_of(texts)
    hashes = word_hashes(words)
    best: dict[tuple[int, int], tuple] = {}
    for size in sorted({min(g.words, SHINGLE) for g in groups}):
        same = [g for g in groups if min(g.words, SHINGLE) == size]
        shingles, ends = windows(hashes, words.bounds, size)
        for i, group, marked in marks(shingles, ends, words.counts >= size, same, threshold):
            mine, full = shingles[ends[i]:ends[i + 1]], group.words - size + 1
            n = min(full, len(mine))  # a text shorter than the item is one window
            total = np.zeros(len(mine) + 1, np.int64)
            total[marked - ends[i] + 1] = 1
            total = np.cumsum(total)
            starts = np.flatnonzero(total[n:] - total[:-n] >= threshold * full - 1e-9)
            for part in (starts[a:a + ROWS] for a in range(0, len(starts), ROWS)):
                near = group.within(simhash(mine[part[:, None] + np.arange(n)]))
                for r, item, bits in zip(*near):
                    at = int(part[r])
                    alike = similarity(mine[at:at + n], group.shingles[item])
                    if alike >= threshold:
                        key, found = (i, group.ids[item]), (-alike, at, n + size - 1, int(bits))
                        best[key] = min(best.get(key, found), found)
    for (i, item), (alike, at, n, bits) in sorted(best.items(), key=lambda kv: (
            kv[0][0], kv[0][1] is not None, kv[0][1] or 0)):
        yield i, item, at, n, bits, -alike


def item_blocks(benchmark: DataFrame) -> Iterator[list[Items]]:
    """The benchmark in blocks of about BLOCK_BYTES of text, one block in memory at a time."""
    block, held = [], 0
    for item, text in benchmark.select(
            F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        block.append((item, text))
        held += len(text or "")
        if held >= BLOCK_BYTES:
            yield index_items(block)
            block, held = [], 0
    if block:
        yield index_items(block)


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8,
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): each document that
    holds a window like a benchmark item, with its most similar, then first, window.
    The only window of a document shorter than an item is the whole document.

    Words are lower-cased (A-Z). An item of fewer than five words is compared as one
    window of its size. Null or empty texts and items match nothing; repeated rows
    and items are reported each; a null id is reported as null. Empty tables give no
    rows. Other columns are not read. The benchmark is indexed in blocks of bounded
    bytes, each with its own pass over the documents.
    """
    parts = []
    for groups in item_blocks(benchmark):
        def find(batches, groups=groups):
            for piece in slices(batches, text):
                found = list(matches(piece.column(text), groups, threshold)) if groups else []
                ids = piece.column(doc_id).take(pa.array([m[0] for m in found], pa.int64()))
                columns = list(zip(*found))[1:] if found else [[]] * len(MATCH)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, f.type) for c, f in zip(columns, MATCH))],
                    names=[doc_id, *MATCH.names])

        kind = dict(docs.dtypes)[doc_id]
        parts.append(docs.select(doc_id, text).mapInArrow(
            find, f"`{doc_id}` {kind}, item_id long, start_word long, n_words long, "
            "hamming long, similarity double"))
    if not parts:
        return docs.select(doc_id, *(F.lit(None).cast(t).alias(n) for n, t in (
            ("item_id", "long"), ("start_word", "long"), ("n_words", "long"), ("hamming", "long"),
            ("similarity", "double")))).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8,
                   text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window like a benchmark item, unchanged."""
    for groups in item_blocks(benchmark):
        def keep(batches, groups=groups):
            for piece in slices(batches, text):
                bad = {m[0] for m in matches(piece.column(text), groups, threshold)} if groups else ()
                yield piece.filter(pa.array([i not in bad for i in range(piece.num_rows)]))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
