"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

The library normalises a text and turns ids back into text; which pieces a text has
is found here. The symbols of a text are its characters. An agenda holds every pair
of neighbours that together are a piece, the pair of the best score first, the
leftmost of equal ones; taking a pair joins it and puts its new neighbours on the
agenda. Characters without a piece become their UTF-8 bytes.

No merge can pass two neighbouring characters that stand side by side in no piece,
so texts are cut there before the agenda runs: results are the same, and a segment
(mostly a word) met before is looked up. Every Arrow batch is held against the
library's own encoding; a vocabulary with user-defined or unused pieces, which the
library treats in another way, would show there.

Defined cases: a null text is encoded as an empty one and has no ids; repeated and
null ids of rows are rows like any other; texts of any length are encoded whole, the
agenda of an uncut run of n characters costs n log n; columns other than the key and
the text are not looked at. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import slices

KEPT_SEGMENTS = 300_000  # memory of one task; a segment that was let go is encoded again
LONGEST_KEPT = 48


def agenda_merge(segment: str, scores: dict[str, float]) -> list[str]:
    """The pieces of ``segment``: best pair first until no pair of neighbours is a piece.

    ``scores`` holds negated scores, so that the heap's smallest entry is the best pair.
    """
    parts, size, best = list(segment), len(segment), scores.get
    agenda = []
    for i in range(size - 1):
        joined = parts[i] + parts[i + 1]
        score = best(joined)
        if score is not None:
            agenda.append((score, i, i + 1, joined))
    if not agenda:
        return parts
    heapify(agenda)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    while agenda:
        _, left, right, joined = heappop(agenda)
        if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != len(joined):
            continue  # one of the two has been merged since
        parts[left], parts[right] = joined, ""
        after[left] = beyond = after[right]
        if beyond < size:
            before[beyond] = left
            wider = joined + parts[beyond]
            score = best(wider)
            if score is not None:
                heappush(agenda, (score, left, beyond, wider))
        front = before[left]
        if front >= 0:
            wider = parts[front] + joined
            score = best(wider)
            if score is not None:
                heappush(agenda, (score, front, left, wider))
    return list(filter(None, parts))


class Agendas:
    """The same agenda for many short segments at once.

    A row holds a segment's symbols; ``rank`` holds, at each living symbol, the rank of the
    piece that it makes with the next one. Each round takes the best pair of every row
    (the first minimum: the leftmost of equal scores).
    """

    NONE = np.int32(2**31 - 1)
    BUCKETS = (6, 12, 24, LONGEST_KEPT)

    def __init__(self, id_of: dict[str, int], scores: dict[str, float]):
        """Symbols are numbered: the pieces first, then letters that are only parts of pieces."""
        names = [*id_of, *sorted({x for piece in id_of for x in piece} - id_of.keys())]
        number = {name: n for n, name in enumerate(names)}
        self.size = len(names) + 1  # the last one: no symbol
        self.id_at = np.array([id_of.get(name, -1) for name in names])
        self.symbol_of = np.full(0x110000, len(names), np.int64)
        for name, n in number.items():
            if len(name) == 1:
                self.symbol_of[ord(name)] = n
        order = {score: n for n, score in enumerate(sorted(set(scores.values())))}
        splits = sorted(
            (number[piece[:i]] * self.size + number[piece[i:]], order[score], number[piece])
            for piece, score in scores.items() for i in range(1, len(piece))
            if piece[:i] in number and piece[i:] in number)
        table = np.array([*splits, (2**62, self.NONE, 0)], np.int64)
        self.keys, self.ranks, self.made = table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], self.NONE), np.where(found, self.made[at], 0)

    def merge(self, segments: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        """Each of the segments that end in pieces only, and its ids."""
        low = 1
        for high in self.BUCKETS:
            some = [s for s in segments if low < len(s) <= high]
            low = high
            if some:
                yield from self._merge(some)

    def _merge(self, segments: list[str]) -> Iterator[tuple[str, tuple[int, ...]]]:
        lengths = np.array(list(map(len, segments)))
        wide = int(lengths.max()) + 1
        inside = np.arange(wide) < lengths[:, None]
        symbol = np.full(inside.shape, self.size - 1, np.int64)
        symbol[inside] = self.symbol_of[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)]
        after = np.tile(np.arange(1, wide + 1), (len(segments), 1))
        before = after - 2
        rank = np.full(inside.shape, self.NONE, np.int64)
        into = np.zeros(inside.shape, np.int64)
        rank[:, :-1], into[:, :-1] = self.pairs(symbol[:, :-1], symbol[:, 1:])
        row = np.arange(len(segments))
        while True:
            left = rank[row].argmin(1)
            open_ = rank[row, left] < self.NONE
            row, left = row[open_], left[open_]
            if not len(row):
                break
            right = after[row, left]
            beyond, front = after[row, right], before[row, left]
            made = into[row, left]
            symbol[row, left], inside[row, right], rank[row, right] = made, False, self.NONE
            after[row, left], before[row, beyond] = beyond, left
            rank[row, left], into[row, left] = self.pairs(made, symbol[row, beyond])
            has = front >= 0
            row_, front = row[has], front[has]
            rank[row_, front], into[row_, front] = self.pairs(symbol[row_, front], made[has])
        ids = self.id_at[symbol[inside]]
        ends = np.cumsum([0, *inside.sum(1)])
        whole = np.minimum.reduceat(ids, ends[:-1]) >= 0
        ids, ends = ids.tolist(), ends.tolist()
        for n, segment in enumerate(segments):
            if whole[n]:
                yield segment, tuple(ids[ends[n]:ends[n + 1]])


class Vocabulary(dict):
    """Ids by segment, made when a segment is first met."""

    def __init__(self, model: bytes):
        super().__init__()
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        every = range(sp.get_piece_size())
        self.bytes_at = {int(sp.id_to_piece(i)[1:-1], 16): i for i in every if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        plain = [i for i in every if not (
            sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.id_of = {sp.id_to_piece(i): i for i in plain}
        self.scores = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        self.agendas = Agendas(self.id_of, self.scores)
        pairs = {xy for piece in self.id_of for xy in pairwise(piece)}
        letters = sorted({x for xy in pairs for x in xy})
        number = {x: n for n, x in enumerate(letters, 1)}
        self.class_of = np.zeros(0x110000, np.uint16)
        self.class_of[[ord(x) for x in letters]] = np.arange(1, len(letters) + 1)
        self.together = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for x, y in pairs:
            self.together[number[x], number[y]] = True

    def __missing__(self, segment: str) -> Sequence[int]:
        ids, id_of = [], self.id_of.get  # tuples of numbers are no work for the collector
        for piece in agenda_merge(segment, self.scores):
            at = id_of(piece)
            if at is not None:
                ids.append(at)
            elif self.bytes_at:
                ids.extend(self.bytes_at[b] for b in piece.encode())
            else:
                ids.append(self.unknown)
        if len(segment) <= LONGEST_KEPT:
            self[segment] = ids = tuple(ids)
        return ids

    def segments(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The normalised texts, cut where no piece has the two neighbours side by side, and
        the bounds of each text's segments."""
        joined = "".join(texts)
        letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = self.class_of[letters]
        cut = np.zeros(len(kind) + 1, bool)
        cut[1:-1] = ~self.together[kind[:-1], kind[1:]]
        ends = np.cumsum([0, *map(len, texts)])
        cut[ends] = True
        at = np.flatnonzero(cut)
        wide = 1 + (letters >= 0x80).astype(np.int64) + (letters >= 0x800) + (letters >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(wide)])[at]
        parts = pa.LargeStringArray.from_buffers(
            len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(joined.encode()))
        return parts.dictionary_encode(), np.searchsorted(at, ends)

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and their bounds."""
        if len(self) > KEPT_SEGMENTS:
            self.clear()
        parts, bounds = self.segments(self.library.normalize(texts))
        segments, which = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        self.update(self.agendas.merge([s for s in segments if s not in self]))
        ids = [self[s] for s in segments]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        pool = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(sizes[which])])
        flat = pool[np.repeat(starts[which] - ends[:-1], sizes[which]) + np.arange(ends[-1])]
        bounds = ends[bounds]
        if not self.bytes_at:  # neighbouring unknown pieces of a text count as one
            again = np.zeros(len(flat) + 1, np.int64)
            again[2:] = (flat[1:] == self.unknown) & (flat[:-1] == self.unknown)
            again[bounds[:-1][bounds[:-1] < len(flat)] + 1] = 0
            flat, bounds = flat[again[1:] == 0], bounds - np.cumsum(again)[bounds]
        return flat, bounds

    def encode(self, texts: list[str]) -> list[list[int]]:
        flat, bounds = self.flat_ids(texts)
        return [flat[a:b].tolist() for a, b in pairwise(bounds.tolist())]


@lru_cache(maxsize=1)
def vocabulary_of(model: bytes) -> Vocabulary:
    """One for all tasks of a Python worker; what it keeps is bounded."""
    return Vocabulary(model)


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded, agrees): the ids of every whole text, the text that the library
    makes of them, and whether the library's own encoding has the same ids.

    ``model`` is the path of the vocabulary file, read once on the driver (its size does
    not grow with the data) and sent to the tasks.
    """
    with open(model, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary_of(vocabulary.value)
        library = words.library
        for batch in slices(batches, "text", 1_000_000):
            texts = batch.column("text").fill_null("").to_pylist()
            flat, bounds = words.flat_ids(texts)
            ids = [flat[a:b] for a, b in pairwise(bounds.tolist())]
            theirs = library.encode_as_numpy(texts, num_threads=1)
            yield pa.RecordBatch.from_arrays([
                batch.column("key"),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                pa.array([library.decode(i) for i in ids], pa.string()),
                pa.array([np.array_equal(a, b) for a, b in zip(ids, theirs)], pa.bool_())],
                ["key", "ids", "decoded", "agrees"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = dict(narrow.dtypes)["key"]
    return narrow.mapInArrow(run, f"key {kind}, ids array<int>, decoded string, agrees boolean").select(
        F.col("key").alias(key), "ids", "decoded", "agrees")
