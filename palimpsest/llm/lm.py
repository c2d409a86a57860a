"""Language-model scores by logistic context mixing over bytes, with a word-count base.

Five predictors see the last one to four bytes and the word begun so far. Each
keeps, per hashed context and node of the byte's binary tree, how often the next
bit was 0 and 1. A mixer adds their stretched probabilities with weights chosen
by a gate (the bit's place and how much the longest contexts have seen), and an adaptive probability
map refines the result. Counting is one distributed pass: every task counts its
text, learns mixer and map online from all of it (a span is predicted before it is
counted; the first are short), and sends sparse blocks that are added up. The model has a fixed number of slots,
so its size is bounded; all training text goes into its counts.

Bytes are lower-cased (A-Z); 255, which UTF-8 never uses, ends a text and also
stands before it. Within a piece, equal (context, byte) events are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import (
    BLANKS, BYTE_VALUES, LOWER, RADIX, mix, numbers, slices, stored, utf8, word_hashes, words_of)

BITS = [16, 19, 20, 21, 21]  # log2 of the slots of each predictor
K = len(BITS)
BASES = np.concatenate([[0], np.cumsum([1 << b for b in BITS])])
SLOTS = int(BASES[-1])
BLOCK = 1 << 14  # slots that travel together
SPREAD = 64  # partial sums of a block, before their sum
LEVELS = [1, 2, 4, 16, 64, 256, 1024]  # counts from which a context is more trusted
COARSE = np.array([0, 1, 1, 1, 2, 2, 2, 2])
SETS = 3 * 8  # weight sets of a place of the byte
GATES, MAP_BINS, STRETCH = 8 * SETS, 33, 8.0
END = 255
RATE, PRIOR, MINI = 0.2, 50, 2048
BATCH = 1 << 13  # events scored at a time
HEAVY = 1 << 17  # words over one HEAVYth of all tokens, at most HEAVY, go to all tasks
MERGE = 1 << 19
PIECE = 1_000_000  # bytes of text that are worked on at a time
FIRST = 4096  # bytes of a task's first span; each later one is as long as all before it
INVERSE = np.uint64(pow(int(RADIX), -1, 1 << 64))
SMALL = pa.Codec("zstd", 1)
NODE, SPIN = numbers(2, 73)
TURNS = np.arange(256, dtype=np.uint64) * NODE * SPIN  # what a node adds to a slot's hash
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse, kept while the worker lives."""
    size = max(1 << 20, 1 << int(n - 1).bit_length()) if n else 1
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.concatenate(
            [[np.uint64(1)], np.cumprod(np.full(size - 1, r))]) for r in (RADIX, INVERSE))
    return tuple(p[:n] for p in _POWERS[size])


@dataclass
class Events:
    """Distinct (contexts, byte) events of a piece, how often each occurs, and where."""

    contexts: list[np.ndarray]  # one hash an order and event
    symbol: np.ndarray
    count: np.ndarray | None  # only of shuffled ones, to learn from
    codes: np.ndarray  # event of every byte
    starts: np.ndarray  # first byte of every text


def events(column: pa.Array, shuffle: bool = False) -> Events:
    raw, bounds = utf8(column)
    data = np.insert(LOWER[raw], bounds[1:], END)
    starts = bounds[:-1] + np.arange(len(bounds) - 1)
    n, ends = len(data), np.append(starts[1:], len(data))
    before = np.empty(n, np.uint32)  # the last four bytes, the latest lowest
    before[1:] = data[:-1]
    before[2:] |= data[:-2].astype(np.uint32) << np.uint32(8)
    before[3:] |= before[1:-2] << np.uint32(16)
    for j in range(4):  # what stands before the text's first byte: END, all ones
        at = starts + j
        at = at[at < ends]
        seen = before[at] & np.uint32((1 << 8 * j) - 1) if j else np.uint32(0)
        before[at] = seen | np.uint32((1 << 32) - (1 << 8 * j))
    power, inverse = powers(n)
    word = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[data] * power)])[:n]
    begin = np.zeros(n, np.int64)
    after = np.flatnonzero(BLANKS[data[:-1]]) + 1
    begin[after] = after
    begin[starts] = starts
    begin = np.maximum.accumulate(begin)
    word = (word - word[begin]) * inverse[begin]
    del begin
    key = before.astype(np.uint64) << np.uint64(8) | data
    key *= NODE
    key += word
    codes, distinct = pd.factorize(key, size_hint=n // 4)  # a small table stays in the cache
    size = len(distinct)
    del power, inverse, key, distinct
    if shuffle:  # rare events come late in a piece: this, always the same, keeps the mixer's batches alike
        codes = np.random.default_rng(5).permutation(size)[codes]
    at = np.empty(size, np.int64)
    at[codes] = np.arange(n)
    last = before[at].astype(np.uint64)
    return Events(
        [last & np.uint64((1 << 8 * k) - 1) for k in range(1, 5)] + [mix(word[at])], data[at],
        np.bincount(codes, minlength=size) if shuffle else None, codes, starts)


def spans(found: Events, done: int) -> Iterator[Events]:
    """The events of successive spans of a piece, whose bytes follow ``done`` others."""
    a, n = 0, len(found.codes)
    while a < n:
        b = min(n, a + max(FIRST, done + a))
        if b - a == n:
            yield found
            return
        count = np.bincount(found.codes[a:b], minlength=len(found.symbol))
        at = np.flatnonzero(count)
        yield Events([c[at] for c in found.contexts], found.symbol[at], count[at], None, None)
        a = b


@dataclass
class Pairs:
    """The distinct (context, byte) pairs of one order among some events."""

    order: int
    context: np.ndarray  # its part of a slot that no node changes
    path: np.ndarray  # the byte below a leading 1: shifted right, the nodes on its way
    codes: np.ndarray  # pair of every event

    def slots(self, place: int) -> np.ndarray:
        """The slot of every pair's node at a place of the byte."""
        node = self.path >> (place + 1)
        if not self.order:
            return self.context + node
        hashed = self.context + TURNS[node]
        hashed >>= np.uint64(64 - BITS[self.order])
        slot = hashed.view(np.int64)
        slot += BASES[self.order]
        return slot


def ordered(key: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys of so many bits, ascending by key."""
    free = 64 - bits
    if len(key) >> free:
        return np.argsort(key)
    both = key << np.uint64(free) | np.arange(len(key), dtype=np.uint64)
    both.sort()
    both &= np.uint64((1 << free) - 1)
    return both.view(np.int64)


def pairs_of(found: Events) -> list[Pairs]:
    """The pairs of every order: far fewer than events, so slots and counts are looked at once a pair."""
    symbol, last = found.symbol.astype(np.uint64), found.contexts[K - 2]
    # Byte and last four, the latest first: its first k + 1 bytes tell the pairs of k last bytes.
    key = symbol << np.uint64(32) | last.astype(np.uint32).byteswap()
    order = ordered(key, 40)
    key = key[order]
    changed = key[1:] ^ key[:-1]
    cut = np.append(0, np.flatnonzero(changed) + 1)
    codes = np.empty(len(key), np.int64)
    codes[order] = np.repeat(np.arange(len(cut)), np.diff(cut, append=len(key)))
    out = [_pairs(found, K - 2, order[cut], codes)]
    for k in range(K - 3, -1, -1):
        fewer = np.append(True, changed[cut[1:] - 1] >> np.uint64(24 - 8 * k) > 0)
        out.insert(0, _pairs(found, k, order[cut[fewer]], (np.cumsum(fewer) - 1)[codes]))
    codes, distinct = pd.factorize(found.contexts[K - 1] + symbol * NODE)
    first = np.empty(len(distinct), np.int64)
    first[codes] = np.arange(len(codes))
    return [*out, _pairs(found, K - 1, first, codes)]


def _pairs(found: Events, order: int, at: np.ndarray, codes: np.ndarray) -> Pairs:
    context = found.contexts[order][at]
    return Pairs(order, context * SPIN if order else context.astype(np.int64) << 8,
                 found.symbol[at].astype(np.int64) | 256, codes)


def stretch_of(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretched probability of a 1 and confidence level of counts."""
    n = zeros + ones
    value = np.clip(np.log((ones + 0.4) / (zeros + 0.4)), -STRETCH, STRETCH)
    return value.astype(np.float32), np.digitize(n, LEVELS).astype(np.int64)


ONE_HOT = np.eye(SETS, dtype=np.float32)
LOGS = np.log(np.arange(1 << 14) + 0.4).astype(np.float32)
SURE = np.digitize(np.arange(LEVELS[-1] + 1), LEVELS)
HALF = np.uint64(32)
LOW = np.uint64((1 << 32) - 1)


def stretch_of_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretched probabilities of a 1, and both counts, of counts (zeros low, ones high in 64 bits)."""
    zeros, ones = (pairs & LOW).view(np.int64), (pairs >> HALF).view(np.int64)
    last = len(LOGS) - 1
    value = LOGS.take(ones, mode="clip")
    value -= LOGS.take(zeros, mode="clip")
    many = np.flatnonzero((zeros | ones) > last)
    if len(many):
        value[many] = np.log((ones[many] + 0.4) / (zeros[many] + 0.4))
    np.maximum(value, -STRETCH, out=value)
    return np.minimum(value, STRETCH, out=value), zeros, ones


def squash(x: np.ndarray) -> np.ndarray:
    out = np.maximum(x, -20)
    np.minimum(out, 20, out=out)
    np.negative(out, out=out)
    np.exp(out, out=out)
    out += 1
    return np.divide(1, out, out=out)


def bounded(x: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.minimum(np.maximum(x, low), high)


def spread(values: list[np.ndarray], codes: list[np.ndarray], out: np.ndarray) -> None:
    """What the predictors say of one bit, from pairs to events: a line of ``out`` an order."""
    for value, code, line in zip(values, codes, out):
        value.take(code, out=line, mode="clip")


@dataclass
class Mixer:
    """Gated weights, and the map that refines what they give: (bin, node of the tree)."""

    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, K + 1), 0.3) * (
        np.arange(K + 1) < K))
    hits: np.ndarray = field(default_factory=lambda: np.zeros((MAP_BINS, 256, 2)))

    def mixed(self, inputs: np.ndarray, own: np.ndarray, gate: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Weighted sums of the inputs; ``gate`` is one of the weight sets of a place, the columns of ``own``."""
        chosen = own.astype(np.float32).take(gate, axis=1, out=room[:, :len(gate)], mode="clip")
        return np.einsum("kn,kn->n", inputs, chosen)

    def place(self, place: int) -> np.ndarray:
        """The weight sets of a place of the byte."""
        return self.weights[place * SETS:(place + 1) * SETS]

    def seen(self) -> np.ndarray:
        """The map as probabilities of a 1, bins one after another."""
        centre = squash(np.arange(MAP_BINS) * (2 * STRETCH / (MAP_BINS - 1)) - STRETCH)
        return ((self.hits[..., 1] + 4 * centre[:, None]) / (self.hits.sum(axis=2) + 4)).ravel()

    def refined(self, x: np.ndarray, node: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Half the mixed probability, half what bits did where it was about the same."""
        place = bounded(x, -STRETCH, STRETCH)
        place += STRETCH
        place *= (MAP_BINS - 1) / (2 * STRETCH)
        low = np.minimum(place.astype(np.int64), MAP_BINS - 2)
        part = place - low
        low *= 256
        low += node
        near = seen.take(low, mode="clip")
        near *= 1 - part
        low += 256
        part *= seen.take(low, mode="clip")
        near += part
        near *= 0.5
        near += 0.5 * squash(x)
        return bounded(near, 2.0 ** -16, 1 - 2.0 ** -16)

    def learn(self, inputs: np.ndarray, place: int, gate: np.ndarray, path: np.ndarray, count: np.ndarray) -> None:
        """Online: small batches, each predicted before it moves the weights.

        ``path`` is the byte's bits down to this one, below a leading 1.
        """
        n = len(path)
        middle, wanted = np.empty(n, np.float32), (path & 1).astype(np.float32)
        own, room = self.place(place).T.copy("C"), np.empty((K + 1, MINI), np.float32)
        # sums by weight set: a set's place in a one-hot row, and one more line for the counts
        push, chosen = np.empty((K + 2, MINI), np.float32), np.empty((MINI, SETS), np.float32)
        for a in range(0, n, MINI):
            s = slice(a, a + MINI)
            x = self.mixed(inputs[:, s], own, gate[s], room)
            middle[s] = x
            gap = (wanted[s] - squash(x)) * count[s]
            pushed = push[:, :len(x)]
            np.multiply(gap, inputs[:, s], out=pushed[:K + 1])
            pushed[K + 1] = count[s]
            sums = pushed @ ONE_HOT.take(gate[s], axis=0, out=chosen[:len(x)], mode="clip")
            own += RATE * sums[:K + 1] / (sums[K + 1] + PRIOR)
        self.place(place)[:] = own.T
        near = np.rint((bounded(middle, -STRETCH, STRETCH) + STRETCH) * (
            (MAP_BINS - 1) / (2 * STRETCH))).astype(np.int64)
        cell = near * 512 + path
        self.hits += np.bincount(cell, count, self.hits.size).reshape(self.hits.shape)


def gate_of(level: list[np.ndarray], codes: list[np.ndarray]) -> np.ndarray:
    """Weight set of every event's bit among those of its place: the levels of the two longest contexts."""
    last_four, word = level
    return (COARSE * 8)[last_four].take(codes[K - 2], mode="clip") + word.take(codes[K - 1], mode="clip")


def study(counts: np.ndarray, mixer: Mixer, span: Events) -> None:
    """Predict, learn and count the eight binary decisions of every event."""
    orders, weight = pairs_of(span), span.count.astype(np.float32)
    codes, path = [o.codes for o in orders], span.symbol.astype(np.int64) | 256
    amounts = [np.bincount(c, span.count, len(o.path)).astype(np.uint64) for o, c in zip(orders, codes)]
    inputs = np.ones((K + 1, len(path)), np.float32)
    # A bit is counted as soon as it is predicted; later bits lie in other nodes.
    for place in range(7, -1, -1):
        slots = [o.slots(place) for o in orders]
        values, level = [], []
        for k in range(K):
            value, zeros, ones = stretch_of_pairs(counts.take(slots[k], mode="clip"))
            values.append(value)
            if k >= K - 2:
                level.append(SURE.take(zeros + ones, mode="clip"))
        spread(values, codes, inputs)
        mixer.learn(inputs, place, gate_of(level, codes), path >> place, weight)
        for o, slot, amount in zip(orders, slots, amounts):
            bit = (o.path >> place & 1).astype(np.uint64)
            np.add.at(counts, slot, amount << bit * HALF)


PART = pa.schema([("kind", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
WORD_KIND, DOCS, COUNTS, WEIGHTS, HITS = range(5)


def _part(kind: int, key, n, data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), kind)), pa.array(key), pa.array(n), pa.array(data, pa.binary())],
        schema=PART)


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one task learns from its training texts: word counts, slot counts, mixer."""
    counts, mixer, mixed_bytes = np.zeros(SLOTS, np.uint64), Mixer(), 0  # zeros low, ones high
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    docs = held = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        words = np.concatenate([w for w, _ in seen])
        codes, distinct = pd.factorize(words)
        return distinct, np.bincount(codes, np.concatenate([n for _, n in seen])).astype(np.int64)

    for piece in slices(batches, "text", PIECE):
        texts = piece.column("text")
        docs += piece.num_rows
        codes, distinct = pd.factorize(word_hashes(words_of(texts)))
        if len(distinct):
            seen.append((distinct, np.bincount(codes)))
            held += len(distinct)
            if held > MERGE:
                seen = [merged()]
                held = len(seen[0][0])
                if held > MERGE // 2:
                    yield _part(WORD_KIND, seen[0][0].view(np.int64), seen[0][1], [None] * held)
                    seen, held = [], 0
        found = events(texts, shuffle=True)
        for span in spans(found, mixed_bytes):
            mixed_bytes += int(span.count.sum())
            study(counts, mixer, span)
    if not docs:
        return
    if seen:
        words, n = merged()
        yield _part(WORD_KIND, words.view(np.int64), n, [None] * len(words))
    yield _part(DOCS, [0], [docs], [None])
    if mixed_bytes:
        yield _part(WEIGHTS, [0], [mixed_bytes], [mixer.weights.tobytes()])
        yield _part(HITS, [0], [mixed_bytes], [mixer.hits.tobytes()])
    salt = TaskContext.get().partitionId() // 8 % SPREAD
    for block in range(-(-SLOTS // BLOCK)):
        part = counts[block * BLOCK:(block + 1) * BLOCK]
        at = np.flatnonzero(part)
        if len(at):
            pairs = np.stack([part[at] & LOW, part[at] >> HALF], 1)
            yield _part(COUNTS, [block * SPREAD + salt], [len(at)], [packed(at, pairs)])


def packed(at: np.ndarray, pairs: np.ndarray) -> bytes:
    """Places in a block and their two counts, column by column, compressed."""
    return SMALL.compress(at.astype("<u2").tobytes() + pairs.T.astype("<u8").tobytes(), asbytes=True)


def add_counts(table: pa.Table) -> np.ndarray:
    total = np.zeros((BLOCK, 2), np.uint64)
    for n, data in zip(table["n"].to_pylist(), table["data"].to_pylist()):
        raw = SMALL.decompress(data, 18 * n, asbytes=True)
        total[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, "<u8", 2 * n, 2 * n).reshape(2, n).T
    return total


def partial_block(table: pa.Table) -> pa.Table:
    """Sum of a block over the tasks of one salt."""
    total = add_counts(table)
    at = np.flatnonzero(total.any(axis=1))
    data = packed(at, total[at])
    block = table["key"][0].as_py() // SPREAD
    return pa.Table.from_batches([_part(COUNTS, [block], [len(at)], [data])])


def whole_block(table: pa.Table) -> pa.Table:
    """A block of the model: stretched probabilities in 1/2048 and confidence levels."""
    total = add_counts(table).astype(np.float64)
    value, level = stretch_of(total[:, 0], total[:, 1])
    data = np.rint(value * 2048).astype("<i2").tobytes() + level.astype("u1").tobytes()
    return pa.Table.from_batches([_part(COUNTS, [table["key"][0].as_py()], [BLOCK], [data])])


@dataclass
class Model:
    value: np.ndarray  # SLOTS float32
    level: np.ndarray  # SLOTS uint8
    mixer: Mixer

    def log10(self, found: Events) -> np.ndarray:
        """log10 probability of every distinct event."""
        out = np.ones(len(found.symbol))  # eight factors of at least 2**-16 each
        orders, seen = pairs_of(found), self.mixer.seen()
        codes, path = [o.codes for o in orders], found.symbol.astype(np.int64) | 256
        inputs, room = np.ones((K + 1, len(path)), np.float32), np.empty((K + 1, BATCH), np.float32)
        for place in range(7, -1, -1):
            slots, own = [o.slots(place) for o in orders], self.mixer.place(place).T.copy("C")
            level = [self.level.take(s, mode="clip") for s in slots[K - 2:]]
            spread([self.value.take(s, mode="clip") for s in slots], codes, inputs)
            gate = gate_of(level, codes)
            for a in range(0, len(out), BATCH):
                s = slice(a, a + BATCH)
                x = self.mixer.mixed(inputs[:, s], own, gate[s], room)
                p = self.mixer.refined(x, path[s] >> (place + 1), seen)
                out[s] *= np.abs((path[s] >> place & 1 ^ 1) - p)  # p of a 1, 1 - p of a 0
        return np.log10(out)

    def scores(self, column: pa.Array) -> np.ndarray:
        """log10 probability of every text, its end included."""
        found = events(column)
        return np.add.reduceat(self.log10(found)[found.codes], found.starts)


@dataclass
class Learned:
    model: Model
    words: DataFrame  # (word, c): hash and count of every training word
    tokens: int  # N: training words and ends
    distinct: int  # V: distinct of them
    ends: int  # training documents
    heavy: tuple[np.ndarray, np.ndarray]  # hashes, ascending, and counts of frequent words


SCHEMA = "kind long, key long, n long, data binary"


def learn(docs: DataFrame, text: str = "text") -> Learned:
    """The word counts and the mixing model of all texts of ``docs``."""
    parts = stored(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        gather, SCHEMA), "lm-parts")
    words = stored(parts.filter(F.col("kind") == WORD_KIND).groupBy(
        F.col("key").alias("word")).agg(F.sum("n").alias("c")), "lm-words")
    sums = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).head()
    ends = parts.filter(F.col("kind") == DOCS).agg(F.sum("n")).head()[0] or 0
    tokens = (sums.n or 0) + ends
    heavy = words.filter(F.col("c") * HEAVY > tokens).toArrow()  # fewer than HEAVY rows
    order = np.argsort(heavy["word"].to_numpy().view(np.uint64))
    blocks = parts.filter(F.col("kind") == COUNTS).groupBy("key").applyInArrow(
        partial_block, SCHEMA).groupBy("key").applyInArrow(whole_block, SCHEMA)
    value, level = np.zeros(SLOTS + BLOCK, np.float32), np.zeros(SLOTS + BLOCK, np.uint8)
    for row in stored(blocks, "lm-blocks").select("key", "data").toLocalIterator():  # SLOTS x 3 bytes
        at = slice(row.key * BLOCK, (row.key + 1) * BLOCK)
        value[at] = np.frombuffer(row.data, "<i2", BLOCK).astype(np.float32) / 2048
        level[at] = np.frombuffer(row.data, "u1", BLOCK, 2 * BLOCK)
    mixer = Mixer()
    # The mixers of all tasks are averaged in Spark, by weight; only one mixer comes back.
    for kind, shape in ((WEIGHTS, mixer.weights.shape), (HITS, mixer.hits.shape)):
        rows = parts.filter(F.col("kind") == kind).select("key", "n", "data").mapInArrow(
            unpack, "at long, value double, n long").groupBy("at").agg(
            F.sum(F.col("value") * F.col("n")).alias("weighted"), F.sum("value").alias("value"),
            F.sum("n").alias("n")).toArrow()
        if rows.num_rows:
            at = rows["at"].to_numpy()
            found = rows["weighted"].to_numpy() / rows["n"].to_numpy() if kind == WEIGHTS else (
                rows["value"].to_numpy())
            table = (mixer.weights if kind == WEIGHTS else mixer.hits).ravel()
            table[at] = found
            if kind == WEIGHTS:
                mixer.weights = table.reshape(shape)
            else:
                mixer.hits = table.reshape(shape)
    return Learned(
        Model(value[:SLOTS], level[:SLOTS], mixer), words, int(tokens),
        int(sums.v) + (1 if ends else 0), int(ends),
        (heavy["word"].to_numpy().view(np.uint64)[order], heavy["c"].to_numpy()[order]))


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for n, data in zip(b.column("n").to_pylist(), b.column("data").to_pylist()):
            value = np.frombuffer(data)
            at = np.flatnonzero(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(value[at]), pa.array(np.full(len(at), n))],
                names=["at", "value", "n"])


def scored(docs: DataFrame, learned: Learned, doc_id: str = "doc_id", text: str = "text",
           ) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte) a row.

    A null text is an empty one: one token, its end. Repeated rows and ids are
    scored each. Without training text every known count is 0 and the model has no
    opinion. Other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((learned.model, learned.heavy))
    known_end = int(learned.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (heavy, count) = shared.value
        number = TaskContext.get().partitionId() << 33
        for piece in slices(batches, "text", PIECE):
            texts, rows = piece.column("text"), piece.num_rows
            words = words_of(texts)
            hashes, row = word_hashes(words), words.rows
            codes, distinct = pd.factorize(hashes)
            at = np.minimum(np.searchsorted(heavy, distinct), max(len(heavy) - 1, 0))
            hit = heavy[at] == distinct if len(heavy) else np.zeros(len(distinct), bool)
            log = np.where(hit, np.log10((count[at] if len(heavy) else 0) + 1.0), 0.0)
            hit, log = hit[codes], log[codes]
            rest = np.flatnonzero(~hit)
            order = rest[np.lexsort((hashes[rest], row[rest]))]
            tail, owner = hashes[order], row[order]
            first = np.ones(len(order), bool)
            first[1:] = (tail[1:] != tail[:-1]) | (owner[1:] != owner[:-1])
            cut = np.flatnonzero(first)
            times = np.diff(np.append(cut, len(order)))
            ends = np.searchsorted(owner[cut], np.arange(rows + 1)).astype(np.int32)
            _, bounds = utf8(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(number + np.arange(rows)), piece.column("id"),
                pa.array(words.counts + 1),
                pa.array(np.bincount(row[hit], minlength=rows) + known_end),
                pa.array(np.bincount(row, log, rows).astype(np.float64)),  # whole numbers if there is no word
                pa.array(model.scores(texts)), pa.array(np.diff(bounds) + 1),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(tail[cut].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(times)),
            ], names=["row", "id", "n_tokens", "known", "logs", "score", "n_bytes", "tail", "times"])
            number += rows

    rows = stored(docs.select(
        F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"row long, id {dict(docs.dtypes)[doc_id]}, n_tokens long, known long, logs double, "
        "score double, n_bytes long, tail array<long>, times array<long>"), "lm-rows")
    rare = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "row", F.col("t.tail").alias("word"), F.col("t.times").alias("times"))
    found = rare.join(learned.words, "word").groupBy("row").agg(
        F.sum("times").alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    base = F.log10(F.lit(float(learned.tokens + learned.distinct + 1)))
    end = F.log10(F.lit(learned.ends + 1.0))
    return rows.drop("tail", "times").join(found, "row", "left").select(
        F.col("id").alias(doc_id), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(learned.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + end - F.col("n_tokens") * base
         ).alias("base_score"),
        "score", "n_bytes",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
