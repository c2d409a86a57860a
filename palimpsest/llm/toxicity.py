"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Token labels come from labelled documents: a token of a toxic document is labelled
toxic if its word or one of its prefixes occurs in toxic documents far more often
than in clean ones. A two-state chain over the words of each line, with hashed
word and prefix features, is fitted on a bounded sample of labelled documents.
Forward-backward marginals then tag every word of every document; their expected
number gives the document score, the likely ones the offending spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import Words, mix, slices, stored, word_hashes, words_of

SAMPLE = 3_000  # labelled documents of each kind that the chain is fitted on, at most
SLOTS = 1 << 20
KINDS = 4  # features of a word: itself and its first four, five and seven bytes
LEAST, ODDS, CANDIDATES = 5, 3.0, 1e6  # contexts at least, log odds, features that may occur by chance
SPAN = 0.5  # marginal from which a word belongs to a span
EPOCHS, BATCH, RATE, DECAY = 2, 64, 0.3, 1e-6
PREFIXES = [np.uint64((1 << 8 * k) - 1) for k in (4, 5, 7)]


def features(words: Words) -> np.ndarray:
    """(words x KINDS) feature slots; a short word is its own prefix."""
    starts, ends = words.starts, words.ends
    data = np.concatenate([words.data, np.zeros(8, np.uint8)])
    head = np.zeros(len(starts), np.uint64)
    for k in range(7):
        byte = np.where(starts + k < ends, data[starts + k], 0).astype(np.uint64)
        head |= byte << np.uint64(8 * k)
    hashed = [word_hashes(words), *(mix(head & m) for m in PREFIXES)]
    salt = np.arange(1, KINDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    return np.stack([(mix(h ^ s) % np.uint64(SLOTS)).astype(np.int64)
                     for h, s in zip(hashed, salt)], axis=1)


def chains(words: Words) -> np.ndarray:
    """Bounds of the chains: the words of one line of one text."""
    lines = np.cumsum(words.data == 10) if len(words.data) else np.zeros(0, np.int64)
    line = lines[words.starts] if len(words.starts) else lines
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    first = words.bounds[:-1][words.counts > 0]
    new[first] = True
    return np.append(np.flatnonzero(new), len(line))


@dataclass
class Chain:
    """Weights: of features towards toxic and of the four transitions; chains start as if
    after a clean word."""

    weights: np.ndarray
    moves: np.ndarray  # log potentials [from, to]

    def lift(self, slots: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(self.weights[slots].sum(axis=1, dtype=np.float64), -30, 30))

    def marginals(self, slots: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of every word and P(both toxic) of every neighbour pair (at its second word).

        All chains go forward and backward in step, longest first, with scaled messages.
        """
        lift, n = self.lift(slots), len(slots)
        move = np.exp(self.moves)
        length = np.diff(bounds)
        order = np.argsort(-length, kind="stable")
        start, length = bounds[:-1][order], length[order]
        ahead, behind = np.empty((2, n)), np.empty((2, n))
        active = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
        for t, m in enumerate(active):
            at = start[:m] + t
            if t:
                x, y = ahead[0, at - 1], ahead[1, at - 1]
                a, b = x * move[0, 0] + y * move[1, 0], (x * move[0, 1] + y * move[1, 1]) * lift[at]
            else:
                a, b = np.full(m, move[0, 0]), move[0, 1] * lift[at]
            total = a + b
            ahead[0, at], ahead[1, at] = a / total, b / total
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            at = start[:m] + t
            more = active[t + 1] if t + 1 < len(active) else 0
            behind[:, at[more:]] = 0.5
            if more:
                on = at[:more] + 1
                x, y = behind[0, on], behind[1, on] * lift[on]
                a, b = x * move[0, 0] + y * move[0, 1], x * move[1, 0] + y * move[1, 1]
                total = a + b
                behind[0, at[:more]], behind[1, at[:more]] = a / total, b / total
        both = ahead * behind
        single = both[1] / both.sum(axis=0)
        pair = np.zeros(n)
        if n > 1:
            inner = np.ones(n, bool)
            inner[bounds[:-1]] = False
            at = np.flatnonzero(inner)
            cell = [[ahead[i, at - 1] * move[i, j] * behind[j, at] * (lift[at] if j else 1.0)
                     for j in (0, 1)] for i in (0, 1)]
            pair[at] = cell[1][1] / (cell[0][0] + cell[0][1] + cell[1][0] + cell[1][1])
        return single, pair


def toxic_features(sample: DataFrame) -> np.ndarray:
    """Slots of the features that mark toxic documents.

    A feature needs the log odds of toxic against clean documents, and to occur between
    more pairs of neighbouring words than chance gives any of CANDIDATES features:
    copies of a document add no such pairs.
    """
    sizes = sample.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).head()
    bad, clean = float(sizes.bad or 0), float(sizes.n - (sizes.bad or 0))
    if not bad or not clean:
        return np.zeros(0, np.int64)
    support = max(LEAST, int(np.ceil(np.log(CANDIDATES) / -np.log(bad / (bad + clean)))))

    def in_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words = words_of(piece.column("text"))
            slots = np.unique(np.repeat(words.rows, KINDS) * SLOTS + features(words).ravel())
            number, n = np.unique(slots % SLOTS, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(n)], names=["slot", "n"])

    found = sample.filter("toxic = 0").mapInArrow(in_clean, "slot long, n long").groupBy(
        "slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS numbers
    usual = np.zeros(SLOTS)
    usual[found["slot"].to_numpy()] = found["n"].to_numpy()
    most = np.exp(-ODDS) * (clean + 1)

    def in_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            words = words_of(piece.column("text"))
            if not len(words.starts):
                continue
            slots, hashes = features(words), word_hashes(words)
            around = mix(np.roll(hashes, 1) + mix(np.roll(hashes, -1))).view(np.int64)
            rare = usual[slots] < most
            row, slot = np.repeat(words.rows, rare.sum(axis=1)), slots[rare]
            new = np.zeros(len(slot), np.int64)
            new[np.unique(row * SLOTS + slot, return_index=True)[1]] = 1
            pairs, at = np.unique(np.stack([
                slot, np.repeat(around, rare.sum(axis=1))], axis=1), axis=0, return_inverse=True)
            docs = np.bincount(at.ravel(), new, minlength=len(pairs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(docs)],
                names=["slot", "around", "docs"])

    often = sample.filter("toxic = 1").mapInArrow(
        in_toxic, "slot long, around long, docs long").groupBy("slot", "around").agg(
        F.sum("docs").alias("docs")).groupBy("slot").agg(
        F.count("*").alias("contexts"), F.sum("docs").alias("docs")).filter(
        F.col("contexts") >= support).toArrow()
    slot, docs = often["slot"].to_numpy(), often["docs"].to_numpy()
    odds = np.log((docs + 0.5) / (bad + 1)) - np.log((usual[slot] + 0.5) / (clean + 1))
    return np.sort(slot[odds >= ODDS])


def fit_chain(texts: pa.Array, toxic: np.ndarray, marked: np.ndarray) -> Chain:
    """Stochastic gradient ascent on the likelihood of the token labels."""
    known = np.zeros(SLOTS, bool)
    known[marked] = True
    chain = Chain(np.zeros(SLOTS, np.float32), np.zeros((2, 2)))
    chain.moves[0, 1] = -4.0
    squares, move_squares = np.full(SLOTS, 1e-6, np.float32), np.full((2, 2), 1e-6)
    for epoch in range(EPOCHS):
        for a in range(0, len(texts), BATCH):
            words = words_of(texts.slice(a, BATCH))
            if not len(words.starts):
                continue
            slots, bounds = features(words), chains(words)
            label = known[slots].any(axis=1) & (toxic[a:a + BATCH][words.rows] == 1)
            single, pair = chain.marginals(slots, bounds)
            gap = label - single
            used, at = np.unique(slots, return_inverse=True)
            step = np.bincount(at.ravel(), np.repeat(gap, KINDS)) - DECAY * chain.weights[used]
            squares[used] += step ** 2
            chain.weights[used] += RATE * step / np.sqrt(squares[used])
            inner = np.ones(len(label), bool)
            inner[bounds[:-1]] = False
            on = np.flatnonzero(inner)
            x, y, seen = label[on - 1], label[on], pair[on]
            real = np.array([[(~x & ~y).sum(), (~x & y).sum()], [(x & ~y).sum(), (x & y).sum()]], float)
            p, q = single[on - 1], single[on]
            guess = np.array([[(1 - p - q + seen).sum(), (q - seen).sum()],
                              [(p - seen).sum(), seen.sum()]])
            first = bounds[:-1][np.diff(bounds) > 0]
            real[0] += [(~label[first]).sum(), label[first].sum()]
            guess[0] += [(1 - single[first]).sum(), single[first].sum()]
            step = real - guess
            move_squares += step ** 2
            chain.moves += RATE * step / np.sqrt(move_squares)
    return chain


def evidence(chain: Chain, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all words, and per text the log of the sum of their squares: close to
    the expected number of toxic words, but free of the small marginals of a long text."""
    if not len(words.starts):
        return np.zeros(0), np.full(len(words.bounds) - 1, np.log(1e-3))
    single, _ = chain.marginals(features(words), chains(words))
    total = np.concatenate([[0.0], np.cumsum(single ** 2)])
    return single, np.log(1e-3 + np.maximum(total[words.bounds[1:]] - total[words.bounds[:-1]], 0))


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept of a ridge-penalised logistic regression, by Newton steps."""
    design, beta = np.stack([x, np.ones(len(x))], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 1e-2 * beta
        curve = (design.T * (p * (1 - p))) @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return beta


def sampled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Texts and labels of at most ``limit`` labelled documents of each kind.

    The ids, at most twice ``limit``, go to all tasks, so the texts are not shuffled."""
    one = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("long").alias("toxic"))
    some = [one.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
            for kind in (0, 1)]
    return stored(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(stored(some[0].union(some[1]), "toxic-ids")), "doc_id"), "toxic-sample")


@dataclass
class Model:
    chain: Chain
    beta: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """The chain and the calibration, from documents whose ``labels`` (doc_id, toxic) are given.

    Fitting is one task over the bounded sample; only weights come back. Without a labelled
    document every score is 0.5."""
    sample = sampled(docs, labels, limit)
    marked = toxic_features(sample)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        texts = table.column("text").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        order = np.argsort(mix(table.column("place").to_numpy().view(np.uint64)), kind="stable")
        texts = texts.take(pa.array(order))
        toxic = table.column("toxic").to_numpy()[order]
        chain = fit_chain(texts, toxic, marked)
        x = np.concatenate([evidence(chain, words_of(texts.slice(a, BATCH)))[1]
                            for a in range(0, len(texts), BATCH)])
        beta = calibrate(x, toxic.astype(float))
        used = np.flatnonzero(np.abs(chain.weights) > 1e-4)
        slot = np.concatenate([np.arange(-6, 0), used])
        value = np.concatenate([chain.moves.ravel(), beta, chain.weights[used]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(value.astype(np.float64))], names=["slot", "value"])

    rows = sample.select(F.xxhash64("doc_id").alias("place"), "text", "toxic").coalesce(1).mapInArrow(
        learn, "slot long, value double").toArrow()  # at most SLOTS + 6 numbers
    slot, value = rows["slot"].to_numpy(), rows["value"].to_numpy()
    head = dict(zip(slot[slot < 0].tolist(), value[slot < 0].tolist()))
    weights = np.zeros(SLOTS, np.float32)
    weights[slot[slot >= 0]] = value[slot >= 0]
    moves = np.array([head.get(k, 0.0) for k in (-6, -5, -4, -3)]).reshape(2, 2)
    return Model(Chain(weights, moves), np.array([head.get(-2, 0.0), head.get(-1, 0.0)]))


SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))


def spans_of(words: Words, single: np.ndarray, shift: np.ndarray) -> list[list[dict]]:
    """Runs of likely words of each text, as character offsets into it."""
    out: list[list[dict]] = [[] for _ in range(len(words.bounds) - 1)]
    hot = np.flatnonzero(single >= SPAN)
    if not len(hot):
        return out
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    for i, row in zip(hot, np.searchsorted(words.bounds, hot, "right") - 1):
        begin = int(chars[words.starts[i]] - chars[shift[row]])
        end, found = int(chars[words.ends[i]] - chars[shift[row]]), out[row]
        if found and found[-1]["last"] == i - 1:
            found[-1].update(end=end, last=i, marginal=max(found[-1]["marginal"], float(single[i])))
        else:
            found.append({"begin": begin, "end": end, "marginal": float(single[i]), "last": i})
    return [[{k: s[k] for k in ("begin", "end", "marginal")} for s in x] for x in out]


def scored(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Every row of ``docs`` with ``score``, ``predicted``, ``n_toxic_words``, ``spans``.

    The text column is read whole and left out. A null or empty text has no words and
    gets the score of no evidence. Repeated rows get the same score. Spans are
    (begin, end, marginal) in characters. Columns named like the new ones are
    replaced; others pass through. An empty table gives no rows.
    """
    new = ["score", "predicted", "n_toxic_words", "spans"]
    kept = [c for c in docs.columns if c.lower() not in (*new, text.lower())]
    types = dict(docs.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, beta = shared.value.chain, shared.value.beta
        for piece in slices(batches, text):
            words = words_of(piece.column(text))
            single, x = evidence(chain, words)
            ends = piece.column(text).cast(pa.large_string()).fill_null("")
            size = np.array([len(t.as_buffer()) for t in ends], np.int64)
            shift = np.cumsum(size) - size
            score = 1 / (1 + np.exp(-np.clip(beta[0] * x + beta[1], -30, 30)))
            likely = np.concatenate([[0], np.cumsum(single >= SPAN)])
            count = likely[words.bounds[1:]] - likely[words.bounds[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in kept), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32)), pa.array(count.astype(np.int64)),
                 pa.array(spans_of(words, single, shift), SPANS)], names=[*kept, *new])

    schema = "".join(f"`{c}` {types[c]}, " for c in kept) + (
        "score double, predicted int, n_toxic_words long, "
        "spans array<struct<begin:bigint,end:bigint,marginal:double>>")
    return docs.select(*kept, text).mapInArrow(run, schema)
