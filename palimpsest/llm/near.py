"""Near-duplicate documents by one-permutation MinHash.

One hash of every shingle is dealt to BANDS x ROWS bins, whose minima are the
signature; an empty bin borrows from a bin that its own probe sequence finds
(optimal densification). Equal bands put documents into a bucket, and a bucket
emits a star, not all pairs: its members against one hub. Links are confirmed on
the full sets. Buckets whose members do not all end up in one component go on
with further hubs, those with most links first, until no two members of
different components are untested, so nothing that shares a bucket is lost; an
exact bound from odd sketches drops most pairs of them before their texts meet.
Exact copies are one class from the start and never meet in pairs.

The chance that a pair at the threshold shares no bucket is about 2e-7 at 0.85
(40 bands of 7) and 1e-8 at 0.8 (60 bands of 6).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import (
    IdFilter, mix, new_name, numbers, slices, sorted_sets, stored, windows, word_hashes, words_of)
from palimpsest.llm.components import components

PERCENT = 85  # of the union: the contract of op8
CLEAN = 80  # of the union: what a clean corpus holds once
BANDING = [(85, 40, 7), (80, 60, 6)]  # least percentage, bands, rows of a band
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
ODD = 16  # longs of a set's odd sketch


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(texts)
    return sorted_sets(*windows(word_hashes(words), words.bounds))


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows) that practically never miss a pair of ``percent``."""
    for least, bands, rows in BANDING:
        if percent >= least:
            return bands, rows
    raise ValueError(f"no bands for a similarity of {percent} percent")


def signatures(values: np.ndarray, ends: np.ndarray, n: int = 280) -> np.ndarray:
    """(texts x n) bin minima; ``values`` ascend within a text, and so do their bins."""
    rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    bins = ((values >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    at = rows * n + bins
    first = np.flatnonzero(np.diff(at, prepend=-1))
    table = np.full((len(ends) - 1) * n, EMPTY)
    table[at[first]] = values[first]
    filled = np.zeros(len(table), bool)
    filled[at[first]] = True
    has = np.repeat(np.diff(ends) > 0, n)
    empty, attempt = np.flatnonzero(~filled & has), 0
    while len(empty):
        attempt += 1
        row, own = np.divmod(empty, n)
        probe = mix(own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        source = row * n + (probe % np.uint64(n)).astype(np.int64)
        found = filled[source]
        table[empty[found]] = table[source[found]]
        empty = empty[~found]
    return table.reshape(-1, n)


def band_keys(table: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = table.reshape(len(table), bands, rows) * numbers(rows, 41)
    return mix(parts.sum(axis=2, dtype=np.uint64) + numbers(bands, 43)).view(np.int64)


def odd_sketches(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(texts x ODD) parities of how many shingles fall on each bit.

    Where two sketches differ in d bits, the sets differ in at least d shingles, since
    what they share cancels: an exact bound, sharp while d is small against the bits.
    """
    rows = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    slot = (values % np.uint64(64 * ODD)).astype(np.int64)
    odd = np.bincount(rows * 64 * ODD + slot, minlength=(len(ends) - 1) * 64 * ODD) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, 64), axis=1).view(np.int64).reshape(-1, ODD)


def sketch(batches: Iterator[pa.RecordBatch], bands: int, size: int) -> Iterator[pa.RecordBatch]:
    """(id, n, digest, bands, odd) of (id, text) rows."""
    for piece in slices(batches, "text", rows=2_000):
        values, ends = shingle_sets(piece.column("text"))
        keys = band_keys(signatures(values, ends, bands * size), bands, size)
        digests = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest()
                   for a, b in zip(ends[:-1], ends[1:])]
        lists = lambda table, n: pa.ListArray.from_arrays(
            pa.array(np.arange(len(table) + 1, dtype=np.int32) * n), pa.array(table.ravel()))
        yield pa.RecordBatch.from_arrays(
            [piece.column("id"), pa.array(np.diff(ends), pa.int64()),
             pa.array(digests, pa.binary()), lists(keys, bands),
             lists(odd_sketches(values, ends), ODD)], names=["id", "n", "digest", "bands", "odd"])


def overlap(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, linked) of pairs with their texts: the test on the full sets."""
    for piece in slices(batches, "text_a", limit=1_000_000):
        left, at = shingle_sets(piece.column("text_a"))
        right, to = shingle_sets(piece.column("text_b"))
        both = np.array([
            len(np.intersect1d(left[at[i]:at[i + 1]], right[to[i]:to[i + 1]], assume_unique=True))
            for i in range(piece.num_rows)])
        linked = both * 100 >= (np.diff(at) + np.diff(to) - both) * percent
        yield pa.RecordBatch.from_arrays(
            [piece.column("a"), piece.column("b"), pa.array(linked)], names=["a", "b", "linked"])


def sizes_fit(x: str, y: str, percent: int) -> Column:
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def can_link(x: str, n_x: str, y: str, n_y: str, percent: int) -> Column:
    """Whether the odd sketches allow the similarity: of S shingles in both sets together,
    at most (1 - j) / (1 + j) may differ."""
    differ = sum(
        (F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(ODD)), F.lit(0))
    return differ * (100 + percent) <= (F.col(n_x) + F.col(n_y)) * (100 - percent)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b), each tested on the full sets of its texts: (a, b, linked)."""
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "text_a", "text_b").mapInArrow(
        lambda batches: overlap(batches, percent), "a long, b long, linked boolean")


def star_labels(
    members: DataFrame, texts: DataFrame, odd: DataFrame, given: DataFrame, percent: int,
) -> DataFrame:
    """Components of the documents of buckets; ``members`` is (key, id, n, hub, hub_n)
    and ``given`` links (a, b) that hold anyway.

    First every document meets the hub it shares most buckets with. Then, in every
    bucket that still spans several components, members in order of links become
    hubs for the members of other components after them, in rounds of more and more
    hubs. Pairs that differ too much by their odd sketches (id, n, odd) are no candidates.
    """
    first = members.filter(F.col("id") != F.col("hub")).filter(sizes_fit("n", "hub_n", percent)).groupBy(
        "id", "n", "hub", "hub_n").count().groupBy("id", "n").agg(
        F.max(F.struct("count", (-F.col("hub")).alias("hub"), "hub_n")).alias("best"))
    pairs = first.select(
        (-F.col("best.hub")).alias("a"), F.col("id").alias("b"))
    tested = stored(confirmed(pairs, texts, percent), "near-tested")
    links = tested.filter("linked").select("a", "b").union(given)
    labels = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(
        F.count("*").alias("degree"))
    with_label = lambda df, labels: df.join(labels, "id", "left").withColumn(
        "comp", F.coalesce("comp", "id"))

    def open_ones(df: DataFrame, labels: DataFrame) -> DataFrame:
        """Members of the buckets that span several components."""
        now = with_label(df, labels)
        several = now.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter(
            "x != y").select("key")
        return now.join(several, "key")

    order = Window.partitionBy("key").orderBy(F.desc_nulls_last("degree"), "id")
    left = stored(open_ones(members.select("key", "id", "n"), labels).join(
        degree, "id", "left").withColumn("rank", F.row_number().over(order)).drop(
        "comp", "degree").join(odd, ["id", "n"]), "near-open")
    low, high = 0, 1
    while True:
        now = stored(open_ones(left, labels), "near-open")
        hubs = now.filter((F.col("rank") > low) & (F.col("rank") <= high)).select(
            "key", F.col("id").alias("hub"), F.col("n").alias("hub_n"),
            F.col("comp").alias("hub_comp"), F.col("rank").alias("hub_rank"),
            F.col("odd").alias("hub_odd"))
        if now.filter(F.col("rank") > low + 1).isEmpty():
            return labels
        pairs = now.join(hubs, "key").filter(
            (F.col("rank") > F.col("hub_rank")) & (F.col("comp") != F.col("hub_comp"))
            & sizes_fit("n", "hub_n", percent)
            & can_link("odd", "n", "hub_odd", "hub_n", percent)).select(
            F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"),
        ).distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        more = stored(confirmed(pairs, texts, percent), "near-tested")
        tested, left = tested.unionByName(more), now.drop("comp")
        if not more.filter("linked").isEmpty():
            links = links.unionByName(more.filter("linked").select("a", "b"))
            labels = components(links)
        low, high = high, 2 if high == 1 else 8 * high


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; documents whose
    shingles share at least ``percent`` (80 or more) of their union are linked.

    Words are lower-cased (A-Z); a text of fewer than five words is one shingle,
    and one without words, empty or null, links with nothing. Documents with the
    same set are one class. Rows with a null id take no part: their component is
    null and they are kept. Rows that repeat an id are one document that has all
    their texts. Ties go to the smallest id. Other columns are not read. An
    empty table gives no rows.
    """
    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    bands, size = banding(percent)
    rows = stored(given.mapInArrow(
        lambda batches: sketch(batches, bands, size), "id long, n long, digest binary, bands array<long>, odd array<long>"), "near-sketches")
    linked = rows.filter("n > 0 and id is not null")
    classes = stored(linked.groupBy("digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("rows")), "near-classes")
    reps = linked.join(classes.select("digest", F.col("rep").alias("id")), ["digest", "id"])
    banded = reps.select(F.explode("bands").alias("key"), "id", "n")
    heads = banded.groupBy("key").agg(
        F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("last")).filter(
        F.col("head.id") < F.col("last"))
    members = stored(banded.join(heads, "key").select(
        "key", "id", "n", F.col("head.id").alias("hub"), F.col("head.n").alias("hub_n")).distinct(),
        "near-buckets")
    wanted = members.select("id").distinct()
    wanted = stored(wanted, "near-wanted")
    texts = stored(IdFilter(wanted).split(given, "id", True).join(wanted, "id", "left_semi"), "near-texts")
    repeated = linked.groupBy("id").count().filter("count > 1").select("id")
    again = linked.join(repeated, "id").join(classes, "digest").select(
        F.col("id").alias("a"), F.col("rep").alias("b")).filter("a != b").distinct()
    labels = star_labels(members, texts, reps.select("id", "n", "odd"), again, percent)
    several = classes.filter("rows > 1").select("digest", "rep")
    named = rows.select("id", "n", "digest").join(several, "digest", "left").withColumn(
        "rep", F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("rep", "id")))
    comp = F.when(F.col("id").isNotNull(), F.coalesce("comp", "rep"))
    return named.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), comp.alias("component_id"),
        F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                percent: int = CLEAN) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the document with the smallest
    id, of rows that repeat its id one (the smallest text); rows with a null id stay."""
    found = stored(near_duplicates(docs, doc_id, text, percent), "near-found")
    gone = stored(found.filter(~F.col("kept")).select(doc_id).distinct(), "near-gone")
    some = IdFilter(gone)  # only texts that may go are shuffled
    stay = some.split(docs, doc_id, False).unionByName(
        some.split(docs, doc_id, True).join(gone, doc_id, "left_anti").select(docs.columns))
    repeated = stored(found.filter("kept").groupBy(doc_id).count().filter(
        (F.col("count") > 1) & F.col(doc_id).isNotNull()).select(doc_id), "near-repeated")
    if repeated.isEmpty():
        return stay.select(docs.columns)
    run, place = Window.partitionBy(doc_id).orderBy(text), new_name(docs)
    single = docs.join(repeated, doc_id, "left_semi").join(gone, doc_id, "left_anti").withColumn(
        place, F.row_number().over(run)).filter(F.col(place) == 1)
    return stay.join(repeated, doc_id, "left_anti").select(docs.columns).union(
        single.select(docs.columns))
