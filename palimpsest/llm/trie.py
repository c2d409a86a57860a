"""Prefix trie of conversations by van Emde Boas recursion over their depth.

Conversations are rebuilt from narrow rows (id, order, md5 of role and text, words): texts are
hashed and counted where they are read and never shuffled. A turn's place comes from one range
sort over (conversation, turn, md5) and a small table of counts for conversations that cross
ranges, so a conversation that holds a third of all turns is spread over tasks like any other.

The recursion stops at blocks of eight turns, one row each, whose prefixes are named in the row.
Above them every sequence is cut at half its depth: blocks are joined to halves level by level,
then the cuts get names from the top down (the name of a prefix is the XOR of 128 bits of every
turn and its place, so that of a cut is the name of the cut before it XOR the half between them).
All upper tries and lower forests of a level are built by the same job. A prefix's name
is its node: members, smallest member and children are grouped by it.

Totals of subtrees go upward the same way: inside blocks first; then, level by level, the roots of
the lower forests hand their totals to the nodes above them within the upper trie, found on the
path of one member. Every level handles at most half of all prefixes, and as many levels as
the greatest depth has bits.

Two prefixes with one name are taken for one node; with 10**10 prefixes that has a chance
of 10**-19.

Defined cases: rows without a conversation id are left out; null roles and texts are empty;
null turns come first, turns with one number are ordered by the md5 of "length of role:role text";
repeated rows are turns of their own; other columns are not looked at. An empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import WORD, stored

BITS = 3  # a block is 2**BITS turns
CHUNK = 16  # joins on a conversation see at most 2**CHUNK of its turns in one key
IDS = 8_192  # ids that are joined to one text before they are hashed in order


def narrow_turns(table: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    return table.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what)).alias("name"),
        F.regexp_count(what, F.lit(WORD)).cast("long").alias("words"))


def _count_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number each conversation's rows within this range of the sort."""
    task, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        at = []
        for conv in batch.column(0).to_pylist():
            seen = seen + 1 if conv == last else 0
            last = conv
            at.append(seen)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3),
             pa.array([task] * len(at), pa.int32()), pa.array(at, pa.int64())],
            ["conv", "name", "words", "range", "at"])


def placed(turns: DataFrame) -> DataFrame:
    """(conv, name, words, pos): the place of every turn in its conversation, stored."""
    order = ["conv", F.col("turn").asc_nulls_first(), "name", "row"]
    counted = stored(
        turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)
        .sortWithinPartitions(*order).mapInArrow(
            _count_within, "conv long, name string, words long, range int, at long"), "turns")
    # two ranges share one conversation at most, so there are no more such rows than ranges
    parted = counted.groupBy("conv").agg(F.min("range").alias("low"), F.max("range").alias("high")).filter(
        "low < high").select("conv")
    sizes = counted.join(F.broadcast(parted), "conv").groupBy("conv", "range").agg(F.count("*").alias("n"))
    earlier = sizes.alias("a").join(sizes.alias("b"), F.expr("a.conv = b.conv AND b.range < a.range")).groupBy(
        F.col("a.conv").alias("conv"), F.col("a.range").alias("range")).agg(F.sum("b.n").alias("before"))
    return counted.join(F.broadcast(earlier), ["conv", "range"], "left").select(
        "conv", "name", "words", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"))


def rebuilt(turns: DataFrame, group: int, heads: int) -> DataFrame:
    """(conv, pos, name, words): conversation c starts with the first h turns of c - c % group, then
    has its own without its first h; h = crc32(c) % heads. After the last turn of each comes
    a row without a name."""
    taken = F.crc32(F.col("conv").cast("string")) % heads
    first = turns.filter((F.col("pos") < heads - 1) & (F.col("conv") % group == 0)).groupBy(
        F.col("conv").alias("origin")).agg(F.array_sort(F.collect_list(F.struct("pos", "name", "words"))).alias("head"))
    convs = stored(
        turns.groupBy("conv").agg(F.count("*").alias("n")).withColumn(
            "origin", F.col("conv") - F.col("conv") % group).join(first, "origin", "left").select(
            "conv", "n", taken.cast("int").alias("h"),
            F.coalesce(F.slice("head", F.lit(1), taken.cast("int")), F.array().cast(
                "array<struct<pos:bigint,name:string,words:bigint>>")).alias("head")), "conversations")
    # the turns of one conversation meet its row in keys of bounded size
    shifts = convs.select(
        "conv", "h", (F.size("head") - F.col("h")).alias("shift"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n"), CHUNK))).alias("chunk"))
    own = turns.withColumn("chunk", F.shiftright("pos", CHUNK)).join(shifts, ["conv", "chunk"]).filter(
        "pos >= h").select("conv", (F.col("pos") + F.col("shift")).alias("pos"), "name", "words")
    lead = convs.select("conv", F.explode("head").alias("t")).select("conv", "t.pos", "t.name", "t.words")
    end = convs.select(
        "conv", (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("pos"),
        F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("words"))
    return own.unionByName(lead).unionByName(end)


def _both(make) -> list[Column]:
    """The two halves of a name."""
    return [make(x).alias(x) for x in ("a", "b")]


def _xor(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(y)


def _cut_names(blocks: DataFrame) -> DataFrame:
    """(conv, block, a, b): the name of the prefix before each block but the first."""
    whole = lambda x: F.aggregate(
        "items", F.lit(0).cast("long"), lambda s, y: _xor(s, y[x]))
    halves = [stored(blocks.filter(
        (F.size("items") == 2**BITS) & F.forall("items", lambda y: y["a"].isNotNull())).select(
        "conv", "block", *_both(whole)), "halves")]
    levels = (blocks.agg(F.max("block")).first()[0] or 0).bit_length()
    for _ in range(1, levels):
        halves.append(stored(
            halves[-1].groupBy("conv", F.shiftright("block", 1).alias("block")).agg(
                *_both(F.bit_xor), F.count("*").alias("n")).filter("n = 2").drop("n"), "halves"))
    zero = F.lit(0).cast("long")
    cuts = blocks.filter("block = 1").select("conv", zero.alias("block"), *_both(lambda x: zero))
    for level in reversed(range(levels)):
        half = halves[level].select("conv", F.col("block").alias("half"), *[
            F.col(x).alias(f"half_{x}") for x in ("a", "b")])
        found = cuts.withColumn("half", F.shiftright("block", level)).join(half, ["conv", "half"]).select(
            "conv", (F.col("block") + 2**level).alias("block"),
            *_both(lambda x: _xor(F.col(x), F.col(f"half_{x}"))))
        cuts = cuts.unionByName(stored(found, "cuts"))
    return cuts


def paths_of(turns: DataFrame) -> DataFrame:
    """(conv, block, steps): the nodes on every conversation's path, a row for 2**BITS depths, stored.

    A step has its depth, the node's name (a, b), the name after the turn there (null behind the
    last turn) and the turn's words.
    """
    seeds = zip((1, 2), ("a", "b"))
    item = F.struct("pos", "words", *[
        F.when(F.col("name").isNotNull(), F.xxhash64(F.lit(seed), "pos", "name")).alias(x) for seed, x in seeds])
    blocks = stored(
        turns.groupBy("conv", F.shiftright("pos", BITS).alias("block")).agg(
            F.array_sort(F.collect_list(item)).alias("items")), "blocks")
    named = blocks.join(_cut_names(blocks), ["conv", "block"], "left")

    def before(x: str, count: Column) -> Column:
        return F.aggregate(
            F.slice("items", F.lit(1), count), F.coalesce(x, F.lit(0).cast("long")), lambda s, y: _xor(s, y[x]))

    steps = F.transform("items", lambda t, i: F.struct(
        t["pos"].alias("depth"), t["words"].alias("words"), before("a", i).alias("a"), before("b", i).alias("b"),
        F.when(t["a"].isNotNull(), before("a", i + 1)).alias("next_a"),
        F.when(t["a"].isNotNull(), before("b", i + 1)).alias("next_b")))
    return stored(named.select("conv", "block", steps.alias("steps")), "paths")


def nodes_of(paths: DataFrame) -> DataFrame:
    """A row a node: name, name of its parent, depth, smallest member, members, children, what is
    saved on its own; stored."""
    step = paths.select("conv", F.explode("steps").alias("s"))
    grown = step.filter("s.next_a IS NOT NULL").groupBy("s.next_a", "s.next_b").agg(
        F.max("s.a").alias("up_a"), F.max("s.b").alias("up_b"), (F.max("s.depth") + 1).alias("depth"),
        F.min("conv").alias("conv"), F.count("*").alias("members"), F.max("s.words").alias("words"),
    ).withColumnsRenamed({"next_a": "a", "next_b": "b"})
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = step.filter("s.next_a IS NULL").agg(F.min("conv").alias("conv"), F.count("*").alias("members")).filter(
        "members > 0").select(
        zero.alias("a"), zero.alias("b"), none.alias("up_a"), none.alias("up_b"), zero.alias("depth"),
        "conv", "members", zero.alias("words"))
    nodes = stored(grown.unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(
        F.count("*").alias("children"))
    return stored(nodes.join(children, ["a", "b"], "left").select(
        "a", "b", "up_a", "up_b", "depth", "conv", "members", F.coalesce("children", zero).alias("children"),
        ((F.col("members") - 1) * F.col("words")).alias("saved")), "nodes")


def _handed(down: DataFrame) -> DataFrame:
    """Totals (leaves, saved) of rows (conv, leaves, saved, s) by the step s they are handed to."""
    return stored(down.groupBy("s.a", "s.b").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("s.depth").alias("depth"),
        F.min("conv").alias("conv")), "totals")


def subtree_totals(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(a, b, leaves, saved) of every node, summed over its subtree."""
    own = nodes.select(
        "conv", F.shiftright("depth", BITS).alias("block"), "depth", "saved",
        (F.col("children") == 0).cast("long").alias("leaves"))
    within = (F.col("depth") % 2**BITS + 1).cast("int")
    totals = _handed(own.join(paths, ["conv", "block"]).select(
        "conv", "leaves", "saved", F.explode(F.slice("steps", F.lit(1), within)).alias("s")))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for level in range(BITS, deepest.bit_length()):
        size = min(level, CHUNK)
        forest = F.shiftright("depth", level)  # odd: a lower one, whose upper trie is the one before it
        roots = totals.filter((F.col("depth") % 2**level == 0) & (forest % 2 == 1)).groupBy("a", "b").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("depth").alias("depth"),
            F.min("conv").alias("conv"))
        low = F.shiftleft(forest - 1, level - size)
        reach = roots.select("conv", "leaves", "saved", F.explode(
            F.sequence(low, low + 2 ** (level - size) - 1)).alias("chunk"))
        upper = paths.withColumn("chunk", F.shiftright("block", size - BITS))
        totals = totals.unionByName(_handed(reach.join(upper, ["conv", "chunk"]).select(
            "conv", "leaves", "saved", F.explode("steps").alias("s"))))
    return totals.groupBy("a", "b").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as texts of at most ``IDS`` ids."""
    node, ids = None, []

    def run() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"a": node[0], "b": node[1], "first": ids[0], "ids": ",".join(map(str, ids))}])

    for batch in batches:
        for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if ids and (node != (a, b) or len(ids) == IDS):
                yield run()
                ids = []
            node = a, b
            ids.append(conv)
    if ids:
        yield run()


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's texts in their order, one text in memory at a time."""
    node = digest = None

    def done() -> dict:
        return {"a": node[0], "b": node[1], "ends_sha256": digest.hexdigest()}

    for batch in batches:
        out = []
        for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node == (a, b):
                digest.update(b",")
            else:
                if node:
                    out.append(done())
                node, digest = (a, b), hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist(out)
    if node:
        yield pa.RecordBatch.from_pylist([done()])


def ends_digests(paths: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the hash of the ids that end at a node, ascending, joined by commas.

    Ids of one node are joined to texts of ``IDS`` of them in as many tasks as they fill; only
    the hash itself, which has an order, runs over a node's texts in one task, as a stream.
    """
    ends = paths.select("conv", F.explode("steps").alias("s")).filter("s.next_a IS NULL").select("s.a", "s.b", "conv")
    texts = ends.repartitionByRange("a", "b", "conv").sortWithinPartitions("a", "b", "conv").mapInArrow(
        _join_ids, "a long, b long, first long, ids string")
    return texts.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(
        _hash_ids, "a long, b long, ends_sha256 string")


def conversation_trie(
    table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    group: int = 20, heads: int = 4,
) -> DataFrame:
    """A row for every distinct prefix of the rebuilt conversations (see the module's text)."""
    turns = placed(narrow_turns(table, conv, turn, role, text))
    paths = paths_of(rebuilt(turns, group, heads))
    nodes = nodes_of(paths)
    parents = nodes.select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv").alias("parent_conv_id"))
    return nodes.drop("saved").join(subtree_totals(nodes, paths), ["a", "b"]).join(
        ends_digests(paths), ["a", "b"], "left").join(parents, ["up_a", "up_b"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
