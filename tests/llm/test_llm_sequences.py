"""Vector codes, the prefix trie and SentencePiece against brute force and the library."""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import llm_fixtures as X  # noqa: E402
from palimpsest.llm import codes, pieces, trie  # noqa: E402
from palimpsest.llm.queries import QUERIES  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# ---- vector codes

def nearest(entries, part):
    return min((sum((a - b) ** 2 for a, b in zip(e, part)), n) for n, e in enumerate(entries))


@pytest.mark.parametrize("size, dims, spread", [(1, 3, 50), (16, 8, 1_000), (64, 2, 6), (7, 1, 9), (16, 5, 2**26)])
def test_sliced_masks_find_the_nearest_entry(size, dims, spread):
    rng = np.random.default_rng(size)
    entries = rng.integers(-spread, spread + 1, (size, dims))
    entries[-1] = entries[0]  # a tie, always
    parts = rng.integers(-3 * spread, 3 * spread + 1, (500, dims))
    index, away = codes.Slices(entries).nearest(parts)
    want = [nearest(entries.tolist(), p) for p in parts.tolist()]
    assert list(zip(away.tolist(), index.tolist())) == want


def test_candidates_are_the_entries_within_the_radius_in_every_dimension():
    rng = np.random.default_rng(5)
    entries, parts = rng.integers(-20, 20, (40, 3)), rng.integers(-20, 20, (100, 3))
    words = codes.Slices(entries).candidates(parts, np.full(100, 7))
    for part, word in zip(parts, words):
        assert [n for n in range(64) if int(word) >> n & 1] == [
            n for n, e in enumerate(entries) if (abs(e - part) <= 7).all()]


def coded_by_hand(rows, parts=8, size=16, rounds=6):
    rows = sorted((r for r in rows if r[1] is not None and all(
        x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(-(-max(len(r[1]) for r in rows) // parts), 1)
    cut = lambda v: [
        [math.floor(4096 * x) for x in (v + [0.0] * (width * parts))[p * width:(p + 1) * width]] for p in range(parts)]
    vectors = [cut(r[1]) for r in rows]
    books = [[v[p] for v in vectors[:size]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            mine = {}
            for v in vectors:
                mine.setdefault(nearest(books[p], v[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(mine[n]) for c in zip(*mine[n])] if n in mine else e
                        for n, e in enumerate(books[p])]
    out = []
    for r, v in zip(rows, vectors):
        best = [nearest(books[p], v[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best), r[2]))
    sums = {}
    for _, _, error, label in out:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=repr)


def codes_query(spark, rows, folder):
    table = spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label int, id string, vector int, codes int, place int, __label int")
    table.write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return QUERIES["op11_vector_codes"](spark, str(folder))


def test_codes_of_awkward_vectors(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 16).astype(np.float32).tolist(), i % 3 or None) for i in range(40)]
    rows += [
        (3, rows[3][1], 0), (5, [0.5] * 16, 1), (None, [0.25] * 16, 1), (None, [0.25] * 16, None), (50, None, 1),
        (51, [math.nan] + [0.0] * 15, 1), (52, [math.inf] * 16, 1), (53, [None] + [0.0] * 15, 1),
        (54, [], 2), (55, [-0.00001] * 3, 2), (56, [900.0] * 16, 2), (57, [-900.0] * 16, 2)]
    got = codes_query(spark, [(*r, "x", 1, 2, 3, 4) for r in rows], tmp_path).collect()
    want = coded_by_hand(rows)
    assert sorted(map(tuple, (
        (r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got)), key=repr) == want
    few = codes_query(spark, [(*r, "x", 1, 2, 3, 4) for r in rows[:3]], tmp_path).collect()
    assert sorted(map(tuple, few), key=repr) == coded_by_hand(rows[:3])


def test_codes_of_no_and_of_huge_vectors(spark, tmp_path):
    out = codes_query(spark, [], tmp_path)
    assert out.collect() == [] and [t for _, t in out.dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
    assert codes_query(spark, [(1, None, 1, "x", 1, 2, 3, 4)], tmp_path).collect() == []
    rows = [(n, [x] * 8, 1, "x", 1, 2, 3, 4) for n, x in enumerate([3e38, -3e38, 1.0, 2.0])]
    assert len(codes_query(spark, rows, tmp_path).collect()) == 4


def test_codebooks_decode_to_the_entries(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    coded, books = codes.compressed(table)
    rows = coded.join(table.select("vec_id", "embedding"), "vec_id").collect()
    back = books.decoded(np.array([r.codes for r in rows]))
    exact = np.floor(np.array([r.embedding for r in rows], np.float64) * 4096)
    assert ((exact - back * 4096) ** 2).sum(1).tolist() == [r.error for r in rows]


# ---- prefix trie

def trie_by_hand(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())

    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, d == len(whole)))
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        below = children.get(n, [])
        leaves[n] = sum(leaves[x] for x in below) or 1
        saved[n] = sum(saved[x] for x in below) + (
            (len(members[n]) - 1) * len(X.words(n[-1][1])) if n else 0)
    smallest = {n: min(c for c, _ in m) for n, m in members.items()}
    return sorted(((
        smallest[n], len(n), smallest[n[:-1]] if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
        hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in m if end)).encode()).hexdigest())
        for n, m in members.items()), key=repr)


def conversations(long=300):
    """Copies, shared heads, nulls, ties, a repeated row, ids below zero, long ones that part late."""
    rows = []
    for c in [*range(0, 45), 61, 62, 63, 64, 65, -7, -20, -33, 100, 101, 102]:
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c // 7 if t > 1 else c % 2}")
                 for t in range(c % 6)]
    for c in (200, 201, 202, 203, 240):
        rows += [(c, t, "user", f"long {t if t < long - c % 7 else (t, c % 3)}") for t in range(long + c % 9 * 4)]
    rows += [(7, None, None, None), (7, None, "user", ""), (8, 1, "user", "a tie"), (8, 1, "user", "a tie"),
             (8, 1, "user", "b tie"), (None, 0, "user", "no id"), (9, 3, "us", "er:x"), (10, 3, "user", ":x"),
             (11, 5, "", " \t"), (300, 0, "user", "é ü \x0b a"), (301, 0, "user", "w " * 5_000)]
    return rows


def trie_rows(spark, rows, parts=5):
    table = spark.createDataFrame(
        [(*r, 1, "x", 2, "y", 3) for r in rows],
        "conv_id long, turn long, role string, text string, conv int, name string, pos int, a string, depth int",
    ).repartition(parts)
    return sorted(map(tuple, trie.conversation_trie(table).collect()), key=repr)


def test_trie_equals_brute_force(spark):
    rows = conversations()
    assert trie_rows(spark, rows) == trie_by_hand(rows)


def test_trie_with_small_chunks_and_texts(spark, monkeypatch):
    """Keys of eight turns, texts of two ids and more ranges than conversations."""
    monkeypatch.setattr(trie, "CHUNK", 3)
    monkeypatch.setattr(trie, "IDS", 2)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [r for r in conversations(70) if r[0] is None or r[0] % 20 < 4]
        assert trie_rows(spark, rows) == trie_by_hand(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie_rows(spark, []) == [] and trie_rows(spark, [(None, 1, "user", "x")]) == []
    rows = [(c, 0, "user", "x") for c in range(1, 19)]  # no conversation 0: heads are empty
    got = trie_rows(spark, rows)
    assert got == trie_by_hand(rows) and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in got)


# ---- SentencePiece

ODD = [
    "", " ", "a", "  Hello  wörld\n ﬁ x▁y ", "a" * 3_000, "▁▁ ▁ x", "😀😀 é́", "x" * 300 + " " * 300,
    "<s> </s> <unk> <0x0A>", "\t\r\n\x00\x01", " " * 37, "日本語のテキスト 東京", "{{}}    if (x):\n        return",
    "the the THE", "​﻿", "𐍈𝔘", " ".join("supercalifragilistic" * k for k in range(1, 9))]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(Path(MODEL).read_bytes())


def test_odd_texts_are_encoded_as_by_the_library(vocabulary):
    assert vocabulary.encode(ODD) == [vocabulary.library.encode(t) for t in ODD]
    assert vocabulary.encode([]) == [] and vocabulary.encode(ODD) == [vocabulary.encode([t])[0] for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.text(st.characters(exclude_categories=["Cs"]), max_size=60),
    st.text("aeinrst ▁▁  Thé\n01", max_size=120)), max_size=4))
def test_any_text_is_encoded_as_by_the_library(vocabulary, texts):
    assert vocabulary.encode(texts) == [vocabulary.library.encode(t) for t in texts]


def test_many_agendas_are_the_single_agenda(vocabulary):
    segments = ["".join(np.random.default_rng(n).choice(list("aeinrstlo▁"), n % 40 + 2)) for n in range(400)]
    for segment, ids in vocabulary.agendas.merge(segments):
        assert [vocabulary.id_of[p] for p in pieces.agenda_merge(segment, vocabulary.scores)] == list(ids)


def test_equal_scores_are_taken_from_the_left():
    scores = {"aa": -2.0, "ab": -2.0, "aab": -1.0}
    assert pieces.agenda_merge("aaab", scores) == ["aa", "ab"] and pieces.agenda_merge("aab", scores) == ["aab"]
    assert pieces.agenda_merge("ba", scores) == ["b", "a"] and pieces.agenda_merge("", scores) == []
    ids = {p: n for n, p in enumerate(["a", "b", "aa", "ab", "aab"])}
    assert dict(pieces.Agendas(ids, scores).merge(["aaab", "aab"])) == {"aaab": (2, 3), "aab": (4,)}


def test_kept_segments_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 5)
    texts = [f"word{n} other{n}" for n in range(50)]
    assert [vocabulary.encode([t])[0] for t in texts] == [vocabulary.library.encode(t) for t in texts]
    assert len(vocabulary) < 60


def test_documents_are_encoded_and_decoded(spark, vocabulary):
    docs = X.documents(spark).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x")).withColumn("key", F.lit(0))
    rows = pieces.encoded(docs, MODEL).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    assert len(rows) == docs.count() and all(r.agrees for r in rows)
    sp = vocabulary.library
    for r in rows:
        assert (r.ids, r.decoded) in [(sp.encode(t), sp.decode(sp.encode(t))) for t in texts[r.doc_id]]
    assert pieces.encoded(docs.limit(0), MODEL).collect() == []


def test_registered_digests_are_those_of_the_library(spark, sf, vocabulary):
    sp = vocabulary.library
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_sentencepiece"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = sp.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) == (
            len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)), True)
