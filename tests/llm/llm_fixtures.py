"""Small tables with every awkward case, and brute-force versions of what Spark computes."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = ("the old miller walked slowly to the river, and there he found a small wooden boat. "
         "Nobody had used it for years; its paint was gone, its oars were broken. Still he sat down "
         "in it, looked at the grey water and thought about his father who had built the mill. ")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None, low: bool = False) -> list[str]:
    return WORD.findall(lower(text) if low else text or "")


def shingles(text: str | None) -> set[tuple]:
    w = words(text, True)
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))}


def documents(spark):
    """Nulls in every column, empty and blank texts, a long text, ties, repeated rows and
    columns whose names clash with those that operators make."""
    long = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
    rows = [
        (1, PROSE, "en", "src0"), (2, PROSE, "en", "src0"), (3, PROSE.upper(), "de", "src1"),
        (4, PROSE + "One more sentence.", "en", None), (5, None, "en", "src0"), (6, "", None, "src1"),
        (7, " \t\n ", "fr", "src2"), (8, "too short", "fr", "src2"), (9, "Too Short", "es", "src2"),
        (10, long, "en", "src0"), (10, long, "en", "src0"), (None, PROSE, "en", "src0"),
        (None, None, None, None), (11, "ein anderer Text über Bäume, Flüsse und Wege. " * 3, "de", "src1"),
        (12, "é\u00a0ü \x0b a\x0cb\r\nc", "fr", "src0")]
    data = [(i, t, lang, s, len(t or ""), f"k{n}", n, "x") for n, (i, t, lang, s) in enumerate(rows)]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, "
        "shard string, copies int, SCORE string")


def near_groups(rows: list[tuple[int, str]], percent: int = 85) -> dict[int, int]:
    """Smallest reachable id of every id, from all pairs at ``percent`` or more."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    ids, up = sorted(sets), {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def weighted_similarity(a: list[str], b: list[str]) -> float:
    def bag(w):
        return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1)))

    x, y = bag(a), bag(b)
    return sum((x & y).values()) / sum((x | y).values())


def leaks(docs: list[tuple], items: list[tuple], threshold: float = 0.8) -> dict[tuple, tuple]:
    """(doc, item) -> (similarity, first word) of the best window, from all windows."""
    out = {}
    for i, t in docs:
        w = words(t, True)
        for j, text in items:
            if not shingles(t) & shingles(text) and len(words(text)) >= 5:
                continue  # nothing in common
            q = words(text, True)
            best = max(((weighted_similarity(w[a:a + len(q)], q), -a)
                        for a in range(len(w) - len(q) + 1)), default=(0, 0)) if q else (0, 0)
            if best[0] >= threshold:
                out[i, j] = (round(best[0], 9), -best[1])
    return out
