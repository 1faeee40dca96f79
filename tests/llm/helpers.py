"""Small tables and plain versions of what the operators compute."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

SF = "/root/testdata/sf0.001"
LONG = "word " * 9000 + "end"

ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two"),
    (6, "one two three four five six seven"),
    (7, "one two three four five six seven"),
    (8, "One  two\nthree FOUR five six seven"),
    (9, "É ▁ 😀 a  b c\x0bd <|endoftext|> it's"),
    (10, LONG),
    (11, "x" * 30000),
    (12, LONG),
    (None, "one two three four five six seven"),
    (None, None),
    (6, "one two three four five six seven"),
]
CLASHING = "key string, word string, block int, score string, node long, label int, n string, start long, _text string"


def odd_documents(spark):
    """Null, empty, long and repeated texts, null ids, and columns that operators use inside."""
    rows = [(i, t, "en", "s", len(t or ""), "k", "w", 1, "s", 5, 1, "n", 3, "t") for i, t in ODD_TEXTS]
    return spark.createDataFrame(
        rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    ).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def crc(value):
    return zlib.crc32(str(value).encode())


def shingle_set(text, size):
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def near_components(texts, size, percent):
    """Component per id, from every pair that shares a shingle."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            having[g].append(i)
    for i, s in sets.items():
        for j in {j for g in s for j in having[g] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}
