"""Rows with every odd case, and brute-force versions to compare with."""

import collections
import re

from pyspark.sql import types as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Columns that the operators use as names of their own come as extra columns.
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("tag", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("size", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("bucket", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("_k_id", T.StringType()),
])


def words(text):
    return WORDS.findall(text or "")


def documents(spark, rows):
    """Documents of (doc_id, text, source) rows, with extra columns of clashing names."""
    full = [(i, t, "en", s, None if t is None else len(t), "t", "i", "s", "k", "b", "r", "x") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows and copies."""
    base = " ".join(f"word{i % 37}x{i}" for i in range(60))
    return [
        (1, base, "b"), (2, base.replace(" ", "\n"), "b"), (3, base + " tail", "a"), (4, None, "a"), (5, "", None), (6, " \t\n\x0b\x0c\r", "c"),
        (7, "one", "c"), (8, "one", "c"), (8, "one", "c"), (9, "two words", None), (10, "Two  Words", "a"), (None, base, None), (None, None, None),
        (11, " ".join(f"long{i}" for i in range(5000)), "a"), (12, "x" * 20000, "b"), (13, "ab cd " * 40, "b"), (14, "é ñ ö 漢字   z", "é"),
        (15, base.upper(), "c"), (16, " ".join(base.split()[:30]) + " " + " ".join(f"other{i}" for i in range(30)), "a"),
        (17, "a<|endoftext|>b <|startoftext|> c", "a"),
    ]


def shingles(text, width):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1)))


def linked(rows, width, percent):
    """Component (smallest id) of each (id, text) row, by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = collections.defaultdict(lambda: float("inf"))
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least[find(k)], i)
    return [(i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets)]
