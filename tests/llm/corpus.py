"""Small corpora and brute-force versions for the tests of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use themselves
CLASHES = ["fp", "key", "row_id", "spans", "base", "doc", "rate", "score", "h", "n_words", "marks",
           "tokens", "posterior", "copies", "root", "component_id", "end", "start", "copy", "first",
           "tokens_", "posterior_", "mix_rate", "mix_copies", "a.b", "with space", "`tick`", "further6_"]


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def rows(texts: list[str | None], first: int = 1) -> list[tuple]:
    return [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def odd_rows() -> list[tuple]:
    """Nulls in every column, blank and very long texts, repeated rows and ids."""
    rng = random.Random(5)
    long = prose(rng, 60_000, 5000)
    return [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4),
        (4, "one", "en", "s", 3), (5, "Été \U0001f600 café", "fr", "s", 10),
        (None, "a text without an id that has some words", "en", None, 1),
        (None, None, None, None, None),
        (6, long, "en", "s", len(long)), (7, long + " end", "en", "s", len(long) + 4),
        (8, "the same row", "en", "s", 12), (8, "the same row", "en", "s", 12),
        (9, "an id twice", "en", "s", 11), (9, "with other words", "de", "t", 16),
        (10, "x" * 5000, "en", "s", 5000), (11, "same " * 300, "en", "s", 1500),
        (12, "\x00 \x01 null bytes \x00", "en", "s", 5),
    ]


def documents(spark, data: list[tuple], extra: bool = False):
    from pyspark.sql import functions as F
    out = spark.createDataFrame(data, DOCS)
    for name in CLASHES if extra else []:
        out = out.withColumn(name, F.lit("x"))
    return out


def components(nodes, links) -> dict:
    """The smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}
