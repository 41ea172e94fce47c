"""Substring dedup: repeated word windows by level-wise doubling.

A word of a document is removed when some window of ``window`` consecutive words covers it
and the same word sequence also starts in a document with a smaller id. Windows are judged
on the input, not on what is left after a removal.

The windows are found by doubling. Level one looks at windows of half the length, and only
at *anchors*: of all half windows inside a full window, the one with the smallest hash.
Equal full windows have equal anchors, so a full window can repeat only where its anchor
repeats, and about one half window in thirteen is an anchor. Windows repeated at one length
are extended to twice that length and kept if they still repeat; with ``longest=True`` this
goes on past ``window`` until no candidates survive, which also tells the length of
each document's longest repeated passage up to a factor of two.

Documents with the same words are one class at first: only the smallest id looks for windows,
the others are covered as a whole. Windows are compared by two independent 64-bit hashes.

Defined results: null and empty texts have no words. A text shorter than the window keeps all
words. A null id counts as larger than every other. Rows with equal ids never remove words
from each other; each input row gives one output row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._store import drop_written, written
from marketlake.llm._text import (
    SPACED_WORD,
    Words,
    distinct_by_row,
    list_column,
    mix,
    row_slices,
    sliding,
    window_hashes,
)

WINDOW = 50
NO_WORDS = hashlib.sha256(b"").hexdigest()
_LAST_ID = (1 << 63) - 1


def _anchors(words: Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-window hashes, for each full window its anchor's hash (0: no window), anchor marks."""
    half = window_hashes(h, window // 2)
    span = window - window // 2 + 1
    least = sliding(half, span, np.minimum)
    least = np.where(words.inside(window)[:len(least)], least, np.uint64(0))
    if not len(least):  # fewer words than one window
        return half, least, np.zeros(len(half), dtype=bool)
    none = np.zeros(span - 1, np.uint64)
    most = sliding(np.concatenate((none, least, none)), span, np.maximum)
    return half, least, (half == most) & (most > 0)


def _digest_rows(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), SPACED_WORD, lower=False)
                half, _, marked = _anchors(words, words.hashes(), window)
                at = np.flatnonzero(marked)
                values, row = distinct_by_row(half[at], words.row[at])
                texts = [words.data[a:b].tobytes() for a, b in
                         zip(words.offsets[:-1], words.offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("key"), part.column("doc_id"),
                    pa.array(np.diff(words.first)),
                    pa.array([hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]),
                    list_column(values.view(np.int64), row, words.rows),
                ], names=["key", "doc_id", "n_words", "words_sha256", "anchors"])
    return run


def _held(part: pa.RecordBatch, column: str = "marks") -> np.ndarray:
    """All distinct marks of a slice's rows; a mark holds for the corpus, not for one row."""
    return np.unique(part.column(column).flatten().to_numpy(zero_copy_only=False)).view(np.uint64)


def _own_marked(part: pa.RecordBatch, words: Words, found: np.ndarray) -> np.ndarray:
    """Whether each window is marked for the very row it stands in."""
    marks = part.column("marks")
    values = marks.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    row = np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy(zero_copy_only=False))
    step = np.uint64(0x9E3779B97F4A7C15)
    return np.isin(mix(found + words.row[:len(found)].astype(np.uint64) * step),
                   mix(values + row.astype(np.uint64) * step))


def _first_level(window: int) -> Callable:
    """Distinct full windows of each row whose anchor repeats."""
    def find(words: Words, h: np.ndarray, marks: np.ndarray) -> np.ndarray:
        _, least, _ = _anchors(words, h, window)
        return np.flatnonzero(np.isin(least, marks))
    return find


def _next_level(length: int) -> Callable:
    """Windows of ``length`` words whose two halves both repeat."""
    def find(words: Words, h: np.ndarray, marks: np.ndarray) -> np.ndarray:
        known = np.isin(window_hashes(h, length // 2), marks)
        both = known[:max(0, len(known) - length // 2)] & known[length // 2:]
        return np.flatnonzero(both & words.inside(length)[:len(both)])
    return find


def _windows(length: int, find: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), SPACED_WORD, lower=False)
                h = words.hashes()
                at = find(words, h, _held(part))
                first = window_hashes(h, length)[at]
                second = window_hashes(words.hashes(1), length)[at]
                row = words.row[at]
                order = np.lexsort((first, row))
                first, second, row = first[order], second[order], row[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (first[1:] != first[:-1]) | (row[1:] != row[:-1])
                key = part.column("key").to_numpy()[row[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(first[new].view(np.int64)),
                     pa.array(second[new].view(np.int64))], names=["key", "h1", "h2"])
    return run


def _remove(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), SPACED_WORD, lower=False)
                hit = _own_marked(part, words, window_hashes(words.hashes(), window))
                hit &= words.inside(window)[:len(hit)]
                edge = np.zeros(len(words) + 1, np.int64)
                edge[:len(hit)] += hit
                edge[window:window + len(hit)] -= hit
                gone = np.cumsum(edge[:-1]) > 0
                removed, kept, whole = [], [], []
                for r in range(words.rows):
                    a, b = words.first[r], words.first[r + 1]
                    own = words.data[words.offsets[r]:words.offsets[r + 1]].tobytes().split()
                    stay = [w for w, g in zip(own, gone[a:b], strict=True) if not g]
                    removed.append(len(own) - len(stay))
                    kept.append(b" ".join(stay).decode())
                    whole.append(hashlib.sha256(b" ".join(own)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(whole), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.string())],
                    names=["key", "words_sha256", "removed", "kept_text"])
    return run


def _repeats(found: DataFrame, level: int) -> DataFrame:
    """The windows of ``found`` that more than one document has; ``earlier``: the row's
    document is not the first of them."""
    shared = written(
        found.groupBy("h1", "h2").agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .where("first < last").select("h1", "h2", "first"), f"shared{level}")
    return found.join(shared, ["h1", "h2"]).select(
        "key", "h1", (F.col("key") > F.col("first")).alias("earlier"))


def _marks(windows: DataFrame) -> DataFrame:
    return windows.groupBy("key").agg(F.collect_set("h1").alias("marks"))


def repeated_windows(docs: DataFrame, window: int = WINDOW,
                     longest: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one row per document, repeated windows per document, longest level per document).

    The first has key, doc_id, n_words, words_sha256 and ``copy`` (all words also stand in a
    document with a smaller id); the second key, h1 and earlier, without the copies.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    keyed = docs.select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("key"), "doc_id", "text")
    rows = written(keyed.mapInArrow(
        _digest_rows(window),
        "key long, doc_id long, n_words long, words_sha256 string, anchors array<long>"), "rows")
    classes = written(
        rows.where(F.col("n_words") >= window).groupBy("words_sha256")
        .agg(F.min("key").alias("class_key"), F.count("*").alias("members"))
        .where("members > 1").drop("members"), "classes")
    rows = rows.join(classes, "words_sha256", "left").select(
        "key", "doc_id", "n_words", "words_sha256", "anchors",
        (F.coalesce("class_key", "key") < F.col("key")).alias("copy"))

    anchors = rows.where(~F.col("copy")).select("key", F.explode("anchors").alias("h1"))
    shared = written(
        anchors.groupBy("h1").agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .where("first < last").select("h1"), "anchors")
    marks = _marks(anchors.join(shared, "h1", "left_semi"))
    length, find, level, top = window, _first_level(window), 1, None
    text = keyed.select("key", "text")
    base = None
    while True:
        found = written(text.join(marks, "key").mapInArrow(
            _windows(length, find), "key long, h1 long, h2 long"), f"windows{level}")
        repeated = written(_repeats(found, level), f"repeated{level}")
        drop_written(found)
        base = repeated if base is None else base
        if not longest:
            break
        own = written(repeated.where("earlier").select("key", F.lit(length).alias("longest"))
                      .distinct(), f"level{level}")
        top = own if top is None else top.unionByName(own)
        if repeated.isEmpty():
            break
        marks = written(_marks(repeated), f"marks{level}")
        if repeated is not base:
            drop_written(repeated)
        length, level = length * 2, level + 1
        find = _next_level(length)
    if top is not None:
        top = top.groupBy("key").agg(F.max("longest").alias("longest"))
    return rows.drop("anchors"), base, top


def substring_dedup(docs: DataFrame, window: int = WINDOW, longest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every document row.

    ``kept_text`` has the kept words joined by one space; it is null where no word goes,
    and ``words_sha256`` is the digest of all the row's words joined likewise.
    ``longest=True`` adds ``longest_repeat``, the greatest doubled length at which a window
    also starts in an earlier document (null for none, and for whole copies).
    """
    rows, windows, top = repeated_windows(docs, window, longest)
    marks = _marks(windows.where("earlier"))
    cut = (docs.select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("key"), "text")
           .join(marks, "key")
           .mapInArrow(_remove(window),
                       "key long, words_sha256 string, removed long, kept_text string")
           .dropDuplicates(["key", "words_sha256"]))
    out = rows.join(cut, ["key", "words_sha256"], "left")
    if longest:
        out = out.join(top, "key", "left")
    whole = F.col("copy")
    return out.select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), "words_sha256",
        *([F.when(~whole, F.col("longest")).alias("longest_repeat")] if longest else []))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of :func:`substring_dedup` over ``documents``, all levels: levels above the
    window remove no further word, but tell how long each document's repeats are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs, longest=True).select(
        "doc_id", "n_words", "n_removed",
        F.when(F.col("kept_text").isNull(), F.col("words_sha256"))
        .otherwise(F.sha2("kept_text", 256)).alias("kept_sha256"),
        F.col("longest_repeat").cast("long").alias("longest_repeat"))


#: doublings that the SQL spells out; longer repeats than 50 * 2**14 words would need more
_SQL_LEVELS = 14


def _sql_level(n: int) -> str:
    """Windows of twice the length of level n - 1, by the digests of their halves."""
    half = WINDOW << n - 1
    return f"""
level{n} AS (
  SELECT key, i, h, first < key AS earlier FROM (
    SELECT key, i, h, min(key) OVER (PARTITION BY h) AS first, max(key) OVER (PARTITION BY h) AS last
    FROM (SELECT a.key, a.i, md5(a.h || b.h) AS h FROM level{n - 1} a
          JOIN level{n - 1} b ON b.key = a.key AND b.i = a.i + {half}))
  WHERE first < last)"""


_SQL_LONGEST = " UNION ALL ".join(
    f"SELECT key, {WINDOW << n} AS length FROM level{n} WHERE earlier" for n in range(_SQL_LEVELS + 1))
#: all windows of 50 words by their text, then windows of twice the length from pairs of halves
OP2_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(doc_id, {_LAST_ID}) AS key,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS words
  FROM documents),
level0 AS (
  SELECT key, i, h, first < key AS earlier FROM (
    SELECT key, i, h, min(key) OVER (PARTITION BY h) AS first, max(key) OVER (PARTITION BY h) AS last
    FROM (SELECT key, i, md5(array_to_string(words[i + 1:i + {WINDOW}], ' ')) AS h
          FROM (SELECT key, words, unnest(range(len(words) - {WINDOW} + 1)) AS i FROM docs)))
  WHERE first < last),{",".join(_sql_level(n) for n in range(1, _SQL_LEVELS + 1))},
gone AS (SELECT DISTINCT key, unnest(range(i, i + {WINDOW})) AS i FROM level0 WHERE earlier),
kept AS (
  SELECT key, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
  FROM (SELECT key, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs)
  ANTI JOIN gone USING (key, i) GROUP BY key),
repeats AS (SELECT key, max(length) AS longest FROM ({_SQL_LONGEST}) GROUP BY key),
copies AS (
  SELECT key, row_number() OVER (PARTITION BY words ORDER BY key) > 1 AS copy
  FROM docs WHERE len(words) >= {WINDOW})
SELECT doc_id, len(d.words) AS n_words, len(d.words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256,
       CAST(CASE WHEN NOT coalesce(copy, false) THEN longest END AS BIGINT) AS longest_repeat
FROM docs d LEFT JOIN kept USING (key) LEFT JOIN repeats USING (key) LEFT JOIN copies USING (key)"""
