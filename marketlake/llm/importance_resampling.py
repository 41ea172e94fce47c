"""Resampling documents by their importance for a target distribution.

Texts are described by hashed word n-grams. A text's separators are collapsed to single spaces, and
one regular expression per length, scanned with overlapping matches and bounded by lookarounds,
emits the spans of all runs of that many words; each span's CRC-32 gives its bucket. Counts of the
whole corpus and of the target texts give every bucket a log ratio (gain), a text's weight is the mean gain
of its spans, and the weight with Gumbel noise from a hash of the id is its score. The texts
with the highest scores are a draw without replacement in proportion to the weights.

Tasks read whole texts and send counts by bucket (``buckets`` numbers, whatever the corpus) or one
small row per document. Ranks need no global sort: documents are counted by score, the counts
are added up inside ranges of scores and then over the ranges, and only documents of one score are
ordered among themselves.

Defined results: null and empty texts, and texts of separators alone, have no words, no features and
weight 0. Very long texts are scanned whole, one at a time. Rows may repeat and each counts;
ties go to the smaller id, then weight and features. A row without an id has no noise, so no score, isn't
counted among the documents and is never drawn. An empty corpus gives no rows; without target texts
every bucket's target count is 0. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm._store import written
from marketlake.llm._text import ALNUM_WORD, LOWER

LONGEST = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: scores whose counts are added up together
SCORE_RANGE = 256

#: separators become spaces, A-Z lower case
_PLAIN = np.where(ALNUM_WORD, LOWER, np.uint8(0x20)).astype(np.uint8).tobytes()

Counts = dict[int, int]


def patterns(longest: int) -> list[regex.Pattern]:
    """One pattern for the runs of 1, 2, ... words of a text with single spaces."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))
            for n in range(1, longest + 1)]


def plain(text: str | None) -> bytes:
    """The words of a text, A-Z in lower case, joined by single spaces (UTF-8)."""
    return b" ".join((text or "").encode().translate(_PLAIN).split())


def spans(words: bytes, found: list[regex.Pattern]) -> Iterator[tuple[int, int]]:
    """(start, end) of every run of words, shorter runs first."""
    for pattern in found:
        for match in pattern.finditer(words, overlapped=True):
            yield match.span()


def feature_buckets(words: bytes, found: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every run of words."""
    view = memoryview(words)
    crc = np.fromiter((zlib.crc32(view[a:b]) for a, b in spans(words, found)), np.uint32)
    return (crc % np.uint32(buckets)).astype(np.int64)


def _count(longest: int, buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = patterns(longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                own = feature_buckets(plain(text.as_py()), found, buckets)
                total += np.bincount(own, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> Counts:
    """Features by bucket over all rows of a one-column frame; at most ``buckets`` entries."""
    parts = texts.mapInArrow(_count(longest, buckets), "bucket long, n long")
    return {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


@dataclass(frozen=True)
class Importance:
    """The gain of each bucket and how features are taken."""

    gains: np.ndarray
    longest: int


def gain_table(corpus: Counts, target: Counts, buckets: int) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of each bucket, shares smoothed by one."""
    s_all, t_all = sum(corpus.values()) + buckets, sum(target.values()) + buckets
    return np.array([math.floor(1000 * math.log(
        ((target.get(b, 0) + 1) * s_all) / ((corpus.get(b, 0) + 1) * t_all))) for b in range(buckets)])


def fit_importance(docs: DataFrame, target: DataFrame, longest: int = LONGEST,
                   buckets: int = BUCKETS) -> Importance:
    """Gains from all texts of ``docs`` and of ``target``."""
    return Importance(gain_table(bucket_counts(docs.select("text"), longest, buckets),
                                 bucket_counts(target.select("text"), longest, buckets), buckets),
                      longest)


def gumbel(doc_id: int | None, seed: int) -> int | None:
    """floor(-1000 ln(-ln(u))) with u from a hash of the id."""
    if doc_id is None:
        return None
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weigh(model: Importance, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, gains = patterns(model.longest), model.gains
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = plain(text.as_py())
                own = feature_buckets(words, found, len(gains))
                weight = int(gains[own].sum()) // len(own) if len(own) else 0
                noise = gumbel(doc_id, seed)
                rows.append((doc_id, words.count(b" ") + bool(words), len(own), weight,
                             None if noise is None else weight + noise))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else
                [pa.array([], pa.int64())] * 5, ["doc_id", "n_words", "n_features", "weight", "score"])
    return run


def importance_scores(docs: DataFrame, model: Importance, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _weigh(model, seed), "doc_id long, n_words long, n_features long, weight long, score long")


def _before(eligible: DataFrame) -> DataFrame:
    """For each score: the number of rows with a higher one, and of all rows."""
    counts = eligible.groupBy("score").agg(F.count("*").alias("n")).withColumn(
        "part", F.floor(F.col("score") / SCORE_RANGE))
    higher = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n").alias("rows"))  # a few hundred rows
    parts = parts.select("part", F.coalesce(F.sum("rows").over(higher), F.lit(0)).alias("above"))
    inside = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, -1)
    return counts.join(parts, "part").select(
        "score", (F.col("above") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))


def resampled(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scores`` with ``rank``: 1, 2, ... for the drawn rows, null for the others.

    Of the rows with a score and ``least_words`` words, the ``percent`` with the highest scores
    are drawn.
    """
    scores = written(scores, "scores")
    fits = F.coalesce(F.col("score").isNotNull() & (F.col("n_words") >= least_words), F.lit(False))
    eligible = scores.where(fits)
    draws = eligible.count() * percent // 100
    before = written(_before(eligible), "before")
    among = Window.partitionBy("score").orderBy("doc_id", "weight", "n_features")
    place = F.col("before") + F.row_number().over(among)
    ranked = eligible.join(before.where(F.col("before") < draws), "score").withColumn("rank", place) \
        .withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    lowest = before.where(F.col("before") < draws).agg(F.min("score")).first()[0]
    out = [*scores.columns, F.col("rank").cast("long").alias("rank")]
    rest = scores if lowest is None else scores.where(~fits | (F.col("score") < lowest))
    return ranked.select(*out).unionByName(
        rest.select(*scores.columns, F.lit(None).cast("long").alias("rank")))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """The contract's columns for ``documents`` with ``benchmark`` as the target."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_importance(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return resampled(importance_scores(docs, model)).select(
        "doc_id", "n_features", "weight", "score", "rank")


#: the eight steps of CRC-32 for a byte, and the bytes of a word
_CRC_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
_WORDS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP12_SQL = rf"""
WITH RECURSIVE steps AS (
  SELECT b AS byte, CAST(b AS BIGINT) AS c, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, {_CRC_STEP.format(c="c")}, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
doc_words AS (SELECT row_number() OVER () AS row_id, doc_id,
                     coalesce({_WORDS}, CAST([] AS VARCHAR[])) AS words FROM documents),
bench_words AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
vocabulary AS (SELECT DISTINCT word FROM (
  SELECT unnest(words) AS word FROM doc_words UNION ALL SELECT word FROM bench_words)),
hexed AS (SELECT word, hex(encode(word)) AS h FROM vocabulary),
bucketed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           range(1, CAST(length(h) AS BIGINT), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM hexed, crc_table),
doc_buckets AS (
  SELECT row_id, bucket FROM (SELECT row_id, unnest(words) AS word FROM doc_words)
  JOIN bucketed USING (word)),
s AS (SELECT bucket, count(*) AS n FROM doc_buckets GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bench_words JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT b AS bucket, CAST(floor(1000 * ln(
      CAST((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS}) AS DOUBLE)
      / CAST((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS}) AS DOUBLE)))
      AS BIGINT) AS gain
  FROM range({BUCKETS}) r(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b),
sums AS (SELECT row_id, count(*) AS n, sum(gain) AS g FROM doc_buckets JOIN gains USING (bucket)
         GROUP BY row_id),
weighed AS (
  SELECT doc_id, coalesce(n, 0) AS n_features,
         CAST(coalesce((g - ((g % n) + n) % n) // n, 0) AS BIGINT) AS weight,
         CAST('0x' || substr(sha256('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM doc_words LEFT JOIN sums USING (row_id)),
scored AS (
  SELECT doc_id, n_features, weight,
         weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM weighed),
ranked AS (
  SELECT *, CASE WHEN n_features >= {LEAST_WORDS} AND score IS NOT NULL THEN row_number() OVER (
      PARTITION BY n_features >= {LEAST_WORDS} AND score IS NOT NULL ORDER BY score DESC, doc_id) END AS place
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT {PERCENT} * count(place) // 100 FROM ranked) THEN place END AS rank
FROM ranked"""
