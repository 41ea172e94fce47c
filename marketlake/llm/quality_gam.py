"""Quality classifier: a generalised additive model with pairwise interactions.

A text's features are shares and ratios of its bytes, words and lines. Each feature has bins at the
learning rows' quantiles; boosting goes round the features in cycles and fits at each turn one
shallow tree of that feature alone to the log-loss gradient, so the trees of a feature add up to
a table by bin. When the cycles are done, the pairs of features whose quadrants reduce the
loss most get tables by pair of bins in the same way. A score is the logistic of a bias and the
tables' entries, looked up and added for whole batches of texts at once.

Learning takes at most ``SAMPLE`` labelled rows, those with the smallest hash of the id; their
features (numbers, no texts) are gathered on the driver. Scoring takes every whole text.

Defined results: null and empty texts have features 0 and a score like any other. A label other
than 0 and 1 or without a text is not learned from; a document with several labels counts with
the greatest. Without both labels to learn from, the score is the smoothed share of label 1.
Every input row gives one output row; rows may repeat. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._names import any_names
from marketlake.llm._store import written
from marketlake.llm._text import SPACED_WORD, Words, mix, row_slices, text_bytes, window_hashes

SAMPLE = 20_000
BINS = 24
CYCLES = 60
RATE = 0.15
PAIRS = 8
PAIR_CYCLES = 20
LEAST_ROWS = 8.0
L2 = 1.0
THRESHOLD = 0.3
FOLDS = 5

FEATURES = ("words", "word_length", "upper", "digit", "symbol", "mark", "bar", "high", "space",
            "distinct_words", "distinct_pairs", "distinct_fives", "line_length", "distinct_lines",
            "short_words", "long_words", "sentence_ends", "tail_marks")

_LINE = np.ones(256, dtype=bool)
_LINE[10] = False
_U = np.uint64


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters.encode())] = True
    return out


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_SYMBOL, _MARK, _BAR = _class("#$%&*+/<=>@[\\]^_`{}~"), _class("!?"), _class("|")
_HIGH, _SPACE, _END = np.arange(256) > 127, ~SPACED_WORD, _class(".!?")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz") | _HIGH


def _distinct(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct values of each row."""
    keyed = mix(values ^ (row.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
    first = np.unique(keyed, return_index=True)[1]
    return np.bincount(row[first], minlength=rows)


def features(column: pa.Array) -> np.ndarray:
    """Rows x ``FEATURES`` of a column of texts."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    words = Words(column, SPACED_WORD, lower=False)
    lines = Words(column, _LINE, lower=False)
    h, row, n = words.hashes(), words.row, np.diff(words.first)
    sizes = words.end - words.start

    def per_row(mask: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[edges[1:]] - total[edges[:-1]]).astype(float)

    def of_bytes(table: np.ndarray) -> np.ndarray:
        return per_row(table[data], offsets)

    def repeats(width: int) -> np.ndarray:
        found = window_hashes(h, width)
        at = np.flatnonzero(words.inside(width)[:len(found)])
        return _distinct(found[at], row[at], rows) / np.maximum(n - width + 1, 1)

    size, count = np.maximum(np.diff(offsets), 1.0), np.maximum(n, 1.0)
    letters, ink = np.maximum(of_bytes(_LETTER), 1), np.maximum(size - of_bytes(_SPACE), 1)
    last = data[words.end - 1] if len(words) else np.empty(0, np.uint8)
    n_lines = np.maximum(np.diff(lines.first), 1.0)
    out = [
        np.log1p(n), per_row(sizes, words.first) / count, of_bytes(_UPPER) / letters,
        of_bytes(_DIGIT) / ink, of_bytes(_SYMBOL) / ink, of_bytes(_MARK) / ink, of_bytes(_BAR) / ink,
        of_bytes(_HIGH) / ink, of_bytes(_SPACE) / size, _distinct(h, row, rows) / count, repeats(2),
        repeats(5), np.log1p(size / n_lines),
        _distinct(lines.hashes(), lines.row, rows) / n_lines,
        per_row(sizes <= 2, words.first) / count, per_row(sizes >= 12, words.first) / count,
        per_row(_END[last], words.first) / count,
        per_row(~_LETTER[last] & ~_END[last], words.first) / count,
    ]
    return np.stack(out, axis=1)


@dataclass(frozen=True)
class Gam:
    """Cut points and additive tables; ``pairs`` maps (feature, feature) to a table of bins."""

    bias: float
    cuts: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right")
                         for j, c in enumerate(self.cuts)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.cuts:
            return np.full(len(x), 1 / (1 + np.exp(-self.bias)))
        b = self.bins(x)
        total = np.full(len(x), self.bias)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for (i, j), table in self.pairs.items():
            total += table[b[:, i], b[:, j]]
        return 1 / (1 + np.exp(-total))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return -g / (h + L2)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + L2)


def _step(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """A tree of one feature from sums by bin: the step of each bin."""
    out = np.full(len(g), _leaf(g.sum(), h.sum()))
    if depth == 0 or len(g) < 2:
        return out
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl)
    gain[(nl < LEAST_ROWS) | (n.sum() - nl < LEAST_ROWS)] = -1
    at = int(gain.argmax())
    if gain[at] <= _gain(g.sum(), h.sum()):
        return out
    return np.concatenate([_step(g[:at + 1], h[:at + 1], n[:at + 1], depth - 1),
                           _step(g[at + 1:], h[at + 1:], n[at + 1:], depth - 1)])


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of two features' bins into four parts: its gain, the step of each cell."""
    def parts(x: np.ndarray) -> np.ndarray:
        c = x.cumsum(axis=0).cumsum(axis=1)
        a, b, whole = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        q = c[:-1, :-1]
        return np.stack([q, a - q, b - q, whole - a - b + q])

    gq, hq, nq = parts(g), parts(h), parts(n)
    gain = _gain(gq, hq).sum(axis=0)
    gain[nq.min(axis=0) < LEAST_ROWS] = -1
    if not gain.size or gain.max() <= _gain(g.sum(), h.sum()):
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    leaf = _leaf(gq[:, i, j], hq[:, i, j])
    step = np.empty_like(g)
    step[:i + 1, :j + 1], step[:i + 1, j + 1:] = leaf[0], leaf[1]
    step[i + 1:, :j + 1], step[i + 1:, j + 1:] = leaf[2], leaf[3]
    return float(gain[i, j] - _gain(g.sum(), h.sum())), step


def fit_gam(x: np.ndarray, y: np.ndarray, cycles: int = CYCLES, pairs: int = PAIRS) -> Gam:
    """Cyclic boosting on rows x features and labels 0 and 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Gam(bias, (), ())
    cuts = tuple(np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T)
    model = Gam(bias, cuts, tuple(np.zeros(len(c) + 1) for c in cuts))
    b = model.bins(x)
    total = np.full(len(y), bias)

    def sums(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return (np.bincount(cell, p - y, size), np.bincount(cell, p * (1 - p), size),
                np.bincount(cell, minlength=size).astype(float))

    for _ in range(cycles):
        for j, table in enumerate(model.tables):
            step = RATE * _step(*sums(b[:, j], len(table)), depth=2)
            table += step
            total += step[b[:, j]]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = len(model.tables[i]), len(model.tables[j])
        return b[:, i] * shape[1] + b[:, j], shape

    found = []
    for i in range(x.shape[1]):
        for j in range(i):
            cell, shape = cells(j, i)
            gain = _quadrants(*(s.reshape(shape) for s in sums(cell, shape[0] * shape[1])))[0]
            found.append((gain, j, i))
    chosen = [(j, i) for gain, j, i in sorted(found, reverse=True)[:pairs] if gain > 0]
    for pair in chosen:
        model.pairs[pair] = np.zeros(cells(*pair)[1])
    for _ in range(PAIR_CYCLES):
        for pair in chosen:
            cell, shape = cells(*pair)
            step = RATE * _quadrants(*(s.reshape(shape) for s in sums(cell, shape[0] * shape[1])))[1]
            model.pairs[pair] += step
            total += step.ravel()[cell]
    return model


_KEPT = ["doc_id", "text_hash", "quality"]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in row_slices(batch):
            x = features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in _KEPT), *map(pa.array, x.T)], names=[*_KEPT, *FEATURES])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Gam:
    """Learn ``labels.quality`` from at most ``sample`` labelled documents outside the held-out fold.

    Of rows that share an id the text with the least hash counts, so ``sample`` bounds the rows
    that come to the driver, whatever repeats.
    """
    known = (labels.where((fold(F.col("doc_id")) != 0) & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the sample bounds the broadcast side
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(
        F.broadcast(written(known, "labels")), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        "quality", "text")
    values = ", ".join(f"{f} double" for f in FEATURES)
    found = (rows.mapInArrow(_feature_rows, f"doc_id long, text_hash long, quality int, {values}")
             .groupBy("doc_id").agg(F.min(F.struct("text_hash", "quality", *FEATURES)).alias("least"))
             .select("doc_id", "least.*").toPandas().sort_values("doc_id"))
    return fit_gam(found[list(FEATURES)].to_numpy(float), found["quality"].to_numpy(float))


def _score(model: Gam, keep: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                score = model.score(features(part.column("text")))
                yield part.select(keep).append_column("score", pa.array(score))
    return run


def quality_scores(docs: DataFrame, model: Gam) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        _score(model, ["doc_id"]), "doc_id long, score double")


def _keep(model: Gam, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                yield part.filter(pa.array(
                    model.score(features(part.column("text"))) >= threshold))
    return run


@any_names
def good_documents(docs: DataFrame, model: Gam, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``threshold``."""
    return docs.mapInArrow(_keep(model, threshold), docs.schema)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`quality_scores` over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
