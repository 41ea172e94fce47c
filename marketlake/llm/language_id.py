"""Language identification with error-correcting output codes.

Each language has a codeword of +1 and -1 bits. One binary classifier per bit says from a text's
byte trigrams on which side of the bit its language is: a trigram's weight is the log-odds of
its rate on either side, and a text's margin is the mean weight of its trigrams. Decoding adds up, for
each codeword, the logistic loss of the margins against its bits, every bit weighted by how well
its classifier did on the learning rows; the codeword with the least loss wins. A text whose two
least losses lie closer than ``CLOSE`` is flagged as ambiguous.

Learning is two aggregations over all learning rows: trigram counts by language, hashed into a
fixed number of buckets, and the mean loss of each bit. Only those tables, bounded by
buckets x languages, reach the driver and, as weights, the tasks.

Defined results: ``und`` with score 0 for a null text and one without a letter, and for all texts
if there is nothing to learn from. Rows without id, text or language are never learned from. Every
input row gives one output row; rows may repeat. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._text import LOWER, row_slices, text_bytes

BUCKETS = 1 << 16
SMOOTHING = 0.5
#: factor from mean log-odds to the margin of the logistic loss
SLOPE = 4.0
CLOSE = 0.5
UNKNOWN = "und"
FOLDS = 5


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 bits per language.

    Up to seven languages: the exhaustive code, all ways to part them in two. More: random bits,
    the best of many draws by least distance, ten bits for each doubling.
    """
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 7:
        bits = np.arange((1 << (languages - 1)) - 1)
        code = np.array([(bits >> i) & 1 for i in range(languages - 1)])
        return np.vstack([np.ones(len(bits)), 1 - 2.0 * (1 - code)])
    width = 10 * int(np.ceil(np.log2(languages)))
    rng = np.random.Generator(np.random.PCG64(languages))
    best, apart = None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (languages, width)) * 2.0 - 1
        product = code @ code.T - 2 * width * np.eye(languages)
        mixed = (np.abs(code.sum(axis=0)) < languages).all()
        distance = (width - product.max()) / 2
        if mixed and distance > apart:
            best, apart = code, distance
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    trust: np.ndarray  # bits


def trigrams(column: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of the byte trigram around each byte of a word.

    Letters are lower-cased (ASCII and Latin-1); every other ASCII byte counts as a space.
    """
    data, offsets = text_bytes(column)
    sizes = np.diff(offsets)
    at = np.arange(len(data)) + np.repeat(np.arange(len(sizes)) + 1, sizes)
    wide = np.full(len(data) + len(sizes) + 1, 32, np.uint8)
    wide[at] = LOWER[data]
    latin = (wide[:-1] == 0xC3) & (wide[1:] >= 0x80) & (wide[1:] <= 0x9E)
    wide[1:][latin] += 32
    wide[(wide < 97) | (wide > 122) & (wide < 128)] = 32
    keep = wide[at] != 32
    at = at[keep]
    code = ((wide[at - 1].astype(np.uint32) << 16) | (wide[at].astype(np.uint32) << 8)
            | wide[at + 1])
    bucket = (code * np.uint32(2654435761)) >> np.uint32(8)
    return bucket % np.uint32(buckets), np.repeat(np.arange(len(sizes)), sizes)[keep]


def margins(part: pa.RecordBatch, weights: np.ndarray) -> np.ndarray:
    """Rows x bits: the mean weight of a row's trigrams (0 without any)."""
    bucket, row = trigrams(part.column("text"), len(weights))
    edge = np.searchsorted(row, np.arange(part.num_rows + 1))
    out = np.zeros((part.num_rows, weights.shape[1]))
    some = np.flatnonzero(np.diff(edge))
    if len(some):
        out[some] = np.add.reduceat(weights[bucket], edge[some], axis=0, dtype=np.float64)
        out[some] /= np.diff(edge)[some][:, None]
    return out


def _loss(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, -SLOPE * x)


def _count(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in row_slices(batch):
                bucket, row = trigrams(part.column("text"), buckets)
                lang = np.array(part.column("lang").to_pylist(), dtype=object)
                for name in set(lang.tolist()):
                    own = bucket[(lang == name)[row]]
                    counts = np.bincount(own, minlength=buckets)
                    total[name] = total.get(name, 0) + counts
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([name] * len(some), pa.string()),
                "bucket": pa.array(some, pa.int64()), "n": pa.array(counts[some], pa.int64())})
    return run


def _losses(code: np.ndarray, weights: np.ndarray, names: tuple[str, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(code.shape[1]), 0
        for batch in batches:
            for part in row_slices(batch):
                # a language none of whose texts has a trigram is not learned
                part = part.filter(pc.is_in(part.column("lang"), pa.array(names, pa.string())))
                if not part.num_rows:
                    continue
                own = np.array([names.index(x) for x in part.column("lang").to_pylist()], np.int64)
                total += _loss(margins(part, weights) * code[own]).sum(axis=0)
                rows += len(own)
        yield pa.RecordBatch.from_pydict({
            "bit": pa.array(range(len(total)), pa.int32()), "loss": pa.array(total),
            "rows": pa.array([rows] * len(total), pa.int64())})
    return run


def fit_language_codes(train: DataFrame, buckets: int = BUCKETS) -> LanguageModel:
    """Learn from all rows of ``train`` (text, lang)."""
    rows = train.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.mapInArrow(_count(buckets), "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    names = tuple(sorted(counts["lang"].unique()))
    code = codewords(len(names))
    table = np.zeros((len(names), buckets))
    for i, name in enumerate(names):
        own = counts[counts["lang"] == name]
        table[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    table /= np.maximum(table.sum(axis=1, keepdims=True), 1)  # each language counts alike
    floor = SMOOTHING / buckets
    weights = np.zeros((buckets, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        side = [table[code[:, bit] * s > 0] for s in (1, -1)]
        rate = [np.log((x.mean(axis=0) if len(x) else 0) + floor) for x in side]
        weights[:, bit] = rate[0] - rate[1] if all(map(len, side)) else 0
    trust = np.ones(code.shape[1])
    if len(names) > 1:
        found = (rows.mapInArrow(_losses(code, weights, names), "bit int, loss double, rows long")
                 .groupBy("bit").agg(F.sum("loss") / F.sum("rows")).collect())
        for bit, loss in found:
            trust[bit] = 1 / (0.05 + loss)
    return LanguageModel(names, code, weights, trust / trust.sum())


def decode(margin: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language number, score, ambiguous) of rows of margins."""
    loss = (_loss(margin[:, None, :] * model.code) * model.trust).sum(axis=2) * len(model.trust)
    best = loss.argmin(axis=1)
    least = loss.min(axis=1, keepdims=True)
    share = np.exp(least - loss)
    score = 1 / share.sum(axis=1)
    near = np.partition(loss, 1, axis=1)[:, 1] - least[:, 0] < CLOSE if loss.shape[1] > 1 else (
        np.zeros(len(loss), dtype=bool))
    return best, score, near


def _predict(model: LanguageModel, keep: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            for part in row_slices(batch):
                known = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
                best, score, near = decode(margins(part, model.weights), model)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep),
                     pa.array(np.where(known, names[best], UNKNOWN), pa.string()),
                     pa.array(np.where(known, score, 0.0)), pa.array(near & known)],
                    names=[*keep, "lang_pred", "score", "ambiguous"])
    return run


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous of every row."""
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    rows = docs.select("doc_id", "text", letter)
    if not model.languages:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("ambiguous"))
    return rows.mapInArrow(_predict(model, ["doc_id"]),
                           "doc_id long, lang_pred string, score double, ambiguous boolean")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """The contract's columns: learned outside the held-out fold, predicted for all rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_language_codes(docs.where(fold(F.col("doc_id")) != 0))
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return predict_languages(docs, model).select(
        "doc_id", held, "lang_pred", "score", "ambiguous")
