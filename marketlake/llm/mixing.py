"""Mixing sources to target weights with soft membership.

A classifier learned from a labelled table gives each document a posterior for every domain. The mix
asks for document rates r >= 0 whose expected token totals by domain, the sum of
rate x tokens x posterior, match targets. Rates start at 1 and follow projected gradients of the
least-squares misfit, measured in the metric of the posteriors' second moments, where
the step is 1. A gradient at a document depends on its posterior alone, and posteriors are
rounded to ``GRID``: so documents of one posterior share a rate, the misfit of every iteration is
summed by tasks over distinct posteriors, and the driver holds sums by domain and pair of domains. The fit ends
where the projected gradient is zero, and tells wanted and reached totals.

The classifier is a softmax regression over the words a text holds, their first bytes, and the last
bytes before spaces, hashed into a fixed number of buckets. For each domain the buckets count
that tell it best from the others, and from the likest one, by a G-test. It learns from at most
``SAMPLE`` labelled rows, those with the smallest hash of the id; counts by bucket and the chosen
features of those rows, no texts, are gathered on the driver.

A rate becomes whole copies: its integer part, and one more with the probability of its
fraction, decided by a hash of the id, so a rerun gives the same mix.

The production targets come from the input: the totals by domain of the documents whose posterior is
less than half toxic, scaled up to the size of the mix. So clean documents keep their proportions
whatever these are, and only toxic ones are cut. Given weights set the shares of the domains they name;
a domain without a weight keeps its natural share.

Defined results: null and empty texts have no tokens and the domains' prior as posterior. A target of
a domain that no labelled row has is left out and the others scaled up; without any, every rate
is 1. Where all tokens are toxic the production targets are 0. An empty table gives no rows. Very long texts
count whole, a slice at a time. Rows may repeat; each gets the same rate and copies, and so do rows of
one posterior and id. Extra columns, whatever their names, are kept by :func:`mixed_documents` and
ignored otherwise; where one is called mix_rate or mix_copies, the stage's own gets a number.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from marketlake.llm._names import any_names
from marketlake.llm._store import written
from marketlake.llm._text import ALNUM_WORD, SPACED_WORD, Words, distinct_by_row, list_column, mix, row_slices

SAMPLE = 20_000
BUCKETS = 1 << 18
#: bytes at the start of words, and at the end of strings between spaces, that are features
PREFIX, SUFFIX = 6, 2
#: features for each domain and test; penalty and rounds of the regression
CHOSEN, L2, ROUNDS = 32, 1e-4, 300
GRID = 1000
#: end of the names of the domains that the production mix cuts
TOXIC = "/toxic"
#: the fit ends when no rate moves by more than this
TOLERANCE, ITERATIONS = 1e-3, 30


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    chosen: np.ndarray  # ascending buckets
    weights: np.ndarray  # chosen buckets, then the bias, x domains
    buckets: int = BUCKETS


def text_features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word count by row, distinct feature buckets, their rows)."""
    words = Words(column, ALNUM_WORD, lower=True)
    n, row = np.diff(words.first), words.row
    whole = words.hashes()
    words.end = np.minimum(words.end, words.start + PREFIX)
    start = words.hashes(1)
    ends = Words(column, SPACED_WORD, lower=False)
    ends.start = np.maximum(ends.start, ends.end - SUFFIX)
    found = np.concatenate((whole, start, mix(ends.hashes()))) % np.uint64(buckets)
    return n, *distinct_by_row(found.astype(np.int64), np.concatenate((row, row, ends.row)))


def _count(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in row_slices(batch):
                domain = np.array(part.column("domain").to_pylist(), dtype=object)
                _, feature, row = text_features(part.column("text"), buckets)
                for name in set(domain.tolist()):
                    own = total.setdefault(name, np.zeros(buckets + 1, np.int64))
                    own[:-1] += np.bincount(feature[(domain == name)[row]], minlength=buckets)
                    own[-1] += (domain == name).sum()
        for name, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "domain": pa.array([name] * len(some), pa.string()),
                "bucket": pa.array(some, pa.int64()), "n": pa.array(counts[some], pa.int64())})
    return run


def _present(chosen: np.ndarray, buckets: int) -> Callable:
    """The chosen features of each row, by their numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                _, feature, row = text_features(part.column("text"), buckets)
                own = np.isin(feature, chosen)
                yield pa.RecordBatch.from_arrays(
                    [part.column("domain"), list_column(
                        np.searchsorted(chosen, feature[own]).astype(np.int32), row[own],
                        part.num_rows)], names=["domain", "features"])
    return run


def _g_statistic(a: np.ndarray, rows_a: float, b: np.ndarray, rows_b: float) -> np.ndarray:
    """How well each feature's share tells two sets of rows apart."""
    rate = (a + b) / (rows_a + rows_b)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))

    return 2 * (part(a, rate * rows_a) + part(rows_a - a, (1 - rate) * rows_a)
                + part(b, rate * rows_b) + part(rows_b - b, (1 - rate) * rows_b))


def choose_features(counts: np.ndarray, rows: np.ndarray, each: int = CHOSEN) -> np.ndarray:
    """For each domain the buckets that tell it best from all others, and from the likest one."""
    share = counts / rows
    length = np.linalg.norm(share, axis=0) + 1e-12
    like = share.T @ share / length / length[:, None] - 2 * np.eye(len(rows))
    found = set()
    for d in range(len(rows)):
        others = [counts.sum(axis=1) - counts[:, d], counts[:, like[d].argmax()]]
        sizes = [rows.sum() - rows[d], rows[like[d].argmax()]]
        for other, size in zip(others, sizes, strict=True):
            g = _g_statistic(counts[:, d], rows[d], other, size)
            best = np.argsort(-g, kind="stable")[:each]
            found.update(best[g[best] > 0].tolist())
    return np.array(sorted(found), np.int64)


def fit_softmax(x: np.ndarray, y: np.ndarray, domains: int) -> np.ndarray:
    """Weights of a softmax regression, by accelerated gradients."""
    weights = ahead = np.zeros((x.shape[1], domains))
    truth = np.eye(domains)[y]
    rate = 4.0 / max(x.sum(axis=1).mean(), 1.0)
    for i in range(ROUNDS):
        p = _softmax(x @ ahead)
        now = ahead - rate * (x.T @ (p - truth) / len(y) + L2 * ahead)
        ahead, weights = now + i / (i + 3) * (now - weights), now
    return weights


def _softmax(total: np.ndarray) -> np.ndarray:
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE,
                buckets: int = BUCKETS) -> DomainModel:
    """Learn from ``labelled`` (doc_id, domain); of several domains of an id the greatest counts."""
    known = written(
        labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL")
        .groupBy("doc_id").agg(F.max("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labels")
    # the sample bounds the broadcast side
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("domain", "text")
    found = (rows.mapInArrow(_count(buckets), "domain string, bucket long, n long")
             .groupBy("domain", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names = tuple(sorted(found["domain"].unique().to_pylist()))
    if not names:
        return DomainModel((), np.empty(0, np.int64), np.zeros((1, 0)))
    number = pc.index_in(found["domain"], pa.array(names)).to_numpy()
    table = np.zeros((buckets + 1, len(names)))
    table[found["bucket"].to_numpy(), number] = found["n"].to_numpy()
    chosen = choose_features(table[:-1], table[-1])
    held = rows.mapInArrow(_present(chosen, buckets), "domain string, features array<int>").toArrow()
    x = np.zeros((held.num_rows, len(chosen) + 1), np.float32)
    x[:, -1] = 1
    lists = held["features"].combine_chunks()
    x[np.repeat(np.arange(len(x)), pc.list_value_length(lists).to_numpy(zero_copy_only=False)),
      lists.flatten().to_numpy(zero_copy_only=False)] = 1
    y = pc.index_in(held["domain"], pa.array(names)).to_numpy()
    return DomainModel(names, chosen, fit_softmax(x, y, len(names)), buckets)


def posteriors(part: pa.RecordBatch, model: DomainModel) -> tuple[np.ndarray, np.ndarray]:
    """(word counts, rows x domains in whole steps of 1 / GRID)."""
    n, feature, row = text_features(part.column("text"), model.buckets)
    own = np.isin(feature, model.chosen)
    at, row = np.searchsorted(model.chosen, feature[own]), row[own]
    total = np.tile(model.weights[-1], (part.num_rows, 1))
    for d in range(len(model.domains)):
        total[:, d] += np.bincount(row, model.weights[at, d], part.num_rows)
    if not model.domains:
        return n, np.zeros((part.num_rows, 0), np.int64)
    return n, np.rint(_softmax(total) * GRID).astype(np.int64)


def _with_posteriors(model: DomainModel, keep: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                n, p = posteriors(part, model)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(part.num_rows + 1) * p.shape[1], pa.int32()),
                    pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(n), lists],
                    names=[*keep, "tokens_", "posterior_"])
    return run


def _rate(posterior: Column, steps: list[np.ndarray]) -> Column:
    """The rate after the projected steps, which start at 1."""
    if not steps:
        return F.lit(1.0)
    table = F.from_json(F.lit(json.dumps([s.tolist() for s in steps])), "array<array<double>>")
    return F.aggregate(table, F.lit(1.0), lambda r, step: F.greatest(F.lit(0.0), r - F.aggregate(
        F.zip_with(posterior, step, lambda p, s: p * s / GRID), F.lit(0.0), lambda a, b: a + b)))


@dataclass(frozen=True)
class _State:
    """The mix after some steps: expected tokens by domain, second moments of the posteriors with a
    rate above 0, and how far the last step moved any rate."""

    totals: np.ndarray
    active: np.ndarray
    moved: float


def _measure(steps: list[np.ndarray], k: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, moved = np.zeros(k + k * k), 0.0
        for batch in batches:
            p = batch.column("posterior").flatten().to_numpy().reshape(-1, k) / GRID
            t = batch.column("tokens").to_numpy().astype(float)
            rate = before = np.ones(len(p))
            for step in steps:
                before, rate = rate, np.maximum(0, rate - p @ step)
            total[:k] += (rate * t) @ p
            some = rate > 0
            total[k:] += ((p[some] * t[some, None]).T @ p[some]).ravel()
            moved = max(moved, np.abs(rate - before).max(initial=0.0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k + k * k)), pa.array(total), pa.array(np.full(k + k * k, moved))],
            ["at", "total", "moved"])
    return run


def _state(mass: DataFrame, steps: list[np.ndarray], k: int) -> _State:
    rows = mass.mapInArrow(_measure(steps, k), "at long, total double, moved double").groupBy("at").agg(
        F.sum("total").alias("total"), F.max("moved").alias("moved")).orderBy("at").collect()
    total = np.array([r.total for r in rows] or [0.0] * (k + k * k))
    return _State(total[:k], total[k:].reshape(k, k), max((r.moved for r in rows), default=0.0))


def fit_rates(mass: DataFrame, targets: np.ndarray) -> list[np.ndarray]:
    """The projected steps for ``mass`` (posterior, tokens) and token targets by domain.

    Gradient steps alternate with steps in the metric of the rates that aren't 0, which are kept
    if they lessen the misfit; these save most of the gradient steps. The fit ends when a gradient
    step moves no rate by more than ``TOLERANCE``: there the projected gradient is 0, which
    is the optimum, whether the targets can be reached or not.
    """
    k = len(targets)
    now = _state(mass, [], k)
    metric = np.linalg.pinv(now.active, rcond=1e-9, hermitian=True)

    def misfit(state: _State) -> float:
        return float((state.totals - targets) @ metric @ (state.totals - targets))

    steps: list[np.ndarray] = []
    for _ in range(ITERATIONS):
        steps.append(metric @ (now.totals - targets))
        now = _state(mass, steps, k)
        if now.moved <= TOLERANCE:
            break
        inner = now.active @ metric
        step = np.linalg.pinv(inner @ now.active, rcond=1e-9, hermitian=True) @ inner @ (now.totals - targets)
        ahead = _state(mass, [*steps, step], k)
        if misfit(ahead) < misfit(now):
            steps.append(step)
            now = ahead
    return steps


def _totals(rate: Column, domains: int) -> list[Column]:
    """Expected tokens by domain at a rate."""
    return [F.sum(rate * F.col("tokens") * (F.col("posterior")[i] / GRID)) for i in range(domains)]


@dataclass(frozen=True)
class Mix:
    """The steps to the rates, with wanted and reached tokens by domain."""

    steps: tuple[np.ndarray, ...]
    wanted: dict[str, float]
    reached: dict[str, float]

    def rate(self, posterior: Column) -> Column:
        return _rate(posterior, list(self.steps))


def fit_mix(mass: DataFrame, domains: tuple[str, ...], weights: dict[str, float] | None = None,
            tokens: float | None = None) -> Mix:
    """The mix of ``mass`` (posterior, tokens) for target weights, by default the production targets."""
    if any(w < 0 for w in (weights or {}).values()):
        raise ValueError("a target weight is negative")
    size = mass.agg(F.sum("tokens")).first()[0] or 0
    targets = target_totals(mass, domains, weights, tokens or size) if size else None
    if targets is None:
        return Mix((), {}, {})
    steps = fit_rates(mass, targets)
    reached = mass.agg(*_totals(_rate(F.col("posterior"), steps), len(domains))).first()
    return Mix(tuple(steps), dict(zip(domains, targets.tolist(), strict=True)),
               dict(zip(domains, map(float, reached), strict=True)))


def target_totals(mass: DataFrame, domains: tuple[str, ...], weights: dict[str, float] | None,
                  size: float) -> np.ndarray | None:
    """Token targets by domain for ``mass``, ``size`` in all; None if nothing is asked for."""
    if not domains:
        return None
    p = [F.col("posterior")[i] / GRID for i in range(len(domains))]

    def totals(rows: DataFrame) -> np.ndarray:
        return np.array([x or 0.0 for x in rows.agg(*(F.sum(F.col("tokens") * x) for x in p)).first()])

    if weights is None:
        toxic = sum((x for x, d in zip(p, domains, strict=True) if d.endswith(TOXIC)), F.lit(0.0))
        share = totals(mass.where(toxic < 0.5))
        return share * (size / share.sum()) if share.sum() else share
    share = totals(mass)
    share /= share.sum()
    listed = np.array([d in weights for d in domains])
    wanted = np.array([weights.get(d, 0.0) for d in domains])
    share[listed] = wanted[listed] * (share[listed].sum() / wanted.sum() if wanted.sum() else 0.0)
    return share / share.sum() * size if share.sum() else None


def scored_documents(docs: DataFrame, model: DomainModel, keep: list[str]) -> DataFrame:
    """doc (a struct of ``keep``), tokens and posterior (an array in steps of 1 / GRID) of every row.

    Without the text among ``keep`` the scores are written, a few dozen bytes a row, so that no text
    is scored twice; with it they are scored at each use, and no text is written.
    """
    kept = StructType([docs.schema[c] for c in keep])
    added = [StructField("tokens_", LongType()), StructField("posterior_", ArrayType(LongType()))]
    wanted = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*wanted).mapInArrow(
        _with_posteriors(model, keep), StructType([*kept.fields, *added]))
    rows = rows.select(F.struct(*keep).alias("doc"), F.col("tokens_").alias("tokens"),
                       F.col("posterior_").alias("posterior"))
    return rows if "text" in keep else written(rows, "scored")


def posterior_mass(rows: DataFrame) -> DataFrame:
    """Tokens by distinct posterior, written."""
    return written(rows.groupBy("posterior").agg(F.sum("tokens").alias("tokens")), "mass")


def _copies(rate: Column) -> Column:
    chance = F.pmod(F.xxhash64("doc.doc_id"), F.lit(1 << 52)) / float(1 << 52)
    return F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")


def mixing_rates(docs: DataFrame, model: DomainModel, weights: dict[str, float] | None = None,
                 tokens: float | None = None, keep: list[str] | None = None) -> DataFrame:
    """doc (a struct of ``keep``, doc_id if not given), n_words, posterior, rate and copies.

    ``weights`` are shares of the mix by domain, by default the production targets. ``tokens`` is the
    size of the mix, by default that of the input. posterior is a map by domain.
    """
    rows = scored_documents(docs, model, keep or ["doc_id"])
    rate = fit_mix(posterior_mass(rows), model.domains, weights, tokens).rate(F.col("posterior"))
    named = F.map_from_arrays(F.array(*(F.lit(d) for d in model.domains)).cast("array<string>"),
                              F.transform("posterior", lambda p: p / GRID))
    return rows.withColumn("rate", rate).select(
        "doc", F.col("tokens").alias("n_words"), named.alias("posterior"), "rate",
        _copies(F.col("rate")).alias("copies"))


def label_domains(labels: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, domain): the labelled document's language, with "/toxic" where so labelled."""
    return (labels.select("doc_id", "toxic").where("toxic IS NOT NULL")
            .join(docs.select("doc_id", "lang"), "doc_id")
            .select("doc_id", F.when(F.col("toxic") == 1, F.concat("lang", F.lit(TOXIC)))
                    .otherwise(F.col("lang")).alias("domain")))


@any_names
def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None
                    ) -> DataFrame:
    """The rows of ``docs`` with at least one copy, with mix_rate and mix_copies."""
    model = fit_domains(docs, label_domains(labels, docs))
    found = mixing_rates(docs, model, weights, keep=docs.columns)
    return found.where("copies > 0").select(
        "doc.*", F.col("rate").alias("mix_rate"), F.col("copies").alias("mix_copies"))


def _posterior_columns(domains: tuple[str, ...]) -> list[Column]:
    """A column p_ for each domain; names that differ in case or slashes only get a number."""
    names: dict[str, str] = {}
    for d in domains:
        name, n = f"p_{d}".replace("/", "_"), 1
        while name.lower() in names:
            n += 1
            name = f"p_{d}_{n}".replace("/", "_")
        names[name.lower()] = name
    return [(F.col("posterior")[i] / GRID).alias(name) for i, name in enumerate(names.values())]


def even_weights(wanted: dict[str, float]) -> dict[str, float]:
    """Stated weights of the query's second mix: the production targets with the clean domains' tokens
    dealt to them in equal parts."""
    clean = [d for d in wanted if not d.endswith(TOXIC)]
    each = sum(wanted[d] for d in clean) / max(len(clean), 1)
    return {d: each if d in clean else w for d, w in wanted.items()}


def op3_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Posteriors by learned domain of every row of ``documents``, and two mixes of the input's size.

    ``rate`` and ``copies`` are for the production targets, ``even_rate`` and ``even_copies`` for
    :func:`even_weights`. ``domain`` is the row's likeliest domain, with the tokens that each mix
    wanted of it and reached (null without domains).
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_domains(docs, label_domains(labels, docs))
    rows = scored_documents(docs, model, ["doc_id"])
    mass = posterior_mass(rows)
    production = fit_mix(mass, model.domains)
    mixes = {"": production,
             "even_": fit_mix(mass, model.domains, even_weights(production.wanted))}
    names = F.array(*(F.lit(d) for d in model.domains)).cast("array<string>")
    likeliest = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))

    def of_domain(totals: dict[str, float]) -> Column:
        known = F.from_json(F.lit(json.dumps(totals)), "map<string,double>")
        return F.try_element_at(known, F.col("domain"))

    rows = rows.withColumn("domain", likeliest)
    rows = rows.withColumns({f"{k}rate": m.rate(F.col("posterior")) for k, m in mixes.items()})
    return rows.select(
        "doc.doc_id", F.col("tokens").alias("n_words"),
        *_posterior_columns(model.domains), "domain",
        *(c for k, m in mixes.items() for c in (
            F.col(f"{k}rate"), _copies(F.col(f"{k}rate")).alias(f"{k}copies"),
            of_domain(m.wanted).alias(f"{k}wanted"), of_domain(m.reached).alias(f"{k}reached"))))
