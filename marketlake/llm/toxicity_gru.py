"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and characters.

A text is cut into overlapping windows of words. A word's input is a learned vector of the word, the mean
of learned vectors of its character runs (four bytes each, with marks at the word's ends), and
two evidence values: how much oftener learning texts with the word, or with its strongest run, were
toxic. Two gated recurrent layers read a window in both directions, attention weighs their
states, and the pooled state gives the window's logit. The greatest logit of a text's windows is the text's.

Learning takes at most ``SAMPLE`` labelled documents, those with the smallest hash of the id, one row of
each. Tasks count their words and runs by label; the ``VOCABULARY`` words and as many runs that
separate the labels best (likelihood ratio) are kept, others share the zero vector. Tasks then send the
``LEARNED_WINDOWS`` windows with most evidence of each document, where a document's own label is left out
of the counts, so that evidence weighs in learning as it does on unseen texts. The network is
trained in numpy on the driver, on these bounded windows, by Adam on the loss of each
document's greatest logit. Scoring reads every window of every whole text, in tasks.

Defined results: null and empty texts and texts without words get the smoothed share of toxic labels as
score. A label other than 0 and 1 or without a text is not learned from; a document with several labels
counts with the greatest, one with several texts with the least. Without both labels every text gets
the smoothed share of label 1. Very long texts are scored whole, a bounded number of windows at a
time. Every input row gives one output row; rows may repeat, empty tables give no rows. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm._store import written
from marketlake.llm._text import ALNUM_WORD, Words, mix, row_slices

SAMPLE = 10_000
VOCABULARY = 4096
LEAST_TEXTS = 3
#: texts' worth of doubt about a count
DOUBT = 4.0

WINDOW, STRIDE = 32, 16
LEARNED_WINDOWS = 3
WORD_DIMS, RUN_DIMS, STATE = 8, 6, 12
EVIDENCE_SCALE = 4.0

STEPS, BATCH, RATE, DECAY, DROPPED = 500, 64, 0.01, 1e-4, 0.1
#: steps between looks at the documents left out
LOOK = 25
#: windows that are scored at a time
BLOCK = 2048

THRESHOLD = 0.3
FOLDS, HELD = 4, 2

Array = np.ndarray


# --- words and character runs ------------------------------------------------------------------
def char_runs(words: Words, pick: Array) -> tuple[Array, Array]:
    """Runs of four bytes of the picked words, marked at both ends, and where each word's begin."""
    start, end = words.start[pick], words.end[pick]
    count = np.maximum(end - start - 1, 1)
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(first[-1]) - np.repeat(first[:-1], count) + np.repeat(start - 1, count)
    start, end = np.repeat(start, count), np.repeat(end, count)
    key = np.zeros(len(at), np.uint32)
    for k in range(4):
        place = at + k
        byte = words.data[np.clip(place, 0, max(len(words.data) - 1, 0))].astype(np.uint32)
        byte = np.where(place < start, 0x5E, np.where(place == end, 0x24, byte))
        key = key << np.uint32(8) | np.where(place > end, 0, byte).astype(np.uint32)
    return key, first


@dataclass(frozen=True)
class Vocabulary:
    """Sorted keys with the toxic and other learning texts that hold them. Place 0 is for the rest."""

    keys: Array
    toxic: Array
    other: Array

    def place(self, keys: Array) -> Array:
        at = np.searchsorted(self.keys, keys)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == keys[found]
        return np.where(found, at + 1, 0)

    def evidence(self, texts: tuple[int, int], label: int | None = None) -> Array:
        """Log odds of each place against all (toxic, other) ``texts``, less a text with ``label``."""
        own = np.array([label == 1, label == 0], float)
        total = np.array(texts, float) - own
        share = (total[0] + 1) / (total.sum() + 2)
        odds = np.log((np.maximum(self.toxic - own[0], 0) + DOUBT * share) /
                      (np.maximum(self.other - own[1], 0) + DOUBT * (1 - share)))
        return np.concatenate(([0.0], odds - np.log(share / (1 - share)))) / EVIDENCE_SCALE


@dataclass(frozen=True)
class Lexicon:
    """What tasks need to turn words into inputs."""

    words: Vocabulary
    runs: Vocabulary
    texts: tuple[int, int]

    def read(self, words: Words, label: int | None = None) -> tuple[Array, ...]:
        """Distinct words: word places, both evidences, run places and their bounds; and the
        distinct word of each word."""
        h, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        place = self.words.place(h)
        runs, bounds = char_runs(words, first)
        at = self.runs.place(runs)
        of_run = self.runs.evidence(self.texts, label)[at]
        strongest = np.maximum.reduceat(of_run, bounds[:-1]) if len(first) else of_run[:0]
        return place, self.words.evidence(self.texts, label)[place], strongest, at, bounds, which


def window_starts(n: Array) -> tuple[Array, Array]:
    """The texts and first words of the windows of texts of ``n`` words."""
    count = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE


# --- the network -------------------------------------------------------------------------------
def new_network(words: int, runs: int, rng: np.random.Generator) -> dict[str, Array]:
    inputs, s = WORD_DIMS + RUN_DIMS + 2, STATE
    net = {"words": rng.normal(0, 0.05, (words + 1, WORD_DIMS)),
           "runs": rng.normal(0, 0.05, (runs + 1, RUN_DIMS)),
           "attend": rng.normal(0, 0.3, (2 * s, s)), "attend_bias": np.zeros(s),
           "focus": rng.normal(0, 0.3, s), "out": rng.normal(0, 0.3, 2 * s), "bias": np.zeros(1)}
    net["words"][0] = net["runs"][0] = 0
    for side in ("forth", "back"):
        net[f"{side}_in"] = rng.normal(0, 0.3, (inputs, 3 * s))
        net[f"{side}_state"] = rng.normal(0, 0.3, (s, 3 * s))
        net[f"{side}_bias"] = np.zeros(3 * s)
        net[f"{side}_bias"][:s] = 1  # keep the state at first
    return {k: v.astype(np.float32) for k, v in net.items()}


def _sigmoid(x: Array) -> Array:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _read(gates: Callable[[int], Array], state: Array, mask: Array, order: range,
          trace: list | None) -> Array:
    """States (windows, words, STATE) of a recurrent layer that reads words in ``order``."""
    n, s = mask.shape[0], STATE
    h, out = np.zeros((n, s), np.float32), np.empty((mask.shape[1], n, s), np.float32)
    for t in order:
        given, own = gates(t), h @ state
        both = _sigmoid(given[:, :2 * s] + own[:, :2 * s])
        keep, reset = both[:, :s], both[:, s:]
        new = np.tanh(given[:, 2 * s:] + reset * own[:, 2 * s:])
        m = mask[:, t:t + 1]
        if trace is not None:
            trace.append((t, h, keep, reset, new, own[:, 2 * s:]))
        h = h + m * (1 - keep) * (new - h)
        out[t] = h
    return out


def run_network(net: dict, forth: Callable, back: Callable, mask: Array, trace: dict | None = None
                ) -> Array:
    """The logit of each window; ``forth(t)`` and ``back(t)`` give the inputs' share of the gates."""
    width = mask.shape[1]
    steps = {"forth": [], "back": []} if trace is not None else {"forth": None, "back": None}
    h = np.concatenate([
        _read(forth, net["forth_state"], mask, range(width), steps["forth"]),
        _read(back, net["back_state"], mask, range(width - 1, -1, -1), steps["back"])], axis=2)
    seen = np.tanh(h @ net["attend"] + net["attend_bias"])
    weight = seen @ net["focus"]
    weight = np.where(mask.T > 0, weight, -np.inf)
    weight = np.exp(weight - weight.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = (weight[:, :, None] * h).sum(axis=0)
    if trace is not None:
        trace |= {"steps": steps, "h": h, "seen": seen, "weight": weight, "pooled": pooled}
    return pooled @ net["out"] + net["bias"][0]


def gradients(net: dict, mask: Array, x: Array, trace: dict, d_logit: Array) -> tuple[dict, Array]:
    """Gradients of the weights, and of the inputs ``x`` (windows, words, inputs)."""
    s, h, weight = STATE, trace["h"], trace["weight"]
    grad = {"bias": d_logit.sum(keepdims=True), "out": trace["pooled"].T @ d_logit}
    d_pooled = d_logit[:, None] * net["out"]
    d_weight = np.einsum("tnk,nk->tn", h, d_pooled)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grad["focus"] = np.einsum("tns,tn->s", trace["seen"], d_score)
    d_seen = d_score[:, :, None] * net["focus"] * (1 - trace["seen"] ** 2)
    grad["attend"] = np.einsum("tnk,tns->ks", h, d_seen)
    grad["attend_bias"] = d_seen.sum(axis=(0, 1))
    d_h = weight[:, :, None] * d_pooled + d_seen @ net["attend"].T
    d_x = np.zeros_like(x)
    for side, part in (("forth", slice(0, s)), ("back", slice(s, 2 * s))):
        d_in, d_state = np.zeros_like(net[f"{side}_in"]), np.zeros_like(net[f"{side}_state"])
        d_bias, carried = np.zeros(3 * s, np.float32), np.zeros((len(mask), s), np.float32)
        for t, before, keep, reset, new, own in reversed(trace["steps"][side]):
            d = carried + d_h[t][:, part]
            m = mask[:, t:t + 1]
            d_new = d * m * (1 - keep) * (1 - new ** 2)
            d_keep = -d * m * (new - before) * keep * (1 - keep)
            d_reset = d_new * own * reset * (1 - reset)
            given = np.concatenate([d_keep, d_reset, d_new], axis=1)
            inner = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
            d_state += before.T @ inner
            d_in += x[:, t].T @ given
            d_bias += given.sum(axis=0)
            d_x[:, t] += given @ net[f"{side}_in"].T
            carried = d * (1 - m * (1 - keep)) + inner @ net[f"{side}_state"].T
        grad |= {f"{side}_in": d_in, f"{side}_state": d_state, f"{side}_bias": d_bias}
    return grad, d_x


def _word_inputs(net: dict, place: Array, word_evidence: Array, run_evidence: Array, runs: Array,
                 bounds: Array) -> Array:
    """Inputs of words: their vector, the mean vector of their known runs, both evidences."""
    owner = np.repeat(np.arange(len(place)), np.diff(bounds))
    known = runs > 0
    owner, runs = owner[known], runs[known]
    mean = np.zeros((len(place), RUN_DIMS), np.float32)
    size = np.maximum(np.bincount(owner, minlength=len(place)), 1)
    for k in range(RUN_DIMS):
        mean[:, k] = np.bincount(owner, net["runs"][runs, k], len(place)) / size
    return np.concatenate([net["words"][place], mean, word_evidence[:, None], run_evidence[:, None]],
                          axis=1).astype(np.float32)


@dataclass(frozen=True)
class Examples:
    """Windows to learn from, in the order of their documents. Word arrays are (windows, WINDOW)."""

    document: Array
    toxic: Array
    size: Array
    place: Array
    word_evidence: Array
    run_evidence: Array
    runs: Array
    run_count: Array

    @cached_property
    def begin(self) -> Array:
        """The first window of each document."""
        return np.flatnonzero(np.concatenate(([True], self.document[1:] != self.document[:-1])))

    @cached_property
    def run_begin(self) -> Array:
        """The first run of each word."""
        return np.concatenate(([0], np.cumsum(self.run_count.ravel())[:-1]))

    def windows(self, texts: Array) -> tuple[Array, Array]:
        """The windows of some documents, and which of these they belong to."""
        end = np.concatenate((self.begin[1:], [len(self.document)]))[texts]
        rows = np.concatenate([np.arange(b, e) for b, e in zip(self.begin[texts], end)])
        return rows, np.repeat(np.arange(len(texts)), end - self.begin[texts])


def _inputs(net: dict, data: Examples, rows: Array, drop: np.random.Generator | None = None):
    """Inputs (windows, WINDOW, inputs), mask, and the word and run places of some windows.

    With ``drop``, words are taken for unknown and evidence for absent at random.
    """
    cell = (rows[:, None] * WINDOW + np.arange(WINDOW)).ravel()
    count = data.run_count.ravel()[cell]
    bounds = np.concatenate(([0], np.cumsum(count)))
    runs = data.runs[np.arange(bounds[-1]) + np.repeat(data.run_begin[cell] - bounds[:-1], count)]
    keep = np.ones((3, len(cell))) if drop is None else drop.random((3, len(cell))) >= DROPPED
    place = data.place[rows].ravel() * keep[0].astype(np.int64)
    x = _word_inputs(net, place, data.word_evidence[rows].ravel() * keep[1],
                     data.run_evidence[rows].ravel() * keep[2], runs, bounds)
    mask = (np.arange(WINDOW) < data.size[rows][:, None]).astype(np.float32)
    return x.reshape(len(rows), WINDOW, -1), mask, place, runs, bounds


def _logits(net: dict, x: Array, mask: Array, trace: dict | None = None) -> Array:
    gates = {side: x @ net[f"{side}_in"] + net[f"{side}_bias"] for side in ("forth", "back")}
    return run_network(net, lambda t: gates["forth"][:, t], lambda t: gates["back"][:, t], mask, trace)


def _loss(net: dict, data: Examples, texts: Array) -> float:
    """Mean loss of whole documents, a block of them at a time."""
    total = 0.0
    for at in range(0, len(texts), 256):
        rows, text = data.windows(texts[at:at + 256])
        x, mask, *_ = _inputs(net, data, rows)
        highest = np.full(text[-1] + 1, -np.inf)
        np.maximum.at(highest, text, _logits(net, x, mask))
        label = data.toxic[data.begin[texts[at:at + 256]]]
        total += float(np.logaddexp(0, np.where(label == 1, -highest, highest)).sum())
    return total / max(len(texts), 1)


def loss_gradients(net: dict, data: Examples, texts: Array, drop: np.random.Generator | None = None
                   ) -> dict[str, Array]:
    """Gradients of the mean loss of some documents."""
    rows, text = data.windows(texts)
    x, mask, place, runs, bounds = _inputs(net, data, rows, drop)
    trace: dict = {}
    logit = _logits(net, x, mask, trace)
    highest = np.full(len(texts), -np.inf)
    np.maximum.at(highest, text, logit)
    d_logit = np.where(logit == highest[text], (_sigmoid(logit) - data.toxic[rows]) / len(texts), 0)
    grad, d_x = gradients(net, mask, x, trace, d_logit.astype(np.float32))
    d_x = d_x.reshape(len(place), -1)
    grad["words"], grad["runs"] = np.zeros_like(net["words"]), np.zeros_like(net["runs"])
    np.add.at(grad["words"], place, d_x[:, :WORD_DIMS])
    owner, known = np.repeat(np.arange(len(place)), np.diff(bounds)), runs > 0
    size = np.maximum(np.bincount(owner[known], minlength=len(place)), 1)
    np.add.at(grad["runs"], runs[known],
              (d_x[:, WORD_DIMS:-2] / size[:, None])[owner[known]].astype(np.float32))
    grad["words"][0] = grad["runs"][0] = 0
    return grad


def _trained(net: dict, data: Examples, texts: Array, test: Array, steps: int, fixed: set[str],
             rng: np.random.Generator) -> dict[str, Array]:
    """Weights after at most ``steps`` of Adam on ``texts``: those with the least loss on ``test``."""
    first = {k: np.zeros_like(v) for k, v in net.items()}
    second = {k: np.zeros_like(v) for k, v in net.items()}
    order, best, kept = np.empty(0, np.int64), _loss(net, data, test), net
    for step in range(1, steps + 1):
        while len(order) < BATCH:
            order = np.concatenate((order, rng.permutation(texts)))
        grad = loss_gradients(net, data, order[:BATCH], rng)
        order = order[BATCH:]
        norm = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
        rate, new = RATE * (1 - step / (steps + 1)) ** 0.5, dict(net)
        for k in grad.keys() - fixed:
            g = grad[k] * min(1, 1 / max(norm, 1e-9)) + DECAY * net[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            new[k] = (net[k] - rate * (first[k] / (1 - 0.9 ** step)) /
                      (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        new["words"][0] = new["runs"][0] = 0
        net = new
        if step % LOOK == 0 or step == steps:
            loss = _loss(net, data, test)
            if loss < best:
                best, kept = loss, net
    return kept


def train_network(data: Examples, words: int, runs: int, steps: int = STEPS) -> dict[str, Array]:
    """A network that is trained in two parts: with fixed word and run vectors, so that it learns
    from evidence first, then with all weights. Every fifth document is left out to choose the weights."""
    rng = np.random.default_rng(7)
    texts = rng.permutation(len(data.begin))
    fifth = np.arange(len(texts)) % 5 == 0
    test, texts = (texts[fifth], texts[~fifth]) if len(texts) > 4 else (texts, texts)
    net = new_network(words, runs, rng)
    for fixed in ({"words", "runs"}, set()):
        net = _trained(net, data, texts, test, steps // 2, fixed, rng)
    return net


# --- scoring -----------------------------------------------------------------------------------
@dataclass(frozen=True)
class Toxicity:
    """A trained network with its lexicon; without a network, the share of toxic labels alone."""

    share: float
    lexicon: Lexicon | None = None
    net: dict[str, Array] | None = None

    def scores(self, column: pa.Array) -> Array:
        """The score of each text of a string column."""
        words = Words(column, ALNUM_WORD, lower=True)
        out = np.full(words.rows, self.share)
        if self.net is None or not len(words):
            return out
        *inputs, which = self.lexicon.read(words)
        x = _word_inputs(self.net, *inputs)
        gates = [x @ self.net[f"{side}_in"] + self.net[f"{side}_bias"] for side in ("forth", "back")]
        n = np.diff(words.first)
        text, start = window_starts(n)
        highest = np.full(words.rows, -np.inf)
        for at in range(0, len(text), BLOCK):
            own, begin = text[at:at + BLOCK], start[at:at + BLOCK]
            size = np.minimum(n[own] - begin, WINDOW)
            width = int(size.max())
            mask = (np.arange(width) < size[:, None]).astype(np.float32)
            place = (words.first[own] + begin)[:, None] + np.arange(width)
            place = which[np.minimum(place, len(words) - 1)]
            logit = run_network(self.net, lambda t: gates[0][place[:, t]],
                                lambda t: gates[1][place[:, t]], mask)
            np.maximum.at(highest, own, logit)
        return np.where(n > 0, _sigmoid(highest), out)


def _least_context(keys: Array, rows: Array, context: Array) -> tuple[Array, ...]:
    """The distinct (key, row) pairs, each with the least of its contexts."""
    order = np.lexsort((context, keys, rows))
    keys, rows, context = keys[order], rows[order], context[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return keys[new], rows[new], context[new]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys (of words: kind 0, of runs: kind 1) of each learning text with label and a context.

    The context is a hash of neighbouring words, so a passage that many texts share tells no more
    about its words than one text does.
    """
    for batch in batches:
        for part in row_slices(batch):
            label = part.column("toxic").to_numpy()
            words = Words(part.column("text"), ALNUM_WORD, lower=True)
            runs, bounds = char_runs(words, np.arange(len(words)))
            row, h = words.row, words.hashes()
            around = np.concatenate(([np.uint64(0)], h, [np.uint64(0)]))
            beside = mix(around[:-2] * np.uint64(3) + around[2:])
            after = np.repeat(mix(h * np.uint64(3) + around[2:]), np.diff(bounds))
            for kind, keys, rows, context in (
                    (0, h, row, beside),
                    (1, runs.astype(np.uint64), np.repeat(row, np.diff(bounds)), after)):
                keys, rows, context = _least_context(keys, rows, context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)),
                     pa.array(context.view(np.int64)), pa.array(label[rows].astype(np.int32))],
                    ["kind", "key", "context", "toxic"])


def _telling(counts: DataFrame, kind: int, texts: tuple[int, int]) -> Vocabulary:
    """The keys whose counts tell the labels apart best, at most ``VOCABULARY``."""
    n = F.col("toxic") + F.col("other")
    share = texts[0] / sum(texts)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = part(F.col("toxic"), n * share) + part(F.col("other"), n * (1 - share))
    rows = counts.where((F.col("kind") == kind) & (n >= LEAST_TEXTS)).orderBy(
        ratio.desc(), "key").limit(VOCABULARY).select("key", "toxic", "other").toArrow()
    keys = rows["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Vocabulary(keys[order], rows["toxic"].to_numpy()[order], rows["other"].to_numpy()[order])


def _window_rows(lexicon: Lexicon) -> Callable:
    """The windows with most evidence of each learning text."""
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("size", pa.int32()),
                        ("place", pa.list_(pa.int32())), ("word_evidence", pa.list_(pa.float32())),
                        ("run_evidence", pa.list_(pa.float32())), ("runs", pa.list_(pa.int32())),
                        ("run_count", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, label, text in zip(*(batch.column(c) for c in ("doc_id", "toxic", "text"))):
                words = Words(pa.array([text.as_py()], pa.string()), ALNUM_WORD, lower=True)
                if not len(words):
                    continue
                place, of_word, of_run, runs, bounds, which = lexicon.read(words, label.as_py())
                total = np.concatenate(([0], np.cumsum((of_word + of_run)[which])))
                start = window_starts(np.array([len(words)]))[1]
                end = np.minimum(start + WINDOW, len(words))
                for k in np.argsort(total[start] - total[end], kind="stable")[:LEARNED_WINDOWS]:
                    own = which[start[k]:end[k]]
                    at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in own])
                    rows.append((doc_id.as_py(), label.as_py(), len(own), place[own], of_word[own],
                                 of_run[own], runs[at], np.diff(bounds)[own]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
                                             if rows else [pa.array([], f.type) for f in schema],
                                             schema=schema)
    return run


def _padded(column: pa.ChunkedArray, kind: type) -> Array:
    out = np.zeros((len(column), WINDOW), kind)
    for i, values in enumerate(column):
        out[i, :len(values)] = values.values.to_numpy()
    return out


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, steps: int = STEPS
                 ) -> Toxicity:
    """Learn ``labels.toxic`` from at most ``sample`` labelled documents outside the held-out fold."""
    known = (labels.where((fold(F.col("doc_id")) != HELD) & F.col("toxic").isin(0, 1))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # the sample bounds the broadcast side and the texts that are written
    learn = written(docs.select("doc_id", "text").where("text IS NOT NULL").join(
        F.broadcast(written(known, "labels")), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("toxic").alias("toxic")), "learn")
    sizes = {r.toxic: r["count"] for r in learn.groupBy("toxic").count().collect()}
    texts = (sizes.get(1, 0), sizes.get(0, 0))
    share = (texts[0] + 1) / (sum(texts) + 2)
    if not all(texts):
        return Toxicity(share)
    counts = written(learn.select("toxic", "text").mapInArrow(
        _contexts, "kind int, key long, context long, toxic int").distinct().groupBy("kind", "key").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other")), "counts")
    lexicon = Lexicon(_telling(counts, 0, texts), _telling(counts, 1, texts), texts)
    found = learn.mapInArrow(_window_rows(lexicon), "doc_id long, toxic int, size int, place array<int>, "
                             "word_evidence array<float>, run_evidence array<float>, runs array<int>, "
                             "run_count array<int>").toArrow().sort_by("doc_id")
    if not found.num_rows:
        return Toxicity(share)
    data = Examples(*(found[c].to_numpy() for c in ("doc_id", "toxic", "size")),
                    _padded(found["place"], np.int32), _padded(found["word_evidence"], np.float32),
                    _padded(found["run_evidence"], np.float32),
                    found["runs"].combine_chunks().flatten().to_numpy(),
                    _padded(found["run_count"], np.int64))
    net = train_network(data, len(lexicon.words.keys), len(lexicon.runs.keys), steps)
    return Toxicity(share, lexicon, net)


def _score(model: Toxicity) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                yield part.select(["doc_id"]).append_column(
                    "score", pa.array(model.scores(part.column("text")).astype(float)))
    return run


def toxicity_scores(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _score(model), "doc_id long, score double")


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`toxicity_scores` over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_scores(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
