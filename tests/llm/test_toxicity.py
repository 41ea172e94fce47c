"""The toxicity network: gradients, windows, planted insults, held-out labels."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import toxicity_gru as tg
from marketlake.llm._text import ALNUM_WORD, Words
from tests.conftest import SF_MED
from tests.llm.corpus import documents, odd_rows, prose, rows

INSULTS = ["idiot", "moron", "scum"]
STEMS = ["blork", "zwanz"]


def planted(rng, n, first=1):
    """Clean and toxic texts: insult words, or stems with endings that are new each time."""
    texts, toxic = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 90), 300).split()
        label = i % 4 == 0
        for _ in range(rng.randrange(1, 4) if label else 0):
            new = rng.choice(STEMS) + str(rng.randrange(10 ** 6))
            words.insert(rng.randrange(len(words)), rng.choice([rng.choice(INSULTS), new]))
        texts.append(" ".join(words))
        toxic.append(int(label))
    return rows(texts, first), [(first + i, None, t) for i, t in enumerate(toxic)]


@pytest.fixture(scope="module")
def model(spark):
    data, labels = planted(random.Random(1), 500)
    return tg.fit_toxicity(documents(spark, data, extra=True), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"), steps=200)


def test_planted_insults_are_found(spark, model):
    data, labels = planted(random.Random(2), 200, 1000)
    truth = {i: t for i, _, t in labels}
    found = tg.toxicity_scores(documents(spark, data), model).collect()
    wrong = [r.doc_id for r in found if (r.score >= tg.THRESHOLD) != truth[r.doc_id]]
    assert len(found) == 200 and len(wrong) <= 4


def test_an_insult_is_found_anywhere_in_a_long_text(model):
    words = prose(random.Random(3), 5000, 300).split()
    clean, first, last = " ".join(words), " ".join(["idiot", *words]), " ".join([*words, "Moron!"])
    scores = model.scores(pa.array([clean, first, last]))
    assert scores[0] < tg.THRESHOLD <= min(scores[1:])


def test_scores_do_not_depend_on_the_slice(model):
    rng = random.Random(4)
    texts = [prose(rng, n, 300) for n in (1, 15, 16, 17, 31, 32, 33, 48, 49, 200, 3000)]
    texts += [None, "", " .,", "idiot", "été idiot"]
    whole = model.scores(pa.array(texts))
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert whole == pytest.approx(alone, abs=1e-5)
    assert (whole[11:14] == model.share).all()


def test_windows_cover_every_word():
    n = np.array([0, 1, 31, 32, 33, 48, 49, 100])
    text, start = tg.window_starts(n)
    for t, size in enumerate(n):
        own = start[text == t]
        seen = {w for s in own for w in range(s, min(s + tg.WINDOW, size))}
        assert seen == set(range(size)) and all(s < size for s in own)
        assert (np.diff(own) == tg.STRIDE).all()


def examples(rng):
    size = np.array([32, 5, 32, 20, 1])
    inside = np.arange(tg.WINDOW) < size[:, None]
    count = rng.integers(0, 3, inside.shape) * inside
    return tg.Examples(np.array([1, 1, 2, 2, 3]), np.array([1, 1, 0, 0, 1]), size,
                       rng.integers(0, 6, inside.shape) * inside, rng.random(inside.shape) * inside,
                       rng.random(inside.shape) * inside, rng.integers(0, 5, count.sum()), count)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    data, net = examples(rng), tg.new_network(5, 4, rng)
    texts = np.arange(3)
    grad = tg.loss_gradients(net, data, texts)
    assert grad.keys() == net.keys()
    for name, value in net.items():
        if name in ("words", "runs"):
            places = [(1, 0), (3, 2)]
        else:
            places = [tuple(rng.integers(0, s) for s in value.shape) for _ in range(4)]
        for place in places:
            sides = []
            for change in (0.01, -0.01):
                moved = value.copy()
                moved[place] += change
                sides.append(tg._loss(net | {name: moved}, data, texts))
            assert grad[name][place] == pytest.approx((sides[0] - sides[1]) / 0.02, abs=2e-3), name


def test_runs_of_words():
    words = Words(pa.array(["a Idiot été"]), ALNUM_WORD, lower=True)
    keys, bounds = tg.char_runs(words, np.arange(3))
    text = [int(k).to_bytes(4, "big") for k in keys]
    assert text[:bounds[1]] == [b"^a$\0"]
    assert text[bounds[1]:bounds[2]] == [b"^idi", b"idio", b"diot", b"iot$"]
    marked = "^été$".encode()
    assert text[bounds[2]:] == [marked[i:i + 4] for i in range(len(marked) - 3)]


def test_a_shared_passage_counts_once(spark):
    passage = "one two three four five six seven"
    learn = spark.createDataFrame([(1, f"{passage} {i}") for i in range(5)] + [(0, f"seven {i}") for i in range(9)],
                                  "toxic int, text string")
    found = learn.mapInArrow(tg._contexts, "kind int, key long, context long, toxic int").where("kind = 0") \
        .distinct().groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
    counts = {r.key: (r.toxic, r.other) for r in found.collect()}
    h = Words(pa.array([passage]), ALNUM_WORD, lower=True).hashes().view(np.int64).tolist()
    assert counts[h[2]] == (1, 0) and counts[h[6]] == (5, 9)


def test_own_label_is_left_out_of_evidence():
    words = tg.Vocabulary(np.array([5, 9], np.uint64), np.array([3, 0]), np.array([0, 4]))
    whole, own = words.evidence((10, 90)), words.evidence((10, 90), 1)
    less = tg.Vocabulary(words.keys, np.array([2, 0]), words.other).evidence((9, 90))
    assert own == pytest.approx(less) and whole[1] > own[1] > 0 > own[2] and whole[0] == 0
    assert words.place(np.array([9, 1, 5, 99], np.uint64)).tolist() == [2, 0, 1, 0]


def test_odd_rows(spark, model):
    data = odd_rows()
    found = tg.toxicity_scores(documents(spark, data, extra=True), model).collect()
    assert sorted((str(r.doc_id) for r in found)) == sorted(str(r[0]) for r in data)
    assert all(0 <= r.score <= 1 for r in found)
    assert tg.toxicity_scores(documents(spark, []), model).collect() == []


def test_nothing_to_learn(spark):
    docs = documents(spark, rows(["a", None, "b c"]))
    blank = documents(spark, rows(["", " . ", "!"]))
    for data in ([], [(1, 0, 1), (2, 1, None), (3, 0, 1), (9, 0, 0), (None, 0, 0)]):
        labels = spark.createDataFrame(data, "doc_id long, quality int, toxic int")
        model = tg.fit_toxicity(docs, labels)
        assert len({r.score for r in tg.toxicity_scores(docs, model).collect()}) == 1
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 4)], "doc_id long, quality int, toxic int")
    assert tg.fit_toxicity(blank, labels).net is None


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF_MED}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MED}/labels.parquet")
    found = tg.op13_toxicity(spark, SF_MED)
    assert found.count() == docs.count()
    held = found.where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    clean = [r for r in held if r.toxic == 0]
    english = [r for r in held if r.toxic == 1 and r.lang == "en"]
    assert len(english) > 5 and sum(r.predicted for r in english) >= 0.9 * len(english)
    assert sum(r.predicted for r in clean) <= 0.1 * len(clean)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in held)
