"""Learned operators: held-out accuracy, additive scores, decoding and target totals."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import language_id, mixing, quality_gam
from tests.conftest import SF_MED
from tests.llm.corpus import documents, prose, rows


def test_quality_on_held_out_labels(spark):
    found = quality_gam.op4_quality_classifier(spark, SF_MED)
    labels = spark.read.parquet(f"{SF_MED}/labels.parquet")
    held = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(f"{SF_MED}/documents.parquet").count()
    assert len(held) > 50
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in held)


def test_scores_add_up():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.8)  # needs a pair
    model = quality_gam.fit_gam(x, y.astype(float), cycles=10, pairs=2)
    assert (0, 1) in model.pairs
    b = model.bins(x)
    for i in (0, 7, 99):
        total = model.bias + sum(t[b[i, j]] for j, t in enumerate(model.tables))
        total += sum(t[b[i, j], b[i, k]] for (j, k), t in model.pairs.items())
        assert model.score(x)[i] == pytest.approx(1 / (1 + np.exp(-total)))
    fresh = rng.random((1500, 4))
    truth = ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)) | (fresh[:, 2] > 0.8)
    assert ((model.score(fresh) > 0.5) == truth).mean() > 0.9


def test_features_do_not_depend_on_the_slice():
    texts = ["A b! c | d\nA b! c | d", None, "", "é é é 12 %", "x" * 3000, "one two " * 50]
    whole = quality_gam.features(pa.array(texts))
    assert whole.shape == (6, len(quality_gam.FEATURES)) and np.isfinite(whole).all()
    for i, text in enumerate(texts):
        assert quality_gam.features(pa.array([text], pa.string()))[0] == pytest.approx(whole[i])


def test_quality_with_nothing_to_learn(spark):
    docs = documents(spark, rows(["a", None, "b c"]))
    for data in ([], [(1, 1, 0), (2, None, 1), (3, 1, 0), (9, 0, 0), (None, 0, 0)]):
        labels = spark.createDataFrame(data, "doc_id long, quality int, toxic int")
        model = quality_gam.fit_quality(docs, labels)
        scores = {r.score for r in quality_gam.quality_scores(docs, model).collect()}
        assert len(scores) == 1 and 0 < scores.pop() < 1


def test_quality_learns_one_row_of_an_id(spark):
    rng = random.Random(3)
    data = rows([prose(rng, 40) + "." if i % 2 else "!! " * rng.randrange(5, 30) for i in range(80)])
    labels = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(data)],
                                   "doc_id long, quality int, toxic int")
    once = quality_gam.fit_quality(documents(spark, data), labels)
    often = quality_gam.fit_quality(documents(spark, data + data[:1] * 60), labels)
    assert once.bias == often.bias and len(once.tables) == len(quality_gam.FEATURES)
    assert all((a == b).all() for a, b in zip(once.tables, often.tables, strict=True))


def test_languages_on_held_out_rows(spark):
    found = language_id.op7_language_id(spark, SF_MED).join(
        spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_codewords_are_apart():
    for n in range(2, 8):
        code = language_id.codewords(n)
        distance = [(a != b).sum() for i, a in enumerate(code) for b in code[i + 1:]]
        assert min(distance) == 2 ** (n - 2) and (np.abs(code.sum(axis=0)) < n).all()
    code = language_id.codewords(20)
    assert min((a != b).sum() for i, a in enumerate(code) for b in code[i + 1:]) >= 10


def test_decoding_mends_a_wrong_bit():
    code = language_id.codewords(4)
    model = language_id.LanguageModel(("a", "b", "c", "d"), code, np.zeros((1, 7)), np.full(7, 1 / 7))
    margin = code.copy()
    margin[:, 2] *= -1
    best, score, near = language_id.decode(margin, model)
    assert best.tolist() == [0, 1, 2, 3] and not near.any() and (score > 0.5).all()
    best, score, near = language_id.decode(np.zeros((1, 7)), model)
    assert near.all() and score[0] == pytest.approx(0.25)


def test_unknown_and_single_languages(spark):
    docs = documents(spark, rows(["aaa bbb", "1234 !", None, "", "ñ", "日本"]))
    for langs in ([], ["xx"], ["xx", "yy"]):
        train = spark.createDataFrame([("aaa bbb ccc", x) for x in langs] + [("z", None), (None, "q")],
                                      "text string, lang string")
        model = language_id.fit_language_codes(train)
        found = {r.doc_id: (r.lang_pred, r.score) for r in
                 language_id.predict_languages(docs, model).collect()}
        assert {k for k, v in found.items() if v == ("und", 0.0)} >= {2, 3, 4}
        if langs:
            assert found[1][0] in langs and found[6][0] in langs
        else:
            assert {v[0] for v in found.values()} == {"und"}


def test_a_language_without_letters_is_not_learned(spark):
    train = spark.createDataFrame([("aaa bbb ccc", "xx"), ("ddd eee", "yy"), ("123 456", "zxx"), ("", "zxx")],
                                  "text string, lang string")
    model = language_id.fit_language_codes(train)
    assert model.languages == ("xx", "yy") and np.isfinite(model.trust).all()


def test_trigrams_know_case_and_rows():
    upper, row = language_id.trigrams(pa.array(["ÉTÉ AB", "été ab", "", None, "b"]))
    by_row = [upper[row == r].tolist() for r in range(5)]
    assert by_row[0] == by_row[1] and len(by_row[0]) == 7 and by_row[2] == by_row[3] == []
    assert by_row[4] == language_id.trigrams(pa.array(["b"]))[0].tolist()


def mixing_corpus(spark, n=240):
    rng = random.Random(1)
    words = {"en": "the of and to", "de": "der die und zu", "en/toxic": "the of and idiot"}
    data, labels = [], []
    for i in range(n):
        kind = rng.choice(["en", "en", "en", "de", "en/toxic"])
        text = " ".join(rng.choices(words[kind].split(), k=rng.randrange(20, 60))) + " " + prose(rng, 20)
        data.append((i, text, kind[:2], "s", len(text)))
        labels.append((i, 1, int(kind.endswith("toxic"))))
    return documents(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rates_meet_the_targets(spark):
    docs, labels = mixing_corpus(spark)
    model = mixing.fit_domains(docs, mixing.label_domains(labels, docs))
    assert model.domains == ("de", "en", "en/toxic")
    weights = {"de": 0.4, "en": 0.59, "en/toxic": 0.01}
    found = mixing.mixing_rates(docs, model, weights, tokens=20_000).collect()
    assert all(r.rate >= 0 for r in found)
    for d, w in weights.items():
        total = sum(r.rate * r.n_words * r.posterior[d] for r in found)
        assert total == pytest.approx(20_000 * w, abs=20)
        copies = sum(r.copies * r.n_words * r.posterior[d] for r in found)
        assert copies == pytest.approx(20_000 * w, abs=1500)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in found)


def test_rates_solve_the_nonnegative_least_squares(spark):
    """The projected gradient against a dense one in numpy, where targets force zero rates."""
    rng = np.random.default_rng(2)
    p = np.rint(rng.dirichlet([0.3, 0.3, 0.3], 200) * 1000)
    t = rng.integers(1, 50, 200)
    mass = spark.createDataFrame([(x.astype(int).tolist(), int(n)) for x, n in zip(p, t, strict=True)],
                                 "posterior array<long>, tokens long")
    targets = np.array([0.0, 500.0, 9000.0])
    steps = mixing.fit_rates(mass, targets)
    got = [r[0] for r in mass.select(mixing._rate(F.col("posterior"), steps)).collect()]
    a = (p / 1000 * t[:, None]).T
    metric = np.linalg.inv((p / 1000).T @ (p / 1000 * t[:, None]))
    r = np.ones(200)
    for _ in range(20_000):
        r = np.maximum(0, r - (p / 1000) @ (metric @ (a @ r - targets)))

    def misfit(x):
        gap = a @ np.array(x) - targets
        return gap @ metric @ gap

    assert misfit(got) <= misfit(r) + 0.01 * misfit(np.ones(200))
    assert min(got) == 0


def test_toxic_documents_leave_the_mix(spark):
    docs, labels = mixing_corpus(spark)
    kept = {r.doc_id for r in mixing.mixed_documents(docs, labels).collect()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()}
    assert len(kept & toxic) <= 0.2 * len(toxic) and len(clean - kept) <= 0.05 * len(clean)


def test_two_mixes_reach_what_they_want(spark, tmp_dir):
    docs, labels = mixing_corpus(spark)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    found = mixing.op3_source_mixing(spark, tmp_dir).collect()
    size = sum(r.n_words for r in found)
    for k in ("", "even_"):
        for d, p in (("de", "p_de"), ("en", "p_en"), ("en/toxic", "p_en_toxic")):
            own = [r for r in found if r.domain == d]
            total = sum(r[f"{k}rate"] * r.n_words * r[p] for r in found)
            assert all(r[f"{k}reached"] == pytest.approx(total) for r in own)
            assert total == pytest.approx(own[0][f"{k}wanted"], abs=0.02 * size)
    wanted = {r.domain: (r.wanted, r.even_wanted) for r in found}
    assert wanted["de"][1] == pytest.approx(wanted["en"][1]) and wanted["de"][0] < 0.8 * wanted["en"][0]
    assert wanted["en/toxic"][0] == pytest.approx(wanted["en/toxic"][1])


def lopsided_corpus(spark, n=600):
    """90% of one language, a fifth language, and a few toxic documents."""
    rng = random.Random(3)
    words = {"en": "the of and to", "de": "der die und zu", "es": "el los y que", "fr": "le les et qui",
             "it": "il gli e che"}
    data, labels = [], []
    for i in range(n):
        lang = "en" if i % 10 else ["de", "es", "fr", "it"][i // 10 % 4]
        toxic = lang == "en" and i % 12 == 1
        own = words[lang] + (" idiot idiot moron" if toxic else "")
        text = " ".join(rng.choices(own.split(), k=rng.randrange(30, 60))) + " " + prose(rng, 10)
        data.append((i, text, lang, "s", len(text)))
        labels.append((i, 1, int(toxic)))
    return documents(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_a_lopsided_corpus_keeps_its_clean_documents(spark, tmp_dir):
    docs, labels = lopsided_corpus(spark)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    found = {r.doc_id: r for r in mixing.op3_source_mixing(spark, tmp_dir).collect()}
    toxic = {r.doc_id for r in labels.where("toxic = 1").collect()}
    italian = {r.doc_id for r in docs.where("lang = 'it'").collect()}
    clean = [r for k, r in found.items() if k not in toxic]
    assert sum(r.copies >= 1 for r in clean) >= 0.99 * len(clean)
    assert sum(found[k].copies >= 1 for k in toxic) <= 0.1 * len(toxic)
    assert all(found[k].p_it > 0.9 and found[k].copies >= 1 for k in italian) and italian
    size = sum(r.n_words for r in found.values())
    assert sum(r.rate * r.n_words for r in found.values()) == pytest.approx(size, rel=0.01)


def test_a_domain_without_a_weight_keeps_its_share(spark):
    mass = spark.createDataFrame([([1000, 0, 0], 60), ([0, 1000, 0], 30), ([0, 0, 1000], 10)],
                                 "posterior array<long>, tokens long")
    names = ("a", "b", "c")
    assert mixing.target_totals(mass, names, {"a": 1, "b": 2}, 200).tolist() == pytest.approx([60, 120, 20])
    assert mixing.target_totals(mass, names, {"z": 1}, 100).tolist() == pytest.approx([60, 30, 10])
    assert mixing.target_totals(mass, names, dict.fromkeys(names, 0.0), 100) is None
    names = ("a", "a/toxic", "b/toxic")
    assert mixing.target_totals(mass, names, None, 100).tolist() == pytest.approx([100, 0, 0])


def test_nothing_to_mix_by(spark):
    docs = documents(spark, rows(["a b", None]))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = mixing.mixed_documents(docs, none).collect()
    assert {(r.doc_id, r.mix_rate, r.mix_copies) for r in found} == {(1, 1.0, 1), (2, 1.0, 1)}
    with pytest.raises(ValueError, match="negative"):
        mixing.mixed_documents(docs, none, {"en": -1.0})


def test_features_are_chosen_for_the_likest_domain_too():
    rows_ = np.array([100.0, 100.0, 50.0])
    counts = np.zeros((4, 3))
    counts[0], counts[1], counts[2], counts[3] = [90, 0, 45], [0, 90, 0], [2, 2, 40], [50, 50, 25]
    assert mixing.choose_features(counts, rows_, 1).tolist() == [1, 2]
