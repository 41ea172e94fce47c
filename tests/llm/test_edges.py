"""Every operator over odd rows, empty tables and clashing extra columns; the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import (
    catalog,
    decontamination,
    embedding_dedup,
    language_id,
    license_scan,
    mixing,
    quality_gam,
    secret_scan,
    simhash_dedup,
    substring_dedup,
)
from marketlake.llm._store import written
from tests.conftest import SF_SMALL
from tests.llm.corpus import documents, odd_rows
from tests.llm.test_pairs import contamination, simhash
from tests.llm.test_scans import base_spans

LABELS = "doc_id long, quality int, toxic int"


def items(spark):
    return spark.createDataFrame([(1, "an id twice"), (2, None), (None, "the same row"), (3, "")],
                                 "item_id long, text string")


def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (4, 1, None), (5, None, 1), (None, 0, 1), (8, 1, 0), (8, 0, 1),
         (9, 0, 0), (11, 0, 1), (77, 1, 1)], LABELS)


OPERATORS = {
    "decontamination": lambda s, d: decontamination.contaminated_words(d, items(s)),
    "substring": lambda s, d: substring_dedup.substring_dedup(d, longest=True),
    "mixing": lambda s, d: mixing.mixing_rates(
        d, mixing.fit_domains(d, mixing.label_domains(labels(s), d))),
    "quality": lambda s, d: quality_gam.quality_scores(d, quality_gam.fit_quality(d, labels(s))),
    "simhash": lambda s, d: simhash_dedup.simhash_components(d),
    "secrets": lambda s, d: secret_scan.secret_spans(d),
    "languages": lambda s, d: language_id.predict_languages(d, language_id.fit_language_codes(d)),
    "licenses": lambda s, d: license_scan.license_labels(d),
}
STAGES = {
    "decontamination": lambda s, d: decontamination.clean_documents(d, items(s)),
    "mixing": lambda s, d: mixing.mixed_documents(d, labels(s)),
    "quality": lambda s, d: quality_gam.good_documents(d, quality_gam.fit_quality(d, labels(s))),
    "simhash": lambda s, d: simhash_dedup.near_duplicates_removed(d),
    "secrets": lambda s, d: secret_scan.redacted(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_give_one_row_each(spark, name):
    data = odd_rows()
    plain = OPERATORS[name](spark, documents(spark, data)).collect()
    assert len(plain) == len(data)
    more = OPERATORS[name](spark, documents(spark, data, extra=True)).collect()
    assert sorted(map(repr, more)) == sorted(map(repr, plain))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(spark, name):
    for data in (odd_rows(), []):
        docs = documents(spark, data, extra=True)
        found = STAGES[name](spark, docs)
        assert found.columns[:len(docs.columns)] == docs.columns
        assert found.count() <= len(data) and (data == [] or found.count() > 0)


def test_pipeline_over_odd_tables(spark, tmp_dir):
    """Nulls, repeated rows, no rows, and further columns of any name, through all stages."""
    for k, data in enumerate((odd_rows(), [])):
        docs = documents(spark, data, extra=True)
        docs.write.parquet(f"{tmp_dir}/{k}/documents.parquet")
        labels(spark).write.parquet(f"{tmp_dir}/{k}/labels.parquet")
        items(spark).write.parquet(f"{tmp_dir}/{k}/benchmark.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_dir}/{k}")
        assert found.columns == [*docs.columns, "mix_rate_2", "mix_copies_2"]
        assert (found.count() > 0) == (data != [])


def test_embeddings_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.embedding_components(none).collect() == []


def test_odd_rows_of_simhash_match_brute_force(spark):
    data = odd_rows()
    found = simhash_dedup.simhash_components(documents(spark, data)).collect()
    assert sorted((r.doc_id or 0, r.fp & (1 << 64) - 1) for r in found) == sorted(
        (k or 0, simhash(t)) for k, t, *_ in data)


def test_every_query_runs_over_its_whole_table(spark):
    tables = {"op9_embedding_dedup": "embeddings", "op10_warc": "pages"}
    for name, query in catalog.QUERIES.items():
        if name == "op11_embedding_whitening":  # a row per component: tests/llm/test_whitening.py
            continue
        table = spark.read.parquet(f"{SF_SMALL}/{tables.get(name, 'documents')}.parquet")
        found = written(query(spark, SF_SMALL), "found")
        key = table.columns[0]
        assert found.count() == table.count(), name
        assert found.select(key).exceptAll(table.select(key)).count() == 0, name


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF_SMALL), "stage"))
    raw, good, single, clean, masked, mixed = frames
    for frame in frames[:-1]:
        assert frame.columns == docs.columns
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    known = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    assert sum(known.get(i) == 0 for i in ids[1]) <= 2
    assert sum(known.get(i) == 1 for i in ids[0] - ids[1]) <= 2
    # near duplicates: of all pairs within the radius one side at most stays, nothing else goes
    prints = {r.doc_id: simhash(r.text) for r in good.collect()}
    kept = sorted(ids[2])
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for i, a in enumerate(kept) for b in kept[i + 1:])
    for gone in ids[1] - ids[2]:
        assert any((prints[gone] ^ p).bit_count() <= 3 for k, p in prints.items() if k != gone)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = contamination([tuple(r) for r in single.collect()], bench, 10)
    assert ids[3] == {k for k, _, hit, _ in want if not hit} and ids[3] != ids[2]
    assert ids[4] == ids[3]
    before = {r.doc_id: r.text for r in clean.collect()}
    for r in masked.collect():
        assert ("[REDACTED]" in r.text) >= bool(base_spans(before[r.doc_id]))
        assert not base_spans(r.text)
    assert {"mix_rate", "mix_copies"} <= set(mixed.columns)
    assert mixed.where(F.col("mix_copies") < 1).count() == 0
    result = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(result.collect()) == sorted(mixed.collect())
