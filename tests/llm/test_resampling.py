"""Importance resampling against a plain version and against its SQL."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from marketlake.llm import importance_resampling as ir
from marketlake.llm.catalog import ORACLE
from tests.conftest import SF_SMALL
from tests.llm.corpus import WORD, documents, lower, odd_rows, prose, rows


def grams(text, longest, buckets):
    words = WORD.findall(lower(text))
    return [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets
            for n in range(1, longest + 1) for i in range(len(words) - n + 1)], len(words)


def plain_version(data, target, longest, buckets, percent, least):
    """(doc_id, n_words, n_features, weight, score, rank) of every row, by plain loops."""
    s = Counter(b for _, t in data for b in grams(t, longest, buckets)[0])
    q = Counter(b for t in target for b in grams(t, longest, buckets)[0])
    s_all, q_all = sum(s.values()) + buckets, sum(q.values()) + buckets
    out = []
    for doc_id, text in data:
        own, n = grams(text, longest, buckets)
        gains = [math.floor(1000 * math.log((q[b] + 1) * s_all / ((s[b] + 1) * q_all))) for b in own]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{ir.SEED}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        out.append([doc_id, n, len(own), weight, score, None])
    fit = [r for r in out if r[4] is not None and r[1] >= least]
    fit.sort(key=lambda r: (-r[4], r[0], r[3], r[2]))
    for k, r in enumerate(fit[:len(fit) * percent // 100]):
        r[5] = k + 1
    return Counter(map(tuple, out))


def found(spark, data, target, longest, buckets, percent, least, extra=False):
    docs = documents(spark, data, extra)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    model = ir.fit_importance(docs, bench, longest, buckets)
    got = ir.resampled(ir.importance_scores(docs, model), percent, least)
    return Counter(map(tuple, got.select("doc_id", "n_words", "n_features", "weight", "score",
                                         "rank").collect()))


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 100)])
def test_equals_the_plain_version(spark, longest, percent):
    rng = random.Random(longest)
    data = odd_rows() + rows([prose(rng, rng.randrange(60), 80) for _ in range(80)], 100)
    target = [prose(rng, 40, 20), None, "", "one two one"]
    want = plain_version([r[:2] for r in data], target, longest, 97, percent, 5)
    assert found(spark, data, target, longest, 97, percent, 5, extra=True) == want
    assert sum(r[5] is not None for r in want) >= 5


def test_empty_tables(spark):
    assert not found(spark, [], ["a b"], 1, 10, 50, 1)
    data = rows(["a b c", "a a", None])
    assert found(spark, data, [], 2, 10, 50, 1) == plain_version([r[:2] for r in data], [], 2, 10, 50, 1)


def test_equal_scores_go_by_id(spark):
    scores = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(30).cast("long").alias("n_words"),
                                      F.lit(30).cast("long").alias("n_features"),
                                      F.lit(0).cast("long").alias("weight"),
                                      (F.col("id") % 3).alias("score"))
    got = {r.doc_id: r["rank"] for r in ir.resampled(scores, 50, 20).collect()}
    order = sorted(range(1000), key=lambda i: (-(i % 3), i))
    assert {i: k + 1 for k, i in enumerate(order[:500])} == {i: k for i, k in got.items() if k}
    assert len(got) == 1000


def test_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(ORACLE["op12_importance_resampling"]).fetchall()
    got = [tuple(r) for r in ir.op12_importance_resampling(spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[4] for r in got)


def test_spans_are_all_runs_of_words():
    words = ir.plain("One  two,THREE été\n—")
    assert words.decode() == "one two three été —"
    runs = [words[a:b].decode() for a, b in ir.spans(words, ir.patterns(3))]
    assert runs == ["one", "two", "three", "été", "—", "one two", "two three", "three été", "été —",
                    "one two three", "two three été", "three été —"]
