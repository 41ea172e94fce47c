"""The numpy words and window hashes against plain Python."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm._groups import bucket_runs
from marketlake.llm._text import (
    ALNUM_WORD,
    SPACED_WORD,
    Words,
    distinct_by_row,
    row_slices,
    sliding,
    window_hashes,
)
from tests.llm.corpus import SPACED, WORD, lower

TEXTS = st.lists(st.one_of(st.none(), st.text(
    alphabet="aZ9 \t\n|-\x00é日\U0001f600\x7f\x85", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_of_slices(texts, limit):
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    at = 0
    for part in row_slices(batch, limit=limit):
        for table, fold, pattern, change in ((ALNUM_WORD, True, WORD, lower),
                                             (SPACED_WORD, False, SPACED, lambda t: t or "")):
            words = Words(part.column("text"), table, lower=fold)
            for r in range(part.num_rows):
                got = [words.word(i).decode() for i in range(words.first[r], words.first[r + 1])]
                assert got == pattern.findall(change(texts[at + r]))
        at += part.num_rows
    assert at == len(texts)


def test_equal_words_and_only_they_have_equal_hashes():
    rng = random.Random(1)
    pool = ["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "x" * 600, "x" * 601, "é"]
    pool += ["".join(rng.choices("abc", k=n)) for n in range(1, 40) for _ in range(3)]
    text = " ".join(rng.choices(pool, k=3000))
    words = Words(pa.array([text]), SPACED_WORD, lower=False)
    for which in (0, 1):
        seen = {}
        for i, h in enumerate(words.hashes(which).tolist()):
            assert seen.setdefault(h, words.word(i)) == words.word(i)
        assert len(seen) == len(set(text.split()))
    for width in (1, 2, 3, 7, 25, 50):
        h = words.hashes()
        found = window_hashes(h, width)
        assert len(found) == len(h) - width + 1
        whole = [tuple(h[i:i + width].tolist()) for i in range(len(found))]
        assert len(set(zip(whole, found.tolist(), strict=True))) == len(set(whole)) \
            == len(set(found.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=40), st.integers(1, 12))
def test_sliding(values, span):
    got = sliding(np.array(values, np.int64), span, np.minimum).tolist()
    assert got == [min(values[i:i + span]) for i in range(len(values) - span + 1)]


def test_distinct_by_row():
    values, row = distinct_by_row(np.array([3, 1, 3, 3]), np.array([0, 0, 0, 2]))
    assert list(zip(row.tolist(), values.tolist(), strict=True)) == [(0, 1), (0, 3), (2, 3)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=12), st.integers(1, 5), st.integers(1, 6))
def test_bucket_runs_give_every_group_once(sizes, step, limit):
    keys = np.repeat(np.arange(len(sizes)), sizes)
    table = pa.record_batch({"k": pa.array(keys), "v": pa.array(np.arange(len(keys)))})
    small, large = {}, {}
    for batch, begin, end in bucket_runs(
            (table.slice(i, step) for i in range(0, len(keys), step)), ["k"], limit):
        k, v = (batch.column(c).to_pylist() for c in ("k", "v"))
        if begin is None:
            for a, b in zip(k, v, strict=True):
                large.setdefault(a, []).append(b)
            continue
        for a, b in zip(begin, end, strict=True):
            assert len(set(k[a:b])) == 1 and k[a] not in small
            small[k[a]] = v[a:b]
    assert not set(small) & set(large)
    for i, size in enumerate(sizes):
        assert len(small.get(i, large.get(i))) == size
        assert (i in large) == (size > limit)
