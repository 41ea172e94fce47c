"""Secret scans, license scans and WARC bundles against brute force and round trips."""

import base64
import hashlib
import io
import random
import re
import string

import pyarrow.fs as pafs
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm._store import scratch_path
from marketlake.llm import secret_scan
from marketlake.llm.license_scan import (
    PHRASES,
    SuffixAutomaton,
    Template,
    license_labels,
    license_spans,
    template_words,
    templates,
)
from marketlake.llm.license_texts import SECTIONS
from marketlake.llm.secret_scan import ASSIGN, KINDS, redacted, secret_spans
from marketlake.llm.warc import parse_records, read_bundles, read_record, write_bundles
from tests.llm.corpus import WORD, documents, lower, prose, rows


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secret_texts():
    rng = random.Random(1)
    hexes = "".join(rng.choices("0123456789abcdef", k=40))
    parts = [
        "password: hunter22", 'API_KEY="abc/def+123="', "passwd=token: abcdefgh", "secret = 'short'",
        "toKen:\x20\x20x.y-z_0=", "api-key: nothing", "AKIA" + "A1B2" * 4, "AKIAAKIA1234",
        "xAKIA" + "Z" * 30, hexes, hexes[:23], hexes[:24], "g" + hexes + "g", "deadBEEF" * 5,
        "secret=password=abcdef12", "password:\npassword: abcdef", "\U0001f600 é", "pässword: abcdefg",
        "passworD:abcdefſ", "secret: secret: secretsecret",
    ]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "\n", "", "é "]) for _ in range(rng.randrange(9)))
             for _ in range(80)]
    return [*texts, *parts, None, ""]


def test_base_secrets(spark):
    data = rows(secret_texts())
    found = secret_spans(documents(spark, data)).collect()
    got = {r.doc.doc_id: [tuple(s) for s in r.base] for r in found}
    want = {k: base_spans(t) for k, t, *_ in data}
    assert got == want and {s[1] for w in want.values() for s in w} == {0, 1, 2}
    assert all([s for s in r.spans if s["rank"] < 3] == r.base for r in found)


def test_random_tokens_are_found_and_ordinary_ones_are_not(spark):
    rng = random.Random(2)
    plain = [f"path/to/some/ordinary-file-name-{i}" for i in range(60)]
    plain += ["0" * (20 + i) for i in range(20)] + ["1234567890" * 3] * 20
    tokens = {kind: ["".join(rng.choices(letters, k=n)) + "7" for _ in range(40)] for kind, letters, n in (
        ("base64", string.ascii_letters + string.digits + "+/", 43),
        ("base32", string.ascii_uppercase + "234567", 55),
        ("HEX", "0123456789ABCDEF", 63))}
    data = rows([f"see {t} here" for t in plain])
    data += rows([f"und {t}." for own in tokens.values() for t in own], 1000)
    found = {r.doc.doc_id: r.spans for r in secret_spans(documents(spark, data)).collect()}
    random_ids = {k for k, spans in found.items() if any(KINDS[s["rank"]] == "random" for s in spans)}
    assert len([k for k in random_ids if k >= 1000]) >= 110  # of 120
    assert len([k for k in random_ids if k < 1000]) <= 10  # of 100
    one = found[1000][0]
    assert (one["start"], one["end"]) == (4, 4 + 44)


def test_keys_glued_to_paths_and_prefixes_are_found(spark):
    rng = random.Random(6)
    plain = [f"com/{a}-{b}/some_{c}/ordinary-file-name-of-{a}" for a in ("alpha", "beta", "gamma", "delta")
             for b in ("service", "frontend", "library") for c in ("module", "folder", "package")]
    letters = string.ascii_letters + string.digits
    keys = ["".join(rng.choices(letters, k=30)) for _ in range(60)]
    keys += ["".join(rng.choices(letters + "+/", k=41)) + "+/a" for _ in range(30)]
    keys += ["".join(rng.choices(string.ascii_letters, k=32)) for _ in range(30)]  # no digit
    glued = [f"https://x.com/my-app/hooks/{k}" for k in keys[:60]] + [f"key-{k}" for k in keys[60:90]]
    glued += keys[90:]
    data = rows([f"see {t} here" for t in plain]) + rows([f"see {t} here" for t in glued], 1000)
    text = {k: t for k, t, *_ in data}
    found = {r.doc.doc_id: r.spans for r in secret_spans(documents(spark, data)).collect()}
    hit = []
    for i, key in enumerate(keys, 1000):
        at = text[i].index(key)
        hit.append(any(s.start <= at and s.end >= at + len(key) for s in found[i]))
    assert sum(hit[:60]) >= 50 and sum(hit[60:90]) >= 25 and sum(hit[90:]) >= 20
    assert sum(bool(found[i]) for i in range(1, 1 + len(plain))) <= 4
    for spans in found.values():
        assert not any(a.start <= b.start and b.end <= a.end for a in spans for b in spans if a != b)


def test_redacted(spark):
    data = rows(["a token = abcdef12 z", 'é \U0001f600 password: "' + "ab12" * 10 + '" x', "nothing", None])
    found = sorted(redacted(documents(spark, data)).collect())
    assert [r.text for r in found] == ["a [REDACTED] z", 'é \U0001f600 [REDACTED]" x', "nothing", None]
    assert [r.n_chars for r in found] == [14, 17, 7, 0]
    assert redacted(documents(spark, data)).columns == documents(spark, data).columns


def places_of(words, phrases):
    return sorted((i, k) for k, p in phrases.items() for i in range(len(words) - len(p.split()) + 1)
                  if words[i:i + len(p.split())] == p.split())


def license_texts():
    rng = random.Random(3)
    known = [" ".join(t.words) for t in templates()]
    pieces = [*PHRASES.values(), *known, "cc", "by", "general", "public license", "all rights", "reserved",
              "CC-BY", "All Rights\nReserved", "the", "license"]
    return [" ".join(rng.choice([*pieces, prose(rng, 3)]) for _ in range(rng.randrange(12)))
            for _ in range(80)] + ["", None, "\U0001f600", "cc by cc by cc"]


def test_license_phrases(spark):
    data = rows(license_texts())
    found = license_spans(documents(spark, data)).collect()
    want = {k: places_of(WORD.findall(lower(t)), PHRASES) for k, t, *_ in data}
    assert {r.doc_id: sorted((p.start, p.label) for p in r.places) for r in found} == want
    assert {r.doc_id: r.n_words for r in found} == {k: len(WORD.findall(lower(t))) for k, t, *_ in data}
    assert {label for w in want.values() for _, label in w} == set(PHRASES)


def test_license_spans(spark):
    mit = next(t for t in templates() if t.label == "mit" and len(t.words) > 10)
    words = list(mit.words)
    changed = words[:10] + ["altered", "words"] + words[10:]
    data = rows([
        "x y " + " ".join(words) + " z", " ".join(changed), " ".join(words[:8]), prose(random.Random(1), 99),
        "Released under the MIT License.", "all rights reserved",
    ])
    found = {r.doc_id: r for r in license_labels(documents(spark, data)).collect()}
    assert list(found[1].labels) == ["mit"] and found[1].score == 1
    assert [(s.start, s.end) for s in found[1].spans if s.coverage > 0.9] == [(2, 2 + len(words))]
    assert list(found[2].labels) == ["mit"] and found[2].spans[0].end == len(changed)
    assert list(found[3].labels) == [] and 0 < found[3].score < 0.6
    assert list(found[4].labels) == [] and found[4].score == 0
    assert list(found[5].labels) == ["mit"]
    assert list(found[6].labels) == list(found[6].base_labels) == ["reserved"]


def test_license_variants_and_bodies(spark):
    gnu = ("This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} "
           "Public License as published by the Free Software Foundation{} either version {} of the License, "
           "or (at your option) any later version.")
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License"
    redistributions = next(t for t in SECTIONS["bsd"] if t.startswith("1. Redistributions"))
    want = {
        gnu.format("program", ";", "General", ";", "2"): ["gpl-2.0"],
        gnu.format("program", ":", "General", ",", "3"): ["gpl-3.0"],
        gnu.format("library", ";", "Lesser General", ";", "2.1"): ["lgpl-2.1"],
        gnu.format("program", ":", "Lesser General", ",", "3"): ["lgpl-3.0"],
        gnu.format("program", ":", "Affero General", ",", "3"): ["agpl-3.0"],
        gnu.format("program", ":", "General", ",", "1"): [],
        cc.format(""): ["cc-by-4.0"], cc.format("-NonCommercial"): ["cc-by-nc-4.0"],
        cc.format("-ShareAlike"): ["cc-by-sa-4.0"], cc.format("-NoDerivatives"): ["cc-by-nd-4.0"],
        cc.format("-NonCommercial-ShareAlike"): ["cc-by-nc-sa-4.0"],
        cc.replace("4.0", "2.5").format(""): [],
        "Licensed under CC BY-NC-SA 4.0": ["cc-by", "cc-by-nc-sa-4.0"],
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY":
            ["mit/unlicense"],
        redistributions: ["bsd"],
        SECTIONS["mpl-2.0"][5]: ["mpl-2.0"], SECTIONS["apache-2.0"][5]: ["apache-2.0"],
        SECTIONS["lgpl-2.1"][12]: ["lgpl-2.1"], SECTIONS["gpl-2.0/lgpl-2.1"][12]: ["gpl-2.0/lgpl-2.1"],
        SECTIONS["agpl-3.0/gpl-3.0"][20]: ["agpl-3.0/gpl-3.0"],
    }
    data = rows([f"w1 w2 {t} w3" for t in want])
    found = {r.doc_id: r.labels for r in license_labels(documents(spark, data)).collect()}
    got = {t: [x for x in found[i] if x != "gpl"] for i, t in enumerate(want, 1)}
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=8), min_size=1, max_size=4), st.text("abcd", max_size=25),
       st.integers(1, 3))
def test_matching_statistics(texts, stream, least):
    known = [Template(str(i), tuple(t), i % 2 == 0) for i, t in enumerate(texts)]
    automaton = SuffixAutomaton(known, least)
    for i, (state, matched) in enumerate(automaton.statistics(list(stream)), 1):
        runs = [n for n in range(i + 1) if any(stream[i - n:i] in t for t in texts)]
        assert matched == max(runs)
        run = stream[i - matched:i]
        assert {t for t, n in automaton.phrases[state] if n <= matched} == {
            k for k, t in enumerate(texts) if k % 2 == 0 and run.endswith(t)}
        if matched >= least:
            assert set(automaton.ends[state]) == {
                (k, e) for k, t in enumerate(texts) for e in range(1, len(t) + 1) if t[:e].endswith(run)}


def test_template_words():
    assert template_words("CC BY-NC 4.0, Été") == ("cc", "by", "nc", "4", "0", "Été")
    with pytest.raises(ValueError, match="no words"):
        templates({"x": "..."})


def pages():
    rng = random.Random(4)
    html = [f"<p>{prose(rng, 40)}</p>" for _ in range(30)] + ["", None, "é\U0001f600\r\n\r\nWARC/1.1\r\n\r\n"]
    data = [(i, f"http://h/{i}?é \r\nX: y", rng.choice(html)) for i in rng.sample(range(1000), 150)]
    return [*data, (None, None, html[0]), (None, "u", html[1]), (data[0][0], "again", data[0][2])]


@pytest.mark.parametrize("least", [0, 1, 10**9])
def test_warc_round_trip(spark, least):
    data = pages()
    folder = scratch_path(spark, "warc")
    df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    index = write_bundles(df.withColumn("sha1", F.lit("x")), folder, least, frame_bytes=2000, bundle_bytes=9000)
    found = read_bundles(index, folder).collect()
    body = {(p, u): (h or "").encode() for p, u, h in data}
    head = {}
    for (p, _), b in body.items():
        if p is not None and len(b) >= least:
            head[b] = min(p, head.get(b, p))
    assert len(found) == len(data)
    safe = {(p, "".join(c if c > " " else f"%{ord(c):02X}" for c in u) if u else None): b
            for (p, u), b in body.items()}
    for r in found:
        b = safe[r.page_id, r.url]
        first = head.get(b, r.page_id) if r.page_id is not None else None
        assert r.payload_bytes == len(b)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert (r.record_type, r.refers_to) == (
            ("response", None) if first == r.page_id else ("revisit", first))
        assert bytes(r.payload) == (b if r.record_type == "response" else b"")
    assert any(r.refers_to is not None for r in found) == (least < 100)
    rows_ = index.collect()
    assert len({r.bundle for r in rows_}) > 1 and max(r.frame for r in rows_) > 0
    for r in rows_[::7]:
        record = read_record(folder, r.bundle, r.frame, r.offset, r.length)
        (head_, _), = parse_records(record)
        assert head_["WARC-Record-ID"] == f"<urn:x-page:{r.page_id}>"


def test_a_bundle_is_one_zstandard_file(spark):
    folder = scratch_path(spark, "warc")
    df = spark.createDataFrame([(i, "u", "x" * 500) for i in range(40)], "page_id long, url string, html string")
    index = write_bundles(df.coalesce(1), folder, frame_bytes=1000)
    fs, path = pafs.FileSystem.from_uri(folder)
    data = fs.open_input_file(f"{path}/{index.first().bundle}").read()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert len(list(parse_records(whole))) == 40


def test_no_pages(spark):
    folder = scratch_path(spark, "warc")
    index = write_bundles(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert index.count() == 0 and read_bundles(index, folder).count() == 0


def test_a_text_of_very_many_spans(spark):
    """100,000 spans in one text: no step copies what it has found so far."""
    import time
    n = 100_000
    text = "token=abcdef12 " * n
    docs = documents(spark, [(1, text, "en", "s", len(text))])
    began = time.time()
    found = secret_scan.secret_spans(docs).first()
    assert [(s.start, s.end) for s in found.base] == [(15 * i, 15 * i + 14) for i in range(n)]
    assert secret_scan.redacted(docs).first().text == "[REDACTED] " * n
    assert time.time() - began < 90  # seconds; quadratic forms take hours


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 9, 10, 50])
def test_prefixes(spark, n):
    rng = random.Random(n)
    values = [rng.randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    add, most = df.select(
        secret_scan.prefixes(F.col("v"), lambda a, b: a + b, F.lit(0)),
        secret_scan.prefixes(F.col("v"), lambda a, b: F.greatest(a, b), F.lit(0))).first()
    assert add == [sum(values[:i + 1]) for i in range(n)]
    assert most == [max(values[:i + 1]) for i in range(n)]


def test_masks_of_overlapping_spans(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdé ") for _ in range(400))
    for n in (0, 1, 5, 60):
        spans = sorted((a, 0, a + rng.randrange(1, 30)) for a in (rng.randrange(360) for _ in range(n)))
        df = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,rank:int,end:int>>")
        got = df.select(F.when(F.size("s") > 0, secret_scan._masked(F.col("t"), F.col("s"), "#"))
                        .otherwise(F.col("t"))).first()[0]
        want, at = "", 0
        for start, _, end in spans:
            if end > at:
                want += text[at:start] + "#" if start >= at else ""
                at = end
        assert got == want + text[at:]
