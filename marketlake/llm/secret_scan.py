"""Secret scans: patterns, and a battery of randomness tests on encoded-looking tokens.

Base spans are the matches of fixed patterns. Further candidates are runs of ``CANDIDATE``
characters of the Base64 alphabets, and the parts of that length that are left of a run cut at
``+`` and ``/``, at ``-`` and ``_``, or at all four, where they don't lie inside a base span. So a key
is tested on its own where a path or a prefix is glued to it. Each
candidate's encoding is the narrowest alphabet that holds all its characters (hexadecimal,
Base32, Base36, Base62, Base64, all of these); in that alphabet three tests ask whether the
characters could be uniform and independent: a chi-squared test of the counts, the number of runs of symbols of the
alphabet's lower and upper half, and the correlation of neighbours. Fisher's method combines
them into one p-value.

Ordinary tokens (paths, numbers, names) fail the tests. Which candidates count as failed is decided
by the Benjamini-Hochberg step-up over all documents at rate ``RATE``, for each encoding and
class of length on its own, since short tokens give the tests little power; of the tokens that are
set aside as ordinary, a share of ``RATE`` at most is expected to be random. The others are
spans of kind ``random``, but for those inside another one.

Only DataFrame functions are used. The step-up needs counts by rounded p-value, at most
``BINS`` for each stratum, never the candidates themselves in one place.

Defined results: a null text counts as empty. Every input row gives one output row, repeated
ids included. Extra columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm._names import any_names
from marketlake.llm._store import written

# The kinds of base spans, their patterns, and the least length of the whole match
# (of the value, for assignments).
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "random")

#: least characters of a candidate
CANDIDATE = 20
RATE = 0.05
#: rounded p-values: steps of 1/20 in the logarithm
BINS, FINE = 1000, 20.0

_TOKEN = r"[A-Za-z0-9+/_-]"
_RUN = rf"(?<!{_TOKEN}){_TOKEN}{{{CANDIDATE},}}"
#: parts of a run, by the separators that they don't hold
_PARTS = tuple(f"[^{cut}]{{{CANDIDATE},}}" for cut in ("+/", "_-", "+/_-"))

# Alphabets in the order of their digits, narrowest first.
_LOW, _UP, _DIG = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    ("hex", _DIG + "abcdef"),
    ("HEX", _DIG + "ABCDEF"),
    ("base32", _UP + "234567"),
    ("base36", _DIG + _LOW),
    ("BASE36", _DIG + _UP),
    ("base62", _DIG + _UP + _LOW),
    ("base64", _UP + _LOW + _DIG + "+/"),
    ("base64url", _UP + _LOW + _DIG + "-_"),
    ("mixed", _UP + _LOW + _DIG + "+/-_"),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _indexes(n: Column) -> Column:
    """0, 1, ... n - 1."""
    return F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i < n)


def _block(n: Column) -> Column:
    return F.ceil(F.sqrt(F.greatest(n, F.lit(1)).cast("double"))).cast("int")


def prefixes(values: Column, join: Callable[[Column, Column], Column], zero: Column) -> Column:
    """``join`` of each value with all before it, in blocks of the root of the array's length.

    A fold can't build an array without copying it at every step; here a value is joined with those
    of its block alone, and with one number for the blocks before.
    """
    def of(x: Column, size: Column) -> Column:
        def part(first: Column, length: Column) -> Column:
            return F.aggregate(F.slice(x, first + 1, length), zero, join)

        blocks = _indexes(F.ceil(F.size(x) / size).cast("int"))
        return _let(F.transform(blocks, lambda k: part(k * size, size)), lambda sums: _let(
            F.transform(sums, lambda _, k: F.aggregate(F.slice(sums, F.lit(1), k), zero, join)),
            lambda before: F.transform(x, lambda _, i: join(
                F.get(before, F.floor(i / size).cast("int")), part(i - i % size, i % size + 1)))))

    return _let(values, lambda x: _let(_block(F.size(x)), lambda size: of(x, size)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of struct<start, text>.

    The gaps are what splitting leaves; a match starts where the gaps and matches before it end.
    """
    def located(hits: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.length)
        before = F.transform(hits, lambda _, i: F.when(i > 0, F.length(F.get(hits, i - 1))).otherwise(0))
        starts = prefixes(F.zip_with(gaps, before, _add), _add, F.lit(0))
        return F.zip_with(starts, hits, lambda at, hit: F.struct(at.alias("start"), hit.alias("text")))

    none = F.array().cast("array<struct<start:int,text:string>>")
    return F.when(text.rlike(pattern), _let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)).otherwise(none)


def _spans(found: Column, kind: str, long_enough: Column | None) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found if long_enough is None else long_enough, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"),
        (m["start"] + F.length(m["text"])).alias("end")))


def _base_spans(text: Column) -> Column:
    """Sorted array of struct<start, rank, end> of the fixed patterns."""
    assign = matches(text, ASSIGN)
    value = F.filter(assign, lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 2))
                     >= LEAST["assign"])
    # a run that is too short holds no match of its own, so the length can stand in the pattern
    access = matches(text, ACCESS[:-1] + "{" + str(LEAST["access"] - 4) + ",}")
    hexes = matches(text, HEX[:-1] + "{" + str(LEAST["hex"]) + ",}")
    return F.array_sort(F.concat(_spans(assign, "assign", value), _spans(access, "access", None),
                                 _spans(hexes, "hex", None)))


def _upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, by a logistic approximation."""
    return 1.0 / (1.0 + F.exp(F.least(F.lit(60.0), 1.5976 * z + 0.070565992 * z * z * z)))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2.0 * _upper_tail(F.abs(z)))


def _battery(tokens: DataFrame) -> DataFrame:
    """Add encoding, n and the combined p-value to a table with column token."""
    by_name = [(F.lit(name), F.col("token").rlike("^[" + alphabet.replace("-", "\\-") + "]+$"),
                alphabet) for name, alphabet in ALPHABETS]
    name, letters = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, fits, alphabet in reversed(by_name):
        name = F.when(fits, label).otherwise(name)
        letters = F.when(fits, F.lit(alphabet)).otherwise(letters)
    known = (tokens.withColumn("encoding", name).withColumn("letters", letters)
             .withColumn("x", F.expr("transform(split(token, ''), c -> "
                                     "cast(locate(c, letters) - 1 AS double))"))
             .withColumn("x", F.filter("x", lambda v: v >= 0))
             .withColumn("n", F.size("x").cast("double"))
             .withColumn("k", F.length("letters").cast("double")))
    squares = F.expr("aggregate(transform(array_distinct(x), v -> cast(size(filter(x, w -> w = v)) "
                     "AS double)), 0D, (a, c) -> a + c * c)")
    half = F.transform("x", lambda v: v < F.col("k") / 2)
    pairs = F.arrays_zip(F.slice("x", F.lit(1), F.size("x") - 1).alias("a"),
                         F.slice("x", F.lit(2), F.size("x") - 1).alias("b"))
    mean = (F.col("k") - 1) / 2
    measured = known.select(
        "*", (squares * F.col("k") / F.col("n") - F.col("n")).alias("chi2"), half.alias("low"),
        F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        .alias("product"))
    changes = F.size(F.filter(F.arrays_zip(
        F.slice("low", F.lit(1), F.size("low") - 1).alias("a"),
        F.slice("low", F.lit(2), F.size("low") - 1).alias("b")), lambda p: p["a"] != p["b"]))
    v = F.col("k") - 1
    chi = (F.pow(F.greatest(F.col("chi2"), F.lit(0.0)) / v, F.lit(1 / 3)) - (1 - 2 / (9 * v))) \
        / F.sqrt(2 / (9 * v))
    runs = (changes - (F.col("n") - 1) / 2) / F.sqrt((F.col("n") - 1) / 4)
    serial = F.col("product") / ((F.col("k") * F.col("k") - 1) / 12 * F.sqrt(F.col("n") - 1))
    tests = measured.select("*", _upper_tail(chi).alias("p1"), _two_sided(runs).alias("p2"),
                            _two_sided(serial).alias("p3"))
    tiny = 1e-15
    t = -sum((F.log(F.greatest(F.col(p), F.lit(tiny))) for p in ("p1", "p2", "p3")), F.lit(0.0))
    return tests.withColumn("t", t).withColumn(
        "p", F.exp(-F.col("t")) * (1 + F.col("t") + F.col("t") * F.col("t") / 2))


def _cutoffs(tokens: DataFrame, rate: float) -> DataFrame:
    """For each stratum the least rounded p (as a bin) that the step-up sets aside."""
    counts = tokens.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("stratum")
    lower = whole.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    return (counts.select("stratum", "bin", F.sum("n").over(lower).alias("seen"),
                          F.sum("n").over(whole).alias("all"))
            .where(F.exp(-F.col("bin") / FINE) <= rate * F.col("seen") / F.col("all"))
            .groupBy("stratum").agg(F.min("bin").alias("cutoff")))


def secret_spans(docs: DataFrame, rate: float = RATE, keep: list[str] | None = None) -> DataFrame:
    """doc (a struct of the columns ``keep``, doc_id if not given), base and spans of every row.

    Both are arrays of struct<start, rank, end>, where ``rank`` numbers ``KINDS``; ``spans`` has the
    base spans and those of kind random.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(
        docs.select(F.struct(*(keep or ["doc_id"])).alias("doc"), _base_spans(text).alias("base"),
                    matches(text, _RUN).alias("runs"))
        .withColumn("row_id", F.monotonically_increasing_id()), "secrets")

    runs = rows.select("row_id", F.explode("runs").alias("r"))
    parts = F.concat(*(matches(F.col("r.text"), cut) for cut in _PARTS))
    found = F.array_distinct(F.concat(F.array("r"), F.transform(parts, lambda m: F.struct(
        (F.col("r.start") + m["start"]).alias("start"), m["text"].alias("text")))))
    candidates = runs.select("row_id", F.explode(found).alias("r")).select(
        "row_id", F.col("r.start").alias("start"), (F.col("r.start") + F.length("r.text")).alias("end"),
        F.col("r.text").alias("token"))
    fixed = rows.where(F.size("runs") > 0).select("row_id", F.explode("base").alias("b")).select(
        "row_id", "b.start", "b.end", F.lit(None).cast("string").alias("token"))
    # a candidate lies inside a base span if one that starts no later ends no earlier
    so_far = Window.partitionBy("row_id").orderBy("start", F.col("token").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0)
    covered = F.max(F.when(F.col("token").isNull(), F.col("end"))).over(so_far)
    tokens = candidates.unionByName(fixed).withColumn("covered", covered).where(
        F.col("token").isNotNull() & (F.coalesce("covered", F.lit(-1)) < F.col("end"))).select(
        "row_id", "start", "token")
    tested = written(_battery(tokens).select(
        "row_id", "start", (F.col("start") + F.length("token")).alias("end"),
        F.concat("encoding", F.lit("/"), F.least(F.floor(F.log2("n") * 2), F.lit(20)))
        .alias("stratum"),
        F.least(F.lit(BINS), F.floor(-F.log(F.greatest(F.col("p"), F.lit(1e-30))) * FINE))
        .alias("bin")), "tested")
    cutoffs = written(_cutoffs(tested, rate), "cutoffs")
    random = (tested.join(cutoffs, "stratum", "left")
              .where(F.col("cutoff").isNull() | (F.col("bin") < F.col("cutoff")))
              .withColumn("reach", F.max("end").over(
                  Window.partitionBy("row_id").orderBy("start", F.desc("end")).rowsBetween(
                      Window.unboundedPreceding, -1)))
              # a span lies inside another one if one before it in this order ends no earlier
              .where(F.col("reach").isNull() | (F.col("reach") < F.col("end")))
              .groupBy("row_id").agg(F.collect_list(F.struct(
                  "start", F.lit(KINDS.index("random")).alias("rank"), "end")).alias("random")))
    return rows.join(random, "row_id", "left").select(
        "doc", "base",
        F.when(F.col("random").isNull(), F.col("base"))
        .otherwise(F.array_sort(F.concat("base", "random"))).alias("spans"))


def _masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` in the place of each run of overlapping spans.

    The text is cut at every span of a block of spans first, then inside the block, so that a cut
    reads a block's characters and not the whole text.
    """
    def cut(s: Column, ends: Column, size: Column) -> Column:
        def at(i: Column) -> Column:  # where the spans before i end
            return F.when(i > 0, F.get(ends, i - 1)).otherwise(0)

        def block(k: Column) -> Column:
            low, last = at(k * size), F.least((k + 1) * size, F.size(s)) - 1
            inner = F.substring(text, low + 1, F.get(ends, last) - low)

            def pieces(own: Column) -> Column:
                return F.transform(F.slice(s, k * size + 1, size), lambda x, i: _let(
                    at(k * size + i), lambda seen: F.when(x["start"] >= seen, F.concat(
                        F.substring(own, seen - low + 1, x["start"] - seen), F.lit(mask))).otherwise("")))

            return F.array_join(_let(inner, pieces), "")

        blocks = F.transform(_indexes(F.ceil(F.size(s) / size).cast("int")), block)
        rest = F.substring(text, F.get(ends, F.size(ends) - 1) + 1, F.length(text))
        return F.concat(F.array_join(blocks, ""), rest)

    ends = prefixes(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
    return _let(spans, lambda s: _let(ends, lambda e: _let(
        _block(F.size(s)), lambda size: cut(s, e, size))))


@any_names
def redacted(docs: DataFrame, rate: float = RATE, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask``; n_chars, if there, follows.

    Spans that overlap are masked once. Rows without spans stay as they are. Spans come back to
    their rows by id and a hash of the text, so only rows with spans are held beside the texts.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = secret_spans(keyed, rate, ["doc_id", "text_hash"])
    known = written(found.where(F.size("spans") > 0)
                    .select(F.col("doc.doc_id").alias("doc_id"),
                            F.col("doc.text_hash").alias("text_hash"), "spans")
                    .dropDuplicates(["doc_id", "text_hash"]), "known")
    same = F.col("d.doc.doc_id").eqNullSafe(F.col("k.doc_id")) & (
        F.xxhash64("d.doc.text") == F.col("k.text_hash"))
    rows = docs.select(F.struct(*docs.columns).alias("doc")).alias("d").join(
        known.alias("k"), same, "left").select("doc", "spans")
    text = F.col("doc.text")
    clean = _masked(text, F.col("spans"), mask)
    some = F.col("spans").isNotNull()
    changed = rows.select("doc", F.when(some, clean).otherwise(text).alias("clean"), some.alias("some"))
    doc = F.col("doc").withField("text", F.col("clean"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        doc = doc.withField("n_chars", F.when(F.col("some"), F.length("clean").cast(kind))
                            .otherwise(F.col("doc.n_chars")))
    return changed.select(doc.alias("doc")).select("doc.*")


def _listed(spans: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",")


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`secret_spans` over ``documents``."""
    found = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: str) -> Column:
        rank = KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    return found.select("doc.doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
