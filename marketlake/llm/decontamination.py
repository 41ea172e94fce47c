"""Benchmark decontamination: a prefix-filtered set join with exact verification.

An item's windows are its runs of ``window`` consecutive words (a shorter item is one window).
A window occurs in a document where all its words stand there consecutively. Containment is
exact, so of a window's shingles every single one is necessary, and the rarest alone is its
prefix: shingles are counted over all documents, ordered by rarity, and only the documents'
positions of prefix shingles are joined with the windows. The place of the shingle in the
window bounds the position (the window must start and end inside the document) and the
length; the words around the position then verify the whole window.

Before the shuffle a bitmap of the benchmark's shingles keeps other positions out. It is built by
a Spark aggregate, sets ``len(SHIFTS)`` slots a shingle and has ``SLOTS`` bits for each of them, so it
lets about one chance position in 10,000 through and never drops one. Its size is bounded by
``MOST_BITS``: beyond some four million shingles more chance positions pass to the join, which
is exact. The join is dealt by shingle and salted by document, so a passage that a third of all
documents hold is spread over many tasks.

Defined results: null, empty and wordless texts have no words; wordless items have no windows.
An item without an id marks words but is never listed. Every document row gives one output
row, repeated ids included. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from marketlake.llm._names import any_names
from marketlake.llm._store import written
from marketlake.llm._text import ALNUM_WORD, Words, row_slices, window_hashes

WINDOW = 10
SHINGLE = 5
#: bits of the bitmap for each shingle, and its greatest size (32 MiB)
SLOTS = 64
MOST_BITS = 1 << 28
#: parts of a hash that give its slots
SHIFTS = (0, 18, 36)
#: parts into which the documents of one shingle are dealt
SALTS = 16


def _item_windows(window: int, shingle: int) -> Callable:
    """Every window of every item with its words and its shingles' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), ALNUM_WORD, lower=True)
                h = words.hashes()
                item, texts, hashes = [], [], []
                for r, item_id in enumerate(part.column("item_id").to_pylist()):
                    a, b = words.first[r], words.first[r + 1]
                    size = min(window, b - a)
                    for i in range(a, b - size + 1 if size else a):
                        item.append(item_id)
                        texts.append([words.word(j).decode() for j in range(i, i + size)])
                        own = window_hashes(h[i:i + size], min(shingle, size))
                        hashes.append(own.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int64()), pa.array(texts, pa.list_(pa.string())),
                     pa.array(hashes, pa.list_(pa.int64()))], names=["item_id", "words", "shingles"])
    return run


def bitmap_bits(shingles: int) -> int:
    """A power of two: ``SLOTS`` bits a shingle, 8 KiB at least, ``MOST_BITS`` at most."""
    return min(MOST_BITS, max(1 << 16, 1 << (SLOTS * max(shingles, 1) - 1).bit_length()))


def shingle_bitmap(shingles: DataFrame, bits: int) -> np.ndarray:
    """Bytes with the slots of every shingle (column h) set; at most bits / 64 rows come back."""
    rows = shingles.select(F.explode(F.array(*(
        F.shiftrightunsigned("h", s).bitwiseAND(F.lit(bits - 1)) for s in SHIFTS))).alias("slot")
    ).select(F.shiftright("slot", 6).alias("word"),
             F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, "<i8")
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def _set(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose slots are all set."""
    at = np.arange(len(h))
    mask = np.uint64(8 * len(bitmap) - 1)
    for shift in SHIFTS:
        slot = (h[at] >> np.uint64(shift)) & mask
        at = at[(bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7))) & 1 == 1]
    return at


def _known(words: Words, size: int, h: np.ndarray, bitmap: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the shingles of ``size`` words whose slots are set."""
    found = window_hashes(h, size)
    at = _set(found, bitmap)
    at = at[words.inside(size)[at]]
    return at, found[at]


def _count_shingles(packed: Broadcast, sizes: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = packed.value
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), ALNUM_WORD, lower=True)
                h = words.hashes()
                found = np.concatenate([_known(words, k, h, bitmap)[1] for k in sizes])
                values, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values.view(np.int64)), pa.array(n)], names=["h", "n"])
    return run


def _prefix_positions(packed: Broadcast, sizes: list[int], window: int,
                      keep: list[str]) -> Callable:
    """Each document's word count and the positions of prefix shingles with the words around.

    A position carries the words that a window with this shingle can reach.
    """
    kind = pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int64()), ("from", pa.int64()),
                               ("around", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = packed.value
        for batch in batches:
            for part in row_slices(batch):
                words = Words(part.column("text"), ALNUM_WORD, lower=True)
                h = words.hashes()
                spots: list[list[dict]] = [[] for _ in range(words.rows)]
                row = words.row
                for size in sizes:
                    at, found = _known(words, size, h, bitmap)
                    for i, value in zip(at.tolist(), found.view(np.int64).tolist(), strict=True):
                        r = row[i]
                        a = max(i - (window - size), words.first[r])
                        b = min(i + window, words.first[r + 1])
                        spots[r].append({
                            "h": value, "pos": i - words.first[r], "from": a - words.first[r],
                            "around": [words.word(j).decode() for j in range(a, b)]})
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(np.diff(words.first)),
                     pa.array(spots, kind)], names=[*keep, "n_words_", "spots_"])
    return run


def contaminated_words(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                       shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """doc (a struct of ``keep``, doc_id if not given), n_words, n_hit and items of every row.

    items is the sorted list of item ids as strings.
    """
    keep = keep or ["doc_id"]
    if not 1 <= shingle <= window:
        raise ValueError("a shingle has 1 to window words")
    spark = docs.sparkSession
    every = written(
        items.select("item_id", "text").mapInArrow(
            _item_windows(window, shingle),
            "item_id long, words array<string>, shingles array<long>"), "item_windows")
    windows = written(every.groupBy("words").agg(F.first("shingles").alias("shingles"))
                      .withColumn("window_id", F.monotonically_increasing_id()), "windows")
    own = windows.select(F.least(F.size("words"), F.lit(shingle)).alias("size"),
                         F.explode("shingles").alias("h")).distinct()
    sizes = sorted(r[0] for r in own.select("size").distinct().collect()) or [shingle]

    def share(shingles: DataFrame) -> Broadcast:
        return spark.sparkContext.broadcast(
            shingle_bitmap(shingles, bitmap_bits(shingles.count())))

    counts = written(docs.select("text").mapInArrow(
        _count_shingles(share(own.select("h")), sizes), "h long, n long")
        .groupBy("h").agg(F.sum("n").alias("n")), "counts")
    ranked = windows.select("window_id", "words", F.posexplode("shingles").alias("offset", "h"))
    prefixes = written(
        ranked.join(counts, "h", "left")
        .groupBy("window_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset"))
                                  .alias("rarest"), F.first("words").alias("words"))
        .where("rarest.n > 0")
        .select("window_id", "words", "rarest.h", "rarest.offset"), "prefixes")

    spot = ArrayType(StructType([
        StructField("h", LongType()), StructField("pos", LongType()),
        StructField("from", LongType()), StructField("around", ArrayType(StringType()))]))
    schema = StructType([*(docs.schema[c] for c in keep), StructField("n_words_", LongType()),
                         StructField("spots_", spot)])
    places = written(
        docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
            _prefix_positions(share(prefixes.select("h")), sizes, window, keep), schema)
        .select(F.struct(*keep).alias("doc"), F.col("n_words_").alias("n_words"),
                F.col("spots_").alias("spots"), F.monotonically_increasing_id().alias("row_id")),
        "places")
    spots = places.select("row_id", "n_words", F.explode("spots").alias("s")).select(
        "row_id", "n_words", "s.*", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).alias("salt"))
    salted = prefixes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                              F.lit(SALTS - 1).cast("long"))))
    start = F.col("pos") - F.col("offset")
    size = F.size("words")
    hits = written(
        spots.join(salted, ["h", "salt"])
        .where((start >= F.col("from")) & (start + size <= F.col("n_words")))
        .where(F.slice("around", (start - F.col("from") + 1).cast("int"), size) == F.col("words"))
        .select("row_id", "window_id", start.alias("start"), (start + size).alias("end")), "hits")
    covered = hits.groupBy("row_id").agg(
        F.aggregate(
            F.array_sort(F.collect_set(F.struct("start", "end"))),
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
            lambda seen, s: F.struct(
                (seen["n"] + F.greatest(F.lit(0).cast("long"),
                                        s["end"] - F.greatest(s["start"], seen["to"]))).alias("n"),
                F.greatest(seen["to"], s["end"]).alias("to")),
            lambda seen: seen["n"]).alias("n_hit"))
    named = every.where("item_id IS NOT NULL").select("item_id", "words").distinct().join(
        windows.select("words", "window_id"), "words").select("window_id", "item_id")
    listed = (hits.select("row_id", "window_id").distinct().join(written(named, "named"), "window_id")
              .groupBy("row_id").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string")))
                                     .alias("items")))
    return (places.select("row_id", "doc", "n_words")
            .join(covered, "row_id", "left").join(listed, "row_id", "left")
            .select("doc", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


@any_names
def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of an item occurs.

    Contaminated rows are told by id and a hash of the text, so no text is written or joined
    but with them.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = contaminated_words(keyed, items, window, min(SHINGLE, window), ["doc_id", "text_hash"])
    bad = written(found.where("n_hit > 0").select("doc.*").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["text_hash"])
    return docs.join(bad, same, "left_anti")


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of :func:`contaminated_words` over ``documents`` and ``benchmark``."""
    found = contaminated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = ("coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), CAST([] AS VARCHAR[]))")
#: every window of every item against every run of as many words of a document
OP1_SQL = rf"""
WITH items AS (SELECT item_id, {_SQL_WORDS} AS words FROM benchmark),
sized AS (SELECT item_id, words, least(len(words), {WINDOW}) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, size, words[i + 1:i + size] AS win
  FROM (SELECT *, unnest(range(len(words) - size + 1)) AS i FROM sized)),
docs AS (SELECT row_number() OVER () AS row_id, doc_id, {_SQL_WORDS} AS words FROM documents),
starts AS (
  SELECT row_id, size, i, words[i + 1:i + size] AS win
  FROM (SELECT row_id, words, size, unnest(range(len(words) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))),
hits AS (SELECT * FROM starts WHERE win IN (SELECT win FROM windows)),
covered AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY row_id),
found AS (
  SELECT row_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids
  FROM hits JOIN windows USING (win) WHERE item_id IS NOT NULL GROUP BY row_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)"""
