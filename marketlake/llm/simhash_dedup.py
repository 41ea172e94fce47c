"""SimHash near-dedup by covering locality-sensitive hashing.

A document's fingerprint has a bit set where more than half of its shingles' hashes have it.
Fingerprints that differ in at most ``max_bits`` bits are linked, and linked documents form
components.

The masks: give every bit position a non-zero vector of ``max_bits + 1`` bits. A mask for each
non-zero vector v keeps the positions whose vector has an odd inner product with v. At most
``max_bits`` positions are at odds in a linked pair, so some v is orthogonal to all their
vectors, and under its mask the pair agrees: every pair within the radius meets in one of
the 2^(max_bits+1) - 1 tables, without exception.

Equal fingerprints are one class from the start, so copies meet no one. A bucket that holds more
than ``BUCKET`` fingerprints is refined instead of compared: the positions its mask leaves
free are cut into ``max_bits + 1`` parts, and a linked pair agrees in at least one. When no
more than ``max_bits`` positions are free, all of the bucket is linked. Buckets give
spanning edges, never all their pairs.

Defined results: a null, empty or blank text has fingerprint zero, linked like any other. A null
doc_id takes part in links but is never a component's id unless no other is there. Every
input row gives one output row; rows may repeat. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from marketlake.llm._graph import components
from marketlake.llm._groups import bucket_runs
from marketlake.llm._names import any_names
from marketlake.llm._store import written
from marketlake.llm._text import row_slices

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: fingerprints of one bucket that a task compares with each other
BUCKET = 2048
_ALL = (1 << 64) - 1
_STEP = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.fromiter(accumulate(len(w) + 1 for w in words), np.int64, len(words)) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), _STEP):
        cuts = map(slice, starts[at:at + _STEP].tolist(), ends[at:at + _STEP].tolist())
        digest = map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED))
        h = np.fromiter(digest, "<u8", min(_STEP, len(starts) - at))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, name: str, keep: list[str]):
    """The columns ``keep`` of a batch and the fingerprint of its texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                fp = [fingerprint(t, shingle) for t in part.column("text").to_pylist()]
                yield part.select(keep).append_column(
                    name, pa.array(np.array(fp, np.uint64).view(np.int64)))
    return run


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero vector of ``radius + 1`` bits."""
    size = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(64) if ((i % size + 1) & v).bit_count() % 2)
            for v in range(1, size + 1)]


def refined(mask: int, radius: int) -> list[int]:
    """The masks that also keep one of ``radius + 1`` parts of the free positions."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[c::radius + 1]) for c in range(radius + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def linked_roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each of a bucket's fingerprints, the index of the first one it is connected with."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    root = near.argmax(axis=1)
    while True:
        least = np.where(near, root[None, :], len(fps)).min(axis=1)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _bucket_edges(radius: int, limit: int):
    """Rows sorted by (mask, key) to edges (kind 0) and the rows of too large buckets (kind 1)."""
    def as_batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)),
             pa.array(b.view(np.int64))], names=["kind", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, end in bucket_runs(batches, ["mask", "key"], limit):
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if begin is None:
                yield as_batch(1, fp, batch.column("mask").to_numpy())
                continue
            two = begin[end - begin == 2]
            near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius
            yield as_batch(0, fp[two[near]], fp[two[near] + 1])
            for i in np.flatnonzero(end - begin > 2):
                own = fp[begin[i]:end[i]]
                root = linked_roots(own, radius)
                other = np.flatnonzero(root != np.arange(len(own)))
                if len(other):
                    yield as_batch(0, own[root[other]], own[other])
    return run


def fingerprint_links(classes: DataFrame, radius: int, limit: int = BUCKET) -> DataFrame:
    """Edges (a, b) that span every set of connected fingerprints; ``classes`` has distinct fp."""
    masks = covering_masks(radius)
    rows = classes.select("fp", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    edges = None
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask"))
        found = written(
            rows.withColumn("key", key).repartition("mask", "key")
            .sortWithinPartitions("mask", "key")
            .mapInArrow(_bucket_edges(radius, limit), "kind int, a long, b long"), "buckets")
        own = found.where("kind = 0").select("a", "b")
        edges = own if edges is None else edges.unionByName(own)
        large = found.where("kind = 1")
        if large.isEmpty():
            return edges
        rows = large.select(F.col("a").alias("fp"), F.col("b").alias("mask")).mapInArrow(
            _refine(radius), "fp long, mask long")


def _refine(radius: int):
    """Each row under every finer mask of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[int]] = {}
        for batch in batches:
            masks = batch.column("mask").to_pylist()
            for mask in set(masks) - known.keys():
                known[mask] = [_signed(m) for m in refined(mask & _ALL, radius)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp").take(pa.array(np.repeat(np.arange(len(masks)), radius + 1))),
                 pa.array([m for mask in masks for m in known[mask]], pa.int64())],
                names=["fp", "mask"])
    return run


def _component_table(prints: DataFrame, max_bits: int) -> DataFrame:
    """fp, root (one fingerprint of the component) and component_id of every fingerprint."""
    if not 1 <= max_bits <= 6:
        raise ValueError("max_bits is 1 to 6")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(fingerprint_links(classes, max_bits))
    linked = written(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")
    ids = written(linked.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    linked = linked.join(ids, "root").select("fp", "root", "component_id")
    return written(classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("component_id", "least").alias("component_id")), "components")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE,
                       max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long) and component_id of every document row."""
    prints = written(docs.select("doc_id", "text").mapInArrow(
        _fingerprints(shingle, "fp", ["doc_id"]), "doc_id long, fp long"), "fingerprints")
    return prints.join(_component_table(prints, max_bits), "fp").select(
        "doc_id", "fp", "component_id")


@any_names
def near_duplicates_removed(docs: DataFrame, shingle: int = SHINGLE,
                            max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    The row with the component's id stays; of rows that share it (or where there is no id) one
    with the least fingerprint, then the least text. Texts move only where an id is missing or
    repeated; the other rows are told by the ids that go.
    """
    prints = written(docs.select("doc_id", "text").mapInArrow(
        _fingerprints(shingle, "fp", ["doc_id"]), "doc_id long, fp long"), "fingerprints")
    table = _component_table(prints, max_bits)
    shared = written(prints.groupBy("doc_id").agg(F.count("*").alias("n"))
                     .where("n > 1 OR doc_id IS NULL").select("doc_id"), "shared")
    found = prints.join(table, "fp")
    gone = written(found.where("doc_id != component_id").select("doc_id")
                   .unionByName(shared.where("doc_id IS NOT NULL")).distinct(), "gone")
    single = docs.where("doc_id IS NOT NULL").join(gone, "doc_id", "left_anti")

    kept = written(
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "doc_id").agg(F.min("fp").alias("fp")).drop("root"), "kept")
    name = "fp"
    while name in docs.columns:
        name += "_"
    schema = StructType([*docs.schema.fields, StructField(name, LongType())])
    marked = docs.join(shared, docs["doc_id"].eqNullSafe(shared["doc_id"]), "left_semi").mapInArrow(
        _fingerprints(shingle, name, docs.columns), schema)
    same = marked["doc_id"].eqNullSafe(kept["doc_id"]) & (marked[name] == kept["fp"])
    several = (marked.join(kept, same, "left_semi").groupBy(name, "doc_id")
               .agg(F.min_by(F.struct(*docs.columns), F.struct("text")).alias("row"))
               .select("row.*"))
    return single.select(*docs.columns).unionByName(several)


def op5_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`simhash_components` over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_components(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
