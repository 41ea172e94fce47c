"""Embedding near-dedup: random-hyperplane tables, exact cosines, connected components.

Every table hashes a vector to the signs of its products with random hyperplanes. The number of
signs follows the number of vectors, so that some ``OCCUPANCY`` vectors meet in a bucket by
chance, and the number of tables follows from the recall asked for pairs that lie exactly at the
threshold (pairs above it are found more often).

What is shuffled to the buckets is an id and a sketch: the signs of 128 further products. A row of
a bucket stays where the sketch of another one differs in few enough signs; a pair at the threshold
differs in more with a chance of ``LOSS``, other pairs hardly ever in as few. Only rows that stay
get their vector, and the vectors of one bucket are compared by their exact cosine in double
precision. Products with hyperplanes are sums of whole numbers without rounding, so a vector has
the same signs in whatever task they are computed.

Equal vectors are one class with a count and meet nobody. A pair is counted only in the first
table in which it meets, so link counts need no list of pairs; buckets give spanning edges to
the components. A bucket above ``BUCKET`` classes is cut into blocks and its pairs of blocks are
dealt to different tasks, so every pair is still compared, with bounded groups.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; vectors of different lengths don't link. A null id takes part in links but is a
component's id for none. Rows may repeat: each counts as a vector. Ties don't arise: a link is a
cosine of at least the threshold, a component's id its least id. Long vectors are handled like
short ones. An empty table gives an empty table. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm._graph import components
from marketlake.llm._groups import bucket_runs
from marketlake.llm._store import drop_written, written

COSINE = 0.9
RECALL = 0.99
SEED = 9
#: vectors that meet in a bucket by chance, as a power of two
OCCUPANCY = 7
#: signs of a sketch, and the chance that a pair at the threshold differs in too many of them
SKETCH = 128
LOSS = 1e-6
#: classes of one bucket that a task compares with each other
BUCKET = 4096
#: groups up to this size are compared side by side with others
_SMALL = 16
_STEP = 1 << 16


def table_plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(signs per table, tables): the occupancy by chance, and the recall at the threshold."""
    bits = min(30, max(4, math.ceil(math.log2(max(vectors, 1))) - OCCUPANCY))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def sketch_reach(cosine: float = COSINE, loss: float = LOSS) -> int:
    """Signs of a sketch in which a pair at the threshold differs, with chance 1 - loss at most."""
    apart = math.acos(cosine) / math.pi
    left, reach = 1.0, -1
    while left > loss:
        reach += 1
        left -= math.comb(SKETCH, reach) * apart ** reach * (1 - apart) ** (SKETCH - reach)
    return reach


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The rows in double precision, scaled by powers of two so that no product overflows."""
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1, initial=0))[1][:, None])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Scaled vectors of one length."""
    return _scaled(column.flatten().to_numpy().reshape(-1, dim))


@lru_cache(maxsize=4)
def _planes(dim: int, count: int, stream: int) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64([SEED, stream, dim]))
    return np.rint(rng.standard_normal((dim, count)) * 65536)


def _signs(vectors: np.ndarray, count: int, stream: int) -> np.ndarray:
    """Sides of hyperplanes: whole numbers whose products and sums stay below 2**53."""
    dim = vectors.shape[1]
    cells = np.rint(np.ldexp(vectors, min(22, 33 - math.ceil(math.log2(dim)))))
    return cells @ _planes(dim, count, stream) >= 0


def _signatures(vectors: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """One unsigned integer per vector and table."""
    out = np.empty((len(vectors), tables), np.uint32)
    weights = (1 << np.arange(bits)).astype(np.uint32)
    for at in range(0, len(vectors), 1024):
        signs = _signs(vectors[at:at + 1024], tables * bits, 0).reshape(-1, tables, bits)
        out[at:at + 1024] = (signs * weights).sum(axis=2, dtype=np.uint32)
    return out


def _sketches(vectors: np.ndarray) -> np.ndarray:
    """Two 64-bit integers per vector."""
    return np.packbits(_signs(vectors, SKETCH, 1), axis=1).view(np.int64)


def _hash_rows(bits: int, tables: int):
    """A row for each class and table: bucket (table and signature), class and sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("embedding").value_lengths().to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for at in range(0, part.num_rows, 512):
                    piece = part.slice(at, 512)
                    x = _matrix(piece.column("embedding"), dim)
                    key = _signatures(x, bits, tables) + (np.arange(tables, dtype=np.int64) << 32)
                    sketch = _sketches(x)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (
                            key.T.ravel(), np.tile(piece.column("cid").to_numpy(), tables),
                            np.tile(sketch[:, 0], tables), np.tile(sketch[:, 1], tables))],
                        names=["key", "cid", "s0", "s1"])
    return run


def _with_partner(s0: np.ndarray, s1: np.ndarray, reach: int) -> np.ndarray:
    """Which rows have another row whose sketch differs in at most ``reach`` signs."""
    out = np.zeros(len(s0), bool)
    for at in range(0, len(s0), 256):
        cut = slice(at, at + 256)
        apart = np.bitwise_count(s0[cut, None] ^ s0) + np.bitwise_count(s1[cut, None] ^ s1)
        own = np.arange(len(apart))
        apart[own, own + at] = SKETCH
        out[cut] = (apart <= reach).any(axis=1)
    return out


def _members(reach: int, limit: int):
    """Rows of the buckets of a sorted partition that may have a link; all of too large buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, end in bucket_runs(batches, ["key"], limit):
            if begin is not None:
                s0, s1 = (batch.column(c).to_numpy().view(np.uint64) for c in ("s0", "s1"))
                stays = np.zeros(batch.num_rows, bool)
                for a, b in zip(begin, end, strict=True):
                    if b - a > 1:
                        stays[a:b] = _with_partner(s0[a:b], s1[a:b], reach)
                batch = batch.filter(pa.array(stays))
            yield batch.select(["key", "cid"])
    return run


_ROW = [("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64()), ("dim", pa.int32()),
        ("key", pa.int64())]
_ROW_DDL = "a long, b long, links long, dim int, key long"


def _as_batch(**columns: pa.Array) -> pa.RecordBatch:
    """Edges (a, b), link counts (a, links), or rows of a large bucket (a, dim, key)."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _ROW],
        names=[c for c, _ in _ROW])


class _Rows:
    """Rows of one length as arrays."""

    def __init__(self, batch: pa.RecordBatch, plan: tuple[int, int]):
        self.cid, self.n = (batch.column(c).to_numpy() for c in ("cid", "n"))
        self.tab = batch.column("key").to_numpy() >> 32
        self.vec = _matrix(batch.column("embedding"), batch.column("dim")[0].as_py())
        self.sigs = _signatures(self.vec, *plan)
        self.norm = np.sqrt((self.vec * self.vec).sum(axis=1))


class _Found:
    """Links found among the rows of one batch."""

    def __init__(self, rows: _Rows):
        self.rows, self.links = rows, np.zeros(len(rows.cid), np.int64)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs that are near; a pair counts in the first table in which it meets."""
        r = self.rows
        for at in range(0, len(i), _STEP):
            a, b = i[at:at + _STEP], j[at:at + _STEP]
            new = (r.sigs[a] == r.sigs[b]).argmax(axis=1) == r.tab[a]
            np.add.at(self.links, a[new], r.n[b[new]])
            np.add.at(self.links, b[new], r.n[a[new]])
        self.pairs.append((i, j))
        if sum(len(x) for x, _ in self.pairs) > 16 * _STEP:
            self.pairs = [self.spanning()]

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that connect all that the pairs so far connect."""
        left, right = (np.concatenate([p[k] for p in self.pairs]) for k in (0, 1))
        root = np.arange(len(self.links))
        while True:
            least = root.copy()
            np.minimum.at(least, left, root[right])
            np.minimum.at(least, right, root[left])
            np.minimum.at(least, root, least.copy())
            least = least[least]
            if (least == root).all():
                own = np.flatnonzero(root != np.arange(len(root)))
                return root[own], own
            root = least

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.pairs:
            a, b = self.spanning()
            yield _as_batch(a=self.rows.cid[a], b=self.rows.cid[b])
            some = self.links > 0
            yield _as_batch(a=self.rows.cid[some], links=self.links[some])


def _near_blocks(rows: _Rows, one: np.ndarray, two: np.ndarray, cosine: float, found: _Found):
    """Compare the rows ``one`` with the rows ``two`` (the same array: each pair once)."""
    other, norm = rows.vec[two], rows.norm[two]
    for at in range(0, len(one), 256):
        cut = one[at:at + 256]
        near = rows.vec[cut] @ other.T >= cosine * (rows.norm[cut, None] * norm[None, :])
        if one is two:
            near &= np.arange(len(two))[None, :] > np.arange(at, at + len(cut))[:, None]
        i, j = np.nonzero(near)
        if len(i):
            found.add(cut[i], two[j])


def _bucket_links(cosine: float, limit: int, plan: tuple[int, int]):
    """Links of the buckets of a sorted partition; rows of too large buckets pass through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, end in bucket_runs(batches, ["dim", "key"], limit):
            if begin is None:
                yield _as_batch(a=batch.column("cid"), dim=batch.column("dim"),
                                key=batch.column("key"))
                continue
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims[begin]):
                first, last = (int(np.searchsorted(dims, dim, side)) for side in ("left", "right"))
                rows = _Rows(batch.slice(first, last - first), plan)
                own = np.flatnonzero(dims[begin] == dim)
                found = _Found(rows)
                _small_groups(rows, begin[own] - first, end[own] - first, cosine, found)
                for i in own[end[own] - begin[own] > _SMALL]:
                    at = np.arange(begin[i], end[i]) - first
                    _near_blocks(rows, at, at, cosine, found)
                yield from found.batches()
    return run


def _small_groups(rows: _Rows, begin: np.ndarray, end: np.ndarray, cosine: float, found: _Found):
    """Compare all groups of at most ``_SMALL`` rows, one distance of rows after the other."""
    stop = np.zeros(len(rows.cid), np.int64)  # the end of each row's group
    for i in np.flatnonzero((end - begin > 1) & (end - begin <= _SMALL)):
        stop[begin[i]:end[i]] = end[i]
    for step in range(1, _SMALL):
        i = np.flatnonzero(stop > np.arange(len(stop)) + step)
        j = i + step
        product = np.einsum("ij,ij->i", rows.vec[i], rows.vec[j])
        near = product >= cosine * (rows.norm[i] * rows.norm[j])
        if near.any():
            found.add(i[near], j[near])


def _block_links(cosine: float, plan: tuple[int, int]):
    """Links of pairs of blocks: groups by (dim, key, low, high), rows of one or two blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, begin, end in bucket_runs(batches, ["dim", "key", "low", "high"], 1 << 62):
            for b, e in zip(begin, end, strict=True):
                part = batch.slice(b, e - b)
                rows = _Rows(part, plan)
                block, low, high = (part.column(c).to_numpy() for c in ("block", "low", "high"))
                one = np.flatnonzero(block == low)
                two = one if low[0] == high[0] else np.flatnonzero(block == high)
                found = _Found(rows)
                _near_blocks(rows, one, two, cosine, found)
                yield from found.batches()
    return run


def _class_links(classes: DataFrame, cosine: float, recall: float, limit: int) -> DataFrame:
    """Edges (a, b) and link counts (a, links) between classes of equal vectors."""
    plan = table_plan(classes.count(), cosine, recall)
    members = written(
        classes.select("cid", "embedding")
        .mapInArrow(_hash_rows(*plan), "key long, cid long, s0 long, s1 long")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_members(sketch_reach(cosine), limit), "key long, cid long"), "members")
    vectors = classes.select("cid", "n", F.size("embedding").alias("dim"), "embedding")
    found = written(
        members.join(vectors, "cid").repartition("dim", "key").sortWithinPartitions("dim", "key")
        .mapInArrow(_bucket_links(cosine, limit, plan), _ROW_DDL), "links")
    drop_written(members)
    large = found.where("key is not null").select(F.col("a").alias("cid"), "dim", "key")
    sizes = written(large.groupBy("dim", "key").agg(F.ceil(F.count("*") / limit).alias("blocks")),
                    "large")
    if sizes.isEmpty():
        return found.select("a", "b", "links")
    blocked = (large.join(sizes, ["dim", "key"])
               .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
               .withColumn("low", F.least("block", "other"))
               .withColumn("high", F.greatest("block", "other"))
               .join(vectors.drop("dim"), "cid"))
    pair = ["dim", "key", "low", "high"]
    return written(
        found.where("key is null").unionByName(
            blocked.repartition(*pair).sortWithinPartitions(*pair)
            .mapInArrow(_block_links(cosine, plan), _ROW_DDL)), "blocks").select("a", "b", "links")


def embedding_components(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL,
                         limit: int = BUCKET) -> DataFrame:
    """vec_id, n_links and component_id of every row of ``vectors`` (vec_id, embedding).

    Rows and classes meet by two 64-bit hashes of the vector, so a vector is shuffled only to
    its class and to the buckets in which it may have a link.
    """
    if not 0 < cosine < 1 or not 0 < recall < 1:
        raise ValueError("cosine and recall lie between 0 and 1")
    x = F.col("embedding")
    sound = (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(
        x, lambda v: v != 0)
    rows = vectors.select("vec_id", "embedding", F.coalesce(sound, F.lit(False)).alias("sound"),
                          F.xxhash64(x).alias("h0"), F.xxhash64(F.lit(SEED), x).alias("h1"))
    classes = written(
        rows.where("sound").groupBy("h0", "h1")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first(x).alias("embedding"))
        .withColumn("cid", F.monotonically_increasing_id()), "vectors")
    links = _class_links(classes, cosine, recall, limit)
    counts = links.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(links.where("b is not null").select("a", "b"))
    known = written(classes.select("cid", "h0", "h1", "least", "n")
                    .join(counts.withColumnRenamed("a", "cid"), "cid", "left")
                    .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
                    .withColumn("root", F.coalesce("root", "cid")), "known")
    drop_written(links)
    drop_written(classes)
    ids = written(known.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = written(known.join(ids, "root").select(
        "h0", "h1", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        "component_id"), "named")
    drop_written(known)
    linked = rows.where("sound").join(named, ["h0", "h1"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(rows.where("not sound").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's columns of :func:`embedding_components` over ``embeddings``."""
    found = embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


#: all pairs of vectors, and what each reaches by links
OP9_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
sound AS (
  SELECT r, x FROM rows
  WHERE len(x) > 0 AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(x, lambda v: v <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.r <> b.r AND len(a.x) = len(b.x)
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) >= {COSINE} END),
reached AS (
  SELECT r AS a, r AS b FROM rows
  UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
component AS (
  SELECT a, min(vec_id) AS component_id FROM reached JOIN rows ON rows.r = reached.b GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM rows JOIN component ON component.a = r LEFT JOIN degree ON degree.a = r"""
