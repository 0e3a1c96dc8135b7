"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Vectors are dealt to the nearest of some centroids.  What is left of a vector
beside its cell's centroid is turned by a random rotation and kept as its signs,
packed, with two scalars: its length, and the inner product of its direction with
its code.  From these the inner product with a query is estimated without bias,
with an error bound of known confidence.  In each part of a cell the best by
estimate are scored exactly; the k-th best of their scores is a threshold, and of
the other vectors only those whose upper bound reaches it are scored exactly, too.

A query first searches the cell that is nearest to it.  The k-th best score found
there tells which other cells it can pass over for certain: those whose centroid
and radius leave no room for a better vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, stored

#: Standard deviations of the estimate that its error bound spans.
CONFIDENCE = 1.9
#: Least number of bits of a code; vectors of fewer dimensions are turned into a space of so many.
BITS = 128
#: Vectors of a part on the average, and queries that are searched at once.
PART, QUERIES = 8192, 512
#: Vectors for each wanted one that are scored exactly for being the best by estimate; they give the threshold.
SEEDS = 8
#: Centroids of one dimension at most, and vectors that they are learned from.
CELLS, SAMPLE = 1024, 16384
SEED = 20240229


def rotation(dim: int, bits: int = 0, seed: int = SEED) -> np.ndarray:
    """``dim`` orthonormal rows of ``bits`` components (default: ``dim``), the same on every machine."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((max(dim, bits),) * 2))
    return (q * np.sign(np.diag(r)))[:dim]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of directions with their codes (1 for a vector of zeros)."""
    turned = vectors @ turn
    length = np.linalg.norm(vectors, axis=1)
    aligned = np.abs(turned).sum(axis=1) / (np.sqrt(turn.shape[1]) * np.where(length > 0, length, 1))
    return np.packbits(turned >= 0, axis=1), length, np.where(length > 0, aligned, 1.0)


class Codes:
    """Codes of some vectors, unpacked: estimates of inner products and the bound of their error."""

    def __init__(self, bits: np.ndarray, length: np.ndarray, aligned: np.ndarray, width: int, confidence: float):
        self.signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32).T * 2 - 1
        self.scale = (length / (aligned * np.sqrt(width))).astype(np.float32)
        spread = length * np.sqrt(np.maximum(0.0, 1 - aligned**2)) / aligned * (confidence / np.sqrt(max(1, width - 1)))
        self.spread = (spread + 1e-6 * length).astype(np.float32)

    def estimate(self, turned_queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimates, queries by vectors, and half the width of their confidence interval."""
        sent = turned_queries.astype(np.float32)
        return sent @ self.signs * self.scale, np.outer(np.linalg.norm(sent, axis=1), self.spread)


class Part:
    """Vectors of one part of a cell, each with the ids of its copies, ready to be searched."""

    def __init__(self, dim: int, centroid: np.ndarray, blocks: list[tuple[bytes, ...]], confidence: float, width: int):
        join = lambda k, kind: np.concatenate([np.frombuffer(b[k], kind) for b in blocks])
        self.vectors, self.centroid = join(0, "<f8").reshape(-1, dim), centroid
        self.counts, self.ids, self.names = join(3, "<i8"), join(4, "<i8"), join(5, "<i8").reshape(-1, 2)
        self.first = np.cumsum(self.counts) - self.counts
        length, aligned = (np.concatenate(x) for x in zip(*(np.frombuffer(b[2], "<f8").reshape(2, -1) for b in blocks), strict=True))
        self.turn = rotation(dim, width)
        self.codes = Codes(join(1, np.uint8).reshape(len(self.vectors), -1), length, aligned, width, confidence)
        self.exactly, self.pairs = 0, 0

    def _scores(self, queries: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
        self.exactly += len(q)
        return np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", queries[q[a : a + 65536]], self.vectors[v[a : a + 65536]]) for a in range(0, len(q), 65536))])

    def search(self, queries: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of each query's ``k`` best vectors that reach ``least``, with ties of the last; ordered by query, best first."""
        n, every = len(self.vectors), np.arange(len(queries))
        self.pairs += n * len(queries)
        about, room = self.codes.estimate(queries @ self.turn)
        about += (queries @ self.centroid)[:, None].astype(np.float32)
        m = min(n, SEEDS * k)
        best = np.argpartition(about, n - m, axis=1)[:, n - m :]
        seed = self._scores(queries, np.repeat(every, m), best.ravel()).reshape(-1, m)
        if m >= k:
            least = np.maximum(least, np.partition(seed, m - k, axis=1)[:, m - k])
        slack = 1e-6 * (1 + np.abs(least))
        q, v = np.nonzero(about + room >= (least - slack)[:, None])
        more = np.setdiff1d(q * n + v, (every[:, None] * n + best).ravel())
        q, v = np.divmod(more, n)
        score = np.concatenate([seed.ravel(), self._scores(queries, q, v)])
        q, v = np.concatenate([np.repeat(every, m), q]), np.concatenate([best.ravel(), v])
        good = score >= least[q]
        q, v, score = q[good], v[good], score[good]
        order = np.lexsort((self.ids[self.first[v]], -score, q))
        q, v, score = q[order], v[order], score[order]
        first = np.searchsorted(q, q)
        last = np.minimum(first + k - 1, np.searchsorted(q, q, side="right") - 1)
        keep = score >= score[last]
        return q[keep], v[keep], score[keep]

    def rows(self, q: np.ndarray, v: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """What :meth:`search` found as (query, id, name of the vector, score): ``k`` copies of each query at most."""
        counts = self.counts[v]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(self.first[v], counts)
        q, score, owner, ids = np.repeat(q, counts), np.repeat(score, counts), np.repeat(v, counts), self.ids[at]
        order = np.lexsort((ids, -score, q))
        order = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < k]
        return q[order], ids[order], self.names[owner[order]], score[order]


def centroids(sample: np.ndarray, cells: int, rounds: int = 6, seed: int = SEED) -> np.ndarray:
    """At most ``cells`` centroids of the sample by Lloyd's rounds; at least one."""
    found = sample[np.random.default_rng(seed).choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds if len(found) > 1 else 0):
        own = nearest_cell(sample, found)
        sums, n = np.zeros_like(found), np.bincount(own, minlength=len(found))
        np.add.at(sums, own, sample)
        found = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], found)
    return found if len(found) > 1 else sample.mean(axis=0, keepdims=True)


def nearest_cell(vectors: np.ndarray, found: np.ndarray) -> np.ndarray:
    half = (found**2).sum(axis=1) / 2
    return np.concatenate([np.empty(0, np.int64), *((vectors[a : a + 4096] @ found.T - half).argmax(axis=1) for a in range(0, len(vectors), 4096))])


class Cells:
    """The centroids of one dimension, and the numbers of their parts: those of cell ``c`` begin at ``begins[c]``."""

    def __init__(self, dim: int, first: int, count: int, sample: np.ndarray, part: int):
        self.dim, self.width = dim, max(dim, BITS)
        self.centers = centroids(sample, min(CELLS, -(-count // part)))
        share = np.bincount(nearest_cell(sample, self.centers), minlength=len(self.centers)) / len(sample)
        self.parts = np.maximum(1, np.ceil(share * count / part)).astype(np.int64)
        self.begins = first + np.cumsum(self.parts) - self.parts
        self.end = int(first + self.parts.sum())


def usable(column: str):
    """Whether a vector takes part: not null, empty or zero, all components finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


BLOCK = "part int, query boolean, vectors binary, codes binary, scalars binary, counts binary, ids binary, names binary"


def block(part: int, query: bool, vectors: np.ndarray, codes: bytes | None, scalars: np.ndarray, counts: np.ndarray | None, ids: np.ndarray | None, names: np.ndarray) -> pa.RecordBatch:
    values = [vectors.astype("<f8").tobytes(), codes, scalars.astype("<f8").tobytes(), None if counts is None else counts.astype("<i8").tobytes(), None if ids is None else ids.astype("<i8").tobytes(), names.astype("<i8").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([query]), *[pa.array([x], pa.binary()) for x in values]], [x.split()[0] for x in BLOCK.split(", ")])


def by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places, vectors) of a batch's column ``v``."""
    v = batch.column("v")
    sizes = np.diff(v.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield dim, at, v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            confidence: float = CONFIDENCE, part_rows: int | None = None) -> DataFrame:
    """The ``k`` rows of ``df`` with the largest inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score (in double precision), ties
    to the smaller vec_id; a row is never its own neighbour.  Both tables have
    the id and vector columns; others are not read.

    Vectors that are null, empty, zero or hold a null or non-finite component,
    and rows without id, take no part.  Rows alike in id and vector are one row;
    rows with one id and several vectors are each a query and a candidate.  Only
    vectors of the query's dimension are its candidates.  Fewer candidates than
    ``k`` are all returned; empty tables give no row.

    Of equal vectors (by 128 bits) the ``k + 1`` smallest ids travel: no result
    can have others.  ``SAMPLE`` vectors of each dimension at most (about, by a
    hash) are what its centroids are learned from, of which there are as many as
    parts of ``part_rows`` vectors, ``CELLS`` at most; larger cells are dealt to
    several parts by a hash.  A task holds one part and sees the queries in blocks;
    what it returns is ``k + 1`` rows a query at most.  Without clusters in the data
    every query meets every code: work grows with queries times vectors.
    """
    spark, part_rows = df.sparkSession, part_rows or PART
    most = k + 1  # the own row may be among the best

    def clean(table: DataFrame) -> DataFrame:
        rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        rows = rows.filter(F.col("id").isNotNull() & usable("v")).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
        return rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit("vector"), "v").alias("h2"))

    copies = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    distinct = clean(df).dropDuplicates(["h1", "h2", "id"]).withColumn("copy", copies).filter(F.col("copy") <= most)
    base = stored(distinct.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    asked = clean(queries).dropDuplicates(["h1", "h2", "id"])

    # One row for each dimension; then about SAMPLE vectors of each.
    sizes = {r.dim: r["count"] for r in base.groupBy(F.size("v").alias("dim")).count().collect()}
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, int(min(1.0, SAMPLE / n) * (1 << 30)))])
    picked = base.filter(F.pmod(F.xxhash64("h2"), F.lit(1 << 30)) < share[F.size("v")]).select("h1", "v").toArrow().sort_by("h1").combine_chunks()
    learned = {d: v for b in picked.to_batches() for d, _, v in by_dim(b)} if picked.num_rows else {}
    cells, first = {}, 0
    for d in sorted(sizes):
        cells[d] = Cells(d, first, sizes[d], learned.get(d, np.zeros((1, d))), part_rows)
        first = cells[d].end
    sent = spark.sparkContext.broadcast(cells)  # SAMPLE and CELLS bound it for each dimension

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            names = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], axis=1)
            counts = np.diff(ids.offsets.to_numpy())
            for dim, at, vectors in by_dim(batch):
                own = sent.value[dim]
                cell = nearest_cell(vectors, own.centers)
                part = own.begins[cell] + names[at, 0] % own.parts[cell]
                turn = rotation(dim, own.width)
                for p in np.unique(part).tolist():
                    mine = np.flatnonzero(part == p)
                    left = vectors[mine] - own.centers[cell[mine[0]]]
                    bits, length, aligned = encode(left, turn)
                    rows = at[mine]
                    flat = ids.take(pa.array(rows)).flatten().to_numpy()
                    yield block(p, False, vectors[mine], bits.tobytes(), np.concatenate([length, aligned]), counts[rows], flat, names[rows])

    index = stored(base.mapInArrow(indexed, BLOCK), "vector-index")

    def radius(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = [float(np.frombuffer(x, "<f8").reshape(2, -1)[0].max()) for x in batch.column("scalars").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(longest)], ["part", "radius"])

    # One row for each part.
    found_parts = index.select("part", "scalars").mapInArrow(radius, "part int, radius double").groupBy("part").agg(F.max("radius").alias("radius")).collect()
    reach = spark.sparkContext.broadcast({r.part: r.radius for r in found_parts})
    n_parts = first

    def probing(home: bool):
        """Blocks of queries for the parts that they have to search: the nearest cell's one, or all others that may hold a better vector."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                every = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], axis=1)
                known = np.zeros(len(every)) if home else batch.column("least").to_numpy(zero_copy_only=False)
                for dim, at, vectors in by_dim(batch):
                    if (own := sent.value.get(dim)) is None:
                        continue
                    near = vectors @ own.centers.T
                    first_cell = near.argmax(axis=1)
                    first_part = own.begins[first_cell] + every[at, 0] % own.parts[first_cell]
                    norms = np.linalg.norm(vectors, axis=1)
                    for p, far in reach.value.items():
                        if not own.begins[0] <= p < own.end:
                            continue
                        if home:
                            wanted = first_part == p
                        else:
                            cell = int(np.searchsorted(own.begins, p, side="right")) - 1
                            wanted = (first_part != p) & (near[:, cell] + norms * far + 1e-9 >= known[at])
                        mine = np.flatnonzero(wanted)
                        for a in range(0, len(mine), QUERIES):
                            some = mine[a : a + QUERIES]
                            least = np.full(len(some), -np.inf) if home else known[at[some]]
                            yield block(p, True, vectors[some], None, least, None, None, every[at[some]])

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, blocks, held = None, [], None
        for batch in batches:
            for part, query, *x in zip(*(batch.column(c.split()[0]).to_pylist() for c in BLOCK.split(", ")), strict=True):
                if part != number:
                    number, blocks, held = part, [], None
                own = next(c for c in sent.value.values() if c.begins[0] <= part < c.end)
                if not query:
                    blocks.append(tuple(x))
                elif blocks:
                    if held is None:
                        cell = int(np.searchsorted(own.begins, part, side="right")) - 1
                        held, blocks = Part(own.dim, own.centers[cell], blocks, confidence, own.width), [()]
                    vectors, names = np.frombuffer(x[0], "<f8").reshape(-1, own.dim), np.frombuffer(x[5], "<i8").reshape(-1, 2)
                    q, ids, theirs, score = held.rows(*held.search(vectors, np.frombuffer(x[2], "<f8"), most), most)
                    same = (names[q] == theirs).all(axis=1)
                    yield pa.RecordBatch.from_pydict({"h1": pa.array(names[q, 0]), "h2": pa.array(names[q, 1]), "vec_id": pa.array(ids), "same": pa.array(same), "score": pa.array(score)})

    def searched(rows: DataFrame, home: bool) -> DataFrame:
        both = index.unionByName(rows.mapInArrow(probing(home), BLOCK))
        dealt = both.repartitionById(n_parts, F.col("part")).sortWithinPartitions("part", "query")
        return dealt.mapInArrow(search, "h1 long, h2 long, vec_id long, same boolean, score double")

    by_vector = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    each = asked.dropDuplicates(["h1", "h2"]).select("h1", "h2", "v")
    home = stored(searched(each, True), "home-cells")
    least = home.groupBy("h1", "h2").agg(F.when(F.count(F.lit(1)) >= most, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
    # A query whose nearest cell is empty has no threshold yet and meets all cells.
    others = searched(each.join(least, ["h1", "h2"], "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))), False)
    best = home.unionByName(others).withColumn("r", F.row_number().over(by_vector)).filter(F.col("r") <= most)
    best = best.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "same", "score"))).alias("best"))
    best = stored(best, "nearest")
    discard(base, index, home)
    # Each row takes its vector's neighbours, but for itself.
    own = F.filter("best", lambda x: ~(x["same"] & (x["vec_id"] == F.col("id"))))
    rows = asked.select("id", "h1", "h2").join(best, ["h1", "h2"])
    return rows.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
