"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to unit length and cut in halves; each half has a codebook of its own, and a vector lives in the cell of
the product grid that its two nearest centroids name. A query visits cells in order of its summed distances to both
centroids (multi-sequence traversal): as many as a brute-force calibration of sample queries needs for `RECALL`. Every
vector is indexed and every vector is a query; a pair is found if either side visits the other's cell, and only found pairs
with an exact cosine of `COSINE` or more, in double precision, are links.

Equal vectors are one class with a count, so copies never meet. A cell's members and visitors are cut into blocks of bounded
size; a block pair returns per vector its number of links and one label of its connected part, never the pairs themselves.

Vectors that are NULL, empty, zero or hold NULL or non-finite parts link with nothing; so do vectors of different length. A
NULL vec_id is a vector like any other: it counts as a link, and names a component only if no other id is in it. Vectors of
single precision travel as such and are compared in double precision; any others travel in double precision.
Codebooks are fitted on at most `SAMPLE` classes per length, chosen by hash, and grow with the table, so that a cell holds
`CELL_VECTORS` on average up to `MOST_CENTROIDS` a half (10⁹ vectors; beyond that cells grow). The calibration asks `QUERIES` of them against all
rows and goes on, four times as many a round, until `PARTNERED` had a partner or the sample is used up. If rows are left that
were not asked and fewer had one, vectors at exactly the cosine, planted around sample vectors, give a least number of visits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm.common import read, scratch, ship, staged
from voltframe.llm.components import components

COSINE = 0.9
RECALL = 0.999
SAMPLE = 16_384
QUERIES = 256
PARTNERED = 100
PLANTED = 2048
CELL_VECTORS = 16
MOST_CENTROIDS = SAMPLE // 2
DISTANCES = 1 << 20
BLOCK = 2048
LEAST_VISITS = 4


def usable() -> Column:
    """Whether a vector has a direction: never NULL."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of rows of one length, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of one vector length at a time."""
    length = batch.column("embedding").value_lengths().to_numpy()
    for n in np.unique(length):
        yield batch.filter(pa.array(length == n))


def kmeans(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:k]].copy()
    part = max(1, DISTANCES // k)
    for _ in range(rounds):
        near = np.concatenate([distances(points[i:i + part], centres).argmin(1) for i in range(0, len(points), part)])
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0)


class Grid:
    """Two codebooks for vectors of one length."""

    def __init__(self, points: np.ndarray, total: int):
        self.half = points.shape[1] // 2
        distinct = min(len(points), MOST_CENTROIDS, max(1, int(np.sqrt(total / CELL_VECTORS))))
        self.books = [kmeans(h, distinct, i) for i, h in enumerate(self.halves(points))]
        self.k = distinct
        self.visits = LEAST_VISITS

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(distances(h, c) for h, c in zip(self.halves(x), self.books))

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.near(x)
        return a.argmin(1) * self.k + b.argmin(1)

    def rank(self, a: np.ndarray, b: np.ndarray, cell: int) -> int:
        """How many cells a query with these centroid distances visits before this one."""
        limit = a[cell // self.k] + b[cell % self.k]
        return int(np.searchsorted(np.sort(b), limit - a, "left").sum())

    def visited(self, x: np.ndarray) -> np.ndarray:
        """The cells that each query visits, nearest first (queries × visits).

        Any of the first t cells of the traversal has an index pair with (i + 1)(j + 1) <= t in the two sorted lists, so only
        those pairs are merged.
        """
        a, b = self.near(x)
        t = min(self.visits, self.k * self.k)
        pairs = [(i, j) for i in range(min(t, self.k)) for j in range(min(t // (i + 1), self.k))]
        i, j = np.array(pairs).T
        oa, ob = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        total = np.take_along_axis(a, oa, 1)[:, i] + np.take_along_axis(b, ob, 1)[:, j]
        best = np.argsort(total, 1, kind="stable")[:, :t]
        return np.take_along_axis(oa, i[best], 1) * self.k + np.take_along_axis(ob, j[best], 1)


def fitted(classes: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> dict[int, Grid]:
    """A grid per vector length, with its visits calibrated against brute force for the sample queries."""
    sizes = {r["length"]: r["n"] for r in classes.groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    grids, samples = {}, {}
    for length, total in sizes.items():
        rows = (classes.filter(F.size("embedding") == length).orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("cid", "embedding").toArrow()
                .combine_chunks())
        points = matrix(rows.column("embedding").combine_chunks())
        grids[length] = Grid(points, total)
        samples[length] = (rows.column("cid").to_numpy(), points)

    found = dict.fromkeys(grids, ({}, 0))
    low, high, wanting = 0, QUERIES, set(grids)
    while wanting:
        asked = {n: (samples[n][0][low:high], samples[n][1][low:high]) for n in wanting}
        for n, (ranks, partnered) in asked_ranks(classes, grids, asked, cosine).items():
            before, count = found[n]
            found[n] = ({r: before.get(r, 0) + ranks.get(r, 0) for r in before | ranks}, count + partnered)
        wanting = {n for n in wanting if found[n][1] < PARTNERED and high < len(samples[n][0])}
        low, high = high, 4 * high
    for n, grid in grids.items():
        ranks, partnered = found[n]
        if ranks:
            own = sorted(ranks.items())
            reached = np.cumsum([w for _, w in own])
            grid.visits = max(LEAST_VISITS, own[int(np.searchsorted(reached, recall * reached[-1] - 1e-9))][0] + 1)
        if partnered < PARTNERED and sizes[n] > len(samples[n][0]):
            grid.visits = max(grid.visits, planted_visits(grid, samples[n][1][:PLANTED], cosine, recall))
    return grids


def asked_ranks(classes: DataFrame, grids: dict[int, Grid], asked: dict[int, tuple[np.ndarray, np.ndarray]], cosine: float) -> dict[int, tuple[dict[int, float], int]]:
    """Per length, at which rank the asked queries meet their partners among all classes, every query with weight one in
    all, and how many queries have a partner."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in by_length(batch):
                length = len(whole.column("embedding")[0])
                if length not in asked:
                    continue
                for at in range(0, whole.num_rows, 2048):
                    part = whole.slice(at, 2048)
                    x, cid, grid = matrix(part.column("embedding")), part.column("cid").to_numpy(), grids[length]
                    step = max(64, DISTANCES // grid.k)
                    cell = np.concatenate([grid.cells(x[i:i + step]) for i in range(0, len(x), step)])
                    for start in range(0, len(asked[length][0]), 1024):
                        ids, q = (v[start:start + 1024] for v in asked[length])
                        qi, xi = np.nonzero((q @ x.T >= cosine) & (ids[:, None] != cid[None]))
                        if not len(qi):
                            continue
                        pairs, n = np.unique(np.stack([qi, cell[xi]], 1), axis=0, return_counts=True)
                        a, b = grid.near(q)
                        rank = [grid.rank(a[i], b[i], c) for i, c in pairs.tolist()]
                        yield pa.RecordBatch.from_pydict({"length": pa.array([length] * len(rank), pa.int32()), "query": ids[pairs[:, 0]],
                                                          "rank": pa.array(rank, pa.int64()), "n": pa.array(n, pa.int64())})

    met = (classes.select("cid", "embedding").mapInArrow(hits, "length int, query long, rank long, n long")
           .groupBy("length", "query", "rank").agg(F.sum("n").alias("n")))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("length", "query"))
    rows = met.withColumn("share", share).groupBy("length", "rank").agg(F.sum("share").alias("w")).collect()
    ranks: dict[int, dict[int, float]] = {}
    for r in rows:
        ranks.setdefault(r["length"], {})[r["rank"]] = r["w"]
    return {n: (own, round(sum(own.values()))) for n, own in ranks.items()}


def planted_visits(grid: Grid, points: np.ndarray, cosine: float, recall: float) -> int:
    """Visits after which this share of pairs at exactly the cosine is found from either side: points and their
    perturbations in random directions."""
    if points.shape[1] < 2:
        return LEAST_VISITS
    away = np.random.default_rng(17).normal(size=points.shape)
    away -= (away * points).sum(1, keepdims=True) * points
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    moved = cosine * points + np.sqrt(1 - cosine * cosine) * away
    ranks = []
    for x, y in ((points, moved), (moved, points)):
        (a, b), cell = grid.near(x), grid.cells(y).tolist()
        ranks.append([grid.rank(a[i], b[i], c) for i, c in enumerate(cell)])
    least = np.sort(np.minimum(*ranks))
    return int(least[min(len(least), int(np.ceil(recall * len(least)))) - 1]) + 1


def placed(classes: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """Every class with its cell and the cells it visits; the length is part of a cell's name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole in by_length(batch):
                length = len(whole.column("embedding")[0])
                grid, name = grids[length], length << 32
                rows = max(64, min(1024, DISTANCES // grid.k))
                for at in range(0, whole.num_rows, rows):
                    part = whole.slice(at, rows)
                    x = matrix(part.column("embedding"))
                    seen = grid.visited(x) + name
                    yield pa.RecordBatch.from_arrays(
                        [part.column("cid"), part.column("n"), part.column("embedding"), pa.array(grid.cells(x) + name),
                         pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * seen.shape[1], seen.ravel())],
                        names=["cid", "n", "embedding", "cell", "visits"])

    kind = classes.schema["embedding"].dataType.simpleString()
    return classes.select("cid", "n", "embedding").mapInArrow(run, f"cid long, n long, embedding {kind}, cell long, visits array<long>")


def linked_parts(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected parts of a bipartite link matrix: a label for each row and column, equal within a part."""
    rows, columns = links.shape
    row_label, column_label = np.arange(rows), np.full(columns, rows)
    while True:
        low = np.where(links, row_label[:, None], rows).min(0, initial=rows)
        new_columns = np.minimum(column_label, low)
        new_rows = np.minimum(row_label, np.where(links, new_columns[None], rows).min(1, initial=rows))
        if (new_rows == row_label).all() and (new_columns == column_label).all():
            return row_label, column_label
        row_label, column_label = new_rows, new_columns


def compared(visitors: pa.Table, members: pa.Table, cosine: float) -> pa.Table:
    """Links between the visitors and the members of one block of one cell: per class how many vectors it links with that no
    other block counts, and a class of its connected part."""
    x, y = matrix(visitors.column("embedding").combine_chunks()), matrix(members.column("embedding").combine_chunks())
    own, other = visitors.column("cid").to_numpy(), members.column("cid").to_numpy()
    weight, cell = members.column("n").to_numpy(), visitors.column("cell").to_numpy()
    own_n, seen = visitors.column("n").to_numpy(), members.column("visits").combine_chunks()
    seen = seen.flatten().to_numpy().reshape(len(other), -1)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(own), BLOCK):
        part = slice(at, at + BLOCK)
        links = (x[part] @ y.T >= cosine) & (own[part, None] != other[None])
        i, j = np.nonzero(links)
        if not len(i):
            continue
        # A member that visits the visitor's cell meets it there too, and counts it there.
        alone = ~(seen[j] == cell[part][i][:, None]).any(1)
        row_label, column_label = linked_parts(links)
        names = own[part]
        rows, columns = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
        out.append((names[rows], np.bincount(i, weight[j], len(names)).astype(np.int64)[rows], names[row_label[rows]]))
        out.append((other[columns], np.bincount(j[alone], own_n[part][i[alone]], len(other)).astype(np.int64)[columns], names[column_label[columns]]))
    columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3)]
    return pa.table(dict(zip(("cid", "links", "part"), columns)))


def links_of(index: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(cid, links, part) rows of all blocks. Cells of many members are dealt into blocks by a hash of the class."""
    counts = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    counts = staged(counts, "cells")
    members = (index.join(counts, "cell").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
               .select("cell", "block", "cid", "n", "embedding", "visits"))
    visitors = (index.select("cid", "n", "embedding", "cell", F.explode("visits").alias("to")).join(counts.withColumnRenamed("cell", "to"), "to")
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    # The visitors of a cell are dealt too: a member block meets each share of them in a task of its own.
    crowd = staged(visitors.groupBy("to").agg(F.ceil(F.count(F.lit(1)) / F.max("blocks") / (4 * BLOCK)).alias("shares")), "crowds")
    visitors = (visitors.join(crowd, "to").withColumn("share", F.pmod(F.xxhash64("cid", F.lit(1)), F.col("shares")))
                .select(F.col("to").alias("go"), "block", "share", "cid", "n", "embedding", "cell"))
    members = (members.join(crowd.withColumnRenamed("to", "cell"), "cell")
               .withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
               .select(F.col("cell").alias("go"), "block", "share", "cid", "n", "embedding", "visits")
               .toDF("go", "block", "share", "cid", "n", "embedding", "visits"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: np.zeros(0, np.int64) for c in ("cid", "links", "part")})
        return compared(left, right, cosine)

    by = ("go", "block", "share")
    return visitors.groupBy(*by).cogroup(members.groupBy(*by)).applyInArrow(run, "cid long, links long, part long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    ship(vectors.sparkSession)
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    with scratch(vectors.sparkSession):
        classes = staged(rows.filter(usable()).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
                         .withColumn("cid", F.monotonically_increasing_id()), "classes")
        index = staged(placed(classes, fitted(classes, cosine, recall)), "index")
        found = staged(links_of(index, cosine), "links")
        counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
        labels = components(found.select(F.col("cid").alias("a"), F.col("part").alias("b"))).withColumnRenamed("node", "cid")
        named = staged(classes.join(counts, "cid", "left").join(labels, "cid", "left")
                       .select("embedding", "rep", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("comp", "cid").alias("comp")), "named")
        least = staged(named.groupBy("comp").agg(F.min("rep").alias("component_id")), "least")
        members = staged(named.join(least, "comp").select("embedding", "n_links", "component_id"), "members", keep=True)
    good = rows.filter(usable()).join(members, "embedding", "left").select("vec_id", "n_links", "component_id")
    bad = rows.filter(~usable())
    alone = bad.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_multi_index(spark, sf_dir):
    """Links and components of all embeddings."""
    return near_vectors(read(spark, sf_dir, "embeddings"))
