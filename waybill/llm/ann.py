"""Nearest neighbours by cosine from balanced posting lists with a graph over their centroids.

The lists' centroids come from a bounded sample, every vector is filed: under its nearest centroid and,
near a boundary, under others almost as near. A query walks the centroid graph, keeps the lists whose
distance is within a ratio of the nearest one's, and is compared exactly with the vectors in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared


@dataclass(frozen=True)
class Settings:
    """``sample``: vectors that the centroids are fitted on. ``per_list``: vectors aimed at in a list;
    beyond ``max_lists`` lists they grow instead, and are compared in cells of ``cell`` vectors."""

    sample: int = 20_000
    per_list: int = 256
    max_lists: int = 4096
    replicas: int = 4
    file_ratio: float = 1.1
    probes: int = 96
    search_ratio: float = 1.35
    beam: int = 128
    cell: int = 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


class Lists:
    """Centroids and the graph that joins each to its nearest ones."""

    def __init__(self, sample: np.ndarray, count: int, degree: int = 24, rounds: int = 12):
        rng = np.random.default_rng(6)
        x = unit(sample.astype(np.float64)).astype(np.float32)
        count = max(1, min(count, len(x)))
        self.centroids = x[rng.permutation(len(x))[:count]].copy()
        load = np.zeros(count, np.float32)
        for _ in range(rounds):
            # Full lists look farther away, which evens the lists out.
            near = x @ self.centroids.T - load
            mine = near.argmax(axis=1)
            sizes = np.bincount(mine, minlength=count)
            load += 0.02 * (sizes / (len(x) / count) - 1).clip(-1, 2).astype(np.float32)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, mine, x)
            filled = sizes > 0
            self.centroids[filled] = unit(sums[filled])
        near = self.centroids @ self.centroids.T
        order = np.argsort(-near, axis=1, kind="stable")[:, 1 : degree + 1]
        # A ring through all centroids keeps the graph connected.
        ring = np.stack([(np.arange(count) + 1) % count, (np.arange(count) - 1) % count], 1)
        self.links = np.hstack([order, ring]).astype(np.int64)
        self.entry = int((self.centroids @ self.centroids.mean(axis=0)).argmax())

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """``beam`` centroids of each row by best-first walks of the graph, nearest first, and distances."""
        q, count = len(x), len(self.centroids)
        beam = min(beam, count)
        scores = np.full((q, beam), -np.inf, np.float32)
        ids = np.zeros((q, beam), np.int64)
        ids[:, 0], scores[:, 0] = self.entry, x @ self.centroids[self.entry]
        seen = np.zeros((q, count), bool)
        seen[:, self.entry] = True
        done = np.zeros((q, beam), bool)
        rows = np.arange(q)
        for _ in range(4 * beam):
            open_ = np.where(done | np.isneginf(scores), -np.inf, scores)
            best = open_.argmax(axis=1)
            go = ~np.isneginf(open_[rows, best])
            if not go.any():
                break
            r = rows[go]
            done[r, best[go]] = True
            to = self.links[ids[r, best[go]]]
            new = np.einsum("qd,qnd->qn", x[r], self.centroids[to])
            new[seen[r[:, None], to]] = -np.inf
            to_sorted = np.sort(to, axis=1)
            if (to_sorted[:, 1:] == to_sorted[:, :-1]).any():
                for k in range(1, to.shape[1]):
                    new[:, k][(to[:, :k] == to[:, k : k + 1]).any(axis=1)] = -np.inf
            seen[r[:, None], to] = True
            pool = np.hstack([scores[r], new])
            keep = np.argpartition(-pool, beam - 1, axis=1)[:, :beam]
            scores[r] = np.take_along_axis(pool, keep, 1)
            ids[r] = np.take_along_axis(np.hstack([ids[r], to]), keep, 1)
            done[r] = np.take_along_axis(np.hstack([done[r], np.zeros(to.shape, bool)]), keep, 1)
        order = np.argsort(-scores, axis=1, kind="stable")
        scores = np.take_along_axis(scores, order, 1)
        distance = np.sqrt(np.maximum(0, 2 - 2 * scores.astype(np.float64)))
        return np.take_along_axis(ids, order, 1), np.where(np.isneginf(scores), np.inf, distance)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column as a float64 matrix; all rows have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` of the vectors that take part.

    NULL, empty and zero vectors and those with a NULL or non-finite part do not, nor do those of
    another length than the most frequent one (the smaller of two equally frequent).
    """
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    live = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        v.isNotNull() & F.col("vec_id").isNotNull() & (F.size(v) > 0) & sound & F.exists(v, lambda x: x != 0)
    )
    sizes = live.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return live.where(F.size("v") == (sizes[0]["size"] if sizes else 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """The ``k`` nearest vectors found for every query: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    The score is the cosine in double precision on the original vectors; ties go to the smaller vec_id; a
    query is no candidate of its own. Vectors that take no part (see ``usable``) are neither candidates
    nor queries. Rows of equal vectors are searched as one of which the ``k + 1`` smallest ids are kept,
    which is exact as no query can need more, so a vector that fills a third of the table is one entry.
    A row repeated with its id counts once. Every list that a query keeps is compared whole.
    """
    s = settings
    spark = vectors.sparkSession
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = (
        usable(vectors, key, vector)
        .dropDuplicates(["vec_id", "v"])
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= k + 1)
        .groupBy("v")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    entries = shared.kept(kept)
    total = entries.count()
    sample = entries.select("v").orderBy(F.xxhash64("v")).limit(s.sample).toArrow()["v"].combine_chunks() if total else None
    if sample is None or not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = Lists(_matrix(sample), min(s.max_lists, total // s.per_list))
    sent = spark.sparkContext.broadcast(lists)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, far = sent.value.nearest(unit(_matrix(part.column(0))).astype(np.float32), s.replicas * 4)
                ids, far = ids[:, : s.replicas], far[:, : s.replicas]
                row, col = np.nonzero(far <= np.maximum(far[:, :1] * s.file_ratio, 1e-6))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col]), part.column(0).take(take), part.column(1).take(take)], ["list", "v", "ids"])

    filed = shared.kept(entries.select("v", "ids").mapInArrow(file, "list long, v array<double>, ids array<long>"))
    sizes = {r["list"]: r["n"] for r in filed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.array([sizes.get(i, 0) for i in range(len(lists.centroids))])
    enough = s.replicas * (k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, far = sent.value.nearest(unit(_matrix(part.column(1))).astype(np.float32), s.beam)
                # Lists beyond the ratio are kept only while those before hold too few vectors.
                held = np.cumsum(counts[ids], axis=1) - counts[ids]
                near = (far <= far[:, :1] * s.search_ratio) & (np.arange(ids.shape[1]) < s.probes)
                row, col = np.nonzero((near | (held < enough)) & np.isfinite(far))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(ids[row, col]), part.column(0).take(take), part.column(1).take(take)], ["list", "query_id", "v"])

    asked = usable(queries, key, vector).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), "v")
    probes = shared.kept(asked.mapInArrow(probe, "list long, query_id long, v array<double>"))
    asked_of = {r["list"]: r["n"] for r in probes.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    grid = spark.createDataFrame(
        [(i, -(-n // s.cell), -(-asked_of[i] // s.cell)) for i, n in sizes.items() if i in asked_of] or [(-1, 1, 1)],
        "list long, rows int, columns int",
    )
    # A long or much asked list is a grid of cells: its vectors dealt to rows, its queries to columns.
    grid = F.broadcast(grid)
    left = filed.join(grid, "list").select(
        "list",
        F.pmod(F.xxhash64("v"), F.col("rows")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
        F.lit(None).cast("long").alias("query_id"),
        "ids",
        "v",
    )
    right = probes.join(grid, "list").select(
        "list",
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.pmod(F.xxhash64("query_id"), F.col("columns")).cast("int").alias("column"),
        "query_id",
        F.lit(None).cast("array<long>").alias("ids"),
        "v",
    )

    def compare(cell: pa.Table) -> pa.Table:
        asks = cell["query_id"].is_valid().to_numpy()
        v = _matrix(cell["v"].combine_chunks())
        ids = cell["ids"].take(pa.array(np.flatnonzero(~asks))).combine_chunks()
        names = cell["query_id"].to_numpy()[asks]
        out: list[tuple] = []
        if len(ids) and len(names):
            first = np.array([x[0].as_py() for x in ids])
            order = np.argsort(first, kind="stable")
            entries = v[~asks][order]
            size = np.linalg.norm(entries, axis=1)
            for at in range(0, len(names), 256):
                q = v[asks][at : at + 256]
                score = (q @ entries.T) / (np.linalg.norm(q, axis=1)[:, None] * size[None, :])
                top = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                for i, best in enumerate(top):
                    out += [(int(names[at + i]), ids[int(order[j])].as_py(), float(score[i, j])) for j in best]
        query, near, value = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(query, pa.int64()), "ids": pa.array(near, pa.list_(pa.int64())), "score": pa.array(value, pa.float64())})

    found = left.unionByName(right).groupBy("list", "row", "column").applyInArrow(compare, "query_id long, ids array<long>, score double")
    each = found.select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
    best = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
