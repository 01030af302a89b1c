"""Connected components of a table of links: forests of bounded parts, then alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import shared

#: Links that one task contracts to a forest, on average.
PART_LINKS = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links but the smallest of its component, and that smallest one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        p, q = label[x], label[y]
        apart = p != q
        if not apart.any():
            break
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a part as a forest of stars, no more of them than nodes."""
    ends = [np.empty((2, 0), np.int64)]
    ends += [np.stack([batch.column(k).to_numpy() for k in range(2)]) for batch in batches]
    yield pa.RecordBatch.from_arrays([pa.array(v) for v in forest(*np.concatenate(ends, axis=1))], ["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of each node are linked to the smallest of them and itself.

    The large star moves a node's larger neighbours, on both directions of each edge; the small star
    moves the smaller ones and the node itself. Both are an aggregate and a join of plain shuffles, so
    the neighbours of a node are never together in one task.
    """
    if large:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    moved = both.join(low, F.col("a") == F.col("n"))
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of a link; long ids.

    ``links`` are written tables or a union of such, as they are counted first. NULL ends are left out; a node
    linked only to itself has no row. Parts of about ``PART_LINKS`` links become forests, each in its task and
    without a shuffle; the forests of several parts are contracted together, and each round is kept in the
    shared folder, so a lost executor costs a round.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b"))
    parts = -(-max(1, edges.count()) // PART_LINKS)
    edges = shared.kept(edges.coalesce(parts).mapInArrow(shared.lean(_forests), "a long, b long"))
    before = None
    while parts > 1:
        edges = shared.kept(_star(_star(edges, True), False))
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if mark == before:
            break
        before = mark
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
