"""Benchmark items inside documents: size-partitioned MinHash search, exact containment after it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import shared, words

PERMUTATIONS = 64
CHUNK_SHINGLES = 1 << 20
PAIRS = "doc_id long, item_id long, containment double, n_shingles long"
_FACTORS = np.random.default_rng(7).integers(1, 1 << 62, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HIGH = np.uint64(32)


def _row_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(words per shingle, shingle hashes)`` of each row; a row of fewer than ``k`` words is one shingle."""
    hashes, first = words.word_hashes(data, offsets)
    counts = np.diff(first)
    for row, n in enumerate(counts):
        width = int(min(k, n))
        part = hashes[first[row] : first[row + 1]]
        yield width, words.shingle_hashes(part, np.array([0, n]), width)[0] if n else part


class Items:
    """The searched items: exact shingle sets, and for each size class a table of minimum hashes."""

    def __init__(self, ids: list[int], widths: list[int], sets: list[np.ndarray], k: int):
        self.ids, self.sets, self.k = ids, sets, k
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.array([1 << int(len(s) - 1).bit_length() for s in sets], np.int64)
        for size in np.unique(sizes):
            members = [i for i in np.flatnonzero(sizes == size) if widths[i] == k]
            if members:
                keys = np.concatenate([_keyed(_minima(sets[i], np.zeros(1, np.int64)))[0] for i in members])
                owner = np.repeat(members, PERMUTATIONS)
                order = np.argsort(keys, kind="stable")
                self.classes[int(size)] = (keys[order], owner[order])
        for width in sorted({w for w in widths if w < k}):
            members = [i for i, w in enumerate(widths) if w == width]
            keys = np.concatenate([sets[i] for i in members])
            order = np.argsort(keys, kind="stable")
            self.short[width] = (keys[order], np.array(members)[order])


def _minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minimum of each permutation over the blocks of ``shingles`` that begin at ``starts``."""
    out = np.empty((len(starts), PERMUTATIONS), np.uint32)
    for p, factor in enumerate(_FACTORS):
        out[:, p] = np.minimum.reduceat(((shingles * factor) >> _HIGH).astype(np.uint32), starts)
    return out


def _keyed(minima: np.ndarray) -> np.ndarray:
    """A minimum together with the number of its permutation."""
    return minima.astype(np.uint64) | (np.arange(PERMUTATIONS, dtype=np.uint64) << _HIGH)


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position in keys, owner)`` of every entry of ``table`` that equals a key."""
    left, right = np.searchsorted(table[0], keys, "left"), np.searchsorted(table[0], keys, "right")
    hit = np.flatnonzero(right > left)
    counts = (right - left)[hit]
    at = np.repeat(hit, counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return at, table[1][left[at] + offset]


def candidates(shingles: np.ndarray, first: np.ndarray, items: Items) -> np.ndarray:
    """``(row, item)`` pairs of which some window of the row shares a minimum hash with the item.

    A size class holds items of more than size / 2 up to ``size`` shingles. Its windows are two
    neighbouring blocks of ``size`` shingles, so every run of that length lies whole in one window
    and the window is at most four times the item: containment 0.75 means a Jaccard of 0.17 at
    least there, which all 64 permutations miss with a chance below 1e-5. The blocks of a larger
    class are unions of smaller ones, so the shingles are hashed once.
    """
    if not len(shingles) or not items.classes:
        return np.empty((0, 2), np.int64)
    sizes = sorted(items.classes)
    size, pairs = sizes[0], []
    counts = np.diff(first)
    blocks = -(-counts // size)
    rows = np.repeat(np.arange(len(counts)), blocks)
    begin = np.cumsum(blocks) - blocks
    within = np.arange(len(rows)) - begin[rows]
    minima = _minima(shingles, first[:-1][rows] + within * size)
    while True:
        if size in items.classes:
            windows = minima.copy()
            joined = np.flatnonzero(rows[1:] == rows[:-1])
            windows[joined] = np.minimum(minima[joined], minima[joined + 1])
            at, owner = _found(items.classes[size], _keyed(windows).ravel())
            if len(at):
                pairs.append(np.unique(np.stack([rows[at // PERMUTATIONS], owner], 1), axis=0))
        if size >= sizes[-1]:
            break
        even = np.flatnonzero(within % 2 == 0)
        minima = np.minimum.reduceat(minima, even, axis=0)
        rows, within, size = rows[even], within[even] // 2, size * 2
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)


def search(data: np.ndarray, offsets: np.ndarray, items: Items, least: float) -> Iterator[tuple[int, int, float]]:
    """``(row, item, containment)`` of the rows that hold at least ``least`` of an item's shingles."""
    hashes, first = words.word_hashes(data, offsets)
    shingles, starts = words.shingle_hashes(hashes, first, items.k)
    row, own = -1, shingles
    for r, i in candidates(shingles, starts, items):
        if r != row:
            row, own = r, shingles[starts[r] : starts[r + 1]]
        share = float(np.isin(items.sets[i], own).mean())
        if share >= least:
            yield int(r), int(i), share
    for width, table in items.short.items():
        grams, begin = words.shingle_hashes(hashes, first, width)
        at, owner = _found(table, grams)
        seen = np.unique(np.stack([np.searchsorted(begin, at, "right") - 1, owner], 1), axis=0) if len(at) else ()
        for r, i in seen:
            yield int(r), int(i), 1.0


def contained(
    documents: DataFrame,
    benchmark: DataFrame,
    least: float = 0.75,
    k: int = 5,
    chunk_shingles: int = CHUNK_SHINGLES,
    with_mark: bool = False,
) -> DataFrame:
    """Pairs of a document and an item of which it holds at least ``least`` of the distinct shingles.

    Reads ``doc_id``, ``text`` and ``item_id``, ``text``; other columns are ignored. Documents are
    scanned where they lie, without a shuffle. Items go to the executors in chunks of about
    ``chunk_shingles`` shingles, one scan per chunk, so what is sent never exceeds that bound.
    An item of fewer than ``k`` words is held by a document with these words in a row, an item
    without words by none. NULL texts hold nothing; NULL ids and repeated rows are kept as they are. ``with_mark``
    adds a hash of the document's text as ``mark``, which tells texts of one doc_id apart.
    """
    spark = documents.sparkSession
    schema = f"{PAIRS}, mark long" if with_mark else PAIRS
    marked = [F.col("doc_id").cast("long"), "text", *([_mark().alias("mark")] if with_mark else [])]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(len(s) for b in batches for _, s in _row_shingles(*words.utf8(b.column(0)), k))
        yield pa.RecordBatch.from_pydict({"n": [total]})

    total = benchmark.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    chunks = max(1, -(-total // chunk_shingles))
    out = None
    for chunk in range(chunks):
        picked = benchmark.select("item_id", "text").where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == chunk)
        ids, widths, sets = [], [], []
        listed = picked.toArrow()
        for item, (width, hashes) in zip(listed["item_id"].to_pylist(), _row_shingles(*words.utf8(listed["text"]), k)):
            if width:
                ids.append(item)
                widths.append(width)
                sets.append(np.unique(hashes))
        sent = spark.sparkContext.broadcast(Items(ids, widths, sets, k))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                data, offsets = words.utf8(batch.column(1))
                found = {"doc_id": [], "item_id": [], "containment": [], "n_shingles": [], **({"mark": []} if with_mark else {})}
                for a, b in words.slices(offsets, words.SMALL_SLICE_BYTES):
                    part = data[offsets[a] : offsets[b]]
                    for r, i, share in search(part, offsets[a : b + 1] - offsets[a], items, least):
                        found["doc_id"].append(batch.column(0)[a + r].as_py())
                        found["item_id"].append(items.ids[i])
                        found["containment"].append(share)
                        found["n_shingles"].append(len(items.sets[i]))
                        if with_mark:
                            found["mark"].append(batch.column(2)[a + r].as_py())
                if found["doc_id"]:
                    kinds = {"containment": pa.float64()}
                    yield pa.RecordBatch.from_pydict(found, pa.schema([(c, kinds.get(c, pa.int64())) for c in found]))

        part = documents.select(*marked).mapInArrow(shared.lean(scan), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _mark():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def clean(documents: DataFrame, benchmark: DataFrame, least: float = 0.75) -> DataFrame:
    """The documents, all columns, whose text holds no item.

    A row is judged by its own text: of rows that share a doc_id, or have none, those with an item go and
    the others stay.
    """
    held = contained(documents, benchmark, least, with_mark=True).select(F.col("doc_id").alias("_held"), F.col("mark").alias("_by")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_held")) & (_mark() == F.col("_by"))
    return documents.join(held, same, "left_anti").select(documents.columns)
