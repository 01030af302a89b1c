"""Collocations by prefix-free parsing: phrases are counted in a dictionary of chunks, not in the texts.

A text is cut into pieces, a piece into words, and a piece's words into chunks wherever the hash of the
next ``longest - 1`` words triggers. Cuts depend on these words alone, so equal passages fall into equal
chunks wherever they stand. Neighbouring chunks overlap by the words of the trigger; a phrase belongs to
the chunk in which it begins, so each occurrence is counted once, also where it reaches into the overlap.
Spark counts how often each distinct chunk was parsed (hash aggregates with map-side combine), and all
later work reads the distinct chunks with these frequencies as weights.

Counts are exact: grouping is by the words themselves. Words are counted first, then pairs, then longer
phrases. A phrase can only reach the wanted count if its words and pairs do, so pairs with a rarer word
and longer phrases with a rarer pair are not emitted at all. What is frequent is held in a bitmap of fixed
size (``BITS``), which may let a rare phrase through to be counted and dropped, but never holds a frequent
one back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared, words

LONGEST = 4
#: One window of words in so many triggers a cut.
TRIGGER = 16
#: Bits of the map of frequent words or pairs (8 MiB), whatever the input's size; a power of two.
BITS = 1 << 26
BLOCK_BITS = 1 << 15
SLICE_BYTES = 2 << 20
#: Rows that one task ranks at a time.
RANK_ROWS = 50_000

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _PIECE_END.copy()
_GAP[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def gathered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings ``data[start:end]``."""
    size = end - start
    close = np.cumsum(size)
    total = int(close[-1]) if len(close) else 0
    out = data[np.arange(total) + np.repeat(start - (close - size), size)]
    offsets = pa.py_buffer(np.append(0, close).astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(start), [None, offsets, pa.py_buffer(out)])


def chunks(data: np.ndarray, offsets: np.ndarray, longest: int = LONGEST, trigger: int = TRIGGER) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Row, words joined by one space, and whether a piece ends with it, of every chunk of some texts."""
    data = _LOWER[data]
    inside = ~_GAP[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~(inside[:-1] & ~first[1:-1])
    closes[:-1] &= ~(inside[1:] & ~first[1:-1])
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    n = len(start)
    if not n:
        return np.empty(0, np.int64), pa.array([], pa.large_string()), np.empty(0, bool)
    row = np.searchsorted(offsets, start, "right") - 1
    piece = np.cumsum(_PIECE_END[data])[start]
    fresh = np.ones(n, bool)
    fresh[1:] = (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])
    # The words with one space after each.
    size = end - start + 1
    close = np.cumsum(size)
    at = close - size
    stream = data[np.minimum(np.arange(close[-1]) + np.repeat(start - at, size), len(data) - 1)]
    stream[close - 1] = 32
    # Windows of longest - 1 words of one piece whose hash triggers, but for a piece's first.
    overlap = longest - 1
    cut = np.zeros(n, bool)
    if n >= overlap:
        whole = n - overlap + 1
        fits = np.ones(whole, bool)
        for k in range(1, overlap):
            fits &= ~fresh[k : k + whole]
        hashes = words.span_hash(words.prefix_hash(stream), at[:whole], close[overlap - 1 :] - 1)
        cut[:whole] = fits & (hashes % np.uint64(trigger) == 0)
    begin = np.flatnonzero(fresh | cut)
    until = np.append(begin[1:], n)
    final = np.append(fresh[begin[1:]], True)
    last_word = np.where(final, until, until + overlap) - 1
    return row[begin], gathered(stream, at[begin], close[last_word] - 1), final


def sections(data: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Parts of a long text of about ``limit`` bytes, cut behind the end of a piece; without one it stays whole."""
    begin = 0
    while len(data) - begin > limit:
        cut = 0
        for low in range(begin + limit, len(data), limit):
            places = np.flatnonzero(_PIECE_END[data[low : low + limit]])
            if len(places):
                cut = low + int(places[0]) + 1
                break
        if not cut:
            break
        yield begin, cut
        begin = cut
    yield begin, len(data)


def dictionary(documents: DataFrame, longest: int = LONGEST, trigger: int = TRIGGER) -> DataFrame:
    """The distinct chunks of all texts: ``lang, final, chunk, n``, ``n`` the times they were parsed.

    ``lang`` NULL counts as ``und``; NULL and empty texts have no chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0)
            data, offsets = words.utf8(batch.column(1))
            for a, b in words.slices(offsets, SLICE_BYTES):
                part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                parts = [(part, bounds)]
                if b - a == 1 and len(part) > SLICE_BYTES:
                    parts = ((part[i:j], np.array([0, j - i])) for i, j in sections(part))
                for text, ends in parts:
                    row, chunk, final = chunks(text, ends, longest, trigger)
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [lang.slice(a, b - a).take(pa.array(row)), pa.array(final), chunk.cast(pa.string())], ["lang", "final", "chunk"]
                        )

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    parsed = documents.select(lang, F.col("text").cast("string").alias("text")).mapInArrow(run, "lang string, final boolean, chunk string")
    return parsed.groupBy("lang", "final", "chunk").agg(F.count(F.lit(1)).alias("n"))


class Chunks:
    """The words of a slice of distinct chunks, and where the phrases that belong to them begin."""

    def __init__(self, chunk: pa.Array, final: np.ndarray, weight: np.ndarray, longest: int):
        self.data, offsets = words.utf8(chunk)
        gap = np.flatnonzero(self.data == 32)
        heads = offsets[:-1]
        self.start = np.sort(np.concatenate([heads, gap + 1]))
        first = np.searchsorted(self.start, heads)
        n_words = np.diff(np.append(first, len(self.start)))
        self.row = np.repeat(np.arange(len(heads)), n_words)
        self.end = np.append(self.start[1:] - 1, offsets[-1])
        closing = np.append(first[1:], len(self.start)) - 1
        self.end[closing] = offsets[1:]
        own = n_words - np.where(final, 0, longest - 1)
        place = np.arange(len(self.start)) - first[self.row]
        self.left = n_words[self.row] - place
        self.owned = place < own[self.row]
        self.weight = weight[self.row]

    def phrases(self, size: int) -> np.ndarray:
        """First words of the phrases of ``size`` words that belong to these chunks."""
        return np.flatnonzero(self.owned & (self.left >= size))

    def strings(self, begin: np.ndarray, size: int) -> pa.Array:
        return gathered(self.data, self.start[begin], self.end[begin + size - 1])

    def bits(self, seeds: np.ndarray, bits: int, unit: int) -> np.ndarray:
        """The place in the bitmap of the ``unit`` words from every word on."""
        begin = np.flatnonzero(self.left >= unit)
        out = np.zeros(len(self.start), np.int64)
        hashes = words.span_hash(words.prefix_hash(self.data), self.start[begin], self.end[begin + unit - 1])
        out[begin] = (words.mixed(hashes ^ seeds[self.row[begin]]) & np.uint64(bits - 1)).astype(np.int64)
        return out


def _seeds(langs: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    data, offsets = words.utf8(langs)
    return words.span_hash(words.prefix_hash(data), offsets[:-1], offsets[1:]) if len(data) else np.zeros(len(langs), np.uint64)


def _summed(lang: pa.Array, chosen: Chunks, found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Weighted counts of the phrases that begin at the given words, equal ones of a slice added up."""
    out = []
    langs = lang.dictionary_encode()
    for size, begin in found:
        if len(begin):
            key = langs.indices.take(pa.array(chosen.row[begin]))
            t = pa.table({"k": key, "phrase": chosen.strings(begin, size), "n": pa.array(chosen.weight[begin])})
            t = t.group_by(["k", "phrase"], use_threads=False).aggregate([("n", "sum")])
            out.append((langs.dictionary.take(t["k"].combine_chunks()), size, t["phrase"], t["n_sum"]))
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([x[0] for x in out]),
            pa.array(np.repeat(np.array([x[1] for x in out], np.int32), [len(x[0]) for x in out])),
            pa.chunked_array([c for x in out for c in x[2].chunks]).cast(pa.string()).combine_chunks(),
            pa.chunked_array([c for x in out for c in x[3].chunks]).combine_chunks(),
        ],
        ["lang", "size", "phrase", "n"],
    )


def _parts(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[pa.Array, Chunks]]:
    for batch in batches:
        lang, chunk = batch.column(0), batch.column(2)
        final, n = batch.column(1).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
        _, offsets = words.utf8(chunk)
        for a, b in words.slices(offsets, SLICE_BYTES):
            yield lang.slice(a, b - a), Chunks(chunk.slice(a, b - a), final[a:b], n[a:b], longest)


COUNTED = "lang string, size int, phrase string, n long"


def _added(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def word_counts(chunks_: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Counts of all words; rows of size 0 hold a language's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in _parts(batches, longest):
            begin = part.phrases(1)
            yield _summed(lang, part, [(1, begin)])
            langs = lang.dictionary_encode()
            total = np.bincount(langs.indices.to_numpy()[part.row[begin]], part.weight[begin], len(langs.dictionary))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary, pa.array(np.zeros(len(total), np.int32)), pa.array([""] * len(total)), pa.array(total.astype(np.int64))],
                ["lang", "size", "phrase", "n"],
            )

    return _added(chunks_.mapInArrow(run, COUNTED))


def phrase_map(phrases: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap of phrases as bytes: blocks of it are built by Spark, at most ``bits`` bits reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.utf8(batch.column(1))
            hashes = words.span_hash(words.prefix_hash(data), offsets[:-1], offsets[1:]) if len(data) else np.zeros(len(batch), np.uint64)
            place = (words.mixed(hashes ^ _seeds(batch.column(0))) & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place // BLOCK_BITS), pa.array(place % BLOCK_BITS)], ["block", "bit"])

    placed = phrases.select("lang", "phrase").mapInArrow(run, "block long, bit long")
    blocks = placed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
    out = np.zeros(max(bits, BLOCK_BITS) // 8, np.uint8)
    for r in blocks:
        out[r["block"] * (BLOCK_BITS // 8) :][: BLOCK_BITS // 8] = np.frombuffer(r["map"], np.uint8)
    return out


def pruned_counts(chunks_: DataFrame, frequent: np.ndarray, unit: int, sizes: range, longest: int = LONGEST) -> DataFrame:
    """Counts of the phrases of ``sizes`` words whose runs of ``unit`` words are all in the bitmap."""
    sent, bits = chunks_.sparkSession.sparkContext.broadcast(frequent), len(frequent) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for lang, part in _parts(batches, longest):
            place = part.bits(_seeds(lang), bits, unit)
            good = (held[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool) & (part.left >= unit)
            found, all_good = [], good
            for size in range(unit + 1, sizes.stop):
                all_good = all_good[: max(0, len(good) - size + unit)] & good[size - unit :]
                if size in sizes:
                    begin = part.phrases(size)
                    found.append((size, begin[all_good[begin]]))
            if any(len(begin) for _, begin in found):
                yield _summed(lang, part, found)

    return _added(chunks_.mapInArrow(run, COUNTED))


def frequent_phrases(documents: DataFrame, least: int = 30, longest: int = LONGEST, trigger: int = TRIGGER, bits: int = BITS) -> DataFrame:
    """All phrases of 1 to ``longest`` words with ``least`` occurrences or more in their language, counted exactly.

    ``lang, size, phrase, n``; rows of size 0 (phrase empty) hold the number of words of the language.
    """
    parsed = shared.table(dictionary(documents, longest, trigger), "chunks")
    counted = shared.table(word_counts(parsed, longest).where((F.col("n") >= least) | (F.col("size") == 0)), "words")
    for unit, sizes in ((1, range(2, 3)), (2, range(3, longest + 1))):
        frequent = phrase_map(counted.where(F.col("size") == unit), bits)
        longer = pruned_counts(parsed, frequent, unit, sizes, longest).where(F.col("n") >= least)
        counted = shared.table(counted.unionByName(longer), "phrases")
    return counted


def first_per_group(df: DataFrame, key: str, order: list, limit: int, rows: int = RANK_ROWS) -> DataFrame:
    """The first ``limit`` rows of each group along ``order``, ranked from 1; no task ranks a large group.

    Rows are dealt to as many parts as keep a part near ``rows``, each part gives up all but its first
    ``limit`` rows, and this is repeated until all that is left fits one part.
    """
    left = df.count()
    while left > max(rows, 2 * limit):
        parts = math.ceil(left / max(rows, 2 * limit))
        part = Window.partitionBy(key, "_part").orderBy(*order)
        df = df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(parts)))
        df = shared.table(df.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= limit).drop("_part", "_rank"), "first")
        before, left = left, df.count()
        if left == before:
            break
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")).where(F.col("rank") <= limit)


def collocations(
    documents: DataFrame,
    least: int = 30,
    longest: int = LONGEST,
    share: int = 80,
    limit: int = 2000,
    trigger: int = TRIGGER,
    bits: int = BITS,
) -> DataFrame:
    """Each language's first ``limit`` phrases by the cohesion of their weakest cut.

    A candidate has 2 to ``longest`` words and occurs ``a >= least`` times. A cut leaves a first part with
    ``l`` occurrences and a rest with ``r``; its score is ``floor(2000000 * a / (l + r))`` in whole numbers.
    The lowest cut counts, of equal ones that after the fewest words. A candidate goes if a longer one
    holds it and occurs at least ``share`` percent as often. Order: score and ``a`` descending, then the
    phrase's bytes. Returns ``lang, rank, phrase, a, l, r, n, score``; ``n`` counts the language's words.

    NULL languages are ``und``, NULL and empty texts have no words, repeated rows count as often as they
    come, an empty table gives no rows, other columns are ignored.
    """
    counted = frequent_phrases(documents, least, longest, trigger, bits)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    several = counted.where(F.col("size") >= 2).select("lang", "size", "phrase", F.col("n").alias("a"))
    parts = counted.where(F.col("size").between(1, longest - 1))
    cuts = several.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", F.col("_k").alias("k"),
        F.expr("substring_index(phrase, ' ', _k)").alias("_first"),
        F.expr("substring_index(phrase, ' ', _k - size)").alias("_rest"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_first"), F.col("n").alias("l")), ["lang", "_first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_rest"), F.col("n").alias("r")), ["lang", "_rest"])
    twice = F.lit(2_000_000).cast("decimal(7,0)") * exact("a")
    cuts = cuts.withColumns({"_twice": twice, "_both": exact("l") + exact("r")}).withColumn("score", F.expr("_twice div _both"))
    weakest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    inner = several.where(F.col("size") > 2).withColumn("_words", F.split("phrase", " "))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda m: F.transform(
                F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice("_words", i, m), " ")
            ),
        )
    )
    covers = inner.select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    held = exact("_longer") * 100 >= exact("a") * share
    scored = weakest.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))
    scored = shared.table(scored.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score"), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    totals = counted.where(F.col("size") == 0).select("lang", "n")
    first = first_per_group(scored, "lang", order, limit)
    return first.join(totals, "lang").select(
        "lang", "rank", "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    )
