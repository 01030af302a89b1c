"""Importance resampling of documents towards a target's distribution of hashed n-grams.

Features are words and pairs of neighbouring words, counted in buckets. A bucket's gain is the
logarithm of how much likelier it is in the target than in the documents; a document's weight is the
mean gain of its features. Adding Gumbel noise to the weights and taking the highest scores draws
without replacement, with chances that follow the weights.

Text is handled by Arrow's kernels: ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode``; neighbouring indices form the pairs, each distinct word or pair is hashed once
per slice, and gains are taken by index and summed by segment. Spark adds the counts of all tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared, words

#: What stands between words: ASCII signs other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SLICE_BYTES = 4 << 20
WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def _crc(strings: pa.Array) -> np.ndarray:
    data, offsets = words.utf8(strings)
    raw, ends = memoryview(data.tobytes()), offsets.tolist()
    return np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])), np.int64, len(strings))


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of ``texts``, the row of each, and each row's number of words.

    All words come first, then all pairs; within both, rows are in order. NULL is the empty text.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
    word, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(word, "")
    coded = word.filter(full).dictionary_encode()
    row = row.filter(full).to_numpy()
    index, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    n_words = np.bincount(row, minlength=len(texts))
    if not len(index):
        return np.empty(0, np.int64), np.empty(0, np.int64), n_words
    same = row[1:] == row[:-1]
    pairs = pa.array((index[:-1] * len(known) + index[1:])[same]).dictionary_encode()
    code = pairs.dictionary.to_numpy()
    joined = pc.binary_join_element_wise(known.take(pa.array(code // len(known))), known.take(pa.array(code % len(known))), pa.scalar(" ", known.type))
    of_word, of_pair = _crc(known) % buckets, _crc(joined) % buckets
    return (
        np.concatenate([of_word[index], of_pair[pairs.indices.to_numpy()]]),
        np.concatenate([row, row[1:][same]]),
        n_words,
    )


def _slices(column: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    column = column.cast(pa.large_string())
    _, offsets = words.utf8(column)
    for a, b in words.slices(offsets, SLICE_BYTES):
        yield a, b, column.slice(a, b - a)


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """How often each bucket occurs in all texts: ``bucket``, ``n``. Buckets that do not occur are left out.

    A task adds up its own counts, so at most ``buckets`` rows of each task are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in _slices(batch.column(0)):
                total += np.bincount(features(texts, buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return df.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """A bucket's gain: ``floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))``, by bucket.

    ``s``, ``t`` are the bucket's counts in the documents and the target, ``S``, ``T`` the sums. Exactly
    ``buckets`` numbers come to the driver, however large the tables are.
    """
    found = np.zeros((2, buckets))
    for k, df in enumerate((documents, target)):
        for r in bucket_counts(df, text, buckets).collect():
            found[k, r["bucket"]] = r["n"]
    (s, t), (all_s, all_t) = found, found.sum(1)
    ratio = ((t + 1) * (all_s + buckets)) / ((s + 1) * (all_t + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(df: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``doc_id``, ``n_words``, ``n_features`` and ``weight``: the floored mean gain of its features.

    A text without words (NULL and empty too) has weight 0. Repeated rows stay repeated.
    """
    sent = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in batches:
            for a, b, texts in _slices(batch.column(1)):
                bucket, row, n_words = features(texts, len(of))
                n = np.bincount(row, minlength=b - a)
                total = np.bincount(row, of[bucket], b - a).astype(np.int64)  # exact: whole numbers far below 2**53
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight))],
                    [x.split()[0] for x in WEIGHED.split(", ")],
                )

    return df.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(run, WEIGHED)


def noise(key: str, seed: int):
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of ``seed:key``; NULL keys are empty strings."""
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """Rows of ``df`` numbered from 1 along ``order``, each range of the order by a task of its own.

    Ranges are written once, so that their counts and their rows are the same on every attempt.
    """
    ranged = shared.table(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_place", place).join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_before") + F.col("_place")).cast("long").alias(name)
    )


def resampled(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every document's ``doc_id, n_features, weight, score, rank``; ``rank`` is NULL if it is not drawn.

    Of the N documents with ``least_words`` words or more the ``floor(percent * N / 100)`` of highest score
    are drawn, ranked from 1, ties to the smaller ``doc_id`` (NULL first). Repeated rows are documents of
    their own with the same score and neighbouring ranks. Documents with fewer words, NULL and empty texts
    are scored but never drawn; empty tables give no rows, and without target texts all weights follow
    from the documents' counts alone. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = weighed(docs, gains(docs, target.select("text"), "text", buckets))
    scored = shared.table(scored.withColumn("score", F.col("weight") + noise("doc_id", seed)), "scores")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered(scored.where(enough).select(*columns), [F.desc("score"), F.asc("doc_id")], "rank")
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
