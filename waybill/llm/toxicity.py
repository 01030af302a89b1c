"""A linear-chain conditional random field that tags toxic spans and scores documents by them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import words
from waybill.llm.langid import held_out

BITS = 21
BLOCK = 64
PER_LABEL = (4000, 800)
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of letters (bytes from 0x80 on count), and each row's first run."""
    inside = _LETTER[data]
    opens, closes = inside.copy(), inside.copy()
    n = len(data)
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        heads, tails = offsets[:-1][offsets[:-1] < n], offsets[1:][offsets[1:] > 0] - 1
        opens[heads] |= inside[heads]
        closes[tails] |= inside[tails]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Buckets of each token's features: the word with A-Z as a-z, and its first 4, 5 and 6 bytes."""
    prefix = words.prefix_hash(data)
    shift = np.uint64(64 - BITS)
    out = np.empty((len(start), 1 + len(PREFIXES)), np.int32)
    out[:, 0] = words.span_hash(prefix, start, end) >> shift
    for k, size in enumerate(PREFIXES):
        span = words.span_hash(prefix, start, np.minimum(end, start + size))
        out[:, k + 1] = words.mixed(span + np.uint64(k + 1)) >> shift
    return out


@dataclass
class Field:
    """Weights of the tag *toxic* against *other*, log weights of the tag pairs, document weights."""

    weights: np.ndarray
    bias: float
    pairs: np.ndarray
    document: np.ndarray


def _blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of each block of ``BLOCK`` tokens (-1: none), each block's row and its number there."""
    counts = np.diff(first)
    per = -(-counts // BLOCK)
    row = np.repeat(np.arange(len(counts)), per)
    within = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    at = (first[:-1][row] + within * BLOCK)[:, None] + np.arange(BLOCK)
    return np.where(at < first[1:][row][:, None], at, -1), row, within


def marginals(emission: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Forward-backward over every row at once: ``P(toxic)`` of each token.

    Rows are cut into blocks. A block's product of transfer matrices takes the messages across it,
    so only the steps inside a block and the blocks of the longest row are loops.
    """
    at, row, within = _blocks(first)
    n = len(at)
    if not n:
        return np.zeros(0)
    at = np.ascontiguousarray(at.T)
    live = at >= 0
    odds = np.where(live, np.exp(np.clip(emission[at], -30, 30)), 1.0)
    (a, b), (c, d) = np.exp(pairs - pairs.max())
    m00, m01, m10, m11 = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
    for t in range(BLOCK):
        go, o = live[t], odds[t]
        n00, n01, n10, n11 = m00 * a + m01 * c, (m00 * b + m01 * d) * o, m10 * a + m11 * c, (m10 * b + m11 * d) * o
        size = n00 + n01 + n10 + n11
        m00, m01, m10, m11 = (np.where(go, x / size, y) for x, y in ((n00, m00), (n01, m01), (n10, m10), (n11, m11)))
    order = np.argsort(within, kind="stable")
    edges = np.searchsorted(within[order], np.arange(within.max() + 2))
    last = np.append(row[1:] != row[:-1], True)
    f, g = np.full(n, 0.5), np.ones(n) / 2
    for k in range(1, len(edges) - 1):
        i = order[edges[k] : edges[k + 1]]
        p, q = 1 - f[i - 1], f[i - 1]
        x, y = p * m00[i - 1] + q * m10[i - 1], p * m01[i - 1] + q * m11[i - 1]
        f[i] = y / (x + y)
    for k in reversed(range(len(edges) - 1)):
        i = order[edges[k] : edges[k + 1]]
        i = i[~last[i]]
        p, q = 1 - g[i + 1], g[i + 1]
        x, y = m00[i + 1] * p + m01[i + 1] * q, m10[i + 1] * p + m11[i + 1] * q
        g[i] = y / (x + y)
    ahead = np.empty((BLOCK, n))
    for t in range(BLOCK):
        x, y = (1 - f) * a + f * c, ((1 - f) * b + f * d) * odds[t]
        f = np.where(live[t], y / (x + y), f)
        ahead[t] = f
    for t in reversed(range(BLOCK)):
        y = ahead[t] * g
        x = (1 - ahead[t]) * (1 - g)
        ahead[t] = y / (x + y)
        q = g * odds[t]
        x, y = a * (1 - g) + b * q, c * (1 - g) + d * q
        g = np.where(live[t], y / (x + y), g)
    out = np.empty(first[-1])
    out[at[live]] = ahead[live]
    return out


def near_copies(feature: np.ndarray, first: np.ndarray, least: int = 3, hashes: int = 8) -> np.ndarray:
    """Family of each training row: rows share one if ``least`` of their minimum hashes are equal.

    The hashes are over runs of three tokens; the rows are a bounded sample.
    """
    word = words.mixed(feature[:, 0].astype(np.uint64) + np.uint64(1))
    family = np.arange(len(first) - 1)
    runs, begin = words.shingle_hashes(word, first, 3)
    live = np.flatnonzero(np.diff(begin))
    shared: dict[tuple[int, int], int] = {}
    for k in range(hashes):
        low = np.minimum.reduceat(words.mixed(runs + np.uint64(k)), begin[:-1][live]) if len(live) else runs[:0]
        order = np.argsort(low, kind="stable")
        for group in np.split(live[order], np.flatnonzero(np.diff(low[order])) + 1):
            for other in group[1:]:
                pair = (int(group[0]), int(other))
                shared[pair] = shared.get(pair, 0) + 1
    for (a, b), n in sorted(shared.items()):
        if n >= least:
            family[family == family[b]] = family[a]
    return family


def cues(feature: np.ndarray, first: np.ndarray, toxic: np.ndarray, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Tags of training tokens from the labels of their documents.

    Near copies count as one document, else the words of a much copied one would look like evidence.
    A feature is a cue if its share of the toxic documents is forty times its share of the others, and
    so many toxic ones hold it that, were they drawn from all, less than one in a hundred trials would
    show such a feature among all those seen. A token is toxic if its document is and one of its
    features is a cue. Returns the tags and the features that may carry weight: those whose share is
    at least forty times the other.
    """
    size = 1 << BITS
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    family = near_copies(feature, first)
    counts, held = np.zeros((2, size)), np.zeros(2)
    for label in (0, 1):
        held[label] = len(np.unique(family[toxic == label]))
        mine = np.flatnonzero(toxic[row] == label)
        owner = family[row[mine]].astype(np.int64) * size
        for k in range(feature.shape[1]):
            counts[label] += np.bincount(np.unique(owner + feature[mine, k]) % size, minlength=size)
    share = counts / np.maximum(1, held)[:, None]
    telling = (counts[1] >= least) & (share[1] >= 40 * share[0])
    odds = np.log((held.sum() + 1) / (held[1] + 1e-9)) if held[0] else 1.0
    enough = np.log(100 * max(1, np.count_nonzero(counts[1]))) / max(odds, 1e-3)
    cue = telling & (counts[1] >= min(enough, held[1] / 4))
    return cue[feature].any(axis=1) & (toxic[row] == 1), telling


def _summary(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each row: log odds of its most toxic token, and the logarithm of the expected number of them."""
    rows = len(first) - 1
    out = np.zeros((rows, 3))
    out[:, 0], out[:, 2] = -12.0, 1.0
    live = np.flatnonzero(np.diff(first))
    if len(live):
        top = np.clip(np.maximum.reduceat(p, first[:-1][live]), 6e-6, 1 - 6e-6)
        out[live, 0] = np.log(top / (1 - top))
        out[live, 1] = np.log1p(np.add.reduceat(p, first[:-1][live]))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Newton steps on the logistic loss with a small penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + 0.01 * w)
    return w


def train(data: np.ndarray, offsets: np.ndarray, toxic: np.ndarray, rounds: int = 20) -> Field:
    """Fit tag weights by gradient steps on the tags of ``cues``, then the document weights.

    Cues are counted over all rows; the steps use the toxic rows and as many others.
    """
    parts, counts = [np.empty((0, 1 + len(PREFIXES)), np.int32)], [np.zeros(0, np.int64)]
    for a, b in words.slices(offsets):
        part = data[offsets[a] : offsets[b]]
        start, end, first = tokens(part, offsets[a : b + 1] - offsets[a])
        parts.append(features(part, start, end))
        counts.append(np.diff(first))
    feature, first = np.concatenate(parts), np.append(0, np.cumsum(np.concatenate(counts)))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    tag, telling = cues(feature, first, toxic)
    tag = tag.astype(float)
    plain = np.flatnonzero(toxic == 0)
    plain = plain[np.random.default_rng(0).permutation(len(plain))[: max(1, int((toxic == 1).sum()))]]
    rows = np.sort(np.append(np.flatnonzero(toxic == 1), plain))
    kept = np.isin(row, rows)
    feature, tag, toxic = feature[kept], tag[kept], toxic[rows]
    first = np.append(0, np.cumsum(np.diff(first)[rows]))
    row = np.repeat(np.arange(len(rows)), np.diff(first))
    size = 1 << BITS
    field = Field(np.zeros(size), -4.0, np.zeros((2, 2)), np.zeros(3))
    if not len(tag) or not tag.any() or tag.all():
        field.document[2] = -4.0 if not toxic.any() else 0.0
        return field
    inner = np.flatnonzero(row[1:] == row[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (tag[inner].astype(int), tag[inner + 1].astype(int)), 1)
    weight = np.where(tag > 0, 0.5 / tag.sum(), 0.5 / (1 - tag).sum()) * len(tag)
    field.pairs = np.log((seen + 1.0) / (seen + 1.0).sum(axis=1, keepdims=True))
    field.pairs -= field.pairs[0, 0]
    field.bias = -2.0
    total = np.full(size, 1e-6)
    for _ in range(rounds):
        p = marginals(field.bias + field.weights[feature].sum(axis=1), first, field.pairs)
        slope = (tag - p) * weight
        gradient = np.zeros(size)
        for k in range(feature.shape[1]):
            gradient += np.bincount(feature[:, k], slope, minlength=size)
        gradient -= 0.02 * field.weights
        total += gradient**2
        field.weights += telling * (0.5 * gradient / np.sqrt(total))
    p = marginals(field.bias + field.weights[feature].sum(axis=1), first, field.pairs)
    field.document = _logistic(_summary(p, first), toxic.astype(float))
    field.weights = field.weights.astype(np.float32)
    return field


def score(field: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Score of each row, and byte spans of its tokens that are toxic rather than not (runs joined)."""
    start, end, first = tokens(data, offsets)
    feature = features(data, start, end)
    p = marginals(field.bias + field.weights[feature].sum(axis=1), first, field.pairs)
    value = 1 / (1 + np.exp(-np.clip(_summary(p, first) @ field.document, -30, 30)))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(offsets) - 1)]
    hot = np.flatnonzero(p >= 0.5)
    for i, r in zip(hot, np.searchsorted(first, hot, "right") - 1):
        a, b = int(start[i] - offsets[r]), int(end[i] - offsets[r])
        if spans[r] and i > first[r] and p[i - 1] >= 0.5:
            spans[r][-1] = (spans[r][-1][0], b)
        else:
            spans[r].append((a, b))
    return value, spans


def fit(documents: DataFrame, labels: DataFrame, per_label: tuple[int, int] = PER_LABEL) -> Field:
    """Field from at most ``per_label`` documents of label 0 and of label 1, none of them held out.

    The sample (smallest hashes of doc_id) is all that reaches the driver; its ids are broadcast, as
    the parameter bounds them. A document with several
    labels counts as toxic if one of them says so.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.max("toxic").alias("_toxic"))
    )
    order = Window.partitionBy("_toxic").orderBy(F.xxhash64("_id"), "_id")
    picked = known.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= max(per_label)).where(F.col("_rank") <= F.when(F.col("_toxic") == 0, per_label[0]).otherwise(per_label[1]))
    sample = (
        documents.select("doc_id", "text")
        .join(F.broadcast(picked.select("_id", "_toxic")), F.col("doc_id") == F.col("_id"))
        .groupBy("text")
        .agg(F.max("_toxic").alias("_toxic"), F.min("doc_id").alias("_first"))
        .orderBy("_first")
        .select("text", "_toxic")
        .toArrow()
    )
    data, offsets = words.utf8(sample["text"]) if sample.num_rows else (np.empty(0, np.uint8), np.zeros(1, np.int64))
    return train(data, offsets, np.array(sample["_toxic"].to_pylist(), np.int64))


def tag(documents: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and ``spans`` (UTF-8 byte offsets) of every row.

    The whole text alone decides. NULL and empty texts get the score of a text without tokens. A NULL
    doc_id is not held out; repeated rows are kept.
    """
    sent = documents.sparkSession.sparkContext.broadcast(field)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            data, offsets = words.utf8(batch.column(2))
            values, spans = np.zeros(batch.num_rows), []
            for a, b in words.slices(offsets):
                values[a:b], more = score(field, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                spans += [[{"start": s, "end": e} for s, e in x] for x in more]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32)), pa.array(spans, kind)],
                ["doc_id", "held_out", "score", "predicted", "spans"],
            )

    schema = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:int,end:int>>"
    return rows.mapInArrow(run, schema)
