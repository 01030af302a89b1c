"""Language by family first, then by one-versus-one linear support vector machines inside it."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared, words

BITS = 13
PER_LANGUAGE = 400
NONE = "und"
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that no classifier learns from."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1


def grams(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of the byte pairs, triples and quadruples that begin at each byte, A-Z as a-z."""
    codes = _FOLD[data]
    two = codes[:-1] | (codes[1:] << np.uint32(8))
    three = two[:-1] | (codes[2:] << np.uint32(16))
    four = three[:-1] | (codes[3:] << np.uint32(24))
    shift = np.uint32(32 - BITS)
    return [(g * np.uint32(m)) >> shift for g, m in ((two, 0x9E3779B1), (three, 0x85EBCA77), (four, 0xC2B2AE3D))]


def profile(text: bytes) -> np.ndarray:
    """Share of each bucket among the grams of a text, each length counted apart and added."""
    out = np.zeros(1 << BITS)
    for g in grams(np.frombuffer(text, np.uint8)):
        if len(g):
            out += np.bincount(g, minlength=1 << BITS) / len(g)
    return out


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps; ``y`` is -1 or 1."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    rows, y = np.hstack([x, np.ones((len(x), 1), x.dtype)]), y.astype(x.dtype)
    v = np.random.default_rng(0).normal(size=rows.shape[1]).astype(x.dtype)
    for _ in range(20):
        v = rows.T @ (weight * (rows @ v))
        norm = float(np.linalg.norm(v))
        v /= norm or 1.0
    step = 1.0 / (1.0 + 2.0 * cost * norm)
    w = ahead = np.zeros(rows.shape[1], x.dtype)
    for k in range(rounds):
        slack = np.maximum(x.dtype.type(0), 1 - y * (rows @ ahead))
        new = ahead - step * (ahead - 2.0 * cost * (rows.T @ (weight * y * slack)))
        ahead, w = new + k / (k + 3.0) * (new - w), new
    return w[:-1], float(w[-1])


def families(names: list[str], means: np.ndarray, count: int | None = None) -> list[list[str]]:
    """Average-linkage groups of languages by the cosine of their mean profiles.

    ``count`` defaults to the rounded square root of the number of languages.
    """
    unit = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)
    near = unit @ unit.T
    groups = [[i] for i in range(len(names))]
    while len(groups) > (count or max(1, round(math.sqrt(len(names))))):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] += groups.pop(b)
    return [sorted(names[i] for i in g) for g in groups]


@dataclass
class Model:
    """``pairs``: machines as ``(first group, second group, column of tables)``."""

    groups: list[list[str]] = field(default_factory=list)
    pairs: list[tuple[tuple, tuple]] = field(default_factory=list)
    tables: np.ndarray | None = None
    bias: np.ndarray | None = None
    slope: np.ndarray | None = None


def train(labels: list[str], profiles: np.ndarray, count: int | None = None, spare: bool = False) -> Model:
    """Families from the profiles, a machine per pair of families and per pair of languages in one.

    With ``spare`` the profiles are overwritten, which saves a copy of them.
    """
    names = sorted(set(labels))
    if not names:
        return Model()
    labels_ = np.array(labels)
    centre = profiles.mean(axis=0)
    scale = 1.0 / (profiles.std(axis=0) + 1e-5)
    groups = families(names, np.stack([profiles[labels_ == n].mean(axis=0) for n in names]), count)
    x = np.subtract(profiles, centre, out=profiles if spare else None)
    x *= scale
    x /= math.sqrt(profiles.shape[1])
    pairs = [(tuple(a), tuple(b)) for a, b in combinations(groups, 2)]
    pairs += [((a,), (b,)) for g in groups for a, b in combinations(g, 2)]
    tables, bias, slope = [], [], []
    for a, b in pairs:
        left, right = np.isin(labels_, a), np.isin(labels_, b)
        rows = left | right
        y = np.where(left[rows], 1.0, -1.0)
        part = x if rows.all() else x[rows]
        w, b0 = svm(part, y)
        margin = part @ w + b0
        fold = w * scale / math.sqrt(profiles.shape[1])
        tables.append(fold)
        bias.append(b0 - float(centre @ fold))
        slope.append(4.0 / max(0.05, float(np.median(np.abs(margin)))))
    return Model(groups, pairs, np.array(tables, np.float32).reshape(len(pairs), -1), np.array(bias), np.array(slope))


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each row the margin of every machine: the mean weight of its grams, without a vector per row."""
    rows = len(offsets) - 1
    out = np.tile(model.bias, (rows, 1)).astype(float)
    if not len(data):
        return out
    for width, g in zip((2, 3, 4), grams(data)):
        counts = np.maximum(0, np.diff(offsets) - width + 1)
        live = np.flatnonzero(counts)
        if not len(live):
            continue
        starts = offsets[:-1][live]
        edges = np.stack([starts, starts + counts[live]], 1).ravel()
        for p, table in enumerate(model.tables):
            sums = np.add.reduceat(np.append(table[g], np.float32(0)), edges, dtype=np.float64)[::2]
            out[live, p] += sums / counts[live]
    return out


def decide(model: Model, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row; the score is the product of the two levels' shares of votes."""
    rows = len(margin)
    votes = 1.0 / (1.0 + np.exp(-np.clip(margin * model.slope, -50, 50)))

    def level(members: list[tuple]) -> np.ndarray:
        share = np.zeros((rows, len(members)))
        for p, (a, b) in enumerate(model.pairs):
            if a in members and b in members:
                share[:, members.index(a)] += votes[:, p]
                share[:, members.index(b)] += 1.0 - votes[:, p]
        total = share.sum(axis=1, keepdims=True)
        return share / total if len(members) > 1 else np.ones((rows, 1))

    outer = level([tuple(g) for g in model.groups])
    name, score = np.empty(rows, object), np.zeros(rows)
    family = outer.argmax(axis=1)
    for f, group in enumerate(model.groups):
        mine = family == f
        inner = level([(n,) for n in group])[mine]
        name[mine] = np.array(group, object)[inner.argmax(axis=1)]
        score[mine] = outer[mine, f] * inner.max(axis=1)
    return name, score


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, count: int | None = None) -> Model:
    """Model from at most ``per_language`` labelled documents of each language, none of them held out.

    The sample (the smallest hashes of doc_id) is the only part of the corpus that reaches the driver,
    as profiles of fixed size. Its ids are broadcast: ``per_language`` for each language bounds them.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~F.coalesce(held_out(), F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (
        known.select("lang", "doc_id")
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= per_language)
        .select("doc_id")
        .distinct()
    )
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(picked), "doc_id", "left_semi")

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = zlib.compress(profile(text.encode()).astype(np.float32).tobytes(), 1)
                yield pa.RecordBatch.from_pydict({"lang": [lang], "profile": pa.array([data], pa.binary())})

    found = rows.select("lang", "text").mapInArrow(shared.lean(profiles), "lang string, profile binary").toArrow()
    if not found.num_rows:
        return Model()
    matrix = np.empty((found.num_rows, 1 << BITS), np.float32)
    for row, data in zip(matrix, found["profile"]):
        row[:] = np.frombuffer(zlib.decompress(data.as_buffer()), np.float32)
    model = train(found["lang"].to_pylist(), matrix, count, spare=True)
    del matrix
    shared.release()
    return model


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row, by its whole text alone.

    NULL texts and texts without a letter are ``und`` with score 0, as is every text if no language
    has been learned. A NULL doc_id is not held out. Repeated rows are kept.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
        "text",
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            data, offsets = words.utf8(batch.column(3))
            names, scores = np.full(batch.num_rows, NONE, object), np.zeros(batch.num_rows)
            if model.groups:
                for a, b in words.slices(offsets, words.SMALL_SLICE_BYTES):
                    names[a:b], scores[a:b] = decide(model, margins(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
            blank = ~batch.column(2).to_numpy(zero_copy_only=False)
            names[blank], scores[blank] = NONE, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(shared.lean(score), "doc_id long, held_out boolean, lang_pred string, score double")


def identified(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, whose text has a letter, with the predicted language as ``lang``.

    NULL and empty texts and those without a letter are of no language and go. Without a learned language
    the others stay as they are. Repeated rows and NULL ids are kept.
    """
    written = documents.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    if not model.groups or "lang" not in documents.columns:
        return written
    sent = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def language(text: pd.Series) -> pd.Series:
        data, offsets = words.utf8(pa.array(text, pa.string()))
        names = np.full(len(text), NONE, object)
        for a, b in words.slices(offsets, words.SMALL_SLICE_BYTES):
            names[a:b], _ = decide(sent.value, margins(sent.value, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        shared.release()
        return pd.Series(names)

    return written.withColumn("lang", language("text"))
