"""Removal of every byte that lies in a 100-byte string which the corpus holds earlier.

Texts are reduced to anchors: of the 16-byte grams of every 100-byte string the one with the smallest
hash, so equal strings have an anchor at the same place. What surrounds an anchor, up to 84 bytes before
and 100 from its start, holds all 100-byte strings that the anchor stands for. Equal surroundings are
one class, of which all but the first are covered whole. Only classes that share an anchor and differ
in the rest need their bytes: they are sent where their anchor is dealt to, a suffix array over anchors
and following blocks brings those of one anchor together, and their 100-byte strings are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm import shared, words

LENGTH = 100
GRAM = 16
SPAN = LENGTH - GRAM + 1
BUCKET_BYTES = 24_000_000
BUCKET_ASKS = 6_000
_CODES = np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.iinfo(np.int64).max


def suffix_array(text: list[int]) -> list[int]:
    """Order of the suffixes of ``text``, whose last symbol is smaller than all others.

    Suffixes are grouped by their first symbol, and in the end by their longest Lyndon prefix. Groups are
    processed from the largest down. Of each member the previous suffix in a smaller group is found along
    pointers; a suffix found k times goes on with k copies of the group's prefix, so those found most often
    move to new groups right above the rest of their old ones. A last pass from the smallest suffix up
    emits each group's order: whenever a suffix has its place, the one before it takes the next place of
    its group, and so do those its pointers lead to. Both passes are linear, and nothing is renamed.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, size, previous = [0] * n, [0] * n, [0] * n, [-1] * n
    for k, i in enumerate(order):
        place[i] = k
        group[i] = group[order[k - 1]] if k and text[order[k - 1]] == text[i] else k
        size[group[i]] += 1
    end = n
    while end > 0:
        start = group[order[end - 1]]
        found: dict[int, int] = {}
        for i in sorted(order[start:end]) if end - start > 1 else order[start:end]:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        if found:
            levels: dict[int, list[int]] = {}
            for j, k in found.items():
                levels.setdefault(k, []).append(j)
            for k in sorted(levels, reverse=True):
                moved = levels[k]
                for j in moved:
                    old = group[j]
                    size[old] -= 1
                    last, at = old + size[old], place[j]
                    other = order[last]
                    order[at], place[other] = other, at
                    order[last], place[j] = j, last
                fresh = [group[j] + size[group[j]] for j in moved]
                for j, new in zip(moved, fresh):
                    group[j] = new
                for new in set(fresh):
                    size[new] = 0
                for new in fresh:
                    size[new] += 1
        end = start
    free = list(range(n))
    out, placed = [-1] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
    return out


def anchors(data: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Positions of the grams that are the smallest, the last of equal ones, in some 100-byte window.

    Windows across texts only add anchors.
    """
    n = len(data) - GRAM + 1
    if len(data) < LENGTH:
        return np.empty(0, np.int64)
    _, down = words.powers(len(prefix))
    h = (prefix[GRAM:] - prefix[:-GRAM]) * down[:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, 0, -1).astype(np.uint64)
    pad = -n % SPAN
    rows = np.append(key, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))).reshape(-1, SPAN)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - SPAN + 1
    low = np.minimum(after[:windows], before[SPAN - 1 : SPAN - 1 + windows]) & np.uint64(0xFFFFFFFF)
    return n - low[np.append(True, low[1:] != low[:-1])].astype(np.int64)


def _pack(bucket: np.ndarray, buckets: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row per bucket with the columns' values one after the other."""
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    live = np.flatnonzero(np.diff(edges))
    columns = [c[order] for c in columns]
    blobs = [np.uint64(edges[k + 1] - edges[k]).tobytes() + b"".join(c[edges[k] : edges[k + 1]].tobytes() for c in columns) for k in live]
    return pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "blob"])


def _unpack(table: pa.Table, kinds: list) -> list[np.ndarray]:
    out: list[list] = [[] for _ in kinds]
    for blob in table["blob"].to_pylist():
        n, at = int(np.frombuffer(blob, np.uint64, 1)[0]), 8
        for k, kind in enumerate(kinds):
            out[k].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(x) for x in out]


def _per_document(doc: np.ndarray, mark: np.ndarray, lists: dict[str, np.ndarray]) -> pa.Table:
    """A row per document with lists of the values that belong to it; the rows come in any order."""
    order = np.lexsort((mark, doc))
    doc, mark = doc[order], mark[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]))) if len(doc) else np.empty(0, np.int64)
    offsets = pa.array(np.append(new, len(doc)).astype(np.int32))
    data = {"doc": pa.array(doc[new]), "mark": pa.array(mark[new])}
    for name, values in lists.items():
        data[name] = pa.ListArray.from_arrays(offsets, pa.array(values[order]))
    return pa.table(data)


def located(texts: DataFrame, buckets: int) -> DataFrame:
    """Per document and bucket of anchors: spans (``starts``, ``ends``) known to be covered, and the anchors
    (``asks``, ``grams``) whose surroundings must be compared.

    Of equal surroundings, in order of document and place, all but the first are covered.
    """

    def found(doc: np.ndarray, mark: np.ndarray, part: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """Bucket, document, gram, surroundings, place and reach of the anchors of a slice."""
        prefix = words.prefix_hash(part, _CODES)
        at = anchors(part, prefix)
        row = np.searchsorted(bounds, at, "right") - 1
        inside = at + GRAM <= bounds[row + 1]
        at, row = at[inside], row[inside]
        left, right = np.maximum(bounds[row], at - SPAN + 1), np.minimum(bounds[row + 1], at + LENGTH)
        whole = right - left >= LENGTH
        at, row, left, right = at[whole], row[whole], left[whole], right[whole]
        gram = words.span_hash(prefix, at, at + GRAM)
        return [
            ((gram >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64),
            doc[row],
            mark[row],
            (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32),
            words.mixed(words.span_hash(prefix, left, right) + (at - left).astype(np.uint64)),
            (at - bounds[row]).astype(np.int64),
            (at - left).astype(np.uint8),
            (right - at).astype(np.uint8),
        ]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Small slices bound what a task holds; the anchors of several are packed together."""
        for batch in batches:
            doc, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = words.utf8(batch.column(2))
            for x, y in words.slices(offsets):
                inner = words.slices(offsets[x : y + 1] - offsets[x], words.SMALL_SLICE_BYTES)
                parts = [found(doc[x + a : x + b], mark[x + a : x + b], data[offsets[x + a] : offsets[x + b]], offsets[x + a : x + b + 1] - offsets[x + a]) for a, b in inner]
                bucket, *columns = (np.concatenate(c) for c in zip(*parts))
                if len(bucket):
                    yield _pack(bucket, buckets, columns)

    def meet(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        doc, mark, gram, around, at, left, right = _unpack(table, [np.int64, np.int64, np.uint32, np.uint64, np.int64, np.uint8, np.uint8])
        order = np.argsort(gram, kind="stable")
        same = np.append(gram[order][1:] == gram[order][:-1], False)
        same[1:] |= same[:-1]
        order = order[same]
        order = order[np.lexsort((at[order], mark[order], doc[order], around[order], gram[order]))]
        doc, mark, gram, around, at, left, right = (x[order] for x in (doc, mark, gram, around, at, left, right))
        if not len(gram):
            empty = np.empty(0, np.int64)
            return _per_document(empty, empty, {"starts": empty, "ends": empty, "asks": empty, "grams": empty})
        new_gram = np.append(True, gram[1:] != gram[:-1])
        first = new_gram | np.append(True, around[1:] != around[:-1])
        classes = np.add.reduceat(first, np.flatnonzero(new_gram))
        ask = first & (classes > 1)[np.cumsum(new_gram) - 1]
        # A row that repeats a document's id and text is the same occurrence, not a later one.
        again = ~first & ~np.append(False, (doc[1:] == doc[:-1]) & (mark[1:] == mark[:-1]) & (at[1:] == at[:-1]))
        covered = _per_document(doc[again], mark[again], {"starts": (at - left)[again], "ends": (at + right)[again]})
        asked = _per_document(doc[ask], mark[ask], {"asks": at[ask], "grams": (np.int64(bucket) << 32 | gram.astype(np.int64))[ask]})
        none = lambda t: pa.array([[]] * len(t), pa.list_(pa.int64()))
        covered = covered.append_column("asks", none(covered)).append_column("grams", none(covered))
        for k, name in enumerate(("starts", "ends")):
            asked = asked.add_column(2 + k, name, none(asked))
        return pa.concat_tables([covered, asked])

    schema = "doc long, mark long, starts array<long>, ends array<long>, asks array<long>, grams array<long>"
    return texts.mapInArrow(shared.lean(scan), "bucket int, blob binary").groupBy("bucket").applyInArrow(shared.lean_group(meet), schema)


def compared(rows: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """Covered spans among the surroundings that share an anchor and differ.

    All columns go to the function, ``row`` unused: the shuffle is then the one that the caller's join needs.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"bucket": [], "gram": [], "doc": [], "mark": [], "at": [], "left": [], "bytes": []}
            held = 0
            for doc, mark, text, asks, grams in zip(*(batch.column(k) for k in range(5))):
                raw = (text.as_py() or "").encode()
                for at, gram in zip(asks.values.to_pylist(), grams.values.to_pylist()):
                    left = min(at, SPAN - 1)
                    rows["bucket"].append(hash((gram, 5)) % buckets)
                    rows["gram"].append(gram)
                    rows["doc"].append(doc.as_py())
                    rows["mark"].append(mark.as_py())
                    rows["at"].append(at)
                    rows["left"].append(left)
                    rows["bytes"].append(raw[at - left : at + LENGTH])
                    held += len(rows["bytes"][-1])
                if held > 8_000_000:
                    yield pa.RecordBatch.from_pydict(rows, kind)
                    rows, held = {k: [] for k in rows}, 0
            if rows["gram"]:
                yield pa.RecordBatch.from_pydict(rows, kind)

    kind = pa.schema([("bucket", pa.int32()), ("gram", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int64()), ("left", pa.int16()), ("bytes", pa.binary())])

    def meet(table: pa.Table) -> pa.Table:
        # A row that repeats a document's id and text sends the same surroundings once more.
        columns = [table[k].to_numpy() for k in ("gram", "doc", "mark", "at")]
        order = np.lexsort(columns[::-1])
        again = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
        if again.any():
            table = table.take(np.sort(order[np.append(True, ~again)]))
        gram, doc, mark, at, left = (table[k].to_numpy() for k in ("gram", "doc", "mark", "at", "left"))
        data, bounds = words.utf8(table["bytes"].cast(pa.large_binary()).combine_chunks())
        group = _anchor_groups(gram, data, bounds, left)
        prefix = words.prefix_hash(data, _CODES)
        # The strings of each surrounding that hold its anchor, by their distance to it.
        sizes = np.diff(bounds) - LENGTH + 1
        owner = np.repeat(np.arange(len(gram)), sizes)
        begin = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = bounds[:-1][owner] + begin
        back = left[owner] - begin
        held = back >= 0
        owner, start, back = owner[held], start[held], back[held]
        string = words.mixed(words.span_hash(prefix, start, start + LENGTH) + back.astype(np.uint64) + group[owner].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        # Ranks of the surroundings by document and place, so the first of equal strings sorts first.
        rank = np.empty(len(gram), np.int64)
        rank[np.lexsort((at, mark, doc))] = np.arange(len(gram))
        order = np.lexsort((rank[owner], string))
        string, owner, back = string[order], owner[order], back[order]
        later = np.append(False, string[1:] == string[:-1])
        owner, back = owner[later], back[later]
        order = np.lexsort((-back, owner))
        owner, back = owner[order], back[order]
        new = np.append(True, (owner[1:] != owner[:-1]) | (back[1:] != back[:-1] - 1)) if len(owner) else np.empty(0, bool)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(owner)) - 1 if len(head) else head
        who = owner[head]
        return _per_document(doc[who], mark[who], {"starts": at[who] - back[head], "ends": at[who] - back[tail] + LENGTH})

    asks = (
        places.where(F.size("asks") > 0)
        .groupBy("doc", "mark")
        .agg(F.flatten(F.collect_list("asks")).alias("asks"), F.flatten(F.collect_list("grams")).alias("grams"))
    )
    sent = rows.join(asks, ["doc", "mark"]).select("doc", "mark", "text", "asks", "grams", "row")
    cuts = sent.mapInArrow(shared.lean(cut), "bucket int, gram long, doc long, mark long, at long, left short, bytes binary")
    return cuts.groupBy("bucket").applyInArrow(shared.lean_group(meet), "doc long, mark long, starts array<long>, ends array<long>")


def _anchor_groups(gram: np.ndarray, data: np.ndarray, bounds: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Group number of each surrounding: neighbours in the suffix array that begin with the same anchor.

    Each surrounding is a string of its anchor and the hashes of the two blocks after it, closed by a
    separator; the suffix array orders all of them by anchor and by what follows.
    """
    prefix = words.prefix_hash(data, _CODES)
    head = bounds[:-1] + left
    end = bounds[1:]
    half = GRAM + (LENGTH - GRAM) // 2
    middle = np.minimum(head + half, end)
    blocks = (gram.astype(np.uint64) >> np.uint64(1), words.span_hash(prefix, np.minimum(head + GRAM, end), middle) >> np.uint64(1), words.span_hash(prefix, middle, end) >> np.uint64(1))
    _, names = np.unique(np.stack(blocks, 1), return_inverse=True)
    symbols = np.ones((len(gram), 4), np.int64)
    symbols[:, :3] = names.reshape(-1, 3) + 2
    text = symbols.ravel().tolist() + [0]
    order = np.array(suffix_array(text))
    heads = order[(order % 4 == 0) & (order < 4 * len(gram))] // 4
    anchor = symbols[heads, 0]
    out = np.empty(len(gram), np.int64)
    out[heads] = np.cumsum(np.append(True, anchor[1:] != anchor[:-1]))
    return out


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def covered(rows: DataFrame) -> DataFrame:
    """Lists of covered spans (``starts``, ``ends``) of the ``rows`` (see ``_keyed``) that have any."""
    texts = rows.select("doc", "mark", F.coalesce("text", F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = shared.kept(located(texts, max(12, -(-total // BUCKET_BYTES))))
    asked = places.agg(F.sum(F.size("asks"))).first()[0] or 0
    return (
        places.where(F.size("starts") > 0)
        .select("doc", "mark", "starts", "ends")
        .unionByName(compared(rows, places, max(12, asked // BUCKET_ASKS)))
        .groupBy("doc", "mark")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"))
    )


def _keyed(documents: DataFrame) -> DataFrame:
    """``text``, the document's place in the order as ``doc`` and ``mark``, and all other columns in ``row``."""
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
        "text",
        F.struct(*[c for c in documents.columns if c != "text"]).alias("row"),
    )


def _with_spans(documents: DataFrame) -> DataFrame:
    """The keyed rows with their spans. Here and in ``compared`` all columns are dealt by document, so that
    Spark shuffles the texts once and reads them twice."""
    rows = _keyed(documents)
    return rows.join(covered(rows), ["doc", "mark"], "left")


def _cut(raw: bytes, starts, ends) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside the spans, and the maximal runs that go."""
    if starts is None or not len(starts):
        return raw, []
    a, b = merged(np.asarray(starts, np.int64), np.asarray(ends, np.int64))
    gone = list(zip(a.tolist(), b.tolist()))
    return b"".join(raw[x:y] for x, y in zip([0, *(y for _, y in gone)], [*(x for x, _ in gone), len(raw)])), gone


def removed(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` of every row.

    A byte goes if a 100-byte string over it also starts earlier, in a smaller doc_id or earlier in the
    same text; what is left is not looked at again. ``spans`` are byte offsets. NULL and empty texts lose
    nothing. A NULL doc_id comes after all others. Rows that repeat a doc_id and its text are one document
    and get the same result; rows that repeat a doc_id with another text are ordered by a hash of it.
    Other columns are ignored.
    """
    rows = _with_spans(documents.select("doc_id", "text")).select(F.col("row.doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in kind.names}
            for doc_id, text, starts, ends in zip(*(batch.column(k) for k in range(4))):
                raw = text.as_py().encode()
                kept, gone = _cut(raw, starts.values.to_numpy() if starts.is_valid else None, ends.values.to_numpy() if ends.is_valid else None)
                out["doc_id"].append(doc_id.as_py())
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(len(raw) - len(kept))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append([{"start": x, "end": y} for x, y in gone])
            yield pa.RecordBatch.from_pydict(out, kind)

    kind = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_removed", pa.int64()),
            ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return rows.mapInArrow(shared.lean(cut), schema)


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with the kept bytes as ``text`` and their characters as ``n_chars``.

    Of a character that is cut in two the rest goes too. Documents that lose nothing are untouched; a text
    that loses all is empty, and its document stays.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([_cut(t.encode(), a, b)[0].decode(errors="ignore") for t, a, b in zip(text, starts, ends)], dtype=object)

    rows = _with_spans(documents)
    changed = F.col("starts").isNotNull()
    text = F.when(changed, kept(F.coalesce("text", F.lit("")), "starts", "ends")).otherwise(F.col("text"))
    out = rows.select(text.alias("text"), changed.alias("changed"), "row")
    columns = {c: F.col("row").getField(c) for c in documents.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("changed"), F.char_length("text").cast("long")).otherwise(columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in documents.columns])
