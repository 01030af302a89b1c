"""Byte-pair encoding by a priority queue of merge ranks, and decoding by vocabulary strings.

Pre-tokens do not influence each other, so a worker merges each distinct one once and keeps the
result in a table of bounded size. The symbols of a pre-token are a doubly linked list; a queue holds
the merges that neighbours allow. The merge of lowest rank, of equal ones the leftmost, is taken; it
changes the neighbours, and entries that no longer describe a pair of the list are skipped when they
come up. A pre-token of n bytes takes O(n log n) steps, also where it is a run of millions of bytes.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from waybill.llm import words
from waybill.llm.tokens import pretoken_starts

SLICE_BYTES = 4 << 20
TABLE_WORDS = 300_000


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary, as sign -> byte.

    Printable bytes of Latin-1 stand for themselves, the others in order for the signs from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def merged(symbols: list[int], ranks: dict[int, int], results: Sequence[int]) -> list[int]:
    """``symbols`` after all merges; ``ranks`` has ``left << 32 | right``, ``results`` the new symbol by rank."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = [*symbols, -1]
    after = list(range(1, n + 1))
    before = list(range(-1, n))
    queue = []
    for k in range(n - 1):
        rank = ranks.get(symbols[k] << 32 | symbols[k + 1])
        if rank is not None:
            queue.append(rank << 32 | k)
    heapify(queue)
    while queue:
        entry = heappop(queue)
        rank, k = entry >> 32, entry & 0xFFFFFFFF
        right = after[k]
        if symbols[k] < 0 or right >= n or ranks.get(symbols[k] << 32 | symbols[right]) != rank:
            continue
        symbols[k] = new = results[rank]
        symbols[right] = -1
        after[k] = end = after[right]
        before[end] = k
        if end < n and (rank := ranks.get(new << 32 | symbols[end])) is not None:
            heappush(queue, rank << 32 | k)
        if (start := before[k]) >= 0 and (rank := ranks.get(symbols[start] << 32 | new)) is not None:
            heappush(queue, rank << 32 | start)
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """A byte-level BPE vocabulary file: merges, strings of the ids, special tokens."""

    def __init__(self, path: str):
        found = json.loads(Path(path).read_text(encoding="utf-8"))
        byte_of, ids = byte_signs(), found["model"]["vocab"]
        added = {t["content"]: t for t in found.get("added_tokens", [])}
        if found["model"]["type"] != "BPE" or found.get("normalizer") or any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", c) for c, t in added.items()
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.first = [0] * 256
        for sign, byte in byte_of.items():
            self.first[byte] = ids[sign]
        self.ranks, self.results = {}, []
        for rank, pair in enumerate(found["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(ids[left] << 32 | ids[right], rank)
            self.results.append(ids[left + right])
        strings = {i: bytes(byte_of[c] for c in token) for token, i in ids.items() if token not in added}
        self.special = {content.encode(): t["id"] for content, t in added.items()}
        strings |= {i: content for content, i in self.special.items()}
        sizes = np.zeros(max(strings) + 2, np.int64)
        for i, string in strings.items():
            sizes[i] = len(string)
        self.sizes, self.ends = sizes, np.cumsum(sizes)
        self.strings = np.frombuffer(b"".join(strings[i] for i in sorted(strings)), np.uint8)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self._clear()

    def _clear(self) -> None:
        self.table = {content: array("I", [i]).tobytes() for content, i in self.special.items()}

    def _of(self, pretoken: bytes) -> bytes:
        """The ids of one pre-token as unsigned 32-bit numbers."""
        first = self.first
        ids = array("I", merged([first[b] for b in pretoken], self.ranks, self.results)).tobytes()
        if len(pretoken) < 64:
            self.table[pretoken] = ids
        return ids

    def _starts(self, data: np.ndarray, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which pre-tokens begin; special tokens are pre-tokens and part the text."""
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        heads, inside = offsets[:-1][offsets[:-1] < len(data)], []
        if self.special_pattern:
            row = 0
            for m in self.special_pattern.finditer(raw):
                row = np.searchsorted(offsets, m.start(), "right")
                if m.end() <= offsets[row]:
                    inside.append(m.span())
            heads = np.concatenate([heads, [x for span in inside for x in span if x < len(data)]]).astype(np.int64)
        start = lead[pretoken_starts(codes, np.searchsorted(lead, np.unique(heads)))]
        if inside:
            opens, ends = np.array(inside).T
            span = np.searchsorted(opens, start, "left") - 1
            start = start[(span < 0) | (start >= ends[np.maximum(span, 0)])]
        return start

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts ``data[offsets[i]:offsets[i + 1]]``, and the offsets of their ids."""
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        start = self._starts(data, raw, offsets)
        bounds = pa.py_buffer(np.append(start, len(data)).astype(np.int64))
        pretokens = pa.Array.from_buffers(pa.large_binary(), len(start), [None, bounds, pa.py_buffer(raw)])
        coded = pretokens.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.table) > TABLE_WORDS:
            self._clear()
        table, of = self.table, self._of
        parts = [table.get(p) or of(p) for p in distinct]
        pool = np.frombuffer(b"".join(parts), np.uint32).astype(np.int32)
        n = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        at = np.cumsum(n) - n
        which = coded.indices.to_numpy()
        size = n[which]
        close = np.cumsum(size)
        ids = pool[np.arange(close[-1]) + np.repeat(at[which] - (close - size), size)]
        return ids, np.append(0, close)[np.searchsorted(start, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ``ids`` stand for, one after the other, and each id's end; unknown ids have none."""
        known = np.where((ids >= 0) & (ids < len(self.sizes)), ids, len(self.sizes) - 1)
        size = self.sizes[known]
        close = np.cumsum(size)
        total = int(close[-1]) if len(close) else 0
        return self.strings[np.arange(total) + np.repeat(self.ends[known] - close, size)], close


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """The worker's copy of the vocabulary at ``path``."""
    return Vocabulary(path)


def sections(data: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Parts of a long text of about ``limit`` bytes, cut where a space follows a visible ASCII sign.

    No pre-token and no special token reaches over such a place. A text without one is a single part.
    """
    begin = 0
    while len(data) - begin > limit:
        cut = 0
        for low in range(begin + limit, len(data), limit):
            here = data[low - 1 : low + limit]
            places = np.flatnonzero((here[1:] == 32) & (here[:-1] > 32) & (here[:-1] < 127))
            if len(places):
                cut = low + int(places[0])
                break
        if not cut:
            break
        yield begin, cut
        begin = cut
    yield begin, len(data)


def _encoded_slices(column: pa.Array, vocab: Vocabulary) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, ids, offsets of the ids)`` for parts of a string column."""
    data, offsets = words.utf8(column)
    for a, b in words.slices(offsets, SLICE_BYTES):
        part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        if b - a == 1 and len(part) > SLICE_BYTES:
            ids = np.concatenate([vocab.encode(part[i:j], np.array([0, j - i]))[0] for i, j in sections(part)])
            yield a, b, ids, np.array([0, len(ids)])
        else:
            yield a, b, *vocab.encode(part, bounds)


def _without(df: DataFrame, name: str) -> tuple[list[str], str]:
    """The columns of ``df`` but ``name``, and their schema as DDL."""
    kept = [f for f in df.schema.fields if f.name != name]
    return [f.name for f in kept], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)


def encoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` under the vocabulary at ``path`` in place of it, as ``ids array<int>``.

    The ids are those of the ``tokenizers`` library without added special tokens; a special token that
    a text spells out is one id. NULL and empty texts have an empty list. Every row is kept, repeats
    included; an empty table stays empty. Whole texts are encoded, long ones in sections. No shuffle.
    A column that is called ``ids`` already is replaced.
    """
    df = df.drop(ids) if ids in df.columns and ids != text else df
    names, ddl = _without(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            rest = [batch.column(k) for k in range(len(names))]
            for a, b, found, bounds in _encoded_slices(batch.column(len(names)), vocab):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in rest), lists], [*names, ids])

    schema = ", ".join(filter(None, [ddl, f"`{ids}` array<int>"]))
    return df.select(*[f"`{n}`" for n in names], f"`{text}`").mapInArrow(run, schema)


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the string that its ``ids`` stand for as ``text``; ``ids`` stay.

    The vocabulary's strings are joined as bytes; bytes that are no UTF-8 become U+FFFD. Special tokens
    appear as text, ids outside the vocabulary and NULL ids as nothing, a NULL list as the empty text. Every
    row is kept. No shuffle. A column that is called ``text`` already is replaced.
    """
    df = df.drop(text) if text in df.columns else df
    names, ddl = _without(df, text)
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            lists = batch.column(place)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            flat = pc.fill_null(pc.list_flatten(lists), -1).to_numpy()
            bounds = np.append(0, np.cumsum(n))
            for a, b in words.slices(bounds, SLICE_BYTES // 4):
                data, close = vocab.decode(flat[bounds[a] : bounds[b]])
                offsets = np.append(0, close)[bounds[a : b + 1] - bounds[a]]
                heads = offsets[:-1][offsets[:-1] < len(data)]
                raw = data.tobytes()
                try:
                    raw.decode()
                    valid = not ((data[heads] & 0xC0) == 0x80).any()
                except UnicodeDecodeError:
                    valid = False
                if valid and len(raw) < 1 << 31:
                    out = pa.Array.from_buffers(pa.string(), b - a, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
                else:
                    out = pa.array([raw[i:j].decode(errors="replace") for i, j in zip(offsets[:-1], offsets[1:])], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), out], [*names, text])

    return df.mapInArrow(run, f"{ddl}, `{text}` string")
