"""Ids of a byte-level BPE vocabulary for whole columns, a vocabulary lookup per distinct word only.

Pre-tokens are independent of each other in byte-level BPE, so a text's ids are the ids of its
pre-tokens in order. The pre-tokens are found on arrays of code points; only words that are new to a
worker are encoded, in one call per slice, and kept in a table that is emptied when it grows large.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np

from waybill.llm import words

SPECIAL = "<|endoftext|>"
# The pre-token pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The code points that Unicode calls white space.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTER, NUMBER, SPACE, OTHER = range(4)
TABLE_WORDS = 1_000_000
_WHITE_HEADS = np.array([*range(9, 14), 32, 0xC2, 0xE1, 0xE2, 0xE3], np.uint8)


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    out[WHITE] = SPACE
    return out


def pretoken_starts(codes: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Positions at which the pre-tokens of texts begin; ``heads`` are the texts' first positions.

    A run of letters, numbers or other signs is a pre-token, with the space before it if there is one.
    Of a run of white space before something else the last one stands apart. An apostrophe that begins
    a run may take a contraction's letters.
    """
    n = len(codes)
    kind = _classes()[codes]
    first = np.zeros(n + 1, bool)
    first[heads] = True
    first[n] = True
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= first[:n]
    starts = change.copy()
    space = kind == SPACE
    ends = np.append(change[1:], True)
    final = first[1:]
    # The last white space of a run that something follows begins a pre-token ...
    apart = space & ends & ~final
    starts |= apart
    # ... which takes in what follows if it is a plain space.
    taken = np.flatnonzero(apart & (codes == 32)) + 1
    starts[taken] = False
    quote = np.flatnonzero((codes == 39) & change)
    quote = quote[(quote == 0) | first[quote] | (codes[np.maximum(quote - 1, 0)] != 32)]
    if len(quote):
        padded = np.append(codes, [0, 0])
        bounded = np.append(first, True)
        one, two = padded[quote + 1], padded[quote + 2]
        same = ~bounded[quote + 1]
        short = same & np.isin(one, [ord(c) for c in "stmd"])
        pair = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        long = same & ~bounded[np.minimum(quote + 2, n)] & pair
        for found, size in ((quote[short], 2), (quote[long], 3)):
            starts[found + 1] = False
            after = found + size
            starts[after[after < n]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Ids of texts under the vocabulary at ``path`` (a ``tokenizers`` file with its ranks beside it)."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        lines = Path(path).with_suffix(".tiktoken").read_bytes().splitlines()
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.parts = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self._clear()

    @cached_property
    def whole(self):
        """The tokenizer itself; few texts need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _clear(self) -> None:
        self.keys, self.at, self.n = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint16)

    def _learn(self, keys: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray) -> None:
        """Encode the pre-tokens ``data[start:end]`` each by itself, in a call per kind.

        Those that begin with a space are joined as they are, as the space keeps them apart; others are
        joined by line feeds, whose ids are taken out again; those that begin with other white space, or
        with a byte that might, are few and go one by one.
        """
        head = data[start]
        spaced = (head == 32) & (end - start > 1) & (data[np.minimum(start + 1, len(data) - 1)] != 32)
        single = np.isin(head, _WHITE_HEADS) & ~spaced
        order, ids, counts = [], [], []
        for group, gap in ((np.flatnonzero(spaced), b""), (np.flatnonzero(~spaced & ~single), b"\n")):
            if len(group):
                size = end[group] - start[group] + len(gap)
                close = np.cumsum(size)
                begin = close - size
                index = np.arange(close[-1]) + np.repeat(start[group] - len(gap) - begin, size)
                joined = data[index]
                if gap:
                    joined[begin] = gap[0]
                got = self.parts.encode_to_numpy(joined.tobytes().decode()).astype(np.int64)
                n = np.diff(np.searchsorted(np.cumsum(self.sizes[got]), close) + 1, prepend=0)
                if gap:
                    got = np.delete(got, np.cumsum(n) - n)
                order.append(group)
                ids.append(got)
                counts.append(n - len(gap))
        for i in np.flatnonzero(single):
            got = self.parts.encode_ordinary(bytes(data[start[i] : end[i]]).decode())
            order.append(np.array([i]))
            ids.append(np.array(got))
            counts.append(np.array([len(got)]))
        order, n = np.concatenate(order), np.concatenate(counts)
        at = len(self.pool) + np.cumsum(n) - n
        self.pool = np.append(self.pool, np.concatenate(ids).astype(np.uint16))
        where = np.searchsorted(self.keys, keys)
        back = np.argsort(order)
        self.keys = np.insert(self.keys, where, keys)
        self.at = np.insert(self.at, where, at[back])
        self.n = np.insert(self.n, where, n[back])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and each text's first."""
        raw = data.tobytes()
        special = SPECIAL.encode() in raw
        if not len(data):
            return np.empty(0, np.uint16), np.zeros(len(offsets), np.int64)
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        heads = np.unique(offsets[:-1][offsets[:-1] < len(data)])
        start = lead[pretoken_starts(codes, np.searchsorted(lead, heads))]
        end = np.append(start[1:], len(data))
        hashes = words.span_hash(words.prefix_hash(data, _EXACT), start, end)
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > TABLE_WORDS:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        new = place == len(self.keys)
        new[~new] = self.keys[place[~new]] != keys[~new]
        if new.any():
            self._learn(keys[new], start[where[new]], end[where[new]], data)
            place = np.searchsorted(self.keys, keys)
        at, n = self.at[place][back], self.n[place][back]
        close = np.cumsum(n)
        ids = self.pool[np.arange(close[-1]) + np.repeat(at - (close - n), n)]
        first = np.append(0, close)[np.searchsorted(start, offsets)]
        if special:
            return self._with_special(raw, offsets, ids, first)
        return ids, first

    def _with_special(self, raw: bytes, offsets: np.ndarray, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts that spell out the special token are left to the tokenizer itself."""
        parts = []
        for a, b, i, j in zip(offsets[:-1], offsets[1:], first[:-1], first[1:]):
            text = raw[a:b]
            if SPECIAL.encode() in text:
                parts.append(np.array(self.whole.encode(text.decode(), add_special_tokens=False).ids, np.uint16))
            else:
                parts.append(ids[i:j])
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


_EXACT = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary."""
    return Encoder(path)
