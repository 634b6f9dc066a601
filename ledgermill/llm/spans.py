"""Texts as UTF-8 buffers: slices, word spans, and 64-bit hashes of spans, all without Python strings.

A hash of a span runs over its bytes, eight at a time, through a mixing function, so that constructed texts fare no worse
than others; very long spans take a cryptographic digest. Two different spans share a hash with a chance near 2**-64. Users
that need exact results compare bytes; the others accept this chance.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from ledgermill.llm.common import mix

SLICE_BYTES = 1_000_000
LONG_SPAN = 512       # bytes from which a span is digested on its own
TABLE_BYTES = 48_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), at


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes (one row at least): first row, end row, bytes, offsets from 0."""
    data, at = utf8(column)
    low, rows = 0, len(at) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
        yield low, high, data[at[low]:at[high]], at[low:high + 1] - at[low]
        low = high


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One hash for each span; ``lower`` takes A to Z as a to z."""
    n = ends - starts
    padded = np.concatenate([_LOWER[data] if lower else data, np.zeros(8, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = mix(n.astype(np.uint64) + np.uint64(1))
    rows, at = np.flatnonzero((n > 0) & (n <= LONG_SPAN)), 0
    while len(rows):
        words = windows[starts[rows] + at].view("<u8").ravel()
        beyond = (np.maximum(8 - (n[rows] - at), 0) * 8).astype(np.uint64)
        out[rows] = mix(out[rows] ^ ((words << beyond) >> beyond)) + np.uint64(0x9E3779B97F4A7C15)
        at += 8
        rows = rows[n[rows] > at]
    for k in np.flatnonzero(n > LONG_SPAN).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(padded[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of a slice: starts, ends, and the first word of each row."""
    space = np.ones(len(data) + 1, bool)
    space[:-1] = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.ones(len(data) + 1, bool)
    before[1:] = space[:-1]
    starts = np.flatnonzero(~space & (before | cut))
    after = np.ones(len(data) + 1, bool)
    after[:-1] = space[1:] | cut[1:]
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, at)


def _gathered(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The positions of all spans one after another."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + n, n)


class _Store:
    """An array that grows by appending."""

    def __init__(self, dtype: type):
        self.room, self.size = np.empty(1024, dtype), 0

    def add(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.room):
            room = np.empty(max(need, 3 * len(self.room) // 2), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:need] = more
        self.size = need

    @property
    def data(self) -> np.ndarray:
        return self.room[:self.size]


class ChunkTable:
    """Distinct chunks of text with their token ids, each segmented once, joined back by position.

    A chunk is found by its hash and then compared byte by byte; chunks of equal hash but different bytes are kept in a
    dictionary. The table starts afresh once it holds more than ``limit`` bytes, so its memory is bounded by that and by
    what one slice of text adds, while no chunk is ever left out.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = TABLE_BYTES):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.text, self.flat = _Store(np.uint8), _Store(np.uint32)
        self.text_at, self.text_n, self.at, self.n = (_Store(np.int64) for _ in range(4))
        self.twins: dict[bytes, int] = {}

    def _bytes(self) -> int:
        return 48 * self.n.size + self.text.size + 4 * self.flat.size

    def _add(self, texts: list[bytes]) -> np.ndarray:
        """New entries; their numbers come back."""
        encoded = self.encode([t.decode() for t in texts])
        first = self.n.size
        for n, at, add in ((np.fromiter(map(len, encoded), np.int64, len(encoded)), self.flat.size, (self.n, self.at)),
                           (np.fromiter(map(len, texts), np.int64, len(texts)), self.text.size, (self.text_n, self.text_at))):
            add[0].add(n)
            add[1].add(at + np.cumsum(n) - n)
        self.flat.add(np.fromiter((i for ids in encoded for i in ids), np.uint32, int(self.n.data[first:].sum())))
        self.text.add(np.frombuffer(b"".join(texts), np.uint8))
        return np.arange(first, self.n.size)

    def positions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The table's entry for each chunk; unknown chunks are added first. Valid until the next call."""
        if self._bytes() > self.limit:
            self._clear()
        distinct, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        if not known.all():
            new = ~known
            added = self._add([data[a:b].tobytes() for a, b in
                               zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            self.keys = np.insert(self.keys, place[new], distinct[new])
            self.entry = np.insert(self.entry, place[new], added)
            place = np.searchsorted(self.keys, distinct)
        entries = self.entry[place[back]]
        for k in np.flatnonzero(~self._same(data, starts, ends - starts, entries)).tolist():
            own = data[starts[k]:ends[k]].tobytes()
            if own not in self.twins:
                self.twins[own] = int(self._add([own])[0])
            entries[k] = self.twins[own]
        return entries

    def _same(self, data: np.ndarray, starts: np.ndarray, n: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Whether each chunk has the very bytes of its entry."""
        same = self.text_n.data[entries] == n
        rows = np.flatnonzero(same)
        for part in np.split(rows, np.searchsorted(np.cumsum(n[rows]), np.arange(SLICE_BYTES, n[rows].sum(), SLICE_BYTES))):
            if len(part):
                size = n[part]
                differ = data[_gathered(starts[part], size)] != self.text.data[_gathered(self.text_at.data[entries[part]], size)]
                if differ.any():
                    same[part] = ~np.logical_or.reduceat(differ, np.cumsum(size) - size)
        return same

    def counts(self, entries: np.ndarray) -> np.ndarray:
        return self.n.data[entries]

    def ids(self, entries: np.ndarray) -> np.ndarray:
        """The ids of the chunks one after another."""
        return self.flat.data[_gathered(self.at.data[entries], self.n.data[entries])]
