"""Byte-level BPE by distinct chunks.

A pretoken of this family never reaches over the start of a run of white space, nor over a space followed by other
text, so a text can be cut there and each distinct chunk encoded once. A run of white space that holds more than blanks,
tabs and line ends stays in one chunk with the text behind it. Added tokens of the vocabulary are taken out of the text first; each occurrence
is a chunk with one id, and what stands between two of them is encoded as a text of its own.
"""
from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgermill.llm.spans import ChunkTable, slices

VOCABULARY = "byte_bpe_50k.tiktoken"
_WS = np.zeros(256, bool)
_WS[[32, 9, 10, 13]] = True
_ODD = np.zeros(256, bool)
_ODD[[11, 12, 28, 29, 30, 31]] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[28:32] = True  # white space to some libraries only, so no cut may depend on it
_tables: dict[str, ChunkTable] = {}
_added: dict[str, dict[str, int]] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def added_tokens(path: str) -> dict[str, int]:
    """Added tokens and their ids, as the JSON file beside the ranks declares them; none without such a file."""
    if path not in _added:
        beside, tokens = os.path.splitext(path)[0] + ".json", []
        if os.path.exists(beside):
            with open(beside, encoding="utf-8") as file:
                tokens = json.load(file).get("added_tokens") or []
        for token in tokens:
            if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
                raise ValueError(f"added token {token['content']!r} takes its surroundings into account")
        _added[path] = {t["content"]: t["id"] for t in tokens}
    return _added[path]


def added_spans(data: np.ndarray, at: np.ndarray, added: dict[str, int]) -> tuple[list[int], list[int]]:
    """Starts and ends of added tokens in a slice of texts that begin at ``at``: leftmost, longest, inside one text."""
    starts, ends = [], []
    if added:
        found = re.compile(b"|".join(re.escape(x.encode()) for x in sorted(added, key=len, reverse=True)))
        raw = data.tobytes()
        m = found.search(raw)
        while m:
            whole = m.end() <= at[np.searchsorted(at, m.start(), side="right")]
            if whole:
                starts.append(m.start())
                ends.append(m.end())
            m = found.search(raw, m.end() if whole else m.start() + 1)
    return starts, ends


def chunk_table(path: str) -> ChunkTable:
    """One table for each worker process and vocabulary."""
    if path not in _tables:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        encoding = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
        added = added_tokens(path)
        _tables[path] = ChunkTable(lambda texts: [[added[x]] if x in added else encoding.encode_ordinary(x)
                                                  for x in texts])
    return _tables[path]


def _odd_white_space(data: np.ndarray) -> np.ndarray:
    """The bytes of white space other than blank, tab and line ends."""
    odd = _ODD[data]
    high = np.flatnonzero(data >= 0xC2)
    if len(high):
        one, two = (np.append(data[k:], np.zeros(k, np.uint8))[high] for k in (1, 2))
        lead = data[high]
        pair = (lead == 0xC2) & ((one == 0x85) | (one == 0xA0))
        triple = ((lead == 0xE1) & (one == 0x9A) & (two == 0x80)
                  | (lead == 0xE2) & (one == 0x80) & (((two >= 0x80) & (two <= 0x8A)) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF))
                  | (lead == 0xE2) & (one == 0x81) & (two == 0x9F)
                  | (lead == 0xE3) & (one == 0x80) & (two == 0x80))
        odd[high] |= pair | triple
        odd[high[pair | triple] + 1] = True
        odd[high[triple] + 2] = True
    return odd


def chunk_starts(data: np.ndarray, at: np.ndarray, added: dict[str, int] | None = None) -> np.ndarray:
    """Starts of chunks in a slice of texts that begin at ``at``; each of the tokens ``added`` is one chunk."""
    n = len(data)
    from_, to = added_spans(data, at, added or {})
    if from_:
        at = np.unique(np.concatenate([at, from_, to]))
    first = np.zeros(n + 1, bool)
    first[at] = True
    ws = _WS[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ws[:-1], ws[1:]
    after |= first[1:]
    blank_before = np.zeros(n, bool)
    blank_before[1:] = data[:-1] == 32
    start = first[:-1] | ws & ~before | ~ws & before & ~blank_before | ws & ~after
    odd = _odd_white_space(data)
    if odd.any():
        blank = ws | odd
        opens = blank & first[:-1]
        opens[1:] |= blank[1:] & ~blank[:-1]
        run = np.cumsum(opens)
        mixed = np.zeros(int(run[-1]) + 1, bool)
        mixed[run[odd]] = True
        inside = blank & mixed[run]
        start[inside] = (opens & (first[:-1] | ~_SEPARATOR[data]))[inside]
        behind = np.zeros(n, bool)
        behind[1:] = inside[:-1] & ~blank[1:] & ~first[1:-1]
        start[behind] = False
    for a, b in zip(from_, to, strict=True):
        start[a + 1:b] = False
    return np.flatnonzero(start)


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, ChunkTable, np.ndarray]]:
    """For runs of rows: first row, end row, where each row's chunks begin, the table, the entry of each chunk."""
    chunks = chunk_table(path)
    for low, high, data, at in slices(column):
        starts = chunk_starts(data, at, added_tokens(path))
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        yield low, high, np.searchsorted(starts, at), chunks, chunks.positions(data, starts, ends)


def totals(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups that begin at ``first`` (one more entry than groups)."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]
