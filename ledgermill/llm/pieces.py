"""SentencePiece encoding and decoding by distinct chunks.

The library marks white space and lets no piece reach from text over a following marker, so a marked text falls apart
before every run of markers. Each distinct chunk (a run of markers and the word after it) is segmented once, and the
ids are joined back by position. Decoding joins the decoded chunks the same way.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgermill.llm.byte_bpe import totals, vocabulary_path
from ledgermill.llm.common import documents, in_batches
from ledgermill.llm.spans import ChunkTable, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"


class PieceChunks(ChunkTable):
    """A chunk table that also knows what each chunk decodes to where that differs from the chunk itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        crossing = [p for p in map(self.model.id_to_piece, range(self.model.get_piece_size()))
                    if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces of {path} cross white space: {crossing[:3]}")
        self.begin, self.end, self.lone = self.model.bos_id(), self.model.eos_id(), self.model.piece_to_id(MARK)
        self.changed: dict[str, str] = {}
        super().__init__(self._encode)

    def _clear(self) -> None:
        super()._clear()
        self.changed = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of chunks; the model itself puts the first marker before a text, hence the missing first blank."""
        bare = [x[1:] for x in texts]
        ids = self.model.encode(bare, num_threads=1)
        for k, x in enumerate(bare):
            if not x:
                ids[k] = [self.lone]
        for x, back in zip(bare, self.model.decode(ids), strict=True):
            if back != x:
                self.changed[" " + x] = " " + back
        return ids


_tables: dict[str, PieceChunks] = {}


def piece_chunks(path: str) -> PieceChunks:
    if path not in _tables:
        _tables[path] = PieceChunks(path)
    return _tables[path]


def _marked(texts: pa.Array) -> pa.Array:
    """Each text with a blank in front, as the model marks it; an empty text stays empty."""
    texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), MARK, " ")
    blank = pa.scalar("", pa.large_string())
    lead = pc.if_else(pc.equal(pc.binary_length(texts), 0), blank, pa.scalar(" ", pa.large_string()))
    return pc.binary_join_element_wise(lead, texts, blank)


def encode_documents(docs: DataFrame, path: str | None = None, with_results: bool = False) -> DataFrame:
    """Ids with begin and end id of every whole text, and the text that they decode to, as digests.

    ``n_tokens`` counts all ids; ``ids_sha256`` is taken over the ids as little-endian 32-bit numbers, ``decoded_sha256``
    over the decoded text. ``with_results`` adds ``ids`` and ``decoded`` themselves. A null text is empty: begin and
    end id, decoding to nothing.
    """
    path = path or vocabulary_path(MODEL)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunks = piece_chunks(path)
        n_tokens, ids_sha, text_sha, all_ids, decoded = [], [], [], [], []
        for _, _, data, at in slices(_marked(batch.column("text"))):
            blank = data == 32
            start = blank.copy()
            start[1:] &= ~blank[:-1]
            start[at[:-1][at[:-1] < len(data)]] = True
            starts = np.flatnonzero(start)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            entries = chunks.positions(data, starts, ends)
            first = np.searchsorted(starts, at)
            counts = totals(chunks.counts(entries), first)
            flat, raw, low = chunks.ids(entries).astype("<u4"), data.tobytes(), 0
            edge = [np.array([x], "<u4").tobytes() for x in (chunks.begin, chunks.end)]
            for k, n in enumerate(counts.tolist()):
                ids = edge[0] + flat[low:low + n].tobytes() + edge[1]
                low += n
                text = raw[at[k] + 1:at[k + 1]]
                if chunks.changed:
                    spans = [raw[a:b].decode() for a, b in zip(starts[first[k]:first[k + 1]].tolist(),
                                                               ends[first[k]:first[k + 1]].tolist(), strict=True)]
                    text = "".join([chunks.changed.get(x, x) for x in spans])[1:].encode()
                n_tokens.append(n + 2)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(text).hexdigest())
                if with_results:
                    all_ids.append(np.frombuffer(ids, "<u4").astype(np.int32))
                    decoded.append(text.decode())
        out = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array(n_tokens, pa.int64()),
               "ids_sha256": pa.array(ids_sha), "decoded_sha256": pa.array(text_sha)}
        if with_results:
            out |= {"ids": pa.array(all_ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
        return pa.RecordBatch.from_pydict(out)

    return documents(docs).mapInArrow(
        in_batches(work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + (", ids array<int>, decoded string" if with_results else ""))
