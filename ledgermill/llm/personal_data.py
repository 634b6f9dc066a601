"""Personal data: exact base patterns, and further spans chosen among candidates by boosted trees.

Generators propose spans with high recall, overlapping ones too: digit runs in any grouping, dotted numbers, addresses
with "at" and "dot" written out. Boosted trees judge a candidate by its format and its surroundings; they learn from the
base matches of a bounded sample of documents, drawn for each kind from all that have it, rewritten in other formats,
against damaged ones and candidates that the base patterns refuse. A threshold for each kind is set where held-out examples reach the wanted precision. Spans of the
base patterns always stay.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.boosting import Boosted, boost
from ledgermill.llm.common import documents, in_batches, ship

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS = 4_000   # documents of any sort that examples are taken from, on average
KIND_DOCUMENTS = 500       # documents with a base match of a kind that examples are taken from besides, on average
EXAMPLES = 20_000          # examples that the trees are fitted on, at most
PRECISION = 0.98           # that added spans of a kind must reach on held-out examples
LEAST_PROBABILITY = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number fails from its first digit if it fails at all, so no search starts inside one: long runs stay linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_LIKE_NUMBER = re.compile(r"(?<![\w+(])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){6,24}(?!\w)")
_LIKE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\]|\(\.\))\x20?[0-9]{1,3}){3}(?![\w.])")
_LIKE_EMAIL = re.compile(r"(?<![\w.])[\w.%+-]{1,64}\x20?(?:@|\[at\]|\(at\)|\x20at\x20)\x20?[\w-]{1,64}"
                         r"(?:\x20?(?:\.|\[dot\]|\(dot\)|\x20dot\x20)\x20?[\w-]{2,24}){1,4}", re.ASCII)
_CUES = re.compile(r"(?:mail|contact|write|phone|call|tel|fax|mobile|card|visa|iban|account|pay|host|server|ip|addr)",
                   re.IGNORECASE)
_AROUND = 24


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and not overlapping within a kind, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                spans.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans of any kind the generators propose; one span may be proposed as several kinds."""
    found = []
    if _DIGIT.search(text):
        for m in _LIKE_NUMBER.finditer(text):
            digits = sum(c.isdigit() for c in m.group())
            found += [(m.start(), 2, m.end())] if 12 <= digits <= 19 else []
            found += [(m.start(), 3, m.end())] if 7 <= digits <= 15 else []
        found += [(m.start(), 1, m.end()) for m in _LIKE_IP.finditer(text)]
    if "@" in text or " at " in text or "(at)" in text or "[at]" in text:
        found += [(m.start(), 0, m.end()) for m in _LIKE_EMAIL.finditer(text)]
    return sorted(found)


def _side(text: str) -> list[float]:
    c = text[:1]
    return [float(c.isspace() or not c), float(c.isalpha()), float(c.isdigit()), float(c in ".,;:!?")]


def features(kind: int, span: str, before: str, after: str) -> list[float]:
    """Format of a span and what stands around it."""
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    digits = "".join(re.findall("[0-9]", span))
    return [float(kind == k) for k in range(len(KINDS))] + [
        float(len(digits)), float(len(groups)), float(max(groups)), float(min(groups)), float(groups[-1]),
        float(len(set(re.findall(r"[^0-9A-Za-z]", span)))), float("(" in span), float("." in span), float("-" in span),
        float(" " in span), float(_luhn(digits) if 12 <= len(digits) <= 19 else 0),
        float(all(int(g) <= 255 for g in re.findall("[0-9]{1,9}", span))), float(sum(c.isalpha() for c in span)),
        float("@" in span), float(bool(re.search(r"[\[( ]at[\]) ]", span))),
        float(bool(re.search(r"\bdot\b", span))), float(len(span)), float(bool(_CUES.search(before)))
    ] + _side(before[::-1]) + _side(after)


def _rewritten(kind: int, span: str, seed: int) -> list[tuple[str, int]]:
    """Other formats of a true span (1) and damaged ones (0)."""
    if kind == 0:
        user, _, host = span.partition("@")
        return [(f"{user} at {host.replace('.', ' dot ')}", 1), (f"{user}(at){host}", 1),
                (f"{user} [at] {host.replace('.', ' [dot] ')}", 1), (f"{user} at {host.split('.')[0]}.", 0),
                (f"the at {host.split('.')[0][:4]}.and", 0)]
    if kind == 1:
        parts = span.split(".")
        return [("[.]".join(parts), 1), ("(.)".join(parts), 1),
                (".".join([*parts[:3], str(300 + seed % 600)]), 0), (".".join(p[:1] for p in parts), 0)]
    digits = re.sub("[^0-9]", "", span)
    if kind == 2:
        four = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        broken = digits[:-1] + str((int(digits[-1]) + 1 + seed % 8) % 10)
        return [(".".join(four), 1), ("/".join(four), 1), (broken, 0), (" ".join(broken[i:i + 4] for i in range(0, 16, 4)), 0)]
    bare = re.sub(r"^\+[0-9]+[\x20.-]*", "", span)
    return [(bare, 1), (bare.replace("(", "").replace(") ", "-"), 1), (digits, 0), (digits[:7], 0),
            (digits[:4] + "-" + digits[4:6] + "-" + digits[6:8], 0)]


@dataclass
class Model:
    trees: Boosted | None = None
    thresholds: dict[int, float] = field(default_factory=dict)


def documents_of_kinds(rows: DataFrame) -> list[int]:
    """For each kind, how many of all documents have a base match of it."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds = [{k for _, k, _ in base_spans(text)} for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_pydict({name: pa.array([sum(k in found for found in kinds)], pa.int64())
                                           for k, name in enumerate(KINDS)})

    counted = rows.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(
        in_batches(work), ", ".join(f"{name} long" for name in KINDS))
    return [n or 0 for n in counted.agg(*[F.sum(name) for name in KINDS]).first()]


def examples(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, limit: int = EXAMPLES,
             of_kind: int = KIND_DOCUMENTS) -> DataFrame:
    """``key, y, x``: examples from documents with a digit or "@", drawn by hash of id and text.

    About ``sample`` of all documents are drawn, and of those with a base match of a kind about ``of_kind``, so each
    kind has examples however rare it is. Beyond ``limit`` the kinds with most examples give some up first.
    """
    rows = documents(docs)
    top = 1 << 30
    below = int(min(1.0, sample / max(1, rows.count())) * top)
    # all that is drawn for a kind: nothing more if the sample has every document
    below_kind = [int(min(1.0, of_kind / max(1, n)) * top) for n in documents_of_kinds(rows)] if below < top else [0]
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(top))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, labels, kinds, rows_ = [], [], [], []

        def add(y: int, kind: int, span: str, before: str, after: str) -> None:
            kinds.append(kind)
            keys.append(zlib.crc32(f"{kind}{span}{before}".encode()))
            labels.append(y)
            rows_.append(features(kind, span, before, after))

        for text, drawn in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist(), strict=True):
            known = base_spans(text)
            if drawn >= below and not any(drawn < below_kind[k] for _, k, _ in known):
                continue
            for a, kind, b in known:
                around = text[max(0, a - _AROUND):a], text[b:b + _AROUND]
                add(1, kind, text[a:b], *around)
                for span, y in _rewritten(kind, text[a:b], a):
                    add(y, kind, span, *around)
            for a, kind, b in candidates(text):
                if not any(a < y and x < b for x, _, y in known):
                    add(0, kind, text[a:b], text[max(0, a - _AROUND):a], text[b:b + _AROUND])
        return pa.RecordBatch.from_pydict({
            "key": pa.array(keys, pa.int64()), "y": pa.array(labels, pa.int32()), "kind": pa.array(kinds, pa.int32()),
            "x": pa.array(rows_, pa.list_(pa.float64()))})

    made = rows.withColumn("draw", draw).where(
        (F.col("draw") < max(below, *below_kind)) & F.col("text").rlike("[0-9@]")).mapInArrow(
            in_batches(work), "key long, y int, kind int, x array<double>")
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("key", "y", "x"))
    return (made.withColumn("nth", nth).where(F.col("nth") <= limit).orderBy("nth", "kind").limit(limit)
            .select("key", "y", "x").orderBy("key", "y", "x"))


def fit(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, limit: int = EXAMPLES, of_kind: int = KIND_DOCUMENTS) -> Model:
    """Trees and thresholds from a bounded sample; without examples of both kinds no span is ever added."""
    ship(docs.sparkSession)
    rows = examples(docs, sample, limit, of_kind).collect()
    if len({r["y"] for r in rows}) < 2:
        return Model()
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float)
    held = np.array([r["key"] % 10 < 3 for r in rows])
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        return Model()
    trees = boost(x[~held], y[~held])
    trees.calibrate(x[held], y[held])
    p, thresholds = trees.probability(x[held]), {}
    for kind in range(len(KINDS)):
        own = x[held][:, kind] == 1
        order = np.argsort(-p[own], kind="stable")
        true = y[held][own][order]
        good = np.flatnonzero((np.cumsum(true) / np.arange(1, len(true) + 1) >= PRECISION)
                              & (p[own][order] >= LEAST_PROBABILITY))
        if len(good):
            thresholds[kind] = float(p[own][order][good[-1]])
    return Model(trees, thresholds)


def all_spans(texts: list[str], model: Model) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """For each text its base spans, and these with the added ones, in order of start and kind."""
    base = [base_spans(t) for t in texts]
    open_, rows = [], []
    for i, (text, known) in enumerate(zip(texts, base, strict=True)):
        for a, kind, b in candidates(text) if model.trees and model.thresholds else ():
            if kind in model.thresholds and not any(a < y and x < b for x, _, y in known):
                open_.append((i, a, kind, b))
                rows.append(features(kind, text[a:b], text[max(0, a - _AROUND):a], text[b:b + _AROUND]))
    full = [list(s) for s in base]
    if rows:
        p = model.trees.probability(np.array(rows))
        for k in np.argsort(-p, kind="stable").tolist():
            i, a, kind, b = open_[k]
            if p[k] >= model.thresholds[kind] and not any(a < y and x < b for x, _, y in full[i]):
                full[i].append((a, kind, b))
    return base, [sorted(s) for s in full]


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def found(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per document; a null text is empty.

    The counts and the digest are those of the base patterns; ``spans`` has the added spans too.
    """
    model = fit(docs) if model is None else model

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, full = all_spans(batch.column("text").to_pylist(), model)
        out = {"doc_id": batch.column("doc_id")}
        for k, kind in enumerate(KINDS):
            out[f"n_{kind}"] = pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64())
        out["base_sha256"] = pa.array([hashlib.sha256(_line(s).encode()).hexdigest() for s in base], pa.string())
        out["spans"] = pa.array([_line(s) for s in full], pa.string())
        return pa.RecordBatch.from_pydict(out)

    return documents(docs).mapInArrow(
        in_batches(work), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                          "spans string")


def _redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first one."""
    parts, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            parts += [text[at:a], f"[{KINDS[kind]}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with all columns, found spans replaced in ``text``; null texts stay null.

    A column ``n_chars`` follows the new text.
    """
    model = fit(docs) if model is None else model
    ship(docs.sparkSession)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        _, full = all_spans([t or "" for t in texts], model)
        new = [t if t is None else _redact(t, s) for t, s in zip(texts, full, strict=True)]
        return batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, batch.column("text").type))

    out = docs.mapInArrow(in_batches(work), docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else out
