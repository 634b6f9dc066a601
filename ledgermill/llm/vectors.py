"""Embeddings packed into blocks: one row per block, its ids and its matrix as bytes."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one double matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def sound(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", zero: bool = True) -> DataFrame:
    """Vectors that can be computed with, as ``array<double>``: not null, not empty, all components finite.

    ``zero`` admits vectors without any component other than 0. A row without id is not ok.
    """
    ship(df.sparkSession)
    v = F.col(f"`{vector_column}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = (F.size(v) > 0) & finite
    ok = ok & F.col(f"`{id_column}`").isNotNull()
    if not zero:
        ok = ok & F.exists(v, lambda x: x != 0)
    return df.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), v.alias("v"),
                     F.coalesce(ok, F.lit(False)).alias("ok"))


def blocks(rows: Iterator[pa.RecordBatch], size: int,
           numbers: tuple[str, ...] = ("vec_id",)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The columns ``numbers`` and the matrix ``v`` of up to ``size`` consecutive rows each, over batch borders.

    A new width starts a block.
    """
    keys: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    held = 0
    for batch in rows:
        if not batch.num_rows:
            continue
        widths = np.diff(batch.column("v").offsets.to_numpy())
        cuts = (np.flatnonzero(np.diff(widths)) + 1).tolist()
        named = np.stack([batch.column(c).to_numpy() for c in numbers])
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            part = matrix(batch.column("v").slice(low, high - low))
            if parts and parts[0].shape[1] != part.shape[1]:
                yield np.concatenate(keys, axis=1), np.concatenate(parts)
                keys, parts, held = [], [], 0
            at = 0
            while at < len(part):
                take = min(size - held, len(part) - at)
                keys.append(named[:, low + at:low + at + take])
                parts.append(part[at:at + take])
                held, at = held + take, at + take
                if held == size:
                    yield np.concatenate(keys, axis=1), np.concatenate(parts)
                    keys, parts, held = [], [], 0
    if parts:
        yield np.concatenate(keys, axis=1), np.concatenate(parts)
