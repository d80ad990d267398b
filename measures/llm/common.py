"""Helpers shared by the corpus operators: shared folder, Arrow text views."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from measures.session import checkpoint_root, ship_package

__all__ = ["blocks_for", "cut_lineage", "shared_path", "ship_package", "stored", "text_buffer",
           "text_chunks"]

# Text handled at once inside a task; a single longer text is handled alone.
CHUNK_BYTES = 4 << 20


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` once to the cluster's shared checkpoint folder and go on
    from there, so that a lost executor never recomputes what came before."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Like `cut_lineage`, as Parquet: much smaller for wide or repetitive rows."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most `max_bytes` of text each (one row at least)."""
    _, offsets = text_buffer(texts)
    n, a = len(texts), 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1] \
        if offsets is not None and len(texts) else np.zeros(1, kind)
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks_for(n_bytes: float, block_bytes: float) -> int:
    return max(1, math.ceil(n_bytes / block_bytes))
