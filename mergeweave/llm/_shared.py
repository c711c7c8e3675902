"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import shared_dir, stored

__all__ = ["shared_dir", "slices", "stored", "table", "texts_of"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, text: str, limit: int = 8_000_000):
    """Cut an Arrow batch so that each part holds about ``limit`` bytes of text at most (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
