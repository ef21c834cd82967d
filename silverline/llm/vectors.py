"""Embeddings as whole numbers, and as numpy matrices inside tasks."""

from __future__ import annotations

from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import numpy as np


def whole_vectors(vectors: DataFrame, scale: int, shift: int = 0) -> DataFrame:
    """(vec_id, x): floor(scale * c) + shift of every component c, taken as double.

    Vectors that are NULL or hold a NULL or non-finite component are left out. Components must stay
    far below 2^63 / scale.
    """
    components = F.col("embedding").cast("array<double>")
    bad = F.exists(components, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(components.isNotNull() & ~bad).select(
        "vec_id", F.transform(components, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x")
    )


def matrix(column: pa.ListArray, least: int = 0, missing: int = 0) -> np.ndarray:
    """The vectors as rows; short ones are filled up, to `least` columns at any rate."""
    import numpy as np

    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    width = max(least, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.full((len(lengths), width), missing, dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out
