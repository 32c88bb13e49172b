"""Embedding rows as whole numbers, the common input of whitening and of vector codes.

Defined cases: rows whose vector is null, or that holds a null or non-finite entry, are left out; so are empty
vectors, which have no entries to work on. All other vectors must have one length: another one ends the job with a ValueError.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Beyond this an entry's square no longer adds up exactly in 64 bits.
LARGEST = 1 << 28


def whole_rows(vectors: DataFrame, scale: int, *others: str) -> DataFrame:
    """vec_id, the named columns, and x: floor(scale * entry) of each entry as double."""
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return (vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound)
            .select(F.col("vec_id").cast("long").alias("vec_id"), *others, x.alias("x")))


def width_of(rows: DataFrame) -> int:
    """Length of the vectors, 0 without any."""
    least, most = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} entries in one table")
    return least or 0


def grid(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of whole numbers."""
    out = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if len(out) and max(out.max(), -out.min()) > LARGEST:
        raise OverflowError(f"an entry beyond {LARGEST} cannot be squared exactly")
    return out
