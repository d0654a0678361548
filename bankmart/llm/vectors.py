"""Vectors of array columns as numpy matrices, and their bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample

SCHEMA = "id long, dim int, digest binary, vector binary"


def usable(vectors: DataFrame, id_column: str, column: str, *more: str, kind: str = "f8") -> DataFrame:
    """Rows whose vector takes part: (id, dim, digest, vector, *more).

    ``vector`` holds the components as floats of ``kind``, ``digest`` is the 128-bit hash of them as 64-bit floats. Left out are null and empty vectors, zero
    ones, and those with a null or non-finite component. ``more`` are columns to carry along.
    """
    numbers = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), numbers.alias("numbers"), *more) \
        .where(F.col("numbers").isNotNull()
               & F.forall("numbers", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
               & F.exists("numbers", lambda x: x != 0))
    carried = [f for f in rows.schema.fields if f.name in more]

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            lists = batch.column("numbers")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            offsets = lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            data = [flat[a:z].tobytes() for a, z in zip(offsets[:-1], offsets[1:])]
            kept = data if kind == "f8" else [flat[a:z].astype(kind).tobytes() for a, z in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets), pa.int32()),
                 pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()),
                 pa.array(kept, pa.binary()), *(batch.column(f.name) for f in carried)],
                ["id", "dim", "digest", "vector", *(f.name for f in carried)])

    extra = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in carried)
    return rows.mapInArrow(run, SCHEMA + extra)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """The rows of a matrix at unit length."""
    x = x / np.abs(x).max(axis=1, keepdims=True)      # neither overflow nor underflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def matrix(column, kind: str = "f8") -> np.ndarray:
    """The vectors of a pandas column of one dimension, as unit rows."""
    return unit_rows(np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64))


def sample(rows: DataFrame, limit: int) -> dict:
    """Unit vectors of up to ``limit`` rows, chosen by a hash of their ids, by dimension (bounded)."""
    found = hash_sample(rows.select("id", "dim", "digest", "vector"), "id", limit).toPandas() \
        .sort_values(["id", "digest"])
    return {int(d): matrix(own.vector) for d, own in found.groupby("dim")}
