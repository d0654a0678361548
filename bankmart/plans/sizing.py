"""Input-size estimates that stay meaningful on derived plans.

Without cost-based statistics Spark estimates a join's output as the product
of its inputs, so the size estimate of a plan with joins can exceed its
input by many orders of magnitude. Decisions that scale with the data (how
many shuffle partitions, which form of a check to run) therefore use the
bytes of the plan's leaf relations (file sizes for Parquet scans): the data
the plan has to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _to_int(size) -> int:
    return int(size if isinstance(size, int) else size.toString())


def input_bytes(df: DataFrame) -> int:
    """Total estimated size of the relations ``df`` reads (its plan's leaves)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(_to_int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
