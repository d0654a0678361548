"""Write an N-times copy of the driver's tables (for scaling measurements).

Every row of customer, orders and lineitem is repeated N times with its keys
moved by a multiple of the key range, so each copy is a disjoint set of
customers with their own orders and line items; nation and region are kept.
The output is split into N files per table. Use a fresh scratch folder:

  python tools/scale_copy.py /root/testdata/sf0.1 "$(mktemp -d /tmp/run-XXXXXX)/sf1x" 10
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from bankmart.session import local_session  # noqa: E402


def main() -> None:
    src, dst, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session(8)
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    n_c = read("customer").agg(F.max("c_custkey")).first()[0] + 1
    n_o = read("orders").agg(F.max("o_orderkey")).first()[0] + 1

    def copied(df, shifts):
        out = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        for column, step in shifts.items():
            out = out.withColumn(column, F.col(column) + F.col("_copy") * F.lit(step))
        return out.drop("_copy").repartition(copies)

    copied(read("customer"), {"c_custkey": n_c}).write.parquet(f"{dst}/customer.parquet")
    copied(read("orders"), {"o_orderkey": n_o, "o_custkey": n_c}).write.parquet(
        f"{dst}/orders.parquet")
    copied(read("lineitem"), {"l_orderkey": n_o}).write.parquet(f"{dst}/lineitem.parquet")
    for t in ("nation", "region"):
        read(t).write.parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
