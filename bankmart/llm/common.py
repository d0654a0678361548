"""Helpers the operators share: scratch tables, Arrow text access, components."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.session import checkpoint_dir

# Fixed value of the operators' contracts: what separates words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage).

    Later jobs then neither recompute it nor depend on any executor's disk.
    """
    path = scratch(df.sparkSession, name)
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shipped(spark: SparkSession, value):
    """Broadcast ``value``, of bounded size, with its class; gives what loads it in a task."""
    from pyspark import cloudpickle

    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(data.value)


@contextmanager
def lent(spark: SparkSession, value):
    """``shipped`` for the jobs of a with block: the broadcast is gone after it, from the driver too."""
    from pyspark import cloudpickle

    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    try:
        yield lambda: cloudpickle.loads(data.value)
    finally:
        data.destroy()


def give_back() -> None:
    """Return freed memory to the system; allocators would keep what a finished step has used."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc
    if trim:
        trim(0)


def lean(run):
    """``run`` for mapInArrow, in a worker that is small again when the task ends (workers serve many stages)."""
    def whole(batches):
        yield from run(batches)
        give_back()

    return whole


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """Up to ``limit`` rows, those of the smallest hashes of ``key``; all rows if there are no more.

    The threshold is set for 97 % of ``limit``, so that the final limit never has to choose.
    """
    n = df.count()
    if n <= limit:
        return df
    least = int(-(2**63) + 0.97 * limit / n * 2**64)
    return df.where(F.xxhash64(key) < F.lit(least)).limit(limit)


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Hand whole texts to Python in batches of fewer rows, unless the session has a setting of its own.

    Spark's default of 10,000 rows is some ten megabytes of text, held several times on both sides.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batch, budget: int, column: str = "text", rows: int = 1 << 30):
    """Cut an Arrow batch into slices of up to ``rows`` rows whose texts hold about ``budget`` bytes.

    A text longer than the budget comes alone. Every row is in one slice.
    """
    if not batch.num_rows:
        return
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + budget, side="right")))
        stop = min(stop, at + rows)
        yield batch.slice(at, stop - at)
        at = stop


def text_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text array and its n + 1 offsets (null: empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if hasattr(array, "combine_chunks"):
        array = array.combine_chunks()
    array = pc.fill_null(array.cast(pa.large_string()), "")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def stretches(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, limit: int):
    """Cut the bytes of texts into stretches (begin, end) of about ``limit`` bytes, not within a word.

    ``inside`` says of each byte value whether it belongs to a word; texts begin at ``offsets``. A word
    that is longer than all this is not cut.
    """
    at = 0
    while at < len(raw):
        stop = min(at + limit, len(raw))
        if stop < len(raw):
            back = np.flatnonzero(~inside[raw[at:stop]])
            border = int(offsets[np.searchsorted(offsets, stop, side="right") - 1])
            cut = max(at + int(back[-1]) + 1 if len(back) else at, border)
            if cut == at:
                end = min(int(offsets[np.searchsorted(offsets, at, side="right")]), len(raw))
                ahead = np.flatnonzero(~inside[raw[stop:end]])
                cut = stop + int(ahead[0]) + 1 if len(ahead) else end
            stop = cut
        yield at, stop
        at = stop


def word_bounds(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray, a: int, z: int):
    """(begin, end) of the words in the stretch raw[a:z], counted from ``a``; texts begin at ``offsets``."""
    within = inside[raw[a:z]]
    cuts = np.zeros(z - a + 1, bool)
    cuts[offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, z, side="right")] - a] = True
    first, last = within.copy(), within.copy()
    first[1:] &= ~within[:-1] | cuts[1:-1]
    last[:-1] &= ~within[1:] | cuts[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches flat[begin:begin + size], one after the other."""
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((begin - (stop - size)).astype(kind), size) + np.arange(total, dtype=kind)]


class PartCache:
    """Ids of parts of texts that a task has met; forgets all beyond ``LIMIT`` parts or ``BYTES`` of them."""

    LIMIT, BYTES = 1 << 20, 96 << 20
    ENTRY = 150                # bytes of a part beside its characters and ids

    def __init__(self, encode):
        self.encode = encode       # parts -> (ids of all, sizes)
        self._forget()

    def _forget(self) -> None:
        self.number: dict = {}
        self.flat, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.held = 0

    def of(self, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin of each part in them, size of each part) for distinct parts."""
        new = [p for p in parts if p not in self.number]
        length = sum(map(len, new))
        if self.number and (len(self.number) + len(new) > self.LIMIT
                            or self.held + self.ENTRY * len(new) + 6 * length > self.BYTES):
            self._forget()
            new, length = parts, sum(map(len, parts))
        if new:
            flat, size = self.encode(new)
            self.held += self.ENTRY * len(new) + 2 * length + 4 * len(flat)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.size = np.concatenate([self.size, size])
        at = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
        return self.flat, (np.cumsum(self.size) - self.size)[at], self.size[at]


class SortedHashes:
    """A sorted array of 64-bit hashes with a directory of their leading bits."""

    BITS = 18

    def __init__(self, hashes: np.ndarray):
        self.keys = np.append(hashes, np.uint64(2**64 - 1))
        lead = np.arange((1 << self.BITS) + 1, dtype=np.uint64)
        lead[:-1] <<= np.uint64(64 - self.BITS)
        self.first = np.searchsorted(hashes, lead[:-1]).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(hashes)))
        self.longest = int(np.diff(self.first).max())

    def __len__(self):
        return len(self.keys) - 1

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted hash, -1 where it is missing."""
        at = self.first[(wanted >> np.uint64(64 - self.BITS)).astype(np.int64)]
        open_ = np.flatnonzero(self.keys[at] != wanted)
        for _ in range(1, self.longest):
            if not len(open_):
                break
            at[open_] = np.minimum(at[open_] + 1, len(self))
            open_ = open_[self.keys[at[open_]] < wanted[open_]]
        at[self.keys[at] != wanted] = -1
        at[at == len(self)] = -1
        return at


FINISHED_EDGES = 1 << 16     # that one task joins


def _smallest(frames):
    """(node, component) of a graph of few edges (a, b)."""
    import pandas as pd

    pdf = pd.concat(list(frames) or [pd.DataFrame({"a": [], "b": []}, dtype="int64")])
    names, at = np.unique(np.concatenate([pdf.a.to_numpy(), pdf.b.to_numpy()]), return_inverse=True)
    a, b = at[:len(pdf)], at[len(pdf):]
    root = np.arange(len(names))
    while (root[a] != root[b]).any():
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))     # a root points at smaller roots only
        while (root[root] != root).any():
            root = root[root]
    yield pd.DataFrame({"node": names, "component": names[root]})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component).

    ``component`` is the smallest node of the component. Nodes of no edge are
    not in the result; null ends and loops are ignored. Each round points every
    node at its smallest neighbour, follows the pointers to their roots' side
    twice, and contracts the graph; pointers only lead to smaller nodes, so
    they cannot form a cycle. Rounds end when FINISHED_EDGES or fewer are left, which one
    task joins. All steps before are joins and
    pre-aggregated groupings: a node of very many edges is no single group.
    """
    edges = stored(edges.where("a is not null and b is not null and a != b")
                   .select("a", "b").distinct(), "edges")
    kind = edges.schema["a"].dataType.simpleString()

    def finished(edges: DataFrame) -> DataFrame:
        return stored(edges.coalesce(1).mapInPandas(_smallest, f"node {kind}, component {kind}"), "joined")

    if edges.count() <= FINISHED_EDGES:
        return finished(edges)
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    while edges.count() > FINISHED_EDGES:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("to"))
        step = stored(step, "step")
        for _ in range(2):
            nxt = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
            step = step.join(nxt, "to").select("node", F.col("further").alias("to"))
        step = stored(step, "jumped")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        labels = stored(labels.join(left.withColumnRenamed("a", "component"), "component", "left")
                        .select("node", F.coalesce("x", "component").alias("component")), "labels")
        edges = stored(edges.join(left, "a").join(right, "b").where("x != y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), "edges")
    left = finished(edges).select(F.col("node").alias("component"), F.col("component").alias("x"))
    return stored(labels.join(left, "component", "left").select("node", F.coalesce("x", "component").alias("component")),
                  "labels")
