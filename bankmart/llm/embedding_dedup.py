"""Near duplicates among embeddings: chunks of near vectors, compared cell by cell, one kept per group.

The different vectors of a label and dimension are dealt into chunks of bounded size by their nearest k-means
centre, and each chunk is cut into small cells. Every two chunks of a label meet in a task. Along the line
between the centres of two cells linked vectors differ by no more than their distance allows, so only
rows that lie near enough to the other cell are compared: no link is lost, wherever the centres lie. Products are
taken in single precision, those near the threshold once more in double precision. Only counts and a
spanning forest leave a task, never pairs. Exact copies are one vector with a multiplicity.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, hash_sample, lean, stored
from .vectors import matrix, unit_rows, usable

ROWS, COLUMNS, STRIP = 512, 2048, 128      # of a product at a time; rows of a strip, at least
CELL = 1024                        # rows of a cell, about
CHUNK_BYTES = 8 << 20              # of the vectors of a chunk, at most
HELD = 1 << 20                     # links that are held before they are counted
UNITS = 16                         # that one job compares, of those of several chunks


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centre that each row is nearest to, and its product with it."""
    home, best = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    for a in range(0, len(x), ROWS):
        near = x[a:a + ROWS] @ centres.T
        home[a:a + ROWS], best[a:a + ROWS] = near.argmax(1), near.max(1)
    return home, best


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Unit centres of unit rows ``x``; a cell that empties takes the row worst served."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        home, best = nearest(x, centres)
        for c in range(len(centres)):
            own = x[home == c]
            total = own.sum(0) if len(own) else x[best.argmin()]
            norm = np.sqrt((total * total).sum())
            if norm > 0:
                centres[c] = total / norm
    return centres


def in_cells(x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by cell, begin of each cell): small cells are joined, large ones are cut by k-means."""
    _, cell, size = np.unique(cell, return_inverse=True, return_counts=True)
    cell = np.where(size[cell] < CELL // 2, -1, cell)
    order = np.argsort(cell, kind="stable")
    parts = []
    for own in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        k = len(own) // CELL
        if k > 1:
            home, _ = nearest(x[own], spherical_kmeans(x[own[::max(1, len(own) // (32 * k))]], k, 4))
            by = np.argsort(home, kind="stable")
            parts += np.split(own[by], np.flatnonzero(np.diff(home[by])) + 1)
        else:
            parts.append(own)
    size = np.array([len(own) for own in parts])
    return np.concatenate(parts), np.cumsum(size) - size


class Chunk:
    """Different vectors of one label and dimension, ordered by cells."""

    def __init__(self, vectors, kind: str, dim: int, id: np.ndarray, copies: np.ndarray, begin: np.ndarray):
        self.raw = np.frombuffer(vectors, kind).reshape(-1, dim)
        self.id, self.copies, self.begin = id, copies, begin
        self.end = np.append(begin[1:], len(id))
        self.x = np.empty(self.raw.shape, np.float32)
        for a in range(0, len(self.x), ROWS):
            self.x[a:a + ROWS] = unit_rows(self.raw[a:a + ROWS].astype(np.float64))
        size = self.end - begin
        self.centres = np.add.reduceat(self.x, begin) / size[:, None].astype(np.float32)
        self.own = np.einsum("ij,ij->i", self.x, np.repeat(self.centres, size, axis=0))

    def __len__(self):
        return len(self.id)


def packed(pdf, kind: str, dim: int) -> tuple:
    """What makes a chunk of rows (id, copies, vector, cell)."""
    raw = np.frombuffer(b"".join(pdf.vector), kind).reshape(-1, dim)
    x = np.concatenate([unit_rows(raw[a:a + ROWS].astype(np.float64)).astype(np.float32)
                        for a in range(0, len(raw), ROWS)])
    order, begin = in_cells(x, pdf.cell.to_numpy())
    return raw[order].tobytes(), pdf.id.to_numpy(np.int64)[order], pdf.copies.to_numpy(np.int64)[order], begin


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of a and b: ``root`` then has the smallest row of each row's group again."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


class Meeting:
    """All links between two chunks, or within one: links of each row, and the row its group points at."""

    def __init__(self, a: Chunk, b: Chunk, threshold: float):
        self.a, self.b, self.threshold, self.same = a, b, threshold, a is b
        self.slack = (a.x.shape[1] + 8) * 2.0 ** -23           # more than a single precision product errs by
        self.shift = 0 if self.same else len(a)
        self.id = a.id if self.same else np.concatenate([a.id, b.id])
        self.copies = (a.copies if self.same else np.concatenate([a.copies, b.copies])).astype(np.float64)
        self.links, self.root = np.zeros(len(self.id)), np.arange(len(self.id))
        self.held, self.waiting, self.compared = [], 0, 0
        self._cells()
        self._count()

    def _cells(self) -> None:
        a, b = self.a, self.b
        # how much nearer the rows are to their own centre than to one of the other chunk
        ahead = a.own[None] - b.centres @ a.x.T
        beyond = ahead if self.same else b.own[None] - a.centres @ b.x.T
        least_a = np.minimum.reduceat(ahead, a.begin, axis=1)
        least_b = least_a if self.same else np.minimum.reduceat(beyond, b.begin, axis=1)
        apart = ((a.centres.astype(np.float64)[:, None] - b.centres[None]) ** 2).sum(2)
        limit = (np.sqrt(max(0.0, 2 - 2 * self.threshold)) + self.slack) * np.sqrt(apart) + 8 * self.slack
        meet = least_a.T + least_b <= limit
        if self.same:
            meet = np.triu(meet)
            np.fill_diagonal(meet, True)
        for c, d in zip(*map(np.ndarray.tolist, np.nonzero(meet))):
            if self.same and c == d:
                i = np.arange(a.begin[c], a.end[c])
                for p in range(0, len(i), ROWS):
                    for q in range(p, len(i), COLUMNS):
                        self._tile(i[p:p + ROWS], i[q:q + COLUMNS], a.x[i[p:p + ROWS]], a.x[i[q:q + COLUMNS]])
                continue
            f, g = ahead[d, a.begin[c]:a.end[c]], beyond[c, b.begin[d]:b.end[d]]
            i = np.flatnonzero(f <= limit[c, d] - least_b[c, d])
            j = np.flatnonzero(g <= limit[c, d] - least_a[d, c])
            i, j = i[np.argsort(f[i])], j[np.argsort(g[j])]
            reached = g[j]
            x, y = a.x.take(a.begin[c] + i, 0), b.x.take(b.begin[d] + j, 0)
            # the farther a strip of rows is ahead, the fewer of the others it can meet
            strip = min(ROWS, max(STRIP, len(i) // 8))
            for p in range(0, len(i), strip):
                stop = int(np.searchsorted(reached, limit[c, d] - f[i[p]], "right"))
                for q in range(0, stop, COLUMNS):
                    e = min(stop, q + COLUMNS)
                    self._tile(a.begin[c] + i[p:p + strip], b.begin[d] + j[q:e], x[p:p + strip], y[q:e])

    def _tile(self, i: np.ndarray, j: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """The rows ``i`` of a (vectors x) with ``j`` of b (vectors y); if both are of one cell, two rows only as i < j."""
        near = x @ y.T
        self.compared += near.size
        if self.same and len(j) and i[0] <= j[-1] and j[0] <= i[-1]:
            near[i[:, None] >= j[None]] = -np.inf
        if not near.size or near.max() < self.threshold - self.slack:
            return
        linked = near >= self.threshold + self.slack
        doubt = np.flatnonzero((near >= self.threshold - self.slack) & ~linked)
        for p in range(0, len(doubt), ROWS):
            r, c = np.divmod(doubt[p:p + ROWS], len(j))
            linked[r, c] = np.einsum("ij,ij->i", unit_rows(self.a.raw[i[r]].astype(np.float64)),
                                     unit_rows(self.b.raw[j[c]].astype(np.float64))) >= self.threshold
        if np.count_nonzero(linked) * 8 <= linked.size:
            r, c = np.nonzero(linked)
            self._hold(i[r], j[c] + self.shift)
            return
        # many links: summed up as a product, and joined only if they connect what is not yet connected
        self.links[i] += linked @ self.copies[j + self.shift]
        self.links[j + self.shift] += self.copies[i] @ linked
        root = self.root[np.concatenate([i[linked.any(1)], j[linked.any(0)] + self.shift])]
        if (root != root[0]).any():
            r, c = np.nonzero(linked)
            _join(self.root, i[r], j[c] + self.shift)

    def _hold(self, i: np.ndarray, j: np.ndarray) -> None:
        self.held.append((i, j))
        self.waiting += len(i)
        if self.waiting > HELD:
            self._count()

    def _count(self) -> None:
        if self.waiting:
            i, j = map(np.concatenate, zip(*self.held))
            n = len(self.id)
            self.links += np.bincount(i, self.copies[j], n) + np.bincount(j, self.copies[i], n)
            _join(self.root, i, j)
        self.held, self.waiting = [], 0

    def result(self) -> dict:
        """Columns (id, links, a, b): rows with links, and the edges of a spanning forest."""
        own = np.flatnonzero(self.links > 0)
        led = np.flatnonzero(self.root != np.arange(len(self.root)))
        zero = np.zeros(max(len(own), len(led)), np.int64)
        return {"id": np.concatenate([self.id[own], zero[:len(led)]]),
                "links": np.concatenate([self.links[own].astype(np.int64), zero[:len(led)]]),
                "a": np.concatenate([zero[:len(own)], self.id[self.root[led]]]),
                "b": np.concatenate([zero[:len(own)], self.id[led]])}


FOUND = "id long, links long, a long, b long"


def _within(threshold: float, kind: str):
    """For applyInPandas: the links of a label's and dimension's vectors, few enough for one chunk."""
    def run(key, pdf):
        import pandas as pd

        vectors, id, copies, begin = packed(pdf.assign(cell=0), kind, int(key[1]))
        chunk = Chunk(vectors, kind, int(key[1]), id, copies, begin)
        return pd.DataFrame(Meeting(chunk, chunk, threshold).result())

    return run


def _assign(centres: dict, kind: str):
    """For mapInArrow: rows with the number of their nearest centre."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                for a in range(0, len(at) if dim in centres else 0, ROWS):
                    k = at[a:a + ROWS]
                    raw = np.frombuffer(b"".join(batch.column("vector").take(pa.array(k)).to_pylist()), kind)
                    x = unit_rows(raw.reshape(len(k), dim).astype(np.float64)).astype(np.float32)
                    cell[k], _ = nearest(x, centres[dim])
            yield batch.append_column("cell", pa.array(cell))

    return lean(run)


PACKED = "unit long, no int, dim int, vectors binary, ids binary, copies binary, begin binary"


def _pack(kind: str):
    """For applyInPandas: a chunk as one row."""
    def run(key, pdf):
        import pandas as pd

        dim = int(pdf.dim.iloc[0])
        vectors, id, copies, begin = packed(pdf, kind, dim)
        return pd.DataFrame({"unit": [key[0]], "no": [key[1]], "dim": [dim], "vectors": [vectors],
                             "ids": [id.tobytes()], "copies": [copies.tobytes()],
                             "begin": [begin.astype(np.int64).tobytes()]})

    return run


def _across(threshold: float, kind: str):
    """For mapInArrow: the links of pairs of chunks (columns a_*, b_*; a pair of one chunk: within it)."""
    def run(batches):
        import pyarrow as pa

        held: dict = {}

        def chunk(row, side: str) -> Chunk:
            key = (row.column(f"{side}_unit")[0].as_py(), row.column(f"{side}_no")[0].as_py())
            if key not in held:
                while len(held) > 1:
                    del held[next(iter(held))]
                of = lambda name: row.column(f"{side}_{name}")[0].as_py()
                held[key] = Chunk(of("vectors"), kind, of("dim"), np.frombuffer(of("ids"), np.int64),
                                  np.frombuffer(of("copies"), np.int64), np.frombuffer(of("begin"), np.int64))
            return held[key]

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                a = chunk(row, "a")
                found = Meeting(a, chunk(row, "b"), threshold).result()
                yield pa.RecordBatch.from_pydict(found)

    return lean(run)


def _crossed(chunks: DataFrame, unit: int, count: int) -> DataFrame:
    """Every two chunks of a unit, each chunk with itself too: read where they are stored, not dealt out."""
    own = chunks.where(F.col("unit") == unit)
    left = own.select([F.col(c).alias(f"a_{c}") for c in own.columns]).coalesce(max(4, count // 4))
    right = own.select([F.col(c).alias(f"b_{c}") for c in own.columns]).hint("shuffle_replicate_nl")
    return left.crossJoin(right).where("a_no <= b_no")


def _large(big: DataFrame, units: list, centres: dict, threshold: float, kind: str) -> list[DataFrame]:
    """Links within units of several chunks. ``big`` (unit, chunks, size, dim, id, copies, vector)."""
    spark = big.sparkSession
    with_cell = big.mapInArrow(_assign(centres, kind), ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in big.schema.fields) + ", cell int")
    cells = with_cell.groupBy("unit", "cell").agg(F.count("*").alias("n"))
    cells = cells.withColumn("before", F.sum("n").over(Window.partitionBy("unit").orderBy("cell")) - F.col("n"))
    # in the order of cells, by a hash within a cell; whatever cell a row gets, it gets a chunk
    rank = F.coalesce(F.col("before") + F.pmod(F.xxhash64("id"), F.col("n")), F.lit(0))
    dealt = with_cell.join(stored(cells, "cell-sizes"), ["unit", "cell"], "left")         .withColumn("no", F.floor(rank * F.col("chunks") / F.col("size")).cast("int"))
    chunks = stored(dealt.select("unit", "no", "dim", "id", "copies", "vector", "cell")
                    .groupBy("unit", "no").applyInPandas(_pack(kind), PACKED), "vector-chunks", ("unit",),
                    maxRecordsPerFile=1)
    found, setting = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")                   # a row is two chunks
    try:
        for at in range(0, len(units), UNITS):
            pairs = reduce(DataFrame.union, [_crossed(chunks, u.unit, u.chunks) for u in units[at:at + UNITS]])
            found.append(stored(pairs.mapInArrow(_across(threshold, kind), FOUND), "vector-links"))
    finally:
        spark.conf.set(setting, before)
    return found


def cells_for(largest: int) -> int:
    """Cells for labels of up to ``largest`` different vectors: the share of pairs compared falls as they grow."""
    return int(min(2048, max(16, largest ** 0.5 / 4, largest / 1500)))


def embedding_near_dedup(vectors: DataFrame, threshold: float = 0.93, cells: int | None = None,
                         sample_rows: int = 20_000, block: int = 4096, blocks: int = 8) -> DataFrame:
    """Link vectors of equal, non-null label with a cosine (double precision) of ``threshold`` or more.

    ``vectors`` (vec_id, embedding, label). Returns per row: vec_id, n_links (other rows linked
    directly, exact copies included), component_id (smallest vec_id reachable by links), kept (vec_id =
    component_id). Up to ``block`` times ``blocks`` different vectors of a label are one chunk; those of larger labels
    are dealt to chunks by centres, fitted on up to ``sample_rows`` vectors. The number of ``cells`` (centres) grows with
    the largest label if not given. Every vector is compared,
    and all links are found. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different length. Rows of one vec_id
    count as vectors of their own. A row with a null vec_id is not compared: null ids, no links,
    kept. Other columns are ignored.
    """
    base = vectors.select("vec_id", "embedding", "label")
    kind = "f4" if dict(base.dtypes)["embedding"] == "array<float>" else "f8"
    taken = usable(base.where("label is not null and vec_id is not null"), "vec_id", "embedding", "label", kind=kind)
    rows = stored(taken.drop("vector"), "vectors")
    groups = stored(taken.groupBy("label", "dim", "digest").agg(
        F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("id", F.monotonically_increasing_id()), "vector-groups")
    most = F.greatest(F.lit(1), F.least(F.lit(block * blocks),
                                        F.floor(F.lit(CHUNK_BYTES) / (F.col("dim") * np.dtype(kind).itemsize))))
    sizes = stored(groups.groupBy("label", "dim").agg(F.count("*").alias("size"))
                   .withColumn("chunks", F.ceil(F.col("size") / most).cast("int"))
                   .withColumn("unit", F.monotonically_increasing_id()), "label-sizes")
    members = groups.select("label", "dim", "id", "copies", "vector")
    few = members.join(sizes.where("chunks = 1").select("label", "dim"), ["label", "dim"])
    found = [stored(few.groupBy("label", "dim").applyInPandas(_within(threshold, kind), FOUND), "vector-links")]
    units = sizes.where("chunks > 1").select("unit", "chunks", "size").collect()
    if units:
        big = members.join(sizes.where("chunks > 1"), ["label", "dim"]).drop("label")
        cells = cells or cells_for(max(u.size for u in units))
        drawn = hash_sample(big.select("id", "dim", "vector"), "id", sample_rows).toPandas().sort_values("id")
        centres = {int(d): spherical_kmeans(matrix(own.vector, kind), cells).astype(np.float32)
                   for d, own in drawn.groupby("dim")}
        found += _large(big, units, centres, threshold, kind)
    found = reduce(DataFrame.union, found)
    links = found.where("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.where("a != b").select("a", "b"))
    group = groups.select("label", "dim", "digest", "id", "least", "copies") \
        .join(labels.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("component", F.coalesce("component", "id")).join(links, "id", "left")
    least = group.groupBy("component").agg(F.min("least").alias("component_id"))
    group = group.join(least, "component").select(
        "label", "dim", "digest", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = rows.select("id", "label", "dim", "digest").join(group, ["label", "dim", "digest"]) \
        .select(F.col("id").alias("vec_id"), "n_links", "component_id")
    numbers = F.col("embedding").cast("array<double>")
    takes_part = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & numbers.isNotNull()
        & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(numbers, lambda x: x != 0), F.lit(False))
    alone = base.where(~takes_part).select(
        F.col("vec_id").cast("long"), F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
