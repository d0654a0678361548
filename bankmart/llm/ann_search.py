"""Approximate nearest neighbours by multi-index hashing.

A code is the signs of a vector under several rotations, learned by alternating
between signs and the rotation that fits them best. It is cut into substrings of 16
bits, each an index of its own. If two codes differ in fewer than m (a + 1) of their bits, some
of the m substrings differs in a bits or fewer: probing all values within a bits of
the query's, in every substring's index, retrieves every code within that radius (and many beyond it).
What is retrieved and differs in no more bits than a second, larger radius is ranked by
the vectors themselves. m, a and that radius are fitted on a sample: of those that find enough of the
sample's neighbours, the ones that retrieve the least.

The index is a table of blocks: ids, codes and vectors of some thousand rows. A task sorts the
codes of a block by each substring and looks the probes up; it reads the vectors of a block only where they are
ranked, and they never leave it. The queries come in blocks of bounded size, one of which
is broadcast at a time. Queries that found too few neighbours are compared with all rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ranges, shipped, stored
from .vectors import matrix, sample, usable

BITS = 16                    # of a substring
PARTS = (16, 24, 32)         # numbers of substrings to choose from
BLOCK_ROWS = 1 << 15
BLOCK_BYTES = 16 << 20       # of a block's vectors
QUERY_BYTES = 32 << 20       # of a block of queries


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 20) -> np.ndarray:
    """An orthogonal matrix under which the rows of ``x`` lie close to their signs."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(rounds):
        u, _, v = np.linalg.svd(x.T @ np.where(x @ rotation >= 0, 1.0, -1.0))
        rotation = u @ v
    return rotation


@dataclass
class Code:
    """How vectors of one length are coded and searched."""

    directions: np.ndarray   # dim x bits
    parts: int               # substrings that are probed
    near: int                # bits that a probed substring may differ in; BITS: everything is retrieved
    radius: int              # bits that a code may differ in to be ranked

    def of(self, x: np.ndarray) -> np.ndarray:
        """Substrings of unit rows (n x parts, 16 bits each)."""
        signs = x @ self.directions[:, :BITS * self.parts] >= 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint16)


def differing(one: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Bits in which the rows of ``codes`` differ from the code ``one``."""
    return np.bitwise_count(codes ^ one).sum(1, dtype=np.int32)


def ball(near: int) -> np.ndarray:
    """All substrings with up to ``near`` bits."""
    return np.array([sum(1 << b for b in c) for r in range(near + 1) for c in combinations(range(BITS), r)], np.uint16)


def everything(dim: int) -> Code:
    """For a length of which too little is known: all is retrieved and ranked."""
    return Code(np.ones((dim, BITS)), 1, BITS, BITS)


def fit_codes(vectors: dict, k: int = 5, recall: float = 0.95, share: float = 0.99, queries: int = 400) -> dict:
    """A ``Code`` by dimension, fitted on a sample of unit vectors.

    Of the choices by which sampled queries retrieve ``recall`` of their ``k`` neighbours within the sample
    the one that retrieves the fewest vectors; the radius holds ``share`` of the neighbours.
    Among more vectors than the sample's neighbours are nearer, so that more of them are found.
    """
    out = {}
    for dim, x in vectors.items():
        if len(x) <= k:
            out[dim] = everything(dim)
            continue
        turns = -(-BITS * max(PARTS) // dim)
        directions = np.hstack([learn_rotation(x, s) for s in range(turns)])[:, :BITS * max(PARTS)]
        full = Code(directions, max(PARTS), 0, 0)
        codes = full.of(x)
        asked = np.arange(0, len(x), max(1, len(x) // queries))
        near = x[asked] @ x.T
        near[np.arange(len(asked)), asked] = -2
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        best = None
        for parts in PARTS:
            least = np.array([np.bitwise_count(codes[:, :parts] ^ codes[q, :parts]).min(1) for q in asked])
            found = np.take_along_axis(least, top, 1)
            for a in range(BITS):
                visited = (least <= a).mean()
                if (found <= a).mean() >= recall:
                    if best is None or visited < best[0]:
                        away = [differing(codes[q, :parts], codes[t, :parts]) for q, t in zip(asked, top)]
                        best = (visited, parts, a, int(np.quantile(np.concatenate(away), share)))
                    break
        if best is None or best[0] > 0.7:      # next to no structure, or very few vectors
            out[dim] = everything(dim)
        else:
            out[dim] = Code(directions[:, :BITS * best[1]], *best[1:])
    return out


def _blocks(load):
    """Rows of one length as index blocks: (dim, ids, codes, vectors)."""
    def run(parts):
        import pandas as pd

        def made(dim, rows):
            vectors = b"".join(v for _, v in rows)
            x = matrix([v for _, v in rows])
            return pd.DataFrame({"dim": [dim], "ids": [np.array([i for i, _ in rows], np.int64).tobytes()],
                                 "codes": [codes.get(dim, everything(dim)).of(x).tobytes()], "vectors": [vectors]})

        codes, waiting = load(), {}
        for pdf in parts:
            for dim, own in pdf.groupby("dim"):
                waiting.setdefault(int(dim), []).extend(zip(own.id, own.vector))
                limit = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * int(dim))))
                while len(waiting[int(dim)]) >= limit:
                    yield made(int(dim), waiting[int(dim)][:limit])
                    waiting[int(dim)] = waiting[int(dim)][limit:]
        for dim, rows in waiting.items():
            if rows:
                yield made(dim, rows)

    return run


class IndexBlock:
    """The rows of an index block with the directories of their substrings."""

    def __init__(self, code: Code, dim: int, ids: bytes, codes: bytes, vectors: bytes):
        self.code, self.ids = code, np.frombuffer(ids, np.int64)
        self.codes = np.frombuffer(codes, np.uint16).reshape(len(self.ids), -1)
        self.x = matrix([vectors[a:a + 8 * dim] for a in range(0, len(vectors), 8 * dim)])
        self.chosen = np.zeros(len(self.ids), bool)
        self.retrieved = self.ranked = 0
        if code.near < BITS:
            n, parts = self.codes.shape
            self.order = np.argsort(self.codes, axis=0, kind="stable").T.astype(np.int32).ravel()
            # per substring where each value begins among the sorted rows
            self.start = np.zeros((parts, (1 << BITS) + 1), np.int32)
            for j in range(parts):
                np.cumsum(np.bincount(self.codes[:, j], minlength=1 << BITS), out=self.start[j, 1:])
            self.start += (np.arange(parts) * n)[:, None]
            self.ball = ball(code.near)

    def retrieve(self, one: np.ndarray) -> np.ndarray:
        """Rows some substring of which is within reach of the query's."""
        if self.code.near >= BITS:
            return np.arange(len(self.ids))
        values = (one[:, None] ^ self.ball).astype(np.int64)
        part = np.arange(len(one))[:, None]
        begin, end = self.start[part, values].ravel(), self.start[part, values + 1].ravel()
        some = np.flatnonzero(end > begin)
        self.chosen[ranges(self.order, begin[some].astype(np.int64), (end - begin)[some].astype(np.int64))] = True
        rows = np.flatnonzero(self.chosen)
        self.chosen[rows] = False
        return rows

    def search(self, query_id: int, q: np.ndarray, one: np.ndarray, k: int, scan: bool) -> tuple:
        """(rows, scores) of the ``k`` best of what is retrieved, nearest first."""
        rows = np.arange(len(self.ids)) if scan else self.retrieve(one)
        self.retrieved += len(rows)
        if not scan and self.code.near < BITS:
            rows = rows[differing(one, self.codes[rows]) <= self.code.radius]
        rows = rows[self.ids[rows] != query_id]
        self.ranked += len(rows)
        score = np.einsum("ij,j->i", self.x[rows], q)
        if len(rows) > 4 * k:            # all that ties with the k-th stays
            least = np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[score >= least], score[score >= least]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return rows[order], score[order]


def _search(load, ask, k: int, scan: bool):
    def run(parts):
        import pandas as pd

        codes, asked = load(), ask()
        for pdf in parts:
            for dim, ids, own, vectors in zip(pdf.dim, pdf.ids, pdf.codes, pdf.vectors):
                if int(dim) not in asked:
                    continue
                code = codes.get(int(dim)) or everything(int(dim))
                block = IndexBlock(code, int(dim), ids, own, vectors)
                query_ids, q = asked[int(dim)]
                mine, out = code.of(q), []
                for i, one, x in zip(query_ids.tolist(), mine, q):
                    rows, score = block.search(i, x, one, k, scan)
                    out.append((np.full(len(rows), i), block.ids[rows], score))
                found = [np.concatenate(c) for c in zip(*out)]
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    return run


def _query_blocks(queries: DataFrame):
    """The queries (id, dim, vector), some at a time: {dim: (ids, unit rows)}."""
    size = queries.agg(F.coalesce(F.sum(F.length("vector") + 64), F.lit(0))).first()[0]
    blocks = -(-size // QUERY_BYTES)
    for b in range(blocks):
        pdf = queries.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks)) == b).toPandas()
        yield {int(d): (own.id.to_numpy(), matrix(own.vector)) for d, own in pdf.groupby("dim")}


def nearest_neighbours(vectors: DataFrame, is_query, k: int = 5, sample_rows: int = 20_000) -> DataFrame:
    """The ``k`` nearest rows found, by cosine, of every row for which the condition ``is_query`` holds.

    ``vectors`` (vec_id, embedding). Candidates are all rows but those of the query's own vec_id.
    Returns query_id, rank (from 1), vec_id, score (cosine in double precision), nearest first, ties to the smaller vec_id;
    all candidates if there are fewer than ``k``. The codes are learned on up to
    ``sample_rows`` vectors, every row is indexed. Vectors that are null, empty, zero or hold null or non-finite
    components, and rows with a null vec_id, take no part; vectors of different length are
    not compared. Of rows with one vec_id the first of their vectors (by digest) counts. Other columns are
    ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.where("vec_id is not null").select("vec_id", "embedding", is_query.alias("asks")),
                  "vec_id", "embedding", "asks").dropDuplicates(["id", "dim", "digest"])
    rows = stored(rows.withColumn("nth", F.row_number().over(
        Window.partitionBy("id").orderBy("digest"))).where("nth = 1").drop("nth"), "ann-vectors")
    load = shipped(spark, fit_codes(sample(rows, sample_rows), k))
    index = stored(rows.select("id", "dim", "vector").mapInPandas(
        _blocks(load), "dim int, ids binary, codes binary, vectors binary"), "ann-index")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def found(asked: DataFrame, scan: bool) -> DataFrame:
        out = spark.createDataFrame([], "query_id long, vec_id long, score double")
        for block in _query_blocks(asked):
            out = out.union(index.mapInPandas(_search(load, shipped(spark, block), k, scan),
                                              "query_id long, vec_id long, score double"))
        return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    queries = rows.where("asks").select("id", "dim", "vector")
    hits = stored(found(queries, False), "ann-hits")
    full = hits.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    pending = stored(queries.join(full, "id", "left_anti"), "ann-pending")
    return hits.join(full, hits.query_id == full.id, "left_semi").union(found(pending, True).select(hits.columns)) \
        .select("query_id", "rank", "vec_id", "score")
