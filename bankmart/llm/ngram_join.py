"""Exact Jaccard self-join of documents by their word shingles.

A set is a document's distinct shingles as 64-bit hashes (a clash inside one
pair of sets has a chance of about n^2 / 2^65). Equal sets are one node. Links
between different sets are found without listing all pairs:

1. *Extended prefixes.* In hash order, two sets that link share at least k of
   their first n - ceil(t n) + k shingles. Only these go to a grouping by
   shingle, packed as 4-byte fingerprints per (chunk of input, bucket); it returns
   a frequency class per shingle. A set with fewer than k shingles that other sets
   have links with nothing and is finished here.
2. *Rarest first.* Of the shared shingles of a prefix, the k - 1 most frequent
   can be left out on both sides (the rarest shingle of a link always stays).
   What remains is the inverted index; long lists of common passages are gone.
3. *Skipping by position.* Two sets meet at the first shingle that both have in their
   indexed prefixes; what a set has before it is not in the other's prefix. That it
   is not in the other set at all holds for its first shingles in hash order only
   (``_reaches``: a linked partner of a given size has them in its prefix if anywhere).
   These bound the size of a partner. Sorted by size, a list falls into blocks such
   that no set reaches beyond its block; only sets of one block meet.
4. *Answers from similar sets.* Blocks that share their first set form a cluster;
   a set is sent once to a cluster, whatever number of lists they share. Inside,
   all overlaps with one pivot are computed, which bound those of the other pairs from both sides. What
   the bounds leave open is answered set by set: a set's overlaps are those of the most similar set
   that has been answered, corrected by the lists of the shingles in which the two differ. Sets
   that are connected already are not compared. A task returns a spanning forest of its links, never all pairs.
5. *Large clusters* are cut into parts of bounded size. Each part is treated as above; then one
   set of each of the groups found goes to all parts, which connects the groups of near copies with work in
   proportion to the cluster. Only what stays outside of the largest group is compared with all (``_across``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (components, lean, mix64, ranges, shuffle_width, slices, stored, stretches, text_bytes,
                     unused, word_bounds)

_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE_VALUE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_FACTOR_INVERSE = pow(_FACTOR, -1, 2**64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SLICE_BYTES = 2 << 20          # texts hashed at a time by a task
PIECE_BYTES = 4 << 20          # of a long text hashed at a time
CHUNK_BYTES = 8 << 20          # prefixes packed together
CHUNK_SETS = 1 << 16
PART_SETS = 1024               # sets of a cluster that are compared together
PART_SHINGLES = 1 << 20
ROUNDS = 3                     # of connecting a large cluster's groups by one set of each
SENT_GROUPS = 32
CELLS = 8                      # ranges of partner sizes that are bounded one by one


def _powers(factor: int, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Shingle sets of many texts at once, from their bytes."""

    def __init__(self, words: int = 5):
        self.words, self.up, self.down = words, _powers(_FACTOR, 1), _powers(_FACTOR, 1)

    def sets(self, texts) -> list[np.ndarray]:
        """A sorted array of distinct hashes per text; null or no word: empty."""
        raw, offsets = text_bytes(texts)
        n, size = len(offsets) - 1, len(raw)
        if not size:
            return [np.zeros(0, np.uint64)] * n
        starts, words = [], []
        for a, z in stretches(raw, offsets, ~_SEPARATOR, PIECE_BYTES):     # long texts a stretch at a time
            if len(self.up) <= z - a:
                self.up, self.down = (_powers(f, z - a + 1) for f in (_FACTOR, _FACTOR_INVERSE))
            start, end = word_bounds(raw, offsets, ~_SEPARATOR, a, z)
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[_LOWER[raw[a:z]]] * self.up[:z - a], out=sums[1:])
            words.append(mix64((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64)))
            starts.append(start + a)
        word = np.concatenate(words)
        bounds = np.searchsorted(np.concatenate(starts), offsets)
        del starts, words
        k, count = self.words, len(word)
        place = np.concatenate([_PLACE_VALUE] * (k // len(_PLACE_VALUE) + 1))
        grams = np.full(max(0, count - k + 1), k, np.uint64)
        for j in range(k):
            for a in range(0, len(grams), PIECE_BYTES):
                z = min(a + PIECE_BYTES, len(grams))
                grams[a:z] += word[a + j:z + j] * place[j]
        for a in range(0, len(grams), PIECE_BYTES):
            grams[a:a + PIECE_BYTES] = mix64(grams[a:a + PIECE_BYTES])
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= k:
                out.append(_distinct(grams[a:b - k + 1]))
            elif b > a:
                whole = (word[a:b] * place[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                out.append(mix64(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, without repeats; in place, so that a long text's grams are not copied again and again."""
    values.sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def signature(tokens: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def _least_overlap(n, percent: int):
    """ceil(t n): what a set of n shares at least with any set it links with."""
    return -(-percent * n // 100)


def _guaranteed(n, percent: int):
    """k: of the extended prefix's shingles, so many are shared with any link."""
    return np.minimum(_least_overlap(n, percent), n // 20 + 12)


def _prefix(n, percent: int):
    return n - _least_overlap(n, percent) + _guaranteed(n, percent)


def _guaranteed_by_any(n, percent: int):
    """The least k of any partner's size; k grows with the size."""
    return _guaranteed(_least_overlap(n, percent), percent)


def _reaches(n: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sets of n and their partners of n to n / t, the sizes in CELLS ranges: per range the least
    overlap of a link, the largest size, and the reach.

    The j-th shingle of a set, if a linked partner of b has it, is among the partner's
    first j + b - overlap ones, so in its prefix for every j up to prefix - b + overlap:
    the reach, taken over all sizes up to the range's largest.
    """
    b = np.arange(n, max(n, 100 * n // percent) + 1)
    overlap = -(-percent * (n + b) // (100 + percent))
    reach = np.minimum.accumulate(_prefix(b, percent) - b + overlap)
    edges = np.linspace(0, len(b), CELLS + 1).astype(np.int64)
    last = np.maximum(edges[1:], 1) - 1
    return overlap[np.minimum(edges[:-1], len(b) - 1)], b[last], reach[last]


def _remembered(percent: int):
    """``_reaches`` for one task, which meets the same sizes again and again."""
    known: dict = {}

    def of(n: int):
        if n not in known:
            if len(known) >= 1 << 14:
                known.clear()
            known[n] = _reaches(n, percent)
        return known[n]

    return of


def _zones(n: int, percent: int, reaches) -> np.ndarray:
    """For each place of the prefix of a set of n: the number of ranges whose reach covers it."""
    reach = reaches(n)[2]
    return (np.arange(_prefix(n, percent))[:, None] < reach).sum(1).astype(np.uint8)


def _largest_partner(n: int, unshared: np.ndarray, reaches) -> np.ndarray:
    """Largest size of a partner by ``unshared`` (entries x CELLS), shingles of a set of n that are in
    no partner of a range; 0 if no range is possible."""
    overlap, size, _ = reaches(n)
    return np.where(n - unshared >= overlap, size, 0).max(1)


def _pack(chunk: list, buckets: int, percent: int, reaches):
    """Prefixes of one chunk's distinct sets as (bucket, fingerprints, set numbers, zones)."""
    tokens = mix64(np.concatenate([t for _, t, _ in chunk]))   # the hash order used the high bits up
    owner = np.repeat(np.arange(len(chunk), dtype=np.uint16), [len(t) for _, t, _ in chunk])
    zone = np.concatenate([_zones(n, percent, reaches) for _, _, n in chunk])
    bucket = tokens % np.uint64(buckets)
    mark = (tokens >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((owner, mark, bucket))
    bucket, mark, owner, zone = bucket[order], mark[order], owner[order], zone[order]
    ends = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for b in range(buckets):
        a, z = ends[b], ends[b + 1]
        if z > a:
            yield b, mark[a:z].tobytes(), owner[a:z].tobytes(), zone[a:z].tobytes()


_FIRST = ("kind string, doc_id long, digest long, n long, signature binary, chunk string, number int, "
          "bucket int, marks binary, owners binary, zones binary")


def _first_pass(words: int, percent: int, buckets: int):
    """Per document a row with its set's size and signature; per (chunk, bucket) the prefixes."""
    def run(batches):
        from itertools import count

        import pyarrow as pa
        from pyspark import TaskContext

        hasher, reaches = Hasher(words), _remembered(percent)
        partition, numbers = TaskContext.get().partitionId(), count()     # same names in each run
        schema = pa.schema([
            ("kind", pa.string()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()),
            ("signature", pa.binary()), ("chunk", pa.string()), ("number", pa.int32()),
            ("bucket", pa.int32()), ("marks", pa.binary()), ("owners", pa.binary()),
            ("zones", pa.binary())])

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        def fresh():
            return [], f"{partition}-{next(numbers)}", 0, set()

        def packed(chunk, name):
            rows = [("prefix", None, None, None, None, name, None, *x) 
                    for x in _pack(chunk, buckets, percent, reaches)]
            for a in range(0, len(rows), 256):
                yield made(rows[a:a + 256])

        chunk, name, size, seen = fresh()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, rows=4096):
                rows = []
                keys = zip(part.column("doc_id").to_pylist(), part.column("digest").to_pylist())
                for (doc_id, digest), tokens in zip(keys, hasher.sets(part.column("text"))):
                    mark = signature(tokens) if len(tokens) else None
                    number = None
                    if mark is not None and mark not in seen:   # copies in a chunk send one prefix
                        seen.add(mark)
                        number = len(chunk)
                        chunk.append((mark, tokens[:_prefix(len(tokens), percent)].copy(), len(tokens)))
                        size += chunk[-1][1].nbytes
                    rows.append(("doc", doc_id, digest, len(tokens), mark, name, number, None, None, None,
                                 None))
                yield made(rows)
                if size >= CHUNK_BYTES or len(chunk) > CHUNK_SETS - 4096:
                    yield from packed(chunk, name)
                    chunk, name, size, seen = fresh()
        if chunk:
            yield from packed(chunk, name)

    return run


def _own(prefixes, sets) -> list:
    """(bucket, marks, owners, zones) of a chunk without sets that another chunk stands for."""
    counted = np.zeros(CHUNK_SETS, bool)
    counted[sets.number.to_numpy(np.int64)] = True
    out = []
    for b, marks, owners, zones in zip(prefixes.bucket, prefixes.marks, prefixes.owners, prefixes.zones):
        marks, owners = np.frombuffer(marks, np.uint32), np.frombuffer(owners, np.uint16)
        keep = counted[owners]
        if keep.any():
            out.append((b, marks[keep], owners[keep], np.frombuffer(zones, np.uint8)[keep]))
    return out


def _distinct_marks(prefixes, sets):
    """One row per (bucket, chunk): its marks with their numbers of sets; a common mark travels once."""
    import pandas as pd

    rows = []
    for b, marks, _, _ in _own(prefixes, sets):
        marks, counts = np.unique(marks, return_counts=True)
        rows.append((b, prefixes.chunk.iloc[0], marks.tobytes(), counts.astype(np.uint32).tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "chunk", "marks", "counts"])


def _classify(pdf):
    """Frequency class of each mark of a bucket: 0 for one set in all, else by its logarithm."""
    import pandas as pd

    marks = [np.frombuffer(m, np.uint32) for m in pdf.marks]
    every, where = np.unique(np.concatenate(marks), return_inverse=True)
    counts = np.concatenate([np.frombuffer(c, np.uint32) for c in pdf.counts]).astype(np.int64)
    total = np.zeros(len(every), np.int64)
    np.add.at(total, where, counts)
    level = np.where(total > 1, np.clip(np.rint(6 * np.log2(np.maximum(total, 1))), 1, 255), 0)
    level = level.astype(np.uint8)[where]
    ends = np.cumsum([0, *map(len, marks)])
    return pd.DataFrame({"kind": "class", "chunk": pdf.chunk, "bucket": pdf.bucket,
                         "number": None, "n": None, "signature": None,
                         "levels": [level[a:z].tobytes() for a, z in zip(ends[:-1], ends[1:])]})


def _index(percent: int):
    """Per chunk: the sets that can have a link, with their index entries, rarest first."""
    def run(prefixes, rest):
        import pandas as pd

        names, reaches = ["signature", "n", "tokens", "most"], _remembered(percent)
        sets = rest[rest.kind == "set"]
        if not len(sets) or not len(prefixes):
            return pd.DataFrame(columns=names)
        levels = dict(zip(rest.bucket[rest.kind == "class"], rest.levels[rest.kind == "class"]))
        token, owner, level, zone = [], [], [], []
        for b, marks, owners, zones in _own(prefixes, sets):
            token.append((np.int64(b) << np.int64(32)) | marks.astype(np.int64))
            owner.append(owners)
            level.append(np.frombuffer(levels[b], np.uint8)[np.unique(marks, return_inverse=True)[1]])
            zone.append(zones)
        token, owner, level, zone = map(np.concatenate, (token, owner, level, zone))
        order = np.lexsort((token, level, owner))
        token, owner, level, zone = token[order], owner[order], level[order], zone[order]
        n, number = sets.n.to_numpy(np.int64), sets.number.to_numpy(np.int64)
        begin, end = np.searchsorted(owner, number), np.searchsorted(owner, number, side="right")
        # shingles of no other set (class 0) come first, and are in no list
        shared = np.concatenate([[0], np.cumsum(level > 0)])
        first = end - (shared[end] - shared[begin])
        kept = end - first - _guaranteed_by_any(n, percent) + 1
        rows = []
        for j, mark in enumerate(sets.signature):
            if kept[j] > 0:
                a, z = first[j], first[j] + kept[j]
                # per entry and range of sizes: the shingles before it that no partner has
                before = np.cumsum(zone[begin[j]:z, None] > np.arange(CELLS), axis=0)
                before = np.concatenate([np.zeros((1, CELLS), before.dtype), before])[a - begin[j]:-1]
                rows.append((mark, n[j], token[a:z], _largest_partner(int(n[j]), before, reaches)))
        return pd.DataFrame(rows, columns=names)

    return run


_SENT = "leader long, parts int, part int, sid long, tokens binary"


def _shingled(words: int):
    """Sets of texts whose signature is the expected one, once for every cluster they belong to."""
    def run(batches):
        import pyarrow as pa

        hasher = Hasher(words)
        schema = pa.schema([("leader", pa.int64()), ("parts", pa.int32()), ("part", pa.int32()),
                            ("sid", pa.int64()), ("tokens", pa.binary())])

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)],
                                              schema=schema)

        for batch in batches:
            for rows in slices(batch, SLICE_BYTES):
                out, size = [], 0
                for sid, mark, clusters, tokens in zip(
                        rows.column("sid").to_pylist(), rows.column("signature").to_pylist(),
                        rows.column("clusters").to_pylist(), hasher.sets(rows.column("text"))):
                    if not len(tokens) or signature(tokens) != mark:
                        continue
                    data = tokens.tobytes()
                    for c in clusters:
                        out.append((c["leader"], c["parts"], sid % c["parts"], sid, data))
                        size += len(data)
                        if size >= 4 * SLICE_BYTES:
                            yield made(out)
                            out, size = [], 0
                if out:
                    yield made(out)

    return run


class Answers:
    """Overlaps of sets of a cluster, each set's derived from those of a similar one answered before.

    A set's answers are its overlaps with all sets. Those of ``a`` are those of an answered set b,
    plus one for every set that holds a shingle which a has and b has not, minus one for every set that
    holds a shingle which b has and a has not. Only the lists of these differing shingles are read.
    """

    def __init__(self, sets: list, percent: int):
        self.percent, self.sets, m = percent, sets, len(sets)
        self.n = np.array([len(t) for t in sets], np.int64)
        _, column = np.unique(np.concatenate(sets), return_inverse=True)
        self.ends = np.append(0, np.cumsum(self.n))
        self.column = column
        order = np.argsort(column, kind="stable")
        self.holders = np.repeat(np.arange(m, dtype=np.int32), self.n)[order]
        self.first = np.append(0, np.cumsum(np.bincount(column)))
        self.rows: dict = {}
        self.closest = np.full(m, -1)            # answered set that each differs least from
        self.apart = self.n.copy()               # shingles they differ in; at first from nothing
        self.read = 0                            # entries of lists, as a measure of the work

    def own(self, a: int) -> np.ndarray:
        return self.column[self.ends[a]:self.ends[a + 1]]

    def _held(self, columns: np.ndarray) -> np.ndarray:
        begin = self.first[columns]
        size = self.first[columns + 1] - begin
        self.read += int(size.sum())
        return np.bincount(ranges(self.holders, begin, size), minlength=len(self.n))

    def of(self, a: int) -> np.ndarray:
        """Overlaps of set ``a`` with every set."""
        if a in self.rows:
            return self.rows[a]
        near, own = int(self.closest[a]), self.own(a)
        if near < 0:
            row = self._held(own)
        else:
            other = self.own(near)
            row = self.rows[near] + self._held(np.setdiff1d(own, other, assume_unique=True)) \
                - self._held(np.setdiff1d(other, own, assume_unique=True))
        self.rows[a] = row
        apart = self.n + self.n[a] - 2 * row
        closer = apart < self.apart
        self.closest[closer], self.apart[closer] = a, apart[closer]
        return row

    def linked(self, a: int) -> np.ndarray:
        """Which sets link with ``a`` (itself among them)."""
        return (100 + self.percent) * self.of(a) >= self.percent * (self.n + self.n[a])


def linked_forest(sets: list, percent: int) -> tuple[list, Answers | None]:
    """Edges of a spanning forest of the links among sorted sets.

    All overlaps with one pivot, the set of median size, bound those of the other pairs from both sides. Pairs that
    are linked by the lower bound join; of the pairs that the bounds leave open only those of sets not joined
    yet are answered, from the answers of similar sets.
    """
    m = len(sets)
    if m < 3:
        if m < 2:
            return [], None
        n = len(sets[0]) + len(sets[1])
        common = n - len(np.unique(np.concatenate(sets)))
        return ([(0, 1)] if (100 + percent) * common >= percent * n else []), None
    answers = Answers(sets, percent)
    n = answers.n
    pivot = int(np.argmin(np.abs(n - np.median(n))))
    shared = answers.of(pivot)
    total = n[:, None] + n[None]
    most = np.minimum(shared[:, None], shared) + np.minimum((n - shared)[:, None], n - shared)
    sure = (100 + percent) * (shared[:, None] + shared - n[pivot]) >= percent * total
    open_ = ((100 + percent) * most >= percent * total) & ~sure
    np.fill_diagonal(sure, False)
    np.fill_diagonal(open_, False)
    edges = _forest(sure)
    label = np.arange(m)
    for a, b in edges:
        label[label == label[b]] = label[a]
    open_ &= label[:, None] != label
    while True:
        left = np.flatnonzero(open_.any(1))
        if not len(left):
            return edges, answers
        # the cheapest to answer of those that are open
        a = int(left[np.argmin(answers.apart[left])])
        for b in np.flatnonzero(answers.linked(a)).tolist():
            if label[b] != label[a]:
                edges.append((a, b))
                label[label == label[b]] = label[a]
        open_[a] = open_[:, a] = False
        joined = np.flatnonzero(label == label[a])
        open_[np.ix_(joined, joined)] = False


def _forest(linked: np.ndarray) -> list:
    """Edges of a spanning forest of a boolean matrix."""
    edges = []
    left = np.flatnonzero(linked.any(1))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            met = linked[np.ix_(front, left)]
            found = met.any(0)
            edges += zip(front[met.argmax(0)[found]].tolist(), left[found].tolist())
            front, left = left[found], left[~found]
    return edges


def _cluster(percent: int):
    """Edges among the members of one part of a cluster."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.drop_duplicates("sid")     # rows of one doc_id and text bring a set twice
        sid = pdf.sid.to_numpy()
        edges, _ = linked_forest([np.frombuffer(t, np.uint64) for t in pdf.tokens], percent)
        edges = np.array(edges, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": sid[edges[:, 0]], "b": sid[edges[:, 1]]})

    return run


def _against(percent: int):
    """Edges between sets that are asked and the members of one part, a spanning forest of them."""
    def run(members, asked):
        import pandas as pd

        if not len(members) or not len(asked):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        both = pd.concat([asked, members])
        sid, count = both.sid.to_numpy(), len(asked)
        answers = Answers([np.frombuffer(t, np.uint64) for t in both.tokens], percent)
        label, edges = np.arange(len(sid)), []
        for a in range(count):
            for b in np.flatnonzero(answers.linked(a)).tolist():
                if label[b] != label[a]:
                    edges.append((sid[a], sid[b]))
                    label[label == label[b]] = label[a]
        edges = np.array(edges, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    return run


def _meet(members: DataFrame, asked: DataFrame, percent: int, *keys: str) -> DataFrame:
    asked = asked.toDF(*asked.columns)       # columns of its own: both sides come from one table
    return members.groupBy("leader", "part", *keys).cogroup(asked.groupBy("leader", "part", *keys)).applyInPandas(
        _against(percent), "a long, b long")


def _across(sets: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """Edges between the parts of large clusters, given those within parts.

    ``sets`` (leader, parts, part, sid, tokens). Sets that are connected already need no comparison. So
    a few rounds send one set of each of a cluster's largest groups to all of its parts, which connects the groups of a
    family of near copies; every set travels once a round. What then is outside of a cluster's largest group
    is compared with all of the cluster, in chunks.
    """
    every = sets.select("leader", "parts", "sid")
    for turn in range(ROUNDS + 1):
        labels = components(edges)
        state = stored(every.join(labels.withColumnRenamed("node", "sid"), "sid", "left").select(
            "leader", "parts", "sid", F.coalesce("component", "sid").alias("label")), "cluster-groups")
        groups = state.groupBy("leader", "parts", "label").agg(
            F.count("*").alias("n"), F.min(F.struct(F.xxhash64("sid", F.lit(turn)), "sid")).alias("one"))
        largest = Window.partitionBy("leader").orderBy(F.desc("n"), "label")
        groups = stored(groups.withColumn("nth", F.row_number().over(largest))
                        .where(F.col("nth") <= SENT_GROUPS), "cluster-heads")
        open_ = groups.where("nth = 2").select("leader")
        if open_.isEmpty():
            return edges
        if turn < ROUNDS:
            heads = groups.join(open_, "leader").select("leader", F.col("one.sid").alias("sid"))
            asked = sets.drop("part").join(heads, ["leader", "sid"]).withColumn(
                "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            edges = stored(edges.union(_meet(sets.join(open_, "leader"), asked, percent)), "cluster-edges")
    rest = state.join(groups.where("nth = 1").select("leader", F.col("label").alias("top")), "leader") \
        .where("label != top").select("leader", "sid")
    chunks = rest.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(PART_SETS)).cast("int").alias("chunks"))
    asked = sets.drop("part").join(rest, ["leader", "sid"]).join(chunks, "leader").withColumn(
        "chunk", F.pmod(F.xxhash64("sid", F.lit(5)), F.col("chunks")).cast("int")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = sets.join(chunks, "leader").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return stored(edges.union(_meet(met, asked, percent, "chunk")), "cluster-edges")


def _clusters(index: DataFrame, percent: int) -> DataFrame:
    """Per set the clusters it belongs to: (sid, [(leader, parts)])."""
    entries = index.select("sid", "n", F.posexplode(F.arrays_zip("tokens", "most")).alias("i", "at")).select(
        F.col("at.tokens").alias("token"), "sid", "n", F.col("at.most").alias("most"))
    by_size = Window.partitionBy("token").orderBy("n", "sid")
    begins = F.col("n") > F.coalesce(F.max(F.greatest("most", "n")).over(
        by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = entries.withColumn("begins", begins.cast("long")) \
        .withColumn("block", F.sum("begins").over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
    heads = blocks.groupBy("token", "block").agg(F.min("sid").alias("leader"), F.count("*").alias("sets")) \
        .where("sets > 1").select("token", "block", "leader")
    members = stored(blocks.join(heads, ["token", "block"]).select("leader", "sid", "n").distinct(), "members")
    parts = members.groupBy("leader").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(PART_SETS)), F.ceil(F.sum("n") / F.lit(PART_SHINGLES))).cast("int").alias("parts"))
    return members.join(parts, "leader").groupBy("sid").agg(
        F.collect_list(F.struct("leader", "parts")).alias("clusters"))     # up to an entry each


def ngram_jaccard_join(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``percent`` % or more.

    Returns one row per row of ``documents`` (doc_id, text): doc_id, n_shingles
    (size of its set), component_id (the smallest doc_id reachable by links), group (names the
    component), signature (of its set, null if empty as is group), digest (of its text). A-Z are lower-cased, words are runs
    of characters other than space and \\t-\\r; a text with fewer words than a
    shingle is one shingle. A null, empty or wordless text has the empty set and links
    with nothing (component_id = doc_id). Repeated rows and repeated ids are kept as they are;
    a row with a null doc_id takes part, and has a null component_id if all ids
    it reaches are null. Other columns are ignored. Similarities from 50 % up.
    """
    if not 50 <= percent <= 100 or not 1 <= words <= 64:
        raise ValueError("percent must be 50 to 100, words 1 to 64")
    spark = documents.sparkSession
    buckets = 4 * shuffle_width(spark)
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .withColumn("digest", F.xxhash64("text"))
    first = stored(documents.mapInArrow(lean(_first_pass(words, percent, buckets)), _FIRST), "shingles",
                   ("kind",))
    docs = first.where("kind = 'doc'").select("doc_id", "digest", "n", "signature", "chunk", "number")
    prefixes = first.where("kind = 'prefix'").select("chunk", "bucket", "marks", "owners", "zones")
    rest = "kind string, chunk string, bucket int, number int, n long, signature binary, levels binary"
    own = docs.where("number is not null").groupBy("signature").agg(
        F.min(F.struct("chunk", "number")).alias("at"), F.first("n").alias("n"))
    own = stored(own.select("signature", "n", "at.chunk", "at.number"), "own")   # one chunk stands for a set
    by_chunk = prefixes.groupBy("chunk")
    classes = by_chunk.cogroup(own.groupBy("chunk")).applyInPandas(
        _distinct_marks, "bucket int, chunk string, marks binary, counts binary") \
        .groupBy("bucket").applyInPandas(_classify, rest)
    numbered = own.select(
        F.lit("set").alias("kind"), "chunk", F.lit(None).cast("int").alias("bucket"), "number", "n",
        "signature", F.lit(None).cast("binary").alias("levels"))
    index = by_chunk.cogroup(classes.union(numbered).groupBy("chunk")).applyInPandas(
        _index(percent), "signature binary, n long, tokens array<long>, most array<long>")
    index = stored(index.withColumn("sid", F.monotonically_increasing_id()), "index")

    known = stored(index.select("sid", "signature").join(_clusters(index, percent), "sid"), "clusters")

    def sets(known: DataFrame) -> DataFrame:
        chosen = docs.join(known, "signature").groupBy("sid", "signature").agg(
            F.min("doc_id").alias("id"), F.first("clusters").alias("clusters"))
        # one plan whatever the number of sets: both sides are shuffled by the id
        texts = documents.join(chosen.hint("merge"), documents.doc_id.eqNullSafe(chosen.id))
        return texts.select("text", "sid", "signature", "clusters").mapInArrow(lean(_shingled(words)), _SENT)

    edges = sets(known).groupBy("leader", "part").applyInPandas(_cluster(percent), "a long, b long")
    large = known.withColumn("clusters", F.filter("clusters", lambda c: c.parts > 1)).where("size(clusters) > 0")
    if not large.isEmpty():
        edges = _across(stored(sets(large).dropDuplicates(["leader", "sid"]), "large-clusters"),
                        stored(edges, "part-edges"), percent)
    groups = index.select("sid", "signature").join(
        components(edges).withColumnRenamed("node", "sid"), "sid", "left") \
        .select("signature", F.coalesce("component", "sid").alias("found"))
    # a set that no candidate met is a group by itself: its signature names it
    sets_of = docs.select("doc_id", "digest", "n", "signature").join(groups, "signature", "left").withColumn(
        "group", F.coalesce(F.col("found").cast("string"), F.hex("signature"))).drop("found")
    least = sets_of.where("signature is not null").groupBy("group").agg(F.min("doc_id").alias("least_id"))
    return sets_of.join(least, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.expr("if(signature is null, doc_id, least_id)").alias("component_id"),
        "group", "signature", "digest")


def one_of_each_group(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of every group of linked documents, that of the smallest doc_id.

    Documents without a word are no copies of each other and all stay. Rows of
    one doc_id and text are one document.
    """
    found = ngram_jaccard_join(documents, words, percent).where("doc_id <=> component_id")
    kept = found.where("signature is not null").dropDuplicates(["group"]) \
        .union(found.where("signature is null")).select("doc_id", "digest").distinct().alias("k")
    (digest,) = unused(documents, "digest")
    rows = documents.withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest]).alias("d")
    return rows.join(kept, F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))
                     & (F.col(f"d.`{digest}`") == F.col("k.digest"))) \
        .select(*[F.col(f"d.`{c}`") for c in documents.columns])
