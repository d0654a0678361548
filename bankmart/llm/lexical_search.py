"""Ranked lexical search: MaxScore with bounds on pairs of terms.

1. *Index.* Documents are packed in blocks; a block holds the postings of its texts
   (term hash, document, frequency), sorted by term. Blocks are rows of a table.
2. *Impacts.* For the terms that a block of queries asks, document frequencies are summed over
   all index blocks; then each index block gets its lists of impacts, with the largest of each
   list, and for pairs of an item's terms the intersection list with the largest joint impact.
3. *Search.* An item's bound of a block is the sum over its pairs of what a document can
   gain from both terms together, which is less than the sum of the two maxima. If it is below
   the item's threshold, the block is skipped. Else lists become candidates until the bound of what is
   left is below the threshold: the intersection list of a pair alone lowers its bound to the
   larger of the two maxima, both lists lower it to nothing; what lowers the bound most per
   entry goes first. Only candidates are scored, and they drop out as soon as the bounds of the pairs to come
   cannot lift them over the threshold.

Thresholds start from a first search in a part of the blocks. They only skip what cannot be
among the best, so that results are exact. The queries are cut in blocks of bounded size,
one of which is broadcast at a time; no posting list ever is in one task as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, shipped, slices, stored, stretches, text_bytes, word_bounds

# Fixed values of the contract's score.
FLAT, SLOPE, UNIT = 10, 90, 1_000_000_000     # m = 100 - 90 + (90 n N) div L
_TERM = np.zeros(256, bool)                   # letters and digits of ASCII, bytes of other characters
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = np.random.default_rng(20250110).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0xA0761D6478BD642F
_FACTOR_INVERSE = pow(_FACTOR, -1, 2**64)

PIECE_BYTES = 1 << 20          # of a text hashed at a time
BLOCK_BYTES = 8 << 20          # texts of an index block; one longer text is a block
BLOCK_ROWS = 1 << 16
MERGE_POSTINGS = 1 << 21
ASKED_ROWS = 200_000           # (item, term) rows of a block of queries
SEED_SHARE = 16                # one of so many blocks gives the first thresholds


class Terms:
    """Hashes of the terms of texts, a bounded stretch of bytes at a time."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, size: int) -> None:
        if len(self.up) <= size:
            for name, factor in (("up", _FACTOR), ("down", _FACTOR_INVERSE)):
                powers = np.full(size + 1, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def of(self, texts):
        """Yield (number of the text, hash) of all terms, stretch by stretch, in order of the texts."""
        raw, offsets = text_bytes(texts)
        for a, z in stretches(raw, offsets, _TERM, PIECE_BYTES):
            self._powers(z - a)
            start, end = word_bounds(raw, offsets, _TERM, a, z)
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[_LOWER[raw[a:z]]] * self.up[:z - a], out=sums[1:])
            marks = mix64((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
            yield np.searchsorted(offsets, start + a, side="right") - 1, marks


def _merged(parts: list) -> list:
    """Postings (document, term, frequency) as one triple sorted by term, then document."""
    who, term, tf = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(term, kind="stable")      # documents already rise
    who, term, tf = who[order], term[order], tf[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (who[1:] != who[:-1])
    first = np.flatnonzero(new)
    return [(who[first], term[first], np.add.reduceat(tf, first) if len(first) else tf)]


def _indexed(batches):
    import pyarrow as pa

    terms = Terms()
    names = ["ids", "lengths", "terms", "starts", "who", "tf"]

    def row(ids, lengths, parts):
        who, term, tf = _merged(parts)[0]
        distinct, first = np.unique(term, return_index=True)
        starts = np.append(first, len(term)).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in (
                np.concatenate(lengths), distinct, starts, who.astype(np.uint16), tf.astype(np.int32)))], names)

    def fresh():
        return [], [], [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0

    ids, lengths, parts, size = fresh()
    for batch in batches:
        for some in slices(batch, BLOCK_BYTES // 8, rows=1 << 13):
            before, count = len(ids), np.zeros(some.num_rows, np.int64)
            ids += some.column("doc_id").to_pylist()
            for who, marks in terms.of(some.column("text")):
                count += np.bincount(who, minlength=len(count))
                parts.append((who + before, marks, np.ones(len(marks), np.int64)))
                if sum(len(p[0]) for p in parts[1:]) > MERGE_POSTINGS:
                    parts = _merged(parts)
            lengths.append(count)
            size += some.column("text").nbytes
            if size >= BLOCK_BYTES or len(ids) > BLOCK_ROWS - (1 << 13):
                yield row(ids, lengths, parts)
                ids, lengths, parts, size = fresh()
    if ids:
        yield row(ids, lengths, parts)


def index_documents(documents: DataFrame) -> DataFrame:
    """The block index of ``documents`` (doc_id, text), stored in the shared folder."""
    return stored(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _indexed, "ids array<long>, lengths binary, terms binary, starts binary, who binary, tf binary"),
        "lexical-index")


def _asked(batches):
    import pyarrow as pa

    terms = Terms()
    for batch in batches:
        for some in slices(batch, PIECE_BYTES):
            for who, marks in terms.of(some.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [some.column("item_id").take(pa.array(who)), pa.array(marks.view(np.int64))],
                    ["item_id", "term"])


@dataclass
class QueryBlock:
    """Items with their terms as pairs, over a common vocabulary."""

    ids: list                # item ids
    vocabulary: np.ndarray   # sorted hashes
    weights: np.ndarray      # of the vocabulary
    pairs: np.ndarray        # distinct pairs of places in the vocabulary; a term alone is paired with -1
    own: list                # by item: numbers of its pairs
    documents: int           # N
    tokens: int              # L
    best: int                # how many documents an item gets

    @classmethod
    def of(cls, rows, documents: int, tokens: int, best: int) -> QueryBlock:
        named = rows.item_id.isna().to_numpy()
        values = rows.item_id.fillna(0).to_numpy(np.int64)
        vocabulary, place = np.unique(rows.term.to_numpy(np.int64).view(np.uint64), return_inverse=True)
        order = np.lexsort((place, values, named))
        values, named, place = values[order], named[order], place[order]
        new = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (named[1:] != named[:-1]))) \
            if len(values) else np.zeros(0, np.int64)
        block = cls([None if named[a] else int(values[a]) for a in new], vocabulary,
                    np.zeros(len(vocabulary), np.int64), np.zeros((0, 2), np.int64), [], documents, tokens, best)
        block.own = np.split(place, new[1:]) if len(new) else []
        return block

    def weigh(self, frequency: np.ndarray) -> None:
        """Weights from the document frequencies, then pairs of terms next to each other by weight."""
        found = frequency > 0
        ratio = (2.0 * self.documents + 2) / (2.0 * frequency + 1)
        self.weights = np.where(found, np.floor(1000 * np.log(ratio)), 0).astype(np.int64)
        pairs, numbers = {}, []
        for places in self.own:
            places = places[self.weights[places] > 0]
            places = places[np.lexsort((places, self.weights[places]))].tolist()
            couples = list(zip(places[0::2], places[1::2] + [-1] * (len(places) % 2)))
            numbers.append(np.array([pairs.setdefault(c, len(pairs)) for c in couples], np.int64))
        self.pairs, self.own = np.array(list(pairs), np.int64).reshape(-1, 2), numbers


def _frequencies(index: DataFrame, block: QueryBlock) -> np.ndarray:
    """Documents of the index that hold each term of the vocabulary."""
    vocabulary = shipped(index.sparkSession, block.vocabulary)

    def run(batches):
        import pyarrow as pa

        asked = vocabulary()
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column("terms").to_pylist(), batch.column("starts").to_pylist()):
                place, here = _places(np.frombuffer(terms, np.uint64), asked)
                total[here] += np.diff(np.frombuffer(starts, np.int32))[place[here]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])

    out = np.zeros(len(block.vocabulary), np.int64)
    for place, n in index.select("terms", "starts").mapInArrow(run, "place long, n long") \
            .groupBy("place").agg(F.sum("n")).collect():
        out[place] = n
    return out


def _places(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted term, and which ones are there."""
    if not len(terms):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return place, terms[place] == wanted


_IMPACTS = ("ids array<long>, term binary, start binary, who binary, gain binary, most binary, "
            "pair binary, pair_start binary, pair_who binary, pair_most binary")


def _with_impacts(load):
    """Per index block the impact lists of the asked terms and the intersection lists of their pairs."""
    def run(batches):
        import pyarrow as pa

        asked = load()
        for batch in batches:
            for b in range(batch.num_rows):
                lengths, starts = (np.frombuffer(batch.column(c)[b].as_py(), t) for c, t in (
                    ("lengths", np.int64), ("starts", np.int32)))
                place, here = _places(np.frombuffer(batch.column("terms")[b].as_py(), np.uint64), asked.vocabulary)
                here &= asked.weights > 0
                who, tf = (np.frombuffer(batch.column(c)[b].as_py(), t) for c, t in (
                    ("who", np.uint16), ("tf", np.int32)))
                m = FLAT + SLOPE * lengths * asked.documents // max(asked.tokens, 1)
                term = np.flatnonzero(here)
                lists, gains, most, at = [], [], [], np.full(len(asked.vocabulary) + 1, -1)
                for j, t in enumerate(term.tolist()):
                    a, z = starts[place[t]], starts[place[t] + 1]
                    own, often = who[a:z], tf[a:z].astype(np.int64)
                    lists.append(own)
                    gains.append((UNIT * often // (1000 * often + 8 * m[own])).astype(np.int32))
                    most.append(int(asked.weights[t]) * int(gains[-1].max()))
                    at[t] = j
                pair, met, joint = [], [], []
                first, second = at[asked.pairs[:, 0]], at[asked.pairs[:, 1]]
                dense = np.zeros(len(lengths), np.int64)
                for p in np.flatnonzero((first >= 0) & (second >= 0)).tolist():
                    x, y = first[p], second[p]
                    dense[lists[x]] = gains[x]
                    both = dense[lists[y]]
                    dense[lists[x]] = 0
                    some = both > 0
                    if some.any():
                        pair.append(p)
                        met.append(lists[y][some])
                        joint.append(int((asked.weights[term[x]] * both[some]
                                          + asked.weights[term[y]] * gains[y][some].astype(np.int64)).max()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(b, 1)] + [pa.array([x.tobytes()], pa.binary()) for x in (
                        term.astype(np.int32), _ends(lists), _joined(lists, np.uint16), _joined(gains, np.int32),
                        np.array(most, np.int64), np.array(pair, np.int32), _ends(met), _joined(met, np.uint16),
                        np.array(joint, np.int64))],
                    ["ids", "term", "start", "who", "gain", "most", "pair", "pair_start", "pair_who", "pair_most"])

    return run


def _ends(lists: list) -> np.ndarray:
    return np.cumsum([0, *map(len, lists)], dtype=np.int64)


def _joined(lists: list, kind) -> np.ndarray:
    return np.concatenate(lists).astype(kind) if lists else np.zeros(0, kind)


class ImpactBlock:
    """One index block as the search reads it."""

    def __init__(self, batch, b: int, asked: QueryBlock):
        def column(name, kind):
            return np.frombuffer(batch.column(name)[b].as_py(), kind)

        self.ids = batch.column("ids")[b].values
        term, self.start = column("term", np.int32), column("start", np.int64)
        self.who, self.gain = column("who", np.uint16), column("gain", np.int32)
        pair, self.pair_start = column("pair", np.int32), column("pair_start", np.int64)
        self.pair_who = column("pair_who", np.uint16)
        n, width = len(asked.pairs), len(asked.vocabulary) + 1
        at = np.full(width, -1)
        at[term] = np.arange(len(term))
        most, size, weight = (np.zeros(width, np.int64) for _ in range(3))
        most[term], size[term], weight[:-1] = column("most", np.int64), np.diff(self.start), asked.weights
        self.at, self.weight = at[asked.pairs], weight[asked.pairs]
        self.single = most[asked.pairs].max(1, initial=0)       # either term without the other
        self.entries = size[asked.pairs].sum(1)
        self.pair_at, joint, self.met = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.pair_at[pair], joint[pair], self.met[pair] = np.arange(len(pair)), column("pair_most", np.int64), \
            np.diff(self.pair_start)
        self.bound = np.maximum(joint, self.single)             # the pair as a whole
        self.score = np.zeros(len(self.ids), np.int64)
        self.chosen = np.zeros(len(self.ids), bool)
        self.scored = 0

    def _add(self, p: int, some: np.ndarray | None) -> None:
        """Add the impacts of a pair's terms to the scores, of all documents or of ``some``."""
        for at, weight in zip(self.at[p].tolist(), self.weight[p].tolist()):
            if at < 0:
                continue
            a, z = self.start[at], self.start[at + 1]
            who, gain = self.who[a:z], self.gain[a:z]
            if some is not None:
                place = np.minimum(np.searchsorted(who, some), len(who) - 1)
                here = who[place] == some
                who, gain = some[here], gain[place[here]]
            self.score[who] += weight * gain.astype(np.int64)

    def search(self, pairs: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents that score ``threshold`` (1 at least) or more."""
        none = np.zeros(0, np.int64)
        pairs = pairs[self.entries[pairs] > 0]
        bound = self.bound[pairs]
        total = int(bound.sum())
        if total < threshold:
            return none, none
        # what to make candidates: intersections, then whole lists, by the fall of the bound per entry
        single = self.single[pairs]
        fall = np.concatenate([bound - single, single])
        cost = np.concatenate([self.met[pairs], self.entries[pairs]])
        order = np.argsort(-fall / (cost + 1.0), kind="stable")
        left = total - np.cumsum(fall[order])
        taken = order[:int(np.argmax(left < threshold)) + 1]
        whole = taken[taken >= len(pairs)] - len(pairs)
        for j in taken[taken < len(pairs)].tolist():
            at = self.pair_at[pairs[j]]
            if at >= 0:
                self.chosen[self.pair_who[self.pair_start[at]:self.pair_start[at + 1]]] = True
        for j in whole.tolist():
            self._add(pairs[j], None)
            for at in self.at[pairs[j]].tolist():
                if at >= 0:
                    self.chosen[self.who[self.start[at]:self.start[at + 1]]] = True
        some = np.flatnonzero(self.chosen)
        self.chosen[some] = False
        self.scored += len(some)
        rest = np.setdiff1d(np.arange(len(pairs)), whole)
        rest = rest[np.argsort(-bound[rest], kind="stable")]
        ahead = int(bound[rest].sum())
        for j in rest.tolist():
            some = some[self.score[some] + ahead >= threshold]
            if not len(some):
                break
            self._add(pairs[j], some)
            ahead -= int(bound[j])
        some = some[self.score[some] >= threshold]
        found = self.score[some].copy()
        self.score[:] = 0
        return some, found


def _search(load, seeds):
    """The best documents of every item within a task's blocks."""
    def run(batches):
        import pyarrow as pa

        asked, threshold = load(), seeds().copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in asked.ids]
        for batch in batches:
            for b in range(batch.num_rows):
                block = ImpactBlock(batch, b, asked)
                ids = block.ids.fill_null(0).to_numpy()
                unnamed = block.ids.is_null().to_numpy(zero_copy_only=False)
                for i, pairs in enumerate(asked.own):
                    some, score = block.search(pairs, max(1, int(threshold[i])))
                    if len(some):
                        own = tuple(np.concatenate(x) for x in zip(best[i], (ids[some], unnamed[some], score)))
                        order = np.lexsort((own[0], own[1], -own[2]))[:asked.best]
                        best[i] = tuple(x[order] for x in own)
                        if len(order) == asked.best:
                            threshold[i] = max(threshold[i], best[i][2][-1])
        for i, (doc, unnamed, score) in enumerate(best):
            if len(doc):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([asked.ids[i]] * len(doc), pa.int64()), pa.array(doc, pa.int64(), mask=unnamed),
                     pa.array(score)], ["item_id", "doc_id", "score"])

    return run


def ranked_search(documents: DataFrame, items: DataFrame, best: int = 10) -> DataFrame:
    """The ``best`` documents of ``documents`` (doc_id, text) for each of ``items`` (item_id, text).

    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. Returns item_id,
    rank (from 1), doc_id, score (whole number, above 0), by falling score, ties by ascending doc_id (a null
    one last). Every row of ``documents`` is a document, also those that repeat another or its id; a
    null or empty text has no terms. Rows of one item_id are one item with the terms of all
    its texts; a null item_id is an item as well. Items that no document matches, and all if a table is empty,
    have no rows. Terms are known by 64-bit hashes. Counts up to 90 n N < 2^63 (n terms of one document,
    N documents). Other columns are ignored.
    """
    spark = documents.sparkSession
    index = index_documents(documents)
    asked = stored(items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
                   .mapInArrow(_asked, "item_id long, term long").distinct(), "lexical-items")

    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            for data in batch.column("lengths").to_pylist():
                n = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])], ["documents", "tokens"])

    n, tokens = index.select("lengths").mapInArrow(counted, "documents long, tokens long").agg(
        F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    blocks = -(-asked.count() // ASKED_ROWS)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for b in range(blocks):
        block = QueryBlock.of(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toPandas(),
                              n, tokens, best)
        block.weigh(_frequencies(index, block))
        load = shipped(spark, block)
        impacts = stored(index.mapInArrow(_with_impacts(load), _IMPACTS), "lexical-impacts")

        def found(blocks, thresholds):
            hits = blocks.mapInArrow(_search(load, shipped(spark, thresholds)),
                                     "item_id long, doc_id long, score long")
            return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)

        some = impacts.where(F.pmod(F.xxhash64(F.col("ids")[0], F.size("ids")), F.lit(SEED_SHARE)) == 0)
        number = {item: i for i, item in enumerate(block.ids)}
        thresholds = np.zeros(len(block.ids), np.int64)
        for item, score in found(some, thresholds).where(F.col("rank") == best).select("item_id", "score").collect():
            thresholds[number[item]] = score
        out = out.union(found(impacts, thresholds).select("item_id", "rank", "doc_id", "score"))
    return out
