"""Language identification by character language models.

Per language an interpolated Kneser-Ney model of characters, of order 4. Grams
are four code units of 16 bits in one integer (letters in lower case, any
other character a space, runs of spaces one); characters beyond the
basic plane fold into its private area. The models are sorted arrays of hashed grams: for
every gram that any language knows, the logarithm of its full interpolated
probability in each; for every context, the logarithm of the weight that is
left for shorter grams. A text takes the language of the least cross-entropy
per character; a calibrated limit per language says when even that is too much.

The gram counts cover every document that may be learned from, and every gram stays in the
model; Spark adds up the counts of all orders, of which the discounts are taken. The
arrays are cut into blocks by the character before a gram's last one: a gram, all its
shorter grams of two characters or more and all their contexts have it in common, so
that a block alone gives the probability. More grams make more blocks; a task holds one at a time.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SortedHashes, mix64, shipped, slices, stored

ORDER = 4
SLICE_BYTES = 1 << 20
GROUP_BYTES = 8 << 20          # texts that meet one block after the other
BLOCK_VALUES = 1 << 22         # probabilities (grams x languages) of a block
ENTROPY_BINS = 1024            # a unit of cross-entropy, that the rejection limits are looked for in
UNDETERMINED = "und"


def _unit_table() -> np.ndarray:
    """Code unit of each character of the basic plane: itself in lower case if a letter, else a space."""
    out = np.full(1 << 16, 32, np.uint16)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


class Units:
    """Code units of many texts at once."""

    def __init__(self):
        self.table = _unit_table()

    def of(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(units of all texts, the n + 1 places of the borders, a space each, around them)."""
        joined = "\x00".join(["", *((t or "").replace("\x00", " ") for t in texts), ""])
        cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        units = self.table[np.minimum(cps, 0xFFFF)]
        far = np.flatnonzero(cps > 0xFFFF)
        if len(far):
            kinds, where = np.unique(cps[far], return_inverse=True)
            units[far] = np.array([0xE000 + c % 0x1900 if chr(c).isalpha() else 32
                                   for c in kinds.tolist()], np.uint16)[where]
        border = cps == 0
        space = units == 32
        keep = np.ones(len(units), bool)
        keep[1:] = ~(space[1:] & space[:-1]) | border[1:]
        return units[keep], np.flatnonzero(border[keep])


def grams(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every unit of the texts with the three before it (spaces before a text's first), and the
    n + 1 offsets of the texts' grams."""
    u = units[:offsets[-1]].astype(np.uint64)
    reach = np.arange(len(u)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = u.copy()
    for j in range(1, ORDER):
        prev = np.full(len(u), 32, np.uint64)
        prev[j:] = u[:-j]
        out |= np.where(reach >= j, prev, np.uint64(32)) << np.uint64(16 * j)
    return out[reach > 0], offsets - np.arange(len(offsets))


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1)


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value in the sorted ``keys``, -1 where it is missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _hashed(grams_: np.ndarray, order: int) -> np.ndarray:
    return mix64(grams_ + np.uint64((order * 0x9E3779B97F4A7C15) % 2**64))


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5


class _Counts:
    """Discounted counts of one language: per order the grams, their contexts' totals and weights.

    For a block of the grams, ``discounts`` (by order) and ``single`` (the grams of order 1) are those of all.
    """

    def __init__(self, gram: np.ndarray, count: np.ndarray, discounts: dict | None = None,
                 single: tuple[np.ndarray, np.ndarray] | None = None):
        self.levels = {}
        for order in range(ORDER, 0, -1):
            if order == 1 and single is not None:
                gram, count = single
            order_by = np.argsort(gram)
            gram, count = gram[order_by], count[order_by]
            discount = discounts[order] if discounts else _discount((count == 1).sum(), (count == 2).sum())
            context = gram >> np.uint64(16)
            names, where = np.unique(context, return_inverse=True)
            total = np.bincount(where, count, len(names))
            kinds = np.bincount(where, minlength=len(names))
            self.levels[order] = (gram, count, discount, names, total, discount * kinds / total)
            # a shorter gram counts the different characters that it follows
            gram, count = np.unique(gram & _mask(order - 1), return_counts=True)
            count = count.astype(float)

    def probability(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        if order == 0:
            return np.full(len(gram), 1 / 65536)
        lower = self.probability(gram & _mask(order - 1), order - 1)
        own, count, discount, names, total, left = self.levels[order]
        if not len(own):
            return lower
        c = _lookup(names, gram >> np.uint64(16))
        g = _lookup(own, gram)
        seen = np.where(g >= 0, np.maximum(count[g] - discount, 0), 0) / np.where(c >= 0, total[c], 1)
        return np.where(c >= 0, seen + left[c] * lower, lower)


@dataclass
class Block:
    languages: list
    grams: dict              # order -> (sorted hashes, log probabilities by language)
    contexts: dict           # order -> (sorted hashes, log weights of shorter grams by language)

    def log_probability(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(grams x languages)."""
        if order == 0:
            return np.full((len(gram), len(self.languages)), -np.log(65536), np.float32)
        keys, values = self.grams[order]
        at = keys.find(_hashed(gram, order))
        out = values[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            keys, left = self.contexts[order]
            c = keys.find(_hashed(gram[miss] >> np.uint64(16), order))
            out[miss] = self.log_probability(gram[miss] & _mask(order - 1), order - 1) \
                + np.where((c >= 0)[:, None], left[c], 0)
        return out


@dataclass
class LanguageModel:
    languages: list
    block_of: np.ndarray     # block of each code unit that comes before a gram's last
    parts: list              # the arrays of each block, broadcast
    limits: np.ndarray       # cross-entropy beyond which a language rejects a text

    def block(self, number: int) -> Block:
        part = self.parts[number]
        # only a single block is kept in memory after its use
        arrays = part.value if len(self.parts) == 1 else part.load_from_path(part._path)
        grams, contexts = ({order: (SortedHashes(h), v) for order, (h, v) in x.items()} for x in arrays)
        return Block(self.languages, grams, contexts)

    def blocks(self):
        if len(self.parts) == 1:
            if not hasattr(self, "_only"):
                self._only = self.block(0)
            yield self._only
        else:
            yield from map(self.block, range(len(self.parts)))

    def budget(self) -> int:
        """Bytes of texts to score at a time."""
        return SLICE_BYTES if len(self.parts) <= 1 else GROUP_BYTES

    def cross_entropy(self, units: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts x languages): mean negative log probability of a character."""
        gram, ends = grams(units, offsets)
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        owner = np.repeat(np.arange(len(out)), np.diff(ends))
        where = self.block_of[(gram >> np.uint64(16)).astype(np.int64) & 0xFFFF]
        for number, block in enumerate(self.blocks()):
            own = np.flatnonzero(where == number)
            for a in range(0, len(own), SLICE_BYTES):
                some = own[a:a + SLICE_BYTES]
                texts, begin = np.unique(owner[some], return_index=True)
                out[texts] -= np.add.reduceat(block.log_probability(gram[some]), begin, axis=0, dtype=np.float64)
        return out / np.maximum(np.diff(ends), 1)[:, None]

    def predict(self, texts: list, reader: Units) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, confidence (0 to 1) and rejection of each text."""
        units, offsets = reader.of(texts)
        inner = np.diff(offsets) > 1          # more than its border: some letter
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy = self.cross_entropy(units, offsets)
        best = entropy.argmin(1)
        least = entropy[np.arange(len(best)), best]
        score = 1 / np.exp((least[:, None] - entropy) * 10).sum(1)
        named = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, inner)]
        return named, np.where(inner, score, 0.0), ~inner | (least > self.limits[best])


def build(languages: list, tables: list[tuple[np.ndarray, np.ndarray]], discounts: list | None = None,
          singles: list | None = None) -> Block:
    """The joint sorted arrays of one (4-gram, count) table per language."""
    none = [None] * len(tables)
    models = [_Counts(g.astype(np.uint64), c.astype(float), d, x)
              for (g, c), d, x in zip(tables, discounts or none, singles or none)]
    known, contexts = {}, {}
    for order in range(1, ORDER + 1):
        every = np.unique(np.concatenate([m.levels[order][0] for m in models] or [np.zeros(0, np.uint64)]))
        names = np.unique(np.concatenate([m.levels[order][3] for m in models] or [np.zeros(0, np.uint64)]))
        value = np.stack([np.log(m.probability(every, order)) for m in models], 1) if models else every
        left = np.stack([np.where((c := _lookup(m.levels[order][3], names)) >= 0,
                                  np.log(np.append(m.levels[order][5], 1.0)[c]), 0) for m in models], 1) \
            if models else names
        for out, keys, values in ((known, every, value), (contexts, names, left)):
            h = _hashed(keys, order)
            by = np.argsort(h)
            out[order] = (SortedHashes(h[by]), values[by].astype(np.float32))
    return Block(list(languages), known, contexts)


def _counted(batches):
    import pyarrow as pa

    reader = Units()
    for batch in batches:
        for part in slices(batch, 4 * SLICE_BYTES):
            units, offsets = reader.of(part.column("text").to_pylist())
            gram, ends = grams(units, offsets)
            lang = part.column("lang").to_pylist()
            names = sorted(set(lang))
            number = np.repeat([names.index(x) for x in lang], np.diff(ends))
            for j, name in enumerate(names):
                key, count = np.unique(gram[number == j], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(key), pa.string()), pa.array(key.view(np.int64)),
                     pa.array(count, pa.int64())], ["lang", "gram", "n"])


def _built(names: list, discounts: list, singles: list):
    """The arrays of one block, from its (lang, gram, n)."""
    def run(pdf):
        import pandas as pd

        tables = [(own.gram.to_numpy(np.int64).astype(np.uint64), own.n.to_numpy(np.int64))
                  for own in (pdf[pdf.lang == x] for x in names)]
        block = build(names, tables, discounts, singles)
        rows = [(pdf.block.iloc[0], kind, order, keys.keys[:-1].tobytes(), values.tobytes())
                for kind, arrays in enumerate((block.grams, block.contexts))
                for order, (keys, values) in arrays.items()]
        return pd.DataFrame(rows, columns=["block", "kind", "order", "keys", "values"])

    return run


def _in_tasks(spark, model: LanguageModel):
    """Gives what loads ``model`` in a task; the blocks are broadcast by themselves."""
    parts, load = model.parts, shipped(spark, replace(model, parts=[]))
    return lambda: replace(load(), parts=parts)


def _blocks(sizes, languages: int, block_values: int) -> tuple[np.ndarray, int]:
    """Block of each code unit, the largest first to the emptiest, and the number of blocks."""
    count = max(1, -(-int(sizes.n.sum()) * languages // block_values))
    block_of, loads = np.zeros(1 << 16, np.int32), [(0, b) for b in range(count)]
    for unit, n in sorted(zip(sizes.unit.tolist(), sizes.n.tolist()), key=lambda x: (-x[1], x[0])):
        load, b = heapq.heappop(loads)
        block_of[unit] = b
        heapq.heappush(loads, (load + n, b))
    return block_of, count


def _limits(entropies: DataFrame, quantile: float) -> dict:
    """The exact ``quantile`` (between two values in proportion) of all rows of ``entropies`` (lang, entropy), by language.

    Counts in ENTROPY_BINS a unit say which one or two bins hold it; only the values of these are put in order.
    """
    entropies = entropies.withColumn("bin", F.floor(F.col("entropy") * ENTROPY_BINS))
    of_lang, of_bin = Window.partitionBy("lang"), Window.partitionBy("lang", "bin").orderBy("entropy")

    def holding(rows: DataFrame) -> DataFrame:
        """The rows among whose ``n`` values, after the ``before`` ones, are those of the place below or above."""
        def among(place):
            return (place >= F.col("before")) & (place < F.col("before") + F.col("n"))

        return rows.withColumn("low", among(F.floor("place"))).withColumn("high", among(F.ceil("place"))) \
            .where("low or high")

    bins = entropies.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    wanted = holding(bins.withColumn("before", F.sum("n").over(of_lang.orderBy("bin")) - F.col("n"))
                     .withColumn("place", (F.sum("n").over(of_lang) - 1) * F.lit(float(quantile))))
    values = entropies.join(F.broadcast(wanted.select("lang", "bin", "place", F.col("before").alias("start"))),
                            ["lang", "bin"]).groupBy("lang", "bin", "place", "start", "entropy").agg(F.count("*").alias("n"))
    found = holding(values.withColumn("before", F.col("start") + F.sum("n").over(of_bin) - F.col("n")))
    rows = found.groupBy("lang", "place").agg(F.max(F.when(F.col("low"), F.col("entropy"))).alias("low"),
                                              F.max(F.when(F.col("high"), F.col("entropy"))).alias("high")).collect()
    return {r.lang: r.low + (r.high - r.low) * (r.place % 1) for r in rows}


def fit_languages(documents: DataFrame, block_values: int = BLOCK_VALUES, quantile: float = 0.999) -> LanguageModel:
    """Models of all non-null ``lang`` values of ``documents`` (doc_id, text, lang).

    Grams are counted over all its whole texts, and all are kept. The model has as many
    blocks of about ``block_values`` probabilities as that takes; the driver and a task
    hold one at a time (at least the grams around one character). The
    rejection limits are a quantile of the cross-entropies of all of a language's own
    documents, plus a tenth.
    """
    spark = documents.sparkSession
    rows = documents.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = stored(rows.select("text", "lang").mapInArrow(_counted, "lang string, gram long, n long")
                    .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    levels = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):     # a shorter gram counts the different characters that it follows
        levels[order] = stored(levels[order + 1].groupBy(
            "lang", F.col("gram").bitwiseAND(F.lit(int(_mask(order)))).alias("gram")).agg(F.count("*").alias("n")),
            f"grams-{order}")
    seen = reduce(DataFrame.union, [x.groupBy("lang").agg(
        F.lit(order).alias("order"), F.count_if(F.col("n") == 1).alias("ones"),
        F.count_if(F.col("n") == 2).alias("twos")) for order, x in levels.items()]).collect()
    names = sorted({r.lang for r in seen})
    if not names:
        return LanguageModel([], np.zeros(1 << 16, np.int32), [], np.zeros(0))
    discount = {(r.lang, r.order): _discount(r.ones, r.twos) for r in seen}
    single = levels[1].toPandas()             # up to 65,536 a language
    unit = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(0xFFFF))
    block_of, count = _blocks(counts.groupBy(unit.alias("unit")).agg(F.count("*").alias("n")).toPandas(),
                              len(names), block_values)
    where = spark.createDataFrame([(u, b) for u, b in enumerate(block_of.tolist()) if b], "unit long, block int")
    blocked = counts.withColumn("unit", unit)
    blocked = blocked.join(F.broadcast(where), "unit", "left").fillna(0, ["block"]) if count > 1 \
        else blocked.withColumn("block", F.lit(0))
    arrays = stored(blocked.select("block", "lang", "gram", "n").groupBy("block").applyInPandas(
        _built(names, [{order: discount[x, order] for order in levels} for x in names],
               [(own.gram.to_numpy(np.int64).astype(np.uint64), own.n.to_numpy(float))
                for own in (single[single.lang == x] for x in names)]),
        "block int, kind int, `order` int, keys binary, values binary"), "language-blocks", ("block",))
    parts = []
    for b in range(count):
        part = ({}, {})
        for r in arrays.where(F.col("block") == b).collect():
            part[r.kind][r.order] = (np.frombuffer(r["keys"], np.uint64),
                                     np.frombuffer(r["values"], np.float32).reshape(-1, len(names)))
        parts.append(spark.sparkContext.broadcast(part))
    model = LanguageModel(names, block_of, parts, np.full(len(names), np.inf))

    load = _in_tasks(spark, model)

    def run(batches):
        import pyarrow as pa

        reader, model = Units(), load()
        for batch in batches:
            for part in slices(batch, model.budget()):
                lang = part.column("lang").to_pylist()
                entropy = model.cross_entropy(*reader.of(part.column("text").to_pylist()))
                own = entropy[np.arange(len(lang)), [model.languages.index(x) if x in model.languages else 0
                                                     for x in lang]]
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(own, pa.float64())],
                                                 ["lang", "entropy"])

    own = stored(rows.select("text", "lang").mapInArrow(run, "lang string, entropy double"), "entropies")
    limits = _limits(own.where(F.col("lang").isin(names)), quantile)     # others have texts without a letter only
    model.limits[:] = [limits[x] * 1.1 for x in names]
    return model


def identify_language(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and rejected per row of ``documents`` (doc_id, text).

    ``lang_pred`` is the language of the least cross-entropy per character of the whole
    text, ``und`` if the text is null or has no letter (score 0). ``rejected``
    says that the text is unlike every language learned (always so for ``und``). With no
    language learned all are ``und``. Equal cross-entropies take the first language by name.
    Repeated rows give repeated rows. Other columns are ignored.
    """
    load = _in_tasks(documents.sparkSession, model)

    def run(batches):
        import pyarrow as pa

        reader, model = Units(), load()
        for batch in batches:
            for part in slices(batch, model.budget()):
                named, score, rejected = model.predict(part.column("text").to_pylist(), reader)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(named, pa.string()),
                     pa.array(score, pa.float64()), pa.array(rejected)],
                    ["doc_id", "lang_pred", "score", "rejected"])

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")
