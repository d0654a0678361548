"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of three rows of hashed tables: two independent
hashes of the word (so that two words rarely share both) and one of its first
five bytes (so that inflections meet). Filters of widths 1, 2 and 3 run over
the words, the maximum of each over the whole text feeds a logistic output.
All labelled documents take part: Spark adds up in how many toxic and clean ones each
table row occurs, which the tables start from; in each epoch every task trains in
numpy on its own documents, and Spark averages what the tasks have learned (a table row by
how often a task moved it). A fifth, by a hash, calibrates the thresholds
by language; the language of a text is guessed from its words, so a score depends on the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, lent, mix64, shipped, slices, stored, stretches, text_bytes, word_bounds

SLICE_BYTES = 1 << 18
LEARNED_BYTES = 1 << 20      # of texts that are put in a random order together
BATCH = 64                   # texts of a step, fewer where they have more than POOLED_WORDS words
LOGIT_BINS = 256             # a unit of logit, that a threshold is looked for in
PIECE_BYTES = 4 << 20        # of a long text hashed at a time
POOLED_WORDS = 1 << 20       # pooled at a time
WIDTHS = (1, 2, 3)
_ROWS = 1 << 18              # of each embedding table
_LANGUAGE_ROWS = 1 << 12
LEAST_HELD = 20              # toxic and clean texts each that a language's threshold is taken from
LANGUAGES = 64               # that are topped up to LEAST_DRAWN
LEAST_DRAWN = 200            # of each language and label in the sample, if there are as many; a fifth calibrates
_DIM = 4
_FILTERS = 4                 # of each width

_RNG = np.random.default_rng(20240608)
_BYTE_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0xD6E8FEB86659FD93
_FACTOR_INVERSE = pow(_FACTOR, -1, 2**64)
# Letters and digits of ASCII, and all bytes of other characters, make words.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTE_VALUE[65:91] = _BYTE_VALUE[97:123]


class Words:
    """Table rows of all words of many texts at once."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(3 x words table rows, n + 1 offsets of the texts' words)."""
        raw, offsets = text_bytes(texts)
        size = len(raw)
        if not size:
            return np.zeros((3, 0), np.int32), np.zeros(len(offsets), np.int64)
        starts, parts = [], []
        for a, z in stretches(raw, offsets, _INSIDE, PIECE_BYTES):
            if len(self.up) <= z - a:
                for name, factor in (("up", _FACTOR), ("down", _FACTOR_INVERSE)):
                    powers = np.full(z - a + 1, factor, np.uint64)
                    powers[0] = 1
                    setattr(self, name, np.cumprod(powers, dtype=np.uint64))
            start, end = word_bounds(raw, offsets, _INSIDE, a, z)
            sums = np.zeros(z - a + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[raw[a:z]] * self.up[:z - a], out=sums[1:])
            word = mix64((sums[end] - sums[start]) * self.down[start])
            stem = mix64((sums[np.minimum(end, start + 5)] - sums[start]) * self.down[start])
            low = np.uint64(_ROWS - 1)
            rows = np.empty((3, len(word)), np.int32)
            rows[0], rows[1], rows[2] = word & low, (word >> np.uint64(32)) & low, stem & low
            starts.append(start + a)
            parts.append(rows)
        return np.concatenate(parts, axis=1), np.searchsorted(np.concatenate(starts), offsets)


@dataclass
class ToxicityModel:
    tables: list             # three (rows x dim) embedding tables
    filters: list            # per width (width x filters x dim)
    bias: np.ndarray         # of the filters
    out: np.ndarray          # weights of the pooled filters
    out_bias: float
    languages: list          # names
    language_words: np.ndarray   # (languages x rows) log probabilities
    scale: float             # of the logits
    thresholds: np.ndarray   # logit that maps to 0.5, by language (last: any)

    def __getstate__(self):
        """Only rows that the sample has met travel; all others are zero."""
        held = [np.flatnonzero(t.any(1)).astype(np.int32) for t in self.tables]
        return {**self.__dict__, "tables": [(len(t), h, t[h]) for t, h in zip(self.tables, held)]}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.tables = []
        for count, held, values in state["tables"]:
            table = np.zeros((count, values.shape[1]), np.float32)
            table[held] = values
            self.tables.append(table)

    def logits(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        pooled, _ = pool(self, rows, ends)
        return pooled @ self.out + self.out_bias

    def guess(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of the likeliest language by text; without words the number after the last."""
        n = len(self.languages)
        if not n:
            return np.zeros(len(ends) - 1, np.int64)
        sums = np.zeros((len(ends) - 1, n))
        has = np.diff(ends) > 0
        if has.any():
            word = rows[0] & (_LANGUAGE_ROWS - 1)
            for j, own in enumerate(self.language_words):
                sums[has, j] = np.add.reduceat(own[word], ends[:-1][has], dtype=np.float64)
        return np.where(has, sums.argmax(1), n)

    def score(self, rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
        logit = (self.logits(rows, ends) - self.thresholds[self.guess(rows, ends)]) * self.scale
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def embed(model, rows: np.ndarray) -> np.ndarray:
    a, b, c = model.tables
    x = a[rows[0]]
    x += b[rows[1]]
    x += c[rows[2]]
    return x


def pool(model, rows: np.ndarray, ends: np.ndarray, places: bool = False):
    """Largest response of each filter in each text (0 where none is positive); and where it is.

    Many words are pooled a stretch at a time; stretches overlap by what the widest filter reaches over.
    """
    count = rows.shape[1]
    if count <= POOLED_WORDS:
        return _pool(model, rows, ends, places)
    pooled = np.zeros((len(ends) - 1, len(model.bias)), np.float32)
    where = np.full(pooled.shape, -1, np.int64) if places else None
    for a in range(0, count, POOLED_WORDS):
        z = min(count, a + POOLED_WORDS + max(WIDTHS) - 1)
        own, at = _pool(model, rows[:, a:z], np.clip(ends, a, z) - a, places)
        if places:
            better = own > pooled
            where[better] = at[better] + a
        np.maximum(pooled, own, out=pooled)
    return pooled, where


def _pool(model, rows: np.ndarray, ends: np.ndarray, places: bool = False):
    n, f = len(ends) - 1, len(model.bias)
    pooled = np.zeros((f, n), np.float32)
    where = np.full((n, f), -1, np.int64) if places else None
    count = rows.shape[1]
    if not count:
        return pooled.T, where
    every = np.concatenate([w.reshape(-1, w.shape[2]) for w in model.filters]) @ embed(model, rows).T
    sizes, done, used = np.diff(ends), 0, 0
    for width, w in zip(WIDTHS, model.filters):
        k = w.shape[1]
        parts = every[used:used + width * k].reshape(width, k, count)
        reach = count - width + 1
        if reach > 0:
            r = parts[0][:, :reach]
            for j in range(1, width):
                r += parts[j][:, j:j + reach]
            for j in range(1, width):        # positions from which the filter runs over the end of a text
                over = ends[1:-1] - j
                r[:, over[(over >= 0) & (over < reach)]] = -np.inf
            has = (sizes > 0) & (ends[:-1] < reach)
            best = np.maximum.reduceat(r, ends[:-1][has], axis=1) + model.bias[done:done + k, None]
            pooled[done:done + k, has] = np.maximum(best, 0)
            if places:
                for t, s, z in zip(np.flatnonzero(has), ends[:-1][has], np.minimum(ends[1:][has], reach)):
                    where[t, done:done + k] = np.where(pooled[done:done + k, t] > 0,
                                                       r[:, s:z].argmax(1) + s, -1)
        done += k
        used += width * k
    return pooled.T, where


class Counts:
    """Numbers of toxic and clean texts that hold each table row, and of the words by language."""

    def __init__(self):
        self.bad, self.good = np.zeros((3, _ROWS), np.int64), np.zeros((3, _ROWS), np.int64)
        self.words: dict = {}                # language -> counts by row
        self.learned = np.zeros(2, np.int64)      # clean and toxic texts that are learned from
        self.texts = np.zeros(2, np.int64)        # of all

    def add(self, rows: np.ndarray, ends: np.ndarray, toxic: np.ndarray, languages: list, learn: np.ndarray) -> None:
        self.texts += np.bincount(toxic, minlength=2)
        self.learned += np.bincount(toxic[learn], minlength=2)
        owner = np.repeat(np.arange(len(toxic)), np.diff(ends))
        for j in range(3):
            key = np.unique(owner * _ROWS + rows[j])     # a text counts once for a row
            key = key[learn[key // _ROWS]]
            bad = toxic[key // _ROWS] > 0
            for counts, own in ((self.bad, bad), (self.good, ~bad)):
                row, n = np.unique(key[own] % _ROWS, return_counts=True)
                counts[j][row] += n
        names = sorted({x for x in languages if x is not None})
        number = np.array([names.index(x) if x is not None else -1 for x in languages])[owner]
        for j, name in enumerate(names):
            own = self.words.setdefault(name, np.zeros(_LANGUAGE_ROWS, np.int64))
            own += np.bincount(rows[0][number == j] & (_LANGUAGE_ROWS - 1), minlength=_LANGUAGE_ROWS)


def _log_odds(bad: np.ndarray, good: np.ndarray, share: float, strength: float = 5.0) -> np.ndarray:
    """Smoothed log odds of a toxic text by row, from the numbers of texts that hold the row."""
    return np.log((bad + strength * share) / (good + strength * (1 - share)) * ((1 - share) / share))


class Training:
    """A model with the moments of its dense weights (Adam) and its table rows (AdaGrad)."""

    def __init__(self, counts: Counts, rng):
        names = sorted(counts.words)
        model = self.model = ToxicityModel(
            [rng.normal(0, 0.02, (_ROWS, _DIM)).astype(np.float32) for _ in range(3)],
            [rng.normal(0, 0.1, (w, _FILTERS, _DIM)).astype(np.float32) for w in WIDTHS],
            np.zeros(len(WIDTHS) * _FILTERS, np.float32), np.zeros(len(WIDTHS) * _FILTERS, np.float32),
            0.0, names, np.zeros((len(names), _LANGUAGE_ROWS), np.float32), 1.0, np.zeros(len(names) + 1))
        share = counts.texts[1] / max(1, counts.texts.sum())
        self.constant = not 0 < share < 1         # labels of one kind: every text scores that kind's share
        if self.constant:
            for table in model.tables:
                table[:] = 0
            model.out_bias = 20.0 if share == 1 else -20.0
            return
        for j, name in enumerate(names):
            words = counts.words[name] + 0.5
            model.language_words[j] = np.log(words / words.sum())
        # start: the first dimension of each table carries the smoothed log odds of its rows
        learned = min(max(counts.learned[1] / max(1, counts.learned.sum()), 1e-6), 1 - 1e-6)
        for j, table in enumerate(model.tables):
            table[:, 0] = _log_odds(counts.bad[j], counts.good[j], learned) / 6
            table[counts.bad[j] + counts.good[j] == 0] = 0        # what is not learned says nothing
        for w, width in zip(model.filters, WIDTHS):
            w[0, :_FILTERS // 2, 0] += 1.0 / width
            w[-1, _FILTERS // 2:, 0] += 1.0 / width
        model.bias[:] = -0.5
        model.out[:] = 0.5
        model.out_bias = -3.0
        self.weight = np.array([0.5 / (1 - share), 0.5 / share]) ** 0.5      # of a clean and a toxic text
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.dense()]
        self.bias_moment = np.zeros(2)
        self.squares = [np.full(_ROWS, 1e-3, np.float32) for _ in model.tables]
        self.moved = [np.zeros(_ROWS, np.int32) for _ in model.tables]       # examples by row
        self.steps = 0.0

    def __getstate__(self):
        """Only rows that are learned travel, as those of the model."""
        held = [np.flatnonzero(t.any(1)).astype(np.int32) for t in self.model.tables]
        return {**self.__dict__, "moved": None, "squares": [(h, x[h]) for h, x in zip(held, self.squares)]}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.squares = []
        for held, values in state["squares"]:
            self.squares.append(np.full(_ROWS, 1e-3, np.float32))
            self.squares[-1][held] = values
        self.moved = [np.zeros(_ROWS, np.int32) for _ in self.squares]

    def dense(self) -> list:
        return [*self.model.filters, self.model.bias, self.model.out]

    def step(self, rows: np.ndarray, ends: np.ndarray, toxic: np.ndarray) -> None:
        """One step over a batch of texts."""
        model, dense = self.model, self.dense()
        self.steps += 1
        pooled, where = pool(model, rows, ends, places=True)
        p = 1 / (1 + np.exp(-(pooled @ model.out + model.out_bias)))
        error = ((p - toxic) * self.weight[toxic] / len(toxic)).astype(np.float32)
        grads = [np.zeros_like(x) for x in dense]
        grads[-1] = pooled.T @ error + 1e-4 * model.out
        back = error[:, None] * model.out * (where >= 0)
        grads[-2] = back.sum(0)
        moved = []
        for v, (width, w) in enumerate(zip(WIDTHS, model.filters)):
            cols = slice(v * _FILTERS, (v + 1) * _FILTERS)
            t, k = np.nonzero(where[:, cols] >= 0)
            at, g = where[:, cols][t, k], back[:, cols][t, k]
            for j in range(width):
                np.add.at(grads[v][j], k, embed(model, rows[:, at + j]) * g[:, None])
                moved.append((rows[:, at + j], w[j][k] * g[:, None]))
        rate = 0.01
        for q, g, (m1, m2) in zip(dense, grads, self.moments):
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            q -= rate * (m1 / (1 - 0.9**self.steps)) / (np.sqrt(m2 / (1 - 0.999**self.steps)) + 1e-8)
        g = float(error.sum())
        self.bias_moment += np.array([0.1, 0.001]) * (np.array([g, g * g]) - self.bias_moment)
        model.out_bias -= rate * self.bias_moment[0] / (1 - 0.9**self.steps) / (
            (self.bias_moment[1] / (1 - 0.999**self.steps)) ** 0.5 + 1e-8)
        at = np.concatenate([r for r, _ in moved], axis=1)
        g = np.concatenate([d for _, d in moved])
        for j, table in enumerate(model.tables):     # by AdaGrad, one rate a row
            row, where_row, count = np.unique(at[j], return_inverse=True, return_counts=True)
            total = np.zeros((len(row), _DIM), np.float32)
            np.add.at(total, where_row, g)
            self.squares[j][row] += (total**2).mean(1)
            self.moved[j][row] += count
            table[row] -= 0.02 * total / np.sqrt(self.squares[j][row])[:, None]

    def learn(self, rows: np.ndarray, ends: np.ndarray, toxic: np.ndarray, order: np.ndarray) -> None:
        """Steps over the texts of ``order``."""
        sizes = np.diff(ends)
        at = 0
        while at < len(order):
            fit_in = int(np.searchsorted(np.cumsum(sizes[order[at:at + BATCH]]), POOLED_WORDS, side="right"))
            part = order[at:at + max(1, fit_in)]
            own = np.concatenate([rows[:, ends[i]:ends[i + 1]] for i in part], axis=1)
            self.step(own, np.cumsum([0, *sizes[part]]), toxic[part])
            at += len(part)

    def vector(self) -> np.ndarray:
        """All dense weights, their moments and the number of steps."""
        return np.concatenate([*(x.ravel() for x in self.dense()), *(m.ravel() for pair in self.moments for m in pair),
                               self.bias_moment, [self.model.out_bias, self.steps]]).astype(np.float64)

    def take(self, vector: np.ndarray) -> None:
        at = 0
        for x in [*self.dense(), *(m for pair in self.moments for m in pair), self.bias_moment]:
            x[...] = vector[at:at + x.size].reshape(x.shape)
            at += x.size
        self.model.out_bias, self.steps = float(vector[at]), float(vector[at + 1])


def fit(texts: list, toxic: np.ndarray, languages: list, epochs: int = 6, seed: int = 0,
        drawn_for: np.ndarray | None = None) -> ToxicityModel:
    """Train on whole ``texts`` with 0/1 labels in one process; a fifth of them, by order, calibrates the thresholds.

    ``drawn_for`` says for how many documents of the input a text was drawn (each for itself if missing).

    ``languages`` (None where unknown) only serve to guess a text's language
    from its words. With labels of one kind or none, every text scores that kind's share.
    """
    import pandas as pd
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    toxic = np.asarray(toxic).astype(np.int64)
    held = np.arange(len(texts)) % 5 == 4
    rows, ends = Words().of(pa.array(texts, pa.large_string()))
    counts = Counts()
    counts.add(rows, ends, toxic, list(languages), ~held)
    training = Training(counts, rng)
    model = training.model
    if training.constant:
        return model
    for _ in range(epochs):
        training.learn(rows, ends, toxic, rng.permutation(np.flatnonzero(~held)))
    stands = np.ones(len(texts)) if drawn_for is None else np.asarray(drawn_for)
    logit = model.logits(rows, ends)
    frame = pd.DataFrame({"guess": model.guess(rows, ends), "bad": toxic * stands, "good": (1 - toxic) * stands,
                          "bads": toxic, "goods": 1 - toxic, "bin": logit, "low": logit, "high": logit})[held]
    _calibrate(model, frame)
    return model


def _best_cut(bins) -> float:
    """Cut of the best F1 between bins of logits (bin; bad, good: its texts; low, high: its least and greatest logit);
    in the middle of the gap that it lies in."""
    bins = bins.groupby("bin").agg({"bad": "sum", "good": "sum", "low": "min", "high": "max"}) \
        .sort_index(ascending=False)
    bad, low, high = bins.bad.to_numpy(float), bins.low.to_numpy(float), bins.high.to_numpy(float)
    f1 = 2 * np.cumsum(bad) / (np.cumsum(bad + bins.good.to_numpy(float)) + bad.sum())
    best = int(f1.argmax())
    return float((low[best] + (high[best + 1] if best + 1 < len(low) else low[best] - 2)) / 2)


def _calibrate(model: ToxicityModel, bins) -> None:
    """Thresholds by bins of logits (``_best_cut``'s columns and guess; bads, goods: texts drawn) of documents that were
    not learned from; a language with under LEAST_HELD toxic or clean ones takes the common one."""
    if not len(bins) or not bins.bads.sum() or not bins.goods.sum():
        return
    model.thresholds[:] = _best_cut(bins)
    for j, own in bins.groupby("guess"):
        if j < len(model.languages) and own.bads.sum() >= LEAST_HELD and own.goods.sum() >= LEAST_HELD:
            model.thresholds[j] = _best_cut(own)


def labelled_sample(documents: DataFrame, labels: DataFrame, limit: int = 8_000,
                    text_bytes: int = 128 << 20) -> DataFrame:
    """For trials with ``fit``, which holds all its texts: about ``limit`` labelled documents, chosen by a hash of id and text (a bounded sample), with more
    of a language's toxic or clean ones where that would be under LEAST_DRAWN of them.

    ``documents`` (doc_id, text, lang), ``labels`` (doc_id, toxic). Returns doc_id, text, lang, toxic and
    drawn_for (documents that a text was drawn for). Rows without a label or text are
    left out; of several labels of an id the largest counts, equal rows count once. The LANGUAGES most
    frequent values of lang are topped up. The sample holds up to about ``text_bytes`` of text: it is thinned where it would be
    more, and a text of more than a sixteenth of that is scored like any other but not learned from.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).alias("toxic"))
    rows = documents.where("text is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
        F.xxhash64("text").alias("digest"))
    labelled = rows.select("doc_id", "digest", "lang", F.octet_length("text").alias("bytes")) \
        .where(F.col("bytes") <= text_bytes // 16).join(known, "doc_id").distinct()
    sizes = labelled.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    share = min(1.0, limit / max(1, total[0]))
    largest = sizes.orderBy(F.desc("n"), "lang", "toxic").limit(2 * LANGUAGES).collect()
    wanted = {(r.lang, r.toxic): min(1.0, max(share, LEAST_DRAWN / r.n)) for r in largest}
    expected = share * (total[1] - sum(r.bytes for r in largest)) + sum(
        wanted[r.lang, r.toxic] * r.bytes for r in largest)
    thin = min(1.0, text_bytes / max(1, expected))
    share, wanted = share * thin, {x: part * thin for x, part in wanted.items()}
    parts = documents.sparkSession.createDataFrame(
        [(x is not None, x or "", bad, part) for (x, bad), part in wanted.items()],
        "named boolean, name string, toxic boolean, part double")
    part = F.coalesce("part", F.lit(share))
    chosen = labelled.withColumn("named", F.col("lang").isNotNull()).withColumn("name", F.coalesce("lang", F.lit(""))) \
        .join(parts, ["named", "name", "toxic"], "left") \
        .where((part >= 1) | (F.xxhash64("doc_id", "digest") / F.lit(2.0 ** 64) + 0.5 < part)) \
        .select("doc_id", "digest", "lang", "toxic", (1 / part).alias("drawn_for"))
    # chosen has about limit rows and up to LEAST_DRAWN for each of the topped-up languages and label, so its
    # broadcast is bounded, and so are the texts
    chosen = chosen.withColumnsRenamed({"doc_id": "id", "digest": "text_digest", "lang": "own_lang"})
    same = (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("text_digest")) \
        & F.col("lang").eqNullSafe(F.col("own_lang"))
    return rows.join(F.broadcast(chosen), same).select("doc_id", "text", "lang", "toxic", "drawn_for") \
        .dropDuplicates(["doc_id", "text", "lang"])


def labelled_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled document, stored: packed (its whole text, compressed), lang, toxic (0 or 1), learn (a fifth is not).

    ``documents`` (doc_id, text, lang), ``labels`` (doc_id, toxic). Rows without a label or text are
    left out; of several labels of an id the largest counts, equal rows count once.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    rows = documents.where("text is not null and doc_id is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.withColumn("digest", F.xxhash64("text", "lang", F.col("lang").isNull()))

    def packed(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 4 * LEARNED_BYTES):
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("digest"), part.column("lang").cast(pa.string()),
                     pa.array([zlib.compress(t, 1) for t in texts], pa.binary())], ["doc_id", "digest", "lang", "packed"])

    keys = rows.select("doc_id", "digest").distinct().join(known, "doc_id")      # an id of many rows is spread by the digest
    texts = rows.mapInArrow(lean(packed), "doc_id long, digest long, lang string, packed binary")
    learn = F.pmod(F.xxhash64("digest", "doc_id"), F.lit(5)) != 4
    return stored(texts.join(keys.hint("merge"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"])
                  .select("packed", "lang", "toxic", learn.alias("learn")), "labelled")


def _encoded(batches, budget: int):
    """Of slices of ``labelled_texts`` with about ``budget`` bytes of text: table rows and ends of the texts, labels, slice."""
    import zlib

    import pyarrow as pa

    words = Words()
    for batch in batches:
        texts, size, start = [], 0, 0
        for i, packed in enumerate(batch.column("packed")):
            texts.append(zlib.decompress(packed.as_py()))
            size += len(texts[-1])
            if size >= budget or i + 1 == batch.num_rows:
                part = batch.slice(start, i + 1 - start)
                rows, ends = words.of(pa.array(texts, pa.large_binary()).view(pa.large_string()))
                yield rows, ends, part.column("toxic").to_numpy().astype(np.int64), part
                texts, size, start = [], 0, i + 1


_COUNTED = "kind int, lang string, row int, bad long, good long"


def _counted(batches):
    """A task's ``Counts``: kinds 0 to 2 the tables, 3 the words of a language, 4 the texts and 5 those learned from."""
    import pyarrow as pa

    counts = Counts()
    for rows, ends, toxic, part in _encoded(batches, LEARNED_BYTES):
        counts.add(rows, ends, toxic, part.column("lang").to_pylist(),
                   part.column("learn").to_numpy(zero_copy_only=False).astype(bool))

    def made(kind, lang, row, bad, good):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(row), kind, np.int32)), pa.array([lang] * len(row), pa.string()),
             pa.array(row.astype(np.int32)), pa.array(bad), pa.array(good)], ["kind", "lang", "row", "bad", "good"])

    for j in range(3):
        row = np.flatnonzero(counts.bad[j] + counts.good[j])
        yield made(j, None, row, counts.bad[j][row], counts.good[j][row])
    for name, own in counts.words.items():
        row = np.flatnonzero(own) if own.any() else np.zeros(1, np.int64)
        yield made(3, name, row, own[row], own[row])
    for kind, (good, bad) in ((4, counts.texts), (5, counts.learned)):
        yield made(kind, None, np.zeros(1, np.int64), np.array([bad]), np.array([good]))


def _all_counts(rows: DataFrame) -> Counts:
    """The sums over all tasks, of a size that the tables and languages bound; they come as Arrow columns, as
    an object for each of them would be many times as large."""
    sums = rows.mapInArrow(lean(_counted), _COUNTED).groupBy("kind", "lang", "row").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    kind, row, bad, good = (sums.column(x).to_numpy() for x in ("kind", "row", "bad", "good"))
    counts = Counts()
    for j in range(3):
        own = kind == j
        counts.bad[j][row[own]], counts.good[j][row[own]] = bad[own], good[own]
    words = np.flatnonzero(kind == 3)
    lang = sums.column("lang").take(words).combine_chunks().dictionary_encode()
    number = lang.indices.to_numpy(zero_copy_only=False)
    for j, name in enumerate(lang.dictionary.to_pylist()):
        own = words[number == j]
        counts.words[name] = np.zeros(_LANGUAGE_ROWS, np.int64)
        counts.words[name][row[own]] = bad[own]
    for j, both in ((4, counts.texts), (5, counts.learned)):
        for at in np.flatnonzero(kind == j):
            both[:] = good[at], bad[at]
    return counts


_LEARNED = "kind int, row int, n long, a double, b double, c double, d double, square double"


def _epoch(load, seed: int):
    """What a task learns from its documents: kinds 0 to 2 changes of table rows, 3 the dense weights, all times ``n``."""
    def run(batches):
        import pyarrow as pa

        training, rng, texts = load(), np.random.default_rng(seed), 0
        before = [t.copy() for t in training.model.tables]
        first = [x.copy() for x in training.squares]
        for rows, ends, toxic, part in _encoded(batches, LEARNED_BYTES):
            training.learn(rows, ends, toxic, rng.permutation(len(toxic)))
            texts += len(toxic)
        if not texts:
            return

        def made(kind, row, n, values, square):
            columns = [*(values * n[:, None]).T, square * n]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(row), kind, np.int32)), pa.array(row.astype(np.int32)), pa.array(n.astype(np.int64)),
                 *(pa.array(x.astype(np.float64)) for x in columns)],
                ["kind", "row", "n", "a", "b", "c", "d", "square"])

        for j, table in enumerate(training.model.tables):
            row = np.flatnonzero(training.moved[j])
            yield made(j, row, training.moved[j][row], (table[row] - before[j][row]).astype(np.float64),
                       (training.squares[j][row] - first[j][row]).astype(np.float64))
        vector = training.vector()
        values = np.zeros((len(vector), _DIM))
        values[:, 0] = vector
        yield made(3, np.arange(len(vector)), np.full(len(vector), texts), values, np.zeros(len(vector)))

    return run


def _learned(training: Training, learn: DataFrame, seed: int) -> None:
    """One epoch over all documents: the mean of what the tasks have learned."""
    means = [(F.sum(x) / F.sum("n")).cast("float").alias(x) for x in ("a", "b", "c", "d", "square")]
    with lent(learn.sparkSession, training) as load:
        sums = learn.mapInArrow(lean(_epoch(load, seed)), _LEARNED).groupBy("kind", "row").agg(*means).toArrow()
    kind, row = sums.column("kind").to_numpy(), sums.column("row").to_numpy()
    values = np.stack([sums.column(x).to_numpy() for x in ("a", "b", "c", "d")], axis=1)
    square = sums.column("square").to_numpy()
    for j in range(3):
        own = kind == j
        training.model.tables[j][row[own]] += values[own]
        training.squares[j][row[own]] += square[own]
    own = kind == 3
    if own.any():
        training.take(values[own, 0].astype(np.float64)[np.argsort(row[own])])


def _logit_bins(model: ToxicityModel, held: DataFrame):
    """Texts by guessed language and range of logits, with the least and the greatest logit."""
    def run(load):
        def logits(batches):
            import pyarrow as pa

            model = load()
            for rows, ends, toxic, _ in _encoded(batches, SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.guess(rows, ends).astype(np.int32)), pa.array(toxic),
                     pa.array(model.logits(rows, ends).astype(np.float64))], ["guess", "toxic", "logit"])

        return logits

    with lent(held.sparkSession, model) as load:
        bins = held.mapInArrow(lean(run(load)), "guess int, toxic long, logit double").groupBy(
            "guess", F.floor(F.col("logit") * LOGIT_BINS).alias("bin")).agg(
            F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"), F.min("logit").alias("low"),
            F.max("logit").alias("high")).toArrow().to_pandas()
    return bins.assign(bads=bins.bad, goods=bins.good)


def fit_toxicity(documents: DataFrame, labels: DataFrame, epochs: int = 6) -> ToxicityModel:
    """Fit on all labelled documents (``labelled_texts``): the driver only holds the model and sums of its size."""
    rows = labelled_texts(documents, labels)
    training = Training(_all_counts(rows), np.random.default_rng(0))
    give_back()              # what the counts took
    if not training.constant:
        for epoch in range(epochs):
            _learned(training, rows.where("learn"), epoch)
        _calibrate(training.model, _logit_bins(training.model, rows.where("not learn")))
        give_back()          # the driver lives on
    return training.model


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1, of the whole text) and predicted (1 if score >= 0.5) per row of ``documents``.

    Null and empty texts are scored as texts without words. Repeated rows give
    repeated rows. Other columns are ignored.
    """
    load = shipped(documents.sparkSession, model)   # of fixed size

    def run(batches):
        import pyarrow as pa

        words, model = Words(), load()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                score = model.score(*words.of(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(score, pa.float64()),
                     pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return documents.select("doc_id", "text").mapInArrow(
        lean(run), "doc_id long, score double, predicted int")


def drop_toxic(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``documents`` (with all their columns) whose whole text scores below 0.5."""
    load = shipped(documents.sparkSession, model)

    def run(batches):
        import pyarrow as pa

        words, model = Words(), load()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                yield part.filter(pa.array(model.score(*words.of(part.column("text"))) < 0.5))

    return documents.mapInArrow(lean(run), documents.schema)
