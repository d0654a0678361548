"""Toxicity and language identification: held-out accuracy, normalisation, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from bankmart.llm import language_id as L
from bankmart.llm import queries as Q
from bankmart.llm import toxicity as T


def labelled(n=1500, seed=3):
    rng = random.Random(seed)
    syllables = {"en": "th er on an re he in ed nd ha", "de": "en er ch ei un sch ge die in te"}
    bad = {"en": ["moron", "scum"], "de": ["lowei%s" % s for s in ("er", "en", "ung")]}
    texts, toxic, lang = [], [], []
    for _ in range(n):
        l = rng.choice(["en", "en", "de"])
        words = ["".join(rng.choices(syllables[l].split(), k=rng.randrange(1, 5))) for _ in range(rng.randrange(5, 300))]
        y = rng.random() < 0.15
        if y:
            for _ in range(rng.randrange(1, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(bad[l]))
        texts.append(" ".join(words)), toxic.append(int(y)), lang.append(l)
    return texts, np.array(toxic), lang


def test_toxicity_held_out():
    texts, toxic, lang = labelled()
    model = T.fit(texts[:1100], toxic[:1100], lang[:1100])
    score = model.score(*T.Words().of(pa.array(texts[1100:])))
    wrong = (score >= 0.5) != toxic[1100:]
    assert wrong.mean() < 0.02
    # a capital, a sign or the neighbours' batch change nothing; an empty text is clean
    words = T.Words()
    one = [float(model.score(*words.of(pa.array([t])))[0]) for t in texts[1100:1110]]
    assert np.allclose(one, score[:10])
    assert model.score(*words.of(pa.array(["MORON!", "", None])))[0] >= 0.5
    assert (model.score(*words.of(pa.array(["", None]))) < 0.5).all()


@pytest.mark.parametrize("toxic", [[], [0, 0], [1, 1]])
def test_toxicity_of_one_kind(toxic):
    model = T.fit(["some words"] * len(toxic), np.array(toxic, float), ["en"] * len(toxic))
    score = model.score(*T.Words().of(pa.array(["some words", ""])))
    assert ((score >= 0.5) == bool(toxic and toxic[0])).all()


def test_toxicity_rows(spark, sf, odd, none):
    documents, labels = Q.table(spark, sf, "documents"), Q.table(spark, sf, "labels")
    model = T.fit_toxicity(documents, labels)
    assert T.score_toxicity(odd, model).count() == odd.count()
    assert T.score_toxicity(none, model).count() == 0
    kept = T.drop_toxic(documents, model)
    scored = {r.doc_id: r.predicted for r in T.score_toxicity(documents, model).collect()}
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, p in scored.items() if not p}
    assert T.fit_toxicity(none, labels).out_bias == -20.0


def test_toxicity_sample_of_a_small_language(spark):
    """A language with few texts in an even sample gets enough of both labels when the input has them."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(4000):
        lang = "es" if i % 8 == 0 else "en"
        bad = rng.random() < (0.4 if lang == "es" else 0.12)
        words = [f"{lang}{w}" for w in rng.integers(0, 300, 30)]
        if bad:
            words[rng.integers(0, 30)] = "idiota" if lang == "es" else "moron"
        rows.append((i, " ".join(words), lang, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    drawn = T.labelled_sample(table.select("doc_id", "text", "lang"), table.select("doc_id", "toxic"), limit=800).toPandas()
    toxic, lang = drawn.toxic.to_numpy(float), drawn.lang
    small = np.array(lang) == "es"
    there = sum(r[2] == "es" and r[3] for r in rows)
    assert there > 150 and (toxic[small] > 0).sum() >= min(there, 150) and len(drawn) < 800 + 4 * 200
    assert abs(drawn.drawn_for.sum() - len(rows)) < 500


def test_toxicity_learns_from_every_document(spark):
    """Each of 300 insults stands in two of 20,000 documents only; odd labels, repeated and long rows."""
    rng = np.random.default_rng(7)
    insults = [f"insult{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    insults = [x[::-1] for x in insults]                   # no common beginning
    rows = []
    for i in range(20_000):
        words = [f"word{w}" for w in rng.integers(0, 300, 12)]
        if i < 600:
            words[rng.integers(0, 12)] = insults[i % 300]
        rows.append((i, " ".join(words), "de" if i % 3 else None, int(i < 600)))
    long_one = "rare " + "word1 " * 1_600_000                # of more than 8 MB
    extra = [(20_000, long_one, "en", 0), (20_001, None, "en", 1), (20_002, "unlabelled", "en", None)] + rows[:50]
    table = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, toxic int").repartition(4)
    documents, labels = table.select("doc_id", "text", "lang"), table.select("doc_id", "toxic")
    held = T.labelled_texts(documents, labels)
    counts = T._all_counts(held)
    assert counts.texts.tolist() == [19_401, 600] and 0.15 < 1 - counts.learned.sum() / 20_001 < 0.25
    learned = held.where("learn")
    only = T._all_counts(learned)
    assert (only.bad == counts.bad).all() and (only.good == counts.good).all()
    assert sum(x.sum() for x in counts.words.values()) == 12 * sum(r[2] == "de" for r in rows) + 1_600_001
    model = T.fit_toxicity(documents, labels, epochs=2)
    score = model.score(*T.Words().of(pa.array([r[1] for r in rows])))
    assert (score[:600] >= 0.5).mean() > 0.85 and (score[600:] < 0.5).mean() > 0.99
    fresh = model.score(*T.Words().of(pa.array([f"word1 word2 {x} word7 word9" for x in insults])))
    assert (fresh >= 0.5).mean() > 0.85


def test_driver_holds_counts_as_columns(spark):
    """The sums of some 100,000 table rows reach the driver as arrays, not as an object a row, whatever the session says."""
    import tracemalloc

    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    rows = [(i, " ".join(word() for _ in range(800)), ("en", "de", None)[i % 3]) for i in range(60)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    labelled = T.labelled_texts(documents, labels)
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    tracemalloc.start()
    try:
        counts = T._all_counts(labelled)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(key, before)
    whole = T.Counts()
    for r in labelled.collect():
        words, ends = T.Words().of(pa.array([zlib.decompress(r.packed).decode()]))
        whole.add(words, ends, np.array([r.toxic]), [r.lang], np.array([r.learn]))
    assert np.array_equal(counts.bad, whole.bad) and np.array_equal(counts.good, whole.good)
    assert (whole.bad + whole.good > 0).sum() > 80_000
    assert counts.texts.tolist() == whole.texts.tolist() and counts.learned.tolist() == whole.learned.tolist()
    assert counts.words.keys() == whole.words.keys() == {"en", "de"}
    assert all(np.array_equal(counts.words[x], whole.words[x]) for x in whole.words)
    assert peak < 30 << 20


def test_places_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, n)) for n in (0, 1, 700, 3, 2, 900, 0)]
    model = T.fit(labelled(60)[0], np.arange(60) % 2, ["en"] * 60, epochs=1)
    rows, ends = T.Words().of(pa.array(texts))
    model.tables = [rng.normal(0, 1, t.shape).astype(np.float32) for t in model.tables]
    want = T.pool(model, rows, ends, places=True)
    monkeypatch.setattr(T, "POOLED_WORDS", 100)
    got = T.pool(model, rows, ends, places=True)
    assert np.allclose(got[0], want[0], atol=1e-5) and (got[1] == want[1]).all()


def test_held_out_rule(spark, sf):
    got = {r.doc_id: r.held_out for r in Q.op2_toxicity(spark, sf).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in got} and len(got) == 200


def plain_grams(text):
    out, was = [], " "
    for c in text:
        c = c.lower() if c.isalpha() else " "
        if c != " " or was != " ":
            out.append(c)
        was = c
    padded = "   " + "".join(out)
    return [padded[i:i + 4] for i in range(len(out))]


def as_text(gram):
    return "".join(chr((int(gram) >> s) & 0xFFFF) for s in (48, 32, 16, 0))


def test_grams_of_many_texts():
    texts = ["The end.", "", None, "a  b--c 1", "  lead", "Élan\n\nÀ", "x"]
    gram, ends = L.grams(*L.Units().of(texts))
    for t, a, z in zip(texts, ends[:-1], ends[1:]):
        assert [as_text(g) for g in gram[a:z]] == plain_grams(t or "")


def test_kneser_ney_is_a_distribution_and_its_arrays_agree():
    corpus = {"de": "die der und das ist nicht ein schach schule " * 30, "en": "the that this with then when there " * 30}
    tables = [np.unique(L.grams(*L.Units().of([t]))[0], return_counts=True) for t in corpus.values()]
    model = L.build(list(corpus), tables)
    counts = L._Counts(tables[1][0].astype(np.uint64), tables[1][1].astype(float))
    every = np.arange(65536, dtype=np.uint64)
    for context in ("  t", " th", "the", "zzz", "xth"):
        c = sum(ord(x) << (16 * (3 - i)) for i, x in enumerate(context))
        p = counts.probability(every | np.uint64(c))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()
        assert np.allclose(model.log_probability(every | np.uint64(c))[:, 1], np.log(p), atol=1e-5)


def test_language_model_keeps_every_gram(spark):
    """More grams than fit a block, in one language: probabilities are those of the plain model over all."""
    rng = np.random.default_rng(8)
    wide = ["".join(map(chr, 0x4E00 + rng.integers(0, 12_000, 9_000))) for _ in range(28)]
    texts = {"de": ["die der und das ist nicht ein schach " * 20, "wir sind auch da, oder nicht?"], "zh": [*wide, wide[0] * 2]}
    rows = [(i, t, x) for i, (x, t) in enumerate((x, t) for x, own in texts.items() for t in own)]
    tables = [np.unique(L.grams(*L.Units().of(own))[0], return_counts=True) for own in texts.values()]
    assert len(tables[1][0]) > 250_000
    asked = ["die schule ist da", wide[3][:500], wide[27][-300:] + " und ", "новый мир", "", wide[5][::-1]]
    units, offsets = L.Units().of(asked)
    gram, ends = L.grams(units, offsets)
    plain = L.build(list(texts), tables).log_probability(gram).astype(float)
    want = [-plain[a:z].mean(0) if z > a else np.zeros(2) for a, z in zip(ends[:-1], ends[1:])]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit_languages(documents)
    assert np.allclose(model.cross_entropy(units, offsets), want, atol=1e-4)
    many = L.fit_languages(documents, block_values=100_000)
    assert len(many.parts) > 3 and np.allclose(many.cross_entropy(units, offsets), want, atol=1e-4)
    assert np.allclose(many.limits, model.limits, atol=1e-4)
    got = [[tuple(r) for r in L.identify_language(documents, m).orderBy("doc_id").collect()] for m in (model, many)]
    assert [r[:2] + r[3:] for r in got[0]] == [r[:2] + r[3:] for r in got[1]] and {r[1] for r in got[0]} == {"de", "zh"}


def test_limits_are_of_all_documents(spark):
    """One text in a thousand is unlike the others: the limit knows all of them."""
    rng = random.Random(21)
    words = {"en": "the that this with then when there".split(), "de": "die der und das ist nicht ein".split()}
    rows = [(i, " ".join(rng.choices(words[x], k=rng.randrange(3, 30))), x)
            for i, x in enumerate(rng.choices(["en", "de"], k=3000))]
    rows += [(i, "qxz vvk " * 4, "en") for i in range(3000, 3004)] + [(9000, "...", "none"), (9001, "", "de")] + rows[:40]
    model = L.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "none"] or model.languages == ["de", "en"]
    for j, name in enumerate(["de", "en"]):
        own = model.cross_entropy(*L.Units().of([t for _, t, x in rows if x == name]))[:, j]
        assert np.isclose(model.limits[j], np.quantile(own, 0.999) * 1.1, rtol=1e-9)


def test_limits_of_repeated_values(spark):
    rng = np.random.default_rng(22)
    rows = {"one": [3.25], "same": [2.5] * 700, "two": [1.0, 9.0],
            "many": np.r_[rng.normal(3, 1e-4, 900).repeat(3), rng.normal(5, 1, 300)].tolist()}
    frame = spark.createDataFrame([(x, v) for x, own in rows.items() for v in own], "lang string, entropy double")
    for quantile in (0.999, 0.5, 1.0, 0.0):
        got = L._limits(frame, quantile)
        assert got.keys() == rows.keys() and all(np.isclose(got[x], np.quantile(own, quantile), rtol=1e-12)
                                                 for x, own in rows.items())


def test_language_held_out(spark, sf):
    rows = Q.op3_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in Q.table(spark, sf, "documents").collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_rows(spark, sf, odd, none):
    model = L.fit_languages(Q.table(spark, sf, "documents"))
    rows = L.identify_language(odd, model).collect()
    assert len(rows) == odd.count()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5, 10} and all(r.rejected and r.score == 0 for r in rows if r.doc_id in und)
    strange = spark.createDataFrame([(1, "漢字 かな " * 40)], "doc_id long, text string")
    assert L.identify_language(strange, model).first().rejected
    assert L.identify_language(none, model).count() == 0
    empty = L.fit_languages(none)
    assert {r.lang_pred for r in L.identify_language(odd, empty).collect()} == {"und"}


def test_sample_of_toxicity_is_bounded(spark):
    """One id of very many rows, many dirty languages, long texts: rows and bytes of the sample stay bounded."""
    def sample(frame, labels, **limits):
        rows = T.labelled_sample(frame, labels, **limits).toPandas()
        return len(rows), rows.text.str.len().sum(), rows.drawn_for

    hot = [(1, f"text number {i} of one id", "en") for i in range(20_000)] + [(1, "the same text", "en")] * 3_000
    dirty = [(i, f"words {i}", f"lang{i % 3_000}") for i in range(2, 6_000)]
    frame = spark.createDataFrame(hot + dirty, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1, 6_000)] + [(1, None), (1, 1)],
                                   "doc_id long, toxic int")
    rows, _, weight = sample(frame, labels, limit=1_000)
    assert 600 < rows < 1_500 + 2 * T.LANGUAGES and (weight >= 1).all()
    assert abs(weight.sum() - 25_999) < 5_000            # the sample stands for all labelled documents
    assert sample(frame, labels, limit=1_000, text_bytes=6_000)[1] < 12_000
    long = spark.createDataFrame([(2, "x " * 50_000, "en"), (3, "short", None)], "doc_id long, text string, lang string")
    assert sample(long, labels, text_bytes=100_000)[0] == 1


def test_convolution_equals_a_plain_one(texts):
    """The pooled responses of a trained model, filter by filter and word by word."""
    rng = np.random.default_rng(5)
    own = [t or "" for t in list(texts.values())[:40]] + ["", "one", "two words"]
    model = T.fit(own, rng.integers(0, 2, len(own)).astype(float), ["en"] * len(own), 1)
    rows, ends = T.Words().of(pa.array(own))
    pooled, _ = T.pool(model, rows, ends)
    for i in range(len(own)):
        words = [sum(table[r] for table, r in zip(model.tables, rows[:, j])) for j in range(ends[i], ends[i + 1])]
        plain, f = [], 0
        for width, w in zip(T.WIDTHS, model.filters):
            for k in range(w.shape[1]):
                values = [sum(float(words[j + s] @ w[s, k]) for s in range(width)) + model.bias[f]
                          for j in range(len(words) - width + 1)]
                plain.append(max([0.0, *values]))
                f += 1
        assert np.allclose(pooled[i], plain, atol=1e-3)


def test_long_texts_by_stretches(monkeypatch, texts):
    """Words, shingles and pooled responses do not depend on how long texts are cut."""
    from bankmart.llm import ngram_join as N

    rng = np.random.default_rng(6)
    own = [t or "" for t in list(texts.values())[:30]] + ["", "x" * 900, "é\U0001d11e " * 200, "A b\tC\x0bd  e"]
    model = T.fit(own, rng.integers(0, 2, len(own)).astype(float), ["en"] * len(own), 1)
    rows, ends = T.Words().of(pa.array(own))
    sets = N.Hasher().sets(pa.array(own))
    scores = model.score(rows, ends)
    for size in (40, 333):
        monkeypatch.setattr(T, "PIECE_BYTES", size)
        monkeypatch.setattr(T, "POOLED_WORDS", size)
        monkeypatch.setattr(N, "PIECE_BYTES", size)
        again, bounds = T.Words().of(pa.array(own))
        assert np.array_equal(rows, again) and np.array_equal(ends, bounds)
        assert np.allclose(model.score(again, bounds), scores, atol=1e-5)
        assert all(np.array_equal(a, b) for a, b in zip(sets, N.Hasher().sets(pa.array(own))))
