"""Whitening, quality rules and ranked search against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bankmart.llm import lexical_search as L
from bankmart.llm import quality_rules as R
from bankmart.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>, label int, n long, component int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 9, 9)
                                  for i, v in rows], VECTORS)


def plain_whitening(x, want):
    """Whole-number rows, their exact deviations, eigenvalues and whitened coordinates."""
    x = np.floor(64 * x.astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1)
    a = (n * x - sums) / n
    values, turn = np.linalg.eigh(a.T @ a / n)
    values, turn = values[::-1], turn[:, ::-1]
    return deviation, values, a @ turn[:, :want] / np.sqrt(values[:want])


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 40)) * np.linspace(4, 0.2, 40)
    x[:1000] = x[0] + rng.normal(size=(1000, 40)) * 0.05          # a third are near copies
    out = W.whiten_embeddings(vectors(spark, enumerate(x)).repartition(5)).toPandas().sort_values(["vec_id", "component"])
    deviation, values, y = plain_whitening(x, 32)
    got = out.whitened.to_numpy().reshape(3000, 32)
    sign = np.sign((got * y).sum(0))
    assert np.abs(got - y * sign).max() < 1e-8
    assert (out.deviation.to_numpy().reshape(3000, 32) == deviation[:, None]).all()
    assert np.allclose(out.explained.to_numpy()[:32], values[:32] / values.sum(), rtol=1e-10)
    assert set(out.n) == {3000} and out.identity_error.nunique() == 1 and out.identity_error.iloc[0] < 1e-10
    assert np.abs(np.cov(got.T, bias=True) - np.eye(32)).max() < 1e-10


def product_of(a):
    def product(left, p):
        u = a @ p
        return u @ u, (a @ left).T @ u, a.T @ u
    return product


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 2, 2, 1, 1], [9, 1, 1e-3, 1e-5, 1e-6], [3, 2, 0, 0, 0], [7] * 6,
                                    [1, 0, 0], list(np.linspace(1, 3, 60))])
def test_bidiagonalisation_finds_repeated_and_missing_directions(values):
    rng = np.random.default_rng(2)
    d = len(values)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    left = np.linalg.qr(rng.normal(size=(200, d)))[0]
    a = left * np.array(values, float) @ turn.T
    v, sigma = W.bidiagonalise(product_of(a), d, np.linalg.norm(a), 200, 4)
    assert np.allclose(sigma, np.sort([s for s in values if s > 0])[::-1][:4], rtol=1e-9)
    assert np.allclose(v.T @ v, np.eye(len(sigma)), atol=1e-12)
    assert np.allclose(np.linalg.norm(a @ v, axis=0), sigma, rtol=1e-9)


def test_bidiagonalisation_stops_before_all_dimensions():
    a = np.random.default_rng(3).normal(size=(400, 300)) * 0.5 ** np.arange(300)
    steps = []
    product = product_of(a)
    _, sigma = W.bidiagonalise(lambda *x: steps.append(1) or product(*x), 300, np.linalg.norm(a), 400, 8)
    assert np.allclose(sigma, np.linalg.svd(a)[1][:8], rtol=1e-10) and len(steps) < 100


def test_whitening_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.normal(size=4)) for i in range(50)]
    odd = [(None, good[0][1]), (3, good[3][1]), (60, [0, 0, 0, 0]), (61, None), (62, [1, None, 2, 3]), (63, []),
           (64, [1, float("nan"), 2, 3]), (65, [1, float("-inf"), 2, 3]), (66, [1, 2]), (67, [2, 5]), (68, [1e5, 0, 0, 0]),
           (69, [3, 1, 2]), (70, [3, 1, 2])]
    rows = W.whiten_embeddings(vectors(spark, good + odd)).toPandas()
    count = Counter(rows.vec_id.fillna(-1).astype(int))
    assert count == {**{i: 4 for i in range(50)}, -1: 4, 3: 8, 60: 4, 66: 1, 67: 1, 68: 4}
    assert rows[rows.vec_id == 66].n.iloc[0] == 2 and rows[rows.vec_id == 60].n.iloc[0] == 54
    assert np.isfinite(rows.whitened).all()
    far = W.whiten_embeddings(vectors(spark, [*good, (68, [1e38, 0, 0, 0])])).toPandas()      # hides all others
    assert far[far.vec_id == 68].deviation.isna().all() and set(far.component) == {1} and len(far) == 51
    assert W.whiten_embeddings(vectors(spark, [])).count() == 0
    assert W.whiten_embeddings(vectors(spark, [(1, [1, 2]), (2, [1, 2])])).count() == 0


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j + k for j in range(len(words) - 2) if windows[tuple(words[j:j + 3])] > 1 for k in range(3)}
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_of_rules(spark, odd, none, sf):
    rng = random.Random(5)
    made = [" ".join(rng.choices(["a", "b", "é", "\U0001f600#", "x\n", "\x85y", "y\x0b"], k=rng.randrange(0, 40)))
            for _ in range(300)] + ["a a a a a", "a b c a b c", "w " * 5000, "\n\n \n", "x\ny\nx\nx \n", "a b\nc"]
    docs = spark.createDataFrame([(i, t, "h", 1) for i, t in enumerate(made)],
                                 "doc_id long, text string, source string, n_words int")
    for frame in (docs, odd, spark.read.parquet(f"{sf}/documents.parquet")):
        expected = Counter((r.doc_id, *plain_counts(r.text)) for r in frame.select("doc_id", "text").collect())
        rows = R.quality_verdicts(frame).collect()
        assert Counter((r.doc_id, *(r[c] for c in COUNTS)) for r in rows) == expected
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)
    assert R.quality_verdicts(none).count() == 0


def test_verdicts_on_hosts(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    symbols, short = "# " * 20 + clean, "too short"
    rows = [("bad", symbols)] * 90 + [("bad", clean)] * 10          # nearly all fail: all go
    rows += [("mixed", symbols)] * 35 + [("mixed", clean)] * 65     # those that fail go
    rows += [("good", symbols)] * 5 + [("good", clean)] * 995 + [(None, clean)] * 200 + [(None, short)]
    rows += [("tiny", symbols), ("other", clean), ("third", clean)] + [("big", clean)] * 1500
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    out = {r.doc_id: r for r in R.quality_verdicts(docs).collect()}
    assert len(out) == len(rows)
    for i, (host, text) in enumerate(rows):
        verdict = {"bad": "rejected", "mixed": "watched"}.get(host, "accepted")
        assert out[i].host_verdict == verdict and out[i].host == host
        assert out[i].kept == (text != short and host != "bad" and not (host == "mixed" and text == symbols))
    rate = {r.host: r for r in R.host_verdicts(R.measured(docs)).collect()}
    assert rate["good"].rate_symbols < 0.02
    assert rate["tiny"].rate_symbols < 0.2 and 0.8 < rate["bad"].rate_symbols < 0.9


def test_alike_hosts_share_one_rate(spark):
    clean, bad = "word%d " * 50 % tuple(range(50)), "# " * 60
    rows = [(i, bad if i % 4 == 0 else clean, f"h{i // 4}") for i in range(400)]
    found = R.host_verdicts(R.measured(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    assert {round(r.rate_symbols, 12) for r in found} == {0.25} and not any(r.rejected for r in found)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, best=10):
    """(item, rank, doc, score) of lists of (id, text)."""
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    n, tokens = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    frequency = Counter(t for _, c in counts for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, c in counts:
            m = 10 + (90 * sum(c.values()) * n) // max(tokens, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:best], 1)]
    return out


def found(frame):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect())


def test_ranked_search_equals_a_plain_one(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.4)) % 4000}" for _ in range(60_000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 120)))) for i in range(1500)]
    docs += [(2000 + i, docs[7][1] + " Extra") for i in range(400)]          # many near copies, ties
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(40)] + [(40, docs[7][1]), (41, "nowhere")]
    monkeypatch.setattr(L, "BLOCK_BYTES", 20_000)     # many blocks
    monkeypatch.setattr(L, "ASKED_ROWS", 150)         # several blocks of queries
    monkeypatch.setattr(L, "SEED_SHARE", 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(L.ranked_search(frame, asked)) == Counter(plain_search(docs, items))
    assert found(L.ranked_search(frame, asked, 3)) == Counter(plain_search(docs, items, 3))


def test_ranked_search_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "The FOX, the fox! naïve"), (1, "and more words"), (None, "id here"), (2, None), (3, ""), (4, "漢字 word1x1"),
             (5, "---"), (1, "The FOX, the fox! naïve")]
    asked = spark.createDataFrame([(*x, 3) for x in items], "item_id long, text string, rank int")
    assert found(L.ranked_search(odd, asked)) == Counter(plain_search(rows, items))
    assert L.ranked_search(none, asked).count() == 0
    assert L.ranked_search(odd, asked.where("false")).count() == 0


def test_terms_of_long_texts(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choices(["ab", "Z", " ", "é", "-", "\U0001f600", "9"], k=rng.randrange(0, 400))) for _ in range(60)]
    texts += ["x" * 500, "y" * 300 + " " + "z" * 300, "", "q " * 400]
    whole = [m for _, m in L.Terms().of(pa.array(texts))]
    monkeypatch.setattr(L, "PIECE_BYTES", 64)
    who, marks = (np.concatenate(x) for x in zip(*L.Terms().of(pa.array(texts))))
    assert np.array_equal(marks, np.concatenate(whole))
    names: dict = {}
    expected = [(i, t) for i, text in enumerate(texts) for t in terms_of(text)]
    assert who.tolist() == [i for i, _ in expected]
    for (_, t), m in zip(expected, marks.tolist()):
        assert names.setdefault(t, m) == m
    assert len(set(names.values())) == len(names)


def test_pair_bounds_hold_and_skip(spark):
    """The pair's bound is below the sum of the maxima, and never below a document's gain."""
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices(["a", "b", "c", "d", "e", f"u{i}"], weights=[9, 1, 5, 1, 3, 4], k=12))) for i in range(600)]
    docs += [(600 + i, "b " * 9) for i in range(5)] + [(700 + i, "d " * 9) for i in range(5)]
    (row,) = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).transform(L.index_documents).collect()
    marks = np.concatenate([m for _, m in L.Terms().of(pa.array(["a b c d e"]))])
    import pandas as pd

    total = sum(len(t.split()) for _, t in docs)
    asked = L.QueryBlock.of(pd.DataFrame({"item_id": 1, "term": marks.view(np.int64)}), len(docs), total, 10)
    terms, starts = np.frombuffer(row.terms, np.uint64), np.frombuffer(row.starts, np.int32)
    asked.weigh(np.diff(starts)[np.searchsorted(terms, asked.vocabulary)].astype(np.int64))
    batch = pa.RecordBatch.from_arrays([pa.array([row[c]], pa.list_(pa.int64()) if c == "ids" else pa.binary())
                                        for c in row.asDict()], list(row.asDict()))
    (impacts,) = L._with_impacts(lambda: asked)([batch])
    block = L.ImpactBlock(impacts, 0, asked)
    (pairs,) = asked.own
    every, scores = block.search(pairs, 1)
    whole = block.scored
    assert (block.bound[pairs] >= block.single[pairs]).all() and scores.max() <= block.bound[pairs].sum()
    limit = int(np.sort(scores)[-10])
    some, best = block.search(pairs, limit)
    keep = scores >= limit
    assert dict(zip(some.tolist(), best.tolist())) == dict(zip(every[keep].tolist(), scores[keep].tolist()))
    assert block.scored - whole < whole and len(block.search(pairs, int(block.bound[pairs].sum()) + 1)[0]) == 0
