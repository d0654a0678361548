"""op8 where labels are larger than one chunk: all links, and what is stored and compared on the way."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pytest

from bankmart.llm import common
from bankmart.llm import embedding_dedup as D

from .test_tables_operators import brute_dedup, vectors


def clustered(rng, n, dim):
    """Vectors of all degrees of likeness, one large dense group and exact copies among them."""
    x = rng.normal(size=(n, dim))
    near = rng.integers(0, 20, n // 3)
    x[:n // 3] = x[near] + rng.normal(size=(n // 3, dim)) * rng.uniform(0, 0.5, (n // 3, 1))
    x[n // 3:n // 2] = x[0] + rng.normal(size=(n // 2 - n // 3, dim)) * 0.02
    x[n // 2:n // 2 + 30] = x[1]
    return x.astype(np.float32).astype(float)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_all_links_across_chunks(spark, kind):
    rng = np.random.default_rng(11)
    x = clustered(rng, 700, 8)
    label = rng.integers(0, 2, 700)
    label[:20] = 2                                             # one chunk alone
    links, root = brute_dedup(x, label)
    df = vectors(spark, x, label, [(5000, [1.0] * 5, 0), (5001, [2.0] * 5, 0), (5002, None, 1)])
    df = df.withColumn("embedding", df.embedding.cast(f"array<{kind}>"))
    got = {r.vec_id: r for r in D.embedding_near_dedup(df, block=30, blocks=2).collect()}
    assert len(got) == 703
    for i in range(700):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], root[i], root[i] == i)
    assert [(got[i].n_links, got[i].component_id) for i in (5000, 5001, 5002)] == [(1, 5000), (1, 5000), (0, 5002)]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "1"


def chunk(x, rows, copies):
    pdf = pd.DataFrame({"id": rows, "copies": copies[rows], "vector": [x[r].tobytes() for r in rows], "cell": rows % 3})
    data, id, n, begin = D.packed(pdf, "f8", x.shape[1])
    return D.Chunk(data, "f8", x.shape[1], id, n, begin)


@pytest.mark.parametrize("dim, threshold", [(3, 0.999), (8, 0.93), (64, 0.93), (8, 0.2)])
def test_meetings_of_chunks(monkeypatch, dim, threshold):
    monkeypatch.setattr(D, "CELL", 50)
    monkeypatch.setattr(D, "STRIP", 8)
    monkeypatch.setattr(D, "ROWS", 32)
    monkeypatch.setattr(D, "COLUMNS", 40)
    monkeypatch.setattr(D, "HELD", 100)
    rng = np.random.default_rng(dim)
    n, x, copies = 1500, clustered(rng, 1500, dim), rng.integers(1, 4, 1500)
    x += rng.normal(size=x.shape) * 1e-3                       # no exact copies
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    chunks = [chunk(x, rows, copies) for rows in np.array_split(rng.permutation(n), 3)]
    links, root = np.zeros(n, np.int64), np.arange(n)
    for i, a in enumerate(chunks):
        for b in chunks[i:]:
            found = D.Meeting(a, b, threshold).result()
            np.add.at(links, found["id"], found["links"])
            D._join(root, found["a"], found["b"])
            assert (found["a"] != found["b"]).sum() < len(a) + len(b)
    assert (links == near @ copies).all()
    expected = np.arange(n)
    D._join(expected, *np.nonzero(near))
    assert (root == expected).all()


def test_double_precision_decides():
    angle = np.arccos(0.93)
    x = np.array([[1.0, 0.0], *([np.cos(a), np.sin(a)] for a in (angle - 1e-8, angle + 1e-8))]) * 7
    own = chunk(x, np.arange(3), np.ones(3, np.int64))
    assert D.Meeting(own, own, 0.93).links[np.argsort(own.id)].tolist() == [1, 2, 1]


def test_few_pairs_are_compared(monkeypatch):
    monkeypatch.setattr(D, "CELL", 200)
    rng = np.random.default_rng(5)
    n, copies = 12_000, np.ones(24_000, np.int64)
    x = rng.normal(size=(60, 64))[rng.integers(0, 60, 2 * n)] + rng.normal(size=(2 * n, 64)) * 0.3
    far = x + 40 * np.sign(np.arange(2 * n) - n + 0.5)[:, None] * np.eye(64)[0]
    for vectors_, most in ((x, 0.5), (far, 0)):                # sixty groups in both chunks; far chunks
        a, b = chunk(vectors_, np.arange(n), copies), chunk(vectors_, np.arange(n, 2 * n), copies)
        assert D.Meeting(a, b, 0.93).compared <= most * n * n


def test_dedup_stores_little_more_than_the_vectors(spark, monkeypatch):
    """A vector is stored as itself and in its chunk, however many cells and blocks its label has."""
    paths, scratch = [], common.scratch
    monkeypatch.setattr(common, "scratch", lambda *a: paths.append(scratch(*a)) or paths[-1])
    x = np.random.default_rng(3).normal(size=(6000, 64))
    assert D.embedding_near_dedup(vectors(spark, x), block=250).count() == 6000
    held = sum(os.path.getsize(os.path.join(d, f)) for p in paths for d, _, files in os.walk(p.removeprefix("file:"))
               for f in files if f.endswith(".parquet"))
    assert 6000 * 64 * 4 < held < 4 * 6000 * 64 * 4
