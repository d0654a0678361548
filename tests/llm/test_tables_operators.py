"""Mixing, sharding, embedding operators and the pipeline against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bankmart.llm import ann_search as A
from bankmart.llm import embedding_dedup as D
from bankmart.llm import mixing as M
from bankmart.llm import queries as Q
from bankmart.llm import sharding as H
from bankmart.llm import common
from bankmart.llm.common import components
from bankmart.llm.secret_scan import redact, scan
from bankmart.llm.sql import ORACLE_SQL
from bankmart.llm.toxicity import fit_toxicity, score_toxicity

from .test_ngram_join import brute as brute_groups


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, sf, duck, name):
    df = Q.QUERIES[name](spark, sf)
    rel = duck.sql(ORACLE_SQL[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert Counter(tuple(r) for r in df.collect()) == Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_by_rounds_and_in_one_task(spark, monkeypatch):
    """Few edges are joined at once, with no rounds; many by rounds first, with the same result."""
    rng = random.Random(17)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    want = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(len(want)):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    frame = spark.createDataFrame(edges, "a long, b long")
    written = []
    monkeypatch.setattr(common, "stored", lambda df, name, *by, own=common.stored: (written.append(name), own(df, name, *by))[1])
    for few, count in ((1 << 16, 2), (40, None), (0, None)):
        monkeypatch.setattr(common, "FINISHED_EDGES", few)
        written.clear()
        assert {r.node: r.component for r in components(frame).collect()} == want
        assert count is None or len(written) == count


def water_level(sizes, shares=(3, 1, 2)):
    weight = np.array([shares[i % len(shares)] for i in range(len(sizes))], float)
    cap, target = 2.0 * np.array(sizes), np.zeros(len(sizes))
    free = np.ones(len(sizes), bool)
    while free.any():
        target[free] = (1.5 * sum(sizes) - cap[~free].sum()) * weight[free] / weight[free].sum()
        over = free & (target > cap)
        if not over.any():
            break
        free &= ~over
        target[~free] = cap[~free]
    return target


def test_mix_of_sources(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), ["a", "b", None, "\U0001f600", "￮"][0 if i % 3 else i % 5]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    weights = spark.createDataFrame([(i, 4.0) for i in range(0, 3000, 2)], "doc_id long, weight double")
    out = M.mix_sources(docs, weights).collect()
    again = M.mix_sources(docs.repartition(3), weights).collect()
    assert sorted(out, key=str) == sorted(again, key=str) and len(out) == 3000
    size, taken, target = Counter(), Counter(), {}
    for r in out:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size >= r.size and r.taken in (0, r.size, 2 * r.size)
    names = sorted((s for s in size if s is not None)) + [None]
    assert names[-3:-1] == ["￮", "\U0001f600"]                  # by code point
    assert np.allclose([target[s] for s in names], water_level([size[s] for s in names]))
    for s in names:
        assert abs(taken[s] - target[s]) <= 5
        # whole epochs come first: copies differ by one at most
        assert len({r.copies for r in out if r.source == s}) <= 2
    # heavier documents enter the fractional part more often
    part = [r for r in out if len({x.copies for x in out if x.source == r.source}) == 2]
    heavy = [r.copies for r in part if r.doc_id % 2 == 0]
    light = [r.copies for r in part if r.doc_id % 2]
    assert not part or np.mean(heavy) > np.mean(light)


def test_mix_rows(odd, none, spark):
    weights = spark.createDataFrame([(1, 2.0), (1, 3.0), (None, 1.0)], "doc_id long, weight double")
    out = M.mix_sources(odd, weights)
    assert out.count() == odd.count() and M.mix_sources(none, weights).count() == 0
    mixed = M.mixed_documents(odd, out)
    assert mixed.columns == odd.columns
    assert mixed.count() == out.agg(F.sum("copies")).first()[0]
    wordless = spark.createDataFrame([(1, "", "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert {(r.target, r.taken, r.copies) for r in M.mix_sources(wordless, weights).collect()} == {(0.0, 0, 0)}


def test_shards_hold_the_mixture(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source")))
    out = H.shard_documents(docs).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == {
        i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in texts.items()}
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    source = {r.doc_id: r.source for r in docs.collect()}
    total = Counter(source.values())
    mix = Counter((r.shard, source[r.doc_id]) for r in out)
    # a cut moves a source by the rounding of all sources' ranks at most
    assert all(abs(mix[k, s] - n / 16) <= 1 + n * len(total) / len(out) for s, n in total.items() for k in range(16))
    assert sorted(map(str, H.shard_documents(docs.repartition(3)).collect())) == sorted(map(str, out))


def test_shard_rows(odd, none, spark, tmp_path):
    out = H.shard_documents(odd, 3)
    rows = out.collect()
    assert len(rows) == odd.count() and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (3, 4)} == {(1, 0)}
    assert H.shard_documents(none).count() == 0
    H.write_shards(odd, out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    # its own columns of these names stay, the added ones get another name
    assert back.groupBy("shard_").count().count() == 3 and back.count() == odd.count()
    assert set(odd.columns) < set(back.columns) and {(r.shard, r.slot, r.size, r.nth) for r in back.collect()} == {
        ("t", 6, 4, 5)}


def vectors(spark, x, label=None, extra=()):
    rows = [(i, [float(v) for v in row], int(label[i]) if label is not None else 1) for i, row in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], "vec_id long, embedding array<float>, label int")


ODD_VECTORS = [
    (1000, None, 1), (1001, [0.0] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [1.0, None] + [0.0] * 6, 1),
    (1004, [], 1), (1005, [float("inf")] + [1.0] * 7, 1), (1006, [1.0] * 5, 1), (None, [1.0] * 8, 1),
    (1007, [1.0] * 8, None), (1008, [1e-30] * 8, 3), (1009, [1e30] * 8, 3), (1010, [2.0] * 8, 3), (1010, [2.0] * 8, 3)]


def brute_dedup(x, label, threshold=0.93):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= threshold) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    root = np.arange(len(x))
    while True:
        new = np.array([min(root[i], root[near[i]].min(initial=len(x))) for i in range(len(x))])
        if (new == root).all():
            return near.sum(1), root
        root = new


def test_all_links_of_embeddings(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[300:600] = x[0] + rng.normal(size=(300, 8)) * 0.45      # a large group of all degrees of likeness
    x[600:650] = x[1]                                          # exact copies
    x = x.astype(np.float32).astype(float)
    label = rng.integers(0, 3, 900)
    label[300:650] = 1
    links, root = brute_dedup(x, label)
    got = {r.vec_id: r for r in D.embedding_near_dedup(vectors(spark, x, label), block=100).collect()}
    assert len(got) == 900
    for i in range(900):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (links[i], root[i], root[i] == i)


def test_share_of_pairs_compared_falls_as_rows_grow():
    """At 1x, 4x and 16x the cells grow, and a smaller share of all pairs meets in a cell."""
    rng = np.random.default_rng(6)
    base, shares = rng.normal(size=(60, 8)), []
    for n in (5_000, 20_000, 80_000):
        x = base[rng.integers(0, 60, n)] + rng.normal(size=(n, 8)) * 0.3
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        cells = D.cells_for(n)
        centres = D.spherical_kmeans(x[:10_000], cells)
        near = x @ centres.T
        home = near.argmax(1)
        between = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        visits = near.max(1, keepdims=True) - near <= (np.sqrt(2 - 2 * 0.93) / 2 + 1e-9) * between[home]
        own = np.bincount(home, minlength=len(centres))
        shares.append((own * (own - 1) / 2 + own * (visits.sum(0) - own)).sum() / (n * (n - 1) / 2))
    assert D.cells_for(100) == 16 and shares[0] > shares[1] > shares[2]


def test_dedup_rows(spark):
    rows = D.embedding_near_dedup(vectors(spark, np.eye(8)[:2], extra=ODD_VECTORS)).collect()
    assert len(rows) == 2 + len(ODD_VECTORS)
    linked = {(r.vec_id, r.n_links, r.component_id) for r in rows if r.n_links}
    assert linked == {(1008, 3, 1008), (1009, 3, 1008), (1010, 3, 1008)}
    assert all(r.kept for r in rows if not r.n_links)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert D.embedding_near_dedup(empty).count() == 0


def index_block(code, x):
    return A.IndexBlock(code, x.shape[1], np.arange(len(x)).tobytes(), code.of(A.matrix([v.tobytes() for v in x])).tobytes(),
                        x.tobytes())


def test_every_code_within_the_radius_is_retrieved():
    rng = np.random.default_rng(0)
    directions = rng.normal(size=(24, 16 * 6))
    for near in (0, 1, 3):
        code = A.Code(directions, 6, near, 96)
        x = rng.normal(size=(3000, 24))
        x[::3] = x[0] + rng.normal(size=(1000, 24)) * rng.uniform(0, 1, (1000, 1))
        block = index_block(code, x)
        for q in range(0, 3000, 100):
            away = A.differing(block.codes[q], block.codes)
            got = set(block.retrieve(block.codes[q]).tolist())
            assert set(np.flatnonzero(away <= 6 * (near + 1) - 1).tolist()) <= got
            reach = np.bitwise_count(block.codes ^ block.codes[q]).min(1) <= near
            assert got == set(np.flatnonzero(reach).tolist())
    assert len(A.ball(3)) == len(set(A.ball(3).tolist())) == 697


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.1", "/root/testdata/sf0.01"])
def test_index_prunes_the_given_vectors(sf_dir):
    """Of the given table few vectors reach the float ranking, at a recall of 0.9 or more."""
    import duckdb

    rows = duckdb.sql(f"SELECT embedding FROM '{sf_dir}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.array([r[0] for r in rows], float)
    unit = A.matrix([v.tobytes() for v in x])
    block = index_block(A.fit_codes({x.shape[1]: unit})[x.shape[1]], x)
    hits, queries = 0, range(0, len(x), 50)
    for q in queries:
        score = unit @ unit[q]
        score[q] = -9
        best = np.lexsort((np.arange(len(x)), -score))[:5]
        rows, _ = block.search(q, unit[q], block.codes[q], 5, False)
        hits += len(set(rows.tolist()) & set(best.tolist()))
    assert hits / (5 * len(queries)) >= 0.9
    assert block.ranked / (len(x) * len(queries)) < 0.2
    print(sf_dir, "recall", hits / (5 * len(queries)), "retrieved", block.retrieved / (len(x) * len(queries)),
          "ranked", block.ranked / (len(x) * len(queries)))


def test_queries_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    whole = A.nearest_neighbours(vectors(spark, x), F.col("vec_id") % 7 == 0).collect()
    monkeypatch.setattr(A, "QUERY_BYTES", 2000)
    monkeypatch.setattr(A, "BLOCK_ROWS", 50)
    assert Counter(map(tuple, whole)) == Counter(map(tuple, A.nearest_neighbours(
        vectors(spark, x), F.col("vec_id") % 7 == 0).collect()))


def test_neighbours_have_high_recall(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2500, 32))
    x[::10] = x[0] + rng.normal(size=(250, 32)) * 0.1
    x[7::500] = x[7]                                           # exact copies
    x = x.astype(np.float32).astype(float)
    out = A.nearest_neighbours(vectors(spark, x), F.col("vec_id") % 50 == 0).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 2500, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = np.lexsort((np.arange(2500), -score))[:5]
        own = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert np.allclose([r.score for r in own], score[[r.vec_id for r in own]], atol=1e-12)
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits / 250 >= 0.9


def test_neighbour_rows(spark):
    rows = A.nearest_neighbours(vectors(spark, np.eye(8)[:2], extra=ODD_VECTORS), F.lit(True)).collect()
    asked = Counter(r.query_id for r in rows)
    # 0, 1, 1007 to 1010 take part with eight components; 1006 is alone with its five
    assert set(asked) == {0, 1, 1007, 1008, 1009, 1010} and set(asked.values()) == {5}
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert A.nearest_neighbours(empty, F.lit(True)).count() == 0


def test_pipeline_stages(spark, sf, texts):
    """Each stage against a plain version of it, on what its predecessor kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "secrets", "mixing", "encoding"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    labels = Q.table(spark, sf, "labels")
    clean = stages[0](spark, docs, sf)
    toxic = {r.doc_id for r in score_toxicity(docs, fit_toxicity(docs, labels)).where("predicted = 1").collect()}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(texts) - toxic
    single = stages[1](spark, clean, sf)
    left = {r.doc_id: r.text for r in clean.collect()}
    groups = brute_groups(left.items())
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in groups.items() if i == c}
    safe = stages[2](spark, single, sf)
    rows = {r.doc_id: r for r in safe.collect()}
    assert {i: r.text for i, r in rows.items()} == {i: redact(texts[i], scan(texts[i])) for i in rows}
    mixed = stages[3](spark, safe, sf)
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for i, r in rows.items()}
    copies = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and max(copies.values()) <= 2
    total = sum(words[i] * n for i, n in copies.items())
    assert math.isclose(total, 1.5 * sum(words.values()), rel_tol=0.05)
    encoded = stages[4](spark, mixed, sf).collect()
    assert Counter(r.doc_id for r in encoded) == copies
    assert corpus_pipeline.run(spark, sf).count() == len(encoded)
