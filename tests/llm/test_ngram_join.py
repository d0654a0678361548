"""N-gram Jaccard join against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from bankmart.llm import ngram_join as N

_ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_ASCII))
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute(rows, percent=80):
    """doc_id -> (set size, smallest doc_id reachable) of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += j < i
        for j, c in common.items():
            if c and 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_jaccard_join(df).collect()}


def test_whole_table(spark, sf, texts):
    assert result(spark.read.parquet(f"{sf}/documents.parquet")) == brute(texts.items())


def test_copies_near_copies_and_common_passages(spark):
    """A large group of near copies of all degrees, a passage and a line that most documents share."""
    rng = random.Random(5)
    word = lambda: "w%d" % rng.randrange(10**6)
    base, passage, line = ([word() for _ in range(n)] for n in (120, 70, 9))
    rows = []
    for i in range(260):
        copy = list(base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9, 20])):
            copy[rng.randrange(len(copy))] = word()
        rows.append(copy)
    rows += [line + passage + [word() for _ in range(rng.randrange(5, 400))] for _ in range(150)]
    rows += [line + [word() for _ in range(rng.randrange(0, 12))] for _ in range(60)]
    rows += [passage + [word() for _ in range(rng.randrange(0, 40))] for _ in range(60)]
    rng.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 150 and len(set(want.values())) < len(rows) - 100
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == want


def test_longer_versions(spark):
    """Texts of 20 to 1,000 shingles and versions that are longer by 15 to 25 %, by new words at either end
    or inside, with passages that several texts share."""
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randrange(10**7)
    passages = [[word() for _ in range(rng.randrange(8, 60))] for _ in range(40)]
    rows = []
    for _ in range(420):
        text = [word() for _ in range(rng.choice([24, 30, 45, 70, 110, 180, 300, 500, 1000]))]
        at = rng.randrange(len(text))
        if rng.random() < 0.5:
            text[at:at] = rng.choice(passages)
        more = [word() for _ in range(int(len(text) * rng.uniform(0.15, 0.25)))]
        at = rng.choice([0, len(text), rng.randrange(len(text))])
        rows += [text, text[:at] + more + text[at:]]
    rng.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    want = brute(rows)
    assert 150 < sum(c != i for i, (_, c) in want.items()) < 420
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == want


def test_reach_of_a_prefix():
    """A shingle within the reach of a set is in the prefix of every linked partner that has it."""
    rng = np.random.default_rng(3)
    for n in (1, 5, 16, 20, 60, 300, 1000):
        overlap, sizes, reach = N._reaches(n, 80)
        assert sizes[-1] == n * 100 // 80 and (np.diff(reach) <= 0).all()
        for b in range(n, n * 100 // 80 + 1, max(1, n // 40)):
            cell = int(np.argmax(sizes >= b))
            common = -(-80 * (n + b) // 180)
            assert overlap[cell] <= common
            for worst in (True, False):
                own = np.sort(rng.permutation(10**6)[:n] + 10**6)
                kept = own[-common:] if worst else np.sort(rng.choice(own, common, replace=False))
                other = np.append(kept, rng.permutation(10**6)[:b - common] if worst
                                  else rng.permutation(10**6)[:b - common] + 2 * 10**6)
                prefix = set(np.sort(other)[:N._prefix(b, 80)].tolist())
                assert all(x in prefix for x in own[:max(0, reach[cell])].tolist() if x in set(kept.tolist()))


def made_cluster(count, rng):
    base = rng.choice(10**6, 90, replace=False)
    sets = []
    for _ in range(count):
        x = base.copy()
        x[rng.choice(90, rng.integers(0, 25), replace=False)] = rng.integers(0, 60, 1) + 10**7
        sets.append(np.unique(np.append(x, rng.integers(2 * 10**6, 2 * 10**6 + 40, rng.integers(0, 9)))).astype(np.uint64))
    return sets


def roots(count, edges):
    label = list(range(count))
    for a, b in edges:
        label = [label[a] if x == label[b] else x for x in label]
    groups = defaultdict(list)
    for i, x in enumerate(label):
        groups[x].append(i)
    return sorted(groups.values())


@pytest.mark.parametrize("count", [1, 2, 3, 40, 300])
def test_forest_of_a_cluster(count):
    """Bounds and derived answers connect the same sets as plain intersections; every edge is a link."""
    for seed in range(6):
        rng = np.random.default_rng(seed)
        sets = made_cluster(count, rng)
        if seed % 2:                      # several families with a common part
            sets = [np.unique(np.append(s, 3 * 10**7 + i % 5 * 100 + np.arange(rng.integers(10, 60)))).astype(np.uint64)
                    for i, s in enumerate(sets)]
        plain = [set(s.tolist()) for s in sets]
        links = [(i, j) for i in range(count) for j in range(i)
                 if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])]
        edges, _ = N.linked_forest(sets, 80)
        assert {(max(e), min(e)) for e in edges} <= set(links) and len(edges) < count
        assert roots(count, edges) == roots(count, links)


def test_answers_are_derived_from_similar_sets():
    sets = made_cluster(200, np.random.default_rng(4))
    plain = [set(s.tolist()) for s in sets]
    answers, work = N.Answers(sets, 80), []
    for a in range(200):
        before = answers.read
        assert answers.of(a).tolist() == [len(plain[a] & p) for p in plain]
        work.append(answers.read - before)
    assert max(work[20:]) < work[0] and sum(work[20:]) / 180 < work[0] / 2


def test_large_clusters_by_rounds(spark, monkeypatch):
    """Parts of few sets: groups of near copies are connected across parts, separate families stay apart."""
    monkeypatch.setattr(N, "PART_SETS", 16)
    rng = random.Random(12)
    word = lambda: "w%d" % rng.randrange(10**6)
    rows = []
    for family in range(4):
        base = [word() for _ in range(160)] if family != 1 else rows[0].split()[:120] + [word() for _ in range(40)]
        for _ in range(110):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows = list(enumerate(rows))
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_sets_sent_grow_with_the_group(spark, monkeypatch):
    """Near copies of one text: what the parts of their cluster read grows in proportion."""
    monkeypatch.setattr(N, "PART_SETS", 32)
    seen = {}
    for count in (200, 400, 800):
        rng = random.Random(13)
        word = lambda: "w%d" % rng.randrange(10**6)
        base, rows = [word() for _ in range(150)], []
        for i in range(count):
            copy = list(base)
            for _ in range(1):
                copy[rng.randrange(150)] = word()
            rows.append((i, " ".join(copy)))
        sent = []
        monkeypatch.setattr(N, "_meet", lambda members, asked, percent, *keys, own=N._meet: (
            sent.append(members.count() + asked.count()), own(members, asked, percent, *keys))[1])
        got = result(spark.createDataFrame(rows, "doc_id long, text string"))
        monkeypatch.undo()
        monkeypatch.setattr(N, "PART_SETS", 32)
        assert got == brute(rows)
        seen[count] = sum(sent)
    assert seen[800] <= 5 * max(seen[200], 200) and seen[400] <= 3 * max(seen[200], 200)


def test_workers_need_no_installed_copy(sf):
    """Run from another folder, where no worker can import the library."""
    import os
    import subprocess
    import sys
    import tempfile
    from pathlib import Path

    root = str(Path(N.__file__).resolve().parents[2])
    code = f"""
import sys
sys.path.insert(0, {root!r})
from bankmart.session import local_session
from bankmart.llm import queries as Q
spark = local_session(2)
def alone(batches):
    for b in batches:
        try:
            import bankmart
            raise SystemExit("importable")
        except ModuleNotFoundError:
            yield b
spark.range(1).mapInArrow(alone, "id long").count()
for name in ("op1_ngram_jaccard_join", "op6_sentencepiece", "op10_ann_search", "op11_whitening", "op13_ranked_search"):
    print(name, Q.QUERIES[name](spark, {sf!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="elsewhere-"), env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "op13_ranked_search 400" in done.stdout, done.stderr[-2000:]


def test_odd_rows(odd):
    rows = N.ngram_jaccard_join(odd).select("doc_id", "n_shingles", "component_id").collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    n = 60_000 - 4
    assert got == sorted([(1, 9, 1), (2, 9, 1), (2, 9, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6),
                          (None, 8, None), (8, n, 8), (9, n + 1, 8), (10, 1, 10), (11, 1, 11), (11, 2, 11)], key=str)


def test_one_of_each_group(odd, none):
    kept = N.one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, 6, None, 8, 10, 11, 11], key=str)
    named = odd.withColumns({"join_digest": F.lit("x"), "size": F.lit(7), "nth": F.lit("y")})
    assert {(r.digest, r.join_digest, r.size) for r in N.one_of_each_group(named).collect()} == {(1, "x", 7)}
    assert N.ngram_jaccard_join(none).count() == 0 and N.one_of_each_group(none).count() == 0
