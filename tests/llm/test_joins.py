"""Operators 7 and 8 and the connected components against brute force."""

import random

import numpy as np
from helpers import SF001, SF01, frame, groups, jaccard_groups, key, odd_rows, shingles

from pyspark.sql import functions as F

from adoptlens.llm import jaccard_join, vector_join
from adoptlens.llm.components import components
from adoptlens.llm.tables import stored


def compare_jaccard(docs, size, percent):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    component, n = jaccard_groups(rows, size, percent)
    want = sorted((key(i), k, c) for (i, _), k, c in zip(rows, n, component))
    assert sorted((r.doc, r.n, r.component) for r in jaccard_join.classes(docs, size, percent).collect()) == want


def test_odd_rows(spark):
    compare_jaccard(frame(spark), 4, 85)


def test_documents_with_tiny_limits(spark, monkeypatch):
    for name, value in {"BLOCK": 2, "WEIGHT": 150, "LEAF": 2, "CHILDREN": 2}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(40).collect()]
    rnd, rows = random.Random(4), []
    for k in range(120):  # near copies of a few texts, linked in chains
        words = base[k % 6][1].split()[:120]
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(30)}"
        rows.append((1000 + k, " ".join(words)))
    docs = frame(spark, [(i, t, "en", "s", 1) for i, t in base + rows])
    compare_jaccard(docs, 4, 85)
    compare_jaccard(docs, 5, 80)


def test_trees_find_what_pairs_show():
    rng = np.random.default_rng(2)
    sets = []
    for k in range(60):
        base = np.arange(k % 7 * 1000, k % 7 * 1000 + 40, dtype=np.uint64)
        drop = rng.choice(40, rng.integers(0, 5), replace=False)
        sets.append(np.unique(np.append(np.delete(base, drop), rng.integers(10**6, 10**7, rng.integers(0, 4)).astype(np.uint64))))

    def similar(a, b):
        both = len(np.intersect1d(a, b))
        return 100 * both >= 85 * (len(a) + len(b) - both)

    label = jaccard_join.linked(sets, None, 85)
    root = groups(60, [(i, j) for i in range(60) for j in range(i) if similar(sets[i], sets[j])])
    assert [[label[i] == label[j] for i in range(60)] for j in range(60)] == [[root[i] == root[j] for i in range(60)] for j in range(60)]
    left, right = sets[:25], sets[25:]
    label = jaccard_join.linked(left, right, 85)
    root = groups(60, [(i, j) for i in range(25) for j in range(25, 60) if similar(sets[i], sets[j])])
    assert [[label[i] == label[j] for i in range(60)] for j in range(60)] == [[root[i] == root[j] for i in range(60)] for j in range(60)]


def test_large_near_copies_are_not_pruned():
    rng = np.random.default_rng(5)
    held = np.unique(rng.integers(0, 1 << 63, 720_000).astype(np.uint64))
    sets = [held[:700_000], held[10_000:710_000]]
    for percent in (85, 80):
        assert jaccard_join.linked(sets, None, percent).tolist() == [0, 0]
        assert jaccard_join.linked(sets[:1], sets[1:], percent).tolist() == [0, 0]
        assert jaccard_join.linked([sets[0], held[300_000:]], None, percent).tolist() == [0, 1]


def test_keep_one_keeps_the_smallest_of_each_group(spark):
    docs = frame(spark).selectExpr("*", "'x' AS sig", "0 AS component")
    rows = [(r[0], r[1]) for r in odd_rows()]
    component, _ = jaccard_groups(rows, 5, 80)
    want = {(i, t) for (i, t), c in zip(rows, component) if key(i) == c}
    got = jaccard_join.keep_one(docs, 5, 80)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(want, key=str)


def watched(monkeypatch, module):
    """Rows that each call of the module's ``_links`` gets."""
    dealt, links = [], module._links

    def counted(tasks, *rest):
        dealt.append(tasks.count())
        return links(tasks, *rest)

    monkeypatch.setattr(module, "_links", counted)
    return dealt


def test_copies_of_sets_are_made_in_waves(spark, monkeypatch):
    for name, value in {"BLOCK": 2, "LEAF": 2, "CHILDREN": 2, "WAVE": 1}.items():
        monkeypatch.setattr(jaccard_join, name, value, raising=False)
    rnd, rows = random.Random(8), []
    for k in range(40):
        words = [f"w{i}" for i in range(120)]
        words[rnd.randrange(120)] = f"new{k}"
        rows.append((k, " ".join(words), "en", "s", 1))
    dealt = watched(monkeypatch, jaccard_join)
    compare_jaccard(frame(spark, rows), 4, 85)
    assert sum(dealt) > 600 and max(dealt) <= 5 * 40


def test_sets_that_share_a_passage_only_are_not_dealt(spark, monkeypatch):
    shared = " ".join(f"s{i}" for i in range(80))
    rows = [(k, " ".join(f"d{k}x{i}" for i in range(120)) + " " + shared, "en", "s", 1) for k in range(60)]
    rows += [(k + 60, text + " end", *rest) for k, text, *rest in rows[:2]]
    dealt = watched(monkeypatch, jaccard_join)
    compare_jaccard(frame(spark, rows), 5, 80)
    assert dealt == [4]


def test_empty_documents(spark):
    assert jaccard_join.classes(frame(spark, []), 4, 85).collect() == []
    assert jaccard_join.keep_one(frame(spark, []), 4, 85).collect() == []
    assert shingles("", 4) == frozenset()


VECTORS = "vec_id long, embedding array<float>, label int, n_links int"


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for label in (0, 1, 2):
        for _ in range(6):
            centre = rng.normal(size=16)
            for _ in range(12):
                rows.append((n, (centre + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.15])).tolist(), label, 0))
                n += 1
    same = rows[3][1]
    odd = [same, same, None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [x * 2 for x in same], same[:8]]
    rows += [(n + k, v, 0, 0) for k, v in enumerate(odd)]
    return rows + [(n + 50, same, None, 0), (n + 51, same, 1, 0), (None, same, 0, 0), (3, same, 0, 0)]


def compare_vectors(spark, rows, least):
    df = spark.createDataFrame(rows, VECTORS)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]

    def good(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    pairs = []
    for a, (_, v, la) in enumerate(rows):
        for b, (_, w, lb) in enumerate(rows[:a]):
            if la is not None and la == lb and good(v) and good(w) and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if v == w or x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    pairs.append((a, b))
    links = [0] * len(rows)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    root, low = groups(len(rows), pairs), {}
    for r, (i, _, _) in zip(root, rows):
        low[r] = min(low.get(r, key(None)), key(i))
    want = sorted((key(i), n, low[r]) for (i, _, _), n, r in zip(rows, links, root))
    assert sorted((r.vec, r.n_links, r.component) for r in vector_join.join(df, least).collect()) == want
    assert len(pairs) > 50


def test_vectors(spark):
    compare_vectors(spark, vectors(), 0.98)


def test_vectors_in_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK", 7)
    compare_vectors(spark, vectors(1), 0.98)
    monkeypatch.setattr(vector_join, "MOST_PIVOTS", 3)
    compare_vectors(spark, vectors(2), 0.9)


def test_vectors_in_many_waves(spark, monkeypatch):
    for name, value in {"BLOCK": 20, "WAVE": 1, "RINGS": 4, "SOME": 3, "RUN": 5}.items():
        monkeypatch.setattr(vector_join, name, value, raising=False)
    compare_vectors(spark, vectors(3), 0.9)
    monkeypatch.setattr(vector_join, "BLOCK_BYTES", 1000, raising=False)
    compare_vectors(spark, vectors(4), 0.98)


def test_copies_of_vectors_are_made_in_waves_and_not_kept(spark, monkeypatch):
    for name, value in {"BLOCK": 300, "WAVE": 1}.items():
        monkeypatch.setattr(vector_join, name, value, raising=False)
    kept, write = [], vector_join.stored

    def counted(df, name, **options):
        table = write(df, name, **options)
        kept.append(table.count() if "vector" in table.columns else 0)
        return table

    monkeypatch.setattr(vector_join, "stored", counted)
    dealt = watched(monkeypatch, vector_join)
    points = np.random.default_rng(7).normal(size=(3000, 16))
    rows = [(k, x.tolist(), 0, 0) for k, x in enumerate(points)] + [(3000, points[5].tolist(), 0, 0)]
    found = vector_join.join(spark.createDataFrame(rows, VECTORS), 0.98)
    assert {(r.vec, r.component) for r in found.where("n_links > 0").collect()} >= {(5, 5), (3000, 5)}
    assert sum(kept) == 3000 and sum(dealt) > 10 * 3000 and max(dealt) <= 6 * 3000


def test_every_label_of_some_size_gets_pivots(spark):
    def pivots(sf):
        rows = spark.read.parquet(f"{sf}/embeddings.parquet").selectExpr("vec_id AS vec", "label", "embedding AS vector", "true AS good")
        return {k: len(v) for k, v in vector_join._pivots(vector_join._classes(rows)).items()}

    assert pivots(SF01)
    rows = [(k, [float(x) for x in np.random.default_rng(k).normal(size=8)], 0 if k % 10 else 1, True) for k in range(4000)]
    found = vector_join._pivots(vector_join._classes(spark.createDataFrame(rows, "vec long, vector array<double>, label long, good boolean")))
    assert 20 <= found[0, 8].shape[0] <= 42 and 4 <= found[1, 8].shape[0] <= 18  # about 30 of 3600, 10 of 400


def test_clustered_vectors_are_compared_within_reach_only(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK", 64)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 32))
    rows = [(k, (centres[k % 40] + rng.normal(size=32) * 0.05).tolist(), 0, True) for k in range(2000)]
    classes = vector_join._classes(spark.createDataFrame(rows, "vec long, vector array<double>, label long, good boolean"))
    radius = float(np.sqrt(2 - 2 * 0.98))
    placed = stored(vector_join._blocks(vector_join._cells(classes, vector_join._pivots(classes), radius)), "cells")
    by = ["label", "size", "cell", "block", "other"]
    tasks = vector_join._tasks(placed, radius).groupBy(*by).agg(F.count_if("searches").alias("a"), F.count_if(~F.col("searches")).alias("b"))
    compared = tasks.agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    assert compared < 0.35 * 2000 * 2000 and placed.where("home").count() == 2000


def test_no_vectors(spark):
    assert vector_join.join(spark.createDataFrame([], VECTORS), 0.98).collect() == []


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(600, 700)]
    rest = [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)]
    links = chain + star + rest
    rnd.shuffle(links)
    df = spark.createDataFrame(links + [(7, 7), (None, 3), (4, None)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = sorted({x for p in links if p[0] != p[1] for x in p})
    at = {x: k for k, x in enumerate(nodes)}
    root = groups(len(nodes), [(at[a], at[b]) for a, b in links if a != b])
    low = {}
    for x, r in zip(nodes, root):
        low[r] = min(low.get(r, x), x)
    assert got == {x: low[r] for x, r in zip(nodes, root)}
    assert components(df.limit(0)).collect() == []
