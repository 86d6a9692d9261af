"""Clustering, lexical search and substring dedup against brute force and on odd rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanledger.llm import centroids, lexical, queries, substrings

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_clusters(rows, k, rounds, dim, scale=256, seed=2):
    x = {i: [math.floor(scale * c) for c in v] for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)}
    names = sorted(x, key=lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centers = [x[i] for i in names[:k]]
    gap = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    near = lambda v: min(range(len(centers)), key=lambda c: (gap(v, centers[c]), c))
    for _ in range(rounds):
        of = {i: near(v) for i, v in x.items()}
        for c in range(len(centers)):
            own = [x[i] for i in x if of[i] == c]
            if own:
                centers[c] = [sum(d) // len(own) for d in zip(*own, strict=True)]
    of = {i: near(v) for i, v in x.items()}
    return {i: (of[i], gap(x[i], centers[of[i]]), centers[of[i]]) for i in x}


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_clusters_against_brute_force(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    middles = rng.normal(size=(4, 8)) * 2
    rows = [(i, (middles[i % 4] + rng.normal(size=8) * spread).tolist()) for i in range(120)]
    rows += [(500, None), (501, [1.0] * 7), (502, [1.0] * 7 + [None]), (503, [float("nan")] * 8), (504, [1e300] * 8), (505, [-0.001] * 8), (506, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("cluster", F.lit("x"))
    got = {r.id: (r.cluster, r.distance, r.centroid) for r in centroids.cluster(df, k=6, rounds=3, dim=8, pivots=4).collect()}
    want = brute_clusters([r for r in rows if r[0] != 504], 6, 3, 8)
    assert got == want
    whole = centroids.cluster(df, k=6, rounds=3, dim=8, pivots=4).first()
    assert whole.inertia == sum(d for _, d, _ in want.values()) and whole.centroid_sha256 == hashlib.sha256(",".join(map(str, whole.centroid)).encode()).hexdigest()


def test_simplex_bounds_hold_and_few_are_compared_where_clusters_are_apart():
    rng = np.random.default_rng(1)
    middles = rng.integers(-3000, 3000, (12, 16))
    x = np.repeat(middles, 50, 0) + rng.integers(-40, 40, (600, 16))
    simplex = centroids.Simplex(middles[:7], 5)
    low, high = simplex.bounds(simplex.apexes(x), simplex.apexes(middles))
    exact = centroids.squared(x[:, None], middles[None])
    assert (low <= exact).all() and (exact <= high).all() and len(simplex.pivots) == 5
    for most, least_saved in ((5, 0.5), (12, 0.85)):  # more pivots, fewer centroids that are off their hyperplane
        simplex = centroids.Simplex(middles, most)
        best, gap, pairs = centroids.nearest(simplex, x, simplex.apexes(x), middles)
        assert (best == exact.argmin(1)).all() and (gap == exact.min(1)).all() and pairs < (1 - least_saved) * exact.size


def test_clusters_of_none_and_of_equal_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert centroids.cluster(none).collect() == [] and "centroid_sha256" in centroids.cluster(none).columns
    same = spark.createDataFrame([(i % 2, [0.5] * 64) for i in range(5)] + [(None, [0.5] * 64)], "vec_id bigint, embedding array<float>")
    assert {(r.cluster, r.distance, r.inertia) for r in centroids.cluster(same).collect()} == {(0, 0, 0)}


def brute_ranking(docs, items, k=10):
    words = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, w in words:
            tf, m = Counter(w), w and 10 + (90 * len(w) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            scores += [(-s, d is None, d or 0)] * (s > 0)
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("leaf", "held", "groups", "item_bytes"), [(16, 4 << 20, 2048, 1 << 20), (2, 3000, 5, 200), (1, 1, 1, 1)])
def test_ranking_against_brute_force(spark, monkeypatch, leaf, held, groups, item_bytes):
    for name, value in (("LEAF", leaf), ("BLOCK_BYTES", held), ("GROUPS", groups), ("ITEM_BYTES", item_bytes)):
        monkeypatch.setattr(lexical, name, value)
    rng = np.random.default_rng(leaf)
    word = lambda: f"W{int(rng.zipf(1.4)) % 90}é"
    docs = [(i, " ".join(word() for _ in range(int(rng.integers(0, 60))))) for i in range(150)]
    docs += [(200, None), (201, ""), (202, ".,;"), (None, docs[3][1]), (3, docs[3][1]), (4, docs[3][1]), (203, "long " * 30_000 + docs[5][1])]
    items = [(i, docs[i][1]) for i in range(0, 30, 3)] + [(90, None), (91, "nowhere"), (92, "--"), (0, docs[7][1]), (None, docs[9][1])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"score": F.lit(1), "item": F.lit("x")}).repartition(3)
    got = lexical.ranked(d, spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranking(docs, items)


def test_ball_tree_leaves_out_what_cannot_score():
    rng = np.random.default_rng(3)
    rows = [[(c, int(rng.integers(1, 1000))) for c in sorted(rng.choice(40, 6, replace=False) + 40 * (i % 5))] for i in range(400)]
    columns = list(range(10))
    tree = lexical.BallTree(lexical.Vectors(rows), lexical.groups_of([(0, columns), (1, list(range(10, 200)))], 200))
    best = lexical.Best(5)
    opened = tree.search(np.array(columns), best.least, lambda r, s: best.add(r.tolist(), s.tolist()))
    scores = sorted(((-sum(v for c, v in row if c < 10), False, i) for i, row in enumerate(rows)))[:5]
    assert best.kept == scores and opened < 200


def test_ranking_of_empty_tables(spark):
    none, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.ranked(none, items).collect() == [] and lexical.ranked(none, items.limit(0)).collect() == []


def brute_removal(docs, window):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode())):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        stays = [True] * len(w)
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                stays[i : i + window] = [False] * window
            seen.add(g)
        out.append((d, len(w), len(w) - sum(stays), " ".join(x for x, s in zip(w, stays, strict=True) if s)))
    return sorted(out, key=repr)


def brute_reach(docs, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    best, size = [0] * len(words), window
    while True:
        grams = Counter(tuple(w[i : i + size]) for _, w in words for i in range(len(w) - size + 1))
        hit = [any(grams[tuple(w[i : i + size])] > 1 for i in range(len(w) - size + 1)) for _, w in words]
        if not any(hit):
            return sorted((d, b) for (d, _), b in zip(words, best, strict=True))
        best, size = [size if h else b for h, b in zip(hit, best, strict=True)], 2 * size


@pytest.mark.parametrize(("window", "held", "bucket"), [(20, 4 << 20, 1 << 20), (4, 3000, 64), (3, 3000, 64)])
def test_substrings_against_brute_force(spark, monkeypatch, window, held, bucket):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", held)
    monkeypatch.setattr(substrings, "BUCKET_HASHES", bucket)
    rng = np.random.default_rng(window)
    text = lambda n: " ".join(f"w{int(x)}" for x in rng.integers(0, 25, n))
    shared = [text(70) for _ in range(4)]
    docs = [(i, text(int(rng.integers(0, 50))) + "\t" + shared[i % 4][int(rng.integers(0, 30)) :] + "\n\x0b" + text(5)) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "é x y"), (None, docs[1][1]), (7, docs[7][1]), (7, docs[8][1]), (103, "again " * 5000), (-5, shared[0])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"id": F.lit("x"), "block": F.lit(1)}).repartition(3)
    got = substrings.without_repeats(d, window=window)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_removal(docs, window)
    known = [r for r in docs if r[0] is not None and r[0] != 7]
    longest = substrings.longest_repeats(d.filter("doc_id <> 7"), window=window).collect()
    assert sorted(map(tuple, longest)) == brute_reach(known, window)


def test_substrings_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert substrings.without_repeats(none).collect() == [] and substrings.longest_repeats(none).collect() == []


def test_whole_results_of_the_queries(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, queries.op12_lexical_search(spark, SF).collect()), key=repr) == brute_ranking(docs, items)
    want = [(d, n, gone, hashlib.sha256(left.encode()).hexdigest()) for d, n, gone, left in brute_removal(docs, 20)]
    assert sorted(map(tuple, queries.op13_substring_dedup(spark, SF).collect())) == sorted(want)
