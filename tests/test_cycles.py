"""Cycles by contraction and as paths, against plain walks."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.operators import graph


def reach(edges):
    """For each node the nodes that it leads to, by plain search."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    found = {}
    for n in {x for e in edges for x in e}:
        seen, todo = set(), [n]
        while todo:
            for m in out.get(todo.pop(), ()):
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        found[n] = seen
    return found


def parts_of(edges):
    leads = reach(edges)
    return {min(x for x in leads[n] if n in leads[x]) for n in leads if n in leads[n]}


def check_paths(rows, edges):
    """Each path is closed, simple and starts at its least node; there is one per strongly connected part."""
    paths, leads = {}, reach(edges)
    for r in rows:
        paths.setdefault(r.cycle, {})[r.at] = r.node
    for first, at in paths.items():
        nodes = [at[i] for i in range(len(at))]
        assert nodes[0] == first == min(nodes) and len(set(nodes)) == len(nodes)
        assert all((a, b) in edges for a, b in zip(nodes, nodes[1:] + nodes[:1], strict=True))
    assert sorted(min(x for x in leads[n] if n in leads[x]) for n in paths) == sorted(parts_of(edges))


@pytest.mark.parametrize(("seed", "doubled"), [(1, 1000), (2, 12)])
def test_cycles_of_random_graphs(spark, monkeypatch, seed, doubled):
    monkeypatch.setattr(graph, "DOUBLED", doubled)
    rng = random.Random(seed)
    edges = {(rng.randrange(20), rng.randrange(20)) for _ in range(24)} | {(100 + i, 100 + (i + 1) % 9) for i in range(9)} | {(100, 5), (200, 201)}
    d = spark.createDataFrame(sorted(edges), "src int, dst int").coalesce(1)
    leads = reach(edges)
    want = sorted(e for e in edges if e[0] in leads[e[1]] or e[0] == e[1])
    assert sorted(tuple(r) for r in graph.cycle_edges(d).collect()) == want
    check_paths(graph.cycle_paths(d).collect(), edges)


def test_small_parts_are_searched_in_few_rounds(spark, monkeypatch):
    """Parts within the bound are told apart from larger ones, and many small rings need no contraction and no broadcast."""
    monkeypatch.setattr(graph, "DOUBLED", 50)
    monkeypatch.setattr(graph, "PART", 12)
    monkeypatch.setattr(graph, "merged", None)
    rings = spark.range(0, 400, 1, 1).select(F.struct((F.col("id") / 10).cast("int").alias("doc"), (F.col("id") % 10).alias("n")).alias("src"))
    rings = rings.select("src", F.struct("src.doc", ((F.col("src.n") + 1) % 10).alias("n")).alias("dst"))
    broken = rings.filter("NOT (src.doc % 4 = 0 AND src.n = 9)")
    assert graph.cycle_edges(broken).count() == 300
    core = broken.filter("src.doc < 3").union(broken.filter("src.doc = 1").selectExpr("dst", "src")).coalesce(1)
    known, left = graph.small_parts(core, 12)
    assert {r[0] for r in known.select("src.doc").collect()} == {2} and {r[0] for r in left.select("src.doc").collect()} == {1}
    assert "Broadcast" not in graph.by_merge(core).join(graph.by_merge(known), ["src", "dst"])._jdf.queryExecution().executedPlan().toString()


def test_no_cycles(spark):
    d = spark.createDataFrame([(1, 2), (2, 3)], "src int, dst int")
    assert graph.cycle_edges(d).collect() == [] and graph.cycle_paths(d).collect() == [] and graph.cycle_paths(d.limit(0)).collect() == []


def test_a_ring_takes_few_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "DOUBLED", 50)
    cuts = []
    plain = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: cuts.append(1) or plain(df))
    n = 200
    ring = spark.range(0, n, 1, 1).select(((F.col("id") * 7919) % n).alias("src"), (((F.col("id") + 1) * 7919) % n).alias("dst"))
    assert graph.cycle_edges(ring).count() == n
    assert len(cuts) < 40  # two a round of contraction, one a round of doubling and of undoing


def test_document_cycles(spark):
    kind = "doc_id int, type string, src string, dst string"
    rows = [(d, t, a, b) for d, t in ((1, "refines"), (1, "composed_of"), (2, "refines")) for a, b in (("R1", "R2"), ("R2", "R1"), ("R2", "R3"))] + [(2, "refines", "R3", "R1"), (3, "refines", "R1", "R2"), (4, "refines", "R2", "R1"), (3, "references", "R2", "R1")]
    got = {}
    for r in graph.document_cycles(spark.createDataFrame(rows, kind)).orderBy("at").collect():
        got.setdefault((r.doc_id, r.type, r.cycle), []).append(r.node)
    assert got == {(1, "refines", "R1"): ["R1", "R2"], (1, "composed_of", "R1"): ["R1", "R2"], (2, "refines", "R1"): ["R1", "R2"]}


@pytest.mark.parametrize("bound", [0, 25])
def test_nodes_with_one_way_out_are_left_behind_by_doubling(spark, monkeypatch, bound):
    """A tail of 300 nodes takes rounds by its logarithm, and neither a search for parts nor a contraction."""
    monkeypatch.setattr(graph, "PART", bound)
    monkeypatch.setattr(graph, "DOUBLED", 0)
    monkeypatch.setattr(graph, "peeled", None)
    rng = random.Random(3)
    ring = [(i, (i + 1) % 20) for i in range(20)]
    edges = ring + [(20 + i, 19 + i) for i in range(300)] + [(1000 + i, rng.randrange(1000, 1200)) for i in range(200)] + [(2000, 3000)]
    d = spark.createDataFrame(edges, "src int, dst int").coalesce(1)
    core, n = graph.leapt(d.filter("src <> dst"), len([1 for a, b in edges if a != b]), bound)
    leads = reach(edges)
    want = sorted(e for e in edges if e[0] in leads[e[1]] or e[0] == e[1])
    on = sorted(e for e in want if e[0] != e[1])
    got = sorted(tuple(r) for r in core.collect())
    assert n == len(got) and set(on) <= set(got) and (got == on or n <= bound)
    if bound:
        monkeypatch.setattr(graph, "joined_parts", None)
        monkeypatch.setattr(graph, "PART", max(bound, n))
        cuts = []
        plain = graph.cut
        monkeypatch.setattr(graph, "cut", lambda df: cuts.append(1) or plain(df))
        assert sorted(tuple(r) for r in graph.cycle_edges(d).collect()) == want
        assert len(cuts) < 14


def test_a_small_rest_is_one_group(spark, monkeypatch):
    """No parts are looked for where all that is left is within the bound of one."""
    monkeypatch.setattr(graph, "joined_parts", None)
    monkeypatch.setattr(graph, "DOUBLED", 50)
    rng = random.Random(4)
    edges = {(rng.randrange(60), rng.randrange(60)) for _ in range(90)}
    leads = reach(edges)
    d = spark.createDataFrame(sorted(edges), "src int, dst int").coalesce(1)
    assert sorted(tuple(r) for r in graph.cycle_edges(d).collect()) == sorted(e for e in edges if e[0] in leads[e[1]] or e[0] == e[1])


@pytest.mark.parametrize("seed", [5, 6])
def test_cycles_without_groups(spark, monkeypatch, seed):
    """Contraction and colouring still find the same where no part is small enough for a group."""
    monkeypatch.setattr(graph, "PART", 0)
    monkeypatch.setattr(graph, "DOUBLED", 10)
    rng = random.Random(seed)
    edges = {(rng.randrange(15), rng.randrange(15)) for _ in range(26)} | {(100 + i, 100 + (i + 1) % 12) for i in range(12)}
    leads = reach(edges)
    d = spark.createDataFrame(sorted(edges), "src int, dst int").coalesce(1)
    assert sorted(tuple(r) for r in graph.cycle_edges(d).collect()) == sorted(e for e in edges if e[0] in leads[e[1]] or e[0] == e[1])
