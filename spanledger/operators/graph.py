"""Edges between statements: validity, cycles, parents, adjudication."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; unlike dropDuplicates, which one is stated."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def within(*tables: DataFrame) -> list[str]:
    """doc_id, if all tables have it: then ids hold within a document."""
    return ["doc_id"] if all("doc_id" in t.columns for t in tables) else []


def valid_edges(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """Edges (src, dst, ...) both of whose ends are nodes, of the same document where both tables name it."""
    keys = within(edges, nodes)
    ids = nodes.select(*keys, F.col(node).alias("id")).distinct()
    end = lambda name: ids.withColumnRenamed("id", name)
    return edges.join(end("src"), [*keys, "src"], "left_semi").join(end("dst"), [*keys, "dst"], "left_semi")


def edge_failures(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """Edges with their failure: a missing end, a loop, or no evidence (a warning). Ends are looked for as in valid_edges."""
    keys = within(edges, nodes)
    ids = nodes.select(*keys, F.col(node).alias("id")).distinct()
    end = lambda name: ids.withColumnRenamed("id", name).withColumn(f"has_{name}", F.lit(True))
    t = edges.join(end("src"), [*keys, "src"], "left").join(end("dst"), [*keys, "dst"], "left")
    why = F.when(F.col("has_src").isNull(), "missing_source").when(F.col("has_dst").isNull(), "missing_target").when(F.col("src") == F.col("dst"), "self_loop")
    if "evidence" in edges.columns:
        why = why.when(F.coalesce(F.trim("evidence"), F.lit("")) == "", "empty_evidence")
    return t.withColumn("failure", why).filter("failure IS NOT NULL").drop("has_src", "has_dst")


def numbered_edges(edges: DataFrame) -> DataFrame:
    """Edges numbered anew within their document, in the order of seq and rel_id."""
    w = Window.partitionBy("doc_id").orderBy("seq", "rel_id")
    return edges.withColumn("rel_id", F.format_string("E%04d", F.row_number().over(w)))


def by_merge(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: of many small rounds, each broadcast would stay in the driver for a while."""
    return df.hint("merge")


def peeled(edges: DataFrame, rounds: int, enough: int = 0) -> tuple[DataFrame, int]:
    """edges without those whose source has no incoming or whose target no outgoing one, until little is left to peel or enough edges or fewer are left, and their number."""
    core, before = edges, None
    for turn in range(rounds + 1):
        n = core.count()
        if turn == rounds or n <= enough or before is not None and n > 0.9 * before:
            break
        before = n
        core = cut(core.join(by_merge(core.select(F.col("dst").alias("src")).distinct()), "src", "left_semi").join(by_merge(core.select(F.col("src").alias("dst")).distinct()), "dst", "left_semi").select("src", "dst"))
    return core, n


def leapt(edges: DataFrame, n: int, enough: int) -> tuple[DataFrame, int]:
    """Of n edges (src, dst), one from each source, those between nodes that steps of doubling length still come to, and their number.

    Nodes of cycles are always come to, others are left behind: after k rounds the rest stands 2^k - 1 steps behind some
    node, after as many rounds as the logarithm of the longest tail cycles alone are left. Ends with enough nodes or fewer.
    """
    step = edges
    while True:
        met = step.select(F.col("dst").alias("src")).distinct()
        here = step.join(by_merge(met), "src", "left_semi")
        step = cut(here.join(by_merge(step.select(F.col("src").alias("dst"), F.col("dst").alias("far"))), "dst").select("src", F.col("far").alias("dst")))
        left = step.count()
        if left <= enough or left == n:
            break
        n = left
    ends = step.select("src")
    core = cut(edges.join(by_merge(ends), "src", "left_semi").join(by_merge(ends.withColumnRenamed("src", "dst")), "dst", "left_semi").select("src", "dst"))
    return core, core.count()


def spread(state: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """state (node, colour): each node takes the greatest colour that reaches it along edges (src, dst)."""
    for _ in range(rounds):
        sent = edges.join(by_merge(state), edges["src"] == state["node"]).select(F.col("dst").alias("node"), "colour")
        new = cut(state.unionByName(sent).groupBy("node").agg(F.max("colour").alias("colour")))
        moved = new.join(by_merge(state), ["node", "colour"], "left_anti").head(1)
        state = new
        if not moved:
            return state
    raise RuntimeError(f"colours did not settle in {rounds} rounds")


def closed(core: DataFrame) -> DataFrame:
    """Edges of core whose target reaches their source, by paths that double in length each round: few rounds, but pairs of nodes."""
    reach, before = core, None
    while (n := reach.count()) != before:
        before = n
        more = reach.alias("a").join(reach.alias("b"), F.col("a.dst") == F.col("b.src")).select("a.src", "b.dst")
        reach = cut(reach.union(more).distinct())
    return core.join(reach.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi")


#: Edges of a core up to which paths are doubled; a core has at most as many nodes.
DOUBLED = 1000

def knotted(core: DataFrame, rounds: int) -> DataFrame:
    """Edges (src, dst) of a core that lie on a cycle, loops left out. A small core is closed by doubling. Of a large one,
    every node takes the greatest node that reaches it; those of a colour that also reach the colour's own node form a
    part with it and leave, until nothing is left: a row per edge and round, as many rounds as the longest shortest path."""
    found, every = [], core
    while n := core.count():
        if n <= DOUBLED:
            found.append(closed(core))
            break
        nodes = core.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
        colours = spread(nodes.withColumn("colour", F.col("node")), core, rounds)
        end = lambda c, colour: colours.select(F.col("node").alias(c), F.col("colour").alias(colour))
        same = core.join(by_merge(end("src", "colour")), "src").join(by_merge(end("dst", "other")), "dst").filter("colour = other")
        same = cut(same.select("src", "dst", "colour"))
        # backwards from the colour's own node, within the colour
        back = same.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        roots = same.select(F.col("colour").alias("node")).distinct().withColumn("colour", F.lit(1))
        gone = spread(roots, back, rounds).select("node")
        inside = lambda df, how: df.join(by_merge(gone.withColumnRenamed("node", "src")), "src", how).join(by_merge(gone.withColumnRenamed("node", "dst")), "dst", how)  # noqa: E731, B023
        found.append(cut(inside(same, "left_semi").select("src", "dst")))
        core, _ = peeled(cut(inside(core, "left_anti").select("src", "dst")), 64)
    out = every.limit(0)
    for part in found:
        out = out.unionByName(part)
    return out


def merged(edges: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """One round of contraction of edges (id, src, dst): nodes all of whose edges lead to one other node, and whose coin
    says so, merge into it. Returns the nodes (node, into) and the edges left, among them loops."""
    coin = lambda c: F.pmod(F.xxhash64(c, F.lit(turn)), F.lit(2)) == 0
    only = edges.groupBy("src").agg(F.min("dst").alias("into"), F.max("dst").alias("other"))
    only = only.filter((F.col("into") == F.col("other")) & (F.col("into") != F.col("src")) & coin("src") & ~coin("into"))
    nodes = cut(only.select(F.col("src").alias("node"), "into"))
    left = edges.join(by_merge(nodes.select(F.col("node").alias("src"))), "src", "left_anti")
    left = left.join(by_merge(nodes.select(F.col("node").alias("dst"), "into")), "dst", "left")
    return nodes, cut(left.select("id", "src", F.coalesce("into", "dst").alias("dst")))


#: Edges of a connected part up to which it is searched as one group.
PART = 10_000


def strong(part: pa.Table) -> pa.Table:
    """Of the edges (a, b) of one part those that lie on a cycle: two searches, forwards and, in falling order of their ends, backwards."""
    rows = list(zip(part["a"].to_pylist(), part["b"].to_pylist(), strict=True))
    out, into, order, seen, root = {}, {}, [], set(), {}
    for a, b in rows:
        out.setdefault(a, []).append(b)
        into.setdefault(b, []).append(a)
    for first in out:
        todo = [] if first in seen else [(first, iter(out[first]))]
        seen.add(first)
        while todo:
            node, rest = todo[-1]
            further = next((n for n in rest if n not in seen), None)
            if further is None:
                order.append(todo.pop()[0])
            else:
                seen.add(further)
                todo.append((further, iter(out.get(further, ()))))
    for first in reversed(order):
        todo = [first]
        while todo:
            node = todo.pop()
            if node not in root:
                root[node] = first
                todo.extend(into.get(node, ()))
    return part.filter(pa.array([root[a] == root[b] for a, b in rows], pa.bool_())).select(["src", "dst"])


def small_parts(core: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst) of core that lie on a cycle of a connected part of most edges or fewer, and the edges of larger parts."""
    parts = joined_parts(core)
    told = cut(core.join(by_merge(parts.withColumnRenamed("node", "src")), "src").select("src", "dst", "part"))
    sizes = told.groupBy("part").agg((F.count(F.lit(1)) <= most).alias("small"))
    told = cut(told.join(by_merge(sizes), "part"))
    return searched(told.filter("small")), told.filter("NOT small").select("src", "dst")


def searched(edges: DataFrame) -> DataFrame:
    """Edges (part, src, dst) that lie on a cycle, each part searched as a group."""
    name = lambda c: F.to_json(F.struct(F.col(c).alias("node")))
    groups = edges.select("part", "src", "dst", name("src").alias("a"), name("dst").alias("b")).groupBy("part")
    return cut(groups.applyInArrow(strong, edges.select("src", "dst").schema))


def cycle_edges(edges: DataFrame, rounds: int = 10_000, turns: int = 200) -> DataFrame:
    """Edges (src, dst) that lie on a cycle, loops included: those inside a strongly connected part.

    What cannot lie on a cycle is peeled off, by steps of doubling length where every node has one way out. PART edges or
    fewer are searched as one group; if more are left, connected parts of up to PART edges each as
    a group, in as many rounds as it takes to find the parts. While the rest is large, nodes with one way out merge into where it leads:
    an edge to such a node lies on a cycle just if it does so afterwards, and the node's own edge if any edge to it does.
    So long rings shrink by a share each round. What has no such nodes goes to knotted; then the merges are undone.
    """
    all_edges = cut(edges.select("src", "dst").distinct())
    found, core = all_edges.filter("src = dst"), all_edges.filter("src <> dst")
    n, sources = core.agg(F.count(F.lit(1)), F.countDistinct("src")).first()
    if n > PART:
        core, n = leapt(core, n, PART) if n == sources else peeled(core, 64, PART)
    if n == 0:
        return found
    if n <= PART:
        return found.unionByName(searched(core.withColumn("part", F.lit(0))))
    if n > DOUBLED:
        known, core = small_parts(core, PART)
        found, n = found.unionByName(known), core.count()
        if n == 0:
            return found
    core, steps, on = core.withColumn("id", F.struct("src", "dst")), [], []
    for turn in range(turns):
        if n <= DOUBLED:
            break
        nodes, left = merged(core, turn)
        if nodes.count() < n // 100:
            break
        steps.append((core, nodes))
        on.append(left.filter("src = dst").select("id"))
        core = left.filter("src <> dst")
        n = core.count()
    now = knotted(cut(core.select("src", "dst").distinct()), rounds)
    known = core.join(by_merge(now), ["src", "dst"], "left_semi").select("id")
    for part in on:
        known = known.unionByName(part)
    for before, nodes in reversed(steps):
        into = before.join(by_merge(known), "id", "left_semi").select(F.col("dst").alias("node")).distinct()
        back = before.join(by_merge(nodes.join(by_merge(into), "node", "left_semi").select(F.col("node").alias("src"))), "src", "left_semi")
        known = cut(known.unionByName(back.select("id")))
    return found.unionByName(known.distinct().select("id.src", "id.dst"))


def joined_parts(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, part: the least node of its connected part, whatever the direction of edges (src, dst).

    Each round, every node and the node that it points to take the least node that a neighbour's pointer points to, and
    pointers are doubled; parts that are long need few more rounds than short ones.
    """
    both = cut(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    state = cut(both.select(F.col("src").alias("node")).distinct().withColumn("part", F.col("node")))
    for _ in range(rounds):
        far = state.alias("a").join(by_merge(state.alias("b")), F.col("a.part") == F.col("b.node")).select("a.node", "a.part", F.col("b.part").alias("far"))
        near = both.join(by_merge(far.select(F.col("node").alias("dst"), "far")), "dst").groupBy("src").agg(F.min("far").alias("far"))
        near = cut(near.join(by_merge(state.withColumnRenamed("node", "src")), "src").select("src", "part", "far"))
        told = near.select(F.col("src").alias("node"), "far").union(near.select("part", "far")).union(far.select("node", "far"))
        new = cut(told.groupBy("node").agg(F.min("far").alias("part")))
        if not new.join(by_merge(state), ["node", "part"], "left_anti").head(1):
            return new
        state = new
    raise RuntimeError(f"parts did not settle in {rounds} rounds")


def cycle_paths(edges: DataFrame) -> DataFrame:
    """cycle, at, node: of each strongly connected part of edges (src, dst) one cycle, from its least node on.

    Every node leads on to its least neighbour within the part; the cycle is the one that the part's least node comes to.
    Steps double each round, so a ring of n nodes takes about twice log2(n) joins; a cycle is as many rows as nodes.
    """
    on = cut(cycle_edges(edges))
    parts = joined_parts(on)
    step = cut(on.groupBy("src").agg(F.min("dst").alias("dst")))
    longest = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    here = parts.select("part", F.col("part").alias("node")).distinct()
    jumps = []
    for _ in range(longest.bit_length()):  # 1 + 2 + 4 ... steps are as many as there are nodes
        jumps.append(step)
        here = cut(here.join(by_merge(step), F.col("node") == F.col("src")).select("part", F.col("dst").alias("node")))
        far = step.select(F.col("src").alias("dst"), F.col("dst").alias("far"))
        step = cut(step.join(by_merge(far), "dst").select("src", F.col("far").alias("dst")))
    met = here.withColumn("at", F.lit(0).cast("bigint"))
    for k, jump in enumerate(jumps):
        more = met.join(by_merge(jump), F.col("node") == F.col("src")).select("part", F.col("dst").alias("node"), (F.col("at") + (1 << k)).alias("at"))
        met = cut(met.unionByName(more).groupBy("part", "node").agg(F.min("at").alias("at")))
    low = met.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "at")).alias("low"))
    t = met.join(by_merge(low), "part")
    return t.select(F.col("low.node").alias("cycle"), F.pmod(F.col("at") - F.col("low.at"), F.col("n")).alias("at"), "node")


def document_cycles(edges: DataFrame, kinds: tuple[str, ...] = ("refines", "composed_of")) -> DataFrame:
    """doc_id, type, cycle, at, node: a cycle of every strongly connected part of each document's edges of a kind."""
    node = lambda c: F.struct("doc_id", "type", F.col(c).alias("id")).alias(c)
    paths = cycle_paths(edges.filter(F.col("type").isin(*kinds)).select(node("src"), node("dst")))
    return paths.select("node.doc_id", "node.type", F.col("cycle.id").alias("cycle"), "at", F.col("node.id").alias("node"))


def shared_folder(df: DataFrame) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, a temporary one is set in local mode alone: on a cluster, executors would not share it."""
    import tempfile

    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage by a checkpoint in the shared folder."""
    shared_folder(df)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df as Parquet beside the checkpoints: for wide rows that are read again by few columns. What it took to make them is shuffled files that nobody reads again; they go with it."""
    import uuid

    path, conf, clean = f"{shared_folder(df)}/stored-{uuid.uuid4().hex}", df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(clean, "false")
    conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(clean, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark_cycles(edges: DataFrame, kinds: tuple[str, ...] = ("refines", "composed_of"), note: str = " [cycle]") -> DataFrame:
    """edges (src, dst, type, evidence, ambiguous) with those on a cycle of their kind ambiguous and noted, once however often it runs. Where the edges name a document, ids hold within it."""
    keys, out = within(edges), edges
    for kind in kinds:
        of = edges.filter(F.col("type") == kind)
        if keys:
            node = lambda c: F.struct("doc_id", F.col(c).alias("id")).alias(c)
            hit = cycle_edges(of.select(node("src"), node("dst"))).select(F.col("src.doc_id").alias("doc_id"), F.col("src.id").alias("src"), F.col("dst.id").alias("dst"))
        else:
            hit = cycle_edges(of)
        hit = hit.withColumn("type", F.lit(kind)).withColumn("hit", F.lit(True))
        out = out.join(hit, [*keys, "src", "dst", "type"], "left")
        noted = F.when(F.endswith("evidence", F.lit(note)), F.col("evidence")).otherwise(F.concat(F.coalesce("evidence", F.lit("")), F.lit(note)))
        out = out.withColumn("evidence", F.when(F.col("hit"), noted).otherwise(F.col("evidence")))
        out = out.withColumn("ambiguous", F.col("ambiguous") | F.coalesce("hit", F.lit(False))).drop("hit")
    return out.select(*edges.columns)


def parent_chains(rows: DataFrame, key: str, node: str, parent: str, name: str, rounds: int = 20) -> DataFrame:
    """key, node, chain: names from the root down to the node's parent, "(top-level)" if it has none.

    Pointers double in each round, so a chain of 2^20 ends; a cycle ends too, with the names met once.
    """
    t = rows.select(key, node, F.col(parent).alias("up"), F.array(F.col(name)).alias("names"))
    state = t
    for _ in range(rounds):
        if not state.filter("up IS NOT NULL").head(1):
            break
        above = state.select(key, F.col(node).alias("up"), F.col("up").alias("next"), F.col("names").alias("above"))
        state = state.join(above, [key, "up"], "left")
        looped = F.size(F.array_intersect("above", "names")) > 0
        state = cut(state.select(key, node, F.when(~F.coalesce(looped, F.lit(False)), F.col("next")).alias("up"), F.when(F.col("above").isNull() | looped, F.col("names")).otherwise(F.concat("above", "names")).alias("names")))
    chain = F.slice("names", F.lit(1), F.size("names") - 1)
    return state.select(key, node, F.when(F.size(chain) > 0, F.array_join(chain, " > ")).otherwise("(top-level)").alias("chain"))


def scoped_counts(edges: DataFrame) -> DataFrame:
    """scope, type, src_doc, dst_doc, n: three groupings of edges in one pass."""
    return edges.groupingSets([["scope"], ["type"], ["src_doc", "dst_doc"]], "scope", "type", "src_doc", "dst_doc").agg(F.count(F.lit(1)).alias("n"))
