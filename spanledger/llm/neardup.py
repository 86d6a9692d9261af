"""MinHash near-duplicates with odd sketches, confirmed on full shingle sets.

1. One pass over the texts gives each document its number of shingles, a digest of its set, band keys and an odd
   sketch: MinHash samples folded into parity bits, so that the XOR of two sketches counts the samples that differ.
2. Documents of one digest are one node. Nodes that share a band key are candidates: in small buckets pairs whose
   sketches could still mean the wanted similarity are linked; a bucket above BUCKET is linked to its least node as it
   stands. Both only widen the groups within which step 3 looks.
3. Each candidate group is solved exactly on the full sets. A large group is cut into chunks that are solved each with
   the same few pivots; then all that did not join the largest part is held against every chunk.
4. Components take the smallest document id.

There are as many bands as it takes for a pair at the threshold to share no key with probability MISS at most.

Defined cases: null or empty texts, or without words, have an empty set and are linked with nothing; very long texts are
cut and compared whole; fewer words than a shingle are one shingle; ids may be of any type with an order (numbers, texts,
dates); null ids come after all others (a group of null ids only has the component null); ties, that is equal sets, are
one class; documents that repeat an id are judged by their own text, and the class takes the id; an empty table gives no
rows; other columns, whatever their names, are not used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, checkpoint, fresh, hot_join, slices, table_bound
from .components import Linked, components

WORDS, PERCENT = 5, 80
ROWS, BITS, MISS = 5, 512, 1e-6
#: Nodes of a bucket that are compared with each other; above, the bucket is one candidate group.
BUCKET = 512
#: Nodes and shingles of a group, or chunk, that one task solves.
GROUP_NODES, GROUP_SHINGLES = 750, 1_000_000
PIVOTS = 16
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
LEFT = np.array([0, *((1 << 8 * k) - 1 for k in range(1, 8)), 2**64 - 1], np.uint64)
SIGNATURE = "struct<n:bigint,node:binary,bands:array<bigint>,sketch:binary>"


class Scheme:
    """What the texts are cut into, the wanted similarity, and the hash functions that follow from it."""

    def __init__(self, words: int, percent: int):
        self.words, self.percent = words, percent
        self.bands = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS)) if percent < 100 else 1
        self.samples = self.bands * ROWS
        rng = np.random.default_rng(20)
        self.multiply = (rng.integers(0, 2**31, self.samples, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.flip = rng.integers(0, 2**32, self.samples, dtype=np.uint32)

    def differ_at_most(self) -> int:
        """Sketch bits that differ, beyond which no pair of the wanted similarity is expected: its mean and 5.5 deviations."""
        far = 1 - self.percent / 100
        differ = self.samples * far + 5.5 * math.sqrt(self.samples * far * (1 - far)) + 2
        return math.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * differ)) + 8)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each word; data has eight bytes to spare at its end."""
    out = np.zeros(len(start), np.uint64)
    for lo in range(0, len(start), 500_000):
        at, size = start[lo : lo + 500_000], (end - start)[lo : lo + 500_000]
        h, left, lane = mixed(size.astype(np.uint64)), np.arange(len(at)), 0
        while len(left):
            eight = np.ascontiguousarray(data[(at[left] + lane)[:, None] + np.arange(8)]).view(np.uint64)[:, 0]
            h[left] = mixed(h[left] * np.uint64(0x9E3779B97F4A7C15) + (eight & LEFT[np.minimum(size[left] - lane, 8)]))
            lane += 8
            left = left[size[left] > lane]
        out[lo : lo + 500_000] = h
    return out


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    lowered = [(t or b"").translate(LOWER) for t in texts]
    data = np.frombuffer(b" ".join([b"", *lowered, b" " * 8]), np.uint8)
    word = np.append(~SPACES[data], False)
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(~word[1:] & word[:-1]) + 1
    hashes = word_hashes(data, start, end)
    first = np.searchsorted(start, np.cumsum([1, *(len(t) + 1 for t in lowered)]))
    rolled = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j in range(words):
        rolled = mixed(rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + len(rolled)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            s = np.sort(rolled[a : b - words + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif b > a:
            out.append(np.array([int.from_bytes(xxhash.xxh64_digest(hashes[a:b].tobytes()))], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and odd sketches of sets that are not empty."""
    start = np.cumsum([0, *(len(s) for s in sets[:-1])])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    samples = np.stack([np.minimum.reduceat((x ^ f) * m, start) for m, f in zip(scheme.multiply, scheme.flip, strict=True)], 1)
    keys = np.tile(np.arange(1, scheme.bands + 1, dtype=np.uint64), (len(sets), 1))
    for j in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + samples[:, j::ROWS])
    bit = mixed(samples.astype(np.uint64) * np.uint64(scheme.samples) + np.arange(scheme.samples, dtype=np.uint64)) % np.uint64(BITS)
    odd = np.bincount((bit.astype(np.int64) + BITS * np.arange(len(sets))[:, None]).ravel(), minlength=BITS * len(sets)) & 1
    return keys.view(np.int64), np.packbits(odd.astype(bool).reshape(len(sets), BITS), axis=1)


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sign(scheme: Scheme) -> Callable:
    kind = pa.struct([("n", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            out = []
            for held in slices(texts, 1 << 20):
                sets = shingle_sets(held, scheme.words)
                full = [s for s in sets if len(s)]
                signed = iter(zip(*signatures(full, scheme), strict=True)) if full else iter(())
                for s in sets:
                    bands, sketch = next(signed) if len(s) else (None, None)
                    out.append({"n": len(s), "node": digest(s) if len(s) else None, "bands": bands, "sketch": sketch.tobytes() if len(s) else None})
            yield pa.array(out, kind)

    return run


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by keys, one table each."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not len(table):
            continue
        change = np.zeros(len(table) - 1, bool)
        for k in keys:
            v = table[k].to_numpy(zero_copy_only=False) if table.num_rows else np.array([])
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(cuts[-1])
    if held is not None and len(held):
        yield held


def labels(linked: np.ndarray) -> np.ndarray:
    """The least index that each row reaches in a symmetric matrix."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


#: Nodes that a task keeps linked before it sends them on.
KEPT = 200_000


def sketch_links(scheme: Scheme) -> Callable:
    """Links of each bucket's nodes to the least one that their sketches lead to; a wide bucket's nodes to its least one."""
    most, percent = scheme.differ_at_most(), scheme.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked = Linked()
        for table in grouped(batches, "key", "salt"):
            nodes = table["node"].to_pylist()
            if table["many"][0].as_py() > BUCKET:
                low = table["low"][0].as_py()
                for x in nodes:
                    linked.join(x, low)
            else:
                n = table["n"].to_numpy()
                bits = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(len(nodes), -1)
                differ = sum(np.bitwise_count(bits[:, None, j] ^ bits[None, :, j]).astype(np.int64) for j in range(bits.shape[1]))
                sized = 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
                for i, r in enumerate(labels((differ <= most) & sized).tolist()):
                    if i != r:
                        linked.join(nodes[i], nodes[r])
            if len(linked.up) > KEPT:
                yield told(linked)
                linked = Linked()
        yield told(linked)

    return run


def told(linked: Linked) -> pa.RecordBatch:
    pairs = linked.links()
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.binary()), pa.array([b for _, b in pairs], pa.binary())], ["a", "b"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 blocks over the shingles that two or more sets hold."""
    values, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    keep = count[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.int64)
    for lo in range(0, int(shared[-1]) + 1 if len(shared) else 0, 4096):
        a, b = np.searchsorted(column, [lo, lo + 4096])
        block = np.zeros((len(sets), 4096), np.float32)
        block[row[a:b], column[a:b] - lo] = 1
        out += np.rint(block @ block.T).astype(np.int64)
    return out


def solve(scheme: Scheme, *keys: str) -> Callable:
    """Confirmed classes of each group: (node, root, least_id) for the nodes of a class of two or more, root being its least node, least_id its least id.

    Rows of one part belong together from the start; then (part, other) says, beside that, which parts a class joins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, *keys):
            parts = table["part"].to_pylist() if "part" in table.column_names else [None] * len(table)
            sets = [s for held in slices(table["text"].combine_chunks(), 1 << 20) for s in shingle_sets(held, scheme.words)]
            rows = {node: (s, part) for node, s, part in zip(table["node"].to_pylist(), sets, parts, strict=True) if len(s) and digest(s) == node}
            nodes = sorted(rows)
            if len(nodes) < 2:
                continue
            place = {x: i for i, x in enumerate(nodes)}
            size = np.array([len(rows[x][0]) for x in nodes])
            both = overlaps([rows[x][0] for x in nodes])
            linked = 100 * both >= scheme.percent * (size[:, None] + size[None, :] - both)
            part = [rows[x][1] for x in nodes]
            first: dict = {}
            for i, p in enumerate(part):
                j = first.setdefault(p if p is not None else ("own", i), i)
                linked[i, j] = linked[j, i] = True
            root = labels(linked).tolist()
            many = np.bincount(root, minlength=len(root))
            least: dict = {}
            for node, own in zip(table["node"].to_pylist(), table["own"].to_pylist(), strict=True):
                if own is not None and node in rows:
                    r = root[place[node]]
                    least[r] = min(least.get(r, own), own)
            out = [(nodes[i], nodes[r], part[i], part[r], least.get(r)) for i, r in enumerate(root) if many[r] > 1]
            if out:
                kinds = [pa.binary()] * 4 + [table.schema.field("own").type]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], ["node", "root", "part", "other", "least_id"])

    return run


def in_groups(rows: DataFrame, solver: Callable, schema: str, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(solver, schema)


def classes_of(rows: DataFrame, scheme: Scheme, *keys: str) -> DataFrame:
    """node, root, part, other, least_id of the groups of rows."""
    return in_groups(rows, solve(scheme, *keys), f"node binary, root binary, part binary, other binary, least_id {rows.schema['own'].dataType.simpleString()}", *keys)


def candidate_groups(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """node, root of nodes that may have a link. Buckets are counted before their rows are dealt, wide ones over many tasks."""
    keyed = nodes.select(F.explode("bands").alias("key"), "node")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("low")).filter(F.col("many") > 1)
    salt = F.when(F.col("many") > BUCKET, F.pmod(F.xxhash64("node"), F.ceil(F.col("many") / BUCKET))).otherwise(0)
    held = keyed.join(shared, "key").withColumn("salt", salt).join(nodes.select("node", "n", "sketch"), "node")
    return components(in_groups(held, sketch_links(scheme), "a binary, b binary", "key", "salt"))


def exact_classes(docs: DataFrame, nodes: DataFrame, scheme: Scheme, *, id_col: str, text_col: str) -> DataFrame:
    """node, least_id: the least id of its class by confirmed links, for nodes that have one."""
    members = checkpoint(nodes.select("node", "n", "rep").join(candidate_groups(nodes, scheme), "node"))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("shingles"))
    heavy = F.when(F.col("shingles") > GROUP_SHINGLES, F.ceil(F.col("shingles") * 2 / GROUP_SHINGLES)).otherwise(1)
    chunks = F.greatest(F.ceil(F.col("many") / GROUP_NODES), heavy).cast("bigint")
    cut = table_bound(checkpoint(sizes.select("root", chunks.alias("chunks")).filter("chunks > 1")))  # roots of large groups are few but hot
    members = checkpoint(members.join(cut, "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("bigint"))))
    small = table_bound(members.select("root", "node", "n", "chunks", F.col("rep.id").alias("rep_id"), F.col("rep.text_key").alias("text_key")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).withColumn("text_key", F.unhex(F.md5("text")))
    one = texts.join(small, (texts["id"].eqNullSafe(small["rep_id"])) & (texts["text_key"] == small["text_key"])).select("root", "node", "n", "chunks", F.col("rep_id").alias("own"), "text")
    few = classes_of(one.filter(F.col("chunks") == 1).select("root", "node", "own", "text"), scheme, "root").select("node", "least_id")
    if not members.filter(F.col("chunks") > 1).head(1):
        return few
    large = checkpoint(one.filter(F.col("chunks") > 1))
    of = large.select("node", "own").join(large_classes(large, scheme), "node")
    return few.union(of.join(of.groupBy("root").agg(F.min("own").alias("least_id")), "root").select("node", "least_id"))


def pivots_of(large: DataFrame) -> DataFrame:
    """The rows of large that every chunk of their group gets: of a chunk's nodes about one in 46, and always the group's node of least hash, a light one where there is any."""
    of = F.xxhash64("node", F.lit(1))
    sure = large.groupBy("root").agg(F.min_by("node", F.struct(F.col("n") * 8 > GROUP_SHINGLES, of)).alias("node"))
    sure = table_bound(checkpoint(sure.select("node", F.lit(True).alias("sure"))))
    drawn = F.pmod(of, F.col("chunks") * max(1, GROUP_NODES // PIVOTS)) == 0
    return large.join(sure, "node", "left").filter(drawn | F.col("sure")).drop("sure")


def large_classes(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """node, root of groups (root, node, n, chunks, own, text) of more than one chunk: the chunks with the same few pivots each, then what did not join the largest part, in pieces of as many nodes and shingles, against every chunk."""
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    large = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    pivots = pivots_of(large).withColumn("chunk", numbers)
    first = large.unionByName(pivots).select("root", "node", "own", "text", "chunk")
    found = classes_of(first, scheme, "root", "chunk").select(F.col("node").alias("a"), F.col("root").alias("b"))
    parts = components(found).withColumnRenamed("root", "part")
    cut = checkpoint(large.drop("text", "own").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node")))
    counted = cut.groupBy("root", "part").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("n"))
    main = counted.groupBy("root").agg(F.max(F.struct("many", "part", "n")).alias("main"), F.sum("many").alias("all"), F.sum("n").alias("all_n"))
    nodes, shingles = F.col("all") - F.col("main.many"), F.col("all_n") - F.col("main.n")
    pieces = F.greatest(F.ceil(nodes / GROUP_NODES), F.ceil(shingles * 2 / GROUP_SHINGLES)).cast("bigint")
    main = checkpoint(main.filter(nodes > 0).select("root", F.col("main.part").alias("main"), pieces.alias("pieces")))
    if not main.head(1):
        return parts.select("node", F.col("part").alias("root"))
    told = large.select("node", "own", "text").join(cut.join(table_bound(main), "root"), "node").withColumn("piece", F.pmod(F.xxhash64("node", F.lit(2)), F.col("pieces")))
    left = told.filter(F.col("part") != F.col("main")).withColumn("chunk", numbers)
    right = told.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))
    columns = ["root", "chunk", "piece", "node", "own", "part", "text"]
    last = classes_of(left.select(columns).unionByName(right.select(columns)), scheme, "root", "chunk", "piece")
    joins = checkpoint(last.filter(F.col("part") != F.col("other")).select(F.col("part").alias("a"), F.col("other").alias("b")).distinct())
    if not joins.head(1):
        return cut.select("node", F.col("part").alias("root"))
    merged = components(joins).select(F.col("node").alias("part"), F.col("root").alias("whole"))
    return cut.join(merged, "part", "left").select("node", F.coalesce("whole", "part").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id, text_key, n_shingles, component_id, kept: one row per document."""
    scheme = Scheme(words, percent)
    raw = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    signed = raw.select("id", F.unhex(F.md5(F.coalesce("text", F.lit(b"")))).alias("text_key"), arrow(sign(scheme), SIGNATURE)("text").alias("s"))
    signed = checkpoint(signed.select("id", "text_key", "s.*"))
    some = signed.filter(F.col("n") > 0)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "n", "bands", "sketch")).alias("m")
    once = some.groupBy("node").agg(least)
    nodes = checkpoint(once.select("node", "m.n", F.struct("m.id", "m.text_key").alias("rep"), "m.bands", "m.sketch"))
    classes = exact_classes(docs, nodes, scheme, id_col=id_col, text_col=text_col)
    own = nodes.select("node", F.col("rep.id").alias("own"))
    of_node = checkpoint(own.join(classes, "node", "left").select("node", F.coalesce("least_id", "own").alias("component_id")))
    full = hot_join(some.select("id", "text_key", "n", "node"), of_node, "node").select("id", "text_key", "n", "component_id")
    empty = signed.filter(F.col("n") == 0).select("id", "text_key", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).select("id", "text_key", F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each group; of rows that repeat id and text, one."""
    found = checkpoint(near_duplicates(docs, id_col=id_col, text_col=text_col, words=words, percent=percent))
    told = found.groupBy("id", "text_key").agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("many")).filter(~F.col("stays") | (F.col("many") > 1))
    key, rest = fresh(docs, "dedup_key"), fresh(docs, "dedup_stays")
    told = table_bound(checkpoint(told.select(F.col("id").alias(key + "_id"), F.col("text_key").alias(key), F.col("stays").alias(rest))))
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    joined = keyed.join(told, F.col(id_col).eqNullSafe(F.col(key + "_id")) & (keyed[key] == told[key]), "left").select(*(keyed[c] for c in docs.columns), keyed[key], told[rest])
    single = joined.filter(F.col(rest).isNull()).select(docs.columns)
    again = joined.filter(F.col(rest)).dropDuplicates([id_col, key]).select(docs.columns)
    return single.unionByName(again)
