"""Nearest neighbours by inner product, with cross-polytope hashing.

A table turns unit vectors by three rounds of random signs and a fast Hadamard transform and takes the nearest signed
axis as the bucket. As vectors grow in number, a second, lower cross-polytope of its own turn is joined to the first, so
that a bucket keeps about BUCKET vectors. A query probes the buckets whose axes it is nearest to, by the sum over both
polytopes, in each of TABLES tables; the vectors met there are ranked exactly, in double precision, on the original
values. Vectors of unequal length are split into bands, each of lengths within a factor STEP, so that in a band the
largest inner product is nearly the nearest direction; a query asks every band, and bands of at most EXACT vectors are
ranked exactly, unhashed. A query that met fewer than k vectors is ranked exactly against all.

Each vector is moved once per table, to the part of its bucket (about BLOCK vectors); each query is moved once per part
and brings the least sum that it still probes. Parts above BLOCK rows, as of one vector repeated, are cut in blocks;
nothing is capped.

Defined cases: null ids, and vectors that are null, empty, zero or hold null or non-finite components, take no part;
vectors of different dimension do not meet; vectors of any finite size are scaled for hashing and ranking, and a score
beyond double precision is infinite; ties go to the smaller id; rows that share an id count as one (a pair's score is the
larger); a query is never its own neighbour; with fewer than k candidates all are returned; an empty table gives no rows;
other columns, whatever their names, are not used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow, checkpoint, table_bound
from .neardup import grouped

TABLES, PROBES, BUCKET, BLOCK = 2, 1.0, 400, 8192
#: The share of buckets that a query probes is PROBES * n ** -FALL: the nearest of many vectors are nearer than those of few.
FALL = 0.105
STEP, EXACT = 1.25, 4096
UNHASHED = -1
KEYS = ["dim", "band", "table", "part", "block", "query_block"]


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast transform of each row; the length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), -1, 2, h)
        x, h = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n), 2 * h
    return x / math.sqrt(n)


class Polytopes:
    """The hash tables for so many vectors of one dimension."""

    def __init__(self, dim: int, n: int, tables: int, probes: float, seed: int):
        self.wide, self.tables, self.seed = 1 << max(0, dim - 1).bit_length(), tables, seed
        self.axes, self.second = 2 * self.wide, 1
        while 2 * self.second <= self.axes and n >= 2 * BUCKET * self.axes * self.second:
            self.second *= 2
        self.buckets = self.axes * self.second
        self.probed = min(self.buckets, math.ceil(self.buckets * probes * max(n, 1) ** -FALL))
        self.parts = math.ceil(n / BLOCK)

    def nearness(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """How near each row is to the signed axes of both polytopes; the second's are 0 where there is none."""
        rng, out = np.random.default_rng([self.seed, table]), []
        x = np.zeros((len(vectors), self.wide))
        unit = vectors / np.abs(vectors).max(1, keepdims=True)
        x[:, : vectors.shape[1]] = unit / np.linalg.norm(unit, axis=1, keepdims=True)
        for axes in (self.axes, self.second):
            turned = x
            for _ in range(3):
                turned = hadamard(turned * rng.choice([-1.0, 1.0], self.wide))
            out.append(np.stack([turned, -turned], 2).reshape(len(x), -1)[:, :axes] if axes > 1 else np.zeros((len(x), 1)))
        return out[0], out[1]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        both = [self.nearness(vectors, t) for t in range(self.tables)]
        return np.stack([a.argmax(1) * self.second + b.argmax(1) for a, b in both], 1)

    def least(self, vectors: np.ndarray) -> np.ndarray:
        """The nearness of the farthest bucket that each row probes, by table."""
        out = np.full((len(vectors), self.tables), -np.inf)
        if self.probed < self.buckets:
            for t in range(self.tables):
                a, b = self.nearness(vectors, t)
                for i in range(len(vectors)):
                    out[i, t] = np.partition((a[i][:, None] + b[i]).ravel(), self.buckets - self.probed)[self.buckets - self.probed]
        return out

    def probes(self, vectors: np.ndarray, table: int, code: np.ndarray) -> np.ndarray:
        """The nearness of each row to each of the buckets."""
        a, b = self.nearness(vectors, table)
        return a[:, code // self.second] + b[:, code % self.second]


def bands(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Bands of length, 0 the longest; longest: the logarithm of the greatest length."""
    most = np.abs(vectors).max(1)
    return np.floor(np.maximum(0, longest - np.log(most) - np.log(np.linalg.norm(vectors / most[:, None], axis=1))) / math.log(STEP)).astype(np.int64)


#: By dimension: the logarithm of the greatest length (none if all are equal), and the tables of each hashed band.
Plan = dict[int, tuple[float | None, dict[int, Polytopes]]]


def by_dimension(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each dimension and their vectors."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False)
    start, flat = np.cumsum(size) - size, vectors.flatten().to_numpy(zero_copy_only=False)
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield at, flat[start[at][:, None] + np.arange(dim)]


def placed(plan: Plan, narrow: bool) -> Callable:
    """Of each stored vector its bytes, its band and its bucket in each table."""
    kind = pa.struct([("vector", pa.binary()), ("band", pa.int64()), ("codes", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in parts:
            out: list = [None] * len(vectors)
            for at, x in by_dimension(vectors):
                longest, tables = plan[x.shape[1]]
                band = bands(x, longest) if longest is not None else np.zeros(len(x), np.int64)
                codes: list = [[UNHASHED]] * len(x)
                for b, p in tables.items():
                    here = np.flatnonzero(band == b)
                    for i, c in zip(here, p.codes(x[here]).tolist() if len(here) else [], strict=True):
                        codes[i] = c
                for i, v, b, c in zip(at, x.astype(np.float32) if narrow else x, band.tolist(), codes, strict=True):
                    out[i] = {"vector": v.tobytes(), "band": b if b in tables else UNHASHED, "codes": c}
            yield pa.array(out, kind)

    return run


def asking(plan: Plan, narrow: bool) -> Callable:
    """Of each query its bytes and, for each band and table, the least nearness that it probes and the number of parts."""
    kind = pa.struct([("vector", pa.binary()), ("asks", pa.list_(pa.struct([("band", pa.int64()), ("table", pa.int64()), ("least", pa.float64()), ("parts", pa.int64())])))])

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in parts:
            out: list = [None] * len(vectors)
            for at, x in by_dimension(vectors):
                longest, tables = plan[x.shape[1]]
                asks: list = [[] for _ in at]
                for b, p in tables.items():
                    for own, least in zip(asks, p.least(x).tolist(), strict=True):
                        own += [{"band": b, "table": t, "least": z, "parts": p.parts} for t, z in enumerate(least)]
                if longest is not None or not tables:
                    for own in asks:
                        own.append({"band": UNHASHED, "table": 0, "least": None, "parts": 1})
                for i, v, own in zip(at, x.astype(np.float32) if narrow else x, asks, strict=True):
                    out[i] = {"vector": v.tobytes(), "asks": own}
            yield pa.array(out, kind)

    return run


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed in an order that depends on the dimension alone, so that equal vectors tie."""
    return np.ascontiguousarray(query * vectors).sum(-1)


def scale(x: np.ndarray) -> int:
    """The power of two by which x is divided, so that products neither overflow nor vanish; 0 for ordinary values."""
    most = float(np.abs(x).max())
    return 0 if 1e-100 < most < 1e100 else math.frexp(most)[1]


def nearest(k: int, plan: Plan, narrow: bool) -> Callable:
    """The k nearest of each query within a block, among the buckets that it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, *KEYS):
            asks = group["asks"].to_numpy(zero_copy_only=False).astype(bool)
            ids = group["id"].to_numpy()
            x = np.frombuffer(b"".join(group["vector"].to_pylist()), np.float32 if narrow else np.float64).reshape(len(group), -1).astype(np.float64)
            order = np.argsort(group["code"].to_numpy()[~asks], kind="stable")
            qid, q, vid, v = ids[asks], x[asks], ids[~asks][order], x[~asks][order]
            if not len(qid) or not len(vid):
                continue
            up_q, up_v = scale(q), scale(v)
            q, v = np.ldexp(q, -up_q), np.ldexp(v, -up_v)
            code, first = np.unique(group["code"].to_numpy()[~asks][order], return_index=True)
            table, tables = group["table"][0].as_py(), plan[x.shape[1]][1].get(group["band"][0].as_py())
            least = group["least"].to_numpy(zero_copy_only=False)[asks]
            found: list[tuple] = []
            for lo in range(0, len(qid), 256):
                own = q[lo : lo + 256]
                if tables is None:
                    score = own @ v.T
                else:
                    score, probed = np.full((len(own), len(v)), -np.inf), tables.probes(own, table, code) >= least[lo : lo + 256, None]
                    for c, (a, b) in enumerate(zip(first, [*first[1:], len(v)], strict=True)):
                        at = np.flatnonzero(probed[:, c])
                        score[at, a:b] = own[at] @ v[a:b].T
                score[qid[lo : lo + 256, None] == vid[None, :]] = -np.inf
                most = min(k, len(vid))
                last = np.partition(score, len(vid) - most, axis=1)[:, len(vid) - most]
                slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(last), last, 0)))
                for i, at in enumerate(score >= (last - slack)[:, None]):
                    at = np.flatnonzero(at & np.isfinite(score[i]))
                    s = exact(own[i], v[at])
                    best = np.lexsort((vid[at], -s))[:k]
                    with np.errstate(over="ignore"):
                        found.append((np.full(len(best), qid[lo + i]), vid[at[best]], np.ldexp(s[best], up_q + up_v)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x")).filter(F.col("id").isNotNull() & F.col("x").isNotNull() & finite & F.exists("x", lambda c: c != 0))


def met(base: DataFrame, asked: DataFrame, plan: Plan, k: int, narrow: bool) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of the vectors in the buckets that a query probes."""
    stored = base.select("id", F.size("x").alias("dim"), arrow(placed(plan, narrow), "struct<vector:binary,band:bigint,codes:array<bigint>>")("x").alias("h"))
    stored = stored.select("id", "dim", "h.vector", "h.band", F.posexplode("h.codes").alias("table", "code")).withColumn("table", F.col("table").cast("bigint"))
    parts = F.create_map(*(F.lit(x) for d, (_, tables) in plan.items() for b, p in tables.items() for x in (f"{d} {b}", p.parts)), *((F.lit(""), F.lit(1)) if not any(t for _, t in plan.values()) else ()))
    own = F.coalesce(F.element_at(parts, F.concat_ws(" ", "dim", "band")), F.lit(1))
    stored = checkpoint(stored.withColumn("part", F.pmod(F.xxhash64("code"), own.cast("bigint"))))
    probed = asked.select("id", F.size("x").alias("dim"), arrow(asking(plan, narrow), "struct<vector:binary,asks:array<struct<band:bigint,table:bigint,least:double,parts:bigint>>>")("x").alias("h"))
    probed = checkpoint(probed.select("id", "dim", "h.vector", F.explode("h.asks").alias("ask")).select("id", "dim", "vector", "ask.*"))
    query_blocks = math.ceil(asked.count() / BLOCK)
    grid = stored.groupBy("dim", "band", "table", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    grid = table_bound(checkpoint(grid))
    place = ["dim", "band", "table", "part"]
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = stored.join(grid, place).select(*place, F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), every(F.lit(max(1, query_blocks))).alias("query_block"), F.lit(False).alias("asks"), "id", "vector", "code", F.lit(None).cast("double").alias("least"))
    right = probed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).join(grid, place)
    right = right.withColumn("block", every(F.col("blocks"))).select(*place, "block", F.pmod(F.xxhash64("id"), F.lit(max(1, query_blocks))).cast("int").alias("query_block"), F.lit(True).alias("asks"), "id", "vector", F.lit(0).cast("bigint").alias("code"), "least")
    near = left.unionByName(right).repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(nearest(k, plan, narrow), "query_id bigint, vec_id bigint, score double")
    best = near.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(queries: DataFrame, vectors: DataFrame, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: float = PROBES, seed: int = 3, exact_rows: int = EXACT) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors found for each query."""
    narrow = all(isinstance(df.schema[vector_col].dataType, T.ArrayType) and isinstance(df.schema[vector_col].dataType.elementType, T.FloatType) for df in (queries, vectors))
    base, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    most = F.array_max(F.transform("x", F.abs))
    length = F.log(most) + F.log(F.aggregate(F.transform("x", lambda c: c / most), F.lit(0.0), lambda a, c: a + c * c)) / 2
    known = base.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.min(length).alias("short"), F.max(length).alias("long")).collect()
    equal = {r["dim"]: r["n"] for r in known if r["short"] >= r["long"] + math.log(0.999)}
    longest = {r["dim"]: r["long"] for r in known if r["dim"] not in equal}
    hashing = lambda d, n: Polytopes(d, n, tables, probes, seed)
    plan: Plan = {d: (None, {0: hashing(d, n)}) for d, n in equal.items()} | {d: (x, {}) for d, x in longest.items()}
    for d, x in longest.items():
        band = F.floor(F.greatest(F.lit(0.0), F.lit(x) - length) / math.log(STEP)).alias("band")
        large = base.filter(F.size("x") == d).groupBy(band).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > exact_rows).orderBy("band")
        plan[d][1].update((r["band"], hashing(d, r["n"])) for r in large.collect())
    here: Column = F.size("x").isin(*plan)
    found = checkpoint(met(base, asked.filter(here), plan, k, narrow))
    short = checkpoint(asked.filter(here).join(found.filter(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti"))
    if not short.head(1):
        return found
    rest = met(base, short, {d: (None, {}) for d in plan}, k, narrow)
    return found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(rest)
