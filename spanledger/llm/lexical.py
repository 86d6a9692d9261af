"""Ranked lexical search: exact inner-product search through sparse ball trees.

1. One pass over the texts counts documents, their terms, and the documents that hold each term of the items.
2. A second pass cuts each task's documents into blocks. A document is a sparse vector over the items' terms: weight of
   the term by its saturated count. Over a block stands a ball tree: nodes halve their documents between two far ones,
   and keep the centroid and, per group of terms that the same items have, the radius around it. For an item, no document
   of a node can score more than the centroid's score plus, over the item's groups, the root of a group's size times its
   radius; this bound is widened by what rounding can do to it. Nodes are opened best first, leaves scored in exact
   integers, until the best node left lies below the k-th score that the task has found in any of its blocks.
3. The k best of each task meet in a window per item.

Items go to the tasks in blocks of about ITEM_BYTES of text, each one more reading of the documents, so that no task and
no driver holds more than one such block.

Defined cases: null texts, or without terms, have none: such documents count for nothing, such items give no rows; an
empty table gives no rows; very long texts are taken whole; equal scores come by ascending id, null ids last; documents
that repeat an id are documents of their own; items that repeat an id, or have none, are one item with all their terms;
other columns, whatever their names, are not used.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, small_batches

TOP = 10
#: Bytes of item texts that are held at once, and of document texts under one tree.
ITEM_BYTES, BLOCK_BYTES = 1 << 20, 4 << 20
#: Documents of a leaf, and groups of terms (more are dealt to as many; one group for all would be the plain ball).
LEAF, GROUPS = 16, 2048
#: By this share, and one, bounds are raised over the rounding of their sums.
SLACK = 1e-9
#: What stands between terms becomes a space, A-Z lower case.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def batches_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of a task's documents, in blocks of about so many bytes."""
    ids, texts, held = [], [], 0
    for batch in batches:
        own = iter(batch["id"].to_pylist())
        for part in slices(batch["text"], most):
            texts += part
            ids += [next(own) for _ in part]
            held += sum(len(t) for t in part if t)
            if held >= most:
                yield ids, texts
                ids, texts, held = [], [], 0
    if texts:
        yield ids, texts


def counts(vocabulary: dict[bytes, int]) -> Callable:
    """A task's documents per term, as (term, n); documents with a term as term -1, all terms as -2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, total = np.zeros(len(vocabulary), np.int64), 0, 0
        for _, texts in batches_of(batches, BLOCK_BYTES):
            for text in texts:
                terms = terms_of(text)
                n, total = n + bool(terms), total + len(terms)
                held[[vocabulary[t] for t in set(terms) if t in vocabulary]] += 1
        met = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *met.tolist()], pa.int32()), pa.array([n, total, *held[met].tolist()], pa.int64())], ["term", "n"])

    return run


class Vectors:
    """Sparse rows: of each entry its column and value, and where each row starts. No row is empty."""

    def __init__(self, rows: list[list[tuple[int, int]]]):
        self.start = np.cumsum([0, *map(len, rows)])
        self.column = np.fromiter((c for r in rows for c, _ in r), np.int32, self.start[-1])
        self.value = np.fromiter((v for r in rows for _, v in r), np.int64, self.start[-1])

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the entries of some rows, and where each row starts among them."""
        size = self.start[rows + 1] - self.start[rows]
        first = np.cumsum(size) - size
        return np.arange(size.sum()) + np.repeat(self.start[rows] - first, size), first


class BallTree:
    """Nodes over the rows of a block. group: of each column."""

    def __init__(self, vectors: Vectors, group: np.ndarray):
        self.vectors, self.dims, self.group, self.groups = vectors, len(group), group, int(group.max()) + 1
        self.rows: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        centers, radii = [], []
        todo = [np.arange(len(vectors.start) - 1)]
        for rows in todo:  # grows on the way: parents stand before their children
            center, gaps, halves = self.node(rows)
            centers.append(center)
            radii.append(np.sqrt(gaps) * (1 + SLACK) + 1)
            self.children.append((len(todo), len(todo) + 1) if halves else None)
            self.rows.append(None if halves else rows)
            todo += halves
        self.radii = np.stack(radii)
        size = [len(c) for c, _ in centers]
        self.at = np.concatenate([c for c, _ in centers])
        self.center = np.concatenate([v for _, v in centers])
        self.of = np.repeat(np.arange(len(centers)), size)

    def node(self, rows: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, list[np.ndarray]]:
        """Centroid as columns and values, the greatest squared distance to it per group, and the halves of a node above LEAF."""
        at, first = self.vectors.entries(rows)
        column, value = self.vectors.column[at], self.vectors.value[at].astype(float)
        own = np.repeat(np.arange(len(rows)), np.diff([*first, len(at)]))
        center = np.bincount(column, value, self.dims) / len(rows)
        filled = np.flatnonzero(center)
        whole = np.bincount(self.group[filled], center[filled] ** 2, self.groups)
        off = np.bincount(own * self.groups + self.group[column], (value - center[column]) ** 2 - center[column] ** 2, len(rows) * self.groups)
        gaps = np.maximum(off.reshape(len(rows), -1) + whole, 0) + SLACK * (whole + np.bincount(self.group[column], value**2, self.groups))
        if len(rows) <= LEAF:
            return (filled, center[filled]), gaps.max(0), []
        norm = np.bincount(own, value**2, len(rows))

        def from_row(i: int) -> np.ndarray:
            far = np.zeros(self.dims)
            mine = slice(first[i], first[i + 1] if i + 1 < len(rows) else None)
            far[column[mine]] = value[mine]
            return norm + norm[i] - 2 * np.bincount(own, value * far[column], len(rows))

        to_a = from_row(int(gaps.sum(1).argmax()))
        side = to_a - from_row(int(to_a.argmax()))
        nearer = np.argsort(side, kind="stable")
        cut = min(max(int((side < 0).sum()), len(rows) // 4), len(rows) - len(rows) // 4)
        return (filled, center[filled]), gaps.max(0), [rows[nearer[:cut]], rows[nearer[cut:]]]

    def bounds(self, wanted: np.ndarray) -> np.ndarray:
        """Above the score of every row of each node. wanted: 1 for the columns that an item has, else 0."""
        inner = np.bincount(self.of, self.center * wanted[self.at], len(self.radii))
        size = np.bincount(self.group, wanted, self.groups)
        own = np.flatnonzero(size)
        return (inner + self.radii[:, own] @ np.sqrt(size[own])) * (1 + SLACK) + 1

    def search(self, columns: np.ndarray, least: Callable[[], int], found: Callable[[np.ndarray, np.ndarray], None]) -> int:
        """Tells found the rows and exact scores of the leaves that may hold a score of least() or more; their number."""
        wanted = np.zeros(self.dims)
        wanted[columns] = 1
        exact, bound, opened = wanted.astype(np.int64), self.bounds(wanted), 0
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= least():
            _, i = heapq.heappop(heap)
            if self.children[i]:
                for j in self.children[i]:
                    heapq.heappush(heap, (-min(bound[i], bound[j]), j))
            else:
                rows = self.rows[i]
                at, first = self.vectors.entries(rows)
                found(rows, np.add.reduceat(exact[self.vectors.column[at]] * self.vectors.value[at], first))
                opened += len(rows)
        return opened


class Best:
    """The k best documents that a task has found for an item: highest score first, then the least id, null ids last."""

    def __init__(self, k: int):
        self.k, self.kept = k, []

    def least(self) -> int:
        return -self.kept[-1][0] if len(self.kept) == self.k else 1

    def add(self, ids: list, scores: list[int]) -> None:
        low = self.least()
        more = [(-s, i is None, i if i is not None else 0) for i, s in zip(ids, scores, strict=True) if s >= low]
        if more:
            self.kept = sorted(self.kept + more)[: self.k]


def search(k: int, items: list[tuple[int, list[int]]], vocabulary: dict[bytes, int], weights: list[int], group: np.ndarray, n_docs: int, n_terms: int) -> Callable:
    """The k best documents of a task for each item (number, columns)."""

    def vector(text: bytes | None) -> list[tuple[int, int]]:
        terms = terms_of(text)
        m = 8 * (10 + 90 * len(terms) * n_docs // n_terms)
        met = ((vocabulary[t], n) for t, n in Counter(terms).items() if t in vocabulary)
        return [(c, weights[c] * (1_000_000_000 * n // (1000 * n + m))) for c, n in met if weights[c]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for ids, texts in batches_of(batches, BLOCK_BYTES):
            rows = [(i, v) for i, t in zip(ids, texts, strict=True) if (v := vector(t))]
            if rows:
                tree = BallTree(Vectors([v for _, v in rows]), group)
                for own, (_, columns) in zip(best, items, strict=True):
                    tree.search(np.array(columns), own.least, lambda r, s, own=own: own.add([rows[i][0] for i in r], s.tolist()))  # noqa: B023
        out = [(item, None if none else i, -s) for own, (item, _) in zip(best, items, strict=True) for s, none, i in own.kept]
        if out:
            kinds = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], ["item", "id", "score"])

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Ids and texts of the items, sorted by id, in blocks of about ITEM_BYTES; rows of one id stay together."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).orderBy("id")
    block: list[tuple] = []
    held = 0
    for r in rows.toLocalIterator():
        if held >= ITEM_BYTES and r["id"] != block[-1][0]:
            yield block
            block, held = [], 0
        block.append((r["id"], bytes(r["text"]) if r["text"] is not None else None))
        held += len(r["text"] or b"")
    if block:
        yield block


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def groups_of(items: list[tuple[int, list[int]]], dims: int) -> np.ndarray:
    """The group of each column: columns that the same items have are one."""
    holders: list[list[int]] = [[] for _ in range(dims)]
    for item, columns in items:
        for c in columns:
            holders[c].append(item)
    numbers: dict[tuple, int] = {}
    return np.array([numbers.setdefault(tuple(h), len(numbers)) % GROUPS for h in holders])


def best_documents(docs: DataFrame, block: list[tuple], kind: str, k: int) -> DataFrame | None:
    """item_id (of that kind), id, score: the k best of each task, for the items of a block."""
    terms: dict = {}
    for item, text in block:
        terms.setdefault(item, set()).update(terms_of(text))
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
    if not vocabulary:
        return None
    told = docs.select("id", "text").mapInArrow(counts(vocabulary), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    known = {r["term"]: r["n"] for r in told.collect()}  # a row per term of the block, and two
    n_docs, n_terms = known.get(-1, 0), known.get(-2, 0)
    if not n_docs:
        return None
    columns = [(i, sorted(vocabulary[t] for t in own)) for i, own in enumerate(terms.values()) if own]
    weights = [weight(n_docs, known.get(i, 0)) for i in range(len(vocabulary))]
    finder = search(k, columns, vocabulary, weights, groups_of(columns, len(vocabulary)), n_docs, n_terms)
    found = docs.select("id", "text").mapInArrow(finder, "item int, id bigint, score bigint")
    names = docs.sparkSession.createDataFrame(list(enumerate(terms)), f"item int, item_id {kind}")
    return found.join(F.broadcast(names), "item").select("item_id", "id", "score")


def ranked(docs: DataFrame, items: DataFrame, *, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of the highest score above 0 for each item."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = items.schema[item_id].dataType.simpleString()
    found = docs.sparkSession.createDataFrame([], f"item_id {kind}, id bigint, score bigint")
    for block in item_blocks(items, item_id, item_text):
        own = best_documents(rows, block, kind, k)
        found = found if own is None else found.unionByName(own)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("item_id", "rank", F.col("id").alias("doc_id"), "score")
