"""Benchmark decontamination: a broadcast hash set of the benchmark's n-gram windows is held against every text.

A word is a run of digits, letters and non-ASCII characters after A-Z are lowered. An item's windows are its runs of
n words; an item of fewer words, but not none, is one window. Every document word inside an occurrence is hit.

The benchmark is taken in blocks of bounded size. A block's index is flat arrays, some six bytes for each byte of its
text: sorted window hashes, where each window stands, and its items. All blocks of PASS_BYTES are broadcast at once and
held against each text in one pass; a larger benchmark takes more passes, which leave only the places that were hit.

Defined cases: null or empty text has no words, so it is never hit; very long texts are scanned whole; a null item text
has no window; an item with a null id marks words but is not listed; repeated items count once; repeated documents are
judged row by row; an empty table of documents gives no rows, an empty benchmark no hits; a column of the output's name
stays, the output then gets underscores; other columns, whatever their names, stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, fresh, slices, table_bound, written
from .neardup import mixed, word_hashes

N = 13
#: UTF-8 bytes of benchmark text in one block, and in the blocks of one pass.
BLOCK_BYTES, PASS_BYTES = 8 << 20, 32 << 20
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
P = 0x9E3779B97F4A7C15
RESULT = "struct<n_words:bigint,n_hit:bigint,spans:array<bigint>,items:array<string>,cleaned:string>"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class Hashed:
    """The words of some texts, joined, and sums by which any window's hash is had at once."""

    def __init__(self, texts: list[bytes | None], seed: int = 0):
        folded = [(t or b"").translate(FOLD) for t in texts]
        self.joined = b" ".join([b"", *folded, b" " * 8])
        data = np.frombuffer(self.joined, np.uint8)
        word = np.append(data != 32, False)
        self.start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        self.end = np.flatnonzero(~word[1:] & word[:-1]) + 1
        self.first = np.searchsorted(self.start, np.cumsum([1, *(len(t) + 1 for t in folded)]))
        hashes = mixed(word_hashes(data, self.start, self.end) ^ np.uint64(seed))
        power = lambda p: np.cumprod(np.append(np.ones(1, np.uint64), np.full(len(hashes), p, np.uint64)), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power(P)[:-1], dtype=np.uint64)])
        self.back = power(pow(P, -1, 1 << 64))

    def windows(self, at: np.ndarray, length: int) -> np.ndarray:
        """The hashes of the windows of so many words that begin at words at."""
        return mixed((self.sums[at + length] - self.sums[at]) * self.back[at])

    def text(self, at: int, length: int) -> bytes:
        return b" ".join(self.joined[self.start[at] : self.end[at + length - 1]].split())


class Windows:
    """The windows of a block of items: for each length their sorted hashes, their places in the joined items, and their items."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], n: int = N):
        self.items = [item for item, _ in items]
        told = [b" ".join(words(text)) for _, text in items]
        for self.seed in range(99):  # another seed in case two windows share a hash
            of, self.by_length = Hashed(told, self.seed), []
            self.joined, size = of.joined, np.diff(of.first)
            for length in np.unique(np.minimum(size[size > 0], n)).tolist():
                here = np.flatnonzero(size >= n if length == n else size == length)
                many = size[here] - length + 1
                owner = np.repeat(here, many)
                at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(of.first[here], many)
                hashes = of.windows(at, length)
                order = np.argsort(hashes, kind="stable")
                hashes, at, owner = hashes[order], at[order], owner[order].astype(np.int32)
                new = np.append(True, hashes[1:] != hashes[:-1])
                head = np.flatnonzero(new)[np.cumsum(new) - 1]
                if any(of.text(at[i], length) != of.text(at[head[i]], length) for i in np.flatnonzero(~new)):
                    break
                whole = np.flatnonzero(new)
                self.by_length.append((length, hashes[whole], of.start[at[whole]].astype(np.int32), of.end[at[whole] + length - 1].astype(np.int32), np.append(whole, len(owner)).astype(np.int32), owner))
            else:
                break
        else:
            raise ValueError("windows share hashes under every seed")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def hits(self, of: Hashed) -> Iterator[tuple[int, int, list[int]]]:
        """First word, length and items (by number) of each window of a text that is one of these."""
        if not hasattr(self, "_seen"):
            self._seen = []
            for _, hashes, *_ in self.by_length:
                bits = np.zeros(1 << min(24, max(16, len(hashes).bit_length() + 3)), bool)
                bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = True
                self._seen.append(bits)
        for (length, hashes, start, end, group, owner), bits in zip(self.by_length, self._seen, strict=True):
            at = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(of.first[:-1], of.first[1:], strict=True) if b - a >= length] or [np.zeros(0, np.int64)])
            own = of.windows(at, length)
            maybe = np.flatnonzero(bits[(own & np.uint64(len(bits) - 1)).astype(np.int64)])
            at, own = at[maybe], own[maybe]
            k = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            for i, j in zip(at[hashes[k] == own].tolist(), k[hashes[k] == own].tolist(), strict=True):
                if of.text(i, length) == self.joined[start[j] : end[j]]:
                    yield i, length, owner[group[j] : group[j + 1]].tolist()


def ranges(hit: np.ndarray) -> np.ndarray:
    """First and end of each run, flat."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))


def cut(text: bytes, spans: list[int]) -> str:
    """The text without the bytes from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, text[last:]]).decode()


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    held, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).toLocalIterator():
        held.append((row[0], row[1] and bytes(row[1])))
        size += len(row[1] or b"")
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


KIND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string())), ("cleaned", pa.string())])


def scan(blocks: list[Broadcast], clean: bool) -> Callable:
    """The Arrow function of one pass over (text, spans and items of earlier passes)."""

    def hits(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = [b.value for b in blocks]
        for texts, spans, items in parts:
            out, at = [], 0
            for held in slices(texts, 1 << 20):
                by_seed: dict[int, Hashed] = {}
                edges: np.ndarray | None = None
                found: list[set] = [set() for _ in held]
                for windows in index or [Windows([])]:
                    of = by_seed.setdefault(windows.seed, None) or Hashed(held, windows.seed)
                    by_seed[windows.seed] = of
                    edges = np.zeros(len(of.start) + 1, np.int64) if edges is None else edges
                    for i, length, owners in windows.hits(of):
                        edges[i] += 1
                        edges[i + length] -= 1
                        found[np.searchsorted(of.first, i, side="right") - 1].update(windows.items[o] for o in owners)
                hit = np.cumsum(edges[:-1]) > 0
                for text, a, b, by in zip(held, of.first[:-1], of.first[1:], found, strict=True):
                    own = hit[a:b]
                    for lo, hi in zip(*[iter(spans[at].as_py() or [])] * 2, strict=True):
                        own[lo:hi] = True
                    run = ranges(own).tolist()
                    by = sorted((by | set(items[at].as_py() or [])) - {None})
                    out.append({"n_words": b - a, "n_hit": int(own.sum()), "spans": run, "items": by, "cleaned": cut(text, run) if clean and run else None})
                    at += 1
            yield pa.array(out, KIND)

    return arrow(hits, RESULT)


def contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = N, clean: bool = False, into: str = "hits", block_bytes: int = BLOCK_BYTES, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """docs with a struct column into: n_words, n_hit, spans (word ranges, flat), items, and, if clean, the text without hit spans (null: no hit)."""
    text, key, spans, items = F.col(text_col).cast("binary"), *(fresh(docs, x) for x in ("hit_key", "hit_spans", "hit_items"))
    nothing = F.lit(None).cast("array<bigint>"), F.lit(None).cast("array<string>")
    index, earlier = [], []
    for block in blocks(benchmark, item_col, item_text_col, block_bytes):
        if len(index) >= max(1, pass_bytes // block_bytes):  # a pass of its own: hit texts by their digest, each once
            hit = docs.select(F.md5(text).alias(key), scan(index, False)(text, *nothing).alias("h")).filter(F.col("h.n_hit") > 0)
            earlier.append(written(hit.groupBy(key).agg(F.min(F.struct("h.spans", "h.items")).alias("h")).select(key, F.col("h.spans").alias(spans), F.col("h.items").alias(items))))
            index = []
        index.append(docs.sparkSession.sparkContext.broadcast(Windows(block, n)))
    if not earlier:
        return docs.withColumn(fresh(docs, into), scan(index, clean)(text, *nothing))
    both = reduce(DataFrame.unionByName, earlier).groupBy(key).agg(F.flatten(F.collect_list(spans)).alias(spans), F.flatten(F.collect_list(items)).alias(items))
    told = docs.withColumn(key, F.md5(text)).join(table_bound(written(both)), key, "left")
    return told.withColumn(fresh(docs, into), scan(index, clean)(text, F.col(spans), F.col(items))).drop(key, spans, items)


def contaminated(hits: Column) -> Column:
    """Hit, and at least one word in twenty."""
    return (hits["n_hit"] > 0) & (F.lit(20) * hits["n_hit"] >= hits["n_words"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """docs without contaminated documents, or, with remove="spans", whole but for their hit spans."""
    hits = fresh(docs, "hits")
    found = contamination(docs, benchmark, text_col=text_col, clean=remove == "spans", into=hits, **options)
    if remove == "spans":
        return found.withColumn(text_col, F.coalesce(F.col(hits)["cleaned"], F.col(text_col))).drop(hits)
    return found.filter(~contaminated(F.col(hits))).drop(hits)
