"""Exact substring dedup by level-wise doubling: words that stand in a repeated window go, but for its first place.

Documents are dealt to blocks by the hash of their id, with one shuffle of the texts that all levels read.

1. The first level looks at windows of half the length. Of the half windows within a window the one of the least hash
   stands for it: windows of the same words have the same one. Each block sends the distinct hashes that stand for any
   window, and gets back one bit for each: whether another block has it too.
2. Windows whose half window is repeated, alone, are extended to the whole length: the hashes of their two halves are
   combined to 96 bits. Each block sends those that are distinct, with the id of its first place, and gets back one bit
   for each: whether an earlier document has it. What is repeated within a block, the block knows itself.
3. The words of all windows that also start earlier are left out.

`longest_repeats` goes on: windows repeated at one length alone, where the window that follows them is repeated too, are extended
to twice the length, until no candidates survive.

A window that very many rows share is one hash per block in any bucket, so no task gets the rows of a hot passage.

Two different windows are taken for one with a chance of about n * n / 2**97 for n repeated windows.

Defined cases: null and empty texts, or of fewer words than a window, have no window and stay as they are; very long
texts are taken whole (one task holds all of a text); ids are integers, a null id comes after all others; rows that
repeat an id are documents of their own, in the order of their texts; an equal row counts as a later one; an empty table
gives no rows; other columns, whatever their names, are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .neardup import SPACES, mixed, word_hashes

WINDOW = 20
#: Bytes of text in a block, and hashes in a bucket, on average.
BLOCK_BYTES, BUCKET_HASHES = 4 << 20, 1 << 20
NO_ID = np.iinfo(np.int64).max
#: One row per block, level and bucket: keys that are asked for, or the answers to them, one bit per key.
ANSWER_KIND = pa.schema([("block", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()), ("many", pa.int32()), ("repeated", pa.binary()), ("earlier", pa.binary())])
SENT_KIND = pa.schema([*ANSWER_KIND, ("keys", pa.binary()), ("more", pa.binary()), ("ids", pa.binary())])
ANSWERS = "block bigint, level int, bucket int, many int, repeated binary, earlier binary"
SENT = f"{ANSWERS}, keys binary, more binary, ids binary"
ODD = np.uint64(0x9E3779B97F4A7C15)


def sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """The least or greatest of each so many consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


@dataclass
class Block:
    """The words of a block's documents, in order, and hashes of their windows at each start."""

    ids: np.ndarray
    first: np.ndarray
    words: np.ndarray
    window: int
    half: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        n, size = len(self.words), (self.window + 1) // 2
        half = np.zeros(max(n - size + 1, 0), np.uint64)
        for j in range(size):
            half = mixed(half * ODD + self.words[j : j + len(half)])
        self.half = half
        self.starts = self.fitting(self.window)

    def fitting(self, length: int) -> np.ndarray:
        """The places where so many words of one document start."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.words))
        return np.flatnonzero(left >= length)

    def standing(self) -> np.ndarray:
        """For each window that fits, the least hash of the half windows in it."""
        return sliding(self.half, self.window // 2 + 1, np.minimum)[self.starts]

    def halves(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashes that stand for a window, sorted, and which of them this block has at two places."""
        least = self.standing()
        spread = self.window // 2 + 1
        held = np.zeros(len(self.half) + spread, np.uint64)
        held[self.starts + spread - 1] = least  # no window: 0, which no least hash of a place exceeds
        chosen = np.flatnonzero(sliding(held, spread, np.maximum)[: len(self.half)] == self.half)
        values, many = np.unique(self.half[chosen], return_counts=True)
        return values, many > 1


def cut(ids: list, texts: list[bytes], window: int) -> Block:
    data = np.frombuffer(b" ".join([b"", *texts, b" " * 8]), np.uint8)
    word = np.append(~SPACES[data], False)
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(~word[1:] & word[:-1]) + 1
    first = np.searchsorted(start, np.cumsum([1, *(len(t) + 1 for t in texts)]))
    return Block(np.array([NO_ID if i is None else i for i in ids], np.int64), first, word_hashes(data, start, end), window)


def in_order(docs: pa.Table) -> tuple[list, list[bytes]]:
    """Ids and texts of a block, by id and text; null ids last."""
    rows = zip(docs["id"].to_pylist(), docs["text"].to_pylist(), strict=True)
    rows = sorted(((i is None, i or 0, t or b"") for i, t in rows))
    return [None if none else i for none, i, _ in rows], [t for *_, t in rows]


def sent(block: int, level: int, buckets: int, keys: np.ndarray, more: np.ndarray | None = None, ids: np.ndarray | None = None) -> list[dict]:
    """Sorted keys as one row per bucket; a bucket is a range of keys."""
    bucket = (keys >> np.uint64(40)).astype(np.int64) * buckets >> 24
    met, at = np.unique(bucket, return_index=True)
    own = lambda x, lo, hi: None if x is None else x[lo:hi].tobytes()
    return [
        {"block": block, "level": level, "bucket": b, "many": int(hi - lo), "keys": own(keys, lo, hi), "more": own(more, lo, hi), "ids": own(ids, lo, hi)}
        for b, lo, hi in zip(met.tolist(), at, [*at[1:], len(keys)], strict=False)
    ]


def bits_of(answers: pa.Table, level: int, kind: str, many: int) -> np.ndarray:
    """The answers of a level in the order of the keys that were asked for."""
    rows = sorted((r for r in answers.to_pylist() if r["level"] == level), key=lambda r: r["bucket"])
    bits = [np.unpackbits(np.frombuffer(r[kind], np.uint8), count=r["many"]) for r in rows]
    out = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
    if len(out) != many:
        raise RuntimeError(f"{len(out)} answers to {many} keys of level {level}")
    return out


@dataclass
class Level:
    """What a block knows of the windows of one length: the places of its candidates, keys in their order, and the distinct ones."""

    at: np.ndarray
    keys: np.ndarray
    more: np.ndarray
    order: np.ndarray  # of the candidates, by key and place
    first: np.ndarray  # of the distinct keys, in that order
    ids: np.ndarray  # of the first place of each

    def own(self) -> np.ndarray:
        """For each candidate in order: the number of its key."""
        return np.repeat(np.arange(len(self.first)), np.diff([*self.first, len(self.order)]))

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Candidates whose key stands elsewhere, in another block or here."""
        many = np.diff([*self.first, len(self.order)])
        out = np.zeros(len(self.at), bool)
        out[self.order] = (elsewhere | (many > 1))[self.own()]
        return out

    def later(self, earlier: np.ndarray) -> np.ndarray:
        """Candidates that are not the first place of their key."""
        here = np.ones(len(self.order), bool)
        here[self.first] = False
        out = np.zeros(len(self.at), bool)
        out[self.order] = here | earlier[self.own()]
        return out


def level_of(block: Block, at: np.ndarray, keys: np.ndarray, more: np.ndarray) -> Level:
    order = np.lexsort((more, keys))  # stable: places of a key stay in order
    k, m = keys[order], more[order]
    first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1]))) if len(k) else np.zeros(0, np.int64)
    doc = np.searchsorted(block.first, at[order[first]], "right") - 1
    return Level(at, keys, more, order, first, block.ids[doc])


def whole_level(block: Block, halves: np.ndarray) -> Level:
    """The windows whose half window is repeated. halves: of the distinct half windows."""
    values, _ = block.halves()
    at = block.starts[halves[np.searchsorted(values, block.standing())]]
    size = (block.window + 1) // 2
    a, b = block.half[at], block.half[at + block.window - size]
    return level_of(block, at, mixed(mixed(a * ODD + np.uint64(1)) + b), (mixed(mixed(b * ODD + np.uint64(2)) + a) >> np.uint64(32)).astype(np.uint32))


def next_level(block: Block, level: Level, repeated: np.ndarray, length: int) -> Level:
    """The windows of twice the length, of which both halves are repeated at this length."""
    place = np.full(len(block.words) + 1, -1)
    place[level.at[repeated]] = np.flatnonzero(repeated)
    at = np.intersect1d(level.at[repeated], block.fitting(2 * length), assume_unique=True)
    at = at[place[at + length] >= 0]
    a, b = place[at], place[at + length]
    key = lambda x: level.keys[x] ^ mixed(level.more[x].astype(np.uint64))
    return level_of(block, at, mixed(mixed(key(a) * ODD + np.uint64(3)) + key(b)), (mixed(mixed(key(b) * ODD + np.uint64(4)) + key(a)) >> np.uint64(32)).astype(np.uint32))


def levels(block: Block, answers: pa.Table, upto: int) -> list[Level]:
    """The levels from whole windows on, up to that number; all but the last are answered."""
    values, here = block.halves()
    out = [whole_level(block, here | bits_of(answers, 0, "repeated", len(values)))] if upto else []
    for number in range(1, upto):
        told = bits_of(answers, number, "repeated", len(out[-1].first))
        out.append(next_level(block, out[-1], out[-1].repeated(told), block.window << (number - 1)))
    return out


def asked(window: int, level: int, buckets: int) -> Callable:
    """Of each block the distinct keys of a level, and on with them the answers to the levels before."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.Table.from_pylist([], SENT_KIND)
        block = cut(*in_order(docs), window)
        if level:
            own = levels(block, answers, level)[-1]
            at = own.order[own.first]
            rows = sent(key[0].as_py(), level, buckets, own.keys[at], own.more[at], own.ids)
        else:
            rows = sent(key[0].as_py(), 0, buckets, block.halves()[0])
        return pa.Table.from_pylist(rows + answers.to_pylist(), SENT_KIND)

    return run


def answered(key: tuple, rows: pa.Table) -> pa.Table:
    """Of each key of a bucket whether another block has it, and whether one has it at an earlier id. Answers go on."""
    told = [{f.name: r[f.name] for f in ANSWER_KIND} for r in rows.to_pylist() if r["keys"] is None]
    open_ = [r for r in rows.to_pylist() if r["keys"] is not None]
    if open_:
        keys = np.frombuffer(b"".join(r["keys"] for r in open_), np.uint64)
        none = bytes(4 * len(keys)), bytes(8 * len(keys))
        more = np.frombuffer(b"".join(r["more"] or b"" for r in open_) or none[0], np.uint32)
        ids = np.frombuffer(b"".join(r["ids"] or b"" for r in open_) or none[1], np.int64)
        order = np.lexsort((ids, more, keys)) if ids.any() else np.argsort(keys, kind="stable")
        k, m = keys[order], more[order]
        same = (k[1:] == k[:-1]) & (m[1:] == m[:-1])
        both = np.zeros((2, len(keys)), bool)
        both[0, order] = np.append(same, False) | np.append(False, same)
        both[1, order] = np.append(False, same)
        start = np.cumsum([0, *(r["many"] for r in open_)])
        for r, a, b in zip(open_, start[:-1], start[1:], strict=True):
            repeated, earlier = (np.packbits(x[a:b]).tobytes() for x in both)
            told.append({c: r[c] for c in ("block", "level", "bucket", "many")} | {"repeated": repeated, "earlier": earlier})
    return pa.Table.from_pylist(told, ANSWER_KIND)


def kept(window: int, kind: pa.Schema) -> Callable:
    """The documents of a block without the words of windows that also start earlier."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.Table.from_pylist([], kind)
        ids, texts = in_order(docs)
        block = cut(ids, texts, window)
        level = levels(block, answers, 1)[0]
        at = level.at[level.later(bits_of(answers, 1, "earlier", len(level.first)))]
        change = np.zeros(len(block.words) + window + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        stays = np.cumsum(change)[: len(block.words)] == 0
        out = []
        for i, t, a, b in zip(ids, texts, block.first[:-1], block.first[1:], strict=True):
            own = stays[a:b]
            left = t.split() if own.all() else compress(t.split(), own.tolist())
            out.append((i, int(b - a), int(b - a - own.sum()), b" ".join(left)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)

    return run


def reach(window: int, upto: int, kind: pa.Schema) -> Callable:
    """Of each document of a block the greatest length at which a window of it is repeated."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.Table.from_pylist([], kind)
        ids, texts = in_order(docs)
        block = cut(ids, texts, window)
        longest = np.zeros(len(ids), np.int64)
        for number, level in enumerate(levels(block, answers, upto), 1):
            at = level.at[level.repeated(bits_of(answers, number, "repeated", len(level.first)))]
            longest[np.searchsorted(block.first, at, "right") - 1] = window << (number - 1)
        return pa.Table.from_arrays([pa.array(ids, kind[0].type), pa.array(longest)], schema=kind)

    return run


class Dealt:
    """The texts in blocks, and how many tasks and buckets their bytes ask for."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, window: int):
        if window < 2:
            raise ValueError("a window has two words at least")
        small_batches(docs.sparkSession)
        rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
        held = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
        self.window, self.buckets = window, max(1, held // (4 * BUCKET_HASHES))
        self.tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), held >> 27)
        block = F.pmod(F.xxhash64("id"), F.lit(max(1, held // BLOCK_BYTES)))
        self.texts = rows.withColumn("block", block).repartition(self.tasks, "block")

    def met(self, answers: DataFrame, solver: Callable, schema: str) -> DataFrame:
        return self.texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(solver, schema)

    def asked(self, answers: DataFrame, level: int) -> DataFrame:
        return self.met(answers, asked(self.window, level, self.buckets), SENT)

    def answered(self, keys: DataFrame) -> DataFrame:
        return keys.repartition(self.tasks, "bucket").groupBy("bucket").applyInArrow(answered, ANSWERS)

    def nothing(self) -> DataFrame:
        return self.texts.sparkSession.createDataFrame([], ANSWERS)


def without_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, kept: each document's words but those of windows that also start earlier, joined by one space."""
    dealt = Dealt(docs, id_col, text_col, window)
    halves = dealt.answered(dealt.asked(dealt.nothing(), 0))
    answers = dealt.answered(dealt.asked(halves, 1))
    kind = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])
    found = dealt.met(answers, kept(window, kind), "id bigint, n_words bigint, n_removed bigint, kept binary")
    return found.withColumn("kept", F.col("kept").cast("string"))


def longest_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, longest: the greatest of window, twice, four times ... window words at which a window of the document is repeated; 0 if none is."""
    dealt = Dealt(docs, id_col, text_col, window)
    answers, level = written(dealt.answered(dealt.asked(dealt.nothing(), 0))), 1
    while True:
        keys = written(dealt.asked(answers, level))
        if not keys.filter(F.col("keys").isNotNull()).head(1):
            break
        answers, level = written(dealt.answered(keys)), level + 1
    kind = pa.schema([("id", pa.int64()), ("longest", pa.int64())])
    return dealt.met(answers, reach(window, level - 1, kind), "id bigint, longest bigint")
