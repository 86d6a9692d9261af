"""Token counts of whole texts under a public BPE vocabulary with word ends.

Pre-tokens that a worker has not met yet are held together as ragged arrays: all symbols flat, the rows one after the
other. In each round every row merges all occurrences of its lowest-rank pair at once, and also every pair that no pair
of lower rank stands so near to that their symbols could become one token; until no row has a known pair. What is left of
a row is its token count. The file is a parameter and is read by the driver, then sent to tasks.

Merging all occurrences at once is right where a merge never makes a pair of lower rank, as in vocabularies in order of
their merges; the file is checked for it. A token is REACH bytes at most, so what is farther away cannot interfere.

Defined cases: null or empty text has 0 bytes and 0 tokens; very long texts are counted whole, very long words by the
same rounds; a special token's string inside a text is that one token, as the library takes it by default; an empty table
gives no rows; repeated rows are counted row by row; columns of the outputs' names stay, the outputs then get
underscores; other columns stay.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, fresh, slices

#: Bytes of pre-tokens that a worker remembers; beyond that it starts anew. Longer pre-tokens are not remembered.
REMEMBERED, LONGEST = 16 << 20, 64
#: Bytes of pre-tokens that are merged together.
TOGETHER = 1 << 18
NONE = np.int32(2**31 - 1)
SPACE = r"\t\n\v\f\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class WordBpe:
    """Merge table: key of a symbol pair -> rank and merged symbol."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, vocab = spec["model"], spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {a + b: i for i, (a, b) in enumerate(pairs)}
        if len(made) < len(pairs) or any(made.get(x, -1) >= i for i, pair in enumerate(pairs) for x in pair):
            raise ValueError("the merges are not in the order in which their tokens arise")
        self.width = np.int64(max(vocab.values()) + 1)
        self.keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        self.into = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.reach = max(len(t) - len(model["end_of_word_suffix"]) * t.endswith(model["end_of_word_suffix"]) for t in made)
        # byte -> symbol: printable bytes stand for themselves, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.first = np.array([vocab[names[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[names[b] + model["end_of_word_suffix"]] for b in range(256)], np.int32)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = next(s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split").replace(r"\s", SPACE)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def split(self, text: str) -> tuple[int, list[str]]:
        """The number of special tokens, and the pre-tokens."""
        if not hasattr(self, "_find"):
            self._find = regex.compile(self.pattern).findall
            self._special = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        parts = self._special.split(text) if any(s in text for s in self.special) else [text]
        out = []
        for part in parts:
            out += self._find(part.lower() if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return len(parts) - 1, out

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs' keys and ranks by hash, each in the first free place."""
        if not hasattr(self, "_table"):
            size = 1 << max(4, (4 * len(self.keys)).bit_length())
            keys, ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
            left, at = np.arange(len(self.keys)), self.place(self.keys, size)
            while len(left):
                free = np.flatnonzero(keys[at] < 0)
                _, first = np.unique(at[free], return_index=True)
                taken = free[first]
                keys[at[taken]], ranks[at[taken]] = self.keys[left[taken]], left[taken]
                left, at = np.delete(left, taken), (np.delete(at, taken) + 1) % size
            self._table = keys, ranks
        return self._table

    @staticmethod
    def place(key: np.ndarray, size: int) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - size.bit_length())).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE if it is not known."""
        keys, ranks = self.table()
        key = left * self.width + right
        at = self.place(key, len(keys))
        found = keys[at]
        out = np.where(found == key, ranks[at], NONE)
        rest = np.flatnonzero((found != key) & (found >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) % len(keys)
            found = keys[at[rest]]
            out[rest] = np.where(found == key[rest], ranks[at[rest]], NONE)
            rest = rest[(found != key[rest]) & (found >= 0)]
        return out

    def near(self, rank: np.ndarray) -> np.ndarray:
        """The least rank within reach of each place, to both sides, whatever the row."""
        width, wide, n = 1, rank, 2 * self.reach + 1
        while 2 * width <= n:
            wide = np.minimum(wide[:-width], wide[width:])
            width *= 2
        span = np.minimum(wide[: len(wide) - (n - width)], wide[n - width :]) if n > width else wide
        return span

    def counts(self, words: list[str]) -> np.ndarray:
        out, lo, held = np.zeros(len(words), np.int64), 0, 0
        raw = [w.encode() for w in words]
        for i, w in enumerate(raw):
            held += len(w)
            if held > TOGETHER or i + 1 == len(raw):
                out[lo : i + 1], lo, held = self.merged(raw[lo : i + 1]), i + 1, 0
        return out

    def merged(self, raw: list[bytes]) -> np.ndarray:
        """The tokens that are left of each word; no word is empty."""
        size = np.array([len(b) for b in raw], np.int64)
        data, end = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size)
        symbol = self.first[data]
        symbol[end - 1] = self.last[data[end - 1]]
        count, row, length = np.ones(len(raw), np.int64), np.arange(len(raw)), size
        rank = np.append(self.ranks(symbol[:-1], symbol[1:]), NONE)
        rank[end - 1] = NONE
        pad = np.full(self.reach, NONE, np.int32)
        while len(row):
            start = np.cumsum(length) - length
            least = np.minimum.reduceat(rank, start)
            done = least == NONE
            if done.any():  # rows without a pair leave
                count[row[done]] = length[done]
                keep = np.repeat(~done, length)
                symbol, rank, row, length, least = symbol[keep], rank[keep], row[~done], length[~done], least[~done]
                if not len(row):
                    break
                start = np.cumsum(length) - length
            chosen = rank == np.repeat(least, length)
            if int(length.max()) > 2 * self.reach:
                chosen |= (rank == self.near(np.concatenate([pad, rank, pad]))) & (rank != NONE)
            at = np.flatnonzero(chosen)
            # of equal pairs that overlap, every second one from the left; not where the run's left end has to wait
            begins = np.append(True, np.diff(at) > 1)
            head = at[begins]
            waits = (head > 0) & (rank[head - 1] == rank[head])
            run = np.cumsum(begins) - 1
            at = at[((at - head[run]) % 2 == 0) & ~waits[run]]
            symbol[at] = self.into[rank[at]]
            own = np.searchsorted(start, at, side="right") - 1
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            ends = np.zeros(len(symbol), bool)
            ends[start + length - 1] = True
            ends[at] |= ends[at + 1]
            length = length - np.bincount(own, minlength=len(length))
            fresh = np.zeros(len(symbol), bool)
            fresh[at] = True
            symbol, rank, ends, fresh = symbol[keep], rank[keep], ends[keep], fresh[keep]
            # pairs on both sides of what was merged are new
            again = fresh.copy()
            again[:-1] |= fresh[1:]
            again &= ~ends
            rank[fresh] = NONE
            at = np.flatnonzero(again)
            rank[at] = self.ranks(symbol[at], symbol[at + 1])
        return count

    def of(self, texts: list[str | None]) -> list[int]:
        split = [self.split(t) if t else (0, []) for t in texts]
        known = self.__dict__.setdefault("_known", {})
        new = [w for w in set().union(*(s[1] for s in split)) if w not in known]
        held = dict(zip(new, self.counts(new).tolist(), strict=True))
        short = {w: n for w, n in held.items() if len(w) <= LONGEST}
        if (size := self.__dict__.get("_size", 0) + sum(map(len, short))) > REMEMBERED:
            both = known | held
            self._known, size = {}, 0
        else:
            known.update(short)
            both = known if len(short) == len(held) else known | held
        self._size = size
        return [extra + sum(map(both.__getitem__, tokens)) for extra, tokens in split]


def token_counts(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text", limit: int = 2048, names: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit")) -> DataFrame:
    """docs with three more columns: UTF-8 bytes, tokens, and whether the tokens are more than limit."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(WordBpe(f.read()))

    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = shared.value
        for texts in parts:
            yield pa.array([n for held in slices(texts) for n in bpe.of(held)], pa.int64())

    size = fresh(docs, names[0])
    sized = docs.withColumn(size, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint"))
    tokens = fresh(sized, names[1])
    counted = sized.withColumn(tokens, arrow(count, "bigint")(F.col(text_col)))
    return counted.withColumn(fresh(counted, names[2]), F.col(tokens) > limit)
