"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; a bounded, hash-chosen sample of all texts is the unlabelled side. A linear
numpy classifier over word presence minimises the class-prior-corrected risk
    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),
following the gradient of the negative part's correction whenever that part falls below zero.

The sample's whole texts stay on the executors: words are counted there, a bounded number of them become features, and
the driver gets only which features each sampled text has.

Defined cases: null and empty texts have no words and get the score of the offset; very long texts count as wholes, in
the sample too; rows with null labels, and documents with conflicting ones, teach nothing; without positives every score
is the prior (0 without labels); of documents that repeat an id the least text teaches; an empty table gives no rows;
repeated rows are scored row by row; a column of the output's name stays, the output then gets underscores; other columns
stay and are no inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, checkpoint, fresh, held_out, slices
from .decontaminate import words
from .quality import known_labels, sampled, shared_udf

#: Bounds of the sample: confirmed positives, unlabelled texts; features of the classifier.
POSITIVES, UNLABELLED, FEATURES = 1500, 6000, 2000
#: A word is a feature if so large a share of the positives has it, and so many deviations more than the unlabelled texts.
LEAST_SHARE, LEAST_Z, FLOOR, RIDGE = 0.02, 6.0, 1e-5, 1e-4
#: Bytes of the beginnings.
BEGINNINGS = (4, 5, 6)
#: Words that a task counts before it sends them on.
KEPT = 300_000


def marks(text: bytes | None) -> set[bytes]:
    """Words, and the beginnings of longer ones, so that inflected forms share a feature."""
    found = set(words(text))
    return found.union(w[:k] + b"*" for k in BEGINNINGS for w in found if len(w) > k)


def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, positive, unlabelled): how many texts of each side have it, summed up within the task."""
    found: tuple[Counter, Counter] = (Counter(), Counter())

    def told() -> pa.RecordBatch:
        seen = list(found[0] | found[1])
        out = pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), *(pa.array([c[m] for m in seen], pa.int64()) for c in (found[1], found[0]))], ["mark", "positive", "unlabelled"])
        found[0].clear()
        found[1].clear()
        return out

    for batch in batches:
        sides = iter(batch["side"].to_pylist())
        for held in slices(batch["text"]):
            for text in held:
                found[next(sides)].update(marks(text))
                if len(found[0]) + len(found[1]) > KEPT:
                    yield told()
    yield told()


def features(sample: DataFrame, n: dict[int, int], most: int) -> list[bytes]:
    """The marks by which positives stand out most."""
    seen = sample.mapInArrow(counts, "mark binary, positive bigint, unlabelled bigint").groupBy("mark").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
    share, rest = (F.col("p") + 0.5) / (n[1] + 1), (F.col("u") + 0.5) / (n[0] + 1)
    z = (share - rest) / F.sqrt(rest * (1 - rest) / n[1] + FLOOR)
    best = seen.filter(F.col("p") >= max(3, LEAST_SHARE * n[1])).select("mark", z.alias("z")).filter(F.col("z") >= LEAST_Z)
    return [bytes(r["mark"]) for r in best.orderBy(F.col("z").desc(), "mark").limit(most).collect()]


class NonNegative:
    """Word weights and an offset."""

    def __init__(self, prior: float):
        self.prior, self.weights = prior, {}
        self.offset = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))

    def fit(self, chosen: list[bytes], positive: list[list[int]], unlabelled: list[list[int]], steps: int = 400) -> None:
        """positive, unlabelled: for each text the places in chosen of what it has."""
        prior, xp, xu = self.prior, sparse(positive), sparse(unlabelled)
        w, b, m, v = np.zeros(len(chosen)), self.offset, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
        sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for t in range(1, steps + 1):
            gp, gu = sigmoid(times(xp, w) + b), sigmoid(times(xu, w) + b)
            soft_p, soft_u = -np.log(1 - gp + 1e-12), -np.log(1 - gu + 1e-12)
            down_u, down_p = turned(xu, gu / len(unlabelled), len(w)), turned(xp, gp / len(positive), len(w))
            negative, slope = soft_u.mean() - prior * soft_p.mean(), down_u - prior * down_p
            up = turned(xp, (gp - 1) / len(positive), len(w)) * prior
            step = up + slope if negative >= 0 else -slope
            step = step + np.append(RIDGE * w, 0)
            m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
            move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        self.weights, self.offset = {x: float(w[i]) for i, x in enumerate(chosen)}, float(b)

    def score(self, text: bytes | None) -> float:
        get = self.weights.get
        z = self.offset + sum(get(w) for w in sorted(self.weights.keys() & marks(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Presence: row and column of each mark."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([x for r in rows for x in r], np.int64), len(rows)


def times(x: tuple, w: np.ndarray) -> np.ndarray:
    return np.bincount(x[0], w[x[1]], x[2])


def turned(x: tuple, g: np.ndarray, n: int) -> np.ndarray:
    """The gradient of the weights and, last, of the offset."""
    return np.append(np.bincount(x[1], g[x[0]], n), g.sum())


def trained(docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str, text_col: str, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> NonNegative:
    known = known_labels(labels, label_col, id_col)
    prior = known.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0] or 0.0
    model = NonNegative(min(max(prior, 0.0), 0.99))
    toxic = bounded_sample(known.filter(F.col("label") == 1), "id", positives).select("id", F.lit(1).alias("side"))
    every = docs.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    sample = sampled(docs, toxic.union(bounded_sample(every, "id", unlabelled).distinct().withColumn("side", F.lit(0))), "side", id_col=id_col, text_col=text_col).filter(F.col("text").isNotNull())
    n = {0: 0, 1: 0} | {r["side"]: r["count"] for r in sample.groupBy("side").count().collect()}
    if not all(n.values()):
        return model
    chosen = features(sample, n, FEATURES)
    place = {x: i for i, x in enumerate(chosen)}
    held = shared_udf(docs, place, lambda by, texts: [sorted(by[x] for x in by.keys() & marks(t)) for t in texts], "array<int>", pa.list_(pa.int32()))
    rows: dict[int, list] = {0: [], 1: []}
    for r in sample.select("side", held("text").alias("has")).orderBy("id").collect():
        rows[r["side"]].append(r["has"])
    model.fit(chosen, rows[1], rows[0])
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", into: str = "score", **sample) -> DataFrame:
    """docs with a score from 0 to 1, higher for text like that confirmed as toxic. positives and unlabelled bound the sample."""
    model = trained(docs, labels, label_col, id_col=id_col, text_col=text_col, **sample)
    score = shared_udf(docs, model, lambda by, held: [by.score(t) for t in held], "double", pa.float64())
    return docs.withColumn(fresh(docs, into), score(F.col(text_col).cast("binary")))
