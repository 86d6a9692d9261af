"""Quality by compression: zstandard dictionaries of good and bad text.

Half of a bounded, hash-chosen sample of labelled rows trains one dictionary per class. A text's features are the
normalised difference of its compressed sizes under the two and the share that the good one leaves; a logistic curve
fitted on the other half makes them a score.

The sample's bounds are parameters: rows per class, and bytes that a text gives to a dictionary. A longer text gives
evenly spaced parts of itself, so long texts teach too; the curve is fitted, and every score made, on whole texts.

Defined cases: null and empty texts have features 0 and get the score there; very long texts are compressed in parts, all
of them; rows with null labels, and documents with conflicting ones, teach nothing; of documents that repeat an id the
least text teaches; without rows of a class every score is the share of good labels (0.5 without labels); an empty table
gives no rows; repeated rows are scored row by row; a column of the output's name stays, the output then gets
underscores; other columns stay and are no inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow, bounded_sample, checkpoint, fresh, held_out, slices

#: Labelled rows taken per class, and the bytes that a text gives to a dictionary.
SAMPLE_ROWS, SAMPLE_TEXT = 1500, 20_000
DICTIONARY = 112 << 10
#: Texts are compressed in parts of so many bytes, all of them, so that the dictionaries weigh as much at the end of a long text.
PART = 512


def known_labels(labels: DataFrame, label_col: str, id_col: str) -> DataFrame:
    """id, label of documents that are not held out and whose labels do not conflict."""
    rows = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    both = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
    return both.filter(F.col("label") == F.col("most")).select("id", F.col("label").cast("int").alias("label"))


def sampled(docs: DataFrame, ids: DataFrame, *keep: str, id_col: str, text_col: str) -> DataFrame:
    """id, keep..., text of the documents of ids, a table of known bound; the least text of those that repeat an id."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return checkpoint(texts.join(F.broadcast(ids), "id").groupBy("id", *keep).agg(F.min("text").alias("text")))


class Compressed:
    """Two dictionaries (bad, good) and a curve over the sizes that they leave."""

    def __init__(self, share: float, dictionaries: list[tuple[bytes, int]] | None = None, level: int = 3):
        self.level, self.dictionaries = level, dictionaries
        self.curve = (np.zeros(3), np.ones(3), np.array([0, 0, 0, np.log(max(share, 1e-6) / max(1 - share, 1e-6))]))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def features(self, text: bytes | None) -> tuple[float, float, float]:
        """The normalised difference of the sizes, and the share left under the good dictionary, once and squared; all shrink to 0 with short texts."""
        if not text or not self.dictionaries:
            return 0.0, 0.0, 0.0
        if not hasattr(self, "_by"):
            self._by = [zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind), write_content_size=False, write_dict_id=False) for d, kind in self.dictionaries]
        bad, good = (sum(len(c.compress(text[i : i + PART])) for i in range(0, len(text), PART)) for c in self._by)
        n = len(text)
        shrink, left = n / (n + 150), np.log((good + 9) / (n + 9))
        return shrink * (bad - good) / (bad + good), shrink * left, shrink * left * left

    def scores(self, texts: list[bytes | None]) -> list[float]:
        mean, scale, beta = self.curve
        x = (np.array([self.features(t) for t in texts], float).reshape(-1, 3) - mean) / scale
        return (1 / (1 + np.exp(-np.clip(x @ beta[:3] + beta[3], -30, 30)))).tolist()


def dictionary(texts: list[bytes], size: int) -> tuple[bytes, int]:
    """A trained dictionary; of too few texts, the texts themselves."""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, texts)) // 4), texts).as_bytes(), zstandard.DICT_TYPE_FULLDICT
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:], zstandard.DICT_TYPE_RAWCONTENT


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (last: offset) by Newton steps; both classes weigh alike, so that a rare one keeps its say."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    design, beta = np.c_[(x - mean) / scale, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    w = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = (design * (w * p * (1 - p))[:, None]).T @ design + np.eye(len(beta)) * ridge * len(y)
        beta = beta + np.linalg.solve(curve, design.T @ (w * (y - p)) - ridge * len(y) * beta)
    return mean, scale, beta


def shared_udf(docs: DataFrame, model: object, f: Callable, kind: str, of: pa.DataType) -> Callable:
    """f(model, texts) as a function of a binary column; the model is sent to each task once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by = shared.value
        for texts in parts:
            yield pa.array([x for held in slices(texts) for x in f(by, held)], of)

    return arrow(run, kind)


def trained(docs: DataFrame, labels: DataFrame, label_col: str, *, id_col: str, text_col: str, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_TEXT) -> Compressed:
    known = known_labels(labels, label_col, id_col).filter(F.col("label").isin(0, 1))
    few = [bounded_sample(known.filter(F.col("label") == c), "id", rows) for c in (0, 1)]
    turn = Window.partitionBy("label").orderBy(F.xxhash64(F.col("id").cast("string")), "id")  # over the bounded sample
    ids = few[0].union(few[1]).withColumn("half", F.row_number().over(turn) % 2)
    sample = sampled(docs, ids, "label", "half", id_col=id_col, text_col=text_col).filter(F.octet_length("text") > 0)
    parts = F.sequence(F.lit(0), F.lit(max(1, longest // PART) - 1))
    step = F.floor(F.octet_length("text") / max(1, longest // PART)).cast("int")
    given = F.when(F.octet_length("text") <= longest, F.array("text")).otherwise(F.transform(parts, lambda i: F.substring(F.col("text"), i * step + 1, F.lit(PART))))
    halves: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sample.filter(F.col("half") == 1).select("label", given.alias("given")).orderBy("id").collect():
        halves[r["label"]].append(b"".join(map(bytes, r["given"])))
    share = sample.agg(F.avg("label")).first()[0]
    model = Compressed(0.5 if share is None else share)
    if all(halves.values()):
        model.dictionaries = [dictionary(halves[c], DICTIONARY) for c in (0, 1)]
        features = shared_udf(docs, model, lambda by, held: [by.features(t) for t in held], "array<double>", pa.list_(pa.float64()))
        rest = sample.filter(F.col("half") == 0).select("id", "label", features("text").alias("x")).orderBy("id").collect()
        if {r["label"] for r in rest} == {0, 1}:
            model.curve = logistic(np.array([r["x"] for r in rest]), np.array([r["label"] for r in rest], float))
        else:
            model.dictionaries = None
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", into: str = "score", **sample) -> DataFrame:
    """docs with a score from 0 to 1, higher for text like that labelled 1. rows and longest bound the sample."""
    model = trained(docs, labels, label_col, id_col=id_col, text_col=text_col, **sample)
    score = shared_udf(docs, model, lambda by, held: by.scores(held), "double", pa.float64())
    return docs.withColumn(fresh(docs, into), score(F.col(text_col).cast("binary")))
