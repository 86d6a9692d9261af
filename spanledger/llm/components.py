"""Connected components of a table of links; no neighbourhood is ever collected."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


class Linked:
    """Union-find over what a task has met; it sends each node on with the least one that it leads to."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def links(self) -> list[tuple]:
        return [(x, r) for x in self.up if (r := self.find(x)) != x]


LINKS = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("moved", pa.bool_())])


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links as stars. moved: a link was brought forward before, or a node got one that has none of its own here."""
    linked, own, moved = Linked(), set(), False
    for batch in batches:
        here = batch["a"].to_pylist()
        own.update(here)
        moved = moved or any(batch["moved"].to_pylist())
        for a, b in zip(here, batch["b"].to_pylist(), strict=True):
            linked.join(a, b)
    out = linked.links()
    yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.binary()), pa.array([moved or a not in own for a, _ in out], pa.bool_())], schema=LINKS)


def components(links: DataFrame, rounds: int = 80) -> DataFrame:
    """node, root: the least node of its component, for every binary node in links (a, b).

    Each round moves every link on to where its lower end leads, by a join, and then contracts the links of each task
    to stars; they are dealt by their upper end, which has at most a few links per task. It ends when nothing moved.
    """
    deal = lambda df: df.repartition("a").mapInArrow(contract, "a binary, b binary, moved boolean")
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    state = checkpoint(deal(down.select("a", "b", F.lit(False).alias("moved"))))
    for _ in range(rounds):
        lower = state.select(F.col("a").alias("at"), F.col("b").alias("to"))
        on = state.select("a", "b").join(lower, F.col("b") == F.col("at"), "left")
        state = checkpoint(deal(on.select("a", F.coalesce("to", "b").alias("b"), F.col("to").isNotNull().alias("moved"))))
        if not state.filter("moved").head(1):
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
