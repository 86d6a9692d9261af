"""Claims on items as a log of events that is worked off in a stream: who holds what, until when, and what became of each event.

An item is held by one batch at a time, until it is released, merged or its time is over. The fold runs per item, over
the events of one micro-batch and what is known of the item so far; each micro-batch commits the new holdings and its
rulings together, so that one that runs again changes nothing. Holdings are written anew by every micro-batch: one row
per item that was ever claimed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.sources import sinks

KEYS = ["doc_id", "stage", "item_id"]
HELD = "struct<holder:string,until:bigint,done:boolean>"


def outcome(held: Column, e: Column) -> Column:
    """What becomes of event e: a claim of a free item is granted, of one's own renewed, else refused; only the holder, in time, renews, releases or merges; what is merged stays done."""
    own = F.coalesce((held["holder"] == e["batch_id"]) & (e["at"] < held["until"]), F.lit(False))
    free = held["holder"].isNull() | (held["until"] <= e["at"])
    claim = e["kind"] == "claim"
    return (
        F.when(held["done"], "done").when(claim & own, "renewed").when(claim & free, "granted").when(claim, "refused").when(~own, "ignored")
        .when(e["kind"].isin("validate", "fail"), "renewed").when(e["kind"] == "release", "released").when(e["kind"] == "merge", "merged").otherwise("ignored")
    )


def ruled(events: DataFrame, holdings: DataFrame | None, ttl: int) -> DataFrame:
    """doc_id, stage, item_id, held, rulings (at, seq, kind, batch_id, outcome) after events (doc_id, stage, item_id, batch_id, at, seq, kind), taken by at and then seq. holdings: the same keys and held, from before. An event without item, batch or time is none."""
    told = events.dropna(subset=["item_id", "batch_id", "at"])
    log = told.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("at", "seq", "kind", "batch_id"))).alias("log"))
    if holdings is not None:
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}")) for k in KEYS]
        log = log.alias("l").join(holdings.select(*KEYS, "held").alias("h"), same, "full").select(*(F.coalesce(f"l.{k}", f"h.{k}").alias(k) for k in KEYS), "log", "held")
    else:
        log = log.withColumn("held", F.lit(None).cast(HELD))
    kind = "array<struct<at:bigint,seq:bigint,kind:string,batch_id:string,outcome:string>>"
    start = F.struct(F.coalesce("held", F.struct(F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(False)).cast(HELD)).alias("held"), F.array().cast(kind).alias("rulings"))

    def step(acc: Column, e: Column) -> Column:
        held, got = acc["held"], outcome(acc["held"], e)
        after = F.struct(
            F.when(got == "granted", e["batch_id"]).when(~got.isin("released", "merged"), held["holder"]).alias("holder"),
            F.when(got.isin("granted", "renewed"), e["at"] + ttl).when(~got.isin("released", "merged"), held["until"]).alias("until"),
            (held["done"] | (got == "merged")).alias("done"),
        )
        row = F.struct(e["at"].cast("bigint"), e["seq"].cast("bigint"), e["kind"], e["batch_id"], got)
        return F.struct(after.cast(HELD).alias("held"), F.concat(acc["rulings"], F.array(row).cast(kind)).alias("rulings"))

    folded = F.aggregate(F.coalesce("log", F.array().cast("array<struct<at:bigint,seq:bigint,kind:string,batch_id:string>>")), start, step)
    return log.select(*KEYS, folded.alias("f")).select(*KEYS, "f.held", "f.rulings")


def rulings(of: DataFrame) -> DataFrame:
    """One row per event of ruled()."""
    return of.select(*KEYS, F.explode("rulings").alias("r")).select(*KEYS, "r.*")


def work_off(stream: DataFrame, root: str, checkpoint: str, ttl: int) -> None:
    """Rules on what the stream of events has now and commits it under root, an epoch at a time; an epoch that is there already is passed over."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        at, version = sinks.current(spark, root)
        if version is not None and epoch <= int(version.split("-")[0]):
            return
        before = spark.read.parquet(f"{root}/v={version}/holdings") if version is not None else None
        name = f"{epoch}-{uuid.uuid4().hex}"
        done = ruled(batch, before, ttl).persist()
        try:
            sinks.commit({"holdings": done.select(*KEYS, "held"), "rulings": rulings(done).withColumn("version", F.lit(name))}, root, name, at)
        finally:
            done.unpersist()

    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def holdings(spark: SparkSession, root: str) -> DataFrame:
    """Items with held as of the last commit."""
    return sinks.read_commit(spark, root, "holdings")[1]["holdings"]


def all_rulings(spark: SparkSession, root: str) -> DataFrame:
    """The rulings of all committed epochs; what a failed one left behind does not count."""
    versions = spark.read.schema("at BIGINT, version STRING").json(f"{root}/commits").select("version")
    return spark.read.parquet(f"{root}/v=*/rulings").join(versions, "version", "left_semi")
