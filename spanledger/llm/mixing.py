"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source's rate is its target share of all bytes over its own bytes: the mean number of copies of each of its documents.
A document's count inverts the Poisson distribution of that mean at a uniform number hashed from seed and id, so the mix
is the same on every run. Each document is exploded by its count; a hash of seed, id and copy deals and orders all rows.

Defined cases: a null source is a source of its own; a null id counts as one id; a source without bytes keeps rate 1;
with given weights, sources that have none are left out; repeated rows get the same count and ties of order stay as they
fall; null, empty and very long texts are copied like others; an empty table gives no rows; a column of the replica's name
stays, the replica then gets underscores. Means above PIECE are sums of independent smaller ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, fresh

#: The largest mean that is inverted in one step.
PIECE = 256
#: The sources of most documents, whose rates are broadcast; a row is below 6 KB. Of what is left no source has many documents.
BROADCAST_SOURCES = 2000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the parts' md5."""
    text = F.concat_ws("|", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def cumulated(mean: Column) -> Column:
    """P(X <= k) of the Poisson distribution for k from 0 until nothing is left."""
    most = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), F.array_append(acc["cdf"], acc["sum"] + p).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda acc: acc["cdf"])


def rates(docs: DataFrame, *, source_col: str = "source", text_col: str = "text", weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """source, bytes, docs, rate. Targets are the given weights, or else bytes to the given power, scaled to sum 1."""
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0))).alias("bytes"), F.count(F.lit(1)).alias("docs"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(power))
    else:
        given = F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))))
        weight = F.coalesce(F.element_at(given, F.col("source")), F.lit(0.0))
    sizes = checkpoint(sizes.withColumn("weight", weight))
    total = sizes.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight")).first()
    factor = epochs * (total["all_bytes"] or 0) / total["all_weight"] if total["all_weight"] else 0.0
    rate = F.when(F.col("bytes") > 0, F.col("weight") * F.lit(factor) / F.col("bytes")).otherwise(F.lit(1.0) if weights is None else F.when(F.col("weight") > 0, 1.0).otherwise(0.0))
    return sizes.select("source", "bytes", "docs", rate.alias("rate"))


def mix(docs: DataFrame, *, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", seed: int = 7, replica_col: str = "replica", **targets) -> DataFrame:
    """docs with a replica number from 1 on, each document as often as its count says, in an order shuffled over all."""
    by = checkpoint(rates(docs, source_col=source_col, text_col=text_col, **targets))
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    key, cdf, many, count, order = (fresh(docs, x) for x in ("mix_source", "mix_cdf", "mix_pieces", "mix_count", "mix_order"))
    named = lambda source: F.coalesce(F.concat(F.lit("="), source), F.lit(""))
    curves = lambda rows: rows.select(named(F.col("source")).alias(key), pieces.alias(many), cumulated(F.col("rate") / pieces).alias(cdf))
    keyed = docs.withColumn(key, named(F.col(source_col).cast("string")))
    if by.count() <= BROADCAST_SOURCES:
        rows = keyed.join(F.broadcast(curves(by)), key)
    else:
        hot = checkpoint(by.orderBy(F.col("docs").desc(), "source").limit(BROADCAST_SOURCES))
        names = F.broadcast(hot.select(named(F.col("source")).alias(key)))
        rest = by.join(F.broadcast(hot.select("source")), by["source"].eqNullSafe(hot["source"]), "left_anti")
        rows = keyed.join(F.broadcast(curves(hot)), key).unionByName(keyed.join(names, key, "left_anti").join(curves(rest), key))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    numbers = F.transform(F.sequence(F.lit(1), F.col(many)), lambda j: uniform(F.lit(seed), name, j))
    total = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter(F.col(cdf), lambda c: c <= u)))
    copies = rows.withColumn(count, total).filter(F.col(count) > 0)
    replica = fresh(docs, replica_col)
    copies = copies.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(count))).alias(replica))
    dealt = copies.withColumn(order, F.md5(F.concat_ws("|", F.lit(str(seed)), name, F.col(replica).cast("string")).cast("binary")))
    return dealt.repartition(order).sortWithinPartitions(order).drop(order)
