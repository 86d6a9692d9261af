"""Work packets: what is open, what came back, how it is merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.text import canonical_quote, trim_unicode

from .annotate import mark_pending
from .graph import first_wins
from .statements import construct

# States in which a claim still holds its items.
HOLDING = ("claimed", "validated", "failed")


def pending(items: DataFrame, done: DataFrame, claimed: DataFrame, key: str, order: list, limit: int) -> DataFrame:
    """The first items that are neither done nor claimed."""
    return items.join(done, key, "left_anti").join(claimed, key, "left_anti").orderBy(*order).limit(limit)


def validate(inputs: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """key, status of every item that is extra, missing or answered more than once."""
    n_in = inputs.groupBy(key).agg(F.count(F.lit(1)).alias("n_in"))
    n_out = outputs.groupBy(key).agg(F.count(F.lit(1)).alias("n_out"))
    t = n_in.join(n_out, key, "full")
    status = F.when(F.col("n_in").isNull(), "extra").when(F.col("n_out").isNull(), "missing").when(F.col("n_out") > 1, "duplicate")
    return t.select(key, status.alias("status")).filter("status IS NOT NULL")


def merge(existing: DataFrame, incoming: DataFrame, key: str, order: list) -> DataFrame:
    """existing and, of incoming, the first row of each key that is not there yet."""
    new = first_wins(incoming, [key], order).join(existing, key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


def claim_overlap(active: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    return active.select(key).intersect(wanted.select(key))


def chunks(rows: DataFrame, key: str, order: list, size: int = 140, above: int = 260) -> DataFrame:
    """rows with a chunk number per key: chunks of size if a key has more than above rows, else one."""
    w = Window.partitionBy(key).orderBy(*order)
    many = F.count(F.lit(1)).over(Window.partitionBy(key))
    return rows.withColumn("chunk", F.when(many > above, F.floor((F.row_number().over(w) - 1) / size)).otherwise(0).cast("bigint"))


def next_number(rows: DataFrame, id_col: str) -> DataFrame:
    """doc_id, last: the greatest number of ids like R00012, 0 if none."""
    return rows.groupBy("doc_id").agg(F.coalesce(F.max(F.expr(f"try_cast(substring({id_col}, 2) AS INT)")), F.lit(0)).alias("last"))


def claims_summary(claims: DataFrame) -> DataFrame:
    """stage, status, n_claims, n_items by status, by stage and in all."""
    return claims.rollup("stage", "status").agg(F.count(F.lit(1)).alias("n_claims"), F.sum("item_count").alias("n_items"))


def export(items: DataFrame, done: DataFrame, claims: DataFrame, stage: str, batch_id: str, key: str, order: list, limit: int = 50) -> tuple[DataFrame, DataFrame]:
    """The next packet of a stage, and its manifest as a new row of claims (stage, batch_id, status, item_count, item_ids): items that are neither done nor in a claim of the stage that still holds them."""
    taken = claims.filter((F.col("stage") == stage) & F.col("status").isin(*HOLDING)).select(F.explode("item_ids").alias(key)).distinct()
    packet = pending(items, done, taken, key, order, limit)
    ids = F.array_sort(F.collect_list(key))  # of limit items at most
    manifest = packet.agg(F.count(F.lit(1)).cast("int").alias("item_count"), ids.alias("item_ids"))
    return packet, manifest.select(F.lit(stage).alias("stage"), F.lit(batch_id).alias("batch_id"), F.lit("claimed").alias("status"), "item_count", "item_ids")


def failures(inputs: DataFrame, rows: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, span_id, failure, n of a packet's answers rows (doc_id, span_id, statements: array of structs with verbatim_quote): spans that were not asked, not answered or answered again, lists that are null, quotes that their span lacks."""
    keys = ["doc_id", "span_id"]
    per = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_out"), F.count_if(F.col("statements").isNull()).alias("no_list"))
    t = inputs.select(*keys).distinct().withColumn("asked", F.lit(True)).join(per, keys, "full")
    known = F.col("asked").isNotNull()
    fault = lambda when, name, n: F.when(when, F.struct(F.lit(name).alias("failure"), n.cast("bigint").alias("n")))
    n = F.col("n_out")
    told = F.array_compact(F.array(fault(~known, "not in packet", n), fault(n.isNull(), "missing", F.lit(1)), fault(known & (n > 1), "duplicate", n - 1), fault(known & (F.col("no_list") > 0), "no list", F.col("no_list"))))
    shape = t.select(*keys, F.explode(told).alias("f")).select(*keys, "f.failure", "f.n")
    quotes = rows.join(inputs.select(*keys).distinct(), keys, "left_semi").select(*keys, F.explode("statements").alias("s")).join(spans.select(*keys, "text"), keys)
    quote = trim_unicode(F.coalesce("s.verbatim_quote", F.lit("")))
    bad = quotes.filter((quote == "") | ~F.contains("text", canonical_quote(quote, F.col("text"))))
    return shape.unionByName(bad.groupBy(*keys).agg(F.lit("quote not found").alias("failure"), F.count(F.lit(1)).alias("n")))


def merge_statements(rows: DataFrame, classes: DataFrame, statements: DataFrame, spans: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New statements and classes after a packet of rows (doc_id, span_id, row, statements: array of structs).

    Spans that have statements keep them. For others the first row with any supplies them, numbered on from last in the
    packet's order, and a span that waited for a downgrade decision no longer does; spans with empty rows only begin to wait.
    """
    keys = ["doc_id", "span_id"]
    held = statements.select("doc_id", F.col("source_span_id").alias("span_id")).distinct()
    open_rows = rows.join(held, keys, "left_anti")
    full = first_wins(open_rows.filter(F.size("statements") > 0), keys, ["row"])
    made = construct(full.select("doc_id", "span_id", "row", F.posexplode("statements").alias("seq", "s")).select("doc_id", "span_id", "row", "seq", "s.*"), spans, last, ("row", "seq"))
    if "downgrade_pending" not in classes.columns:
        classes = classes.withColumn("downgrade_pending", F.lit(False))
    empty = open_rows.select(*keys).distinct().join(full.select(*keys), keys, "left_anti")
    waits = mark_pending(classes.join(empty, keys, "left_semi"), statements)
    rest = classes.join(empty, keys, "left_anti").join(full.select(*keys, F.lit(True).alias("full")), keys, "left")
    rest = rest.withColumn("downgrade_pending", F.coalesce("downgrade_pending", F.lit(False)) & F.col("full").isNull()).drop("full")
    return made, rest.unionByName(waits, allowMissingColumns=True)


def merge_edges(rows: DataFrame) -> DataFrame:
    """The edges that a packet puts in place of all others: rows (doc_id, seq, src, dst, type, ...), the first of each, numbered in order."""
    once = first_wins(rows, ["doc_id", "src", "dst", "type"], ["seq"])
    return once.withColumn("rel_id", F.format_string("E%04d", F.row_number().over(Window.partitionBy("doc_id").orderBy("seq"))))
