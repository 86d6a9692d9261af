"""Coverage: every byte in exactly one span, every obligation with a statement, every quote verbatim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lines import by_doc

BEARING = "requirement_bearing"


def gaps_and_overlaps(spans: DataFrame, sizes: DataFrame) -> DataFrame:
    """doc_id, total_bytes, n_spans, covered_bytes, n_gaps, gap_bytes, n_overlaps for sizes (doc_id, total_bytes).

    A start is held against the greatest end so far, so that a nested span hides no gap; the rest of a text is a gap too.
    """
    w = by_doc("byte_start", "byte_end")
    far = F.coalesce(F.max("byte_end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    at = spans.select("doc_id", "byte_start", "byte_end", far.alias("far"))
    gap = F.greatest(F.col("byte_start") - F.col("far"), F.lit(0))
    held = at.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("byte_end") - F.col("byte_start")).alias("covered_bytes"), F.count_if(gap > 0).alias("n_gaps"), F.sum(gap).alias("gap_bytes"), F.count_if(F.col("byte_start") < F.col("far")).alias("n_overlaps"), F.max("byte_end").alias("last"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    tail = F.greatest(F.col("total_bytes") - zero("last"), F.lit(0))
    return sizes.join(held, "doc_id", "left").select("doc_id", "total_bytes", zero("n_spans").alias("n_spans"), zero("covered_bytes").alias("covered_bytes"), (zero("n_gaps") + F.when(tail > 0, 1).otherwise(0)).alias("n_gaps"), (zero("gap_bytes") + tail).alias("gap_bytes"), zero("n_overlaps").alias("n_overlaps"))


def coverage(spans: DataFrame, sizes: DataFrame) -> DataFrame:
    """gaps_and_overlaps with the share covered and whether the text is tiled."""
    pct = F.when(F.col("total_bytes") > 0, F.round(F.col("covered_bytes") / F.col("total_bytes") * 100, 6)).otherwise(F.lit(0.0))
    return gaps_and_overlaps(spans, sizes).withColumn("coverage_pct", pct).withColumn("passed", (F.col("n_gaps") == 0) & (F.col("n_overlaps") == 0))


def is_bearing(label: str = "final_label", embedded: str = "final_embedded") -> Column:
    return F.coalesce((F.col(label) == BEARING) | F.array_contains(embedded, BEARING), F.lit(False))


def unclassified(spans: DataFrame, classes: DataFrame) -> DataFrame:
    return spans.join(classes, ["doc_id", "span_id"], "left_anti")


def without_statements(classes: DataFrame, statements: DataFrame) -> DataFrame:
    """Bearing spans that have no statement; downgrade_pending tells those that wait for a decision."""
    owned = statements.select("doc_id", F.col("source_span_id").alias("span_id"))
    return classes.filter(is_bearing()).join(owned, ["doc_id", "span_id"], "left_anti")


def quote_failures(statements: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, req_id, failure: a missing span, a quote that is only loosely there, or one that is not there at all."""
    from spanledger.functions.text import loose_contains

    text = spans.select("doc_id", F.col("span_id").alias("source_span_id"), "text")
    at = statements.join(text, ["doc_id", "source_span_id"], "left")
    quote = F.coalesce("verbatim_quote", F.lit(""))
    why = F.when(F.col("text").isNull(), "missing_span").when(quote == "", "empty_quote").when(F.contains("text", quote), None).when(loose_contains(F.col("text"), quote), "whitespace_only").otherwise("not_in_span")
    return at.select("doc_id", "req_id", why.alias("failure")).filter("failure IS NOT NULL")


def gate(sizes: DataFrame, spans: DataFrame, classes: DataFrame, statements: DataFrame) -> DataFrame:
    """One row per document: the counts of each check, whether all hold, and a message of those that do not, in fixed order."""
    zero = F.lit(0).cast("bigint")
    per = lambda df, name: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    waiting = without_statements(classes, statements).withColumn("pending", F.coalesce("downgrade_pending", F.lit(False)))
    known = classes.select("doc_id").distinct().withColumn("has_classes", F.lit(True))
    tables = [per(unclassified(spans, classes), "unclassified"), per(waiting.filter(~F.col("pending")), "unrequirementized"), per(waiting.filter("pending"), "downgrade_pending"), per(quote_failures(statements, spans), "quote_failures"), per(classes.filter("ambiguous"), "ambiguous"), known]
    out = coverage(spans, sizes)
    for t in tables:
        out = out.join(t, "doc_id", "left")
    checks = ["n_gaps", "n_overlaps", "unclassified", "unrequirementized", "downgrade_pending", "quote_failures", "ambiguous"]
    out = out.withColumn("unclassified", F.when(F.col("has_classes"), F.col("unclassified"))).drop("has_classes").withColumns({c: F.coalesce(F.col(c), zero) for c in checks})
    told = F.concat_ws("; ", *(F.when(F.col(c) > 0, F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in checks if c != "ambiguous"))
    hard = [c for c in checks if c != "ambiguous"]
    passed = F.lit(True)
    for c in hard:
        passed = passed & (F.col(c) == 0)
    return out.withColumn("passed", passed).withColumn("message", told)


def label_counts(spans: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id, label, n: by final label, or by kind where a document has no classes."""
    known = classes.select("doc_id").distinct().withColumn("known", F.lit(True))
    at = spans.join(classes.select("doc_id", "span_id", "final_label"), ["doc_id", "span_id"], "left").join(known, "doc_id", "left")
    return at.groupBy("doc_id", F.when(F.col("known"), F.coalesce("final_label", F.lit("unclassified"))).otherwise(F.col("kind")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def containing_span(hits: DataFrame, spans: DataFrame, *carry: str) -> DataFrame:
    """hits (doc_id, at, ...) with the span that holds the byte, and its columns named in carry; null if none.

    Spans tile their text, so this is an as-of join: starts and hits in one order, the last start carried on. No range
    join, and no key but the document.
    """
    cols = [c for c in hits.columns if c not in ("doc_id", "at")]
    starts = spans.select("doc_id", F.col("byte_start").alias("at"), F.struct("span_id", F.col("byte_end").cast("bigint").alias("byte_end"), *carry).alias("start"), *(F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in cols), F.lit(0).alias("side"))
    asks = hits.select("doc_id", "at", F.lit(None).cast(starts.schema["start"].dataType).alias("start"), *cols, F.lit(1).alias("side"))
    w = by_doc("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    held = starts.unionByName(asks).withColumn("start", F.last("start", True).over(w)).filter("side = 1")
    return held.select("doc_id", "at", *cols, *(F.when(F.col("at") < F.col("start.byte_end"), F.col(f"start.{c}")).alias(c) for c in ("span_id", *carry)))


def highlight_depth(ranges: DataFrame) -> DataFrame:
    """doc_id, at, depth: how many ranges (doc_id, start, end) are open from each place on where that changes; starts come before ends."""
    events = ranges.select("doc_id", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e"))
    changes = events.groupBy("doc_id", F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    return changes.withColumn("depth", F.sum("d").over(by_doc("at").rowsBetween(Window.unboundedPreceding, 0))).select("doc_id", "at", "depth")


def active_segments(ranges: DataFrame, lengths: DataFrame) -> DataFrame:
    """doc_id, start, end, ids, anchor: the pieces into which the ends of ranges (doc_id, start, end, id) cut each text of
    lengths (doc_id, length), with the sorted ids open over each piece; anchor is the least of them, null where none is.

    Cut points are numbered by one window per document; a range then is a run of piece numbers, exploded, so that what is
    collected is the ids of one piece alone, never a document's events. Ranges beyond the text are clipped; empty ones cut
    but open nothing; equal ids count once.
    """
    held = ranges.join(lengths, "doc_id")
    points = held.select("doc_id", "length", F.explode(F.array("start", "end")).alias("at")).filter("at >= 0 AND at <= length").select("doc_id", "at")
    points = points.union(lengths.select("doc_id", F.explode(F.array(F.lit(0).cast("bigint"), F.col("length").cast("bigint"))).alias("at"))).distinct()
    w = by_doc("at")
    numbered = points.withColumn("no", F.row_number().over(w)).withColumn("next", F.lead("at").over(w))
    at = lambda c, name: numbered.select("doc_id", F.col("at").alias(c), F.col("no").alias(name))
    clipped = held.select("doc_id", "id", F.greatest("start", F.lit(0)).alias("start"), F.least("end", "length").alias("end")).filter("start < end")
    runs = clipped.join(at("start", "first"), ["doc_id", "start"]).join(at("end", "last"), ["doc_id", "end"])
    open_ = runs.select("doc_id", "id", F.explode(F.sequence("first", F.col("last") - 1)).alias("no"))
    ids = open_.groupBy("doc_id", "no").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    t = numbered.filter("next IS NOT NULL").join(ids, ["doc_id", "no"], "left")
    ids = F.coalesce("ids", F.array().cast(ids.schema["ids"].dataType))
    return t.select("doc_id", F.col("at").alias("start"), F.col("next").alias("end"), ids.alias("ids")).withColumn("anchor", F.get("ids", 0))
