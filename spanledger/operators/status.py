"""Where a catalog stands: counters, registry lists, claims, and the lists that reports show."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .audit import is_bearing, without_statements


def pipeline_status(spans: DataFrame, classes: DataFrame, statements: DataFrame, edges: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per document of spans: the nine counters of a catalog. candidates (doc_id, span_id) wait for the embedded audit."""
    per = lambda df, name: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    known = classes.groupBy("doc_id").agg(F.countDistinct("span_id").alias("classifications"), F.count_if(is_bearing()).alias("bearing_spans"), F.count_if(F.coalesce("downgrade_pending", F.lit(False))).alias("downgrades_pending"))
    due = without_statements(classes, statements).filter(~F.coalesce("downgrade_pending", F.lit(False)))
    out = per(spans, "spans")
    for t in (known, per(statements, "statements"), per(due, "decompose_pending"), per(candidates, "embedded_pending"), per(edges, "edges")):
        out = out.join(t, "doc_id", "left")
    return out.na.fill(0).withColumn("classification_pending", F.col("spans") - F.col("classifications"))


def list_registry(registry: DataFrame, jurisdiction: str | None = None, status: str | None = None, tag: str | None = None) -> DataFrame:
    """Rows of registry (doc_id, jurisdiction, status, applies_to) that meet every filter given, by doc_id."""
    out = registry
    if jurisdiction is not None:
        out = out.filter(F.col("jurisdiction") == jurisdiction)
    if status is not None:
        out = out.filter(F.col("status") == status)
    if tag is not None:
        out = out.filter(F.array_contains("applies_to", tag))
    return out.orderBy("doc_id")


def released(claims: DataFrame, release: DataFrame) -> DataFrame:
    """claims (stage, batch_id, status, ...) with those of release (stage, batch_id) released, unless they are merged already."""
    hit = release.select("stage", "batch_id").distinct().withColumn("hit", F.lit(True))
    free = F.coalesce("hit", F.lit(False)) & (F.col("status") != "merged")
    return claims.join(hit, ["stage", "batch_id"], "left").withColumn("status", F.when(free, "released").otherwise(F.col("status"))).drop("hit")


def top(rows: DataFrame, n: int, *order) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def divergent(log: DataFrame, more_than: int = 3, n: int = 10) -> DataFrame:
    """The n log rows on which the two annotators' counts differ most, by more than so many."""
    apart = F.abs(F.col("count_a") - F.col("count_b"))
    return top(log.filter(apart > more_than).withColumn("apart", apart), n, F.col("apart").desc(), "doc_id", "span_id")


def latest_log(log: DataFrame) -> DataFrame:
    """Of log rows (run_id, doc_id, stage, key, ...) those of each document's and stage's last run, so that runs again do not add up."""
    last = Window.partitionBy("doc_id", "stage")
    return log.withColumn("last", F.max("run_id").over(last)).filter("run_id = last").drop("last")


def safety_net(log: DataFrame) -> DataFrame:
    """doc_id, rescued, filtered of the embedded audit's log (doc_id, decision), and a total with doc_id null; documents with neither are left out."""
    n = lambda d: F.count_if(F.col("decision") == d)
    out = log.filter(F.col("decision").isin("embedded_obligation_added", "false_positive")).rollup("doc_id")
    return out.agg(n("embedded_obligation_added").alias("rescued"), n("false_positive").alias("filtered"))


def decision_summary(decided: DataFrame) -> DataFrame:
    return decided.groupBy("decision").agg(F.count(F.lit(1)).alias("n_parts"), F.sum("n_refs").cast("bigint").alias("n_refs"))


def cited_parts(refs: DataFrame, n: int = 15) -> DataFrame:
    """part, n: every part number in the citation texts of unresolved references, the most cited first."""
    found = F.regexp_extract_all("citation", F.lit(r"(?i)\b(?:part\s+|21\s+CFR\s+|§§?\s*)(\d+)(?:\.\d+)?"), F.lit(1))
    each = refs.filter(~F.col("auto_resolved")).select(F.explode(found).alias("part"))
    return top(each.groupBy("part").agg(F.count(F.lit(1)).alias("n")), n, F.col("n").desc(), F.col("part").cast("bigint"))


def markers_missing(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, found, common, missing: distinct paragraph markers that start a line, those that end a span's path, and those that do not."""
    marker = F.regexp_extract("line", r"^\(([a-z0-9]{1,5})\)", 1)
    found = lines.select("doc_id", marker.alias("marker")).filter("marker <> ''").distinct()
    held = spans.filter(F.size("path") > 0).select("doc_id", F.element_at("path", -1).alias("marker"), F.lit(1).alias("held")).distinct()
    t = found.join(held, ["doc_id", "marker"], "left").groupBy("doc_id").agg(F.count(F.lit(1)).alias("found"), F.count("held").alias("common"))
    return t.withColumn("missing", F.col("found") - F.col("common"))


def downgrade_history(classes: DataFrame, said: str = "found 0 obligations", most: int = 5) -> DataFrame:
    """doc_id, span_id, n: the first classes of each document whose note says so, and how many there are."""
    w = Window.partitionBy("doc_id")
    hit = classes.filter(F.contains("note", F.lit(said))).withColumn("n", F.count(F.lit(1)).over(w))
    return hit.withColumn("rn", F.row_number().over(w.orderBy("span_id"))).filter(F.col("rn") <= most).select("doc_id", "span_id", "n")


def char_offsets(lines: DataFrame) -> DataFrame:
    """lines (doc_id, line_no, line) with char_start beside byte_start: where each line starts in characters and in bytes."""
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda size: F.coalesce(F.sum(size("line") + 1).over(w), F.lit(0)).cast("bigint")
    return lines.select("doc_id", "line_no", before(F.octet_length).alias("byte_start"), before(F.length).alias("char_start"))


def page_numbers(lines: DataFrame) -> DataFrame:
    """doc_id, seq, page, line: lines cut at form feeds, the page rising at each; empty pieces beside a feed are kept."""
    pieces = lines.select("doc_id", "line_no", F.posexplode(F.split("line", "\f")).alias("piece", "line"))
    w = Window.partitionBy("doc_id").orderBy("line_no", "piece")
    page = F.sum(F.when(F.col("piece") > 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1
    return pieces.select("doc_id", F.row_number().over(w).cast("bigint").alias("seq"), page.cast("bigint").alias("page"), "line")
