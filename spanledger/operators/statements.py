"""Statements and edges made from what annotators returned: constructed, reconciled, completed, and asked about again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.text import canonical_quote, clean_tags, coerce_modality, trim_unicode

from .annotate import mark_pending, same_multiset
from .audit import without_statements
from .graph import first_wins, valid_edges

# The types of an edge.
EDGE_TYPES = ("refines", "references", "exception_to", "conditional_on", "defined_by", "composed_of")


def construct(rows: DataFrame, spans: DataFrame, last: DataFrame | None = None, order: tuple[str, ...] = ("span_id", "seq")) -> DataFrame:
    """Statements of rows (doc_id, span_id, seq, verbatim_quote, atomic_statement, modality, tags, conditions, ambiguous): the quote as the span has it, texts trimmed, tags cleaned, numbered by order on from last (doc_id, last).

    A span without a citation is cited by its id; rows of unknown spans are left out.
    """
    t = rows.join(spans.select("doc_id", "span_id", "text", "citation"), ["doc_id", "span_id"])
    said = lambda c: trim_unicode(F.coalesce(F.col(c), F.lit("")))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    if last is not None:
        t = t.join(last.select("doc_id", "last"), "doc_id", "left")
        number = number + F.coalesce("last", F.lit(0))
    conditions = F.transform(F.filter("conditions", lambda c: c.isNotNull() & (c != "")), trim_unicode)
    return t.select(
        "doc_id", F.format_string("R%05d", number.cast("bigint")).alias("req_id"), F.col("span_id").alias("source_span_id"), F.coalesce(F.nullif("citation", F.lit("")), "span_id").alias("citation_raw"),
        canonical_quote(said("verbatim_quote"), F.col("text")).alias("verbatim_quote"), said("atomic_statement").alias("atomic_statement"), coerce_modality(F.col("modality")).alias("modality"),
        clean_tags(F.col("tags")).alias("tags"), conditions.alias("conditions"), F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"),
    )


def reconciled(rows: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and the log (doc_id, span_id, count_a, count_b, count_final, ambiguous_items, status), of rows by agents a, b and r.

    Where a and b hold the same quotes as often, a's rows stand. Elsewhere those of r do, and the log says how many each had.
    """
    keys = ["doc_id", "span_id"]
    of = lambda agent: rows.filter(F.col("agent") == agent)
    # spans of which neither has a row agree on none
    equal = same_multiset(of("a"), of("b"), keys, "verbatim_quote")
    t = rows.join(equal, keys, "left")
    agree = F.coalesce("equal", F.lit(True))
    kept = t.filter(agree & (F.col("agent") == "a") | ~agree & (F.col("agent") == "r")).drop("equal")
    n = lambda agent: F.count_if(F.col("agent") == agent)
    items = F.count_if((F.col("agent") == "r") & F.coalesce("ambiguous", F.lit(False)))
    log = t.filter(~agree).groupBy(*keys).agg(n("a").alias("count_a"), n("b").alias("count_b"), n("r").alias("count_final"), items.alias("ambiguous_items"))
    return kept, log.withColumn("status", F.when(F.col("ambiguous_items") > 0, "ambiguous").otherwise("resolved"))


def completed(classes: DataFrame, statements: DataFrame, rows: DataFrame, spans: DataFrame, last: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The completion pass over bearing spans without statements: those with rows of the reconciler get statements, the others wait for a downgrade decision. Returns classes and the new statements."""
    if "downgrade_pending" not in classes.columns:
        classes = classes.withColumn("downgrade_pending", F.lit(False))
    due = without_statements(classes, statements).filter(~F.coalesce("downgrade_pending", F.lit(False))).select("doc_id", "span_id")
    made = construct(rows.join(due, ["doc_id", "span_id"], "left_semi"), spans, last)
    left = due.join(made.select("doc_id", F.col("source_span_id").alias("span_id")), ["doc_id", "span_id"], "left_anti")
    touched = mark_pending(classes.join(left, ["doc_id", "span_id"], "left_semi"), statements)
    rest = classes.join(left, ["doc_id", "span_id"], "left_anti")
    return rest.unionByName(touched, allowMissingColumns=True), made


def relate(edges: DataFrame, statements: DataFrame) -> DataFrame:
    """Edges rel_id, src, dst, type, evidence, ambiguous of edges by agents a, b and r (doc_id, chunk, agent, seq, src, dst, type, evidence, ambiguous).

    A chunk on which a and b return the same edges, evidence included, takes a's; else those of r. The first of each
    (src, dst, type) over the chunks is kept, edges without a known end or type go, and the rest is numbered.
    """
    keys = ["doc_id", "chunk"]
    whole = edges.withColumn("whole", F.to_json(F.struct("src", "dst", "type", "evidence")))
    of = lambda agent: whole.filter(F.col("agent") == agent)
    t = edges.join(same_multiset(of("a"), of("b"), keys, "whole"), keys, "left")
    agree = F.coalesce("equal", F.lit(True))
    kept = t.filter(agree & (F.col("agent") == "a") | ~agree & (F.col("agent") == "r")).drop("equal")
    once = first_wins(kept, ["doc_id", "src", "dst", "type"], ["chunk", "seq"]).filter(F.col("type").isin(*EDGE_TYPES))
    known = valid_edges(once, statements, "req_id")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk", "seq"))
    return known.select("doc_id", F.format_string("E%04d", number).alias("rel_id"), "src", "dst", "type", F.coalesce("evidence", F.lit("")).alias("evidence"), F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"))


#: Columns that builders of relations and adjudicators get to see.
RELATION_COLUMNS = ("req_id", "citation_raw", "verbatim_quote", "atomic_statement", "modality", "tags")
CONTEXT_COLUMNS = ("req_id", "source_span_id", "citation_raw", "verbatim_quote", "atomic_statement", "modality", "tags", "ambiguous")


def compact(statements: DataFrame, columns: tuple[str, ...] = RELATION_COLUMNS) -> DataFrame:
    """doc_id, req_id, item: each statement as a small JSON object."""
    return statements.select("doc_id", "req_id", F.to_json(F.struct(*columns)).alias("item"))


def requests(items: DataFrame, spans: DataFrame, statements: DataFrame, size: int = 25) -> DataFrame:
    """doc_id, batch, n, of items (doc_id, span_id) that wait for a decision: each with its span's text and the statements there, in batches of size."""
    held = statements.groupBy("doc_id", F.col("source_span_id").alias("span_id")).agg(F.array_sort(F.collect_list("req_id")).alias("req_ids"))
    t = items.select("doc_id", "span_id").join(spans.select("doc_id", "span_id", "text"), ["doc_id", "span_id"], "left").join(held, ["doc_id", "span_id"], "left")
    batch = F.floor((F.row_number().over(Window.partitionBy("doc_id").orderBy("span_id")) - 1) / size).cast("bigint")
    return t.withColumn("batch", batch).withColumn("req_ids", F.coalesce("req_ids", F.array().cast("array<string>")))


def bearing_with_statement(classes: DataFrame, statements: DataFrame, bears: Column) -> DataFrame:
    """doc_id, n of classes that bear by an embedded label alone and have a statement."""
    owned = statements.select("doc_id", F.col("source_span_id").alias("span_id")).distinct()
    return classes.filter(bears).join(owned, ["doc_id", "span_id"], "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
