"""Queries in which every line of every document counts: the audit with its failures, the document pipeline, tags."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators import audit, graph, lines
from spanledger.plans import pipeline
from spanledger.plans.regtext import LINES_SQL, offsets_sql, table

from .texts import COLLAPSED, COVER, SPACED_SQL
from .texts import SQL as TEXT_SQL


def line_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit with each line a span and, but for every third, a statement. Every fifth line has no span, every seventh reaches into the next; some quotes are respaced, some longer than their line."""
    at = lines.with_offsets(lines.split_lines(table(spark, sf_dir, "documents"))).withColumn("k", F.col("doc_id") + F.col("line_no"))
    sizes = at.groupBy("doc_id").agg(F.max("byte_end").alias("total_bytes"))
    named = at.withColumn("span_id", F.concat(F.lit("S"), "line_no"))
    spans = named.filter("line_no % 5 <> 4").withColumn("byte_end", F.col("byte_end") + F.when(F.col("line_no") % 7 == 6, 3).otherwise(0)).withColumnRenamed("line", "text")
    classes = named.filter("k % 11 <> 0").selectExpr("doc_id", "span_id", "CASE WHEN k % 4 = 0 THEN 'requirement_bearing' ELSE 'definition' END AS final_label", "CASE WHEN k % 6 = 1 THEN array('requirement_bearing') ELSE CAST(array() AS array<string>) END AS final_embedded", "k % 9 = 0 AS ambiguous", "k % 8 = 0 AS downgrade_pending")
    quote = F.when(F.col("k") % 6 == 0, F.concat("line", F.lit("  x"))).when(F.col("k") % 6 == 5, F.replace("line", F.lit(" "), F.lit("  "))).otherwise(F.col("line"))
    statements = named.filter("line_no % 3 <> 2").select("doc_id", F.concat(F.lit("R"), "line_no").alias("req_id"), F.col("span_id").alias("source_span_id"), quote.alias("verbatim_quote"))
    out = audit.gate(sizes, spans, classes, statements)
    return out.select("doc_id", "total_bytes", "n_spans", "covered_bytes", "n_gaps", "gap_bytes", "n_overlaps", "unclassified", "unrequirementized", "downgrade_pending", "quote_failures", "ambiguous", "passed", "message")


def quote_failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a quote of its whole text, some respaced, some longer, some empty, some of a document that is not there."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit("S").alias("span_id"), "text")
    at = lines.split_lines(d).withColumn("k", F.col("doc_id") + F.col("line_no"))
    quote = F.when(F.col("k") % 5 == 0, "").when(F.col("k") % 5 == 1, F.concat("line", F.lit(" ~x"))).when(F.col("k") % 5 == 2, F.concat(F.lit(" "), F.replace("line", F.lit(" "), F.lit(" \n")))).otherwise(F.col("line"))
    st = at.select("doc_id", F.concat(F.lit("R"), "line_no").alias("req_id"), F.when(F.col("k") % 7 == 0, "T").otherwise("S").alias("source_span_id"), quote.alias("verbatim_quote"))
    return audit.quote_failures(st, d).groupBy("doc_id", "failure").agg(F.count(F.lit(1)).alias("n"))


def blanked_corpus(spark: SparkSession, sf_dir: str) -> pipeline.Corpus:
    """The documents with a blank run after each sentence."""
    d = table(spark, sf_dir, "documents")
    pages = d.select("doc_id", F.lit(1).alias("page_number"), F.replace("text", F.lit(". "), F.lit(".\n\n\n")).alias("text"))
    meta = d.select("doc_id", F.lit(None).cast("string").alias("title"), F.lit("generic").alias("citation_format"), F.lit(None).cast("string").alias("part"))
    return pipeline.Corpus(pages, meta)


def document_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans with their texts after the stages boilerplate and segment, with a blank run after each sentence."""
    out = pipeline.run(blanked_corpus(spark, sf_dir), only=("boilerplate", "segment"))["spans"]
    return out.select("doc_id", "span_id", "kind", "byte_start", "byte_end", F.sha2("text", 256).alias("digest"))


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log's rows of two stages that end and of one that fails for want of statements, with the rows of the tables made."""
    corpus = blanked_corpus(spark, sf_dir)
    log = f"{graph.shared_folder(corpus.pages)}/log-{uuid.uuid4().hex}"
    corpus = pipeline.run(corpus, only=("boilerplate", "segment"), log=log, run_id="one")
    try:
        pipeline.run(corpus, only=("relate",), log=log, run_id="one")
    except AttributeError:  # no statements and no edges: the log tells it
        pass
    return spark.read.parquet(log).select("run_id", "stage", "status", F.explode_outer("tables").alias("made", "n"))


def tag_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents a tag has, as counts and sums that merge before the shuffle, so that a tag of a third of all rows is one small row per task."""
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array("lang", "source")).alias("tag")).filter("tag IS NOT NULL")
    return each.groupBy("tag").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.sum("doc_id").cast("bigint").alias("sum_ids"), F.bit_xor("doc_id").alias("xor_ids"))


QUERIES = {f.__name__: f for f in (line_gate, quote_failure_kinds, document_pipeline, stage_log, tag_digests)}

BLANKED = f"{COLLAPSED.format('docl')}, clean AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS line_no, line FROM kept), {offsets_sql('clean')}"
HEAD, TAIL = TEXT_SQL["generic_spans"].replace(f"WITH {SPACED_SQL}, {offsets_sql('docl')}", f"WITH {SPACED_SQL}, {BLANKED}").rsplit("\n      SELECT", 1)
PARTS = ("n_gaps", "n_overlaps", "unclassified", "unrequirementized", "downgrade_pending", "quote_failures")
SQL = {
    "line_gate": f"""WITH {LINES_SQL}, {offsets_sql("docl")}, l AS (SELECT *, doc_id + line_no AS k FROM off), sizes AS (SELECT doc_id, max(byte_end) AS total_bytes FROM l GROUP BY doc_id),
      spans AS (SELECT doc_id, byte_start, byte_end + CASE WHEN line_no % 7 = 6 THEN 3 ELSE 0 END AS byte_end FROM l WHERE line_no % 5 <> 4), cover AS (WITH {COVER}),
      x AS (SELECT *, k % 11 <> 0 AS classed, line_no % 5 <> 4 AS spanned, line_no % 3 <> 2 AS quoted, k % 11 <> 0 AND (k % 4 = 0 OR k % 6 = 1) AND line_no % 3 = 2 AS due, CASE k % 6 WHEN 0 THEN line || '  x' WHEN 5 THEN replace(line, ' ', '  ') ELSE line END AS quote FROM l),
      n AS (SELECT doc_id, CASE WHEN bool_or(classed) THEN count(*) FILTER (spanned AND NOT classed) ELSE 0 END AS unclassified, count(*) FILTER (due AND k % 8 <> 0) AS unrequirementized, count(*) FILTER (due AND k % 8 = 0) AS downgrade_pending,
        count(*) FILTER (quoted AND (NOT spanned OR quote = '' OR NOT contains(line, quote))) AS quote_failures, count(*) FILTER (classed AND k % 9 = 0) AS ambiguous FROM x GROUP BY doc_id)
      SELECT doc_id, total_bytes, n_spans, covered_bytes, n_gaps, gap_bytes, n_overlaps, unclassified, unrequirementized, downgrade_pending, quote_failures, ambiguous, {" + ".join(PARTS)} = 0 AS passed, concat_ws('; ', {", ".join(f"CASE WHEN {c} > 0 THEN '{c}=' || {c} END" for c in PARTS)}) AS message FROM cover JOIN n USING (doc_id)""",
    "quote_failure_kinds": f"""WITH {LINES_SQL}, l AS (SELECT doc_id, line, doc_id + line_no AS k, text FROM docl JOIN documents USING (doc_id)),
      f AS (SELECT doc_id, CASE WHEN k % 7 = 0 THEN 'missing_span' WHEN k % 5 = 0 OR k % 5 > 2 AND line = '' THEN 'empty_quote' WHEN k % 5 = 1 THEN 'not_in_span' WHEN k % 5 = 2 AND NOT contains(text, ' ' || replace(line, ' ', ' ' || chr(10))) THEN 'whitespace_only' END AS failure FROM l)
      SELECT doc_id, failure, count(*) AS n FROM f WHERE failure IS NOT NULL GROUP BY ALL""",
    "document_pipeline": f"{HEAD}, g AS (SELECT{TAIL}) SELECT g.doc_id, span_id, kind, g.byte_start, g.byte_end, sha256(string_agg(line, chr(10) ORDER BY line_no) || chr(10)) AS digest FROM g JOIN off o ON o.doc_id = g.doc_id AND o.byte_start >= g.byte_start AND o.byte_start < g.byte_end GROUP BY ALL",
    "stage_log": f"""{HEAD}, g AS (SELECT{TAIL}), n(stage, made, n) AS (SELECT 'boilerplate', 'canonical', count(DISTINCT doc_id) FROM off UNION ALL SELECT 'boilerplate', 'lines', count(*) FROM off UNION ALL SELECT 'boilerplate', 'stripped', 0 UNION ALL SELECT 'segment', 'spans', count(*) FROM g)
      SELECT 'one' AS run_id, stage, 'completed' AS status, made, n FROM n UNION ALL SELECT 'one', 'relate', 'failed', NULL, NULL""",
    "tag_digests": "SELECT tag, count(*) AS n_docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc, CAST(sum(doc_id) AS BIGINT) AS sum_ids, bit_xor(doc_id) AS xor_ids FROM (SELECT doc_id, unnest([lang, source]) AS tag FROM documents) WHERE tag IS NOT NULL GROUP BY tag",
}
