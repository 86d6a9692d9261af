"""Open ranges over a text, characters by byte, cycles as paths; beside SQL that walks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators import audit, graph, lines
from spanledger.plans.regtext import table


def active_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements open over each piece of a supplier's text of 4,990 characters; some reach beyond its end."""
    ranges = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS doc_id", "l_orderkey % 5000 AS start", "l_orderkey % 5000 + CAST(l_quantity AS BIGINT) AS end", "concat('R', l_orderkey, '.', l_linenumber) AS id")
    sizes = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS doc_id", "CAST(4990 AS BIGINT) AS length")
    out = audit.active_segments(ranges, sizes)
    return out.select("doc_id", "start", "end", F.array_join("ids", ",").alias("ids"), "anchor")


def characters_by_byte(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight bytes of every document, anywhere in its lines, with the characters that hold them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bytes_ = F.octet_length("text").cast("bigint") + 1
    asked = docs.filter("text <> ''").select("doc_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.pmod(F.col("doc_id") * 7919 + k * 104729, bytes_))).alias("at"))
    return lines.chars_at(asked, lines.split_lines(docs)).groupBy("doc_id", "at").agg(F.max("char").cast("bigint").alias("char"))


def ring_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten customers a document, numbered within it: each leads to the next, in two of three documents the last to the first, and some two further on."""
    t = table(spark, sf_dir, "customer").selectExpr("c_custkey DIV 10 AS doc_id", "c_custkey % 10 AS n", "c_custkey % 10 AS seq")
    far = F.expr("CASE WHEN n = 9 THEN array(CASE WHEN doc_id % 3 > 0 THEN 0L END) WHEN n % 4 = 0 AND n < 8 THEN array(n + 1, n + 2) ELSE array(n + 1) END")
    kind = F.when(F.col("doc_id") % 2 == 0, "refines").otherwise("composed_of")
    return t.select("doc_id", F.col("n").alias("src"), F.explode(far).alias("dst"), kind.alias("type")).filter("dst IS NOT NULL")


def document_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cycle of every strongly connected part, one row per node in order."""
    return graph.document_cycles(ring_edges(spark, sf_dir)).select("doc_id", "type", "cycle", "at", "node")


QUERIES = {f.__name__: f for f in (active_ranges, characters_by_byte, document_cycles)}

SQL = {
    "active_ranges": """WITH r AS (SELECT l_suppkey AS doc_id, l_orderkey % 5000 AS s, l_orderkey % 5000 + CAST(l_quantity AS BIGINT) AS e, 'R' || l_orderkey || '.' || l_linenumber AS id FROM lineitem),
      p AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, s AS x FROM r UNION ALL SELECT doc_id, e FROM r UNION ALL SELECT s_suppkey, unnest([0, 4990]) FROM supplier) WHERE x BETWEEN 0 AND 4990 AND doc_id IN (SELECT s_suppkey FROM supplier)),
      seg AS (SELECT doc_id, x AS a, lead(x) OVER (PARTITION BY doc_id ORDER BY x) AS b FROM p QUALIFY b IS NOT NULL),
      ids AS (SELECT seg.doc_id, a, string_agg(DISTINCT id, ',' ORDER BY id) AS ids, min(id) AS anchor FROM seg JOIN r ON r.doc_id = seg.doc_id AND r.s <= a AND r.e >= b GROUP BY ALL)
      SELECT doc_id, a AS start, b AS "end", coalesce(ids, '') AS ids, anchor FROM seg LEFT JOIN ids USING (doc_id, a)""",
    "characters_by_byte": """WITH c AS (SELECT doc_id, i - 1 AS n, sum(strlen(ch)) OVER (PARTITION BY doc_id ORDER BY i) AS till, strlen(ch) AS size FROM (SELECT doc_id, unnest(string_split(text || chr(10), '')) AS ch, unnest(range(1, length(text) + 2)) AS i FROM documents WHERE text <> '')),
      q AS (SELECT DISTINCT doc_id, (doc_id * 7919 + k * 104729) % (strlen(text) + 1) AS x FROM documents, range(8) r(k) WHERE text <> '')
      SELECT q.doc_id, x AS "at", n AS char FROM q JOIN c ON c.doc_id = q.doc_id AND x < till AND x >= till - size""",
    "document_cycles": """SELECT c_custkey // 10 AS doc_id, CASE WHEN (c_custkey // 10) % 2 = 0 THEN 'refines' ELSE 'composed_of' END AS type, CAST(0 AS BIGINT) AS cycle, c_custkey % 10 AS "at", c_custkey % 10 AS node
      FROM customer WHERE (c_custkey // 10) % 3 > 0 AND c_custkey // 10 IN (SELECT c_custkey // 10 FROM customer GROUP BY 1 HAVING count(*) = 10)""",
}
