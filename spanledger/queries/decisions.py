"""Queries over decisions and packets, on the catalog derived from orders and line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions import text
from spanledger.operators import annotate, decide, packets, rulings
from spanledger.plans.regtext import table

from .forms import SENTENCES, filled, picked, values_sql
from .reports import CATALOG_SQL, bare_classes, said, spans

NOTHING = "CAST(array() AS array<string>)"


def signal_spans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans with sentences that hold signals or none, every ninth mostly blank; their classes, of all but every 13th; those audited, every seventh."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.concat(F.lit("S"), "o_orderkey").alias("span_id"), F.col("o_orderkey").alias("o"))
    line = filled(picked(tuple(t for t, *_ in SENTENCES), F.col("o")), p=F.col("o"), o=F.col("doc_id"))
    texts = o.select("doc_id", "span_id", F.when(F.col("o") % 9 == 0, F.concat(line, F.repeat(F.lit(" "), F.lit(900)))).otherwise(line).alias("text"))
    classes = o.filter("o % 13 <> 0").selectExpr("doc_id", "span_id", "element_at(array('definition', 'source_note', 'requirement_bearing', 'structural'), CAST(o % 4 AS INT) + 1) AS final_label", f"CASE WHEN o % 5 = 0 THEN array('requirement_bearing') ELSE {NOTHING} END AS final_embedded", "o % 6 = 0 AS ambiguous")
    return texts, classes, o.filter("o % 7 = 0").select("doc_id", "span_id")


def embedded_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of the embedded audit, and those of its packets, where blank spans count and audited ones do not."""
    texts, classes, audited = signal_spans(spark, sf_dir)
    first = annotate.audit_candidates(texts, classes).select("doc_id", "span_id", F.lit("audit").alias("asked_by"))
    return first.unionByName(annotate.audit_candidates(texts, classes, False, audited).select("doc_id", "span_id", F.lit("packet").alias("asked_by")))


def promoted_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes after every second candidate was found to bear."""
    texts, classes, _ = signal_spans(spark, sf_dir)
    found = annotate.audit_candidates(texts, classes).filter("CAST(substring(span_id, 2) AS BIGINT) % 2 = 0")
    out = annotate.promote_embedded(classes, found)
    return out.select("doc_id", "span_id", "final_label", F.array_join("final_embedded", ",").alias("embedded"), "ambiguous")


def decided_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes after up to three decisions each, of which the last stands."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("seq")).filter("seq <= o_orderkey % 4")
    o = o.join(bare_classes(spark, sf_dir).select("doc_id", F.col("at").alias("o_orderkey"), "final_embedded"), "o_orderkey")
    label = F.element_at(F.array(*map(F.lit, ("definition", "requirement_bearing", "administrative"))), (F.col("o_orderkey") + F.col("seq")).cast("int") % 3 + 1)
    decisions = o.select("doc_id", F.concat(F.lit("S"), "o_orderkey").alias("span_id"), "seq", label.alias("final_label"), "final_embedded", F.lit(None).cast("string").alias("note"))
    out, _ = rulings.rule_classes(bare_classes(spark, sf_dir), decisions)
    return out.select("doc_id", "span_id", "final_label", F.array_join("final_embedded", ",").alias("embedded"), "ambiguous")


def rows_of(**given: Column) -> Column:
    """A row of an extraction with these fields, the others null."""
    kinds = {c: "array<string>" if c in ("tags", "conditions") else "string" for c in rulings.EDITED}
    return F.struct(*(given.get(c, F.lit(None).cast(kind)).alias(c) for c, kind in kinds.items()))


def decided_downgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending classes after confirmations and extractions, some of which do not count."""
    waiting = annotate.mark_pending(bare_classes(spark, sf_dir), said(spark, sf_dir))
    decisions = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 20 AS doc_id", "concat('S', o_orderkey) AS span_id", "1 AS seq", "CASE WHEN o_orderkey % 5 < 2 THEN 'confirm_downgrade' ELSE 'extract' END AS decision", "CASE o_orderkey % 5 WHEN 0 THEN 'administrative' WHEN 1 THEN 'requirement_bearing' END AS final_label",
        f"CASE o_orderkey % 5 WHEN 2 THEN array('that order', 'as of old.') WHEN 3 THEN array('that order', 'absent') ELSE {NOTHING} END AS quotes", "o_orderkey % 5 AS k",
    ).filter("k < 4").withColumn("rows", F.transform("quotes", lambda q: rows_of(verbatim_quote=q))).drop("k", "quotes")
    out, made, _ = rulings.rule_downgrades(waiting, spans(spark, sf_dir), said(spark, sf_dir).filter("false"), decisions)
    n = made.groupBy("doc_id", F.col("source_span_id").alias("span_id")).agg(F.count(F.lit(1)).alias("n_made"))
    t = out.join(n, ["doc_id", "span_id"], "left")
    return t.select("doc_id", "span_id", "final_label", F.array_join("final_embedded", ",").alias("embedded"), "downgrade_pending", F.coalesce("n_made", F.lit(0)).cast("bigint").alias("n_made"))


def dropped_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left per document once the statements of every eighth order are dropped: edges, their last number, spans that wait."""
    before = said(spark, sf_dir)
    edges = before.selectExpr("doc_id", "at AS seq", "'E' AS rel_id", "req_id AS src", "concat('R', l_orderkey, '.', rn + 1) AS dst")
    drops = before.filter("l_orderkey % 8 = 3").selectExpr("doc_id", "req_id", "at AS seq", "'drop' AS decision", "CAST(NULL AS STRING) AS rationale")
    classes, kept = rulings.after_drops(bare_classes(spark, sf_dir), before, before.filter("l_orderkey % 8 <> 3"), edges, drops)
    waits = classes.filter("downgrade_pending").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pending"))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_edges"), F.max(F.struct(F.length("rel_id"), "rel_id"))["rel_id"].alias("last_id")).join(waits, "doc_id", "left").na.fill(0)


def final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """completed where the audit passed and nothing is open; ambiguous classes stand in every fourth document only, edges in none."""
    classes = bare_classes(spark, sf_dir).withColumn("ambiguous", F.col("ambiguous") & (F.col("doc_id") % 4 == 0)).withColumn("downgrade_pending", F.col("at").isNull())
    st = said(spark, sf_dir).withColumn("ambiguous", F.col("ambiguous") & (F.col("doc_id") % 7 == 0))
    report = spans(spark, sf_dir).select("doc_id").distinct().withColumn("passed", F.col("doc_id") % 3 != 0)
    return decide.status(report, annotate.unresolved(classes, st, st.select("doc_id", F.lit(False).alias("ambiguous"))))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a packet: per order one with as many statements as its key's rest by three, and for even orders a second with one; later orders come first."""
    item = lambda k, quote: F.struct(F.lit(quote).alias("verbatim_quote"), F.lit(f"item {k}").alias("atomic_statement"), F.lit("may").alias("modality"), F.array().cast("array<string>").alias("tags"), F.array().cast("array<string>").alias("conditions"), F.lit(False).alias("ambiguous"))
    o = F.col("o_orderkey")
    first = F.slice(F.array(item(1, "that order"), item(2, "as of old.")), F.lit(1), (o % 3).cast("int"))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("doc_id"), F.concat(F.lit("S"), o).alias("span_id"), F.explode(F.array_compact(F.array(F.struct((-2 * o).alias("row"), first.alias("statements")), F.when(o % 2 == 0, F.struct((-2 * o + 1).alias("row"), F.array(item(3, "Status")).alias("statements")))))).alias("r"))
    return rows.select("doc_id", "span_id", "r.*")


def merged_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = said(spark, sf_dir).filter("l_orderkey % 5 = 0")
    last = held.select("doc_id").distinct().withColumn("last", F.col("doc_id") * 10)
    made, _ = packets.merge_statements(answers(spark, sf_dir), bare_classes(spark, sf_dir), held, spans(spark, sf_dir), last)
    return made.select("doc_id", "req_id", "source_span_id", "verbatim_quote", "atomic_statement")


def merged_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which classes wait after the packet; every third one waited before."""
    held = said(spark, sf_dir).filter("l_orderkey % 5 = 0")
    last = held.select("doc_id").distinct().withColumn("last", F.lit(0))
    before = bare_classes(spark, sf_dir).withColumn("downgrade_pending", F.col("at") % 3 == 1)
    return packets.merge_statements(answers(spark, sf_dir), before, held, spans(spark, sf_dir), last)[1].select("doc_id", "span_id", "downgrade_pending")


def packet_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that four divides were not asked, those of rest one not answered; every fifth answer holds no list, and quotes of old are not in texts of tenths."""
    asked = spans(spark, sf_dir).filter("at % 4 <> 0")
    rows = answers(spark, sf_dir).withColumn("o", F.substring("span_id", 2, 20).cast("bigint")).filter("o % 4 <> 1").withColumn("statements", F.when(F.col("o") % 5 != 0, F.col("statements")))
    texts = spans(spark, sf_dir).withColumn("text", F.when(F.col("at") % 7 == 0, F.replace("text", F.lit("as of old."), F.lit(""))).otherwise(F.col("text")))
    return packets.failures(asked, rows, texts).select("doc_id", "span_id", "failure", "n")


def exported_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim of the next packet of 50 documents: those without label that no active claim of the stage holds."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    claims = d.filter("doc_id % 6 < 4").groupBy(F.when(F.col("doc_id") % 2 == 0, "classify").otherwise("relate").alias("stage"), F.when(F.col("doc_id") % 3 == 0, "validated").otherwise("merged").alias("status"), (F.col("doc_id") % 97).alias("b")).agg(F.collect_list("doc_id").alias("item_ids"))
    claim = packets.export(d, table(spark, sf_dir, "labels").select("doc_id"), claims, "classify", "b1", "doc_id", ["doc_id"])[1]
    return claim.select("stage", "batch_id", "status", F.col("item_count").cast("bigint").alias("item_count"), F.array_join("item_ids", ",").alias("item_ids"))


def replaced_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a packet between suppliers of an order, each once."""
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 50 AS doc_id", "struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq", "l_suppkey % 9 AS src", "l_partkey % 9 AS dst", "CASE WHEN l_returnflag = 'A' THEN 'refines' ELSE 'references' END AS type")
    return packets.merge_edges(rows).select("doc_id", "rel_id", "src", "dst", "type")


def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    slug = F.when(s % 3 == 0, F.concat(F.lit("45-cfr-part-"), s)).when(s % 3 == 1, F.concat(F.lit("21-cfr-part-"), s, F.lit("a"))).otherwise(F.concat(F.lit("guide-"), s, F.lit("-cfr-part-1")))
    title, part = decide.title_and_part(slug)
    return table(spark, sf_dir, "supplier").select("s_suppkey", title.alias("title"), part.alias("part"))


def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in fences, with stray brackets and commas, and whole ones, as their values."""
    o = F.col("o_orderkey").cast("string")
    raw = picked(('{"k": {o}, "v": "x{o}"}', '```json\n{"k": {o}, "v": "x{o}"}\n```', '{"k": {o}, "v": "x{o}"]}', '{"k": {o}, "v": "x{o}",}', '```\n{"v": "x{o}", "k": {o},\n}\n```', "no {o}"), F.col("o_orderkey"))
    parsed = F.from_json(text.repair_json(filled(raw, o=o)), "k BIGINT, v STRING", {"mode": "PERMISSIVE"})
    return table(spark, sf_dir, "orders").select("o_orderkey", parsed.alias("j")).select("o_orderkey", "j.k", "j.v")


QUERIES = {f.__name__: f for f in (embedded_candidates, promoted_classes, decided_classes, decided_downgrades, dropped_statements, final_status, merged_statements, merged_classes, packet_failures, exported_claims, replaced_edges, format_dispatch, repaired_json)}

SIGNALLED_SQL = f"""found(k, strong) AS ({values_sql((k, int(h[1] != "modal_permissive")) for k, (_, *hits) in enumerate(SENTENCES) for h in hits)}),
  c AS (SELECT o_custkey AS doc_id, 'S' || o_orderkey AS span_id, o_orderkey AS o, ['definition', 'source_note', 'requirement_bearing', 'structural'][o_orderkey % 4 + 1] AS final_label, o_orderkey % 5 = 0 AS embedded, o_orderkey % 6 = 0 AS ambiguous FROM orders WHERE o_orderkey % 13 <> 0),
  hit AS (SELECT *, final_label <> 'requirement_bearing' AND NOT embedded AND (o % {len(SENTENCES)} IN (SELECT k FROM found WHERE strong = 1) OR final_label <> 'source_note' AND o % {len(SENTENCES)} IN (SELECT k FROM found)) AS hit FROM c)"""
BARE = f"WITH {CATALOG_SQL}, held AS (SELECT DISTINCT source_span_id AS span_id FROM said)"
ANSWERS_SQL = """a AS (SELECT o_custkey % 20 AS doc_id, o_orderkey AS o, -2 * o_orderkey AS row, o_orderkey % 3 AS n, 0 AS second FROM orders UNION ALL SELECT o_custkey % 20, o_orderkey, 1 - 2 * o_orderkey, 1, 1 FROM orders WHERE o_orderkey % 2 = 0),
  open AS (SELECT * FROM a WHERE NOT (o % 5 = 0 AND 'S' || o IN (SELECT source_span_id FROM said))),
  win AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY row) AS rn FROM open WHERE n > 0),
  items AS (SELECT doc_id, o, row, k, CASE WHEN second = 1 THEN 'Status' WHEN k = 1 THEN 'that order' ELSE 'as of old.' END AS quote, CASE WHEN second = 1 THEN 3 ELSE k END AS item FROM win JOIN (VALUES (1), (2)) v(k) ON k <= n WHERE rn = 1)"""

SQL = {
    "embedded_candidates": f"WITH {SIGNALLED_SQL} SELECT doc_id, span_id, 'audit' AS asked_by FROM hit WHERE hit AND o % 9 <> 0 UNION ALL SELECT doc_id, span_id, 'packet' FROM hit WHERE hit AND o % 7 <> 0",
    "promoted_classes": f"WITH {SIGNALLED_SQL} SELECT doc_id, span_id, final_label, CASE WHEN embedded OR hit AND o % 9 <> 0 AND o % 2 = 0 THEN 'requirement_bearing' ELSE '' END AS embedded, ambiguous OR (hit AND o % 9 <> 0 AND o % 2 = 0) AS ambiguous FROM hit",
    "decided_classes": f"""WITH {CATALOG_SQL}, d AS (SELECT *, CASE WHEN pos % 4 > 0 THEN ['definition', 'requirement_bearing', 'administrative'][(pos + pos % 4) % 3 + 1] END AS told FROM classes)
      SELECT doc_id, span_id, coalesce(told, final_label) AS final_label, CASE WHEN coalesce(told, '') = embedded THEN '' ELSE embedded END AS embedded, ambiguous AND told IS NULL AS ambiguous FROM d""",
    "decided_downgrades": f"""WITH {CATALOG_SQL}, held AS (SELECT *, pending AND (pos % 5 = 0 OR pos % 5 = 1 AND final_label <> 'requirement_bearing') AS confirmed FROM classes) SELECT doc_id, span_id, CASE WHEN pending AND pos % 5 = 0 AND final_label = 'requirement_bearing' THEN 'administrative' ELSE final_label END AS final_label, CASE WHEN confirmed THEN '' ELSE embedded END AS embedded,
      pending AND NOT confirmed AND pos % 5 <> 2 AS downgrade_pending, CAST(CASE WHEN pending AND pos % 5 = 2 THEN 2 ELSE 0 END AS BIGINT) AS n_made FROM held""",
    "dropped_statements": f"""{BARE}, k AS (SELECT s.doc_id, count(*) AS n FROM said s JOIN said t ON t.l_orderkey = s.l_orderkey AND t.rn = s.rn + 1 WHERE s.l_orderkey % 8 <> 3 GROUP BY s.doc_id), w AS (SELECT doc_id, count(*) AS n_pending FROM classes WHERE bears AND pos % 8 = 3 AND span_id IN (SELECT span_id FROM held) GROUP BY doc_id)
      SELECT doc_id, n AS n_edges, 'E' || lpad(CAST(n AS VARCHAR), CAST(greatest(4, length(CAST(n AS VARCHAR))) AS INTEGER), '0') AS last_id, coalesce(n_pending, 0) AS n_pending FROM k LEFT JOIN w USING (doc_id)""",
    "final_status": f"""WITH {CATALOG_SQL} SELECT DISTINCT doc_id, CASE WHEN doc_id % 3 <> 0 AND NOT (doc_id % 4 = 0 AND doc_id IN (SELECT doc_id FROM classes WHERE ambiguous)) AND NOT (doc_id % 7 = 0 AND doc_id IN (SELECT doc_id FROM said WHERE ambiguous)) THEN 'completed' ELSE 'in_progress' END AS status FROM spans""",
    "merged_statements": f"""WITH {CATALOG_SQL}, {ANSWERS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY row, k) + CASE WHEN doc_id IN (SELECT doc_id FROM said WHERE l_orderkey % 5 = 0) THEN doc_id * 10 ELSE 0 END AS no FROM items)
      SELECT doc_id, 'R' || lpad(CAST(no AS VARCHAR), CAST(greatest(5, length(CAST(no AS VARCHAR))) AS INTEGER), '0') AS req_id, 'S' || o AS source_span_id, quote AS verbatim_quote, 'item ' || item AS atomic_statement FROM n""",
    "merged_classes": f"""WITH {CATALOG_SQL}, {ANSWERS_SQL} SELECT doc_id, span_id, CASE WHEN pos IN (SELECT o FROM items) THEN false WHEN pos IN (SELECT o FROM open) THEN bears ELSE pos % 3 = 1 END AS downgrade_pending FROM classes""",
    "packet_failures": """WITH o AS (SELECT o_custkey % 20 AS doc_id, 'S' || o_orderkey AS span_id, o_orderkey AS o, o_orderkey % 2 = 0 AS twice FROM orders)
      SELECT doc_id, span_id, 'not in packet' AS failure, CAST(2 AS BIGINT) AS n FROM o WHERE o % 4 = 0 UNION ALL SELECT doc_id, span_id, 'missing', 1 FROM o WHERE o % 4 = 1 UNION ALL SELECT doc_id, span_id, 'duplicate', 1 FROM o WHERE o % 4 = 2
      UNION ALL SELECT doc_id, span_id, 'no list', CASE WHEN twice THEN 2 ELSE 1 END FROM o WHERE o % 4 > 1 AND o % 5 = 0 UNION ALL SELECT doc_id, span_id, 'quote not found', 1 FROM o WHERE o % 4 > 1 AND o % 5 <> 0 AND o % 7 = 0 AND o % 3 = 2""",
    "exported_claims": """WITH p AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND NOT (doc_id % 6 = 0) ORDER BY doc_id LIMIT 50) SELECT 'classify' AS stage, 'b1' AS batch_id, 'claimed' AS status, count(*) AS item_count, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS item_ids FROM p""",
    "replaced_edges": """WITH e AS (SELECT l_orderkey % 50 AS doc_id, l_suppkey % 9 AS src, l_partkey % 9 AS dst, CASE WHEN l_returnflag = 'A' THEN 'refines' ELSE 'references' END AS type, row_number() OVER (PARTITION BY l_orderkey % 50 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS seq FROM lineitem),
      f AS (SELECT doc_id, src, dst, type, min(seq) AS seq FROM e GROUP BY ALL) SELECT doc_id, 'E' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS VARCHAR), 4, '0') AS rel_id, src, dst, type FROM f""",
    "format_dispatch": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '45' ELSE '21' END AS title, CASE s_suppkey % 3 WHEN 0 THEN CAST(s_suppkey AS VARCHAR) WHEN 1 THEN s_suppkey || 'a' ELSE '11' END AS part FROM supplier",
    "repaired_json": "SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN o_orderkey END AS k, CASE WHEN o_orderkey % 6 < 5 THEN 'x' || o_orderkey END AS v FROM orders",
}
