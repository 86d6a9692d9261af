"""Decisions on catalogs in which every id stands in as many documents as there are orders, beside SQL that walks them.

A document is an order, its spans, statements and edges are numbered within it; up to three decisions name each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanledger.functions.text import LABELS
from spanledger.operators import annotate, graph, rulings
from spanledger.operators.statements import EDGE_TYPES
from spanledger.plans.regtext import table

from .decisions import rows_of


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and n: the line items of each order, numbered from 1. Written once, since every table of a catalog is made of them."""
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order))
    return graph.stored(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), n.alias("n")))


def asked(items: DataFrame) -> DataFrame:
    """doc_id, n, k, seq: up to three decisions on each."""
    t = items.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3))))
    return t.filter("k <= (doc_id + n) % 4").withColumn("seq", F.expr("n * 10 + k"))


def class_rulings(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = ", ".join(f"'{x}'" for x in LABELS)
    classes = items.selectExpr(
        "doc_id", "concat('S', n) AS span_id", f"element_at(array({names}), CAST((doc_id + n) % 9 AS INT) + 1) AS final_label",
        "CASE WHEN n % 2 = 0 THEN array('definition', 'requirement_bearing') ELSE CAST(array() AS array<string>) END AS final_embedded",
        "doc_id % 2 = 0 AS ambiguous", "concat('first ', n) AS note",
    )
    decisions = asked(items).selectExpr(
        "doc_id", "CASE WHEN (doc_id + n + k) % 11 = 0 THEN 'S99' ELSE concat('S', n) END AS span_id", "seq",
        "element_at(array('definition', 'administrative', 'nonsense', NULL, 'requirement_bearing'), CAST((doc_id * 7 + n * 3 + k * 4) % 5 AS INT) + 1) AS final_label",
        "CASE (doc_id + k) % 4 WHEN 0 THEN NULL WHEN 3 THEN array('bogus') ELSE array('structural', 'definition', 'structural') END AS final_embedded",
        "CASE WHEN (n + k) % 2 = 0 THEN concat(' told ', k) ELSE '' END AS note",
    )
    return rulings.rule_classes(classes, decisions)


def ruled_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes after their decisions, some with unknown labels, unknown spans or no label."""
    out, _ = class_rulings(numbered(spark, sf_dir))
    return out.select("doc_id", "span_id", "final_label", F.array_join("final_embedded", ",").alias("embedded"), "ambiguous", "note")


def edge_rulings(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = ", ".join(f"'{x}'" for x in EDGE_TYPES)
    edges = items.selectExpr(
        "doc_id", "n AS seq", "concat('E', lpad(n, 4, '0')) AS rel_id", "concat('R', n) AS src", "concat('R', n + 1) AS dst",
        f"element_at(array({names}), CAST((doc_id + n) % 6 AS INT) + 1) AS type", "CASE WHEN n % 3 = 0 THEN '' ELSE concat('as of ', n) END AS evidence", "true AS ambiguous",
    )
    decisions = asked(items).selectExpr(
        "doc_id", "CASE WHEN (doc_id + n + k) % 13 = 0 THEN 'E0099' ELSE concat('E', lpad(n, 4, '0')) END AS rel_id", "seq",
        "element_at(array('keep', ' EDIT ', 'edit', 'drop', 'nonsense'), CAST((doc_id * 3 + n + k * 2) % 5 AS INT) + 1) AS decision",
        "element_at(array(NULL, 'refines', 'no_such_type', ''), CAST((doc_id + n * 2 + k) % 4 AS INT) + 1) AS type",
        "CASE WHEN (doc_id + k) % 3 = 0 THEN concat('told ', k) ELSE NULL END AS evidence",
    )
    return rulings.rule_edges(edges, decisions)


def ruled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges after decisions to keep, edit and drop, of which some name no type or edge that there is."""
    out, _ = edge_rulings(numbered(spark, sf_dir))
    return out.select("doc_id", "rel_id", "src", "type", "evidence", "ambiguous")


def bearing_spans(items: DataFrame) -> DataFrame:
    return items.selectExpr("doc_id", "concat('S', n) AS span_id", "concat('(', n, ') Firms shall keep part ', doc_id, ',\\nand file it.') AS text")


def statement_rulings(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    statements = items.selectExpr(
        "doc_id", "concat('R', lpad(n, 5, '0')) AS req_id", "concat('S', n) AS source_span_id", "'Firms' AS verbatim_quote", "concat('first ', n) AS atomic_statement",
        "'shall' AS modality", "array('first') AS tags", "true AS ambiguous",
    )
    decisions = asked(items).selectExpr(
        "doc_id", "CASE WHEN (doc_id + n + k) % 17 = 0 THEN 'R99999' ELSE concat('R', lpad(n, 5, '0')) END AS req_id", "seq",
        "element_at(array('edit', 'keep', 'Edit', 'drop', 'nonsense'), CAST((doc_id * 3 + n + k * 2) % 5 AS INT) + 1) AS decision",
        "element_at(array(' shall keep ', concat('part ', doc_id, ' and file'), 'absent', ''), CAST((doc_id + n * 2 + k) % 4 AS INT) + 1) AS verbatim_quote",
        "concat(' told ', k) AS atomic_statement", "element_at(array('MUST', 'perhaps', NULL), CAST((n + k) % 3 AS INT) + 1) AS modality",
        "array(' A ', '', concat('b', k)) AS tags", "concat('why ', k) AS rationale",
    )
    return rulings.rule_statements(statements, bearing_spans(items), decisions)


def ruled_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements after decisions to keep, edit and drop; an edit's quote is found across a wrap and a comma."""
    out, _ = statement_rulings(numbered(spark, sf_dir))
    return out.select("doc_id", "req_id", "verbatim_quote", "atomic_statement", "modality", F.array_join("tags", ",").alias("tags"), "ambiguous")


def downgrade_rulings(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    classes = items.selectExpr(
        "doc_id", "concat('S', n) AS span_id", "CASE (doc_id + n) % 3 WHEN 0 THEN 'definition' ELSE 'requirement_bearing' END AS final_label",
        "CASE (doc_id + n) % 3 WHEN 0 THEN array('requirement_bearing', 'structural') WHEN 1 THEN array('scope_inclusion', 'administrative') ELSE CAST(array() AS array<string>) END AS final_embedded",
        "true AS ambiguous",
    )
    statements = items.filter("n % 4 = 0").selectExpr("doc_id", "concat('R', lpad(n, 5, '0')) AS req_id", "concat('S', n) AS source_span_id", "'Firms' AS verbatim_quote")
    decisions = asked(items).selectExpr(
        "doc_id", "n", "CASE WHEN (doc_id + n + k) % 17 = 0 THEN 'S99' ELSE concat('S', n) END AS span_id", "seq",
        "element_at(array('confirm_downgrade', 'extract', 'Confirm_Downgrade', 'nonsense'), CAST((doc_id * 3 + n + k * 2) % 4 AS INT) + 1) AS decision",
        "element_at(array(NULL, 'administrative', 'bogus', 'requirement_bearing', ''), CAST((doc_id + n * 2 + k) % 5 AS INT) + 1) AS final_label",
        "element_at(array(array('shall keep', concat('part ', doc_id, ' and file')), array('Firms', 'absent'), CAST(array() AS array<string>)), CAST((doc_id + k) % 3 AS INT) + 1) AS quotes",
    )
    rows = F.transform("quotes", lambda q: rows_of(verbatim_quote=q, atomic_statement=F.concat(F.lit("from "), F.col("seq"))))
    return rulings.rule_downgrades(annotate.mark_pending(classes, statements), bearing_spans(items), statements, decisions.withColumn("rows", rows).drop("quotes", "n"))


def ruled_downgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans that waited, after confirmations and extractions, with the statements that each has now: their numbers and quotes."""
    classes, statements, _ = downgrade_rulings(numbered(spark, sf_dir))
    of = statements.groupBy("doc_id", F.col("source_span_id").alias("span_id")).agg(F.count(F.lit(1)).alias("n_statements"), F.min("req_id").alias("first_id"), F.max(F.md5("verbatim_quote")).alias("last_quote"))
    t = classes.join(of, ["doc_id", "span_id"], "left")
    return t.select("doc_id", "span_id", "final_label", F.array_join("final_embedded", ",").alias("embedded"), "ambiguous", "downgrade_pending", "resolution", F.coalesce("n_statements", F.lit(0)).cast("bigint").alias("n_statements"), "first_id", "last_quote")


def ruling_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many decisions of each kind led to what in each document, or were ignored for what."""
    items = numbered(spark, sf_dir)
    return rulings.tally({
        "class": class_rulings(items)[1], "edge": edge_rulings(items)[1],
        "statement": statement_rulings(items)[1], "downgrade": downgrade_rulings(items)[2],
    })


QUERIES = {f.__name__: f for f in (ruled_classes, ruled_edges, ruled_statements, ruled_downgrades, ruling_log)}

names = ", ".join(f"'{x}'" for x in LABELS)
types = ", ".join(f"'{x}'" for x in EDGE_TYPES)
ASKED = """li AS MATERIALIZED (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS n FROM lineitem),
asked AS MATERIALIZED (SELECT doc_id, n, k, n * 10 + k AS seq FROM li, range(1, 4) r(k) WHERE k <= (doc_id + n) % 4)"""

# classes: the record of each is walked through its decisions, one after the other
CLASS_WALK = f"""cd AS MATERIALIZED (SELECT *, lag(seq) OVER (PARTITION BY doc_id, id ORDER BY seq) IS NULL AS is_first, row_number() OVER (PARTITION BY doc_id, id ORDER BY seq) AS step,
    told IN ({names}) AND coalesce(len([x FOR x IN emb IF x <> told AND x NOT IN ({names})]), 0) = 0 AS fits
  FROM (SELECT doc_id, CASE WHEN (doc_id + n + k) % 11 = 0 THEN 99 ELSE n END AS id, seq, ['definition', 'administrative', 'nonsense', NULL, 'requirement_bearing'][(doc_id * 7 + n * 3 + k * 4) % 5 + 1] AS told,
    CASE (doc_id + k) % 4 WHEN 0 THEN NULL WHEN 3 THEN ['bogus'] ELSE ['structural', 'definition', 'structural'] END AS emb, CASE WHEN (n + k) % 2 = 0 THEN 'told ' || k END AS note FROM asked)),
cw AS (SELECT doc_id, n AS id, 0 AS step, [{names}][(doc_id + n) % 9 + 1] AS label, CASE WHEN n % 2 = 0 THEN ['definition', 'requirement_bearing'] ELSE [] END AS embedded, doc_id % 2 = 0 AS ambiguous, 'first ' || n AS note FROM li
  UNION ALL SELECT w.doc_id, w.id, d.step, CASE WHEN fits THEN told ELSE label END, CASE WHEN fits THEN list_sort(list_distinct([x FOR x IN coalesce(emb, []) IF x <> told])) ELSE embedded END,
    ambiguous AND NOT coalesce(fits, false), CASE WHEN fits THEN coalesce(d.note, w.note) ELSE w.note END FROM cw w JOIN cd d ON d.doc_id = w.doc_id AND d.id = w.id AND d.step = w.step + 1)"""

EDGE_WALK = f"""ed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY seq) AS step FROM (SELECT doc_id, CASE WHEN (doc_id + n + k) % 13 = 0 THEN 99 ELSE n END AS id, seq,
    ['keep', 'edit', 'edit', 'drop', 'nonsense'][(doc_id * 3 + n + k * 2) % 5 + 1] AS decision, [NULL, 'refines', 'no_such_type', NULL][(doc_id + n * 2 + k) % 4 + 1] AS new_type,
    ['None', 'refines', 'no_such_type', ''][(doc_id + n * 2 + k) % 4 + 1] AS shown, CASE WHEN (doc_id + k) % 3 = 0 THEN 'told ' || k END AS new_evidence FROM asked)),
ew AS (SELECT doc_id, n AS id, 0 AS step, [{types}][(doc_id + n) % 6 + 1] AS type, CASE WHEN n % 3 = 0 THEN '' ELSE 'as of ' || n END AS evidence, true AS ambiguous, false AS dropped FROM li
  UNION ALL SELECT w.doc_id, w.id, d.step, CASE WHEN fits THEN coalesce(new_type, type) ELSE type END, CASE WHEN fits THEN coalesce(new_evidence, evidence) ELSE evidence END, ambiguous AND NOT fits, dropped OR decision = 'drop'
    FROM ew w JOIN (SELECT *, decision IN ('keep', 'edit') AND coalesce(new_type, 'refines') <> 'no_such_type' AS fits FROM ed) d ON d.doc_id = w.doc_id AND d.id = w.id AND d.step = w.step + 1)"""

STATEMENT_WALK = """sd AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, id ORDER BY seq) AS step FROM (SELECT doc_id, CASE WHEN (doc_id + n + k) % 17 = 0 THEN 99 ELSE n END AS id, n, k, seq,
    ['edit', 'keep', 'edit', 'drop', 'nonsense'][(doc_id * 3 + n + k * 2) % 5 + 1] AS decision, ['shall keep', 'part ' || doc_id || ',' || chr(10) || 'and file', NULL, NULL][(doc_id + n * 2 + k) % 4 + 1] AS quote,
    ['must', 'unspecified', 'unspecified'][(n + k) % 3 + 1] AS new_modality FROM asked)),
sw AS (SELECT doc_id, n AS id, 0 AS step, 'Firms' AS quote, 'first ' || n AS statement, 'shall' AS modality, 'first' AS tags, true AS ambiguous, false AS dropped FROM li
  UNION ALL SELECT w.doc_id, w.id, d.step, CASE WHEN edits THEN d.quote ELSE w.quote END, CASE WHEN edits THEN 'told ' || k ELSE statement END, CASE WHEN edits THEN new_modality ELSE modality END,
    CASE WHEN edits THEN 'a,b' || k ELSE tags END, ambiguous AND NOT edits AND decision <> 'keep', dropped OR decision = 'drop'
    FROM sw w JOIN (SELECT *, decision = 'edit' AND quote IS NOT NULL AS edits FROM sd) d ON d.doc_id = w.doc_id AND d.id = w.id AND d.step = w.step + 1)"""

DOWNGRADE_WALK = """dc AS MATERIALIZED (SELECT doc_id, n AS id, CASE (doc_id + n) % 3 WHEN 0 THEN 'definition' ELSE 'requirement_bearing' END AS label,
    CASE (doc_id + n) % 3 WHEN 0 THEN 'requirement_bearing,structural' WHEN 1 THEN 'scope_inclusion,administrative' ELSE '' END AS embedded, CASE (doc_id + n) % 3 WHEN 1 THEN 'scope_inclusion' ELSE 'administrative' END AS proposed, n % 4 <> 0 AS pending FROM li),
dj AS MATERIALIZED (SELECT d.*, label, proposed, pending, coalesce(nullif(given, ''), proposed) AS new_label FROM (SELECT doc_id, CASE WHEN (doc_id + n + k) % 17 = 0 THEN 99 ELSE n END AS id, k, seq,
    ['confirm_downgrade', 'extract', 'confirm_downgrade', 'nonsense'][(doc_id * 3 + n + k * 2) % 4 + 1] AS decision, [NULL, 'administrative', 'bogus', 'requirement_bearing', ''][(doc_id + n * 2 + k) % 5 + 1] AS given, (doc_id + k) % 3 AS quotes FROM asked) d LEFT JOIN dc USING (doc_id, id)),
dr AS MATERIALIZED (SELECT *, min(CASE WHEN why IS NULL THEN seq END) OVER (PARTITION BY doc_id, id) AS won FROM (SELECT *, CASE WHEN label IS NULL THEN 'not found' WHEN NOT pending THEN 'no pending downgrade'
    WHEN decision = 'confirm_downgrade' AND label = 'requirement_bearing' AND new_label = 'bogus' THEN 'invalid final_label ''bogus''' WHEN decision = 'confirm_downgrade' AND label = 'requirement_bearing' AND new_label = 'requirement_bearing' THEN 'confirm_downgrade cannot keep requirement_bearing'
    WHEN decision = 'extract' AND quotes = 2 THEN 'extract decision without requirements' WHEN decision = 'extract' AND quotes = 1 THEN 'requirements[1]: verbatim_quote not found in source span' WHEN decision = 'nonsense' THEN 'invalid decision ''nonsense''' END AS why FROM dj)),
made AS (SELECT doc_id, id, CASE WHEN pos = 0 THEN 'shall keep' ELSE 'part ' || doc_id || ',' || chr(10) || 'and file' END AS quote, row_number() OVER (PARTITION BY doc_id ORDER BY seq, id, pos) + coalesce(last, 0) AS no
  FROM (SELECT * FROM dr WHERE seq = won AND decision = 'extract') LEFT JOIN (SELECT doc_id, max(n) AS last FROM li WHERE n % 4 = 0 GROUP BY doc_id) USING (doc_id), range(2) r(pos)),
held AS (SELECT doc_id, id, count(*) AS n_statements, min('R' || lpad(CAST(no AS VARCHAR), 5, '0')) AS first_id, max(md5(quote)) AS last_quote FROM (SELECT * FROM made UNION ALL SELECT doc_id, n, 'Firms', n FROM li WHERE n % 4 = 0) GROUP BY ALL)"""

SQL = {
    "ruled_classes": f"""WITH RECURSIVE {ASKED}, {CLASS_WALK} SELECT doc_id, 'S' || id AS span_id, label AS final_label, array_to_string(embedded, ',') AS embedded, ambiguous, note FROM cw QUALIFY row_number() OVER (PARTITION BY doc_id, id ORDER BY step DESC) = 1""",
    "ruled_edges": f"""WITH RECURSIVE {ASKED}, {EDGE_WALK}, last AS (SELECT * FROM ew QUALIFY row_number() OVER (PARTITION BY doc_id, id ORDER BY step DESC) = 1)
      SELECT doc_id, 'E' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY id) AS VARCHAR), 4, '0') AS rel_id, 'R' || id AS src, type, evidence, ambiguous FROM last WHERE NOT dropped""",
    "ruled_statements": f"""WITH RECURSIVE {ASKED}, {STATEMENT_WALK}, last AS (SELECT * FROM sw QUALIFY row_number() OVER (PARTITION BY doc_id, id ORDER BY step DESC) = 1)
      SELECT doc_id, 'R' || lpad(CAST(id AS VARCHAR), 5, '0') AS req_id, quote AS verbatim_quote, statement AS atomic_statement, modality, tags, ambiguous FROM last WHERE NOT dropped""",
    "ruled_downgrades": f"""WITH {ASKED}, {DOWNGRADE_WALK}
      SELECT doc_id, 'S' || id AS span_id, CASE WHEN decision = 'confirm_downgrade' AND label = 'requirement_bearing' THEN new_label ELSE label END AS final_label,
        CASE WHEN decision = 'confirm_downgrade' THEN array_to_string([x FOR x IN string_split(embedded, ',') IF x NOT IN ('', 'requirement_bearing') AND (label <> 'requirement_bearing' OR x <> new_label)], ',') ELSE embedded END AS embedded,
        decision IS DISTINCT FROM 'confirm_downgrade' AS ambiguous, pending AND decision IS NULL AS downgrade_pending, decision AS resolution, coalesce(n_statements, 0) AS n_statements, first_id, last_quote
      FROM dc LEFT JOIN (SELECT doc_id, id, decision, new_label FROM dr WHERE seq = won) USING (doc_id, id) LEFT JOIN held USING (doc_id, id)""",
    "ruling_log": f"""WITH {ASKED}, {CLASS_WALK.split(",\ncw AS")[0]}, {EDGE_WALK.split(",\new AS")[0]}, {STATEMENT_WALK.split(",\nsw AS")[0]}, {DOWNGRADE_WALK.split(",\nmade AS")[0]},
    logs AS (SELECT doc_id, 'class' AS kind, 'updated' AS done, CASE WHEN id = 99 THEN 'not found' WHEN NOT coalesce(fits, false) THEN 'invalid label' END AS why FROM cd
      UNION ALL SELECT doc_id, 'edge', CASE decision WHEN 'drop' THEN 'dropped' WHEN 'edit' THEN 'edited' ELSE 'kept' END, CASE WHEN id = 99 THEN 'not found' WHEN decision = 'drop' THEN NULL WHEN decision = 'nonsense' THEN 'invalid decision ''nonsense''' WHEN shown = 'no_such_type' THEN 'invalid type ''no_such_type''' END FROM ed
      UNION ALL SELECT doc_id, 'statement', CASE decision WHEN 'drop' THEN 'dropped' WHEN 'edit' THEN 'edited' ELSE 'kept' END, CASE WHEN id = 99 THEN 'not found' WHEN decision = 'nonsense' THEN 'invalid decision ''nonsense''' WHEN decision = 'edit' AND quote IS NULL THEN 'edited verbatim_quote not found in source span' END FROM sd
      UNION ALL SELECT doc_id, 'downgrade', CASE decision WHEN 'extract' THEN 'extracted' ELSE 'confirmed' END, CASE WHEN label IS NOT NULL AND seq > won THEN 'no pending downgrade' ELSE why END FROM dr)
    SELECT doc_id, kind, CASE WHEN why IS NULL THEN done END AS outcome, why AS reason, count(*) AS n FROM logs GROUP BY ALL""",
}
