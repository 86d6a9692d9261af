"""Queries over a catalog derived from orders (spans) and their line items (statements): sections, status, reconciling, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanledger.functions import text
from spanledger.operators import annotate, audit, graph, lines, packets, refs, segment, statements, status, views
from spanledger.plans.regtext import LINES_SQL, REG_SQL, reg_lines, table

from .catalog import REFS, all_refs, big, kept_spans, reg_spans

BEARING = audit.BEARING


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span per order; every eleventh has no citation, every 13th no class."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 20 AS doc_id", "o_orderkey AS at", "concat('S', o_orderkey) AS span_id", "CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('§ ', o_custkey % 20 + 1, '.', o_orderkey) END AS citation",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'section_header' ELSE 'paragraph' END AS kind", "concat('(', char(97 + o_orderkey % 26), ') Status ', o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN ' means' ELSE ' is' END, ' that order\\n', o_orderpriority, ' counts, as of old.\\n') AS text",
        "o_orderkey * 10 AS byte_start", "o_orderkey * 10 + o_orderkey % 97 AS byte_end",
    )


def bare_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderkey % 13 <> 0").selectExpr(
        "o_custkey % 20 AS doc_id", "o_orderkey AS at", "concat('S', o_orderkey) AS span_id", "element_at(array('requirement_bearing', 'definition', 'scope_inclusion', 'scope_exclusion'), CAST(o_orderkey % 4 AS INT) + 1) AS final_label",
        "CASE WHEN o_orderkey % 6 = 0 THEN array('requirement_bearing') ELSE CAST(array() AS array<string>) END AS final_embedded", "o_orderkey % 7 = 0 AS ambiguous",
    )


def said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements: the line items of orders that nine does not divide."""
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    li = table(spark, sf_dir, "lineitem").filter("l_orderkey % 9 <> 0").withColumn("rn", rn)
    t = li.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return t.selectExpr(
        "o_custkey % 20 AS doc_id", "l_orderkey * 1000 + rn AS at", "concat('R', l_orderkey, '.', rn) AS req_id", "concat('S', l_orderkey) AS source_span_id", "l_orderkey", "l_partkey", "rn", "concat('C', l_orderkey) AS citation_raw",
        "CASE l_returnflag WHEN 'A' THEN 'shall' WHEN 'N' THEN 'may' ELSE 'must' END AS modality", "concat('ship part ', l_partkey) AS atomic_statement", "concat('that order\\n', o_orderpriority) AS verbatim_quote", "rn = 2 AS ambiguous",
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each statement leads to the next of its order, the last to one that is not there."""
    return said(spark, sf_dir).selectExpr("doc_id", "req_id AS src", "concat('R', l_orderkey, '.', rn + 1) AS dst", "element_at(array('refines', 'references', 'composed_of'), CAST(l_partkey % 3 AS INT) + 1) AS type", "l_partkey % 5 = 0 AS ambiguous")


CATALOG_SQL = """spans AS (SELECT o_custkey % 20 AS doc_id, o_orderkey AS pos, 'S' || o_orderkey AS span_id, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '§ ' || (o_custkey % 20 + 1) || '.' || o_orderkey END AS citation,
  CASE WHEN o_orderkey % 5 = 0 THEN 'section_header' ELSE 'paragraph' END AS kind, '(' || chr(CAST(97 + o_orderkey % 26 AS INTEGER)) || ') Status ' || o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN ' means' ELSE ' is' END || ' that order' || chr(10) || o_orderpriority || ' counts, as of old.' || chr(10) AS text,
  o_orderkey * 10 AS byte_start, o_orderkey * 10 + o_orderkey % 97 AS byte_end FROM orders),
said AS (SELECT o_custkey % 20 AS doc_id, l_orderkey * 1000 + rn AS pos, 'R' || l_orderkey || '.' || rn AS req_id, 'S' || l_orderkey AS source_span_id, l_orderkey, l_partkey, rn, 'C' || l_orderkey AS citation_raw,
  CASE l_returnflag WHEN 'A' THEN 'shall' WHEN 'N' THEN 'may' ELSE 'must' END AS modality, 'ship part ' || l_partkey AS atomic_statement, 'that order' || chr(10) || o_orderpriority AS verbatim_quote, rn = 2 AS ambiguous
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rn FROM lineitem WHERE l_orderkey % 9 <> 0) JOIN orders ON l_orderkey = o_orderkey),
classes AS (SELECT *, final_label = 'requirement_bearing' OR embedded <> '' AS bears, (final_label = 'requirement_bearing' OR embedded <> '') AND span_id NOT IN (SELECT source_span_id FROM said) AS pending
  FROM (SELECT o_custkey % 20 AS doc_id, o_orderkey AS pos, 'S' || o_orderkey AS span_id, ['requirement_bearing', 'definition', 'scope_inclusion', 'scope_exclusion'][o_orderkey % 4 + 1] AS final_label,
    CASE WHEN o_orderkey % 6 = 0 THEN 'requirement_bearing' ELSE '' END AS embedded, o_orderkey % 7 = 0 AS ambiguous FROM orders WHERE o_orderkey % 13 <> 0)),
edges AS (SELECT doc_id, req_id AS src, 'R' || l_orderkey || '.' || (rn + 1) AS dst, ['refines', 'references', 'composed_of'][l_partkey % 3 + 1] AS type, l_partkey % 5 = 0 AS ambiguous FROM said)"""

#: The text with its wraps joined, as sections show it.
CLEAN_SQL = "trim(replace(text, chr(10), ' '))"
CITED_SQL = "coalesce(nullif(citation, ''), span_id)"


def cited(df: DataFrame) -> DataFrame:
    return df.withColumn("citation", F.coalesce(F.nullif("citation", F.lit("")), "span_id"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cited(spans(spark, sf_dir)).join(bare_classes(spark, sf_dir).drop("at"), ["doc_id", "span_id"]).withColumn("label", F.col("final_label"))


def definition_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.definition_lines(labelled(spark, sf_dir)).select("doc_id", F.col("ord.at").alias("pos"), "line")


def scope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.scope_lines(labelled(spark, sf_dir)).select("doc_id", F.col("ord.at.rank").alias("rank"), F.col("ord.at.at").alias("pos"), "line")


def bearing_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.span_heads(labelled(spark, sf_dir).filter(audit.is_bearing())).select("doc_id", F.col("ord.at").alias("pos"), "ord.k", "line")


def statement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.statement_lines(said(spark, sf_dir), edges(spark, sf_dir)).select("doc_id", F.col("ord.at").alias("pos"), "ord.k", "line")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log row per order, of all stages in turn."""
    log = table(spark, sf_dir, "orders").selectExpr("o_custkey % 20 AS doc_id", "o_orderkey AS at", "element_at(array('classify', 'decompose', 'relate', 'other'), CAST(o_orderkey % 4 AS INT) + 1) AS stage", "concat('S', o_orderkey) AS key", "CASE WHEN o_orderkey % 3 = 0 THEN 'ambiguous' ELSE 'resolved' END AS status", "'definition' AS label_a", "o_orderstatus AS label_b", "'definition' AS final_label", "o_orderkey % 5 AS count_a", "o_orderkey % 7 AS count_b", "o_orderkey % 6 AS count_final", "nullif(o_orderkey % 2, 0) AS ambiguous_items")
    return views.log_lines(log).select("doc_id", F.col("ord.at").alias("pos"), "line")


def appendix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = bare_classes(spark, sf_dir).select("doc_id", "span_id", F.col("final_label").alias("label"), "ambiguous")
    return views.appendix_lines(spans(spark, sf_dir).join(c, ["doc_id", "span_id"], "left")).select("doc_id", F.col("ord.at").alias("pos"), "line")


def pending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = annotate.mark_pending(bare_classes(spark, sf_dir), said(spark, sf_dir))
    return views.pending_lines(c).select("doc_id", F.col("ord.at").alias("pos"), "line")


def catalog_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine counters; candidates of the embedded audit are classes that bear nothing and are ambiguous."""
    plain = bare_classes(spark, sf_dir)
    c = annotate.mark_pending(plain, said(spark, sf_dir)).withColumn("downgrade_pending", F.col("downgrade_pending") & (F.col("at") % 2 == 0))
    out = status.pipeline_status(spans(spark, sf_dir), c, said(spark, sf_dir), edges(spark, sf_dir), plain.filter(~audit.is_bearing() & F.col("ambiguous")))
    return out.select("doc_id", *(big(x) for x in ("spans", "classifications", "classification_pending", "bearing_spans", "statements", "decompose_pending", "downgrades_pending", "embedded_pending", "edges")))


def agent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three annotators return: a every statement, b the same but, for orders that four divides, without its last word, and r the first two."""
    s = said(spark, sf_dir).select("doc_id", F.col("source_span_id").alias("span_id"), F.col("rn").alias("seq"), F.concat(F.lit(" "), F.replace("verbatim_quote", F.lit("\n"), F.lit(",  ")), F.lit(" ")).alias("verbatim_quote"), "atomic_statement", F.upper("modality").alias("modality"), "ambiguous", "l_orderkey", F.array(F.lit(" Ship"), F.lit(""), F.lit("Old ")).alias("tags"), F.array(F.lit(" if due "), F.lit("")).alias("conditions"))
    other = F.when(F.col("l_orderkey") % 4 == 0, F.lit("that order")).otherwise(F.col("verbatim_quote"))
    return s.withColumn("agent", F.lit("a")).unionByName(s.withColumn("verbatim_quote", other).withColumn("agent", F.lit("b"))).unionByName(s.filter("seq <= 2").withColumn("agent", F.lit("r")))


def decomposed_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reconciled rows as statements, their numbers left to next_numbers: here the order within a span counts."""
    kept, _ = statements.reconciled(agent_rows(spark, sf_dir), spans(spark, sf_dir))
    made = statements.construct(kept, spans(spark, sf_dir))
    return made.groupBy("doc_id", "source_span_id", "citation_raw", "verbatim_quote", "modality", F.array_join("tags", ",").alias("tags"), F.array_join("conditions", ",").alias("conditions")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ambiguous").alias("n_ambiguous"))


def decompose_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.reconciled(agent_rows(spark, sf_dir), spans(spark, sf_dir))[1]


def completed_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans without statements: those of even orders get one from the reconciler, the others wait."""
    given = spans(spark, sf_dir).filter("at % 2 = 0").select("doc_id", "span_id", F.lit(1).alias("seq"), F.lit("that order").alias("verbatim_quote"), F.lit("completed").alias("atomic_statement"), F.lit("may").alias("modality"), F.array().cast("array<string>").alias("tags"), F.array().cast("array<string>").alias("conditions"), F.lit(False).alias("ambiguous"))
    last = packets.next_number(said(spark, sf_dir).select("doc_id", F.lit("R00100").alias("req_id")), "req_id")
    classes, made = statements.completed(bare_classes(spark, sf_dir), said(spark, sf_dir), given, spans(spark, sf_dir), last)
    waits = classes.filter(F.coalesce("downgrade_pending", F.lit(False))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pending"))
    new = made.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_made"), F.min("req_id").alias("first_id"), F.max("req_id").alias("last_id"))
    return new.join(waits, "doc_id", "full").select("doc_id", F.coalesce("n_made", F.lit(0)).cast("bigint").alias("n_made"), "first_id", "last_id", F.coalesce("n_pending", F.lit(0)).cast("bigint").alias("n_pending"))


def related_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of two annotators who differ in the chunk of every third document, where the third's stand."""
    e = edges(spark, sf_dir).select("doc_id", (F.col("doc_id") % 3).alias("chunk"), F.col("src").alias("seq"), "src", "dst", F.when(F.col("doc_id") == 5, "other").otherwise(F.col("type")).alias("type"), F.col("src").alias("evidence"), "ambiguous")
    b = e.withColumn("evidence", F.when(F.col("doc_id") % 3 == 0, "else").otherwise(F.col("evidence")))
    r = e.filter(F.col("type") == "refines").withColumn("evidence", F.lit(None).cast("string"))
    every = e.withColumn("agent", F.lit("a")).unionByName(b.withColumn("agent", F.lit("b"))).unionByName(r.withColumn("agent", F.lit("r"))).unionByName(e.withColumn("agent", F.lit("a")))
    every = every.unionByName(b.withColumn("agent", F.lit("b")))
    return statements.relate(every, said(spark, sf_dir)).select("doc_id", "rel_id", "src", "dst", "type", "evidence", "ambiguous")


def adjudication_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = statements.requests(bare_classes(spark, sf_dir).filter("ambiguous"), spans(spark, sf_dir), said(spark, sf_dir))
    return out.groupBy("doc_id", "batch").agg(F.count(F.lit(1)).alias("n_items"), F.min("span_id").alias("first_span"), F.sum(F.size("req_ids")).cast("bigint").alias("n_statements"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


def compact_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = said(spark, sf_dir)
    seen = statements.compact(rows, ("req_id", "modality", "verbatim_quote")).withColumnRenamed("item", "short")
    return seen.join(statements.compact(rows, ("req_id", "source_span_id", "ambiguous")), ["doc_id", "req_id"]).select("doc_id", "req_id", "short", "item")


def embedded_with_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = bare_classes(spark, sf_dir)
    return statements.bearing_with_statement(c, said(spark, sf_dir), audit.is_bearing() & (F.col("final_label") != BEARING))


def registry_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as registry rows: nation as jurisdiction, balance as status, segment and key as tags."""
    reg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("j"), F.col("c_nationkey") % 3).alias("jurisdiction"), F.when(F.col("c_acctbal") > 0, "completed").otherwise("in_progress").alias("status"), F.array(F.lower("c_mktsegment"), F.concat(F.lit("k"), F.col("c_custkey") % 4)).alias("applies_to"))
    return status.list_registry(reg, "j1", "completed", "k2").select("doc_id", "jurisdiction", "status", F.array_join("applies_to", ",").alias("applies_to"))


def released_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    claims = o.select(F.col("o_orderpriority").alias("stage"), F.col("o_orderkey").alias("batch_id"), F.when(F.col("o_orderkey") % 3 == 0, "merged").when(F.col("o_orderkey") % 3 == 1, "active").otherwise("validated").alias("status"), (F.col("o_orderkey") % 50).alias("item_count"))
    out = status.released(claims, o.filter("o_orderkey % 4 = 0").select(F.col("o_orderpriority").alias("stage"), F.col("o_orderkey").alias("batch_id")))
    return out.groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n_claims"), F.sum("item_count").cast("bigint").alias("n_items"))


def divergent_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "orders").selectExpr("o_custkey % 20 AS doc_id", "o_orderkey AS span_id", "o_orderkey % 11 AS count_a", "o_orderkey % 7 AS count_b")
    return status.divergent(log)


def latest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").selectExpr("user_id % 30 AS doc_id", "event_type AS stage", "date_format(ts, 'yyyy-MM-dd') AS run_id", "event_id AS key")
    return status.latest_log(log).groupBy("doc_id", "stage", "run_id").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))


def safety_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").selectExpr("user_id % 30 AS doc_id", "CASE event_id % 3 WHEN 0 THEN 'embedded_obligation_added' WHEN 1 THEN 'false_positive' ELSE 'kept' END AS decision")
    return status.safety_net(log)


def downgrade_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = bare_classes(spark, sf_dir).withColumn("note", F.when(F.col("at") % 3 == 0, F.concat(F.lit("decomposer found 0 obligations, "), "span_id")))
    return status.downgrade_history(c)


def decision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage with every outcome: documents of even suppliers are processed, and the part's number names its domain."""
    r = all_refs(spark, sf_dir)
    part = F.col("part").cast("bigint") % 4
    seen = r.filter("NOT auto_resolved").select(text.cited_part(F.col("citation")).alias("part")).distinct()
    domains = seen.select("part", F.when(part == 0, "core").when(part == 1, "out").when(part == 2, "later").alias("domain"))
    done = table(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").select((F.col("s_suppkey") + 9000).cast("string").alias("part"))
    out = refs.triage(r, done, domains, core=("core",), exclude=("out",), defer=("later",))
    return out.groupBy("decision", "reason").agg(F.count(F.lit(1)).alias("n_parts"), F.sum("n_refs").cast("bigint").alias("n_refs"))


def cited_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most cited numbers in texts that name parts, full citations and sections."""
    r = table(spark, sf_dir, "lineitem").selectExpr("concat('see part ', l_partkey % 40 + 1, ', 21 CFR ', l_suppkey + 1, '.', l_linenumber, ' and § ', l_linenumber, '.7') AS citation", "l_returnflag = 'A' AS auto_resolved")
    return status.cited_parts(r)


def top_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts most often cited, ties by their number."""
    parts = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 97).cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n_refs"))
    return status.top(parts, 30, F.col("n_refs").desc(), F.col("part").cast("int"))


def markers_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = reg_spans(spark, sf_dir).filter(~F.array_contains("path", "b"))
    return status.markers_missing(reg_lines(spark, sf_dir), held)


def char_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.char_offsets(lines.split_lines(table(spark, sf_dir, "documents"))).select("doc_id", big("line_no"), "byte_start", "char_start")


def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose commas are page feeds."""
    d = lines.split_lines(table(spark, sf_dir, "documents")).withColumn("line", F.replace("line", F.lit(","), F.lit("\f")))
    return status.page_numbers(d).groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("bigint").alias("n_chars"))


def document_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "21-cfr-part-").otherwise("45-cfr-part-"), F.col("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.doc_part(slug).alias("part"))


def map_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = kept_spans(spark, sf_dir)
    st = spans.selectExpr("doc_id", "concat('R', seq) AS req_id", "span_id AS source_span_id", "seq")
    ids: Column = F.concat(F.col("doc_id"), F.lit(":R"), F.col("seq"))
    intra = st.select(ids.alias("src"), F.concat(F.col("doc_id"), F.lit(":R"), F.col("seq") + 1).alias("dst"), F.lit("intra").alias("scope"), F.lit("refines").alias("type"), F.col("doc_id").alias("src_doc"), F.col("doc_id").alias("dst_doc"))
    twice = intra.withColumn("time", F.explode(F.array(F.lit(1), F.lit(2)))).drop("time")  # side by side, so that they merge before the shuffle
    return refs.atomic_map(all_refs(spark, sf_dir, spans), st.drop("seq"), twice)[2]


def regulation_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # made once for the spans and their parents
    out = graph.stored(segment.regulation_spans(reg_lines(spark, sf_dir), F.col("doc_id") + 100).select("doc_id", "span_id", "parent_span_id", "kind", "cite"))
    up = out.select("doc_id", F.col("span_id").alias("parent_span_id"), F.col("cite.raw").alias("parent_raw"))
    t = out.join(up, ["doc_id", "parent_span_id"], "left")
    return t.groupBy("doc_id", "kind", F.col("cite.title").alias("title"), F.col("cite.part").alias("part"), F.col("cite.section").alias("section"), F.size("cite.paragraphs").cast("bigint").alias("depth"), "parent_raw").agg(F.count(F.lit(1)).alias("n"), F.min("cite.raw").alias("first_raw"))


QUERIES = {f.__name__: f for f in (definition_lines, scope_lines, bearing_heads, statement_lines, log_lines, appendix_lines, pending_lines, catalog_status, decomposed_statements, decompose_log, completed_spans, related_edges, adjudication_requests, compact_items, embedded_with_statement, registry_list, released_claims, divergent_counts, latest_log, safety_net, downgrade_history, decision_summary, cited_parts, top_unresolved, markers_missing, char_offsets, page_numbers, document_parts, map_stats, regulation_parents)}

LABELLED = f"WITH {CATALOG_SQL}, l AS (SELECT s.*, {CITED_SQL.replace('span_id', 's.span_id')} AS cited, final_label, embedded, ambiguous, bears FROM spans s JOIN classes c USING (doc_id, span_id))"
SQL = {
    "definition_lines": f"""{LABELLED} SELECT doc_id, pos, CASE WHEN strpos(text, ' means ') > 0 THEN '- **' || trim(substring(split_part(text, ' means ', 1), strpos(text, ')') + 1)) || '** (' || cited || '): means ' || rtrim(split_part(text, ' means ', 2), chr(10))
      ELSE '- (' || cited || '): ' || rtrim(text, chr(10)) END AS line FROM l WHERE final_label = 'definition'""",
    "scope_lines": f"{LABELLED} SELECT doc_id, CASE final_label WHEN 'scope_inclusion' THEN 0 ELSE 1 END AS rank, pos, '- **' || cited || '**: ' || {CLEAN_SQL} AS line FROM l WHERE final_label LIKE 'scope%'",
    "bearing_heads": f"""{LABELLED} SELECT doc_id, pos, 0 AS k, '#### ' || cited || CASE WHEN ambiguous THEN '  **[ambiguous]**' ELSE '' END || CASE WHEN embedded <> '' THEN '  _[primary: ' || final_label || '; also: ' || embedded || ']_' ELSE '' END AS line FROM l WHERE bears
      UNION ALL SELECT doc_id, pos, 1, '> ' || {CLEAN_SQL} FROM l WHERE bears""",
    "statement_lines": f"""WITH {CATALOG_SQL} SELECT doc_id, pos, 0 AS k, '- **`' || req_id || '`** [' || modality || ']' || CASE WHEN ambiguous THEN '  ⚠ ambiguous' ELSE '' END || ' ' || atomic_statement AS line FROM said
      UNION ALL SELECT doc_id, pos, 1, '  - quote: "' || replace(verbatim_quote, chr(10), ' ') || '"' FROM said
      UNION ALL SELECT e.doc_id, s.pos, 2, '  - **' || type || '**' || CASE WHEN e.ambiguous THEN ' ⚠' ELSE '' END || ' → `' || dst || '` (' || coalesce(t.citation_raw, '?') || ')' FROM edges e JOIN said s ON s.doc_id = e.doc_id AND s.req_id = src LEFT JOIN said t ON t.doc_id = e.doc_id AND t.req_id = dst
      UNION ALL SELECT e.doc_id, s.pos, 3, '  - referenced by: 1 ' || type FROM edges e JOIN said s ON s.doc_id = e.doc_id AND s.req_id = dst""",
    "log_lines": """WITH l AS (SELECT o_custkey % 20 AS doc_id, o_orderkey AS pos, o_orderkey % 4 AS s, o_orderkey AS o, o_orderstatus FROM orders)
      SELECT doc_id, pos, '- **' || ['classify', 'decompose', 'relate', 'other'][s + 1] || '** `S' || o || '` — status: **' || CASE WHEN o % 3 = 0 THEN 'ambiguous' ELSE 'resolved' END || '**' ||
        CASE WHEN s = 0 THEN '  (A=definition → B=' || o_orderstatus || ' → final=definition)' WHEN s = 3 THEN '' ELSE '  (A=' || (o % 5) || CASE s WHEN 1 THEN ' reqs' ELSE ' edges' END || ', B=' || (o % 7) || CASE s WHEN 1 THEN ' reqs' ELSE ' edges' END || ', final=' || (o % 6) || ', ambiguous_items=' || (o % 2) || ')' END AS line FROM l""",
    "appendix_lines": f"WITH {CATALOG_SQL} SELECT s.doc_id, s.pos, '| `' || s.span_id || '` | ' || citation || ' | `' || kind || '` | ' || coalesce(final_label, '—') || CASE WHEN coalesce(ambiguous, false) THEN ' ⚠' ELSE '' END || ' | ' || (byte_end - byte_start) || ' |' AS line FROM spans s LEFT JOIN classes c ON c.span_id = s.span_id",
    "pending_lines": f"WITH {CATALOG_SQL} SELECT doc_id, pos, '- `' || span_id || '` — final: **' || final_label || '**  proposed: **' || CASE WHEN final_label = 'requirement_bearing' THEN 'administrative' ELSE final_label END || '** (kind: ' || CASE WHEN final_label = 'requirement_bearing' THEN 'primary' ELSE 'embedded' END || ')' AS line FROM classes WHERE pending",
    "catalog_status": f"""WITH {CATALOG_SQL}, c AS (SELECT doc_id, count(*) AS classifications, count(*) FILTER (bears) AS bearing_spans, count(*) FILTER (pending AND pos % 2 = 1) AS decompose_pending, count(*) FILTER (pending AND pos % 2 = 0) AS downgrades_pending, count(*) FILTER (NOT bears AND ambiguous) AS embedded_pending FROM classes GROUP BY doc_id)
      SELECT doc_id, spans, coalesce(classifications, 0) AS classifications, spans - coalesce(classifications, 0) AS classification_pending, coalesce(bearing_spans, 0) AS bearing_spans, coalesce(n, 0) AS statements, coalesce(decompose_pending, 0) AS decompose_pending, coalesce(downgrades_pending, 0) AS downgrades_pending, coalesce(embedded_pending, 0) AS embedded_pending, coalesce(n, 0) AS edges
      FROM (SELECT doc_id, count(*) AS spans FROM spans GROUP BY doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM said GROUP BY doc_id) USING (doc_id)""",
    "decomposed_statements": f"""WITH {CATALOG_SQL} SELECT s.doc_id, source_span_id, {CITED_SQL} AS citation_raw, verbatim_quote, modality, 'ship,old' AS tags, 'if due' AS conditions, count(*) AS n, count(*) FILTER (ambiguous) AS n_ambiguous
      FROM said s JOIN spans p ON p.span_id = source_span_id WHERE l_orderkey % 4 <> 0 OR rn <= 2 GROUP BY ALL""",
    "decompose_log": f"""WITH {CATALOG_SQL}, n AS (SELECT doc_id, source_span_id AS span_id, count(*) AS n, count(*) FILTER (rn <= 2) AS two, count(*) FILTER (rn = 2) AS second FROM said WHERE l_orderkey % 4 = 0 GROUP BY ALL)
      SELECT doc_id, span_id, n AS count_a, n AS count_b, two AS count_final, second AS ambiguous_items, CASE WHEN second > 0 THEN 'ambiguous' ELSE 'resolved' END AS status FROM n""",
    "completed_spans": f"""WITH {CATALOG_SQL} SELECT doc_id, count(*) FILTER (pos % 2 = 0) AS n_made, CASE WHEN count(*) FILTER (pos % 2 = 0) > 0 THEN 'R00101' END AS first_id, CASE WHEN count(*) FILTER (pos % 2 = 0) > 0 THEN 'R' || lpad(CAST(100 + count(*) FILTER (pos % 2 = 0) AS VARCHAR), 5, '0') END AS last_id, count(*) FILTER (pos % 2 = 1) AS n_pending FROM classes WHERE pending GROUP BY doc_id""",
    "related_edges": f"""WITH {CATALOG_SQL} SELECT doc_id, 'E' || lpad(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY src) AS VARCHAR), CAST(greatest(4, length(CAST(row_number() OVER (PARTITION BY doc_id ORDER BY src) AS VARCHAR))) AS INTEGER), '0') AS rel_id, src, dst, type, CASE WHEN doc_id % 3 = 0 THEN '' ELSE src END AS evidence, ambiguous
      FROM edges WHERE doc_id <> 5 AND dst IN (SELECT req_id FROM said) AND (doc_id % 3 <> 0 OR type = 'refines')""",
    "adjudication_requests": f"""WITH {CATALOG_SQL}, i AS (SELECT c.doc_id, c.span_id, text, (SELECT count(*) FROM said WHERE source_span_id = c.span_id) AS n, (row_number() OVER (PARTITION BY c.doc_id ORDER BY c.span_id) - 1) // 25 AS batch FROM classes c JOIN spans s ON s.span_id = c.span_id WHERE ambiguous)
      SELECT doc_id, batch, count(*) AS n_items, min(span_id) AS first_span, CAST(sum(n) AS BIGINT) AS n_statements, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM i GROUP BY ALL""",
    "compact_items": f"""WITH {CATALOG_SQL} SELECT doc_id, req_id, '{{"req_id":"' || req_id || '","modality":"' || modality || '","verbatim_quote":"' || replace(verbatim_quote, chr(10), '\\n') || '"}}' AS short, '{{"req_id":"' || req_id || '","source_span_id":"' || source_span_id || '","ambiguous":' || ambiguous || '}}' AS item FROM said""",
    "embedded_with_statement": f"WITH {CATALOG_SQL} SELECT doc_id, count(*) AS n FROM classes WHERE bears AND NOT pending AND final_label <> 'requirement_bearing' GROUP BY doc_id",
    "registry_list": "SELECT c_custkey AS doc_id, 'j1' AS jurisdiction, 'completed' AS status, lower(c_mktsegment) || ',k2' AS applies_to FROM customer WHERE c_nationkey % 3 = 1 AND c_acctbal > 0 AND c_custkey % 4 = 2",
    "released_claims": """SELECT o_orderpriority AS stage, CASE WHEN o_orderkey % 3 = 0 THEN 'merged' WHEN o_orderkey % 4 = 0 THEN 'released' WHEN o_orderkey % 3 = 1 THEN 'active' ELSE 'validated' END AS status, count(*) AS n_claims, CAST(sum(o_orderkey % 50) AS BIGINT) AS n_items FROM orders GROUP BY ALL""",
    "divergent_counts": "SELECT o_custkey % 20 AS doc_id, o_orderkey AS span_id, o_orderkey % 11 AS count_a, o_orderkey % 7 AS count_b, abs(o_orderkey % 11 - o_orderkey % 7) AS apart FROM orders WHERE abs(o_orderkey % 11 - o_orderkey % 7) > 3 ORDER BY apart DESC, doc_id, span_id LIMIT 10",
    "latest_log": """WITH l AS (SELECT user_id % 30 AS doc_id, event_type AS stage, strftime(ts, '%Y-%m-%d') AS run_id, event_id AS key FROM events), m AS (SELECT *, max(run_id) OVER (PARTITION BY doc_id, stage) AS last FROM l)
      SELECT doc_id, stage, run_id, count(*) AS n, min(key) AS first_key FROM m WHERE run_id = last GROUP BY ALL""",
    "safety_net": "SELECT user_id % 30 AS doc_id, count(*) FILTER (event_id % 3 = 0) AS rescued, count(*) FILTER (event_id % 3 = 1) AS filtered FROM events WHERE event_id % 3 <> 2 GROUP BY ROLLUP (user_id % 30)",
    "downgrade_history": f"WITH {CATALOG_SQL}, h AS (SELECT doc_id, span_id, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY span_id) AS rn FROM classes WHERE pos % 3 = 0) SELECT doc_id, span_id, n FROM h WHERE rn <= 5",
    "cited_parts": """WITH c AS (SELECT unnest([CAST(l_partkey % 40 + 1 AS BIGINT), CAST(l_suppkey + 1 AS BIGINT)]) AS part FROM lineitem WHERE l_returnflag <> 'A') SELECT CAST(part AS VARCHAR) AS part, count(*) AS n FROM c GROUP BY part ORDER BY count(*) DESC, c.part LIMIT 15""",
    "top_unresolved": "SELECT CAST(l_partkey % 97 AS VARCHAR) AS part, count(*) AS n_refs FROM lineitem GROUP BY l_partkey % 97 ORDER BY count(*) DESC, l_partkey % 97 LIMIT 30",
    "markers_missing": f"WITH {REG_SQL}, m AS (SELECT DISTINCT doc_id, substring(line, 2, 1) AS marker FROM reg WHERE line LIKE '(%') SELECT doc_id, count(*) AS found, count(*) FILTER (marker <> 'b') AS common, count(*) FILTER (marker = 'b') AS missing FROM m GROUP BY doc_id",
    "char_offsets": f"WITH {LINES_SQL} SELECT doc_id, line_no, CAST(coalesce(sum(strlen(line) + 1) OVER w, 0) AS BIGINT) AS byte_start, CAST(coalesce(sum(length(line) + 1) OVER w, 0) AS BIGINT) AS char_start FROM docl WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    "page_numbers": f"""WITH {LINES_SQL}, p AS (SELECT doc_id, line_no, unnest(string_split(line, ',')) AS piece, unnest(generate_series(0, len(string_split(line, ',')) - 1)) AS k FROM docl),
      q AS (SELECT doc_id, piece, 1 + sum(CASE WHEN k > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no, k) AS page FROM p) SELECT doc_id, CAST(page AS BIGINT) AS page, count(*) AS n_lines, CAST(sum(length(piece)) AS BIGINT) AS n_chars FROM q GROUP BY ALL""",
    "document_parts": "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS part FROM supplier",
    "regulation_parents": f"""WITH {REG_SQL}, body AS (SELECT doc_id, line_no, line, CASE WHEN line LIKE 'PART %' THEN 'part_header' WHEN line LIKE '§%' AND line_no < (SELECT min(r.line_no) FROM reg r WHERE r.doc_id = reg.doc_id AND r.line LIKE 'PART %') THEN 'toc_entry' WHEN line LIKE '§%' THEN 'section_header' WHEN line LIKE '(%' THEN 'paragraph' END AS kind FROM reg WHERE line <> ''),
      s AS (SELECT *, last_value(CASE WHEN line LIKE '§%' THEN regexp_extract(line, '^§ (\\d+\\.\\d+)', 1) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS number FROM body WHERE kind IS NOT NULL)
      SELECT doc_id, kind, '21' AS title, CAST(doc_id + 100 AS VARCHAR) AS part, CASE WHEN kind <> 'part_header' THEN number END AS section, CAST(CASE WHEN kind = 'paragraph' THEN 1 ELSE 0 END AS BIGINT) AS depth, CASE WHEN kind = 'paragraph' THEN '§ ' || number END AS parent_raw, count(*) AS n,
        min(CASE kind WHEN 'part_header' THEN 'PART ' || (doc_id + 100) WHEN 'paragraph' THEN '§ ' || number || substring(line, 1, 3) ELSE '§ ' || number END) AS first_raw FROM s GROUP BY ALL""",
    "decision_summary": f"""WITH {REFS}, stats AS (SELECT part, count(*) AS n_refs, count(DISTINCT source_doc) AS n_docs FROM refs WHERE NOT auto_resolved GROUP BY part),
      d AS (SELECT *, part - 9000 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) AS done FROM stats)
      SELECT CASE WHEN done THEN 'already_processed' WHEN part % 4 = 1 THEN 'exclude' WHEN part % 4 = 0 THEN 'process' ELSE 'defer' END AS decision,
        CASE WHEN done THEN 'processed' WHEN part % 4 = 1 THEN 'out' WHEN part % 4 = 0 THEN 'core' WHEN part % 4 = 2 THEN 'peripheral' WHEN n_docs >= 2 AND n_refs >= 5 THEN 'cited often' ELSE 'low context' END AS reason,
        count(*) AS n_parts, CAST(sum(n_refs) AS BIGINT) AS n_refs FROM d GROUP BY ALL""",
    "map_stats": f"""WITH {REFS} SELECT n_nodes, n_nodes + n_cross AS n_edges, n_nodes AS n_intra, n_cross FROM (SELECT count(*) AS n_nodes FROM regspans), (SELECT count(*) AS n_cross FROM (SELECT DISTINCT source_doc, seq, target_doc, target_seq FROM one WHERE auto_resolved))""",
}
