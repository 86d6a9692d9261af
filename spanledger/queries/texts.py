"""Queries over lines, canonical text, furniture, spans and signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions import rules, signals, text
from spanledger.operators import audit, graph, lines, segment
from spanledger.plans.regtext import LINES_SQL, REG_SQL, offsets_sql, reg_lines, table

big = lambda c: F.col(c).cast("bigint").alias(c)


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.split_lines(table(spark, sf_dir, "documents"))


def spaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a blank run after each sentence."""
    return lines.split_lines(table(spark, sf_dir, "documents").withColumn("text", F.replace("text", F.lit(". "), F.lit(".\n\n\n"))))


SPACED_SQL = LINES_SQL.replace("string_split(text, chr(10))", "string_split(replace(text, '. ', '.' || chr(10) || chr(10) || chr(10)), chr(10))")


def doc_coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line spans against the size that the text itself has, with a line feed at its end."""
    d = table(spark, sf_dir, "documents")
    total = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.octet_length("text") + F.when(F.endswith("text", F.lit("\n")), 0).otherwise(1))
    return audit.coverage(lines.with_offsets(lines.split_lines(d)), d.select("doc_id", total.cast("bigint").alias("total_bytes")))


def line_byte_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.with_offsets(doc_lines(spark, sf_dir)).select("doc_id", big("line_no"), "byte_start", "byte_end")


def canonical_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.join_lines(lines.collapse_blanks(spaced(spark, sf_dir))).drop("text")


def boilerplate_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = lines.tag_furniture(doc_lines(spark, sf_dir), rules.CORPUS_FURNITURE).filter("rule_id IS NOT NULL")
    return tagged.groupBy("rule_id").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("doc_id").alias("n_docs"))


def regulation_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = lines.tag_furniture(reg_lines(spark, sf_dir))
    kept = lines.join_lines(lines.collapse_blanks(tagged.filter("rule_id IS NULL"))).select("doc_id", "sha256", "byte_count")
    gone = tagged.groupBy("doc_id").agg(F.count_if(F.col("rule_id") == "PAGE_FOOTER_PAGE").alias("n_page_footers"))
    return kept.join(gone, "doc_id")


def title_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = doc_lines(spark, sf_dir)
    titles = at.filter("line_no = 0").select("doc_id", F.rtrim("line").alias("title"))
    tagged = lines.tag_titles(at.withColumn("rule_id", F.lit(None).cast("string")), titles).filter("rule_id IS NOT NULL")
    return tagged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_title_lines"))


def repeated_line_furniture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(doc_lines(spark, sf_dir))


def margin_number_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = reg_lines(spark, sf_dir)
    numbered = at.withColumn("line", F.when(F.col("line_no") % 7 != 3, F.concat((F.col("line_no") % 9000 + 1).cast("string"), F.lit("   "), "line")).otherwise(F.col("line")))
    out = lines.strip_margin_numbers(numbered)
    return out.groupBy("doc_id").agg(F.count_if("stripped").alias("n_stripped"), F.sum(F.length("line")).alias("n_chars"))


def generic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segment.generic_spans(spaced(spark, sf_dir))
    return out.select("doc_id", "span_id", "kind", "citation", "byte_start", "byte_end")


def regulation_line_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = segment.regulation_lines(reg_lines(spark, sf_dir), F.col("doc_id") + 100)
    return at.groupBy("doc_id", "role").agg(F.count(F.lit(1)).alias("n_lines"))


def regulation_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = segment.in_force(segment.regulation_lines(reg_lines(spark, sf_dir), F.col("doc_id") + 100))
    return at.filter("role = 'marker'").groupBy("doc_id", "section").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.min("byte_start").alias("first_byte"))


def regulation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segment.regulation_spans(reg_lines(spark, sf_dir), F.col("doc_id") + 100)
    return out.select("doc_id", "span_id", "kind", "section", F.array_join("path", "/").alias("path"), "citation", "byte_start", "byte_end")


def regulation_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = graph.cut(reg_lines(spark, sf_dir))
    sizes = lines.with_offsets(at).groupBy("doc_id").agg(F.max("byte_end").alias("total_bytes"))
    return audit.coverage(segment.regulation_spans(at, F.col("doc_id") + 100), sizes)


def paragraph_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Letters, numbers and romans nested by the quantities of an order's lines: the sequence rules decide what each single letter is."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS doc_id", "l_orderkey AS section_line", "l_linenumber AS ln", "l_partkey AS pk", "l_quantity AS q")
    marker = F.when(F.col("q") % 3 == 0, F.col("ln").cast("string")).when(F.col("q") % 3 == 1, F.lower(text.roman(F.col("ln")))).otherwise(F.char(F.col("ln") + 96))
    w = lines.by_doc("section_line", "ln", "pk", "q")
    marked = li.select("doc_id", "section_line", F.row_number().over(w).alias("line_no"), marker.alias("marker"))
    return segment.paragraph_paths(marked).groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("path").alias("n_paths"))


def decimal_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS doc_id", "0 AS part_no", "concat_ws('.', l_linenumber, l_orderkey % 20) AS two", "l_partkey % 3 AS k", "concat_ws('.', l_linenumber, l_orderkey % 20, l_partkey % 3 + 1) AS three", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    named = li.withColumn("section", F.when(F.col("k") == 0, F.col("two")).otherwise(F.col("three")))
    w = lines.by_doc("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    numbered = named.select("doc_id", "part_no", F.row_number().over(w).alias("seq"), "section")
    return segment.decimal_parents(numbered).select("doc_id", big("seq"), "section", big("parent_seq"))


def guideline_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guideline lines derived from orders: decimals of the key, now and then a roman part or a contents line."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey AS doc_id", "o_orderkey AS k", "o_orderpriority AS p", "o_orderstatus AS st")
    line = F.when(F.col("k") % 11 == 0, F.concat(text.roman(F.col("k") % 20 + 1), F.lit(". "), F.upper("p"))).when(F.col("k") % 7 == 0, F.concat(F.col("p"), F.lit(" ..... "), (F.col("k") % 90).cast("string"))).when(F.col("k") % 2 == 0, F.concat((F.col("k") % 9 + 1).cast("string"), F.lit("."), (F.col("k") % 5 + 1).cast("string"), F.lit(" "), F.col("p"))).otherwise(F.concat(F.lit("The order is "), F.lower("st"), F.lit(".")))
    at = o.select("doc_id", (F.row_number().over(lines.by_doc("k")) - 1).alias("line_no"), line.alias("line"))
    return segment.guideline_spans(at).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("byte_end") - F.col("byte_start")).alias("n_bytes"))


def roman_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3999 + 1).alias("number"))
    return o.groupBy("number").agg(F.count(F.lit(1)).alias("n")).withColumn("roman", text.roman(F.col("number"))).select("number", "n", "roman", text.from_roman(F.lower("roman")).cast("bigint").alias("back"))


def signal_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.counts(reg_lines(spark, sf_dir), "doc_id", "line").groupBy("sig_class", "pattern_id").agg(F.sum("n").alias("n_hits"), F.count(F.lit(1)).alias("n_docs"))


def signal_hits_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = signals.hit_rows(reg_lines(spark, sf_dir), "doc_id", "line", signals.obliging)
    return hits.groupBy("doc_id", F.col("h.matched_text").alias("verb")).agg(F.count(F.lit(1)).alias("n_hits"), F.sum("h.start").alias("sum_start"))


def modal_in_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modal hits by byte, dealt to the spans that hold them. The lines are made for the hits and for the spans from one shuffle by document, which serves all windows."""
    raw = reg_lines(spark, sf_dir)
    at = lines.with_offsets(raw)
    openings = segment.regulation_openings(raw, F.col("doc_id") + 100)  # kinds and bytes alone, no citations
    spans = openings.select("doc_id", F.format_string("S%04d", "seq").alias("span_id"), "kind", "byte_start", "byte_end")
    found = at.filter(F.col("line").rlike("shall|must|may")).select("doc_id", "byte_start", "line", F.explode(signals.positions(F.col("line"), r"\b(?:shall|must|may)\b")).alias("h"))
    hits = found.select("doc_id", (F.col("byte_start") + F.octet_length(F.substring("line", F.lit(1), F.col("h.start")))).alias("at"), F.col("h.matched_text").alias("verb"))
    held = audit.containing_span(hits, spans, "kind")
    return held.groupBy("verb", F.coalesce("kind", F.lit("(no span)")).alias("kind")).agg(F.count(F.lit(1)).alias("n_hits"), F.countDistinct("doc_id").alias("n_docs"))


def degenerate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = F.regexp_replace("html", "<[^>]*>", "                         ")
    return table(spark, sf_dir, "pages").select("page_id", flat.alias("t")).select("page_id", text.is_degenerate(F.col("t")).alias("degenerate"), F.length("t").cast("bigint").alias("n_chars"), F.length(F.regexp_replace("t", r"(?U)\S", "")).cast("bigint").alias("n_space"))


def html_to_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = F.split(F.regexp_replace("html", "<(p|br|h1|li|div|nav|article)[^>]*>", "\u0001"), "\u0001")
    each = table(spark, sf_dir, "pages").select("page_id", F.posexplode(blocks).alias("block", "raw"))
    clean = F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]*>", " "), r"\s+", " "))
    return each.select("page_id", big("block"), F.md5(text.escape_html(clean)).alias("digest"), F.length(clean).cast("bigint").alias("n_chars")).filter("n_chars > 0")


def slugify_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.slugify(F.col("url")).alias("slug"))


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    gid = text.global_id(F.col("source"), text.numbered("S", 4, F.col("doc_id")))
    doc, local = text.split_global(gid)
    return d.select("doc_id", gid.alias("global_id"), doc.alias("doc_part"), local.alias("local_part"), text.stable_hash(F.col("source"), F.col("lang"), F.col("text")).alias("content_key"))


QUERIES = {f.__name__: f for f in (doc_coverage_audit, line_byte_offsets, canonical_digest, boilerplate_rule_counts, regulation_furniture, title_furniture, repeated_line_furniture, margin_number_runs, generic_spans, regulation_line_roles, regulation_carry_forward, regulation_spans, regulation_coverage, paragraph_levels, decimal_parents, guideline_kinds, roman_round_trip, signal_class_counts, signal_hits_by_doc, modal_in_span, degenerate_docs, html_to_blocks, slugify_sources, stable_ids)}

ROMAN_SQL = "['','M','MM','MMM'][number // 1000 + 1] || ['','C','CC','CCC','CD','D','DC','DCC','DCCC','CM'][number // 100 % 10 + 1] || ['','X','XX','XXX','XL','L','LX','LXX','LXXX','XC'][number // 10 % 10 + 1] || ['','I','II','III','IV','V','VI','VII','VIII','IX'][number % 10 + 1]"
COVER = """per AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(byte_end - byte_start) AS BIGINT) AS covered_bytes, count(*) FILTER (byte_start > far) AS n_gaps, CAST(sum(greatest(byte_start - far, 0)) AS BIGINT) AS gap_bytes, count(*) FILTER (byte_start < far) AS n_overlaps, max(byte_end) AS last
  FROM (SELECT *, coalesce(max(byte_end) OVER (PARTITION BY doc_id ORDER BY byte_start, byte_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS far FROM spans) GROUP BY doc_id)
SELECT doc_id, total_bytes, coalesce(n_spans, 0) AS n_spans, coalesce(covered_bytes, 0) AS covered_bytes, coalesce(n_gaps, 0) + CASE WHEN total_bytes > coalesce(last, 0) THEN 1 ELSE 0 END AS n_gaps,
  coalesce(gap_bytes, 0) + greatest(total_bytes - coalesce(last, 0), 0) AS gap_bytes, coalesce(n_overlaps, 0) AS n_overlaps, round(coalesce(covered_bytes, 0) / total_bytes * 100, 6) AS coverage_pct,
  coalesce(n_gaps, 0) = 0 AND total_bytes <= coalesce(last, 0) AND coalesce(n_overlaps, 0) = 0 AS passed FROM sizes LEFT JOIN per USING (doc_id)"""
SPANS = """starts AS (SELECT doc_id, line_no, byte_start, line, total, CASE WHEN line LIKE 'PART %' THEN 'part_header' WHEN line LIKE '(%' THEN 'paragraph' WHEN line_no < part_line THEN 'toc_entry' ELSE 'section_header' END AS kind
  FROM (SELECT *, min(CASE WHEN line LIKE 'PART %' THEN line_no END) OVER (PARTITION BY doc_id) AS part_line, max(byte_end) OVER (PARTITION BY doc_id) AS total FROM off) WHERE line <> '' AND line NOT LIKE 'page %'),
spans AS (SELECT *, row_number() OVER w AS seq, coalesce(lead(byte_start) OVER w, total) AS byte_end FROM starts WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))"""
ROLES = f"WITH {REG_SQL}, {offsets_sql('reg')}, {SPANS}"
COLLAPSED = """trimmed AS (SELECT doc_id, line_no, trim(line) AS line FROM {0}),
kept AS (SELECT * FROM (SELECT *, lag(line, 1, '') OVER (PARTITION BY doc_id ORDER BY line_no) AS prior, max(CASE WHEN line <> '' THEN line_no END) OVER (PARTITION BY doc_id) AS final FROM trimmed) WHERE (line <> '' OR prior <> '') AND line_no <= final),
joined AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) || chr(10) AS text FROM kept GROUP BY doc_id)"""

SQL = {
    "doc_coverage_audit": f"WITH {LINES_SQL}, {offsets_sql('docl')}, spans AS (SELECT * FROM off), sizes AS (SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE strlen(text) + CASE WHEN text[-1] = chr(10) THEN 0 ELSE 1 END END AS total_bytes FROM documents), {COVER}",
    "line_byte_offsets": f"WITH {LINES_SQL}, {offsets_sql('docl')} SELECT doc_id, line_no, byte_start, byte_end FROM off",
    "canonical_digest": f"WITH {SPACED_SQL}, {COLLAPSED.format('docl')} SELECT doc_id, sha256(text) AS sha256, strlen(text) AS byte_count FROM joined",
    "boilerplate_rule_counts": f"""WITH {LINES_SQL}, tagged AS (SELECT doc_id, CASE WHEN regexp_matches(line, 'licensed under|Released under the|All rights reserved') THEN 'LICENSE_LINE' WHEN line LIKE 'Licensed under%' THEN 'LICENSED_LINE'
      WHEN regexp_matches(line, '[a-z0-9.]+@[a-z0-9.]+') THEN 'EMAIL_LINE' WHEN regexp_matches(line, '(token|password) ?=') THEN 'TOKEN_LINE' END AS rule_id FROM (SELECT doc_id, trim(line) AS line FROM docl))
      SELECT rule_id, count(*) AS n_lines, count(DISTINCT doc_id) AS n_docs FROM tagged WHERE rule_id IS NOT NULL GROUP BY rule_id""",
    "regulation_furniture": f"""WITH {REG_SQL}, content AS (SELECT * FROM reg WHERE line NOT LIKE 'page %'), {COLLAPSED.format('content')},
      gone AS (SELECT doc_id, count(*) FILTER (line LIKE 'page %') AS n_page_footers FROM reg GROUP BY doc_id)
      SELECT doc_id, sha256(text) AS sha256, strlen(text) AS byte_count, n_page_footers FROM joined JOIN gone USING (doc_id)""",
    "title_furniture": f"WITH {LINES_SQL} SELECT a.doc_id, count(*) AS n_title_lines FROM docl a JOIN docl b ON a.doc_id = b.doc_id AND b.line_no = 0 AND rtrim(a.line) = rtrim(b.line) GROUP BY a.doc_id",
    "repeated_line_furniture": f"WITH {LINES_SQL} SELECT line, count(DISTINCT doc_id) AS n_docs, count(*) AS n_lines FROM docl GROUP BY line HAVING count(DISTINCT doc_id) >= 3",
    "margin_number_runs": f"""WITH {REG_SQL}, n AS (SELECT doc_id, line_no, line AS content, CASE WHEN line_no % 7 <> 3 THEN (line_no % 9000 + 1) || '   ' || line ELSE line END AS line FROM reg),
      c AS (SELECT *, line_no % 9000 + 1 AS number FROM n WHERE line_no % 7 <> 3 AND content <> ''),
      r AS (SELECT *, coalesce(line_no - lag(line_no) OVER w BETWEEN 1 AND 3 AND number - lag(number) OVER w BETWEEN 1 AND 3, false) OR coalesce(lead(line_no) OVER w - line_no BETWEEN 1 AND 3 AND lead(number) OVER w - number BETWEEN 1 AND 3, false) AS run FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
      s AS (SELECT * FROM (SELECT doc_id, line_no, count(*) OVER (PARTITION BY doc_id) AS many FROM r WHERE run) WHERE many >= 3)
      SELECT n.doc_id, count(s.line_no) AS n_stripped, CAST(sum(length(CASE WHEN s.line_no IS NOT NULL THEN content ELSE line END)) AS BIGINT) AS n_chars FROM n LEFT JOIN s ON s.doc_id = n.doc_id AND s.line_no = n.line_no GROUP BY n.doc_id""",
    "generic_spans": f"""WITH {SPACED_SQL}, {offsets_sql('docl')}, first AS (SELECT * FROM (SELECT *, lag(trim(line), 1, '') OVER (PARTITION BY doc_id ORDER BY line_no) AS prior, max(byte_end) OVER (PARTITION BY doc_id) AS total FROM off) WHERE trim(line) <> '' AND prior = ''),
      k AS (SELECT *, trim(line) AS t, regexp_matches(trim(line), '\\.{{3,}}\\s*\\d+\\s*$') AS toc FROM first),
      h AS (SELECT *, NOT toc AND length(t) <= 80 AND (regexp_matches(t, '\\p{{L}}') AND NOT regexp_matches(t, '[\\p{{Ll}}\\p{{Lt}}\\p{{Lm}}\\p{{Lo}}]') OR regexp_matches(t, '^(?:[IVXLC]+\\.|[A-Z]\\.|\\d+(?:\\.\\d+)*\\.?)\\s+\\S')) AS header FROM k),
      s AS (SELECT *, row_number() OVER w AS seq, coalesce(max(header) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS seen, coalesce(lead(byte_start) OVER w, total) AS next FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
      SELECT doc_id, 'S' || CASE WHEN seq < 10000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END AS span_id, CASE WHEN seq = 1 THEN 'document_title' WHEN toc THEN 'toc_entry' WHEN header THEN 'section_header' WHEN seen THEN 'paragraph' ELSE 'document_title' END AS kind,
        t[1:60] AS citation, CASE WHEN seq = 1 THEN 0 ELSE byte_start END AS byte_start, next AS byte_end FROM s""",
    "regulation_line_roles": f"""WITH {REG_SQL}, p AS (SELECT *, min(CASE WHEN line LIKE 'PART %' THEN line_no END) OVER (PARTITION BY doc_id) AS part_line FROM reg)
      SELECT doc_id, CASE WHEN line = '' THEN 'blank' WHEN line LIKE 'PART %' THEN 'part_header' WHEN line LIKE '(%' THEN 'marker' WHEN line LIKE 'page %' THEN 'prose' WHEN line_no < part_line THEN 'toc_entry' ELSE 'section_header' END AS role, count(*) AS n_lines FROM p GROUP BY 1, 2""",
    "regulation_carry_forward": f"""{ROLES}, c AS (SELECT *, last_value(CASE WHEN kind = 'section_header' THEN regexp_extract(line, '^§ (\\d+\\.\\d+)', 1) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS section FROM starts)
      SELECT doc_id, section, count(*) AS n_paragraphs, min(byte_start) AS first_byte FROM c WHERE kind = 'paragraph' GROUP BY doc_id, section""",
    "regulation_coverage": f"{ROLES}, sizes AS (SELECT doc_id, max(byte_end) AS total_bytes FROM off GROUP BY doc_id), {COVER}",
    "decimal_parents": """WITH n AS (SELECT l_suppkey AS doc_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS seq, l_linenumber || '.' || l_orderkey % 20 AS two, CASE WHEN l_partkey % 3 = 0 THEN l_linenumber || '.' || l_orderkey % 20 ELSE l_linenumber || '.' || l_orderkey % 20 || '.' || (l_partkey % 3 + 1) END AS section FROM lineitem)
      SELECT doc_id, seq, section, CASE WHEN section <> two THEN last_value(CASE WHEN section = two THEN seq END IGNORE NULLS) OVER (PARTITION BY doc_id, two ORDER BY seq) END AS parent_seq FROM n""",
    "roman_round_trip": f"SELECT number, n, {ROMAN_SQL} AS roman, number AS back FROM (SELECT o_orderkey % 3999 + 1 AS number, count(*) AS n FROM orders GROUP BY 1)",
    "signal_class_counts": f"""WITH {REG_SQL}, h AS (SELECT doc_id, unnest(regexp_extract_all(line, '\\b(?:shall|must|may)\\b')) AS verb FROM reg)
      SELECT CASE WHEN verb = 'may' THEN 'modal_permissive' ELSE 'modal_obligation' END AS sig_class, verb AS pattern_id, CAST(count(*) AS BIGINT) AS n_hits, count(DISTINCT doc_id) AS n_docs FROM h GROUP BY 1, 2""",
    "signal_hits_by_doc": f"WITH {REG_SQL} SELECT doc_id, regexp_extract(line, '\\b(shall|must|may)\\b', 1) AS verb, count(*) AS n_hits, CAST(sum(strpos(line, 'supplier ') + 8) AS BIGINT) AS sum_start FROM reg WHERE line LIKE '(%' GROUP BY 1, 2",
    "modal_in_span": f"WITH {REG_SQL} SELECT regexp_extract(line, '\\b(shall|must|may)\\b', 1) AS verb, 'paragraph' AS kind, count(*) AS n_hits, count(DISTINCT doc_id) AS n_docs FROM reg WHERE line LIKE '(%' GROUP BY 1",
    "degenerate_docs": """WITH t AS (SELECT page_id, regexp_replace(html, '<[^>]*>', repeat(' ', 25), 'g') AS t FROM pages), c AS (SELECT page_id, t, length(t) AS n_chars, length(regexp_replace(t, '[^\\s\\p{Z}\\x{85}]', '', 'g')) AS n_space FROM t)
      SELECT page_id, n_chars >= 400 AND n_space / n_chars >= 0.6 AND contains(t, repeat(' ', 20)) AS degenerate, n_chars, n_space FROM c""",
    "html_to_blocks": """WITH b AS (SELECT page_id, string_split(regexp_replace(html, '<(p|br|h1|li|div|nav|article)[^>]*>', chr(1), 'g'), chr(1)) AS a FROM pages),
      e AS (SELECT page_id, unnest(generate_series(0, len(a) - 1)) AS block, unnest(a) AS raw FROM b), c AS (SELECT page_id, block, trim(regexp_replace(regexp_replace(raw, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM e)
      SELECT page_id, block, md5(replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS digest, length(t) AS n_chars FROM c WHERE length(t) > 0""",
    "slugify_sources": "SELECT page_id, trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM pages",
    "stable_ids": "SELECT doc_id, source || ':S' || CASE WHEN doc_id < 10000 THEN lpad(CAST(doc_id AS VARCHAR), 4, '0') ELSE CAST(doc_id AS VARCHAR) END AS global_id, source AS doc_part, 'S' || CASE WHEN doc_id < 10000 THEN lpad(CAST(doc_id AS VARCHAR), 4, '0') ELSE CAST(doc_id AS VARCHAR) END AS local_part, sha256(source || chr(31) || lang || chr(31) || text)[1:16] AS content_key FROM documents",
}
SQL["regulation_spans"] = f"""{ROLES}, c AS (SELECT *, last_value(CASE WHEN kind = 'section_header' THEN regexp_extract(line, '^§ (\\d+\\.\\d+)', 1) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS body_section FROM spans)
  SELECT doc_id, 'S' || CASE WHEN seq < 10000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END AS span_id, kind, CASE WHEN kind IN ('toc_entry', 'section_header') THEN regexp_extract(line, '^§ (\\d+\\.\\d+)', 1) WHEN kind = 'paragraph' THEN body_section END AS section,
    CASE WHEN kind = 'paragraph' THEN line[2:2] ELSE '' END AS path, CASE WHEN kind = 'part_header' THEN line ELSE '§ ' || CASE WHEN kind = 'paragraph' THEN body_section || '(' || line[2:2] || ')' ELSE regexp_extract(line, '^§ (\\d+\\.\\d+)', 1) END END AS citation, byte_start, byte_end FROM c"""
