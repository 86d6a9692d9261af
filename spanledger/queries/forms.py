"""Queries over lines of every form: signals, furniture, citations, markers, guidelines and whole regulation prints.

Each line is a template that an order or line item picks by its key. The SQL does not look at patterns: it names per
template what has to be found there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.functions import rules, signals, text
from spanledger.operators import lines, refs, segment
from spanledger.plans.regtext import offsets_sql, table

from .texts import ROMAN_SQL, big


def filled(template: Column, **names: Column) -> Column:
    """template with each {name} replaced."""
    for name, value in names.items():
        template = F.replace(template, F.lit("{%s}" % name), value.cast("string"))
    return template


def filled_sql(template: str, **names: str) -> str:
    for name, value in names.items():
        template = f"replace({template}, '{{{name}}}', CAST({value} AS VARCHAR))"
    return template


def picked(templates: tuple, pick: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, templates)), (pick % len(templates) + 1).cast("int"))


def values_sql(rows) -> str:
    told = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'%s'" % v.replace("'", "''")
    return "VALUES " + ", ".join("(%s)" % ", ".join(map(told, r)) for r in rows)


#: Sentences with signals, and what stands in them: pattern, class, where it is found, how long it is.
SENTENCES = (
    ("Use of part {p} is limited.", ("use_of", "nominal_imperative", "Use of ", 7)),
    ("(a) Determination of part {p}, as listed.", ("determination", "nominal_imperative", "(a) Determination ", 18)),
    ("The establishment of part {p} includes others.", ("establishment", "nominal_imperative", "The establishment ", 18), ("includes", "inclusion_clause", "includes", 8)),
    ("(2) Implementation of part {p} does not apply.", ("implementation", "nominal_imperative", "(2) Implementation ", 19), ("does_not_apply", "exclusion_clause", "does not apply", 14)),
    ("Maintenance of part {p} is not subject to order {o}.", ("maintenance", "nominal_imperative", "Maintenance ", 12), ("not_subject_to", "exclusion_clause", "is not subject to", 17)),
    ("(iv) Validation of part {p} shall include order {o}.", ("validation", "nominal_imperative", "(iv) Validation ", 16), ("shall", "modal_obligation", "shall", 5), ("shall_include", "inclusion_clause", "shall include", 13), ("includes", "inclusion_clause", "include", 7)),
    ("Protection of part {p} may also be applied to order {o}.", ("protection", "nominal_imperative", "Protection ", 11), ("may", "modal_permissive", "may", 3), ("may_also_apply", "inclusion_clause", "may also be applied to", 22)),
    ("Limiting part {p} is intended to help.", ("limiting", "nominal_imperative", "Limiting ", 9), ("is_intended_to", "inclusion_clause", "is intended to", 14)),
    ("Ensuring part {p}, for the purposes of order {o}, must stand.", ("ensuring", "nominal_imperative", "Ensuring ", 9), ("for_purposes_of", "inclusion_clause", "for the purposes of", 19), ("must", "modal_obligation", "must", 4)),
    ("Maintaining part {p} is not applicable here.", ("maintaining", "nominal_imperative", "Maintaining ", 12), ("not_applicable", "exclusion_clause", "not applicable", 14)),
    ("Following order {o}, parts remain subject to {p}.", ("following_procs", "nominal_imperative", "Following ", 10), ("remain_subject_to", "re_inclusion", "remain subject to", 17)),
    ("Part {p} was due on may 12, 2019 and on May 3, 2020.",),
    ("Part {p} should ship. may be late", ("should", "modal_permissive", "should", 6)),
    ("It MUST hold that part {p} SHALL ship.", ("must", "modal_obligation", "MUST", 4), ("shall", "modal_obligation", "SHALL", 5)),
    ("No validation of part {p} is due.",),
    ("Part {p} may ship on Jan. 5, 2020 and may not wait.", ("may", "modal_permissive", "may ship", 3), ("may", "modal_permissive", "may not", 3)),
    ("Part {p} is not applicable and does not apply.", ("not_applicable", "exclusion_clause", "not applicable", 14), ("does_not_apply", "exclusion_clause", "does not apply", 14)),
    ("Parts of order {o} remain subject to {p}.", ("remain_subject_to", "re_inclusion", "remain subject to", 17)),
)


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    line = filled(picked(tuple(t for t, *_ in SENTENCES), F.col("l_orderkey") + F.col("l_partkey")), p=F.col("l_partkey"), o=F.col("l_orderkey"))
    return li.select(F.col("l_suppkey").alias("doc_id"), line.alias("line"))


def signal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of all patterns with their offsets, per supplier."""
    hits = signals.hit_rows(sentences(spark, sf_dir), "doc_id", "line")
    return hits.groupBy("doc_id", "h.sig_class", "h.pattern_id").agg(F.count(F.lit(1)).alias("n_hits"), F.sum("h.start").cast("bigint").alias("sum_start"), F.sum("h.end").cast("bigint").alias("sum_end"), F.sum(F.length("h.matched_text")).cast("bigint").alias("n_chars"))


def signal_form_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.counts(sentences(spark, sf_dir), "doc_id", "line")


def obligation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with and without an obligation per supplier; exclusions and re-inclusions are none."""
    return sentences(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(signals.has_obligation(F.col("line"))).alias("n_obliging"))


#: Lines and the furniture rule that each falls to.
FURNITURE = (
    ("21 CFR Part {p} (up to date as of 1/02/2024)", "PAGE_HEADER_PART_DATE"), ("21 CFR Part {p} (Jan. 2, 2024)", "PAGE_HEADER_PART_PUBDATE"), ("21 CFR {p}.1(a)(2) (enhanced display)   page {p} of 9", "PAGE_FOOTER_COMBINED"), ("21 CFR {p}.10 (enhanced display)", "PAGE_FOOTER_CITATION"),
    ("page {p} of 99  ", "PAGE_FOOTER_PAGE"), ("  21 CFR {p}.3(b)(1)", "PAGE_FOOTER_CITATION_BARE"), ("This content is from the eCFR and is authoritative but unofficial.", "ECFR_DISCLAIMER"), ("© EMEA 2006 {p}", "PAGE_FOOTER_EMEA"), ("{p} ICH E6(R2) Guideline", "PAGE_HEADER_ICH_GUIDELINE"), ("ICH harmonised guideline", "PAGE_HEADER_ICH_HARMONISED"),
    ("21 CFR Part {p} (up to date)", None), ("see 21 CFR {p}.3", None), ("page {p}", None), ("21 CFR {p}.3 applies", None), ("the ICH E6 Guideline", None), ("This content is from the eCFR.", None), ("", None),
)


def furniture_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    line = filled(picked(tuple(t for t, _ in FURNITURE), F.col("o_orderkey")), p=F.col("o_orderkey"))
    tagged = lines.tag_furniture(o.select(F.col("o_custkey").alias("doc_id"), line.alias("line")), rules.REGULATION_FURNITURE + rules.GUIDELINE_FURNITURE)
    return tagged.groupBy("doc_id", "rule_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).cast("bigint").alias("n_chars"))


#: Texts with citations, and each as pass, place, part, section, paragraphs, wording.
CITED = (
    ("see § {p}.{o}(a)(2)(iv) now", (1, 0, "{p}", "{p}.{o}", "a/2/iv", "§ {p}.{o}(a)(2)(iv)")),
    ("see §§ {p}.{o} through {p}.{q} there", (1, 0, "{p}", "{p}.{o}", "", "§§ {p}.{o}"), (2, 0, "{p}", "{p}.{o}", "", "§§ {p}.{o} through {p}.{q}")),
    ("under part {p} and PART {q} of it", (3, 0, "{p}", None, "", "part {p}"), (3, 1, "{q}", None, "", "PART {q}")),
    ("per 21 CFR {p}.{o} alone", (4, 0, "{p}", "{p}.{o}", "", "21 CFR {p}.{o}")),
    ("part of {p}, 45 CFR {o}.1, parts {q}",),
    ("§ {p}.{o} and §{q}.{o}(b) of Part {p}, 21  CFR {q}.{p}(a)", (1, 0, "{p}", "{p}.{o}", "", "§ {p}.{o}"), (1, 1, "{q}", "{q}.{o}", "b", "§{q}.{o}(b)"), (3, 0, "{p}", None, "", "Part {p}"), (4, 0, "{q}", "{q}.{p}", "", "21  CFR {q}.{p}")),
)


def cited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    line = filled(picked(tuple(t for t, *_ in CITED), o), p=o % 40 + 100, q=o % 7 + 300, o=o % 25)
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 60 + 100).alias("doc_id"), F.concat(F.lit("S"), o).alias("span_id"), line.alias("text"))


def citation_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = refs.citations(cited_texts(spark, sf_dir))
    return c.select("doc_id", "span_id", big("pass"), big("pos"), "part", "section", F.array_join("paras", "/").alias("paras"), "citation")


def citation_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of four forms led to the sections of parts 100 to 129: the deepest paragraph that is there, the header, the document, or nothing; those of the own part are skipped."""
    section = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 40 + 100).alias("doc_id"), (F.col("o_orderkey") % 25).alias("n")).distinct().filter("doc_id < 130 AND n <> 3")
    none, one, two = F.array().cast("array<string>"), F.array(F.lit("a")), F.array(F.lit("a"), F.lit("2"))
    paths = F.array_compact(F.array(none, F.when(F.col("n") % 2 == 0, one), F.when(F.col("n") % 4 == 0, two)))
    at = section.select("doc_id", "n", F.posexplode(paths).alias("depth", "path"))
    spans = at.select("doc_id", (F.col("n") * 10 + F.col("depth")).alias("seq"), F.concat_ws("-", F.lit("T"), "n", "depth").alias("span_id"), F.when(F.col("depth") == 0, "section_header").otherwise("paragraph").alias("kind"), F.concat_ws(".", "doc_id", "n").alias("section"), "path")
    docs = section.select(F.col("doc_id").cast("string").alias("part"), "doc_id").distinct()
    out = refs.cross_refs(refs.citations(cited_texts(spark, sf_dir)), spans, docs)
    return out.select("source_doc", "source_span", "target_doc", "target_span", "ref_type", "part", "citation", "auto_resolved")


#: Markers of all levels; one of them is no numeral, some are letters as well as numerals.
MARKERS = ("a", "1", "i", "ii", "b", "1", "2", "i", "A", "ii", "iii", "B", "iiii", "iv", "v", "c", "i", "3", "d", "h", "i")


def paragraph_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers of a customer's orders as the paragraphs of one section; orders move on by one or three in the list."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.lit(0).alias("section_line"), F.row_number().over(lines.by_doc("o_orderkey", doc="o_custkey")).alias("line_no"), F.col("o_orderkey"))
    marked = o.withColumn("marker", picked(MARKERS, F.col("line_no") * (1 + F.col("doc_id") % 3 * 2) + F.col("o_orderkey") % 2))
    out = segment.paragraph_paths(marked.drop("o_orderkey"))
    return out.select("doc_id", big("line_no"), big("level"), F.array_join("path", "/").alias("path"), big("parent_line"))


def guideline_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guideline spans with parents: roman and named parts, decimals of two and three numbers, contents, furniture, prose."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey DIV 25 AS doc_id", "o_orderkey AS k", "o_orderpriority AS p")
    k = F.col("k")
    two = F.concat_ws(".", k % 3 + 1, k % 4 + 1)
    line = F.when(k % 11 == 0, F.concat(text.roman(k % 20 + 1), F.lit(". PRIORITY "), F.upper("p"))).when(k % 29 == 0, "GLOSSARY").when(k % 17 == 0, "12 ICH E6 Guideline").when(k % 7 == 0, F.concat(F.lit("1.1 Orders ..... "), k % 90)).when(k % 5 == 0, F.concat(two, F.lit(" Order "), k)).when(k % 5 == 1, F.concat(two, F.lit("."), k % 2 + 1, F.lit(" Order "), k)).when(k % 5 == 2, "").otherwise(F.concat(F.lit("Order "), k, F.lit(" is due.")))
    at = o.select("doc_id", (F.row_number().over(lines.by_doc("k")) - 1).alias("line_no"), line.alias("line"))
    return segment.guideline_spans(at).select("doc_id", "span_id", "kind", "section", "byte_start", "byte_end", "parent_span_id")


# Lines of a regulation print: zone, rank, divisor and rest of the key that has it, text; then kind, path, zone and rank of the parent, raw citation.
# c is the document, p its part, q another part, o the order. Zones 30 and 50 are subparts A and B.
FRAME = (
    (0, 0, 1, 0, "Title 21—Food", "document_title", "", None, "Title 21—Food"), (0, 1, 1, 0, "Chapter I—Agency", "document_title", "", None, "Chapter I—Agency"), (0, 2, 2, 0, "Subchapter A—General", "document_title", "", None, "Subchapter A—General"),
    (0, 3, 1, 0, "Part {p} Records of {c}", "document_title", "", None, "Part {p} Records of {c}"), (0, 4, 1, 0, "Subpart A General", "toc_entry", "", None, "Subpart A General"), (10, 9, 1, 0, "PART {p}—RECORDS", "part_header", "", None, "PART {p}"),
    (12, 0, 1, 0, "Authority: 21 U.S.C. {c}.", "authority", "", None, "Authority"), (12, 1, 3, 0, "Source: 62 FR {c}, Mar. 20, 1997.", "source_note", "", None, "Source"), (30, 0, 1, 0, "Subpart A—General", "subpart_header", "", None, "Subpart A"), (50, 0, 1, 0, "Subpart B—Others", "subpart_header", "", None, "Subpart B"),
)
BODY = (
    (0, 1, 0, "§ {p}.{o} Order {o}.", "section_header", "", -1, "§ {p}.{o}"), (1, 1, 0, "Each order counts.", "section_chapeau", "", 0, "§ {p}.{o} chapeau"), (2, 1, 0, "and goes on.", None, None, None, None), (3, 7, 0, "[61 FR {o}, Jan. 2, 1996]", "source_note", "", 0, "amendment_note"),
    (4, 7, 0, "Lead again.", "section_chapeau", "", 0, "§ {p}.{o} chapeau"), (10, 1, 0, "(a) Lead of {o}.", "paragraph", "a", 0, "§ {p}.{o}(a)"), (11, 1, 0, "(1) First.", "paragraph", "a/1", 10, "§ {p}.{o}(a)(1)"), (12, 1, 0, "(i) Roman.", "paragraph", "a/1/i", 11, "§ {p}.{o}(a)(1)(i)"),
    (13, 1, 0, "(ii) Roman.", "paragraph", "a/1/ii", 11, "§ {p}.{o}(a)(1)(ii)"), (14, 2, 0, "(A) Upper.", "paragraph", "a/1/ii/A", 13, "§ {p}.{o}(a)(1)(ii)(A)"), (15, 1, 0, "(b) Next.", "paragraph", "b", 0, "§ {p}.{o}(b)"), (16, 3, 0, "[62 FR {o}, Mar. 21,", "source_note", "", 0, "amendment_note"),
    (17, 3, 0, "1998, as amended]", None, None, None, None), (18, 3, 1, "[62 FR {o}, Mar. 21, 1998]", "source_note", "", 0, "amendment_note"), (19, 5, 0, "§ {q}.{o} Foreign section.", None, None, None, None), (20, 4, 0, "21 CFR {p}.{o} (enhanced display)", None, None, None, None), (21, 1, 0, "", None, None, None, None),
)


def print_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, line of a regulation print per customer: titles, contents, a part with two subparts, a section per order; even documents repeat their contents in the body."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("o"))
    head = (1, 0, BODY[0][3])
    rows = (*(t[:5] for t in FRAME), (10, 0, *head), (20, 0, *head), *((None, *t[:4]) for t in BODY))
    # lines are dealt and sorted as the numbers of their templates, and get their words once they are in order
    of = lambda k: F.element_at(F.array(*(F.lit(r[k]) for r in rows)), F.col("i") + 1)
    numbers = lambda *span: F.explode(F.array(*map(F.lit, range(*span)))).alias("i")
    frame = o.select("doc_id").distinct().select("doc_id", F.lit(-1).cast("bigint").alias("o"), F.col("doc_id").alias("key"), numbers(len(FRAME)))
    sections = o.select("doc_id", "o", F.col("o").alias("key"), numbers(len(FRAME), len(rows)))
    mine = frame.unionByName(sections).withColumn("zone", F.coalesce(of(0), F.when(F.col("o") % 2 == 0, 30).otherwise(50)))
    mine = mine.filter((F.col("key") % of(2) == of(3)) & ((F.col("zone") != 20) | (F.col("doc_id") % 2 == 0))).withColumn("rank", of(1))
    # a part header closes zone 10, behind all of its orders
    w = lines.by_doc("zone", F.when(F.col("rank") == 9, 2**62).otherwise(F.col("o")), "rank")
    p, q = F.col("doc_id") + 100, F.col("doc_id") + 9000
    numbered = mine.select("doc_id", "o", "i", (F.row_number().over(w) - 1).alias("line_no"))
    return numbered.select("doc_id", "line_no", filled(of(4), p=p, q=q, c=F.col("doc_id"), o=F.col("o")).alias("line"))


def regulation_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segment.regulation_spans(print_lines(spark, sf_dir), F.col("doc_id") + 100)
    return out.select("doc_id", "span_id", "kind", "section", "subpart", F.array_join("path", "/").alias("path"), F.col("cite.raw").alias("raw"), "byte_start", "byte_end", "parent_span_id")


QUERIES = {f.__name__: f for f in (signal_forms, signal_form_counts, obligation_lines, furniture_forms, citation_forms, citation_targets, paragraph_tree, guideline_parts, regulation_prints)}

SAID_SQL = f"""tmpl(k, line) AS ({values_sql((k, t) for k, (t, *_) in enumerate(SENTENCES))}), found(k, pattern_id, sig_class, needle, size) AS ({values_sql((k, *h) for k, (_, *hits) in enumerate(SENTENCES) for h in hits)}),
  said AS (SELECT l_suppkey AS doc_id, k, {filled_sql("line", p="l_partkey", o="l_orderkey")} AS line FROM lineitem JOIN tmpl ON k = (l_orderkey + l_partkey) % {len(SENTENCES)})"""
CITED_SQL = f"""ords AS (SELECT o_custkey % 60 + 100 AS doc_id, o_orderkey, o_orderkey % 40 + 100 AS p, o_orderkey % 7 + 300 AS q, o_orderkey % 25 AS o FROM orders),
  tmpl(k, pass, pos, part, section, paras, citation) AS ({values_sql((k, *c) for k, (_, *cs) in enumerate(CITED) for c in cs)}),
  cites AS (SELECT doc_id, 'S' || o_orderkey AS span_id, CAST(pass AS BIGINT) AS pass, CAST(pos AS BIGINT) AS pos, {", ".join(filled_sql(f"tmpl.{x}", p="ords.p", q="ords.q", o="ords.o") + " AS " + x for x in ("part", "section"))}, paras, {filled_sql("citation", p="ords.p", q="ords.q", o="ords.o")} AS citation FROM ords JOIN tmpl ON k = o_orderkey % {len(CITED)})"""
NUMBERED = "'S' || CASE WHEN {0} < 10000 THEN lpad(CAST({0} AS VARCHAR), 4, '0') ELSE CAST({0} AS VARCHAR) END"
MARKED_SQL = "list_value({})[CAST(({}) % {} AS INTEGER) + 1]".format(", ".join(f"'{m}'" for m in MARKERS), "line_no * (1 + doc_id % 3 * 2) + o_orderkey % 2", len(MARKERS))
#: walk: the markers of m (doc_id, section_line, line_no from 1, marker) one after the other.
WALK_SQL = """told AS (SELECT *, CASE WHEN regexp_full_match(marker, '\\d+') THEN 2 WHEN regexp_full_match(marker, '[A-Z]') THEN 4 WHEN regexp_full_match(marker, '[ivxlcdm]{2,}') THEN 3 WHEN regexp_full_match(marker, '[ivxlcdm]') THEN 0 ELSE 1 END AS plain,
    coalesce(map {'i': 1, 'ii': 2, 'iii': 3, 'iv': 4, 'v': 5, 'vi': 6, 'vii': 7, 'c': 100, 'd': 500}[marker], 0) AS value FROM m),
  walk AS (SELECT doc_id, section_line, CAST(0 AS BIGINT) AS line_no, CAST(0 AS INTEGER) AS level, CAST([NULL, NULL, NULL, NULL] AS VARCHAR[]) AS names, CAST([NULL, NULL, NULL, NULL] AS BIGINT[]) AS lines, CAST(0 AS INTEGER) AS roman FROM (SELECT DISTINCT doc_id, section_line FROM m)
    UNION ALL SELECT doc_id, section_line, line_no, lv, [CASE WHEN i < lv THEN names[i] WHEN i = lv THEN marker END FOR i IN [1, 2, 3, 4]], [CASE WHEN i < lv THEN lines[i] WHEN i = lv THEN line_no END FOR i IN [1, 2, 3, 4]], CAST(CASE WHEN lv <= 2 THEN 0 WHEN lv = 3 AND value > 0 THEN value ELSE roman END AS INTEGER)
    FROM (SELECT t.*, w.names, w.lines, w.roman, CAST(CASE WHEN plain > 0 THEN plain WHEN w.lines[2] IS NOT NULL AND (CASE WHEN w.roman > 0 THEN value = w.roman + 1 ELSE w.level = 2 AND marker = 'i' END) THEN 3 ELSE 1 END AS INTEGER) AS lv FROM walk w JOIN told t ON t.doc_id = w.doc_id AND t.section_line = w.section_line AND t.line_no = w.line_no + 1))"""
GUIDE_SQL = "(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM off WHERE line <> '' AND line NOT LIKE '%ICH E6%')"

SQL = {
    "signal_forms": f"WITH {SAID_SQL} SELECT doc_id, sig_class, pattern_id, count(*) AS n_hits, CAST(sum(strpos(line, needle) - 1) AS BIGINT) AS sum_start, CAST(sum(strpos(line, needle) - 1 + size) AS BIGINT) AS sum_end, CAST(sum(size) AS BIGINT) AS n_chars FROM said JOIN found USING (k) GROUP BY ALL",
    "signal_form_counts": f"WITH {SAID_SQL} SELECT doc_id, sig_class, pattern_id, count(*) AS n FROM said JOIN found USING (k) GROUP BY ALL",
    "obligation_lines": f"WITH {SAID_SQL} SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM found WHERE sig_class NOT IN ('exclusion_clause', 're_inclusion'))) AS n_obliging FROM said GROUP BY doc_id",
    "furniture_forms": f"""WITH tmpl(k, line, rule_id) AS ({values_sql((k, *t) for k, t in enumerate(FURNITURE))}) SELECT o_custkey AS doc_id, rule_id, count(*) AS n_lines, CAST(sum(length(trim({filled_sql("line", p="o_orderkey")}))) AS BIGINT) AS n_chars FROM orders JOIN tmpl ON k = o_orderkey % {len(FURNITURE)} GROUP BY ALL""",
    "citation_forms": f"WITH {CITED_SQL} SELECT * FROM cites",
    "citation_targets": f"""WITH {CITED_SQL}, secs AS (SELECT DISTINCT p, o FROM ords WHERE p < 130 AND o <> 3), docs AS (SELECT DISTINCT p FROM secs),
      t AS (SELECT c.*, d.p AS doc, CASE WHEN s.p IS NOT NULL THEN 'T-' || s.o || '-' || CASE WHEN paras LIKE 'a/2%' AND s.o % 4 = 0 THEN 2 WHEN paras LIKE 'a%' AND s.o % 2 = 0 THEN 1 ELSE 0 END END AS span
        FROM cites c LEFT JOIN docs d ON CAST(d.p AS VARCHAR) = part LEFT JOIN secs s ON s.p || '.' || s.o = section WHERE NOT (doc_id IN (SELECT p FROM docs) AND part = CAST(doc_id AS VARCHAR))),
      r AS (SELECT *, CASE WHEN pass IN (1, 4) THEN span IS NOT NULL ELSE doc IS NOT NULL END AS done FROM t),
      k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, span_id, doc, CASE WHEN pass IN (1, 4) THEN span END, pass IN (1, 4), done ORDER BY pass, pos) AS rn FROM r)
      SELECT doc_id AS source_doc, span_id AS source_span, CASE WHEN done THEN doc END AS target_doc, CASE WHEN pass IN (1, 4) THEN span END AS target_span, CASE WHEN pass IN (1, 4) THEN 'section' ELSE 'part' END AS ref_type, part, citation, done AS auto_resolved FROM k WHERE CASE WHEN done THEN rn = 1 ELSE pass IN (1, 3) END""",
    "paragraph_tree": f"""WITH RECURSIVE m AS (SELECT *, {MARKED_SQL} AS marker FROM (SELECT o_custkey AS doc_id, 0 AS section_line, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line_no, o_orderkey FROM orders)), {WALK_SQL}
      SELECT doc_id, line_no, CAST(level AS BIGINT) AS level, array_to_string(names, '/') AS path, CASE WHEN level > 1 THEN coalesce(CASE WHEN level > 3 THEN lines[3] END, CASE WHEN level > 2 THEN lines[2] END, lines[1]) END AS parent_line FROM walk WHERE line_no > 0""",
    "paragraph_levels": f"""WITH RECURSIVE m AS (SELECT l_suppkey AS doc_id, l_orderkey AS section_line, row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS line_no,
        CASE WHEN l_quantity % 3 = 0 THEN CAST(l_linenumber AS VARCHAR) WHEN l_quantity % 3 = 1 THEN ['i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii'][l_linenumber] ELSE chr(CAST(l_linenumber + 96 AS INTEGER)) END AS marker FROM lineitem), {WALK_SQL}
      SELECT level, count(*) AS n, count(DISTINCT array_to_string(names, '/')) AS n_paths FROM walk WHERE line_no > 0 GROUP BY level""",
    "guideline_kinds": f"""WITH g AS (SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS line_no, CASE WHEN k % 11 = 0 THEN {ROMAN_SQL.replace("number", "(k % 20 + 1)")} || '. ' || upper(p) WHEN k % 7 = 0 THEN p || ' ..... ' || k % 90 WHEN k % 2 = 0 THEN (k % 9 + 1) || '.' || (k % 5 + 1) || ' ' || p ELSE 'The order is ' || lower(o_orderstatus) || '.' END AS line,
        CASE WHEN k % 11 = 0 THEN 'prose' WHEN k % 7 = 0 THEN 'toc_entry' WHEN k % 2 = 0 THEN 'decimal' ELSE 'prose' END AS kind FROM (SELECT *, o_orderkey AS k, o_orderpriority AS p FROM orders)), {offsets_sql("g")},
      s AS (SELECT * FROM (SELECT *, CASE WHEN line_no = 0 THEN 'document_title' ELSE kind END AS k, max(byte_end) OVER (PARTITION BY doc_id) AS total FROM off) WHERE k <> 'prose'),
      e AS (SELECT doc_id, k, coalesce(lead(byte_start) OVER (PARTITION BY doc_id ORDER BY line_no), total) - byte_start AS size FROM s) SELECT doc_id, k AS kind, count(*) AS n_spans, CAST(sum(size) AS BIGINT) AS n_bytes FROM e GROUP BY ALL""",
    "guideline_parts": f"""WITH g AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS line_no, two, CASE WHEN k % 11 = 0 THEN {ROMAN_SQL.replace("number", "(k % 20 + 1)")} || '. PRIORITY ' || upper(p) WHEN k % 29 = 0 THEN 'GLOSSARY' WHEN k % 17 = 0 THEN '12 ICH E6 Guideline' WHEN k % 7 = 0 THEN '1.1 Orders ..... ' || k % 90
          WHEN k % 5 = 0 THEN two || ' Order ' || k WHEN k % 5 = 1 THEN two || '.' || (k % 2 + 1) || ' Order ' || k WHEN k % 5 = 2 THEN '' ELSE 'Order ' || k || ' is due.' END AS line,
        CASE WHEN k % 11 = 0 OR k % 29 = 0 THEN 'part_header' WHEN k % 7 = 0 THEN 'toc_entry' WHEN k % 5 < 2 THEN 'decimal' ELSE 'prose' END AS kind FROM (SELECT o_custkey // 25 AS doc_id, o_orderkey AS k, o_orderpriority AS p, (o_orderkey % 3 + 1) || '.' || (o_orderkey % 4 + 1) AS two FROM orders)), {offsets_sql("g")},
      b AS (SELECT *, CASE WHEN n = 1 THEN 'document_title' ELSE kind END AS k, max(total) OVER (PARTITION BY doc_id) AS all_bytes FROM (SELECT *, (SELECT max(byte_end) FROM off f WHERE f.doc_id = x.doc_id) AS total FROM {GUIDE_SQL} x)),
      p AS (SELECT *, count(*) FILTER (k = 'part_header') OVER w AS part_no, lag(k) OVER w AS prior FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
      o AS (SELECT *, CASE WHEN k = 'prose' THEN 'section_chapeau' ELSE k END AS sort, CASE WHEN k = 'decimal' THEN split_part(line, ' ', 1) END AS section FROM p WHERE k <> 'prose' OR part_no > 0 AND prior <> 'prose'),
      s AS (SELECT *, row_number() OVER w AS seq, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE byte_start END AS first, coalesce(lead(byte_start) OVER w, all_bytes) AS last FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
      u AS (SELECT *, last_value(CASE WHEN sort = 'part_header' THEN seq END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS header, CASE WHEN section <> two THEN last_value(CASE WHEN section = two THEN seq END IGNORE NULLS) OVER (PARTITION BY doc_id, part_no, two ORDER BY seq) END AS above FROM s)
      SELECT doc_id, {NUMBERED.format("seq")} AS span_id, sort AS kind, section, first AS byte_start, last AS byte_end, CASE WHEN sort IN ('decimal', 'section_chapeau') THEN {NUMBERED.format("coalesce(above, header)")} END AS parent_span_id FROM u""",
    "regulation_prints": f"""WITH frame(zone, rank, mod, rest, text, kind, path, up, raw) AS ({values_sql(FRAME)}), sect(rank, mod, rest, text, kind, path, up, raw) AS ({values_sql(BODY)}), o AS (SELECT o_custkey AS c, o_orderkey AS o FROM orders),
      r AS (SELECT c, CAST(-1 AS BIGINT) AS o, zone, rank, text, kind, path, CAST(NULL AS INTEGER) AS up, raw FROM (SELECT DISTINCT c FROM o) JOIN frame ON c % mod = rest
        UNION ALL SELECT c, o, CASE WHEN o % 2 = 0 THEN 30 ELSE 50 END, rank, text, kind, path, up, raw FROM o JOIN sect ON o % mod = rest
        UNION ALL SELECT c, o, zone, 0, text, 'toc_entry', '', NULL, raw FROM o JOIN sect ON rank = 0 JOIN (VALUES (10), (20)) z(zone) ON zone = 10 OR c % 2 = 0),
      n AS (SELECT c AS doc_id, row_number() OVER (PARTITION BY c ORDER BY zone, rank = 9, o, rank) AS line_no, {filled_sql("text", p="(c + 100)", q="(c + 9000)", c="c", o="o")} AS line, {filled_sql("raw", p="(c + 100)", c="c", o="o")} AS raw, c, o, zone, rank, kind, path, up FROM r), {offsets_sql("n")},
      s AS (SELECT *, row_number() OVER w AS seq, coalesce(lead(byte_start) OVER w, total) AS stop FROM (SELECT *, max(byte_end) OVER (PARTITION BY doc_id) AS total FROM off) WHERE kind IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY line_no))
      SELECT s.doc_id, {NUMBERED.format("s.seq")} AS span_id, s.kind, CASE WHEN s.o >= 0 THEN (s.c + 100) || '.' || s.o END AS section, CASE s.zone WHEN 30 THEN 'A' WHEN 50 THEN 'B' END AS subpart, s.path, s.raw, s.byte_start, s.stop AS byte_end, CASE WHEN u.seq IS NOT NULL THEN {NUMBERED.format("u.seq")} END AS parent_span_id
      FROM s LEFT JOIN s u ON u.doc_id = s.doc_id AND u.zone = s.zone AND CASE WHEN s.up = -1 THEN u.o = -1 AND u.rank = 0 ELSE u.o = s.o AND u.rank = s.up END""",
}
