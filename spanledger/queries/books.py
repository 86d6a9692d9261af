"""The whole catalog of every customer's orders as numbered lines, beside SQL that places each line by its own key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanledger.operators import graph
from spanledger.plans import catalog
from spanledger.plans.regtext import table

EMPTY = "CAST(array() AS array<string>)"


def book_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classed span per order, in sections such as 11.2 and 11.10; every eleventh stands in none, every 13th has no class."""
    at = table(spark, sf_dir, "orders").selectExpr("o_custkey AS doc_id", "o_orderkey AS o", "o_orderstatus", "o_orderpriority", "CASE WHEN o_orderkey % 11 > 0 THEN concat(o_custkey % 30 + 1, '.', element_at(array(2, 10, 9), CAST(o_orderkey % 3 AS INT) + 1)) END AS section", "o_orderkey % 5 = 0 AS head", "o_orderkey % 13 > 0 AS classed")
    return at.selectExpr(
        "doc_id", "o AS at", "concat('S', o) AS span_id", "section", "CASE WHEN head THEN 'section_header' ELSE 'paragraph' END AS kind", "CASE WHEN o % 4 = 0 THEN 'B' END AS subpart", "coalesce(concat('§ ', section), concat('S', o)) AS citation",
        "CASE WHEN head THEN concat('§ ', section, ' Orders of ', o_orderpriority, '\\n') ELSE concat('(', char(97 + o % 26), ') Status ', o_orderstatus, CASE WHEN o % 2 = 0 THEN ' means' ELSE ' is' END, ' that order\\n', o_orderpriority, ' counts, as of old.\\n') END AS text",
        "o * 10 AS byte_start", "o * 10 + o % 97 AS byte_end", "CASE WHEN classed THEN element_at(array('requirement_bearing', 'definition', 'scope_inclusion', 'scope_exclusion'), CAST(o % 4 AS INT) + 1) END AS final_label",
        f"CASE WHEN classed AND o % 6 = 0 THEN array('requirement_bearing') ELSE {EMPTY} END AS final_embedded", "CASE WHEN classed THEN o % 7 = 0 END AS ambiguous",
    ).withColumn("text", F.coalesce("text", F.lit("Orders.\n")))


def book_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement per line item, with fields that some lack."""
    rn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    li = table(spark, sf_dir, "lineitem").withColumn("rn", rn)
    t = li.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return t.selectExpr(
        "o_custkey AS doc_id", "l_orderkey", "l_partkey", "rn", "concat('R', l_orderkey, '.', lpad(rn, 3, '0')) AS req_id", "concat('S', l_orderkey) AS source_span_id", "concat('C', l_orderkey) AS citation_raw", "CASE WHEN l_partkey % 4 > 0 THEN concat('that order\\n', o_orderpriority) END AS verbatim_quote",
        "concat('ship part ', l_partkey) AS atomic_statement", "CASE l_returnflag WHEN 'A' THEN 'shall' WHEN 'N' THEN 'may' ELSE 'must' END AS modality", "CASE WHEN l_partkey % 3 = 0 THEN 'firms' ELSE '' END AS subject", "CASE WHEN l_partkey % 5 = 0 THEN 'records' END AS object",
        f"CASE WHEN l_partkey % 2 = 0 THEN array('ship', concat('flag ', l_returnflag), 'ship') ELSE {EMPTY} END AS tags", "CASE WHEN l_partkey % 7 = 0 THEN array('if due', 'if old') END AS conditions", "rn = 2 AS ambiguous",
    )


def whole_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every catalog with its number in its document; customers without orders have a title alone."""
    meta = table(spark, sf_dir, "customer").selectExpr("c_custkey AS doc_id", "c_name AS title")
    # each part reads them again: made and joined once, not for every part
    st = graph.stored(book_statements(spark, sf_dir))
    edges = st.selectExpr("doc_id", "concat('E', l_orderkey, '.', rn) AS rel_id", "req_id AS src", "concat('R', l_orderkey, '.', lpad(rn + 1, 3, '0')) AS dst", "element_at(array('refines', 'references', 'composed_of'), CAST(l_partkey % 3 AS INT) + 1) AS type", "l_partkey % 5 = 0 AS ambiguous")
    log = table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").selectExpr("o_custkey AS doc_id", "o_orderkey AS at", "element_at(array('classify', 'decompose'), CAST(o_orderkey DIV 2 % 2 AS INT) + 1) AS stage", "concat('S', o_orderkey) AS key", "CASE WHEN o_orderkey % 3 = 0 THEN 'ambiguous' ELSE 'resolved' END AS status", "'definition' AS label_a", "o_orderstatus AS label_b", "'definition' AS final_label", "o_orderkey % 5 AS count_a", "o_orderkey % 7 AS count_b", "o_orderkey % 6 AS count_final", "nullif(o_orderkey % 3, 0) AS ambiguous_items")
    rows = catalog.whole(meta, graph.stored(book_spans(spark, sf_dir)), st, edges, log)
    no = F.row_number().over(Window.partitionBy("doc_id").orderBy("part", "key"))
    return rows.select("doc_id", "part", no.cast("bigint").alias("no"), "line")


QUERIES = {"whole_catalog": whole_catalog}

#: Parts that have a heading: number, rows, heading.
HEADED = (
    (1, "labels", "## Coverage"), (2, "defs", catalog.DEFINITIONS), (3, "scope", catalog.SCOPE), (4, "reqs", catalog.REQUIREMENTS), (5, "tagged", catalog.TAGS),
    (6, "logged", catalog.LOG), (7, "waits", catalog.AMBIGUOUS), (8, "app", catalog.APPENDIX),
)
PARTS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, {part} AS part, k, line FROM {name} UNION ALL SELECT doc_id, {part}, h.k, h.line FROM (SELECT DISTINCT doc_id FROM {name}), (VALUES ([-2, 0]::BIGINT[], '{head}'), ([-2, 1]::BIGINT[], ''), ([4611686018427387904]::BIGINT[], '')) h(k, line)"
    for part, name, head in HEADED
)
SQL = {
    "whole_catalog": f"""WITH o AS (SELECT o_custkey AS doc_id, o_orderkey AS o, o_orderstatus AS s, o_orderpriority AS p, CASE WHEN o_orderkey % 11 > 0 THEN [2, 10, 9][o_orderkey % 3 + 1] END AS sub, o_custkey % 30 + 1 AS chap, o_orderkey % 13 > 0 AS classed FROM orders),
      sp AS (SELECT *, 'S' || o AS span_id, chap || '.' || sub AS section, coalesce('§ ' || chap || '.' || sub, 'S' || o) AS cited, CASE WHEN classed THEN ['requirement_bearing', 'definition', 'scope_inclusion', 'scope_exclusion'][o % 4 + 1] END AS label, classed AND o % 6 = 0 AS also, coalesce(classed AND (o % 6 = 0 OR o % 4 = 0), false) AS bears, classed AND o % 7 = 0 AS open,
        CASE WHEN o % 5 = 0 THEN coalesce('§ ' || chap || '.' || sub || ' Orders of ' || p, 'Orders.') ELSE '(' || chr(CAST(97 + o % 26 AS INTEGER)) || ') Status ' || s || CASE WHEN o % 2 = 0 THEN ' means' ELSE ' is' END || ' that order' || chr(10) || p || ' counts, as of old.' END AS text FROM o),
      st AS (SELECT o_custkey AS doc_id, l_orderkey AS o, l_partkey AS pk, rn, 'R' || l_orderkey || '.' || lpad(CAST(rn AS VARCHAR), 3, '0') AS req_id, 'R' || l_orderkey || '.' || lpad(CAST(rn + 1 AS VARCHAR), 3, '0') AS dst, ['refines', 'references', 'composed_of'][l_partkey % 3 + 1] AS type, l_returnflag AS flag, o_orderpriority AS p
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rn FROM lineitem) JOIN orders ON l_orderkey = o_orderkey),
      labels AS (SELECT doc_id, [row_number() OVER (PARTITION BY doc_id ORDER BY label)]::BIGINT[] AS k, '| ' || label || ' | ' || n || ' |' AS line FROM (SELECT doc_id, coalesce(label, '(none)') AS label, count(*) AS n FROM sp GROUP BY ALL)
        UNION ALL SELECT doc_id, h.k, h.line FROM (SELECT DISTINCT doc_id FROM sp), (VALUES ([-1, 0]::BIGINT[], '{catalog.COUNTS[0]}'), ([-1, 1]::BIGINT[], '{catalog.COUNTS[1]}')) h(k, line)),
      defs AS (SELECT doc_id, [o, 0]::BIGINT[] AS k, CASE WHEN strpos(text, ' means ') > 0 THEN '- **' || trim(substring(split_part(text, ' means ', 1), strpos(text, ')') + 1)) || '** (' || cited || '): means ' || split_part(text, ' means ', 2) ELSE '- (' || cited || '): ' || text END AS line FROM sp WHERE label = 'definition'),
      scope AS (SELECT doc_id, [o % 4 - 2, o]::BIGINT[] AS k, '- **' || cited || '**: ' || replace(text, chr(10), ' ') AS line FROM sp WHERE label LIKE 'scope%'
        UNION ALL SELECT doc_id, [r, -2, i]::BIGINT[], CASE WHEN i = 1 THEN '' WHEN r = 0 THEN '{catalog.SCOPES[0]}' ELSE '{catalog.SCOPES[1]}' END FROM (SELECT DISTINCT doc_id, o % 4 - 2 AS r FROM sp WHERE label LIKE 'scope%'), range(2) t(i)),
      b AS (SELECT *, [chap, sub, -1, -1]::BIGINT[] AS place FROM sp WHERE bears AND section IS NOT NULL),
      sect AS (SELECT doc_id, section, any_value([chap, sub, -1, -1]::BIGINT[]) AS place, min_by(text, o) FILTER (o % 5 = 0) AS title, bool_or(o % 4 = 0) AS b, bool_or(bears) AS told FROM sp WHERE section IS NOT NULL GROUP BY ALL),
      x AS (SELECT st.*, place || [b.o, row_number() OVER (PARTITION BY st.doc_id, st.o ORDER BY req_id)]::BIGINT[] AS pos FROM st JOIN b ON b.doc_id = st.doc_id AND b.o = st.o),
      reqs AS (SELECT doc_id, place || [-2, i]::BIGINT[] AS k, CASE WHEN i = 1 THEN '' ELSE '### ' || CASE WHEN b THEN 'Subpart B — ' ELSE '' END || coalesce(title, '§ ' || section) END AS line FROM sect, range(2) t(i) WHERE told
        UNION ALL SELECT doc_id, place || [o, i]::BIGINT[], CASE i WHEN -10 THEN '#### ' || cited || CASE WHEN open THEN '  **[ambiguous]**' ELSE '' END || CASE WHEN also THEN '  _[primary: ' || label || '; also: requirement_bearing]_' ELSE '' END WHEN -8 THEN '> ' || replace(text, chr(10), ' ') ELSE '' END FROM b, (VALUES (-10), (-9), (-8), (-7), (1099511627776)) t(i)
        UNION ALL SELECT doc_id, pos || [0]::BIGINT[], '- **`' || req_id || '`** [' || CASE flag WHEN 'A' THEN 'shall' WHEN 'N' THEN 'may' ELSE 'must' END || ']' || CASE WHEN rn = 2 THEN '  ⚠ ambiguous' ELSE '' END || ' ship part ' || pk FROM x
        UNION ALL SELECT doc_id, pos || [1]::BIGINT[], '  - subject: firms' FROM x WHERE pk % 3 = 0 UNION ALL SELECT doc_id, pos || [2]::BIGINT[], '  - object: records' FROM x WHERE pk % 5 = 0
        UNION ALL SELECT doc_id, pos || [3]::BIGINT[], '  - tags: `ship, flag ' || flag || ', ship`' FROM x WHERE pk % 2 = 0 UNION ALL SELECT doc_id, pos || [4]::BIGINT[], '  - conditions: if due; if old' FROM x WHERE pk % 7 = 0
        UNION ALL SELECT doc_id, pos || [9]::BIGINT[], '  - quote: "that order ' || p || '"' FROM x WHERE pk % 4 > 0
        UNION ALL SELECT x.doc_id, x.pos || [10]::BIGINT[], '  - **' || x.type || '**' || CASE WHEN x.pk % 5 = 0 THEN ' ⚠' ELSE '' END || ' → `' || x.dst || '` (' || CASE WHEN y.o IS NULL THEN '?' ELSE 'C' || y.o END || ')' FROM x LEFT JOIN x y ON y.doc_id = x.doc_id AND y.req_id = x.dst
        UNION ALL SELECT y.doc_id, y.pos || [12]::BIGINT[], '  - referenced by: 1 ' || x.type FROM x JOIN x y ON y.doc_id = x.doc_id AND y.req_id = x.dst),
      tags AS (SELECT doc_id, tag, req_id, row_number() OVER (PARTITION BY doc_id, tag ORDER BY req_id) AS r FROM (SELECT doc_id, req_id, unnest(['ship', 'flag ' || flag]) AS tag FROM st WHERE pk % 2 = 0)),
      tagged AS (SELECT doc_id, [row_number() OVER (PARTITION BY doc_id ORDER BY tag)]::BIGINT[] AS k, '- `' || tag || '` (' || n || '): ' || ids || CASE WHEN n > 20 THEN ', ...' ELSE '' END AS line FROM (SELECT doc_id, tag, count(*) AS n, string_agg(req_id, ', ' ORDER BY r) FILTER (r <= 20) AS ids FROM tags GROUP BY ALL)),
      logged AS (SELECT doc_id, [o, 0]::BIGINT[] AS k, '- **' || CASE WHEN o // 2 % 2 = 0 THEN 'classify' ELSE 'decompose' END || '** `S' || o || '` — status: **' || CASE WHEN o % 3 = 0 THEN 'ambiguous' ELSE 'resolved' END || '**' ||
        CASE WHEN o // 2 % 2 = 0 THEN '  (A=definition → B=' || s || ' → final=definition)' ELSE '  (A=' || (o % 5) || ' reqs, B=' || (o % 7) || ' reqs, final=' || (o % 6) || ', ambiguous_items=' || (o % 3) || ')' END AS line FROM o WHERE o % 2 = 0),
      waits AS (SELECT doc_id, [row_number() OVER (PARTITION BY doc_id ORDER BY rank, id)]::BIGINT[] AS k, '- ' || id AS line FROM (SELECT doc_id, 1 AS rank, span_id AS id FROM sp WHERE open UNION ALL SELECT doc_id, 2, req_id FROM st WHERE rn = 2 UNION ALL SELECT doc_id, 3, 'E' || o || '.' || rn FROM st WHERE pk % 5 = 0)),
      app AS (SELECT doc_id, [o, 0]::BIGINT[] AS k, '| `' || span_id || '` | ' || cited || ' | `' || CASE WHEN o % 5 = 0 THEN 'section_header' ELSE 'paragraph' END || '` | ' || coalesce(label, '—') || CASE WHEN open THEN ' ⚠' ELSE '' END || ' | ' || (o % 97) || ' |' AS line FROM sp),
      lines AS (SELECT c_custkey AS doc_id, 0 AS part, [i]::BIGINT[] AS k, CASE WHEN i = 0 THEN '# Catalog — ' || c_name ELSE '' END AS line FROM customer, range(2) t(i) UNION ALL {PARTS_SQL})
      SELECT doc_id, part, row_number() OVER (PARTITION BY doc_id ORDER BY part, k) AS no, line FROM lines""",
}
