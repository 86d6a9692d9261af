"""Regulation text derived from the order tables, one document per supplier, and the same rows as DuckDB SQL.

A document holds a table of contents (sections of every 50th order), a part header, and for each order of the supplier
a section header, one lettered paragraph per line item, furniture after every tenth order, and a blank line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the part that the previous line of the same order belongs to."""
    li = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS s", "l_orderkey AS o", "l_linenumber AS ln", "l_partkey AS pk", "l_quantity AS q", "l_extendedprice AS ep", "l_shipdate AS sd", "l_returnflag AS flag")
    before = F.lag("s").over(Window.partitionBy("o").orderBy("ln", "pk", "s", "q", "ep", "sd", "flag"))
    return li.withColumn("p", F.coalesce(before + 100, F.lit(9100).cast("bigint")))


def placed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line item with the place of its lines in the text of its document, before any line is made.

    doc_id, o, ln, part, flag and p say what the lines hold; at is the first line's number, toc that of its order in the
    contents and top that of the part's header, null where the item opens none; opens and closes: whether it is the first
    and the last of its order. The shuffle by document moves these numbers, no text: n is the place within the order, by
    which items of one order and document stand in the order of all their columns.
    """
    li = table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS s", "l_orderkey AS o", "l_linenumber AS ln", "l_partkey AS pk", "l_quantity AS q", "l_extendedprice AS ep", "l_shipdate AS sd", "l_returnflag AS flag")
    same_order = Window.partitionBy("o").orderBy("ln", "pk", "s", "q", "ep", "sd", "flag")
    modal = F.when(F.col("flag") == "A", 0).when(F.col("flag") == "N", 1).otherwise(2)
    at = li.select("s", "o", F.row_number().over(same_order).alias("n"), F.lag("s").over(same_order).alias("before"), "ln", (F.col("pk") % 150 + 100).cast("int").alias("part"), modal.alias("modal"))
    w = Window.partitionBy("s").orderBy("o", "n")
    now, every = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    row = F.row_number().over(w)
    opens = (row == 1) | ~F.col("o").eqNullSafe(F.lag("o").over(w))
    closes = F.lead("n").over(w).isNull() | ~F.col("o").eqNullSafe(F.lead("o").over(w))
    at = at.select("*", row.alias("row"), opens.alias("opens"), closes.alias("closes"))
    size = 1 + F.col("opens").cast("int") + F.when(F.col("closes"), F.when(F.col("o") % 10 == 0, 2).otherwise(1)).otherwise(0)
    listed = F.when(F.col("opens") & (F.col("o") % 50 == 0), 1)
    at = at.withColumn("size", size).withColumn("listed", listed)
    contents, lines = F.count("listed").over(every), F.sum("size").over(now)
    at = at.select("*", contents.alias("contents"), F.count("listed").over(now).alias("number"), lines.alias("lines"))
    return at.select(
        F.col("s").alias("doc_id"), "o", "ln", "part", "modal", F.coalesce(F.col("before") + 100, F.lit(9100).cast("bigint")).alias("p"), "opens", "closes",
        (F.col("contents") + 1 + F.col("lines") - F.col("size")).cast("int").alias("at"),
        F.when(F.col("listed") == 1, F.col("number") - 1).cast("int").alias("toc"), F.when(F.col("row") == 1, F.col("contents")).cast("int").alias("top"),
    )


def made_lines(placed: DataFrame, furniture: bool = True) -> DataFrame:
    """doc_id, o, r (line_no, kind, line) of placed_items: title, header and paragraph and, unless left out, furniture and blank lines."""
    s, o, at = F.col("doc_id").cast("string"), F.col("o").cast("string"), F.col("at")
    modal = F.when(F.col("modal") == 0, "shall").when(F.col("modal") == 1, "may").otherwise("must not")
    para = F.concat(F.lit("("), F.char(F.col("ln") + 96), F.lit(") The supplier "), modal, F.lit(" ship part "), F.col("part").cast("string"), F.lit(" units under § "), F.col("p").cast("string"), F.lit("."), o, F.lit("."))
    header = F.concat(F.lit("§ "), (F.col("doc_id") + 100).cast("string"), F.lit("."), o, F.lit(" Shipments of order "), o, F.lit("."))
    title = F.concat(F.lit("PART "), (F.col("doc_id") + 100).cast("string"), F.lit("—SUPPLIER "), s)
    footer = F.concat(F.lit("page "), (F.col("o") % 7 + 1).cast("string"), F.lit(" of 9"))
    row = lambda n, kind, line: F.struct(n.cast("int").alias("line_no"), F.lit(kind).alias("kind"), line.alias("line"))
    own = at + F.col("opens").cast("int")
    rows = [F.when(F.col("toc").isNotNull(), row(F.col("toc"), "section_header", header)), F.when(F.col("opens"), row(at, "section_header", header)), row(own, "paragraph", para)]
    if furniture:
        paged = F.col("closes") & (F.col("o") % 10 == 0)
        rows += [F.when(F.col("top").isNotNull(), row(F.col("top"), "title", title)), F.when(paged, row(own + 1, "footer", footer))]
        rows += [F.when(F.col("closes"), row(own + F.when(F.col("o") % 10 == 0, 2).otherwise(1), "blank", F.lit("")))]
    return placed.select("doc_id", "o", "ln", F.explode(F.array_compact(F.array(*rows))).alias("r"))


def reg_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, line_no, line."""
    return made_lines(placed_items(spark, sf_dir)).select("doc_id", "r.line_no", "r.line")


#: reg(doc_id, line_no, line)
REG_SQL = """items AS (SELECT l_suppkey AS s, l_orderkey AS o, l_linenumber AS ln, l_partkey AS pk, l_quantity AS q, l_extendedprice AS ep, l_shipdate AS sd, l_returnflag AS flag,
  coalesce(lag(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_returnflag) + 100, 9100) AS p FROM lineitem),
sections AS (SELECT DISTINCT s, o, '§ ' || (s + 100) || '.' || o || ' Shipments of order ' || o || '.' AS header FROM items),
regrows AS (
  SELECT s, 0 AS zone, o, 0 AS rank, header AS line, NULL AS ln, NULL AS pk, NULL AS q, NULL AS ep, NULL AS sd, NULL AS flag FROM sections WHERE o % 50 = 0
  UNION ALL SELECT DISTINCT s, 1, -1, 0, 'PART ' || (s + 100) || '—SUPPLIER ' || s, NULL, NULL, NULL, NULL, NULL, NULL FROM items
  UNION ALL SELECT s, 2, o, 0, header, NULL, NULL, NULL, NULL, NULL, NULL FROM sections
  UNION ALL SELECT s, 2, o, 1, '(' || chr(96 + ln) || ') The supplier ' || CASE flag WHEN 'A' THEN 'shall' WHEN 'N' THEN 'may' ELSE 'must not' END || ' ship part ' || (pk % 150 + 100) || ' units under § ' || p || '.' || o || '.', ln, pk, q, ep, sd, flag FROM items
  UNION ALL SELECT s, 2, o, 2, 'page ' || (o % 7 + 1) || ' of 9', NULL, NULL, NULL, NULL, NULL, NULL FROM sections WHERE o % 10 = 0
  UNION ALL SELECT s, 2, o, 3, '', NULL, NULL, NULL, NULL, NULL, NULL FROM sections),
reg AS (SELECT s AS doc_id, row_number() OVER (PARTITION BY s ORDER BY zone, o, rank, ln, pk, q, ep, sd, flag) - 1 AS line_no, line FROM regrows)"""

#: docl(doc_id, line_no, line) of documents
LINES_SQL = """docl AS (SELECT doc_id, unnest(generate_series(0, len(a) - 1)) AS line_no, unnest(a) AS line
  FROM (SELECT doc_id, CASE WHEN a[len(a)] = '' THEN a[1:len(a) - 1] ELSE a END AS a FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)))"""


def offsets_sql(source: str) -> str:
    """off: source with byte_start and byte_end."""
    return f"off AS (SELECT *, byte_end - strlen(line) - 1 AS byte_start FROM (SELECT *, CAST(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS byte_end FROM {source}))"
