"""Texts as lines with byte offsets, and what is filtered or rebuilt on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions import rules
from spanledger.functions.text import first_rule, trim_unicode


def by_doc(*order: str | Column, doc: str = "doc_id") -> Window:
    return Window.partitionBy(doc).orderBy(*order)


def before(*order: str | Column) -> Window:
    """All rows before the current one."""
    return by_doc(*order).rowsBetween(Window.unboundedPreceding, -1)


def after(*order: str) -> Window:
    """All rows behind the current one, the nearest last. In falling order, since Spark works a frame that ends in unbounded following out anew for every row."""
    return by_doc(*(F.col(c).desc() for c in order)).rowsBetween(Window.unboundedPreceding, -1)


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line_no, line; the empty piece behind a last line feed is no line."""
    parts = F.split(F.col(text_col), "\n", -1)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(parts).alias("line_no", "line"))


def with_offsets(lines: DataFrame) -> DataFrame:
    """lines with byte_start and byte_end in the joined text, each line with its line feed."""
    size = (F.octet_length("line") + 1).cast("bigint")
    end = F.sum(size).over(by_doc("line_no").rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("byte_end", end).withColumn("byte_start", F.col("byte_end") - size)


def is_blank(line: str = "line") -> Column:
    return F.col(line).rlike(r"(?U)^\s*$")


def collapse_blanks(lines: DataFrame) -> DataFrame:
    """Lines trimmed, runs of blank ones made one, leading and trailing ones dropped, numbered anew."""
    t = lines.withColumn("line", trim_unicode(F.col("line"))).withColumn("blank", F.col("line") == "")
    t = t.withColumn("prior", F.lag("blank", 1, True).over(by_doc("line_no"))).filter(~(F.col("blank") & F.col("prior")))
    # a frame of all rows in the same order: one that looks ahead would sort the lines again, and numbering them once more
    every = by_doc("line_no").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("last", F.max(F.when(~F.col("blank"), F.col("line_no"))).over(every)).filter("line_no <= last")
    return t.select("doc_id", (F.row_number().over(by_doc("line_no")) - 1).alias("line_no"), "line")


def join_lines(lines: DataFrame) -> DataFrame:
    """doc_id, text, sha256, byte_count; every line ends in a line feed."""
    text = F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"), F.lit("\n"))
    return lines.groupBy("doc_id").agg(text.alias("text")).select("doc_id", "text", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("byte_count"))


def tag_furniture(lines: DataFrame, table: tuple = rules.REGULATION_FURNITURE) -> DataFrame:
    """lines with rule_id: the first rule that the trimmed line matches, null for content."""
    return lines.withColumn("line", trim_unicode(F.col("line"))).withColumn("rule_id", first_rule(F.col("line"), table))


def tag_titles(lines: DataFrame, titles: DataFrame) -> DataFrame:
    """lines with rule_id set where a line without one is its document's title (doc_id, title) and nothing else."""
    own = F.col("title").isNotNull() & (F.rtrim(F.col("line")) == F.col("title"))
    return lines.join(titles, "doc_id", "left").withColumn("rule_id", F.coalesce("rule_id", F.when(own, "PAGE_HEADER_DOC_TITLE"))).drop("title")


def pages_to_lines(pages: DataFrame) -> DataFrame:
    """doc_id, line_no, page_number, line of pages (doc_id, page_number, text), in page order."""
    each = pages.select("doc_id", "page_number", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return each.select("doc_id", (F.row_number().over(by_doc("page_number", "at")) - 1).alias("line_no"), "page_number", "line")


MARGIN = r"^(\d{1,4})(\s{2,})(\S.*)$"


def strip_margin_numbers(lines: DataFrame) -> DataFrame:
    """lines without margin numbers, and stripped: whether one went. Numbers go only where they climb by 1 to 3 within three lines, and if three lines or more of a document do so."""
    number = F.when(F.col("line").rlike(MARGIN), F.regexp_extract("line", MARGIN, 1).cast("int"))
    found = lines.withColumn("number", number)
    some = found.filter("number IS NOT NULL").select("doc_id", "line_no", "number")
    w = by_doc("line_no")
    follows = lambda far, n: (far.between(1, 3)) & (n.between(1, 3))
    run = F.coalesce(follows(F.col("line_no") - F.lag("line_no").over(w), F.col("number") - F.lag("number").over(w)), F.lit(False))
    run = run | F.coalesce(follows(F.lead("line_no").over(w) - F.col("line_no"), F.lead("number").over(w) - F.col("number")), F.lit(False))
    some = some.withColumn("run", run).filter("run").withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("doc_id"))).filter("many >= 3")
    joined = found.join(some.select("doc_id", "line_no", F.lit(True).alias("stripped")), ["doc_id", "line_no"], "left")
    return joined.withColumn("stripped", F.coalesce("stripped", F.lit(False))).withColumn("line", F.when(F.col("stripped"), F.regexp_extract("line", MARGIN, 3)).otherwise(F.col("line"))).drop("number")


def repeated_lines(lines: DataFrame, least: int = 3) -> DataFrame:
    """line, n_docs, n_lines of lines that stand in so many documents."""
    pairs = lines.groupBy("line", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines")).filter(F.col("n_docs") >= least)


def lead_bytes(c: Column) -> Column:
    """How many characters start in some bytes of UTF-8: all bytes but those that go on with one."""
    return F.length(F.regexp_replace(F.hex(c), "[89AB].|(.).", "$1"))


#: Bytes of text between two entries of the index.
PIECE = 256


def byte_index(lines: DataFrame) -> DataFrame:
    """doc_id, byte_start, char_start, piece: every PIECE bytes of each line, its line feed included, with the characters that start before them."""
    whole = with_offsets(lines).withColumn("bytes", F.concat("line", F.lit("\n")).cast("binary"))
    at = whole.select("doc_id", "byte_start", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - 1, F.lit(PIECE))).alias("from"))
    piece = at.select("doc_id", (F.col("byte_start") + F.col("from")).alias("byte_start"), F.substring("bytes", F.col("from") + 1, F.lit(PIECE)).alias("piece"))
    w = by_doc("byte_start").rowsBetween(Window.unboundedPreceding, -1)
    return piece.withColumn("char_start", F.coalesce(F.sum(lead_bytes(F.col("piece"))).over(w), F.lit(0)))


def chars_at(offsets: DataFrame, lines: DataFrame) -> DataFrame:
    """offsets (doc_id, at, ...) with the number of the character that holds byte at, from 0; at the text's end the number of its characters, null beyond. An as-of merge with the index: work grows with bytes plus offsets, however long a line is."""
    index = byte_index(lines).select("doc_id", F.col("byte_start").alias("at"), F.lit(0).alias("side"), F.struct("byte_start", "char_start", "piece").alias("entry"))
    w = by_doc("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    both = index.unionByName(offsets.withColumn("side", F.lit(1)), allowMissingColumns=True)
    asked = both.withColumn("entry", F.last("entry", True).over(w)).filter("side = 1")
    inside = F.col("at") - F.col("entry.byte_start")
    size = F.octet_length("entry.piece")
    here = lead_bytes(F.substring("entry.piece", F.lit(1), (inside + 1).cast("int"))) - 1
    char = F.when(inside < size, F.col("entry.char_start") + here).when(inside == size, F.col("entry.char_start") + lead_bytes(F.col("entry.piece")))
    return asked.withColumn("char", char).select(*offsets.columns, "char")
