"""Reports and catalogs as rows: (document, order, line); a writer turns them into text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.text import clean_paragraph, cut, definition_parts, trim_unicode


def catalog_lines(spans: DataFrame, most: int = 60) -> DataFrame:
    """doc_id, ord, line of spans (doc_id, seq, kind, section, text): sections in numeric order, each with its title and its paragraphs."""
    number = F.transform(F.split("section", r"\."), lambda x: x.cast("bigint"))
    titles = spans.filter("kind = 'section_header'").groupBy("doc_id", "section").agg(F.min("text").alias("title"))
    head = titles.select("doc_id", F.struct(number.alias("section"), F.lit(0).cast("bigint").alias("seq")).alias("ord"), F.concat(F.lit("## "), "title").alias("line"))
    body = spans.filter("kind <> 'section_header'").select("doc_id", F.struct(number.alias("section"), F.col("seq").cast("bigint").alias("seq")).alias("ord"), F.concat(F.lit("- "), cut(F.col("text"), most)).alias("line"))
    return head.unionByName(body)


def label_table(spans: DataFrame) -> DataFrame:
    """doc_id, ord, line: how many spans each label has, by name."""
    counted = spans.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("doc_id", F.col("label").alias("ord"), F.concat(F.lit("| "), "label", F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("line"))


def ambiguous_index(classes: DataFrame, statements: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id, ord, line of everything that waits for a decision: spans, statements, edges, in this order."""
    of = lambda df, rank, id_col: df.filter("ambiguous").select("doc_id", F.struct(F.lit(rank).alias("rank"), F.col(id_col).alias("id")).alias("ord"), F.concat(F.lit("- "), id_col).alias("line"))
    return of(classes, 1, "span_id").unionByName(of(statements, 2, "req_id")).unionByName(of(edges, 3, "rel_id"))


def incoming_counts(edges: DataFrame) -> DataFrame:
    """dst, told: "n type, ..." of the edges that come in, by type."""
    counted = edges.groupBy("dst", "type").agg(F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("type", "n")))
    return counted.groupBy("dst").agg(F.array_join(F.transform(listed, lambda x: F.concat_ws(" ", x["n"].cast("string"), x["type"])), ", ").alias("told"))


#: Ids that an index names of each tag.
FEW = 20


def rows_of(df: DataFrame, *lines: tuple[int, Column]) -> DataFrame:
    """doc_id, ord, line: numbered lines of each row of df (doc_id, at, ...), null ones left out; at orders the rows."""
    each = F.array_compact(F.array(*(F.when(line.isNotNull(), F.struct(F.lit(k).alias("k"), line.alias("line"))) for k, line in lines)))
    return df.select("doc_id", "at", F.explode(each).alias("x")).select("doc_id", F.struct("at", "x.k").alias("ord"), "x.line")


def definition_lines(spans: DataFrame) -> DataFrame:
    """Definitions of spans (doc_id, at, citation, label, text) in order: the term in bold where the text says what it means."""
    term, body = definition_parts(F.col("text"))
    told = F.when(term != "", F.concat(F.lit("- **"), term, F.lit("** ("), "citation", F.lit("): "), body)).otherwise(F.concat(F.lit("- ("), "citation", F.lit("): "), trim_unicode(F.col("text"))))
    return rows_of(spans.filter("label = 'definition'"), (0, told))


def scope_lines(spans: DataFrame) -> DataFrame:
    """What is in scope and then what is not, by the primary label: doc_id, ord, line of spans (doc_id, at, citation, label, text)."""
    told = F.concat(F.lit("- **"), "citation", F.lit("**: "), clean_paragraph(F.col("text")))
    rank = F.when(F.col("label") == "scope_inclusion", 0).otherwise(1)
    return rows_of(spans.filter("label IN ('scope_inclusion', 'scope_exclusion')").withColumn("at", F.struct(rank.alias("rank"), "at")), (0, told))


def span_heads(spans: DataFrame) -> DataFrame:
    """Heading and text of bearing spans (doc_id, at, citation, text, final_label, final_embedded, ambiguous)."""
    more = F.when(F.size("final_embedded") > 0, F.concat(F.lit("  _[primary: "), "final_label", F.lit("; also: "), F.array_join("final_embedded", ", "), F.lit("]_"))).otherwise("")
    head = F.concat(F.lit("#### "), "citation", F.when(F.col("ambiguous"), "  **[ambiguous]**").otherwise(""), more)
    return rows_of(spans, (0, head), (1, F.concat(F.lit("> "), clean_paragraph(F.col("text")))))


def statement_lines(statements: DataFrame, edges: DataFrame) -> DataFrame:
    """Statements (doc_id, at, req_id, modality, atomic_statement, verbatim_quote, citation_raw, ambiguous) with what they lead to and what leads to them; the citation of an unknown target is ?."""
    quote = cut(trim_unicode(F.replace("verbatim_quote", F.lit("\n"), F.lit(" "))), 200)
    head = F.concat(F.lit("- **`"), "req_id", F.lit("`** ["), "modality", F.lit("]"), F.when(F.col("ambiguous"), "  ⚠ ambiguous").otherwise(""), F.lit(" "), "atomic_statement")
    own = rows_of(statements, (0, head), (1, F.when(F.coalesce("verbatim_quote", F.lit("")) != "", F.concat(F.lit('  - quote: "'), quote, F.lit('"')))))
    place = statements.select("doc_id", F.col("req_id").alias("src"), "at")
    cited = statements.select("doc_id", F.col("req_id").alias("dst"), F.col("citation_raw").alias("cited"))
    out = edges.join(place, ["doc_id", "src"]).join(cited, ["doc_id", "dst"], "left")
    told = F.concat(F.lit("  - **"), "type", F.lit("**"), F.when(F.col("ambiguous"), " ⚠").otherwise(""), F.lit(" → `"), "dst", F.lit("` ("), F.coalesce("cited", F.lit("?")), F.lit(")"))
    leads = out.select("doc_id", F.struct("at", F.lit(2).alias("k")).alias("ord"), told.alias("line"))
    into = edges.withColumn("dst", F.struct("doc_id", "dst"))
    n = incoming_counts(into).select("dst.doc_id", F.col("dst.dst").alias("src"), "told").join(place, ["doc_id", "src"])
    return own.unionByName(leads).unionByName(n.select("doc_id", F.struct("at", F.lit(3).alias("k")).alias("ord"), F.concat(F.lit("  - referenced by: "), "told").alias("line")))


def log_lines(log: DataFrame) -> DataFrame:
    """The reconcilers' log (doc_id, at, stage, key, status, label_a, label_b, final_label, count_a, count_b, count_final, ambiguous_items), told by stage."""
    unit = F.when(F.col("stage") == "decompose", " reqs").otherwise(" edges")
    labels = F.concat(F.lit("  (A="), "label_a", F.lit(" → B="), "label_b", F.lit(" → final="), "final_label", F.lit(")"))
    counts = F.concat(F.lit("  (A="), F.col("count_a").cast("string"), unit, F.lit(", B="), F.col("count_b").cast("string"), unit, F.lit(", final="), F.col("count_final").cast("string"), F.lit(", ambiguous_items="), F.coalesce(F.col("ambiguous_items").cast("string"), F.lit("0")), F.lit(")"))
    tail = F.when(F.col("stage") == "classify", labels).when(F.col("stage").isin("decompose", "relate"), counts).otherwise("")
    return rows_of(log, (0, F.concat(F.lit("- **"), F.coalesce("stage", F.lit("?")), F.lit("** `"), F.coalesce("key", F.lit("?")), F.lit("` — status: **"), F.coalesce("status", F.lit("?")), F.lit("**"), tail)))


def appendix_lines(spans: DataFrame) -> DataFrame:
    """Every span (doc_id, at, span_id, citation, kind, label, ambiguous, byte_start, byte_end) as a table row."""
    flag = F.when(F.coalesce("ambiguous", F.lit(False)), " ⚠").otherwise("")
    cells = ("`", "span_id"), ("` | ", "citation"), (" | `", "kind")
    told = F.concat(F.lit("| "), *(x for text, c in cells for x in (F.lit(text), F.coalesce(c, F.lit("")))), F.lit("` | "), F.coalesce("label", F.lit("—")), flag, F.lit(" | "), (F.col("byte_end") - F.col("byte_start")).cast("string"), F.lit(" |"))
    return rows_of(spans, (0, told))


def pending_lines(classes: DataFrame) -> DataFrame:
    """Classes (doc_id, at, span_id, final_label, downgrade_pending, downgrade_proposal) that wait for a downgrade decision."""
    p = F.col("downgrade_proposal")
    told = F.concat(F.lit("- `"), "span_id", F.lit("` — final: **"), "final_label", F.lit("**  proposed: **"), p["proposed_label"], F.lit("** (kind: "), p["kind"], F.lit(")"))
    return rows_of(classes.filter("downgrade_pending"), (0, told))


def registry_row(rows: DataFrame, order: str) -> DataFrame:
    """n_rows, sha256 of the registry written as one JSON list; the registry has a row per source, not per document."""
    told = F.to_json(F.struct(*rows.columns))
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), told.alias("j"))))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat(F.lit("["), F.array_join(F.transform(listed, lambda x: x["j"]), ","), F.lit("]")), 256).alias("sha256"))


def write_lines(rows: DataFrame, path: str) -> None:
    """doc_id and text of each document's lines in order, as Parquet: one row per document, no folder for each."""
    listed = F.array_sort(F.collect_list(F.struct("ord", "line")))
    rows.groupBy("doc_id").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("text")).write.mode("overwrite").parquet(path)
