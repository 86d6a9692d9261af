"""The catalog of every document as one ordered set of lines, written as text without ever collecting a document.

Parts come in order: title, coverage, definitions, scope, requirements by section, tags, reconcilers' log, what is
ambiguous, appendix; an empty part is left out, its heading too. A line's place is its document, its part and a key of
numbers, by which rows are dealt in ranges and sorted; a part of a document may span many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.text import clean_paragraph
from spanledger.operators import views
from spanledger.operators.audit import is_bearing
from spanledger.operators.graph import stored

# Headings of the parts, in order.
DEFINITIONS, SCOPE, REQUIREMENTS, TAGS, LOG, AMBIGUOUS, APPENDIX = (
    "## Definitions", "## Scope", "## Requirements", "## Tag index", "## Reconciler log", "## Ambiguous items", "## Appendix: spans",
)
SCOPES = ("### Inclusions", "### Exclusions")
COUNTS = ("| Classification | Count |", "|---|---:|")
DEPTH = 4


def key(*parts: Column | int) -> Column:
    return F.array(*(F.lit(p).cast("bigint") if isinstance(p, int) else p.cast("bigint") for p in parts))


def section_key(section: Column) -> Column:
    """The numbers of a section such as 11.10, filled up to DEPTH, so that 11.2 comes before 11.10."""
    numbers = F.transform(F.split(section, r"\."), lambda x: F.coalesce(x.try_cast("bigint"), F.lit(-1).cast("bigint")))
    filled = F.concat(numbers, F.array_repeat(F.lit(-1).cast("bigint"), DEPTH))
    return F.slice(filled, 1, DEPTH)


def headed(pieces: DataFrame | tuple[DataFrame, ...], part: int, *heads: str) -> DataFrame:
    """Rows (doc_id, key, line) of one part, after its heading and a blank line and before a blank one, in documents that
    have any. Each piece is written before the next is made: what its joins and windows shuffle is gone by then."""
    kept = [stored(p.select("doc_id", "key", "line")) for p in (pieces if isinstance(pieces, tuple) else (pieces,))]
    rows = kept[0]
    for p in kept[1:]:
        rows = rows.unionByName(p)
    docs = rows.select("doc_id").distinct()
    lines = [line for h in heads for line in (h, "")]
    top = docs.select("doc_id", F.posexplode(F.array(*map(F.lit, lines))).alias("k", "line"))
    top = top.select("doc_id", key(-2, F.col("k")).alias("key"), "line")
    end = docs.select("doc_id", key(1 << 62).alias("key"), F.lit("").alias("line"))
    return top.unionByName(rows).unionByName(end).withColumn("part", F.lit(part))


def placed(rows: DataFrame, *fields: str) -> DataFrame:
    return rows.select("doc_id", key(*(F.col(f) for f in fields)).alias("key"), "line")


def scope_part(spans: DataFrame) -> DataFrame:
    """Inclusions, then exclusions, each under its heading where there are any."""
    own = placed(views.scope_lines(spans), "ord.at.rank", "ord.at.at")
    ranks = own.select("doc_id", F.element_at("key", 1).alias("rank")).distinct()
    names = F.when(F.col("rank") == 0, SCOPES[0]).otherwise(SCOPES[1])
    heads = ranks.select("doc_id", "rank", F.posexplode(F.array(names, F.lit(""))).alias("k", "line"))
    return headed(own.unionByName(heads.select("doc_id", key(F.col("rank"), -2, F.col("k")).alias("key"), "line")), 3, SCOPE)


def requirement_part(spans: DataFrame, statements: DataFrame, edges: DataFrame) -> DataFrame:
    """Bearing spans by section and byte, each section under its title and subpart; statements below, with all their fields and edges."""
    inside = spans.filter(F.coalesce("section", F.lit("")) != "").withColumn("place", section_key(F.col("section")))
    bearing = inside.filter(is_bearing())
    first = lambda c, when: F.min_by(F.col(c), F.when(when, F.col("at")))
    heads = inside.groupBy("doc_id", "section", "place").agg(first("text", F.col("kind") == "section_header").alias("title"), first("subpart", F.coalesce("subpart", F.lit("")) != "").alias("subpart"))
    heads = heads.join(bearing.select("doc_id", "section").distinct(), ["doc_id", "section"], "left_semi")
    title = F.coalesce(F.trim(F.regexp_replace("title", r"\s+$", "")), F.concat(F.lit("§ "), "section"))
    told = F.concat(F.lit("### "), F.coalesce(F.concat(F.lit("Subpart "), "subpart", F.lit(" — ")), F.lit("")), title)
    head = heads.select("doc_id", "place", F.posexplode(F.array(told, F.lit(""))).alias("k", "line"))
    head = head.select("doc_id", F.concat("place", key(-2, F.col("k"))).alias("key"), "line")
    own = span_lines(bearing)
    below = statement_part(bearing, statements, edges)
    return headed((head, own, *below), 4, REQUIREMENTS)


def span_lines(bearing: DataFrame) -> DataFrame:
    more = F.when(F.size("final_embedded") > 0, F.concat(F.lit("  _[primary: "), "final_label", F.lit("; also: "), F.array_join("final_embedded", ", "), F.lit("]_"))).otherwise("")
    head = F.concat(F.lit("#### "), "citation", F.when(F.col("ambiguous"), "  **[ambiguous]**").otherwise(""), more)
    text = F.concat(F.lit("> "), clean_paragraph(F.col("text")))
    rows = bearing.select("doc_id", "place", "at", F.posexplode(F.array(head, F.lit(""), text, F.lit(""))).alias("k", "line"))
    end = bearing.select("doc_id", "place", "at", F.lit(1 << 40).cast("bigint").alias("k"), F.lit("").alias("line"))
    return rows.withColumn("k", F.col("k") - 10).unionByName(end).select("doc_id", F.concat("place", key(F.col("at"), F.col("k"))).alias("key"), "line")


def statement_part(bearing: DataFrame, statements: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A statement's lines in order: itself, its fields, what it leads to with the evidence, what leads to it. The fields come apart."""
    within = Window.partitionBy("doc_id", "source_span_id").orderBy("req_id")
    st = statements.withColumn("no", F.row_number().over(within))
    at = bearing.select("doc_id", F.col("span_id").alias("source_span_id"), "place", F.col("at").alias("span_at"))
    st = stored(st.join(at, ["doc_id", "source_span_id"]).withColumn("at", F.concat("place", key(F.col("span_at"), F.col("no")))))
    lists = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("tags", "conditions")}
    fields = [
        (c, F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"  - {c}: "), c))) for c in ("subject", "object")
    ] + [
        ("tags", F.when(F.size(lists["tags"]) > 0, F.concat(F.lit("  - tags: `"), F.array_join(lists["tags"], ", "), F.lit("`")))),
        ("conditions", F.when(F.size(lists["conditions"]) > 0, F.concat(F.lit("  - conditions: "), F.array_join(lists["conditions"], "; ")))),
    ]
    own = views.statement_lines(st, edges)
    # the statement itself is line 0 and its quote line 1 there, edges 2 and counts 3: fields go between
    rank = F.when(F.col("ord.k") == 0, 0).when(F.col("ord.k") == 1, 9).when(F.col("ord.k") == 2, 10).otherwise(12)
    own = own.select("doc_id", F.concat("ord.at", key(rank)).alias("key"), "line")
    more = views.rows_of(st, *((k, line) for k, (_, line) in enumerate(fields, 1)))
    return own, more.select("doc_id", F.concat("ord.at", key(F.col("ord.k"))).alias("key"), "line")


def tag_part(statements: DataFrame) -> DataFrame:
    """Every tag with the number of its statements and the first ids, by name; the tag's order is a window, not a list of all."""
    each = statements.select("doc_id", "req_id", F.explode(F.array_distinct("tags")).alias("tag"))
    rank = F.row_number().over(Window.partitionBy("doc_id", "tag").orderBy("req_id"))
    few = each.withColumn("rank", rank).groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.when(F.col("rank") <= views.FEW, F.col("req_id")))).alias("ids"))
    told = F.concat(F.lit("- `"), "tag", F.lit("` ("), F.col("n").cast("string"), F.lit("): "), F.array_join("ids", ", "), F.when(F.col("n") > views.FEW, ", ...").otherwise(""))
    return few.select("doc_id", key(F.row_number().over(Window.partitionBy("doc_id").orderBy("tag"))).alias("key"), told.alias("line"))


def whole(meta: DataFrame, spans: DataFrame, statements: DataFrame, edges: DataFrame, log: DataFrame) -> DataFrame:
    """doc_id, part, key, line. meta: doc_id, title. spans: doc_id, span_id, at, kind, section, subpart, citation, text,
    byte_start, byte_end, with their class (final_label, final_embedded, ambiguous). statements: doc_id, req_id,
    source_span_id, citation_raw, verbatim_quote, atomic_statement, modality, subject, object, tags, conditions,
    ambiguous. edges: doc_id, rel_id, src, dst, type, ambiguous. log: as views.log_lines takes it."""
    at = spans.withColumn("label", F.col("final_label"))
    title = meta.select("doc_id", F.posexplode(F.array(F.concat(F.lit("# Catalog — "), "title"), F.lit(""))).alias("k", "line")).select("doc_id", key(F.col("k")).alias("key"), "line", F.lit(0).alias("part"))
    labels = views.label_table(at.withColumn("label", F.coalesce("label", F.lit("(none)"))))
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))
    labels = labels.select("doc_id", key(order).alias("key"), "line")
    head = labels.select("doc_id").distinct().select("doc_id", F.posexplode(F.array(*map(F.lit, COUNTS))).alias("k", "line")).select("doc_id", key(-1, F.col("k")).alias("key"), "line")
    open_ = views.ambiguous_index(at, statements, edges).withColumn("no", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")))
    parts = (
        title,
        headed(labels.unionByName(head), 1, "## Coverage"),
        headed(placed(views.definition_lines(at), "ord.at", "ord.k"), 2, DEFINITIONS),
        scope_part(at),
        requirement_part(at, statements, edges),
        headed(tag_part(statements), 5, TAGS),
        headed(placed(views.log_lines(log), "ord.at", "ord.k"), 6, LOG),
        headed(placed(open_, "no"), 7, AMBIGUOUS),
        headed(placed(views.appendix_lines(at), "ord.at", "ord.k"), 8, APPENDIX),
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "part", "key", "line")


def write_text(rows: DataFrame, path: str, tasks: int | None = None) -> None:
    """The lines of all documents in order as text files, whose names are in order too: dealt by ranges of place and
    sorted within them, so that the longest document is as many files as it needs."""
    place = ["doc_id", "part", "key"]
    dealt = rows.repartitionByRange(*([tasks] if tasks else []), *place).sortWithinPartitions(*place)
    dealt.select("line").write.mode("errorifexists").text(path)
