"""Lines into gap-free spans: generic blocks, guideline decimals, regulation paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions import rules
from spanledger.functions.text import from_roman, numbered, trim_unicode

from .graph import cut, stored
from .lines import after, before, by_doc, is_blank, with_offsets


def close_spans(starts: DataFrame, lines: DataFrame, pin_first: bool) -> DataFrame:
    """Spans from rows that open one (doc_id, line_no, byte_start, ...): each ends where the next starts, the last at the end.

    pin_first moves the first span to byte 0; without it, text before the first span stays a gap.
    """
    total = lines.groupBy("doc_id").agg(F.max("byte_end").alias("byte_count"))
    w = by_doc("line_no")
    numbered = starts.withColumn("seq", F.row_number().over(w))
    if pin_first:
        numbered = numbered.withColumn("byte_start", F.when(F.col("seq") == 1, F.lit(0).cast("bigint")).otherwise(F.col("byte_start")))
    spans = numbered.join(total, "doc_id").withColumn("byte_end", F.coalesce(F.lead("byte_start").over(w), F.col("byte_count")))
    spans = spans.withColumn("span_id", F.format_string("S%04d", "seq")).drop("byte_count")
    return spans.drop("line_no")


def line_spans(lines: DataFrame) -> DataFrame:
    """One span per line."""
    at = with_offsets(lines)
    return at.select("doc_id", F.format_string("S%04d", F.col("line_no") + 1).alias("span_id"), "byte_start", "byte_end", "line")


def is_caps(text: Column, most: int = 10**9) -> Column:
    return (F.length(text) <= most) & text.rlike(r"\p{L}") & ~text.rlike(r"[\p{L}&&[^\p{Lu}]]")


def generic_spans(lines: DataFrame) -> DataFrame:
    """Blocks between blank lines; the kind comes from the block's first line."""
    at = with_offsets(lines).withColumn("blank", is_blank())
    first = at.withColumn("prior", F.lag("blank", 1, True).over(by_doc("line_no"))).filter(~F.col("blank") & F.col("prior"))
    text = trim_unicode(F.col("line"))
    header = (F.length(text) <= 80) & (is_caps(text, 80) | text.rlike(rules.HEADING)) & ~text.rlike(rules.TOC_LINE)
    kinds = first.withColumn("text", text).withColumn("header", header)
    seen = F.coalesce(F.max("header").over(before("line_no")), F.lit(False))
    opening = F.row_number().over(by_doc("line_no")) == 1
    kind = F.when(opening, "document_title").when(F.col("text").rlike(rules.TOC_LINE), "toc_entry").when(F.col("header"), "section_header").when(seen, "paragraph").otherwise("document_title")
    starts = kinds.select("doc_id", "line_no", "byte_start", kind.alias("kind"), F.substring("text", 1, 60).alias("citation"))
    return close_spans(starts, at, pin_first=True)


def guideline_spans(lines: DataFrame) -> DataFrame:
    """Decimal sections under roman or named parts; the first prose line of a part opens its chapeau. parent_span_id: the longest dotted prefix seen before in the part, else the part's header; a chapeau's is the header."""
    at = with_offsets(lines)
    text = trim_unicode(F.col("line"))
    roman_title = F.regexp_extract(text, rules.ROMAN_HEADER, 2)
    kind = F.when(text.rlike(rules.TOC_LINE), "toc_entry").when((roman_title != "") & is_caps(roman_title) | text.rlike(rules.NAMED_HEADER), "part_header").when(text.rlike(rules.DECIMAL), "decimal").otherwise("prose")
    body = at.filter(~is_blank() & ~text.rlike(rules.GUIDELINE_LINE)).withColumn("text", text).withColumn("kind", kind)
    w = by_doc("line_no")
    body = body.withColumn("n", F.row_number().over(w)).withColumn("kind", F.when(F.col("n") == 1, "document_title").otherwise(F.col("kind")))
    body = body.withColumn("part_no", F.count(F.when(F.col("kind") == "part_header", 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    chapeau = (F.col("kind") == "prose") & (F.col("part_no") > 0) & (F.lag("kind").over(w) != "prose")
    starts = body.filter((F.col("kind") != "prose")).unionByName(body.withColumn("open", chapeau).filter("open").drop("open").withColumn("kind", F.lit("section_chapeau")))
    starts = starts.withColumn("section", F.when(F.col("kind") == "decimal", F.regexp_extract("text", rules.DECIMAL, 1)))
    spans = cut(close_spans(starts.select("doc_id", "line_no", "byte_start", "kind", "section", "part_no"), at, pin_first=True))
    above = decimal_parents(spans.filter("section IS NOT NULL").select("doc_id", "part_no", "seq", "section")).select("doc_id", "seq", "parent_seq")
    header = F.last(F.when(F.col("kind") == "part_header", F.col("seq")), True).over(before("seq"))
    told = spans.withColumn("header", header).join(above, ["doc_id", "seq"], "left")
    parent = F.when(F.col("kind").isin("decimal", "section_chapeau"), F.coalesce("parent_seq", "header"))
    return told.withColumn("parent_span_id", F.format_string("S%04d", parent)).withColumn("parent_span_id", F.when(parent.isNotNull(), F.col("parent_span_id"))).drop("header", "parent_seq")


def decimal_parents(decimals: DataFrame) -> DataFrame:
    """decimals (doc_id, part_no, seq, section) with parent_seq: the last earlier row whose section is the longest dotted prefix."""
    parts = F.split("section", r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "."))
    asks = decimals.filter(F.size(parts) > 1).select("doc_id", "part_no", "seq", F.posexplode(prefixes).alias("depth", "prefix"))
    have = decimals.select("doc_id", "part_no", F.col("section").alias("prefix"), F.col("seq").alias("parent_seq"))
    hits = asks.join(have, ["doc_id", "part_no", "prefix"]).filter(F.col("parent_seq") < F.col("seq"))
    best = hits.groupBy("doc_id", "part_no", "seq").agg(F.max_by("parent_seq", F.struct("depth", "parent_seq")).alias("parent_seq"))
    return decimals.join(best, ["doc_id", "part_no", "seq"], "left")


def line_class(text: Column) -> Column:
    """What a regulation line is by itself. How it begins tells which patterns are worth a try."""
    chain = (
        ("document_title", ("Title", "Chapter", "Subchapter"), f"{rules.TITLE}|{rules.CHAPTER}|{rules.SUBCHAPTER}"), ("part_header", ("PART",), rules.PART_HEADER), ("part_toc", ("Part",), rules.PART_TOC), ("authority", ("Authority:",), rules.AUTHORITY), ("source_note", ("Source:",), rules.SOURCE_NOTE),
        ("subpart", ("Subpart",), rules.SUBPART), ("subpart_toc", ("Subpart",), rules.SUBPART_TOC), ("section", ("§",), rules.SECTION), ("amended", ("[",), rules.AMENDED_OPEN), ("marker", ("(",), r"^\((?:[a-z]|\d+|[ivxlcdm]+|[A-Z])\)"),
    )
    out = F.when(text == "", "blank")
    for name, heads, rx in chain:
        begins = F.startswith(text, F.lit(heads[0]))
        for head in heads[1:]:
            begins = begins | F.startswith(text, F.lit(head))
        out = out.when(begins & text.rlike(rx), name)
    return out.otherwise("prose")


def carried(lines: DataFrame) -> DataFrame:
    """Classed lines with the part, subpart and section in force: a part header resets both, a subpart header the section."""
    w = by_doc("line_no").rowsBetween(Window.unboundedPreceding, 0)
    c = F.col("class")
    own = lines.withColumn("own_section", F.when(c == "section", F.regexp_extract("text", rules.SECTION, 1)).when(c.isin("part_header", "subpart"), ""))
    own = own.withColumn("own_subpart", F.when(c == "subpart", F.regexp_extract("text", rules.SUBPART, 1)).when(c == "part_header", "")).withColumn("own_part", F.when(c == "part_header", F.regexp_extract("text", rules.PART_HEADER, 1)))
    for name in ("part", "subpart", "section"):
        own = own.withColumn(name, F.nullif(F.last(f"own_{name}", True).over(w), F.lit("")))
    return own.drop("own_part", "own_subpart", "own_section")


def regulation_lines(lines: DataFrame, default_part: Column) -> DataFrame:
    """Lines with byte offsets, class and the class after context: what opens the body, which section lines are contents, which are the real header.

    default_part names the document's own part, in terms of the columns of lines. Each line is read before the windows,
    which carry what was found there; text stays only of lines that are not prose, blank or a paragraph.
    """
    text, c = F.col("text"), F.col("class")
    read = lines.select("doc_id", "line_no", default_part.cast("string").alias("home"), (F.octet_length("line") + 1).cast("bigint").alias("size"), trim_unicode(F.col("line")).alias("text"))
    section = lambda group: F.when(c == "section", F.regexp_extract(text, rules.SECTION, group))
    own = read.withColumn("class", line_class(text)).select(
        "doc_id", "line_no", "home", "size", "class", section(1).alias("number"), section(2).rlike(r"^\p{Ll}").alias("lowered"),
        F.when((c == "amended") & ~text.rlike(rules.AMENDED), F.col("line_no")).alias("opens"), F.when(F.contains(text, F.lit("]")), F.col("line_no")).alias("bracket"),
        ((c == "blank") | (c == "prose") & text.rlike(r"^\p{Ll}")).alias("tail"), (c.isin("section", "subpart", "part_header") | F.startswith(text, F.lit("Appendix"))).alias("structural"),
        F.when(c == "marker", F.regexp_extract(text, MARKER, 1)).alias("marker"), F.when(~c.isin("marker", "prose", "blank"), text).alias("text"),
    )
    w, earlier = by_doc("line_no"), before("line_no")
    now, every = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # an amendment note that does not end in its bracket takes in the lines up to the next one with a bracket, if there is
    # one: the document's last bracket tells, since a frame from the row on would be worked out anew for every row
    at = own.select(
        "doc_id", "line_no", "home", "size", "class", "number", "lowered", "tail", "structural", "marker", "text", F.sum("size").over(now).alias("byte_end"), F.sum("size").over(every).alias("byte_count"),
        F.last("opens", True).over(earlier).alias("note"), F.last("bracket", True).over(earlier).alias("closed"), F.max("bracket").over(every).alias("closes"),
    )
    inside = F.coalesce((F.coalesce("closed", F.lit(-1)) <= F.col("note")) & (F.col("closes") >= F.col("line_no")), F.lit(False))
    at = at.withColumn("inside", inside).select(
        "doc_id", "line_no", "home", "marker", "text", (F.col("byte_end") - F.col("size")).alias("byte_start"), "byte_end", "byte_count", F.when(F.col("inside"), "inside_note").otherwise(c).alias("class"), F.when(~F.col("inside"), F.col("number")).alias("number"),
        F.coalesce((F.substring_index("number", ".", 1) != F.col("home")) | F.col("lowered"), F.lit(False)).alias("foreign"), F.when(~F.col("inside") & ~F.col("tail"), F.col("structural")).alias("structural"),
    )
    # a section line whose next structural line is one too belongs to a table of contents
    at = at.withColumn("next_structural", F.coalesce(F.expr("lead(structural, 1) IGNORE NULLS OVER (PARTITION BY doc_id ORDER BY line_no)"), F.lit(False)))
    # the body starts at a part header, or where a section number is seen for the second time; one header per number, the
    # first in the body: all sightings but the first are there, so that one order by number serves both
    header = (c == "section") & ~F.col("foreign") & ~F.col("next_structural")
    same = Window.partitionBy("doc_id", "number").orderBy("line_no")
    at = at.select(
        "doc_id", "line_no", "home", "marker", "text", "byte_start", "byte_end", "byte_count", "class", "number", "foreign", "next_structural", F.row_number().over(same).alias("sighting"),
        F.count(F.when(header, 1)).over(same.rowsBetween(Window.unboundedPreceding, -1)).alias("headers"), F.first(F.when(header, F.col("line_no"))).over(same.rowsBetween(Window.unboundedPreceding, 0)).alias("first_line"),
    )
    body_line = F.min(F.when((c == "part_header") | F.col("number").isNotNull() & (F.col("sighting") == 2), F.col("line_no"))).over(now)
    at = at.withColumn("body_line", body_line)
    body, in_body = F.col("body_line").isNotNull(), F.coalesce(F.col("first_line") >= F.col("body_line"), F.lit(False))
    first = (F.col("sighting") == 1) | (F.col("headers") == F.col("first_line").isNotNull().cast("int")) & ~in_body
    role = F.when(c == "section", F.when(~body, "toc_entry").when(F.col("foreign"), "prose").when(F.col("next_structural"), "toc_entry").when(first, "section_header").otherwise("prose"))
    role = role.when(c.isin("document_title", "part_toc"), F.when(~body, "document_title").otherwise("prose")).when(c == "subpart_toc", F.when(~body, "toc_entry").otherwise("prose"))
    role = role.when(c == "subpart", F.when(body, "subpart_header").otherwise("prose")).when(c == "amended", "source_note").otherwise(c)
    return at.select("doc_id", "line_no", "home", "marker", "text", "byte_start", "byte_end", "byte_count", "class", "number", role.alias("role"))


def in_force(lines: DataFrame, *more: Column) -> DataFrame:
    """regulation_lines with the section header and the subpart that each line stands under; more windows in line order go along in one pass."""
    now = by_doc("line_no").rowsBetween(Window.unboundedPreceding, 0)
    r = F.col("role")
    told = lambda value: F.last(value, True).over(now)
    out = lines.select(
        "*", *more, told(F.when(r == "section_header", F.col("line_no")).when(r.isin("part_header", "subpart_header"), -1)).alias("section_line"),
        told(F.when(r == "section_header", F.col("number")).when(r.isin("part_header", "subpart_header"), "")).alias("section"),
        told(F.when(r == "subpart_header", F.regexp_extract("text", rules.SUBPART, 1)).when(r == "part_header", "")).alias("subpart"),
        told(F.when(r == "subpart_header", F.col("line_no")).when(r == "part_header", -1)).alias("subpart_line"),
    )
    line = lambda name: F.when(F.col(name) >= 0, F.col(name))
    return out.withColumns({"section": F.nullif("section", F.lit("")), "subpart": F.nullif("subpart", F.lit("")), "section_line": line("section_line"), "subpart_line": line("subpart_line")})


ROMAN_DIGITS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def paragraph_paths(markers: DataFrame) -> DataFrame:
    """markers (doc_id, section_line, line_no, marker) with level, path and parent_line, the line of the paragraph above (none: the section).

    A fold over the markers of a section keeps the open markers per level. A single letter that is also a roman digit
    is roman only if it goes on a roman list under an open number: the value after the last one, or i as the first. A
    marker that is no numeral, as (iiii), does not count in that list. A column named rest goes along, so that nobody
    has to join the paths back.
    """
    more = ["rest"] if "rest" in markers.columns else []
    m = F.col("marker")
    plain = F.when(m.rlike(r"^\d+$"), 2).when(m.rlike("^[A-Z]$"), 4).when(m.rlike("^[ivxlcdm]{2,}$"), 3).when(m.rlike("^[ivxlcdm]$"), 0).otherwise(1)
    digit = F.element_at(F.array(*map(F.lit, ROMAN_DIGITS.values())), F.instr(F.lit("".join(ROMAN_DIGITS)), m))
    told = markers.withColumn("value", F.when(plain == 0, digit).when(plain == 3, F.coalesce(from_roman(m), F.lit(0))).otherwise(0)).withColumn("plain", plain)
    rows = told.groupBy("doc_id", "section_line").agg(F.array_sort(F.collect_list(F.struct("line_no", "marker", "value", "plain", *more))).alias("rows"))
    kind = "struct<line_no:int,level:int,path:array<string>,parent_line:int" + "".join(f",{c}:{markers.schema[c].dataType.simpleString()}" for c in more) + ">"
    none = F.lit(None).cast("struct<line:int,marker:string>")
    start = F.struct(F.array().cast(f"array<{kind}>").alias("out"), none.alias("l1"), none.alias("l2"), none.alias("l3"), F.lit(0).alias("roman"), F.lit(0).alias("deep"))

    def opened(s: Column, x: Column, level: Column) -> Column:
        m = F.struct(x["line_no"].cast("int").alias("line"), x["marker"].alias("marker"))
        l1 = F.when(level == 1, m).otherwise(s["l1"])
        l2 = F.when(level == 1, none).when(level == 2, m).otherwise(s["l2"])
        l3 = F.when(level <= 2, none).when(level == 3, m).otherwise(s["l3"])
        roman = F.when(level <= 2, 0).when((level == 3) & (x["value"] > 0), x["value"]).otherwise(s["roman"])
        above = F.coalesce(F.when(level > 3, l3["line"]), F.when(level > 2, l2["line"]), F.when(level > 1, l1["line"]))
        row = F.struct(m["line"].alias("line_no"), level.alias("level"), F.array_compact(F.array(l1["marker"], l2["marker"], l3["marker"], F.when(level == 4, x["marker"]))).alias("path"), above.alias("parent_line"), *(x[c].alias(c) for c in more))
        return F.struct(F.array_append(s["out"], row).alias("out"), l1.alias("l1"), l2.alias("l2"), l3.alias("l3"), roman.alias("roman"), level.alias("deep"))

    def step(s: Column, x: Column) -> Column:
        goes_on = F.when(s["roman"] > 0, x["value"] == s["roman"] + 1).otherwise((s["deep"] == 2) & (x["marker"] == "i"))
        level = F.when(x["plain"] > 0, x["plain"]).when(s["l2"].isNotNull() & goes_on, 3).otherwise(1)
        return F.get(F.transform(F.array(level), lambda lv: opened(s, x, lv)), 0)  # binds the level once

    folded = rows.select("doc_id", "section_line", F.explode(F.aggregate("rows", start, step, lambda s: s["out"])).alias("r"))
    return folded.select("doc_id", "section_line", "r.line_no", "r.level", "r.path", "r.parent_line", *(f"r.{c}" for c in more))


def render_citation(section: Column, path: Column) -> Column:
    return F.concat(F.lit("§ "), section, F.array_join(F.transform(path, lambda p: F.concat(F.lit("("), p, F.lit(")"))), ""))


def regulation_openings(lines: DataFrame, default_part: Column) -> DataFrame:
    """The lines that open a span, with its number, kind and bytes and the numbers of the section and subpart above: one
    shuffle by document, in which the windows share one order but for one by number; other lines and most texts end here."""
    role, c, earlier = F.col("role"), F.col("class"), before("line_no")
    last_marker = F.coalesce(F.last(F.when(role == "marker", F.col("line_no")), True).over(earlier), F.lit(-1))
    last_role = F.last(F.when(~role.isin("blank", "inside_note"), role), True).over(earlier)
    at = in_force(regulation_lines(lines, default_part), last_marker.alias("last_marker"), last_role.alias("last_role"))
    marked = (role == "marker") & F.col("section_line").isNotNull()
    # prose before any paragraph of its section opens a chapeau, again after a note, and goes on with one that is open
    chapeau = (role == "prose") & (F.col("last_marker") <= F.col("section_line")) & (F.col("last_role") != "prose")
    plain = role.isin("document_title", "toc_entry", "part_header", "authority", "source_note", "subpart_header", "section_header")
    at = at.withColumn("kind", F.when(plain, role).when(marked, "paragraph").when(chapeau, "section_chapeau")).filter("kind IS NOT NULL")
    w = by_doc("line_no")
    now, kind = w.rowsBetween(Window.unboundedPreceding, 0), F.col("kind")
    at = at.withColumn("seq", F.row_number().over(w)).withColumn("byte_end", F.coalesce(F.lead("byte_start").over(w), F.col("byte_count")))
    seen = lambda at_line, opener: F.when(F.col(at_line).isNotNull(), F.last(F.when(kind == opener, F.col("seq")), True).over(now))
    text = F.col("text")
    part = F.when(kind == "part_header", F.regexp_extract(text, rules.PART_HEADER, 1)).when(c == "part_toc", F.regexp_extract(text, rules.PART_TOC, 1))
    return at.select(
        "doc_id", "seq", "kind", "class", "home", "section", "subpart", "byte_start", "byte_end", F.coalesce("number", "section").alias("number"),
        seen("section_line", "section_header").alias("section_seq"), seen("subpart_line", "subpart_header").alias("subpart_seq"),
        F.when(kind == "paragraph", F.col("marker")).alias("marker"), part.alias("own_part"),
        F.when(c == "subpart_toc", F.regexp_extract(text, rules.SUBPART_TOC, 1)).alias("toc_subpart"),
        F.when(~kind.isin("paragraph", "section_chapeau", "section_header"), text).alias("text"),
    )


MARKER = r"^\(([a-z]|\d+|[ivxlcdm]+|[A-Z])\)"


def regulation_spans(lines: DataFrame, default_part: Column, title: str = "21") -> DataFrame:
    """doc_id, seq, span_id, kind, section, subpart, path, citation, byte_start, byte_end, parent_span_id, cite; text before the first span stays a gap.

    cite is the citation record: title, part, section, paragraphs, subpart, raw. A paragraph's parent is the paragraph
    above it or the section header; chapeaus and amendment notes hang under the section, sections under the subpart.
    Paragraphs are dealt by section for the fold of their markers and take their rows along; nothing is joined back.
    """
    at = stored(regulation_openings(lines, default_part))
    none = F.array().cast("array<string>")
    own = [c for c in at.columns if c not in ("doc_id", "marker")]
    rest = F.struct("seq", "home", "section", "subpart", "byte_start", "byte_end", "subpart_seq")  # what paragraphs differ in
    body = at.filter("kind = 'paragraph'").select("doc_id", F.col("section_seq").alias("section_line"), F.col("seq").alias("line_no"), "marker", rest.alias("rest"))
    same = (F.lit("paragraph").alias("kind"), F.lit("marker").alias("class"), F.col("rest.section").alias("number"), F.col("section_line").alias("section_seq"))
    folded = paragraph_paths(body).select("doc_id", "rest.*", *same, "path", F.col("parent_line").alias("above"))
    starts = at.filter("kind <> 'paragraph'").select("doc_id", *own, none.alias("path"), F.lit(None).cast("int").alias("above")).unionByName(folded, allowMissingColumns=True)
    number, kind, c = F.col("number"), F.col("kind"), F.col("class")
    amended = c == "amended"
    sectioned = kind.isin("section_header", "section_chapeau", "paragraph") | (kind == "toc_entry") & (c == "section")
    parent = F.when(kind == "paragraph", F.coalesce("above", "section_seq")).when((kind == "section_chapeau") | amended, F.col("section_seq")).when(sectioned, F.col("subpart_seq"))
    part = F.when(sectioned, F.coalesce(F.nullif(F.substring_index(number, ".", 1), F.lit("")), F.col("home"))).when(kind == "subpart_header", F.col("home")).otherwise(F.col("own_part"))
    raw = F.when(kind == "paragraph", render_citation(F.col("section"), F.col("path"))).when(kind == "section_chapeau", F.concat(F.lit("§ "), "section", F.lit(" chapeau"))).when(sectioned, F.concat(F.lit("§ "), number))
    raw = raw.when(amended, "amendment_note").when(kind == "subpart_header", F.concat(F.lit("Subpart "), "subpart")).when(kind == "part_header", F.concat(F.lit("PART "), part)).when(kind == "authority", "Authority").when(kind == "source_note", "Source").otherwise(F.col("text"))
    cite = F.struct(
        F.when(sectioned | kind.isin("subpart_header", "part_header"), F.lit(title)).alias("title"), part.alias("part"), F.when(sectioned, number).when(amended, F.col("section")).alias("section"),
        F.col("path").alias("paragraphs"), F.when(sectioned | (kind == "subpart_header"), F.col("subpart")).otherwise(F.col("toc_subpart")).alias("subpart"), raw.alias("raw"),
    )
    citation = F.coalesce(render_citation(number, F.col("path")), F.substring("text", 1, 60))
    told = lambda n: F.when(n.isNotNull(), numbered("S", 4, n))
    return starts.select(
        "doc_id", "byte_start", "kind", F.when(kind != "document_title", number).alias("section"), "subpart", "path", citation.alias("citation"), cite.alias("cite"),
        "seq", "byte_end", told(F.col("seq")).alias("span_id"), told(parent).alias("parent_span_id"),
    )
