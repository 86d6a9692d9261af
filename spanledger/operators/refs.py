"""Citations across documents: found in text, resolved to spans, counted where they lead nowhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions import rules


#: Passes whose citations lead to spans; those of the others lead to documents.
TO_SPAN = (1, 4)
#: Rows of part_docs up to which they are broadcast.
PARTS = 500_000


def matches(text: Column, pattern: str, groups: int) -> Column:
    """Groups of all matches of a pattern, in order: array of structs g0 (the whole), g1, ..."""
    lists = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in range(groups + 1)]
    return F.arrays_zip(*lists)


def citations(spans: DataFrame) -> DataFrame:
    """doc_id, span_id, pass, pos, part, section, paras, citation, alone of spans (doc_id, span_id, text), of which ids are keys: sections, ranges, parts, full citations. alone: no other citation of the span can lead to the same place, a span or a document."""
    text, none = F.col("text"), F.lit(None).cast("string")

    def found(n: int, pattern: str, groups: int, section: str | None, paras: str | None) -> Column:
        def one(m: Column, pos: Column) -> Column:
            sec = F.concat_ws(".", m["g1"], m[section]) if section else none
            inside = F.regexp_extract_all(m[paras], F.lit(r"\(([a-z0-9]+)\)"), F.lit(1)) if paras else F.array().cast("array<string>")
            return F.struct(F.lit(n).alias("pass"), pos.alias("pos"), m["g1"].alias("part"), sec.alias("section"), inside.alias("paras"), m["g0"].alias("citation"))

        return F.when(text.rlike(pattern), F.transform(matches(text, pattern, groups), one))

    passes = (found(1, rules.CITE_SECTION, 3, "g2", "g3"), found(2, rules.CITE_RANGE, 3, "g2", None), found(3, rules.CITE_PART, 1, None, None), found(4, rules.CITE_FULL, 2, "g2", None))
    # all passes over a text that is read once
    each = spans.select("doc_id", "span_id", F.flatten(F.array_compact(F.array(*passes))).alias("all"))
    to_spans = F.size(F.filter("all", lambda m: m["pass"].isin(*TO_SPAN)))
    # explode alone would work all passes out once more, in a filter that the planner adds
    each = each.select("doc_id", "span_id", F.explode_outer("all").alias("m"), to_spans.alias("to_spans"), (F.size("all") - to_spans).alias("to_docs")).filter("m IS NOT NULL")
    return each.select("doc_id", "span_id", "m.*", (F.when(F.col("m.pass").isin(*TO_SPAN), F.col("to_spans")).otherwise(F.col("to_docs")) == 1).alias("alone"))


def resolve(cites: DataFrame, spans: DataFrame, part_docs: DataFrame, *more: str) -> DataFrame:
    """cites with target_doc and target_span: the longest prefix of the cited path that a span has, then the section's header; of several such spans the last.

    part_docs: part, doc_id of the documents that can be cited. Spans have doc_id, seq, span_id, kind, section, path;
    those of their columns that more names come as target_kind and so on. Citations without a document or section are
    moved nowhere. Where no citation names a paragraph, the others meet headers alone, else all spans of their sections.
    """
    known = part_docs.select("part", F.col("doc_id").alias("target_doc"))
    known = F.broadcast(known) if part_docs.limit(PARTS + 1).count() <= PARTS else known
    target = cites.join(known, "part", "left").select(*cites.columns, "target_doc")
    asks = F.col("target_doc").isNotNull() & F.col("section").isNotNull()
    found = F.struct(F.col("span_id").alias("span"), *more)
    deep = cites.filter(F.col("section").isNotNull() & (F.size("paras") > 0)).head(1)
    if deep:
        at = by_section(target.filter(asks), spans, found)
    else:
        headers = spans.filter(is_header()).groupBy(F.col("doc_id").alias("target_doc"), "section").agg(F.max_by(found, "seq").alias("to"))
        at = target.filter(asks).join(headers, ["target_doc", "section"], "left")
    at = at.unionByName(target.filter(~asks), allowMissingColumns=True)
    return at.select(*target.columns, F.col("to.span").alias("target_span"), *(F.col(f"to.{c}").alias(f"target_{c}") for c in more))


def is_header() -> Column:
    return (F.col("kind") == "section_header") & (F.size("path") == 0) & F.col("section").isNotNull()


def by_section(asks: DataFrame, spans: DataFrame, found: Column) -> DataFrame:
    """asks (target_doc, section, paras, ...) with to, what was found. Both sides are dealt once by document and section; there each
    prefix of a path meets the last span of that path, and the longest that met one counts."""
    key, own = ["target_doc", "section"], [c for c in asks.columns if c not in ("target_doc", "section")]
    held = spans.filter("section IS NOT NULL").select(F.col("doc_id").alias("target_doc"), "section", F.array_join("path", "/").alias("path"), "seq", found.alias("entry"), is_header().alias("header"))
    both = held.unionByName(asks.select(*key, F.struct(*own).alias("ask")), allowMissingColumns=True).repartition(*key)
    paras = F.col("ask.paras")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(paras)), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(paras, 1, k), "/").alias("path")))
    asked = F.col("ask").isNotNull()
    each = both.select(*key, "seq", "entry", "header", "ask", F.explode(F.when(asked, prefixes).otherwise(F.array(F.struct(F.lit(0).alias("k"), F.col("path").alias("path"))))).alias("p"))
    w = Window.partitionBy(*key, F.col("p.path")).orderBy(asked, "seq").rowsBetween(Window.unboundedPreceding, 0)
    met = each.withColumns({"by_path": F.last("entry", True).over(w), "by_header": F.last(F.when(F.col("header"), F.col("entry")), True).over(w)}).filter(asked)
    k, deep = F.col("p.k"), F.size("ask.paras") > 0
    best = met.groupBy(*key, "ask").agg(
        F.max_by("by_path", F.when(deep & F.col("by_path").isNotNull(), k)).alias("by_path"), F.max_by("by_header", F.when(k == 0, k)).alias("by_header"), F.count_if(k == 0).alias("times"),
    )
    out = best.withColumn("to", F.coalesce("by_path", "by_header")).withColumn("time", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    return out.select(*key, "ask.*", "to")


def cross_refs(cites: DataFrame, spans: DataFrame, part_docs: DataFrame) -> DataFrame:
    """source_doc, source_span, target_doc, target_span, ref_type, citation, auto_resolved.

    Citations of the own part are skipped. Section and full citations resolve to spans, ranges and parts to documents.
    Resolved ones are kept once per source span and target, the first in order of pass and place; unresolved sections
    and parts are kept as often as they stand, unresolved ranges and full citations are dropped. Only citations that are
    not alone in their span are dealt by span for this, unless parts or documents stand in part_docs more than once.
    """
    own = part_docs.select(F.col("doc_id"), F.col("part").alias("own_part"))
    n, parts, docs = part_docs.agg(F.count(F.lit(1)), F.countDistinct("part"), F.countDistinct("doc_id")).first()
    own = F.broadcast(own) if n <= PARTS else own
    # before anything is looked up: what is skipped need not be moved
    cites = cites.join(own, "doc_id", "left").filter(F.col("own_part").isNull() | (F.col("part") != F.col("own_part"))).drop("own_part")
    t = resolve(cites, spans, part_docs)
    to_span = F.col("pass").isin(*TO_SPAN)
    done = F.when(to_span, F.col("target_span").isNotNull()).otherwise(F.col("target_doc").isNotNull())
    t = t.withColumn("auto_resolved", done).withColumn("target_span", F.when(to_span, F.col("target_span"))).withColumn("ref_type", F.when(to_span, "section").otherwise("part"))
    t = t.withColumn("target_doc", F.when(F.col("auto_resolved"), F.col("target_doc")))
    t = t.filter(F.col("auto_resolved") | F.col("pass").isin(1, 3))
    # one window for sections, which have a target span, and parts, which have none: the rows resolved are made once
    w = Window.partitionBy("doc_id", "span_id", "target_doc", "target_span", "ref_type", "auto_resolved").orderBy("pass", "pos")
    once = lambda df: df.withColumn("rn", F.row_number().over(w)).filter(~F.col("auto_resolved") | (F.col("rn") == 1)).drop("rn")
    kept = t.filter("alone").unionByName(once(t.filter("NOT alone"))) if "alone" in t.columns and n == parts == docs else once(t)
    return kept.select(F.col("doc_id").alias("source_doc"), F.col("span_id").alias("source_span"), "target_doc", "target_span", "ref_type", "part", "citation", "auto_resolved")


def triage(refs: DataFrame, processed: DataFrame, domains: DataFrame | None = None, core: tuple = (), exclude: tuple = (), defer: tuple = (), min_docs: int = 2, min_refs: int = 5) -> DataFrame:
    """part, n_refs, n_docs, decision, reason of unresolved references; domains (part, domain) is optional configuration, core, exclude and defer name domains."""
    from spanledger.functions.text import cited_part

    stats = refs.filter(~F.col("auto_resolved")).withColumn("part", cited_part(F.col("citation"))).filter("part IS NOT NULL").groupBy("part").agg(F.count(F.lit(1)).alias("n_refs"), F.countDistinct("source_doc").alias("n_docs"))
    done = processed.select("part").distinct().withColumn("done", F.lit(True))
    t = stats.join(done, "part", "left")
    t = t.join(domains, "part", "left") if domains is not None else t.withColumn("domain", F.lit(None).cast("string"))
    domain = F.coalesce("domain", F.lit("unknown"))
    often = (F.col("n_docs") >= min_docs) & (F.col("n_refs") >= min_refs)
    decision = F.when(F.col("done"), "already_processed").when(domain.isin(*exclude) if exclude else F.lit(False), "exclude").when(domain.isin(*core) if core else F.lit(False), "process").otherwise("defer")
    reason = F.when(F.col("done"), "processed").when(decision != "defer", domain).when(domain.isin(*defer) if defer else F.lit(False), "peripheral").when(often, "cited often").otherwise("low context")
    return t.select("part", "n_refs", "n_docs", decision.alias("decision"), reason.alias("reason"))


def first_examples(rows: DataFrame, key: str, order: list, n: int = 5) -> DataFrame:
    """The first n rows of each key, numbered."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def fan_out(refs: DataFrame, statements: DataFrame, intra: DataFrame | None = None) -> DataFrame:
    """Edges src, dst, scope, type, src_doc, dst_doc, each once: intra (the same columns), then those between all statements of both spans of a reference."""
    of = statements.select("doc_id", "source_span_id", F.concat_ws(":", "doc_id", "req_id").alias("id"))
    left = of.select(F.col("doc_id").alias("source_doc"), F.col("source_span_id").alias("source_span"), F.col("id").alias("src"))
    right = of.select(F.col("doc_id").alias("target_doc"), F.col("source_span_id").alias("target_span"), F.col("id").alias("dst"))
    pairs = refs.filter("auto_resolved AND target_span IS NOT NULL").join(left, ["source_doc", "source_span"]).join(right, ["target_doc", "target_span"])
    made = pairs.select("src", "dst", F.lit("cross").alias("scope"), F.lit("references").alias("type"), F.col("source_doc").alias("src_doc"), F.col("target_doc").alias("dst_doc")).distinct()
    return made if intra is None else intra.select(made.columns).distinct().unionByName(made)


def atomic_map(refs: DataFrame, statements: DataFrame, intra: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes (id, doc_id), edges and stats (n_nodes, n_edges, n_intra, n_cross) of the map over all documents."""
    nodes = statements.select(F.concat_ws(":", "doc_id", "req_id").alias("id"), "doc_id")
    edges = fan_out(refs, statements, intra)
    counted = edges.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if(F.col("scope") == "intra").alias("n_intra"), F.count_if(F.col("scope") == "cross").alias("n_cross"))
    return nodes, edges, nodes.agg(F.count(F.lit(1)).alias("n_nodes")).crossJoin(counted)
