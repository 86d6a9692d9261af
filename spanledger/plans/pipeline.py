"""The document pipeline over a corpus of DataFrames: pages to canonical lines, spans, classes, statements, edges, audit.

Stages only compose DataFrames; what several later stages read is cut once by a checkpoint. Annotator output is input.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions import rules, text
from spanledger.operators import annotate, audit, graph, lines, segment
from spanledger.sources import sinks


class GateFailed(RuntimeError):
    """Documents did not pass the audit; the message names each with what is wrong."""


@dataclass(frozen=True)
class Corpus:
    """Tables of a run; a stage returns a corpus with more of them."""

    pages: DataFrame
    meta: DataFrame  # doc_id, title, citation_format, part
    annotations: DataFrame | None = None
    statements: DataFrame | None = None
    edges: DataFrame | None = None
    made: dict = field(default_factory=dict)

    def put(self, **tables: DataFrame) -> Corpus:
        return replace(self, made=self.made | tables)

    def __getitem__(self, name: str) -> DataFrame:
        return self.made[name]


def boilerplate(c: Corpus) -> Corpus:
    """Furniture out, margin numbers out, blank runs collapsed."""
    tagged = lines.tag_furniture(lines.pages_to_lines(c.pages))
    guideline = c.meta.filter("citation_format = 'ich'").select("doc_id", F.lit(True).alias("guideline"))
    tagged = tagged.join(guideline, "doc_id", "left").withColumn("rule_id", F.coalesce("rule_id", F.when(F.col("guideline"), text.first_rule(F.col("line"), rules.GUIDELINE_FURNITURE)))).drop("guideline")
    tagged = graph.cut(lines.tag_titles(tagged, c.meta.select("doc_id", "title")))
    content = lines.strip_margin_numbers(tagged.filter("rule_id IS NULL").select("doc_id", "line_no", "line"))
    clean = graph.cut(lines.collapse_blanks(content.select("doc_id", "line_no", "line")))
    return c.put(stripped=tagged.filter("rule_id IS NOT NULL"), lines=clean, canonical=lines.join_lines(clean))


def segmentation(c: Corpus) -> Corpus:
    """Spans by the document's citation format; without one, or an unknown one, the regulation rules."""
    form = c.meta.select("doc_id", F.coalesce("citation_format", F.lit("cfr")).alias("form"), F.coalesce("part", F.lit("11")).alias("part"))
    at = c["lines"].join(form, "doc_id")
    of = lambda *names: at.filter(F.col("form").isin(*names)).select("doc_id", "line_no", "line", "part")
    none, path = F.lit(None).cast("string"), F.array().cast("array<string>")
    generic = segment.generic_spans(of("generic").drop("part")).select("doc_id", "seq", "span_id", "kind", none.alias("section"), path.alias("path"), "byte_start", "byte_end")
    ich = segment.guideline_spans(of("ich").drop("part")).select("doc_id", "seq", "span_id", "kind", "section", path.alias("path"), "byte_start", "byte_end")
    rest = at.filter(~F.col("form").isin("generic", "ich")).select("doc_id", "line_no", "line", "part")
    cfr = segment.regulation_spans(rest, F.col("part")).select("doc_id", "seq", "span_id", "kind", "section", "path", "byte_start", "byte_end")
    spans = graph.cut(generic.unionByName(ich).unionByName(cfr))
    return c.put(spans=with_text(spans, c["lines"]))


def with_text(spans: DataFrame, at: DataFrame) -> DataFrame:
    """spans with their text, joined of whole lines, so that no character is cut."""
    offsets = lines.with_offsets(at)
    hits = offsets.select("doc_id", F.col("byte_start").alias("at"), "line_no", "line")
    held = audit.containing_span(hits, spans).filter("span_id IS NOT NULL")
    texts = held.groupBy("doc_id", "span_id").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))
    return graph.cut(spans.join(texts, ["doc_id", "span_id"], "left"))


def classification(c: Corpus) -> Corpus:
    """Reconciled labels; degenerate spans are structural and need no annotator."""
    flat = c["spans"].filter(text.is_degenerate(F.col("text"))).select("doc_id", "span_id")
    asked = c.annotations.join(flat, ["doc_id", "span_id"], "left_anti")
    empty = F.array().cast("array<string>")
    auto = flat.select("doc_id", "span_id", F.lit("structural").alias("label_a"), F.lit("structural").alias("label_b"), empty.alias("embedded_a"), empty.alias("embedded_b"), F.lit("structural").alias("final_label"), empty.alias("final_embedded"), F.lit(False).alias("ambiguous"))
    return c.put(classes=graph.cut(annotate.mark_pending(annotate.reconcile(asked).unionByName(auto), c.statements)))


def gate(c: Corpus, strict: bool = True) -> Corpus:
    sizes = c["canonical"].select("doc_id", F.col("byte_count").alias("total_bytes"))
    report = graph.cut(audit.gate(sizes, c["spans"], c["classes"], c.statements))
    if strict and (bad := report.filter(~F.col("passed")).orderBy("doc_id").limit(20).collect()):
        raise GateFailed("; ".join(f"{r['doc_id']}: {r['message']}" for r in bad))
    return c.put(audit=report)


def relations(c: Corpus) -> Corpus:
    """Valid edges, once each, with cycles marked."""
    nodes = c.statements.select("doc_id", "req_id")
    once = graph.first_wins(c.edges, ["doc_id", "src", "dst", "type"], ["seq"])
    return c.put(edges=graph.mark_cycles(graph.valid_edges(once, nodes, "req_id").filter("src <> dst")))


STAGES = (("boilerplate", boilerplate), ("segment", segmentation), ("classify", classification), ("audit", gate), ("relate", relations))


def run(corpus: Corpus, only: tuple[str, ...] = (), strict: bool = True, log: str | None = None, run_id: str | None = None) -> Corpus:
    """The stages in order, or those named. log names a table to which every stage adds a row when it ends, and when it fails: stage, status, seconds, tables made with their rows, error."""
    run_id = run_id or uuid.uuid4().hex
    for name, stage in STAGES:
        if only and name not in only:
            continue
        began, before, error = time.monotonic(), set(corpus.made), None
        try:
            corpus = stage(corpus, strict) if stage is gate else stage(corpus)
        except Exception as e:
            error = f"{name}: {e}"
            raise
        finally:
            if log:
                made = {t: corpus.made[t].count() for t in sorted(set(corpus.made) - before)} if error is None else {}
                sinks.append(sinks.run_row(corpus.pages.sparkSession, run_id, name, time.monotonic() - began, made, error), log)
    return corpus
