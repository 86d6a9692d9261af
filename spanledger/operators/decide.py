"""What decisions lead to: open questions, the catalog's status, obligations outside of bearing spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import BEARING


class Unresolved(RuntimeError):
    """A catalog still has open questions."""


def require_resolved(counters: DataFrame) -> None:
    """Raises Unresolved with the counters (doc_id, ...) of the first documents that have open ones."""
    names = [c for c in counters.columns if c != "doc_id"]
    some: Column = F.lit(False)
    for c in names:
        some = some | (F.col(c) > 0)
    bad = counters.filter(some).orderBy("doc_id").limit(20).collect()
    if bad:
        raise Unresolved("; ".join(f"{r['doc_id']}: " + ", ".join(f"{c}={r[c]}" for c in names if r[c]) for r in bad))


def status(report: DataFrame, counters: DataFrame) -> DataFrame:
    """doc_id, status: completed if the audit passed and nothing is open, else in_progress."""
    names = [c for c in counters.columns if c != "doc_id"]
    open_ones = sum((F.coalesce(F.col(c), F.lit(0)) for c in names), F.lit(0))
    t = report.select("doc_id", "passed").join(counters, "doc_id", "left")
    return t.select("doc_id", F.when(F.col("passed") & (open_ones == 0), "completed").otherwise("in_progress").alias("status"))


def title_and_part(slug: Column) -> tuple[Column, Column]:
    """Title and part that a slug such as 45-cfr-part-164 names; 21 and 11 for others."""
    found = lambda g: F.nullif(F.regexp_extract(slug, r"^(\d+)-cfr-part-(\w+)$", g), F.lit(""))
    return F.coalesce(found(1), F.lit("21")), F.coalesce(found(2), F.lit("11"))


def outside_hits(hits: DataFrame, classes: DataFrame, least_permissive: tuple[str, ...] = ("May", "may")) -> DataFrame:
    """doc_id, span_id, verbs of hits (doc_id, span_id, verb) in spans that bear nothing; a source note with permissive verbs only is left out."""
    per = hits.groupBy("doc_id", "span_id").agg(F.array_sort(F.collect_set("verb")).alias("verbs"))
    t = per.join(classes.select("doc_id", "span_id", "final_label", "final_embedded"), ["doc_id", "span_id"], "left")
    bears = F.coalesce((F.col("final_label") == BEARING) | F.array_contains("final_embedded", BEARING), F.lit(False))
    strong = F.size(F.array_except("verbs", F.array(*map(F.lit, least_permissive)))) > 0
    return t.filter(~bears & (strong | (F.coalesce("final_label", F.lit("")) != "source_note"))).select("doc_id", "span_id", "verbs")
