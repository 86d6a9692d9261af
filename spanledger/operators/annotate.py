"""Labels of independent annotators: reconcile, keep disagreement, mark what waits for a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import BEARING, is_bearing


def reconcile(annotations: DataFrame, third: DataFrame | None = None, enforce_union: bool = False) -> DataFrame:
    """One row per (doc_id, span_id) of annotations (doc_id, span_id, agent, label, embedded).

    Two equal labels are final, with the union of the embedded ones. Different labels take the third annotator's row
    (agent r) and stay ambiguous; without one the first label stands, ambiguous. enforce_union joins the embedded
    labels of all three, which the third row alone decides otherwise.
    """
    empty = F.array().cast("array<string>")
    of = lambda a, c: F.max(F.when(F.col("agent") == a, F.col(c)))
    both = annotations.groupBy("doc_id", "span_id").agg(of("a", "label").alias("label_a"), of("b", "label").alias("label_b"), of("a", "embedded").alias("embedded_a"), of("b", "embedded").alias("embedded_b"))
    if third is None:
        third = annotations.filter(F.col("agent") == "r").select("doc_id", "span_id", "label", "embedded")
    third = third.select("doc_id", "span_id", F.col("label").alias("label_r"), F.col("embedded").alias("embedded_r"))
    t = both.join(third, ["doc_id", "span_id"], "left").withColumns({c: F.coalesce(F.col(c), empty) for c in ("embedded_a", "embedded_b")})
    agree = F.col("label_a").eqNullSafe(F.col("label_b"))
    union = F.array_sort(F.array_union("embedded_a", "embedded_b"))
    told = F.coalesce("embedded_r", empty)
    told = F.array_sort(F.array_union(told, union)) if enforce_union else told
    final = F.when(agree, F.col("label_a")).otherwise(F.coalesce("label_r", "label_a", "label_b"))
    embedded = F.when(agree, union).when(F.col("label_r").isNotNull(), told).otherwise(union)
    return t.select("doc_id", "span_id", "label_a", "label_b", "embedded_a", "embedded_b", final.alias("final_label"), embedded.alias("final_embedded"), (~agree).alias("ambiguous"))


def same_multiset(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, equal: whether both sides hold the same trimmed values as often. Counted by value, so that no group is ever one row."""
    one = lambda df, n: df.select(*keys, F.trim(F.coalesce(value, F.lit(""))).alias("value"), F.lit(n).alias("n"))
    more = one(left, 1).unionByName(one(right, -1)).groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    return more.groupBy(*keys).agg(F.bool_and(F.col("n") == 0).alias("equal"))


def mark_pending(classes: DataFrame, statements: DataFrame) -> DataFrame:
    """classes with downgrade_pending and a proposal for bearing spans that have no statement; labels stay. Running it again changes nothing."""
    owned = statements.select("doc_id", F.col("source_span_id").alias("span_id"), F.lit(True).alias("owned")).distinct()
    primary = F.col("final_label") == BEARING
    others = F.filter(F.coalesce("final_embedded", F.array().cast("array<string>")), lambda x: x != BEARING)
    label = F.when(primary, F.coalesce(F.get(others, 0), F.lit("administrative"))).otherwise(F.col("final_label"))
    proposal = F.struct(F.when(primary, "primary").otherwise("embedded").alias("kind"), label.alias("proposed_label"), F.filter(others, lambda x: ~primary | (x != label)).alias("proposed_embedded"))
    t = classes.drop("downgrade_pending", "downgrade_proposal") if "downgrade_pending" in classes.columns else classes
    due = F.col("owned").isNull() & F.col("doc_id").isNotNull() & F.col("span_id").isNotNull() & is_bearing()
    t = t.join(owned, ["doc_id", "span_id"], "left").withColumn("downgrade_pending", F.coalesce(due, F.lit(False)))
    return t.withColumn("downgrade_proposal", F.when(F.col("downgrade_pending"), proposal)).drop("owned")


def promote_embedded(classes: DataFrame, found: DataFrame) -> DataFrame:
    """classes with the bearing label embedded, sorted, and ambiguous where found (doc_id, span_id) says so."""
    hit = found.select("doc_id", "span_id").distinct().withColumn("hit", F.lit(True))
    t = classes.join(hit, ["doc_id", "span_id"], "left")
    more = F.array_sort(F.array_union(F.coalesce("final_embedded", F.array().cast("array<string>")), F.array(F.lit(BEARING))))
    return t.withColumn("final_embedded", F.when(F.col("hit"), more).otherwise(F.col("final_embedded"))).withColumn("ambiguous", F.col("ambiguous") | F.coalesce("hit", F.lit(False))).drop("hit")


def audit_candidates(spans: DataFrame, classes: DataFrame, guard_degenerate: bool = True, audited: DataFrame | None = None) -> DataFrame:
    """Spans that are classified, bear nothing and yet hold a signal; a permissive modal in a source note or a date is none. audited (doc_id, span_id) were asked before."""
    from spanledger.functions import rules
    from spanledger.functions.signals import blank_dates
    from spanledger.functions.text import is_degenerate

    strong = F.lit(False)
    weak = F.lit(False)
    for _, kind, rx in rules.SIGNALS:
        if kind == "modal_permissive":
            weak = weak | blank_dates(F.col("text")).rlike(rx)
        else:
            strong = strong | F.col("text").rlike(rx)
    at = spans.join(classes.filter(~is_bearing()), ["doc_id", "span_id"])
    if audited is not None:
        at = at.join(audited, ["doc_id", "span_id"], "left_anti")
    at = at.filter(strong | weak & (F.col("final_label") != "source_note"))
    return at.filter(~is_degenerate(F.col("text"))) if guard_degenerate else at


def unresolved(classes: DataFrame, statements: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id and the counters that must be zero before a catalog is final."""
    pending: Column = F.coalesce("downgrade_pending", F.lit(False))
    tables = (classes.groupBy("doc_id").agg(F.count_if("ambiguous").alias("classes"), F.count_if(pending).alias("downgrades")), statements.groupBy("doc_id").agg(F.count_if("ambiguous").alias("statements")), edges.groupBy("doc_id").agg(F.count_if("ambiguous").alias("edges")))
    out = tables[0].join(tables[1], "doc_id", "full").join(tables[2], "doc_id", "full")
    return out.na.fill(0)
