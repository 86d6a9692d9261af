"""Decisions on a catalog, taken in order: what each record becomes, and which decisions counted, or why they did not.

All ids hold within a document: decisions (doc_id, id, seq, ...) only ever meet records of their own doc_id. A decision is
judged by its own row, by the record that it names and by what stands before it; then the record takes the last one that
counts (labels, edits), the first one (downgrades) or any (drops). These are aggregates that merge before the shuffle, so
no record's decisions are ever collected in one place. Every function returns the log beside the records: doc_id, id, seq,
outcome (what a decision that counts led to) and reason (why another was ignored).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.functions.text import LABELS, canonical_quote, canonical_quotes, clean_tags, coerce_modality, trim_unicode

from .annotate import mark_pending
from .audit import BEARING, is_bearing
from .graph import numbered_edges, stored, valid_edges
from .statements import EDGE_TYPES

# Decisions, and the reasons for which one is ignored.
KEEP, EDIT, DROP, CONFIRM, EXTRACT = "keep", "edit", "drop", "confirm_downgrade", "extract"
NOT_FOUND, INVALID_LABEL = "not found", "invalid label"
NO_PENDING, NO_ROWS, NO_SPAN = "no pending downgrade", "extract decision without requirements", "source span not found"
KEEPS_BEARING = "confirm_downgrade cannot keep requirement_bearing"
QUOTE_NOT_FOUND = "edited verbatim_quote not found in source span"
DROPPED_LAST = "requirement adjudicator dropped the span's last requirement"


def none() -> Column:
    return F.array().cast("array<string>")


def said(c: str) -> Column:
    """The column trimmed, null if nothing is left."""
    return F.nullif(trim_unicode(F.col(c)), F.lit(""))


def invalid(what: str, c: Column) -> Column:
    return F.concat(F.lit(f"invalid {what} "), F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None")))


def verdict(c: str = "decision") -> Column:
    return F.coalesce(trim_unicode(F.lower(F.col(c))), F.lit(""))


def latest(value: Column, counts: Column) -> Column:
    """value in the last row that counts and has one."""
    return F.max(F.when(counts & value.isNotNull(), F.struct(F.col("seq"), value.alias("value"))))["value"]


def found(decisions: DataFrame, records: DataFrame, key: str, *more: Column) -> DataFrame:
    """decisions with whether their document has such a record, and what else of it is asked for."""
    known = records.select("doc_id", key, *more).distinct().withColumn("known", F.lit(True))
    return decisions.join(known, ["doc_id", key], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def log_of(judged: DataFrame, key: str, outcome: Column) -> DataFrame:
    counts = F.col("reason").isNull()
    return judged.select("doc_id", F.col(key).alias("id"), "seq", F.when(counts, outcome).alias("outcome"), "reason")


def rule_classes(classes: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes and log. decisions: doc_id, span_id, seq, final_label, final_embedded, note. The last valid one gives the label and the embedded labels anew, sorted, and ends the ambiguity; the last note stands."""
    told = F.col("final_label")
    others = F.filter(F.coalesce("final_embedded", none()), lambda x: x.isNull() | (x != told))
    wrong = ~F.coalesce(told.isin(*LABELS), F.lit(False)) | F.exists(others, lambda x: x.isNull() | ~x.isin(*LABELS))
    judged = found(decisions, classes, "span_id").withColumn("others", others)
    judged = judged.withColumn("reason", F.when(~F.col("known"), NOT_FOUND).when(wrong, INVALID_LABEL))
    counts = F.col("reason").isNull()
    last = judged.groupBy("doc_id", "span_id").agg(
        latest(F.struct(told.alias("label"), F.array_sort(F.array_distinct("others")).alias("embedded")), counts).alias("new"),
        latest(said("note"), counts).alias("new_note"),
    )
    t = classes.join(last, ["doc_id", "span_id"], "left")
    has = F.col("new").isNotNull()
    t = t.withColumns({
        "final_label": F.coalesce("new.label", "final_label"), "final_embedded": F.coalesce("new.embedded", "final_embedded"),
        "ambiguous": F.col("ambiguous") & ~has,
    })
    if "note" in classes.columns:
        t = t.withColumn("note", F.coalesce("new_note", "note"))
    return t.select(*classes.columns), log_of(judged, "span_id", F.lit("updated"))


def rule_edges(edges: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges and log. decisions: doc_id, rel_id, seq, decision, type, evidence. Keep and edit both take a type and evidence that they give, and end the ambiguity; a drop is final. What is left is numbered anew by seq."""
    judged = found(decisions, edges, "rel_id", F.col("type").isin(*EDGE_TYPES).alias("typed"))
    judged = judged.withColumn("decision", verdict())
    decision, new = F.col("decision"), F.nullif("type", F.lit(""))
    gives = F.coalesce(new.isin(*EDGE_TYPES) & decision.isin(KEEP, EDIT), F.lit(False))
    before = Window.partitionBy("doc_id", "rel_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    typed = F.coalesce("typed", F.lit(False)) | F.coalesce(F.max(gives).over(before), F.lit(False))
    judged = judged.withColumn("typed", typed).withColumn("new_type", new)
    fits = F.when(F.col("new_type").isNull(), F.col("typed")).otherwise(F.col("new_type").isin(*EDGE_TYPES))
    reason = F.when(~F.col("known"), NOT_FOUND).when(decision == DROP, None).when(~decision.isin(KEEP, EDIT), invalid("decision", decision))
    judged = judged.withColumn("reason", reason.when(~fits, invalid("type", F.col("type"))))
    counts = F.col("reason").isNull() & (decision != DROP)
    last = judged.groupBy("doc_id", "rel_id").agg(
        F.bool_or(F.col("reason").isNull() & (decision == DROP)).alias("dropped"), F.bool_or(counts).alias("ruled"),
        latest(F.col("new_type"), counts).alias("new_type"), latest(F.nullif("evidence", F.lit("")), counts).alias("new_evidence"),
    )
    t = edges.join(last, ["doc_id", "rel_id"], "left").filter(~F.coalesce("dropped", F.lit(False)))
    t = t.withColumns({
        "type": F.coalesce("new_type", "type"), "evidence": F.coalesce("new_evidence", "evidence"),
        "ambiguous": F.col("ambiguous") & ~F.coalesce("ruled", F.lit(False)),
    })
    done = F.when(decision == DROP, "dropped").when(decision == EDIT, "edited").otherwise("kept")
    return numbered_edges(t.select(*edges.columns)), log_of(judged, "rel_id", done)


#: What an edit gives a statement anew.
EDITED = ("verbatim_quote", "atomic_statement", "modality", "subject", "object", "tags", "conditions")


def cleaned(c: str) -> Column:
    """A field of a statement as it is kept: texts trimmed, a known modality, tags and conditions without empty ones."""
    if c == "modality":
        return coerce_modality(F.col(c))
    if c == "tags":
        return clean_tags(F.coalesce(c, none()))
    if c == "conditions":
        return F.transform(F.filter(F.coalesce(c, none()), lambda x: x.isNotNull() & (x != "")), trim_unicode)
    return trim_unicode(F.coalesce(c, F.lit("")))


def rule_statements(statements: DataFrame, spans: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Statements and log. decisions: doc_id, req_id, seq, decision, and what an edit gives (EDITED, as far as there). An edit counts if the span has its quote, up to wraps and commas; then it replaces all of EDITED that the statements have. Keep and edit end the ambiguity and clear alternates; a drop is final."""
    texts = spans.select("doc_id", F.col("span_id").alias("source_span_id"), "text")
    ready = decisions.withColumn("decision", verdict())
    decision = F.col("decision")
    ready = ready.withColumn("verbatim_quote", F.when(decision == EDIT, cleaned("verbatim_quote")).otherwise(""))
    judged = found(ready, statements, "req_id", F.col("source_span_id")).join(texts, ["doc_id", "source_span_id"], "left")
    text = F.coalesce("text", F.lit(""))
    judged = judged.withColumn("verbatim_quote", canonical_quote(F.col("verbatim_quote"), text))
    has = (F.col("verbatim_quote") != "") & F.contains(text, F.col("verbatim_quote"))
    reason = F.when(~F.col("known"), NOT_FOUND).when(~decision.isin(KEEP, EDIT, DROP), invalid("decision", decision))
    judged = judged.withColumn("reason", reason.when((decision == EDIT) & ~has, QUOTE_NOT_FOUND)).drop("text")
    counts = F.col("reason").isNull()
    fields = [c for c in EDITED if c in statements.columns]
    given = lambda c: F.col(c) if c == "verbatim_quote" else cleaned(c) if c in decisions.columns else F.lit(None)
    last = judged.groupBy("doc_id", "req_id").agg(
        F.bool_or(counts & (decision == DROP)).alias("dropped"), F.bool_or(counts & (decision != DROP)).alias("ruled"),
        latest(F.struct(*(given(c).alias(c) for c in fields)), counts & (decision == EDIT)).alias("new"),
    )
    t = statements.join(last, ["doc_id", "req_id"], "left").filter(~F.coalesce("dropped", F.lit(False)))
    ruled = F.coalesce("ruled", F.lit(False))
    t = t.withColumns({c: F.when(F.col("new").isNotNull(), F.col("new")[c]).otherwise(F.col(c)) for c in fields})
    t = t.withColumn("ambiguous", F.col("ambiguous") & ~ruled)
    if "alternates" in statements.columns:
        t = t.withColumn("alternates", F.when(~ruled, F.col("alternates")))
    done = F.when(decision == DROP, "dropped").when(decision == EDIT, "edited").otherwise("kept")
    return t.select(*statements.columns), log_of(judged, "req_id", done)


def after_drops(classes: DataFrame, before: DataFrame, after: DataFrame, edges: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes and edges once statements are dropped: bearing spans that lost their last one wait for a downgrade, with the rationales of the drops (decisions: doc_id, req_id, seq, decision, rationale) in order; edges that dangle go."""
    spans = lambda df: df.select("doc_id", F.col("source_span_id").alias("span_id")).distinct()
    gone = before.join(after.select("doc_id", "req_id"), ["doc_id", "req_id"], "left_anti")
    orphans = spans(gone).join(spans(after), ["doc_id", "span_id"], "left_anti")
    why = decisions.filter(verdict() == DROP).withColumn("why", said("rationale")).filter("why IS NOT NULL")
    why = why.join(gone.select("doc_id", "req_id", F.col("source_span_id").alias("span_id")), ["doc_id", "req_id"])
    why = why.join(orphans, ["doc_id", "span_id"], "left_semi").groupBy("doc_id", "span_id").agg(F.array_sort(F.collect_list(F.struct("seq", "why"))).alias("whys"))
    why = why.select("doc_id", "span_id", F.array_join(F.transform("whys", lambda x: x["why"]), "; ").alias("why"))
    if "downgrade_pending" not in classes.columns:
        classes = classes.withColumn("downgrade_pending", F.lit(False))
    due = classes.join(orphans, ["doc_id", "span_id"], "left_semi").filter(is_bearing() & ~F.coalesce("downgrade_pending", F.lit(False)))
    rest = classes.join(due.select("doc_id", "span_id"), ["doc_id", "span_id"], "left_anti")
    reason = F.concat_ws(": ", F.lit(DROPPED_LAST), "why")
    waiting = mark_pending(due, after).join(why, ["doc_id", "span_id"], "left").withColumn("downgrade_reason", reason).drop("why")
    left = valid_edges(edges, after, "req_id")
    return rest.unionByName(waiting, allowMissingColumns=True), numbered_edges(left)


def rule_downgrades(classes: DataFrame, spans: DataFrame, statements: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, statements with those that are new, and log. decisions: doc_id, span_id, seq, decision, final_label, rows (array of structs of EDITED).

    A span that waits takes the first decision that counts; later ones find nothing that waits. A confirmation gives a
    bearing label up for the one named, else for the one proposed, else for administrative, and takes the new label and
    the bearing one out of the embedded labels; an embedded one is given up without a label. An extraction counts if the
    span has every quote, up to wraps and commas; its rows become statements, numbered on from the document's last.
    """
    own = [c for c in ("final_label", "downgrade_pending", "downgrade_proposal") if c in classes.columns]
    proposed = F.nullif(F.col("downgrade_proposal.proposed_label"), F.lit("")) if "downgrade_proposal" in own else F.lit(None).cast("string")
    held = classes.select(
        "doc_id", "span_id", (F.col("final_label") == BEARING).alias("primary"), proposed.alias("proposed"), F.lit(True).alias("known"),
        (F.col("downgrade_pending") if "downgrade_pending" in own else F.lit(False)).alias("waits"),
    )
    held = held.join(spans.select("doc_id", "span_id", "text"), ["doc_id", "span_id"], "left")
    ready = decisions.withColumn("decision", verdict())
    decision = F.col("decision")
    # an extraction's rows as they are kept, each quote as the span has it; other decisions have none
    ready = ready.withColumn("rows", F.when(decision == EXTRACT, F.col("rows")))
    judged = ready.join(held, ["doc_id", "span_id"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    judged = judged.withColumn("label", F.coalesce(F.nullif("final_label", F.lit("")), "proposed", F.lit("administrative")))
    given = F.transform("rows", lambda r: trim_unicode(F.coalesce(r["verbatim_quote"], F.lit(""))))
    judged = judged.withColumn("quotes", given).withColumn("quotes", canonical_quotes(F.col("quotes"), F.col("text")))
    absent = F.transform("quotes", lambda q: ~F.coalesce((q != "") & F.contains("text", q), F.lit(False)))
    judged = judged.withColumn("bad", F.nullif(F.array_position(absent, True), F.lit(0)) - 1)
    primary = F.coalesce("primary", F.lit(False))
    judged = judged.withColumn("reason", F.when(~F.col("known"), NOT_FOUND).when(~F.coalesce("waits", F.lit(False)), NO_PENDING)
        .when((decision == CONFIRM) & primary & ~F.col("label").isin(*LABELS), invalid("final_label", F.col("label")))
        .when((decision == CONFIRM) & primary & (F.col("label") == BEARING), KEEPS_BEARING)
        .when((decision == EXTRACT) & (F.coalesce(F.size("rows"), F.lit(0)) < 1), NO_ROWS)
        .when((decision == EXTRACT) & F.col("text").isNull(), NO_SPAN)
        .when((decision == EXTRACT) & F.col("bad").isNotNull(), F.concat(F.lit("requirements["), "bad", F.lit("]: verbatim_quote not found in source span")))
        .when(~decision.isin(CONFIRM, EXTRACT), invalid("decision", decision)))
    # the window deals the rows anew: what a decision that does not count brought along stays behind
    kept = lambda c: F.when(F.col("reason").isNull(), F.col(c)).alias(c)
    judged = judged.select("doc_id", "span_id", "seq", "decision", "reason", "known", kept("label"), kept("quotes"), kept("rows"))
    first = F.min(F.when(F.col("reason").isNull(), F.col("seq"))).over(Window.partitionBy("doc_id", "span_id"))
    judged = judged.withColumn("first", first)
    judged = judged.withColumn("reason", F.when(F.col("known") & (F.col("seq") > F.col("first")), NO_PENDING).otherwise(F.col("reason")))
    # judged once for classes, statements and log; only extractions that count go on with their rows
    judged = stored(judged.select("doc_id", "span_id", "seq", "decision", "reason", kept("label"), kept("quotes"), kept("rows")))
    counted = judged.filter("reason IS NULL")
    ruling = counted.select("doc_id", "span_id", "decision", "label")
    # its own column: inside a lambda, final_label would be the new one of the same select
    t = classes.join(ruling, ["doc_id", "span_id"], "left").withColumn("was_bearing", F.col("final_label") == BEARING)
    confirmed, primary = F.coalesce(decision == CONFIRM, F.lit(False)), F.col("was_bearing")
    embedded = F.filter(F.coalesce("final_embedded", none()), lambda x: (x != BEARING) & (~primary | (x != F.col("label"))))
    t = t.select(
        *(c for c in classes.columns if c not in ("final_label", "final_embedded", "ambiguous", "downgrade_pending")),
        F.when(confirmed & primary, F.col("label")).otherwise(F.col("final_label")).alias("final_label"),
        F.when(confirmed, embedded).otherwise(F.col("final_embedded")).alias("final_embedded"),
        (F.col("ambiguous") & ~confirmed).alias("ambiguous"),
        (F.col("downgrade_pending") & F.col("decision").isNull()).alias("downgrade_pending"),
        F.col("decision").alias("resolution"),
    )
    return t, statements.unionByName(extracted(counted, statements), allowMissingColumns=True), log_of(judged, "span_id", F.when(decision == CONFIRM, "confirmed").otherwise("extracted"))


def extracted(counted: DataFrame, statements: DataFrame) -> DataFrame:
    """The statements that the extractions among decisions that count add, in the order of the decisions and of their rows."""
    each = counted.filter(F.col("decision") == EXTRACT).select("doc_id", "span_id", "seq", "quotes", F.posexplode("rows").alias("pos", "row"))
    made = each.select("doc_id", "span_id", "seq", "pos", F.get("quotes", F.col("pos")).alias("verbatim_quote"), *(F.col("row")[c].alias(c) for c in EDITED[1:]))
    last = statements.groupBy("doc_id").agg(F.max(F.substring("req_id", 2, 20).try_cast("bigint")).alias("last"))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "span_id", "pos")) + F.coalesce("last", F.lit(0))
    out = made.join(last, "doc_id", "left").select(
        "doc_id", F.format_string("R%05d", number.cast("bigint")).alias("req_id"), F.col("span_id").alias("source_span_id"), F.col("verbatim_quote"),
        *(cleaned(c).alias(c) for c in EDITED[1:]), F.lit(False).alias("ambiguous"),
    )
    return out.select(*(c for c in out.columns if c in statements.columns))


def tally(logs: dict[str, DataFrame]) -> DataFrame:
    """doc_id, kind, outcome, reason, n: how many decisions of each kind led to what. Each kind's counts are written before the next kind is judged, so that what one takes to judge is gone by then."""
    out = None
    for kind, log in logs.items():
        own = stored(log.groupBy("doc_id", "outcome", "reason").agg(F.count(F.lit(1)).alias("n"))).withColumn("kind", F.lit(kind))
        out = own if out is None else out.unionByName(own)
    return out.select("doc_id", "kind", "outcome", "reason", "n")
