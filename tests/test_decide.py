"""Decisions on classes, edges, statements and downgrades; ids hold within a document."""

import pytest
from pyspark.sql import functions as F

from spanledger.operators import decide, graph, rulings

SPANS = "doc_id int, span_id string, text string"
CLASSES = "doc_id int, span_id string, final_label string, final_embedded array<string>, ambiguous boolean, downgrade_pending boolean"
STATEMENTS = "doc_id int, seq int, req_id string, source_span_id string, verbatim_quote string, ambiguous boolean"


def spans(spark):
    return spark.createDataFrame([(1, "S1", "Firms shall keep records."), (1, "S2", "Nothing here.")], SPANS)


def logged(log):
    return {(r.doc_id, r.id, r.seq): r.outcome or r.reason for r in log.collect()}


def test_statement_decisions(spark):
    st = spark.createDataFrame([(1, i, f"R{i}", "S1", "shall keep", True) for i in range(1, 5)] + [(2, 1, "R1", "S1", "q", True)], STATEMENTS)
    rows = [(1, "R1", 1, "drop", None), (1, "R1", 2, "keep", None), (1, "R2", 1, " Edit", "keep records "), (1, "R3", 1, "edit", "not there"), (1, "R9", 1, "drop", None), (1, "R4", 1, None, None)]
    out, log = rulings.rule_statements(st, spans(spark), spark.createDataFrame(rows, "doc_id int, req_id string, seq int, decision string, verbatim_quote string"))
    got = {(r.doc_id, r.req_id): (r.verbatim_quote, r.ambiguous) for r in out.collect()}
    assert got == {(1, "R2"): ("keep records", False), (1, "R3"): ("shall keep", True), (1, "R4"): ("shall keep", True), (2, "R1"): ("q", True)}
    want = {(1, "R1", 1): "dropped", (1, "R1", 2): "kept", (1, "R2", 1): "edited", (1, "R3", 1): rulings.QUOTE_NOT_FOUND, (1, "R9", 1): "not found", (1, "R4", 1): "invalid decision ''"}
    assert logged(log) == want


def test_drops_orphan_spans_and_edges(spark):
    before = spark.createDataFrame([(1, 1, "R1", "S1", "q", False), (1, 2, "R2", "S2", "q", False), (2, 1, "R1", "S1", "q", False)], STATEMENTS)
    classes = spark.createDataFrame([(1, "S1", "requirement_bearing", [], False, False), (1, "S2", "requirement_bearing", [], False, False), (2, "S1", "requirement_bearing", [], False, False)], CLASSES)
    edges = spark.createDataFrame([(1, 1, "E0001", "R1", "R2"), (1, 2, "E0002", "R2", "R2"), (2, 1, "E0001", "R2", "R1")], "doc_id int, seq int, rel_id string, src string, dst string")
    drops = spark.createDataFrame([(1, "R1", 1, "drop", "twice"), (2, "R2", 1, "drop", "elsewhere")], "doc_id int, req_id string, seq int, decision string, rationale string")
    c, e = rulings.after_drops(classes, before, before.filter("NOT (doc_id = 1 AND req_id = 'R1')"), edges, drops)
    assert {(r.doc_id, r.span_id): r.downgrade_reason for r in c.collect()} == {(1, "S1"): rulings.DROPPED_LAST + ": twice", (1, "S2"): None, (2, "S1"): None}
    assert {(r.doc_id, r.span_id) for r in c.filter("downgrade_pending").collect()} == {(1, "S1")}
    assert [(r.doc_id, r.rel_id, r.seq) for r in e.collect()] == [(1, "E0001", 2)]


def extraction(*quotes):
    return [(q, "s", None, None, None, None, None) for q in quotes]


DOWNGRADES = "doc_id int, span_id string, seq int, decision string, final_label string, rows array<struct<verbatim_quote:string,atomic_statement:string,modality:string,subject:string,object:string,tags:array<string>,conditions:array<string>>>"


def test_downgrade_decisions(spark):
    classes = spark.createDataFrame([(1, "S1", "requirement_bearing", ["requirement_bearing"], True, True), (1, "S2", "requirement_bearing", ["administrative"], True, True), (2, "S1", "definition", ["requirement_bearing"], True, True), (2, "S2", "requirement_bearing", [], True, True)], CLASSES)
    texts = spans(spark).unionByName(spans(spark).withColumn("doc_id", F.lit(2)))
    st = spark.createDataFrame([(1, 7, "R00007", "S9", "q", False)], STATEMENTS)
    rows = [
        (1, "S1", 1, "extract", None, extraction("absent")), (1, "S1", 2, "extract", None, extraction("shall  keep", "Firms")), (1, "S1", 3, "confirm_downgrade", None, []),
        (1, "S2", 1, "confirm_downgrade", "requirement_bearing", None), (1, "S2", 2, "confirm_downgrade", "bogus", None), (1, "S2", 3, "confirm_downgrade", None, None),
        (2, "S1", 1, "confirm_downgrade", "requirement_bearing", None), (2, "S2", 1, "extract", None, []), (2, "S2", 2, "later", None, None), (2, "S8", 1, "extract", None, None),
    ]
    got, made, log = rulings.rule_downgrades(classes, texts, st, spark.createDataFrame(rows, DOWNGRADES))
    assert {(r.doc_id, r.span_id): (r.final_label, r.final_embedded, r.ambiguous, r.downgrade_pending) for r in got.collect()} == {
        (1, "S1"): ("requirement_bearing", ["requirement_bearing"], True, False), (1, "S2"): ("administrative", [], False, False),
        (2, "S1"): ("definition", [], False, False), (2, "S2"): ("requirement_bearing", [], True, True),
    }
    assert sorted((r.doc_id, r.req_id, r.source_span_id, r.verbatim_quote) for r in made.collect()) == [(1, "R00007", "S9", "q"), (1, "R00008", "S1", "shall keep"), (1, "R00009", "S1", "Firms")]
    told = logged(log)
    assert told[1, "S1", 1] == "requirements[0]: verbatim_quote not found in source span" and told[1, "S1", 2] == "extracted" and told[1, "S1", 3] == rulings.NO_PENDING
    assert told[1, "S2", 1] == rulings.KEEPS_BEARING and told[1, "S2", 2] == "invalid final_label 'bogus'" and told[1, "S2", 3] == "confirmed"
    assert told[2, "S1", 1] == "confirmed" and told[2, "S2", 1] == rulings.NO_ROWS and told[2, "S2", 2] == "invalid decision 'later'" and told[2, "S8", 1] == "not found"


def test_decisions_stay_in_their_document(spark):
    kind = "doc_id int, rel_id string, seq int, src string, dst string, type string, evidence string, ambiguous boolean"
    edges = spark.createDataFrame([(d, f"E000{i}", i, "R1", "R2", "references", "e", True) for d in (1, 2) for i in (1, 2, 3)], kind)
    rows = [(1, "E0001", 1, "drop", None, None), (1, "E0001", 2, "keep", None, None), (1, "E0002", 1, "keep", "refines", ""), (2, "E0002", 1, "nonsense", "refines", None), (2, "E0003", 1, "edit", "no_such_type", None), (2, "E0003", 2, "edit", None, "told")]
    out, log = rulings.rule_edges(edges, spark.createDataFrame(rows, "doc_id int, rel_id string, seq int, decision string, type string, evidence string"))
    got = {(r.doc_id, r.rel_id, r.seq): (r.type, r.evidence, r.ambiguous) for r in out.collect()}
    plain = ("references", "e", True)
    assert got == {(1, "E0001", 2): ("refines", "e", False), (1, "E0002", 3): plain, (2, "E0001", 1): plain, (2, "E0002", 2): plain, (2, "E0003", 3): ("references", "told", False)}
    assert logged(log)[2, "E0002", 1] == "invalid decision 'nonsense'" and logged(log)[2, "E0003", 1] == "invalid type 'no_such_type'"
    classes = spark.createDataFrame([(d, "S1", "definition", ["structural"], True, False) for d in (1, 2)], CLASSES)
    rows = [(1, "S1", 1, "administrative", ["scope_inclusion", "administrative"], None), (1, "S1", 2, "bogus", [], None), (2, "S1", 1, "structural", [None], None), (2, "S1", 2, None, None, None)]
    out, log = rulings.rule_classes(classes, spark.createDataFrame(rows, "doc_id int, span_id string, seq int, final_label string, final_embedded array<string>, note string"))
    assert {r.doc_id: (r.final_label, r.final_embedded, r.ambiguous) for r in out.collect()} == {1: ("administrative", ["scope_inclusion"], False), 2: ("definition", ["structural"], True)}
    assert [r.reason for r in log.orderBy("doc_id", "seq").collect()] == [None, rulings.INVALID_LABEL, rulings.INVALID_LABEL, rulings.INVALID_LABEL]


def test_edges_and_cycles_stay_in_their_document(spark):
    kind = "doc_id string, src string, dst string, type string, evidence string, ambiguous boolean"
    edges = spark.createDataFrame([("A", "R1", "R2", "refines", "e", False), ("B", "R2", "R1", "refines", "e", False), ("B", "R1", "R1", "refines", "e", False)], kind)
    assert {(r.doc_id, r.src, r.dst) for r in graph.mark_cycles(edges).filter("ambiguous").collect()} == {("B", "R1", "R1")}
    nodes = spark.createDataFrame([("A", "R1"), ("A", "R2"), ("B", "R1")], "doc_id string, req_id string")
    assert {(r.doc_id, r.src) for r in graph.valid_edges(edges, nodes, "req_id").collect()} == {("A", "R1"), ("B", "R1")}
    assert {(r.doc_id, r.src, r.failure) for r in graph.edge_failures(edges, nodes, "req_id").collect()} == {("B", "R2", "missing_source"), ("B", "R1", "self_loop")}


def test_status_and_refusal(spark):
    counters = spark.createDataFrame([("a", 0, 0), ("b", 1, 0)], "doc_id string, classes int, edges int")
    report = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "doc_id string, passed boolean")
    assert {r.doc_id: r.status for r in decide.status(report, counters).collect()} == {"a": "completed", "b": "in_progress", "c": "in_progress", "d": "completed"}
    with pytest.raises(decide.Unresolved, match="b: classes=1"):
        decide.require_resolved(counters)
    decide.require_resolved(counters.filter("doc_id = 'a'"))


def test_title_and_part_and_outside_hits(spark):
    title, part = decide.title_and_part(F.col("s"))
    rows = spark.createDataFrame([("45-cfr-part-164",), ("other",)], "s string").select(title.alias("t"), part.alias("p")).collect()
    assert [tuple(r) for r in rows] == [("45", "164"), ("21", "11")]
    hits = spark.createDataFrame([(1, "S1", "shall"), (1, "S2", "may"), (1, "S2", "shall"), (1, "S3", "may"), (1, "S4", "may")], "doc_id int, span_id string, verb string")
    classes = spark.createDataFrame([(1, "S1", "requirement_bearing", []), (1, "S2", "definition", []), (1, "S3", "source_note", []), (1, "S4", "definition", [])], "doc_id int, span_id string, final_label string, final_embedded array<string>")
    assert {r.span_id: r.verbs for r in decide.outside_hits(hits, classes).collect()} == {"S2": ["may", "shall"], "S4": ["may"]}
