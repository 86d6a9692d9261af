"""Adjudication in order with one commit; active ranges; characters by byte."""

import random

import pytest

from spanledger.operators import audit, decide, lines
from spanledger.plans import adjudication
from spanledger.sources import sinks

ROWS = "array<struct<verbatim_quote:string,atomic_statement:string,modality:string,subject:string,object:string,tags:array<string>,conditions:array<string>>>"


def catalog(spark):
    return {
        "spans": spark.createDataFrame([(d, f"S{i}", f"Firms shall keep part {i}.") for d in (1, 2) for i in (1, 2, 3)], "doc_id int, span_id string, text string"),
        "classes": spark.createDataFrame([(d, f"S{i}", "requirement_bearing", [], i == 3, i == 2) for d in (1, 2) for i in (1, 2, 3)], "doc_id int, span_id string, final_label string, final_embedded array<string>, ambiguous boolean, downgrade_pending boolean"),
        "statements": spark.createDataFrame([(d, "R00001", "S1", "shall keep", True) for d in (1, 2)] + [(2, "R00002", "S3", "Firms", False)], "doc_id int, req_id string, source_span_id string, verbatim_quote string, ambiguous boolean"),
        "edges": spark.createDataFrame([(2, 1, "E0001", "R00001", "R00002", "references", "e", True), (2, 2, "E0002", "R00002", "R00001", "refines", "e", False)], "doc_id int, seq int, rel_id string, src string, dst string, type string, evidence string, ambiguous boolean"),
    }


def decisions(spark):
    return {
        "classes": spark.createDataFrame([(1, "S3", 1, "definition", None, None)], "doc_id int, span_id string, seq int, final_label string, final_embedded array<string>, note string"),
        "downgrades": spark.createDataFrame([(1, "S2", 1, "confirm_downgrade", None, None), (2, "S2", 1, "extract", None, [("keep part 2", "s", None, None, None, None, None)])], f"doc_id int, span_id string, seq int, decision string, final_label string, rows {ROWS}"),
        "statements": spark.createDataFrame([(1, "R00001", 1, "keep", None, None), (2, "R00001", 1, "drop", None, "twice")], "doc_id int, req_id string, seq int, decision string, verbatim_quote string, rationale string"),
        "edges": spark.createDataFrame([(2, "E0001", 1, "keep", None, None)], "doc_id int, rel_id string, seq int, decision string, type string, evidence string"),
    }


def test_one_commit_for_all_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "catalog")
    sinks.commit(catalog(spark), root, "one", 0)

    def fault(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(adjudication, "STEPS", (*adjudication.STEPS[:3], ("statements", fault)))
        with pytest.raises(OSError, match="lost"):
            adjudication.adjudicate_published(spark, root, decisions(spark), "two")
    at, tables = sinks.read_commit(spark, root, "statements", "edges")
    assert at == 1 and tables["statements"].count() == 3 and tables["edges"].count() == 2
    tally = adjudication.adjudicate_published(spark, root, decisions(spark), "three")
    assert {(r.doc_id, r.kind, r.outcome, r.reason): r.n for r in tally.collect()} == {
        (1, "class", "updated", None): 1, (1, "downgrade", "confirmed", None): 1, (2, "downgrade", "extracted", None): 1,
        (1, "statement", "kept", None): 1, (2, "statement", "dropped", None): 1, (2, "edge", None, "not found"): 1,
    }
    at, t = sinks.read_commit(spark, root, *adjudication.NAMES)
    assert at == 2 and t["edges"].count() == 0
    assert sorted((r.doc_id, r.req_id, r.source_span_id) for r in t["statements"].collect()) == [(1, "R00001", "S1"), (2, "R00002", "S3"), (2, "R00003", "S2")]
    classes = {(r.doc_id, r.span_id): (r.final_label, r.downgrade_pending) for r in t["classes"].collect()}
    assert classes[1, "S2"] == ("administrative", False) and classes[1, "S3"] == ("definition", False) and classes[2, "S1"] == ("requirement_bearing", True)
    with pytest.raises(sinks.Conflict):
        sinks.commit(catalog(spark), root, "four", 1)
    with pytest.raises(decide.Unresolved):
        adjudication.adjudicate_published(spark, root, {k: v.limit(0) for k, v in decisions(spark).items()}, "five", finalize=True)
    assert sinks.current(spark, root) == (2, "three")


def plain_segments(ranges, length):
    points = sorted({p for a, b, _ in ranges for p in (a, b) if 0 <= p <= length} | {0, length})
    return [(a, b, sorted({i for s, e, i in ranges if max(s, 0) <= a and b <= min(e, length) and s < e})) for a, b in zip(points, points[1:], strict=False)]


def test_active_segments(spark):
    rng = random.Random(4)
    of = {1: [(0, 5, "R1"), (0, 5, "R2"), (5, 9, "R3"), (2, 3, "R4"), (7, 7, "R5"), (-3, 2, "R6"), (8, 40, "R7"), (8, 9, "R7"), (9, 4, "R8")], 2: [], 3: [(a := rng.randrange(90), a + rng.randrange(30), f"R{i}") for i in range(60)]}
    ranges = spark.createDataFrame([(d, *r) for d, rows in of.items() for r in rows], "doc_id int, start bigint, end bigint, id string")
    sizes = spark.createDataFrame([(1, 10), (2, 4), (3, 100)], "doc_id int, length bigint")
    got = {}
    for r in audit.active_segments(ranges, sizes).orderBy("doc_id", "start").collect():
        assert r.anchor == (r.ids[0] if r.ids else None)
        got.setdefault(r.doc_id, []).append((r.start, r.end, r.ids))
    assert got == {1: plain_segments(of[1], 10), 2: [(0, 4, [])], 3: plain_segments(of[3], 100)}


def test_characters_by_byte(spark):
    texts = {1: ["汉字" * 300 + "a", "", "é𝄞x"], 2: ["plain"], 3: ["𝄞" * 129]}
    rows = [(d, i, t) for d, own in texts.items() for i, t in enumerate(own)]
    at, want = [], {}
    for d, own in texts.items():
        whole = "".join(t + "\n" for t in own)
        place = 0
        for n, ch in enumerate(whole):
            for _ in ch.encode():
                want[d, place] = n
                place += 1
        want[d, place], want[d, place + 1] = len(whole), None
        at += [(d, p) for p in range(place + 2)]
    offsets = spark.createDataFrame(at, "doc_id int, at bigint")
    got = {(r.doc_id, r["at"]): r.char for r in lines.chars_at(offsets, spark.createDataFrame(rows, "doc_id int, line_no int, line string")).collect()}
    assert got == want
