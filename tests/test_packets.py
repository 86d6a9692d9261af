"""Packets, answers and readers on small rows: what is refused, and what happens to rows that come twice."""

import pytest

from spanledger.operators import annotate, packets
from spanledger.sources import readers

SAID = "array<struct<verbatim_quote:string,atomic_statement:string,modality:string,tags:array<string>,conditions:array<string>,ambiguous:boolean>>"
SPANS = "doc_id int, span_id string, text string, citation string"


def said(*quotes):
    return [(q, "it", "shall", [], [], False) for q in quotes]


def test_merge_of_statements(spark):
    spans = spark.createDataFrame([(1, s, "Firms shall keep\nrecords.", "") for s in "ABCD"], SPANS)
    classes = spark.createDataFrame([(1, s, "requirement_bearing", [], s == "C") for s in "ABCD"], "doc_id int, span_id string, final_label string, final_embedded array<string>, downgrade_pending boolean")
    held = spark.createDataFrame([(1, "R00007", "A")], "doc_id int, req_id string, source_span_id string")
    # A has statements; B answers nothing twice; C nothing, then two; D one, then nothing
    rows = spark.createDataFrame([(1, "A", 1, said("Firms")), (1, "B", 2, []), (1, "B", 3, None), (1, "C", 4, []), (1, "C", 5, said("shall keep records", "Firms")), (1, "D", 0, said("records.")), (1, "D", 6, [])], f"doc_id int, span_id string, row int, statements {SAID}")
    made, after = packets.merge_statements(rows, classes, held, spans, packets.next_number(held, "req_id"))
    assert sorted((r.req_id, r.source_span_id, r.verbatim_quote) for r in made.collect()) == [("R00008", "D", "records."), ("R00009", "C", "shall keep\nrecords"), ("R00010", "C", "Firms")]
    assert {r.span_id: r.downgrade_pending for r in after.collect()} == {"A": False, "B": True, "C": False, "D": False}
    none, same = packets.merge_statements(rows.limit(0), classes, held, spans, packets.next_number(held, "req_id"))
    assert none.count() == 0 and {r.span_id for r in same.filter("downgrade_pending").collect()} == {"C"}


def test_failures_of_answers(spark):
    spans = spark.createDataFrame([(1, s, "Firms shall keep\nrecords.", "") for s in "ABCDE"], SPANS)
    asked = spans.filter("span_id <> 'E'")
    rows = spark.createDataFrame([(1, "A", said("shall keep records")), (1, "B", said("absent", "", None)), (1, "C", None), (1, "C", []), (1, "E", said("absent"))], f"doc_id int, span_id string, statements {SAID}")
    got = sorted((r.span_id, r.failure, r.n) for r in packets.failures(asked, rows, spans).collect())
    assert got == [("B", "quote not found", 3), ("C", "duplicate", 1), ("C", "no list", 1), ("D", "missing", 1), ("E", "not in packet", 1)]


def test_export_leaves_what_claims_hold(spark):
    items = spark.range(8).withColumnRenamed("id", "k")
    claims = spark.createDataFrame([("classify", "failed", [0, 1]), ("classify", "released", [2]), ("relate", "claimed", [3])], "stage string, status string, item_ids array<bigint>")
    packet, claim = packets.export(items, items.filter("k = 4"), claims, "classify", "b", "k", ["k"], 3)
    assert [r.k for r in packet.collect()] == [2, 3, 5] and claim.first().item_ids == [2, 3, 5] and claim.first().status == "claimed"


def test_candidates_without_dates(spark):
    spans = spark.createDataFrame([(1, "A", "It was due on Jan. 5, 2020."), (1, "B", "Firms should ask."), (1, "C", "Firms should ask.")], "doc_id int, span_id string, text string")
    classes = spark.createDataFrame([(1, "A", "definition", []), (1, "B", "definition", []), (1, "C", "source_note", [])], "doc_id int, span_id string, final_label string, final_embedded array<string>")
    assert [r.span_id for r in annotate.audit_candidates(spans, classes).collect()] == ["B"]


def test_readers_name_what_is_wrong(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n{"id": oops}\n')
    with pytest.raises(readers.BadRecords, match=r"a\.jsonl:4: \{\"id\": oops"):
        readers.json_lines_strict(spark, str(tmp_path / "a.jsonl"), "id int").collect()
    for name, meta in (("fda/good", '{"title": "x"}'), ("fda/bad", "{"), ("fda/No", '{"title": "x"}'), ("review_site/x", "{")):
        (tmp_path / "docs" / name).mkdir(parents=True)
        (tmp_path / "docs" / name / "meta.json").write_text(meta)
    root = str(tmp_path / "docs")
    assert [r.doc_id for r in readers.catalog(spark, root, "title string").collect()] == ["fda/good"]
    assert sorted(r.file.split("/")[-2] for r in readers.bad_metas(spark, root, "title string").collect()) == ["No", "bad"]
    assert readers.whole_texts(spark, f"{root}/fda/bad/meta.json").first().text == "{"
    asked = spark.createDataFrame([("d", "S1", "a"), ("d", "S2", "b")], "doc_id string, span_id string, agent string")
    said_so = spark.createDataFrame([("d", "S1", "a", "definition")], "doc_id string, span_id string, agent string, label string")
    assert readers.require_answers(asked.limit(1), said_so).first().label == "definition"
    with pytest.raises(readers.BadRecords, match="no answer of b for S2 of d"):
        readers.require_answers(asked, said_so)
