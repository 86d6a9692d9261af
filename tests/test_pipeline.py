"""The document pipeline, and resumable streams."""

import pytest
from pyspark.sql import functions as F

from spanledger.plans import pipeline
from spanledger.streaming import resume

REG = "21 CFR Part 11 (up to date as of 5/15/2026)\nPART 11—RECORDS\n§ 11.1 Scope.\n(a) Firms shall keep records.\n(b) Firms may ask.\npage 1 of 2\n"


def corpus(spark, quote):
    pages = spark.createDataFrame([("fda/x", 1, REG, len(REG)), ("fda/g", 1, "Title\n\nBody text here.\n", 23)], "doc_id string, page_number int, text string, char_count int")
    meta = spark.createDataFrame([("fda/x", "Records", "cfr", "11"), ("fda/g", "Guide", "generic", None)], "doc_id string, title string, citation_format string, part string")
    label = lambda d, s, x: [(d, s, a, x, [], "", "high") for a in "ab"]
    rows = [r for s, x in (("S0001", "structural"), ("S0002", "structural"), ("S0003", "requirement_bearing"), ("S0004", "administrative")) for r in label("fda/x", s, x)] + [r for s in ("S0001", "S0002") for r in label("fda/g", s, "administrative")]
    annotations = spark.createDataFrame(rows, "doc_id string, span_id string, agent string, label string, embedded array<string>, reason string, confidence string")
    statements = spark.createDataFrame([("fda/x", 1, "R00001", "S0003", quote, False)], "doc_id string, seq int, req_id string, source_span_id string, verbatim_quote string, ambiguous boolean")
    edges = spark.createDataFrame([("fda/x", 1, "R00001", "R00001", "refines", "e", False), ("fda/x", 2, "R00001", "R9", "refines", "e", False)], "doc_id string, seq int, src string, dst string, type string, evidence string, ambiguous boolean")
    return pipeline.Corpus(pages, meta, annotations, statements, edges)


def test_run(spark):
    out = pipeline.run(corpus(spark, "Firms shall keep records."))
    assert {r.doc_id for r in out["audit"].filter("passed").collect()} == {"fda/x", "fda/g"}
    assert out["stripped"].count() == 2 and out["edges"].count() == 0
    assert out["spans"].filter("span_id = 'S0003' AND doc_id = 'fda/x'").first().text == "(a) Firms shall keep records.\n"


def test_gate_names_what_failed(spark):
    with pytest.raises(pipeline.GateFailed, match="fda/x: quote_failures=1"):
        pipeline.run(corpus(spark, "not there"))


def test_every_stage_leaves_a_row_also_when_it_fails(spark, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(pipeline.GateFailed):
        pipeline.run(corpus(spark, "not there"), only=("boilerplate", "segment", "classify", "audit"), log=log, run_id="r1")
    rows = {r.stage: r for r in spark.read.parquet(log).collect()}
    assert {s: r.status for s, r in rows.items()} == {"boilerplate": "completed", "segment": "completed", "classify": "completed", "audit": "failed"}
    assert rows["segment"].tables["spans"] == 6 and rows["audit"].error.startswith("audit: fda/x: quote_failures=1") and {r.run_id for r in rows.values()} == {"r1"}


def test_resume_works_each_key_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(5).write.parquet(src)
    for n in (5, 8):
        spark.range(n).write.mode("append").parquet(src)
        stream = spark.readStream.schema("id bigint").parquet(src)
        resume.run_resumable(stream, out, str(tmp_path / "ck"), ["id"], lambda df: df.withColumn("v", F.col("id") * 2))
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == list(range(8))


def test_sessions(spark):
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:10:00", 2.0), (1, "2024-01-01 01:00:00", 4.0)]
    events = spark.createDataFrame(rows, "user_id int, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted((r.n_events, r.total) for r in resume.sessions(events).collect()) == [(1, 4.0), (2, 3.0)]
