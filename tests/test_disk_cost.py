"""What a query writes besides its result: one shuffle by document where one will do, and files that go before the next step."""

from pyspark.sql import functions as F

from spanledger.operators import graph, rulings
from spanledger.plans import catalog
from spanledger.queries import reports, texts

SF = "/root/testdata/sf0.001"


def test_hits_and_spans_share_the_lines_of_one_shuffle(spark, monkeypatch):
    want = sorted(texts.modal_in_span(spark, SF).collect())
    monkeypatch.setattr(graph, "stored", None)
    df = texts.modal_in_span(spark, SF)
    assert sorted(df.collect()) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "ReusedExchange" in final


def test_parents_are_looked_up_among_spans_made_once(spark):
    df = reports.regulation_parents(spark, SF)
    assert "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.agg(F.sum("n")).first()[0] > 0


def test_each_kind_of_decisions_is_counted_before_the_next(spark, monkeypatch):
    seen = []
    plain = rulings.stored
    monkeypatch.setattr(rulings, "stored", lambda df: seen.append(df.columns) or plain(df))
    log = spark.createDataFrame([(1, "S1", 1, "kept", None), (1, "S2", 2, None, "not found"), (2, "S1", 1, "kept", None), (2, "S1", 2, "kept", None)], "doc_id int, id string, seq int, outcome string, reason string")
    got = rulings.tally({"edge": log, "class": log.filter("doc_id = 2")})
    assert len(seen) == 2
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "edge", "kept", None, 1), (1, "edge", None, "not found", 1), (2, "edge", "kept", None, 2), (2, "class", "kept", None, 2)], key=str)


def test_pieces_of_a_part_are_written_one_by_one(spark):
    rows = spark.createDataFrame([(1, 7, "a"), (2, 8, "b")], "doc_id int, k int, line string")
    piece = rows.groupBy("doc_id", "line").agg(F.max("k").alias("k")).select("doc_id", catalog.key(F.col("k")).alias("key"), "line")
    out = catalog.headed((piece, piece.filter("doc_id = 2")), 3, "## Head")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("max(") == 0
    assert [r.line for r in out.filter("doc_id = 2").orderBy("key").collect()] == ["## Head", "", "b", "b", ""]
