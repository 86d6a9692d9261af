"""Decisions are judged by one lookup, and lists of quotes in place; ends are trimmed by a set of characters."""

from pyspark.sql import functions as F

from spanledger.functions import text
from spanledger.operators import rulings


def test_trimmed_characters_are_those_of_the_pattern(spark):
    chars = [chr(n) for n in range(1, 0x3100) if not 0xD800 <= n < 0xE000]
    df = spark.createDataFrame([(c + "a" + c + "b" + c,) for c in chars], "t string")
    by_pattern = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    assert df.filter(text.trim_unicode(F.col("t")) != by_pattern).collect() == []
    assert spark.createDataFrame([(" 　\n",), ("",), (None,)], "t string").select(text.trim_unicode(F.col("t"))).collect() == [("",), ("",), (None,)]


def test_lists_of_quotes_are_as_single_ones(spark):
    words = [f"w{i}" for i in range(60)]
    body = "Firms shall keep, records -\n of a-\nb. " + ",\n".join(words)
    quotes = ["shall keep records", "", "absent", "a-b", ",;", " ".join(words), "shall keep", None, " ".join(words[:41]), " ".join(words[:40])]
    df = spark.createDataFrame([(quotes, body), (quotes, None), ([], body), (None, body)], "qs array<string>, t string")
    got = [r[0] for r in df.select(text.canonical_quotes(F.col("qs"), F.col("t"))).collect()]
    one = spark.createDataFrame([(i, q, t) for t in (body, None) for i, q in enumerate(quotes)], "i int, q string, t string")
    want = [r[0] for r in one.select(text.canonical_quote(F.col("q"), F.col("t"))).collect()]
    assert got == [want[:10], want[10:], [], None]
    assert want[0] == "shall keep, records" and want[5] == ",\n".join(words)


def test_edges_and_statements_meet_their_records_once(spark):
    """Three joins less: with found, type, source and quotes looked up apart, these plans had more."""
    edges = spark.createDataFrame([(1, 1, "E0001", "R1", "R2", "refines", "", True)], "doc_id int, seq int, rel_id string, src string, dst string, type string, evidence string, ambiguous boolean")
    ruled = spark.createDataFrame([(1, "E0001", 1, "keep", None, None)], "doc_id int, rel_id string, seq int, decision string, type string, evidence string")
    st = spark.createDataFrame([(1, 1, "R1", "S1", "keep", True)], "doc_id int, seq int, req_id string, source_span_id string, verbatim_quote string, ambiguous boolean")
    spans = spark.createDataFrame([(1, "S1", "Firms keep it.")], "doc_id int, span_id string, text string")
    edits = spark.createDataFrame([(1, "R1", 1, "edit", "keep it.")], "doc_id int, req_id string, seq int, decision string, verbatim_quote string")
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert joins(rulings.rule_edges(edges, ruled)[1]) == 1
    assert joins(rulings.rule_statements(st, spans, edits)[1]) == 2
