"""A pattern is run once, and only where its longest word stands."""

from pyspark.sql import functions as F

from spanledger.functions import rules, signals
from spanledger.queries import texts

SF = "/root/testdata/sf0.001"


def test_hits_of_a_line_are_worked_out_once(spark):
    """A filter of all patterns before the hits, or one that asks whether a list of hits is empty, would run them again."""
    plan = texts.signal_hits_by_doc(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.split("Generate", 1)[1].split("\n", 1)[1]
    assert sum("regexp_extract_all" in x for x in plan.split("\n")) == 1 and "split(" not in plan


def test_words_that_a_match_need_not_hold_hide_no_pattern(spark):
    table = (("colour", "a", "colou?r"), ("either", "b", "wider|narrower"), ("class", "c", "[xyz]{2,}"), ("short", "d", "ab*c{0,2}"))
    df = spark.createDataFrame([(1, "colour colr is narrower, xyzzy abbcc, color")], "k int, t string")
    assert sorted(map(tuple, signals.counts(df, "k", "t", table).collect())) == [(1, "a", "colour", 2), (1, "b", "either", 1), (1, "c", "class", 1), (1, "d", "short", 2)]
    hits = df.select(signals.signals(F.col("t"), table)).first()[0]
    assert [(h["pattern_id"], h["start"], h["end"]) for h in hits] == [("colour", 0, 6), ("either", 15, 23), ("short", 16, 17), ("class", 25, 30), ("short", 31, 36), ("colour", 38, 43)]


def test_every_match_has_its_characters_and_place(spark):
    t = "𝔘 shall\nUse of it; it SHALL and\n(a) Use of that, may 12, 2019, may go, shall include, Jan. 5, 2020."
    df = spark.createDataFrame([(1, t), (2, None), (3, "")], "k int, t string")
    hits = df.orderBy("k").select(signals.signals(F.col("t"))).collect()
    assert hits[1][0] == [] and hits[2][0] == []
    assert [t[h["start"] : h["end"]] == h["matched_text"] for h in hits[0][0]] == [True] * 8
    assert [h["pattern_id"] for h in hits[0][0]] == ["shall", "use_of", "shall", "use_of", "may", "shall", "shall_include", "includes"]
    told = df.orderBy("k").select(signals.has_obligation(F.col("t"))).collect()
    assert [r[0] for r in told] == [True, None, False] and len(rules.SIGNALS) == 24
