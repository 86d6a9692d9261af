"""Lines of a regulation are dealt once and sorted three times: by line, by section number, by line."""

from pyspark.sql import functions as F

from spanledger.operators import segment
from spanledger.queries import forms

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_lines_are_sorted_three_times(spark):
    d = spark.createDataFrame([(1, 0, "§ 1.1 A.")], "doc_id int, line_no int, line string")
    told = plan(segment.regulation_openings(d, F.col("doc_id")))
    assert told.count("Sort [") == 3 and told.count("Exchange ") == 1


def test_prints_are_dealt_once_and_without_their_words(spark):
    told = plan(segment.regulation_openings(forms.print_lines(spark, SF), F.col("doc_id") + 100))
    assert told.count("Exchange hashpartitioning(") == 2  # customers once each, and lines


def test_first_header_of_the_body_counts(spark):
    """A first sighting before the body is none, one in it is the header, and only the first of several."""
    text = "§ 1.1 A.\nx y\n§ 1.2 B.\nPART 1—P\n§ 1.2 B.\nText.\n§ 1.3 C.\nText.\n§ 1.1 A.\nText.\n§ 1.3 C.\nText.\n§ 1.1 A.\nText.\n§ 2.1 D.\nText."
    d = spark.createDataFrame([(1, i, x) for i, x in enumerate(text.split("\n"))], "doc_id int, line_no int, line string")
    out = segment.regulation_lines(d, F.lit(1)).filter("class = 'section'").orderBy("line_no")
    assert [(r.line_no, r.role) for r in out.collect()] == [(0, "toc_entry"), (2, "toc_entry"), (4, "section_header"), (6, "section_header"), (8, "section_header"), (10, "prose"), (12, "prose"), (14, "prose")]
