"""Collapsing blank lines sorts a document once."""

from spanledger.operators import lines


def test_blank_lines_are_collapsed_with_one_sort(spark):
    rows = [(1, i, x) for i, x in enumerate(["", " ", "a", "", "  ", " b ", "", ""])] + [(2, 0, ""), (2, 1, " ")] + [(3, 5, "c")]
    df = spark.createDataFrame(rows, "doc_id int, line_no int, line string")
    out = lines.collapse_blanks(df)
    assert sorted(map(tuple, out.collect())) == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (3, 0, "c")]
    assert out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Sort [") <= 1
