"""The whole catalog's parts read its statements as they were written, not joined anew for each part."""

from spanledger.queries import books

SF = "/root/testdata/sf0.001"


def test_line_items_are_read_once(spark):
    plan = books.whole_catalog(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_linenumber" not in plan
