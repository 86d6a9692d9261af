"""Citations move what is needed to resolve them and no more; lines of regulations are made after their shuffle."""

from pyspark.sql import functions as F

from spanledger.operators import graph, refs
from spanledger.plans import regtext
from spanledger.queries import catalog

SF = "/root/testdata/sf0.001"
SPANS = "doc_id int, seq int, span_id string, kind string, section string, path array<string>, text string"


def held(spark):
    rows = [(1, 1, "S1", "section_header", "11.1", [], "§ 11.1"), (1, 2, "S2", "paragraph", "11.1", ["a"], "(a) see § 12.1(a)(1), § 12.1(a)(9) and § 12.1."),
            (2, 1, "S1", "section_header", "12.1", [], "§ 12.1"), (2, 2, "S2", "paragraph", "12.1", ["a"], "first"), (2, 3, "S3", "paragraph", "12.1", ["a"], "again"),
            (2, 4, "S4", "paragraph", "12.1", ["a", "1"], "under § 11.1 and § 11.1, part 11, part 11"), (2, 5, "S5", "section_chapeau", "12.1", [], "§ 99.9, part 11")]
    return spark.createDataFrame(rows, SPANS)


def test_prefixes_meet_the_last_span_of_their_path(spark):
    spans = held(spark)
    parts = spark.createDataFrame([("11", 1), ("12", 2)], "part string, doc_id int")
    cites = refs.citations(spans)
    cites = cites.unionByName(cites.filter("citation = '§ 12.1(a)(9)'"))
    got = sorted((r.citation, r.target_span, r.target_kind) for r in refs.resolve(cites, spans, parts, "kind").collect() if r.doc_id == 1 and r["pass"] == 1 and r.span_id == "S2")
    assert got == [("§ 12.1", "S1", "section_header"), ("§ 12.1(a)(1)", "S4", "paragraph"), ("§ 12.1(a)(9)", "S3", "paragraph"), ("§ 12.1(a)(9)", "S3", "paragraph")]


def test_only_citations_in_company_are_compared(spark):
    """Alone is told in the span; what is not alone is still kept once, also where parts stand twice."""
    spans = held(spark)
    cites = refs.citations(spans)
    alone = {(r.doc_id, r.span_id, r["pass"], r.pos): r.alone for r in cites.collect()}
    assert alone[2, "S5", 1, 0] and alone[2, "S5", 3, 0] and not alone[2, "S4", 1, 0] and not alone[2, "S4", 3, 1]
    want = [("S4", "§ 11.1", "S1"), ("S4", "part 11", None), ("S5", "part 11", None), ("S5", "§ 99.9", None)]
    for parts in ([("11", 1), ("12", 2)], [("11", 1), ("11", 1), ("12", 2)]):
        out = refs.cross_refs(cites, spans, spark.createDataFrame(parts, "part string, doc_id int")).filter("source_doc = 2")
        assert sorted((r.source_span, r.citation, r.target_span) for r in out.collect()) == sorted(want, key=lambda x: x[:2])


def test_the_shuffle_by_document_moves_no_text(spark):
    plan = regtext.reg_lines(spark, SF)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "Shipments" in plan and "Shipments" not in below and plan.count("Exchange hashpartitioning") == 2


def test_citations_are_found_once(spark):
    """No filter works out all passes a second time."""
    spans = graph.stored(catalog.reg_spans(spark, SF))
    plan = refs.citations(spans)._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten" in plan and "size(flatten" not in plan


def test_stored_keeps_rows_and_leaves_the_setting(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(graph.stored(df).collect()) == sorted(df.collect())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == before
