"""The whole catalog as ordered lines and as text."""

import glob

from spanledger.plans import catalog

SPANS = "doc_id int, span_id string, at bigint, kind string, section string, subpart string, citation string, text string, byte_start bigint, byte_end bigint, final_label string, final_embedded array<string>, ambiguous boolean"
STATEMENTS = "doc_id int, req_id string, source_span_id string, citation_raw string, verbatim_quote string, atomic_statement string, modality string, subject string, object string, tags array<string>, conditions array<string>, ambiguous boolean"
LOG = "doc_id int, at bigint, stage string, key string, status string, label_a string, label_b string, final_label string, count_a bigint, count_b bigint, count_final bigint, ambiguous_items bigint"


def test_parts_in_order_and_empty_ones_left_out(spark, tmp_path):
    spans = [
        (1, "S1", 1, "section_header", "11.10", "B", "§ 11.10", "§ 11.10 Controls.\n", 0, 18, "structural", [], False),
        (1, "S2", 2, "paragraph", "11.10", "B", "§ 11.10(a)", "(a) Firms shall keep\nrecords.\n", 18, 48, "requirement_bearing", ["definition"], True),
        (1, "S3", 3, "paragraph", "11.2", None, "§ 11.2(a)", "(a) Firms may sign.\n", 48, 68, "requirement_bearing", [], False),
        (1, "S4", 4, "paragraph", "11.3", None, "§ 11.3(1)", "(1) Act means the law.\n", 68, 91, "definition", [], False),
        (1, "S5", 5, "paragraph", "11.1", None, "§ 11.1(b)", "(b) Not this.\n", 91, 105, "scope_exclusion", [], False),
        (2, "S1", 1, "section_header", "11.1", None, "§ 11.1", "§ 11.1 Scope.\n", 0, 14, "structural", [], False),
    ]
    statements = [
        (1, "R00001", "S2", "§ 11.10(a)", "shall keep\nrecords", "keep records", "shall", "firms", "records", ["a", "b"], ["always"], True),
        (1, "R00002", "S3", "§ 11.2(a)", "may sign", "sign", "may", "", "", ["a"], [], False), (2, "R00001", "S9", "?", "q", "s", "may", "", "", [], [], False),
    ]
    edges = spark.createDataFrame([(1, "E0001", "R00001", "R00002", "refines", False), (2, "E0001", "R00002", "R00001", "refines", False)], "doc_id int, rel_id string, src string, dst string, type string, ambiguous boolean")
    rows = catalog.whole(spark.createDataFrame([(1, "Part 11"), (2, "Other")], "doc_id int, title string"), spark.createDataFrame(spans, SPANS), spark.createDataFrame(statements, STATEMENTS), edges, spark.createDataFrame([], LOG))
    text = {}
    for r in rows.orderBy("doc_id", "part", "key").collect():
        text.setdefault(r.doc_id, []).append(r.line)
    at = text[1].index
    heads = [x for x in text[1] if x.startswith(("# ", "## "))]
    assert heads == ["# Catalog — Part 11", "## Coverage", "## Definitions", "## Scope", "## Requirements", "## Tag index", "## Ambiguous items", "## Appendix: spans"]
    assert [x for x in text[2] if x.startswith("##")] == ["## Coverage", "## Appendix: spans"]
    assert text[1][at("## Requirements") :][:28] == [
        "## Requirements", "", "### § 11.2", "", "#### § 11.2(a)", "", "> (a) Firms may sign.", "", "- **`R00002`** [may] sign", "  - tags: `a`", '  - quote: "may sign"', "  - referenced by: 1 refines", "",
        "### Subpart B — § 11.10 Controls.", "", "#### § 11.10(a)  **[ambiguous]**  _[primary: requirement_bearing; also: definition]_", "", "> (a) Firms shall keep records.", "",
        "- **`R00001`** [shall]  ⚠ ambiguous keep records", "  - subject: firms", "  - object: records", "  - tags: `a, b`", "  - conditions: always", '  - quote: "shall keep records"', "  - **refines** → `R00002` (§ 11.2(a))", "", "",
    ]
    assert "### Exclusions" in text[1] and "### Inclusions" not in text[1] and "- `a` (2): R00001, R00002" in text[1] and "- R00001" in text[1]
    catalog.write_text(rows, str(tmp_path / "out"), tasks=3)
    files = sorted(glob.glob(str(tmp_path / "out" / "part-*")))
    assert len(files) > 1 and "".join(open(f, encoding="utf-8").read() for f in files) == "".join(x + "\n" for d in (1, 2) for x in text[d])
