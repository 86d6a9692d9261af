"""Operators on small hand-written tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from spanledger.functions import signals, text
from spanledger.operators import annotate, audit, graph, lines, packets, quotes, refs, segment
from spanledger.queries import catalog
from spanledger.sources import readers, sinks


def column(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("r")).first()["r"]


def doc_lines(spark, *texts):
    return lines.split_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_lines_offsets_and_phantom(spark):
    out = lines.with_offsets(doc_lines(spark, "§a\nb\n", "x\n\ny")).orderBy("doc_id", "line_no").collect()
    assert [(r.doc_id, r.line, r.byte_start, r.byte_end) for r in out] == [(0, "§a", 0, 4), (0, "b", 4, 6), (1, "x", 0, 2), (1, "", 2, 3), (1, "y", 3, 5)]


def test_blank_runs_collapse(spark):
    out = lines.join_lines(lines.collapse_blanks(doc_lines(spark, "\n\n a \n\n\nb \n\n"))).first()
    assert out.text == "a\n\nb\n" and out.byte_count == 5
    assert lines.join_lines(lines.collapse_blanks(doc_lines(spark, "\n \n"))).count() == 0


def test_margin_numbers_need_a_run_of_three(spark):
    out = lines.strip_margin_numbers(doc_lines(spark, "1   a\n2   b\n3   c\n21 CFR", "7   a\n8   b\n100 patients", "9   a\n8   b\n7   c"))
    assert [(r.doc_id, r.line) for r in out.orderBy("doc_id", "line_no").collect()][:4] == [(0, "a"), (0, "b"), (0, "c"), (0, "21 CFR")]
    assert out.filter("doc_id > 0 AND stripped").count() == 0


def test_generic_blocks(spark):
    spans = segment.generic_spans(doc_lines(spark, "\nTitle here\n\nBACKGROUND\n\nprose one\ngoes on\n\nA. Data ..... 3\n")).orderBy("seq").collect()
    assert [(s.kind, s.byte_start) for s in spans] == [("document_title", 0), ("section_header", 13), ("paragraph", 25), ("toc_entry", 44)]
    assert spans[-1].byte_end == 60 and all(a.byte_end == b.byte_start for a, b in zip(spans, spans[1:], strict=False))


def test_regulation_paths(spark):
    body = "PART 11—X\n§ 11.1 Scope.\nLead in.\n(a) one\n(1) n\n(i) r\n(ii) rr\n(2) m\n(b) two\n(c) c\n(1) x\n(2) y\n(d) after c\n[62 FR 1, Mar. 20,\n1997]\n§ 11.2 Next.\n(h) h\n(i) letter\n§ 160.2 of this part\n"
    spans = segment.regulation_spans(doc_lines(spark, body), F.lit("11")).orderBy("seq").collect()
    paths = ["/".join(s.path) for s in spans if s.kind == "paragraph"]
    assert paths == ["a", "a/1", "a/1/i", "a/1/ii", "a/2", "b", "c", "c/1", "c/2", "d", "h", "i"]
    assert [s.kind for s in spans if s.kind != "paragraph"] == ["part_header", "section_header", "section_chapeau", "source_note", "section_header"]
    assert spans[3].citation == "§ 11.1(a)" and spans[-1].byte_end == len(body.encode())


def test_regulation_leading_junk_is_a_gap(spark):
    at = doc_lines(spark, "junk\nPART 11—X\n")
    sizes = lines.with_offsets(at).groupBy("doc_id").agg(F.max("byte_end").alias("total_bytes"))
    out = audit.coverage(segment.regulation_spans(at, F.lit("11")), sizes).first()
    assert (out.n_gaps, out.gap_bytes, out.passed) == (1, 5, False)


def test_contents_before_the_body(spark):
    body = "Subpart A General\n§ 11.1 Scope.\n§ 11.2 Terms.\n§ 11.1 Scope.\n(a) text\n"
    spans = segment.regulation_spans(doc_lines(spark, body), F.lit("11")).orderBy("seq").collect()
    assert [s.kind for s in spans] == ["toc_entry", "toc_entry", "toc_entry", "section_header", "paragraph"]


def test_guideline_and_parents(spark):
    spans = segment.guideline_spans(doc_lines(spark, "E6 text\nI. INTRODUCTION\nlead\nmore\n1.1 First\n1.1.2 Deep\nII. METHODS\n1.1.2 Again\n")).orderBy("seq")
    assert [s.kind for s in spans.collect()] == ["document_title", "part_header", "section_chapeau", "decimal", "decimal", "part_header", "decimal"]
    parents = segment.decimal_parents(spans.filter("section IS NOT NULL").select("doc_id", "part_no", "seq", "section")).orderBy("seq").collect()
    assert [(p.section, p.parent_seq) for p in parents] == [("1.1", None), ("1.1.2", 4), ("1.1.2", None)]


def test_coverage_needs_the_running_maximum(spark):
    spans = spark.createDataFrame([(1, 0, 10), (1, 2, 3), (1, 8, 12), (2, 0, 4), (2, 6, 9)], "doc_id int, byte_start bigint, byte_end bigint")
    sizes = spark.createDataFrame([(1, 12), (2, 9), (3, 5), (4, 0)], "doc_id int, total_bytes bigint")
    out = {r.doc_id: (r.n_gaps, r.gap_bytes, r.n_overlaps, r.passed) for r in audit.coverage(spans, sizes).collect()}
    assert out == {1: (0, 0, 2, False), 2: (1, 2, 0, False), 3: (1, 5, 0, False), 4: (0, 0, 0, True)}


def test_containing_span(spark):
    spans = spark.createDataFrame([(1, "A", 2, 5), (1, "B", 5, 7)], "doc_id int, span_id string, byte_start bigint, byte_end bigint")
    hits = spark.createDataFrame([(1, 0, "w"), (1, 2, "x"), (1, 5, "y"), (1, 7, "z")], "doc_id int, at bigint, verb string")
    assert {r.verb: r.span_id for r in audit.containing_span(hits, spans).collect()} == {"w": None, "x": "A", "y": "B", "z": None}


def test_roman(spark):
    assert [column(spark, x, text.from_roman) for x in ("iv", "XLIX", "iiii", "abc", "mcmxciv")] == [4, 49, None, None, 1994]
    assert column(spark, 3999, text.roman, "int") == "MMMCMXCIX" and column(spark, 4000, text.roman, "int") is None


def test_scalars(spark):
    assert column(spark, " Hello,  World! ", text.slugify) == "hello-world" and column(spark, "!!", text.slugify) == "untitled"
    assert [column(spark, x, text.coerce_label) for x in ("Requirement", "scope-exclusion", "TOC", "nope")] == ["requirement_bearing", "scope_exclusion", "structural", None]
    assert column(spark, ["toc", "x", "header", "definition"], text.coerce_labels, "array<string>") == ["structural", "definition"]
    assert column(spark, "(1) Clinical investigation means any study", text.defined_term) == "Clinical investigation"
    assert [column(spark, x, text.cited_part) for x in ("21 CFR 50.20", "see part 56", "§ 11.10", "none")] == ["50", "56", "11", None]
    assert column(spark, 'x ```json\n{"a": 1,}\n```', text.repair_json) == 'x ```json\n{"a": 1}\n```'
    assert column(spark, '```json\n{"a": [1,],}\n```', text.repair_json) == '{"a": [1]}'
    assert column(spark, "token: abcdefgh123", text.redact_keys) == "token: [redacted]"
    assert column(spark, "Incorrect API key provided: sk-abcdefgh12345678.", text.redact_keys) == "invalid_api_key"
    assert column(spark, "code invalid_api_key, sk-abcdefgh1", text.redact_keys) == "invalid_api_key"
    assert column(spark, "bad sk-abcdefgh_-1, sk-short", text.redact_keys) == "bad sk-[redacted], sk-short"
    assert column(spark, "{API key used here: ab c, x}", text.redact_keys) == "{API key used here: [redacted], x}"
    assert column(spark, "{'error': {'api_key': 'q w', 'n': 1}}", text.redact_keys) == "{'error': {'api_key': [redacted], 'n': 1}}"
    assert column(spark, "x" * 3000, text.redact_keys) == "x" * 1000
    dense = "x" * 160 + " " * 240
    assert column(spark, dense, text.is_degenerate) and not column(spark, dense[:-1], text.is_degenerate) and not column(spark, ("x" * 8 + " " * 12) * 20, text.is_degenerate)


def test_loose_match_takes_all_lines(spark):
    texts = ["\n".join(f"line {i}, of; many words" for i in range(12)), "one\ntwo\nthree,four here"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    d.write.mode("overwrite").parquet(f"{(folder := tempfile.mkdtemp(prefix='spark-'))}/documents.parquet")
    got = {r.doc_id: (r.restored, r.loose) for r in catalog.quote_loose_match_whole(spark, folder).collect()}
    assert got == {0: (True, True), 1: (False, True)}


def test_quotes(spark):
    rows = [("shall be FDA- regulated", "It shall be FDA-\nregulated now"), ("a, b c", "x a b,\n c"), ("gone", "text"), ("", "text"), (" ".join(f"w{i}" for i in range(200)), "\n".join(f"w{i}," for i in range(200)))]
    out = spark.createDataFrame(rows, "q string, t string").select(text.canonical_quote(F.col("q"), F.col("t")).alias("r")).collect()
    assert out[0].r == "shall be FDA- regulated" or out[0].r == "shall be FDA-\nregulated"
    assert out[1].r == "a b,\n c" and out[2].r == "gone" and out[3].r == "" and out[4].r.startswith("w0,\nw1,")


def test_many_short_quotes_are_not_listed_in_one_row(spark):
    texts = ["to be, or not to be", "", "ab-cd été 7", None, "--- x"]
    asked = ["be", "b", "not to", "---", "-", " ", "-- ", ", ", "!", "té", "cd été", "zz", "e, o", "", "7", "to be, or not", None]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    q = spark.createDataFrame(list(enumerate(asked)), "item_id bigint, text string")
    want = {(i, k, t.index(a)) for i, a in enumerate(asked) if a is not None for k, t in enumerate(texts) if t is not None and a in t}
    listed, looked_up = quotes.containment(d, q), quotes.containment(d, q, most_bytes=0)
    for df in (listed, looked_up):
        rows = [tuple(r) for r in df.select("item_id", "doc_id", "start").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    plan = looked_up._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "Join Cross" not in plan


def test_signals(spark):
    def found(t):
        return [(h["pattern_id"], h["start"]) for h in column(spark, t, signals.signals)]

    assert found("It shall include X and may go.") == [("shall", 3), ("shall_include", 3), ("includes", 9), ("may", 23)]
    assert found("May 27, 2016") == [] and found("Done. may go") == [] and found("(a) Use of tools") == [("use_of", 0)]
    assert found("does not apply; remain subject to") == [("does_not_apply", 0), ("remain_subject_to", 16)]
    assert column(spark, "it is not applicable", signals.has_obligation) is False and column(spark, "you should", signals.has_obligation) is True


def test_reconcile_keeps_disagreement(spark):
    a = spark.createDataFrame([(1, "S1", "a", "x", ["p"]), (1, "S1", "b", "x", ["q"]), (1, "S2", "a", "x", []), (1, "S2", "b", "y", ["q"]), (1, "S3", "a", "x", []), (1, "S3", "b", "y", []), (1, "S3", "r", "z", ["k"])], "doc_id int, span_id string, agent string, label string, embedded array<string>")
    out = {r.span_id: (r.final_label, r.final_embedded, r.ambiguous) for r in annotate.reconcile(a).collect()}
    assert out == {"S1": ("x", ["p", "q"], False), "S2": ("x", ["q"], True), "S3": ("z", ["k"], True)}
    assert {r.span_id: r.final_embedded for r in annotate.reconcile(a, enforce_union=True).collect()}["S3"] == ["k"]


def test_pending_life_cycle(spark):
    classes = spark.createDataFrame([(1, "S1", "requirement_bearing", ["definition"], False), (1, "S2", "definition", ["requirement_bearing"], False), (1, "S3", "definition", [], False)], "doc_id int, span_id string, final_label string, final_embedded array<string>, ambiguous boolean")
    none = spark.createDataFrame([], "doc_id int, source_span_id string, req_id string, verbatim_quote string, ambiguous boolean")
    once = annotate.mark_pending(classes, none)
    twice = annotate.mark_pending(once, none)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    got = {r.span_id: (r.downgrade_pending, r.downgrade_proposal and r.downgrade_proposal.proposed_label) for r in twice.collect()}
    assert got == {"S1": (True, "definition"), "S2": (True, "definition"), "S3": (False, None)}
    extracted = spark.createDataFrame([(1, "S1", "R1", "q", False)], none.schema)
    assert {r.span_id: r.downgrade_pending for r in annotate.mark_pending(twice, extracted).collect()} == {"S1": False, "S2": True, "S3": False}


def test_cycles_marked_once(spark):
    edges = spark.createDataFrame([(a, b, "refines", "e", False) for a, b in [(1, 2), (2, 3), (3, 1), (3, 4), (5, 5), (6, 7), (7, 6), (8, 1)]], "src int, dst int, type string, evidence string, ambiguous boolean")
    out = graph.mark_cycles(graph.mark_cycles(edges))
    assert {(r.src, r.dst) for r in out.filter("ambiguous").collect()} == {(1, 2), (2, 3), (3, 1), (5, 5), (6, 7), (7, 6)}
    assert {r.evidence for r in out.filter("ambiguous").collect()} == {"e [cycle]"}


def test_parent_chains_end_on_cycles(spark):
    rows = spark.createDataFrame([(1, "a", None, "A"), (1, "b", "a", "B"), (1, "c", "b", "C"), (1, "x", "y", "X"), (1, "y", "x", "Y"), (1, "o", "gone", "O")], "doc int, id string, up string, name string")
    out = {r.id: r.chain for r in graph.parent_chains(rows, "doc", "id", "up", "name").collect()}
    assert out["a"] == "(top-level)" and out["b"] == "A" and out["c"] == "A > B" and out["o"] == "(top-level)"


def test_cross_refs(spark):
    spans = spark.createDataFrame([(1, 1, "A", "section_header", "50.2", [], "§ 50.2 X"), (1, 2, "B", "paragraph", "50.2", ["a"], "(a) t"), (2, 1, "C", "paragraph", "60.1", ["a"], "see § 50.2(a)(9) and § 50.2(a)(9), § 60.1, part 50, part 77, part 77, §§ 50.2 through 50.9, 21 CFR 50.2")], "doc_id int, seq int, span_id string, kind string, section string, path array<string>, text string")
    parts = spark.createDataFrame([("50", 1), ("60", 2)], "part string, doc_id int")
    out = refs.cross_refs(refs.citations(spans.filter("doc_id = 2")), spans, parts).collect()
    assert sorted((r.ref_type, r.target_span or "", r.auto_resolved) for r in out) == [("part", "", False), ("part", "", False), ("part", "", True), ("section", "A", True), ("section", "B", True)]


def test_packets(spark):
    have = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    out = spark.createDataFrame([(1,), (1,), (3,), (9,)], "id int")
    assert {(r.id, r.status) for r in packets.validate(have, out, "id").collect()} == {(1, "duplicate"), (2, "missing"), (9, "extra")}
    merged = packets.merge(spark.createDataFrame([(1, "old")], "id int, v string"), spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id int, v string"), "id", ["v"])
    assert {(r.id, r.v) for r in merged.collect()} == {(1, "old"), (2, "a")}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    assert readers.json_lines(spark, str(tmp_path / "a.jsonl"), "id int").count() == 2
    assert readers.json_lines(spark, str(tmp_path / "none.jsonl"), "id int", missing_ok=True).count() == 0
    (tmp_path / "b.jsonl").write_text('{"id": 1}\nnot json\n')
    try:
        readers.json_lines_strict(spark, str(tmp_path / "b.jsonl"), "id int")
        raise AssertionError("no error")
    except readers.BadRecords as e:
        assert "not json" in str(e)
    for slug in ("good-one", "bad"):
        (tmp_path / "docs/fda" / slug).mkdir(parents=True)
    (tmp_path / "docs/fda/good-one/meta.json").write_text('{"title": "T"}')
    (tmp_path / "docs/fda/bad/meta.json").write_text("{broken")
    assert [r.doc_id for r in readers.catalog(spark, str(tmp_path / "docs"), "title string").collect()] == ["fda/good-one"]
    assert [column(spark, x, readers.valid_doc_id) for x in ("fda/ok-1", "fda/../x", "/etc", "fda/.x")] == [True, False, False, False]
    root = str(tmp_path / "table")
    sinks.publish(spark.range(3), root, "1")
    sinks.publish(spark.range(5), root, "2")
    assert sinks.read_published(spark, root).count() == 5
    assert sinks.upsert(spark.range(3).withColumn("v", F.lit(1)), spark.range(1).withColumn("v", F.lit(2)), "id").agg(F.sum("v")).first()[0] == 4


def test_same_multiset_counts_values(spark):
    rows = [(1, "a", "x "), (1, "a", "x"), (1, "b", "x"), (1, "b", " x"), (2, "a", "x"), (2, "a", "x"), (2, "b", "x"), (3, "a", None), (3, "b", ""), (4, "b", "y"), (None, "a", "x"), (None, "b", "x")]
    df = spark.createDataFrame(rows, "k int, agent string, v string")
    out = annotate.same_multiset(df.filter("agent = 'a'"), df.filter("agent = 'b'"), ["k"], "v")
    assert {r.k: r.equal for r in out.collect() if r.k} == {1: True, 2: False, 3: True, 4: False}
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()  # a group as one row fails by memory


def test_no_frame_runs_on_from_the_row(spark):
    lines_ = doc_lines(spark, "[1 FR 2,\nas amended\nat 3 FR 4]\n§ 1.1 A.\n[5 FR 6,\nopen")
    out = segment.regulation_lines(lines_, F.lit(1))
    assert [r["class"] for r in out.orderBy("line_no").collect()] == ["amended", "inside_note", "inside_note", "section", "amended", "prose"]
    assert "currentrow$(), unboundedfollowing$()" not in out._jdf.queryExecution().optimizedPlan().toString()  # quadratic in a document's lines


def test_long_quotes_make_no_pattern(spark, monkeypatch):
    """Words of a long quote are found across commas, wraps and hyphens without a pattern of all its words."""
    words = [f"w{i % 7}-{i}x" for i in range(20_000)]
    held = "Ab, ;" + ",\n ".join(words).replace("-", "-\n") + "yz; end"
    cases = [(" ".join(words), held), ("a b", "xa,\nbc"), ("a b", "a,b"), ("a- b", "a- ,\n b"), ("a-b c-", "za-  b, c- \nd"), ("a a b", "a a a b"), ("a b", None)]
    monkeypatch.setattr(text.re, "search", lambda *a: pytest.fail("a pattern of the whole quote"))
    out = text.long_quotes(*(text.pa.array(c) for c in zip(*cases, strict=True))).to_pylist()
    assert out == [held[held.index("w0-") : held.index("yz; end")], "a,\nb", None, "a- ,\n b", "a-  b, c- \n", "a a b", None]


def test_citations_read_their_text_once(spark):
    kind = "doc_id int, seq int, span_id string, kind string, section string, path array<string>, text string"
    rows = [(1, 1, "S1", "paragraph", "11.1", ["a"], "see § 12.5, § 12.5 and part 12, part 12, § 99.1, § 99.1"), (2, 1, "S1", "section_header", "12.5", [], "x")]
    spans = spark.createDataFrame(rows, kind)
    cites = refs.citations(spans.filter("kind = 'paragraph'"))
    assert cites._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = refs.cross_refs(cites, spans, spark.createDataFrame([("11", 1), ("12", 2)], "part string, doc_id int"))
    told = sorted((r.ref_type, r.target_doc or 0, r.target_span or "", r.auto_resolved) for r in got.collect())
    assert told == [("part", 2, "", True), ("section", 0, "", False), ("section", 0, "", False), ("section", 2, "S1", True)]
