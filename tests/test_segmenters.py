"""Segmenters on random texts against a plain walk through the lines, and cycles against plain reachability."""

import random
import re

from pyspark.sql import functions as F

from spanledger.functions import rules
from spanledger.operators import graph, lines, segment

POOL = (
    "Title 21—Food", "Chapter I—Agency", "Part 11 Lower case", "Subpart A Contents", "Subpart B—Body", "Subpart C—More", "§ 11.1 Scope.", "§ 11.2 Terms.", "§ 11.3 Use.", "§ 160.2 Foreign.", "§ 11.2 of this part says", "(a) one", "(b) two", "(c) three", "(h) eight", "(i) nine or one", "(ii) two",
    "(iii) three", "(iiii) odd", "(v) five", "(1) first", "(2) second", "(A) upper", "(B) upper", "Prose line.", "lower prose", "Authority: law", "Source: law", "[62 FR 1, Mar. 20, 1997]", "[62 FR 2, Mar. 21,", "1998 as amended]", "", "Appendix A to this", "PART 11—RECORDS",
)
ROMAN = {"i": 1, "ii": 2, "iii": 3, "v": 5}


def classed(text):
    if not text:
        return "blank"
    order = (("title", f"{rules.TITLE}|{rules.CHAPTER}"), ("part", rules.PART_HEADER), ("part_toc", rules.PART_TOC), ("authority", rules.AUTHORITY), ("source_note", rules.SOURCE_NOTE), ("subpart", rules.SUBPART), ("subpart_toc", rules.SUBPART_TOC), ("section", rules.SECTION), ("note", rules.AMENDED_OPEN), ("marker", r"^\((?:[a-z]|\d+|[ivxlcdm]+|[A-Z])\)"))
    return next((name for name, rx in order if re.match(rx, text)), "prose")


def walk(text):
    """(kind, start, path, index of the parent) of each span, by one walk."""
    rows, at = [], 0
    for line in text.split("\n")[:-1]:
        rows.append((at, line))
        at += len(line.encode()) + 1
    kinds, skip = [classed(t) for _, t in rows], set()
    for i, k in enumerate(kinds):
        if k == "note" and i not in skip and not rows[i][1].endswith("]"):
            end = next((j for j in range(i + 1, len(rows)) if "]" in rows[j][1]), None)
            skip.update(range(i + 1, end + 1) if end else ())
    kinds = ["inside" if i in skip else k for i, k in enumerate(kinds)]
    out, body, seen, done = [], False, set(), set()
    subpart = section = None
    open_at, last_roman, deepest, chapeau = {}, 0, 0, False

    def emit(kind, start, path=(), parent=None):
        out.append((kind, start, tuple(path), parent))
        return len(out) - 1

    for i, ((start, t), k) in enumerate(zip(rows, kinds, strict=True)):
        if k in ("blank", "inside"):
            continue
        number = re.match(rules.SECTION, t)[1] if k == "section" else None
        if k == "section":
            body = body or number in seen
            seen.add(number)
        if k == "part":
            body, subpart, section = True, None, None
            emit("part_header", start)
            continue
        if k in ("title", "part_toc", "subpart_toc") and not body:
            emit("toc_entry" if k == "subpart_toc" else "document_title", start)
            continue
        if k in ("authority", "source_note"):
            emit(k, start)
            chapeau = False
            continue
        if k == "subpart" and body:
            subpart, section = emit("subpart_header", start), None
            continue
        if k == "note":
            emit("source_note", start, (), section)
            chapeau = False
            continue
        if k == "section" and not body:
            emit("toc_entry", start)
            continue
        if k == "section" and number.startswith("11.") and not re.match(r"^§\s*[\d.]+\s+[a-z]", t):
            nxt = next((j for j in range(i + 1, len(rows)) if kinds[j] not in ("blank", "inside") and not (kinds[j] == "prose" and rows[j][1][0].islower())), None)
            if nxt is not None and (kinds[nxt] in ("section", "subpart", "part") or rows[nxt][1].startswith("Appendix")):
                emit("toc_entry", start, (), subpart)
                chapeau = False
                continue
            if number not in done:
                done.add(number)
                section = emit("section_header", start, (), subpart)
                open_at, last_roman, deepest, chapeau = {}, 0, 0, False
                continue
        if section is None:
            continue
        if k == "marker":
            m = re.match(r"\((\w+)\)", t)[1]
            value = ROMAN.get(m, 0)
            if m.isdigit():
                level = 2
            elif m.isupper():
                level = 4
            elif len(m) > 1:
                level = 3
            elif 2 in open_at and value and (value == last_roman + 1 if last_roman else deepest == 2 and m == "i"):
                level = 3
            else:
                level = 1
            open_at = {n: v for n, v in open_at.items() if n < level}
            last_roman = 0 if level < 3 else value or last_roman if level == 3 else last_roman
            deepest = level
            path = [v[1] for _, v in sorted(open_at.items())] + [m]
            above = open_at[max(open_at)][0] if open_at else section
            open_at[level] = (emit("paragraph", start, path, above), m)
        elif not open_at and not chapeau:
            emit("section_chapeau", start, (), section)
            chapeau = True
    return out


def test_regulation_spans_of_random_texts(spark):
    rng = random.Random(12)
    texts = ["\n".join(rng.choice(POOL[: len(POOL) - (i % 2)]) for _ in range(rng.randint(1, 40))) + "\n" for i in range(120)]
    texts += ["PART 11—X\n§ 11.1 Scope.\n[62 FR 2, never closed\n(a) one\n§ 11.2 Next.\n(b) two\n", "PART 11—X\n§ 11.1 Scope.\nLead.\n[62 FR 1, 1997]\nLead again.\n(1) n\n(i) r\n(iiii) odd\n(ii) goes on\n"]
    d = lines.split_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).repartition(2)
    got: dict = {}
    for r in segment.regulation_spans(d, F.lit("11")).orderBy("doc_id", "seq").collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.byte_start, tuple(r.path), int(r.parent_span_id[1:]) - 1 if r.parent_span_id else None))
    for i, text in enumerate(texts):
        assert got.get(i, []) == walk(text), text


def test_guideline_spans_of_random_texts(spark):
    pool = ("E6 title", "I. INTRODUCTION", "II. METHODS", "GLOSSARY", "1.1 First", "1.2 Second", "1.1.1 Deep", "1.1.1.4 Deeper", "Prose here", "more prose", "", "2.1 Other ..... 7", "ICH E6 Guideline")
    rng = random.Random(13)
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25))) + "\n" for _ in range(80)]
    got: dict = {}
    for r in segment.guideline_spans(lines.split_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))).orderBy("doc_id", "seq").collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.section, int(r.parent_span_id[1:]) - 1 if r.parent_span_id else None))
    for i, text in enumerate(texts):
        want, part, known, prior = [], None, {}, None
        for t in text.split("\n"):
            if not t or t.startswith("ICH"):
                continue
            kind = "toc_entry" if "..." in t else "part_header" if t == "GLOSSARY" or re.match("I+\\. [A-Z]+$", t) else "decimal" if re.match(r"\d\.", t) else "prose"
            if not want:
                kind = "document_title"
            here = len(want)
            if kind == "part_header":
                part, known = here, {}
                want.append((kind, None, None))
            elif kind == "decimal":
                number = t.split()[0]
                pieces = number.split(".")
                above = next((known[p] for n in range(len(pieces) - 1, 0, -1) if (p := ".".join(pieces[:n])) in known), part)
                want.append((kind, number, above))
                known[number] = here
            elif kind != "prose":
                want.append((kind, None, None))
            elif part is not None and prior != "prose":
                want.append(("section_chapeau", None, part))
            prior = kind
        assert got.get(i, []) == want, text


def test_cycles_by_colouring_and_by_doubling(spark, monkeypatch):
    rng = random.Random(14)
    pairs = sorted({(rng.randrange(14), rng.randrange(14)) for _ in range(24)})
    reach = {a: {b for x, b in pairs if x == a} for a in range(14)}
    for _ in range(14):
        reach = {a: r | {c for b in r for c in reach[b]} for a, r in reach.items()}
    want = sorted((a, b) for a, b in pairs if a in reach[b] or a == b)
    d = spark.createDataFrame(pairs, "src bigint, dst bigint")
    for bound in (1000, 0):
        monkeypatch.setattr(graph, "DOUBLED", bound)
        assert sorted(tuple(r) for r in graph.cycle_edges(d).collect()) == want
