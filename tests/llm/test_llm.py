"""The training-data operators against brute force, and on nulls, empties, long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from spanledger.llm import ann, chat, components, decontaminate, licenses, mixing, neardup, quality, queries, secrets, token_counts, toxicity
from spanledger.llm.common import held_out

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = "doc_id bigint, text string, source string, spans string, hits string, score string, `Secret_Key` string, replica string"


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)], DOCS)


def odd(spark, texts):
    """Documents whose other columns bear the names that operators use."""
    return spark.createDataFrame([(i, t, None, "a", "b", "c", "d", "e") for i, t in enumerate(texts)], ODD)


def words_of(rx, text):
    return re.findall(rx, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


# 1

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_contamination(texts, items):
    out = []
    for t in texts:
        w, hit, by = words_of(ALNUM, t), set(), set()
        for item, x in items:
            b = words_of(ALNUM, x)
            n = min(13, len(b))
            for i in range(max(1, len(b) - 12) if b else 0):
                for k in range(len(w) - n + 1):
                    if w[k : k + n] == b[i : i + n]:
                        hit.update(range(k, k + n))
                        by.update([str(item)] * (item is not None))
        out.append((len(w), len(hit), sorted(by)))
    return out


def test_contamination_is_that_of_brute_force(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["the", "Of", "a", "é", "x1", "Straße", "中"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 12, 13, 14, 20])))) for i in range(25)] + [(None, "unlisted words stand here"), (3, None), (7, "repeat me"), (7, "repeat me")]
    texts = [None, "", " .,", "A" * 200_000] + [" ".join([word() for _ in range(rng.randint(0, 40))] + (rng.choice(items)[1] or "").split() + [word() for _ in range(20)]) for _ in range(60)] + ["unlisted, WORDS stand\nhere"] * 2
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, spans string")
    for size, whole in ((8 << 20, 32 << 20), (60, 32 << 20), (400, 1200)):  # one block; many; several passes
        got = decontaminate.contamination(odd(spark, texts), bench, into="found", block_bytes=size, pass_bytes=whole).orderBy("doc_id").collect()
        assert [(r.found.n_words, r.found.n_hit, sorted(r.found["items"])) for r in got] == brute_contamination(texts, items)
        assert got[0].spans == "a" and got[0].hits == "b"


def test_decontaminate_documents_and_spans(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    texts = [f"Clean. {passage.upper()}! rest", "w " * 400 + passage, "clean", None]
    assert [r.doc_id for r in decontaminate.decontaminate(odd(spark, texts), bench).orderBy("doc_id").collect()] == [1, 2, 3]
    cut = decontaminate.decontaminate(odd(spark, texts), bench, remove="spans").orderBy("doc_id").collect()
    assert [r.text for r in cut] == ["Clean. ! rest", "w " * 400, "clean", None] and cut[0].asDict().keys() == odd(spark, texts).first().asDict().keys()
    assert decontaminate.decontaminate(docs(spark, texts), bench.limit(0)).count() == 4 and decontaminate.decontaminate(docs(spark, texts).limit(0), bench).count() == 0


# 2


def test_token_counts_are_the_library_s(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(2)
    letters = "abcdeésßΣςσİıﬁ  \t\n'sretmll0١4.,!?<|endoftext|>中文한😀​́\x1c\x85ABC　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(400)] + ["", "a<|endoftext|>b<|startoftext|><|endoftext|", "a" * 5000, "中" * 3000, "ΑΣ it's we'll"]
    want = [len(x.ids) for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    got = token_counts.token_counts(odd(spark, [*texts, None]), path).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [*want, 0]
    assert [r.n_bytes for r in got] == [*(len(t.encode()) for t in texts), 0] and [r.over_limit for r in got] == [n > 2048 for n in [*want, 0]]


# 3


def brute_spans(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?a)([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(found)


def test_base_spans_are_those_of_brute_force(spark):
    rng = random.Random(3)
    parts = ["password", "PassWD=", "api_key", "APIKEY: ", '"token" = "', "ſecret=", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", " ", "\n", "é", "x" * 11, "aB3" * 7, "=", ":"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "f" * 100_000]
    found = secrets.secret_spans(docs(spark, texts)).orderBy("doc_id").collect()
    assert [[(s.start, s.kind, s.end) for s in r.spans if s.kind < 3] for r in found] == [brute_spans(t or "") for t in texts]


def test_ownership_tells_examples_from_live_values(spark):
    example, live, wide = "password=EXAMPLE0example1", "token: q8Zr5Tt0pLm2Wx9", "Zk3Lm9Qw2Xv8Bn4Rt6Yh1P"
    rows = [(i, f"see {example}", f"owner{i}/r") for i in range(9)] + [(10, f"my {live} and {wide}", "me/r"), (11, None, None), (12, f"my {live} and {wide}", "me/r")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: [(s.kind, s.live, s.n_owners) for s in r.spans] for r in secrets.secret_spans(d).collect()}
    assert found[0] == [(0, False, 9)] and found[10] == [(0, True, 1), (3, True, 1)] == found[12] and found[11] == []
    out = {r.doc_id: r.text for r in secrets.redact(d.withColumn("secret_spans", F.lit(1)).withColumn("secret_key", F.lit(2))).collect()}
    assert out[0] == f"see {example}" and out[10] == "my <secret> and <secret>" and out[11] is None
    assert secrets.redact(d.limit(0)).columns == d.columns


# 4


def test_patience_alignment():
    assert licenses.patience(list("abcxde"), list("abycde")) == [(0, 0), (1, 1), (2, 3), (4, 4), (5, 5)]
    assert licenses.increasing([(0, 5), (1, 1), (2, 2), (3, 0), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 20))] for _ in "ab")
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:], strict=False))
    assert licenses.patience(list("hello"), list("hello")) == [(i, i) for i in range(5)]


def test_licenses(spark):
    mit = licenses.MIT
    texts = ["x " * 500 + "Licensed under the Apache License, Version 2.0. y", mit.replace("free of charge", "gratis, free of any charge"), "The license was lost under the bed, version unknown.", None, "", "All rights reserved. Released under the MIT License.", mit[:200], "z" * 300_000]
    got = licenses.license_matches(odd(spark, texts), into="found").orderBy("doc_id").collect()
    names = [[m.license for m in r.found.matches] for r in got]
    assert names == [["Apache-2.0"], ["MIT"], [], [], [], ["MIT", "LicenseRef-All-Rights-Reserved"], [], []]
    assert (got[0].found.matches[0].first, got[0].found.matches[0].coverage) == (500, 1.0)


def found_in(text):
    return [m["license"] for m in licenses.Templates().scan(text.encode())["matches"]]


@pytest.mark.parametrize("kind, version, name", [("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Library ", "2", "LGPL-2.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("Lesser ", "3", "LGPL-3.0"), ("Affero ", "3", "AGPL-3.0")])
def test_gnu_licenses_are_told_apart(kind, version, name):
    text = f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
    assert found_in(f"a b {text} c d") == [name]


@pytest.mark.parametrize("kind", ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"])
def test_creative_commons_licenses_are_told_apart(kind):
    assert found_in(f"a b Licensed under CC {kind} 4.0. c d") == [f"CC-{kind}-4.0"]


def test_stretched_words_are_no_license():
    assert found_in("All of our human rights were reserved for later.") == [] and found_in("ALL RIGHTS, RESERVED") == ["LicenseRef-All-Rights-Reserved"]


def longest(a, b):
    """The longest common subsequence, by the plain table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_licenses_of_random_templates_against_brute_force():
    rng = random.Random(9)
    for _ in range(150):
        template = [rng.choice("abcdefghijkl") for _ in range(rng.randint(6, 16))]
        notice = list(template)
        if rng.random() < 0.5:
            notice[rng.randrange(len(notice))] = "z"
        noise = lambda: [rng.choice("abcdxyz") for _ in range(rng.randint(0, 12))]
        text = noise() + (notice if rng.random() < 0.7 else noise()) + noise()
        found = licenses.Templates((("T", " ".join(template)),)).scan(" ".join(text).encode())["matches"]
        fits = [(i, j) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if (k := longest(template, text[i:j])) >= 0.85 * len(template) and j - i <= 1.25 * k]
        if found:
            (m,) = found
            assert m["matched"] <= longest(template, text[m["first"] : m["last"]]) and m["coverage"] == m["matched"] / len(template) >= 0.85
        assert bool(found) <= bool(fits) and (found or not any(text[i : i + len(template)] == template for i in range(len(text))))


def test_bsd_licenses_are_told_apart():
    head = f"{licenses.BSD} {licenses.CLAUSES[0]} {licenses.CLAUSES[1]} provided with the distribution."
    end = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"
    assert found_in(f"{head} {end}") == ["BSD-2-Clause"]
    assert found_in(f"{head} Neither the name of {licenses.CLAUSES[2]} {end}") == ["BSD-3-Clause"]
    assert found_in(licenses.BSD) == ["LicenseRef-BSD"]


def test_every_template_finds_its_own_license_alone():
    for name, text in licenses.TEMPLATES:
        assert found_in("a b " + text.replace("{", "").replace("}", "") + " c d") == [name]


def test_licenses_repeated_closely():
    scan = licenses.Templates().scan
    texts = {"x y all rights reserved all rights reserved z w": (2, 5), "Foo Released under the MIT License. Released under the MIT License. bar": (1, 6)}
    for text, place in texts.items():
        (m,) = scan(text.encode())["matches"]
        assert m["coverage"] == 1.0 and (m["first"], m["last"]) in (place, (place[1], 2 * place[1] - place[0]))


# 5


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    for stretched in (False, True):
        x = rng.normal(size=(600, 24))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x = x * rng.uniform(0.2, 3, (600, 1)) if stretched else x
        x[7] = x[8] = x[9]
        d = spark.createDataFrame([(i, v.tolist(), "q") for i, v in enumerate(x)], "vec_id bigint, embedding array<double>, score string")
        got = ann.search(d.filter("vec_id % 20 = 0"), d, k=10, probes=3.0).collect()
        hit = 0
        for q in range(0, 600, 20):
            s = (x * x[q]).sum(1)
            want = sorted((-s[i], i) for i in range(600) if i != q)[:10]
            mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
            assert [m[0] for m in mine] == list(range(1, 11)) and all(m[2] == pytest.approx(s[m[1]], abs=1e-12) for m in mine)
            assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
            hit += len({i for _, i in want} & {m[1] for m in mine})
        assert hit >= 0.9 * 300


@pytest.mark.parametrize("case", ["one long", "lognormal"])
def test_search_recall_with_unequal_lengths(spark, case):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= np.exp(0.5 * rng.standard_normal((2000, 1))) if case == "lognormal" else 1
    x[7] *= 10 if case == "one long" else 1
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in ann.search(d.filter("vec_id % 20 = 0"), d, exact_rows=100).collect()}
    score = x[::20] @ x.T
    score[np.arange(100), np.arange(0, 2000, 20)] = -np.inf
    want = {(20 * q, int(v)) for q, row in enumerate(np.argsort(-score, axis=1)[:, :20]) for v in row}
    assert len(got) == 2000 and len(got & want) >= 0.93 * 2000


def test_search_gives_all_candidates_of_small_tables(spark):
    x = np.random.default_rng(8).normal(size=(18, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1] = -x[0]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    assert {(r.query_id, r.vec_id) for r in ann.search(d, d).collect()} == {(q, v) for q in range(18) for v in range(18) if q != v}


def test_search_fills_up_and_bears_extreme_lengths(spark):
    x = np.random.default_rng(11).normal(size=(22, 3))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    assert sorted((r.query_id, r.rank) for r in ann.search(d.filter("vec_id % 20 = 0"), d).collect()) == [(q, k) for q in (0, 20) for k in range(1, 21)]
    for size in (1e200, 1e-170):
        rows = [(0, [size, 0.0]), (1, [0.9 * size, 0.1 * size]), (2, [0.5 * size, 0.0]), (3, [-size, size])]
        got = ann.search(spark.createDataFrame(rows[:1], "vec_id bigint, embedding array<double>"), spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).orderBy("rank").collect()
        assert [r.vec_id for r in got] == [1, 2, 3] and len({r.score for r in got}) == (2 if size > 1 else 1)


def test_search_leaves_out_what_is_no_vector(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [0.5, 0.5]), (20, [float("inf"), 0.0]), (1, [0.5, 0.5])]
    d = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(ann.search(d.filter("vec_id = 0 OR vec_id = 20 OR vec_id = 8"), d).collect(), key=lambda r: r.rank)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 0.5), (0, 2, 9, 0.5)]
    assert ann.search(d.limit(0), d.limit(0)).count() == 0


# 6


def test_mixing_meets_its_targets_and_repeats_itself(spark):
    rows = [(i, "w" * 100, "en", "big" if i < 3000 else "small" if i < 3300 else None, 100) for i in range(3400)] + [(None, None, "en", "none", 0), (9999, "", "en", "none", 0)]
    d = spark.createDataFrame(rows, DOCS).withColumn("mix_source", F.lit("x"))
    out = mixing.mix(d, weights={"big": 0.5, "small": 0.5})
    n = Counter(r.source for r in out.select("source").collect())
    assert set(n) == {"big", "small"} and abs(n["small"] / (n["big"] + n["small"]) - 0.5) < 0.04
    first = lambda: sorted((r.doc_id, r.replica) for r in mixing.mix(d).select("doc_id", "replica").collect() if r.doc_id is not None)
    assert first() == first() and mixing.mix(d).columns == [*d.columns, "replica"]
    assert mixing.mix(d.limit(0)).count() == 0


def test_large_rates_are_sums_of_pieces(spark):
    d = spark.createDataFrame([(i, "a", "en", "x", 1) for i in range(60)] + [(10**6 + i, "b" * 100_000, "en", "y", 1) for i in range(2)], DOCS)
    n = mixing.mix(d, weights={"x": 1.0}).count()
    mean = 60 * (60 + 200_000) / 60
    assert abs(n - mean) < 6 * mean**0.5


# 7 and 8


@pytest.fixture(scope="module")
def larger(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return d, spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


def accuracy(scored, labels, label, least):
    rows = scored.filter(held_out(F.col("doc_id"))).join(labels, "doc_id").select(label, "score").collect()
    ones, zeros = ([r.score >= least for r in rows if r[label] == y] for y in (1, 0))
    return sum(ones) / len(ones), 1 - sum(zeros) / len(zeros)


def test_quality_on_held_out_rows(spark, larger):
    keep, reject = accuracy(quality.quality_scores(larger[0].select("doc_id", "text"), larger[1]), larger[1], "quality", 0.3)
    assert keep > 0.98 and reject > 0.9


def test_toxicity_on_held_out_rows(spark, larger):
    caught, clean = accuracy(toxicity.toxicity_scores(larger[0].select("doc_id", "text"), larger[1]), larger[1], "toxic", 0.5)
    assert (caught + clean) / 2 > 0.93


def test_conflicting_labels_teach_nothing(spark):
    some = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (3, 1), (4, 0)], "doc_id bigint, toxic int")
    assert {(r.id, r.label) for r in quality.known_labels(some, "toxic", "doc_id").collect()} == {(i, y) for i, y in ((2, 1), (3, 1), (4, 0)) if not spark.range(i, i + 1).filter(held_out(F.col("id"))).count()}


def test_outputs_leave_columns_of_their_names(spark):
    d = spark.createDataFrame([(1, "a b", "mine", "mine", "mine")], "doc_id bigint, text string, score string, Hits string, N_TOKENS string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.quality_scores(d, none).columns == [*d.columns, "score_"] and toxicity.toxicity_scores(d, none).columns == [*d.columns, "score_"]
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(d, bench).columns == [*d.columns, "hits_"]
    counted = token_counts.token_counts(d, public_tokenizers.path("word_bpe_49k.json")).first()
    assert (counted.N_TOKENS, counted["n_tokens_"], counted.n_bytes, counted.over_limit) == ("mine", 2, 3, False)
    r = mixing.mix(d.withColumn("source", F.lit("s")).withColumn("replica", F.lit("mine"))).first()
    assert r is None or r.replica == "mine"


@pytest.mark.parametrize("scores", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores_of_odd_rows(spark, scores):
    texts = [None, "", "x" * 300_000, "plain text", "plain text"]
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None), (3, 1, 1), (4, 0, 1)], none.schema)
    for labels in (none, some):
        got = [r.result for r in scores(odd(spark, texts), labels, into="result").orderBy("doc_id").collect()]
        assert all(0 <= s <= 1 for s in got) and got[3] == got[4]
    assert scores(docs(spark, texts).limit(0), some).count() == 0


# 9

SPACED = r"[^\x20\x09-\x0D]+"


def brute_groups(rows, n, percent):
    sets = []
    for _, t in rows:
        w = words_of(SPACED, t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def near_texts(seed):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 90))) for _ in range(12)]
    out = [None, "", " \n", "one", "One", "a b", "x " * 5000]
    for b in base:
        for _ in range(rng.randint(1, 14)):
            w = b.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"v{rng.randint(0, 9999)}"
            out.append((" " if rng.random() < 0.8 else "\t").join(w))
    return [(rng.randint(0, 10**6), t) for t in out]


@pytest.mark.parametrize(("n", "percent", "nodes", "bucket"), [(3, 85, 750, 512), (5, 80, 750, 512), (3, 85, 8, 4)])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, n, percent, nodes, bucket):
    monkeypatch.setattr(neardup, "GROUP_NODES", nodes)  # small groups and buckets: large ones are cut as at scale
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    monkeypatch.setattr(neardup, "PIVOTS", 2)
    rows = near_texts(n + nodes)
    rows += [(None, rows[-1][1]), (None, "only null"), (None, "only null"), (rows[9][0], rows[9][1])]
    d = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id bigint, text string, kept string").repartition(3)
    got = [(r.id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(d, words=n, percent=percent).collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(brute_groups(rows, n, percent))


@pytest.mark.parametrize("apart", [0, 12])
def test_groups_are_cut_by_their_shingles(spark, monkeypatch, apart):
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 20_000)
    monkeypatch.setattr(neardup, "BUCKET", 8)  # wide buckets are groups unchecked, so that some of a group is not linked
    rng, loads, plain = random.Random(9), [], neardup.classes_of

    def spied(rows, scheme, *keys):
        words = F.size(F.split(F.col("text").cast("string"), " "))
        loads.append(rows.groupBy(*keys).agg(F.sum(words).alias("w")).agg(F.max("w")).first()[0] or 0)
        return plain(rows, scheme, *keys)

    monkeypatch.setattr(neardup, "classes_of", spied)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(2000)]
    rows = []
    for i in range(40):
        w = list(base)
        for j in range(1000, 1000 + (120 if i < apart else 0)):
            w[j * 2 % 2000] = f"x{i}.{j}"  # spread: more than a fifth of the shingles are its own
        w[rng.randrange(500)] = f"v{i}"
        rows.append((i, " ".join(w)))
    got = [(r.id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()]
    assert sorted(got) == sorted(brute_groups(rows, 5, 80)) and len(loads) > 1
    assert max(loads) <= 30_000


def test_near_duplicates_with_text_ids_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr("spanledger.llm.common.HOT_ROWS", 5)
    rows = [(f"id{i:03}" if i else None, "same words stand in all of these") for i in range(40)] + [("z", "quite other words are here"), ("y", None)]
    d = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.id: (r.component_id, r.kept) for r in neardup.near_duplicates(d).collect()}
    assert all(got[i] == ("id001", i == "id001") for i, _ in rows[:40]) and got["z"] == ("z", True) and got["y"] == ("y", True)
    assert sorted(r.doc_id for r in neardup.deduplicate(d).collect()) == ["id001", "y", "z"]


def test_deduplicate_leaves_one_of_each(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, "other words stand here now ok"), (4, None), (5, None), (6, ""), (3, "other words stand here now ok")]
    d = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, dedup_key string, id string")
    assert sorted(r.doc_id for r in neardup.deduplicate(d).collect()) == [1, 3, 4, 5, 6]
    assert neardup.deduplicate(d).columns == d.columns and neardup.deduplicate(d.limit(0)).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(6)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    name = lambda i: i.to_bytes(2, "big")
    got = {r.node: r.root for r in components.components(spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in pairs], "a binary, b binary")).collect()}
    up: dict = {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    assert {bytes(k): bytes(v) for k, v in got.items()} == {name(x): name(find(x)) for a, b in pairs if a != b for x in (a, b)}


# 10


def test_events_fold_and_render(spark):
    log = [("c", 1, 1, "delta", "user", "He"), ("c", 1, 2, "delta", None, "llo"), ("c", 2, 5, "delta", "assistant", "bad"), ("c", 2, 6, "regenerate", None, None), ("c", 2, 7, "delta", None, "good <x> \\l"), ("c", 2, 8, "delta", None, "!"), ("c", 3, 9, "delta", "user", "x"), ("c", 3, 10, "edit", None, "edited"), (None, None, None, None, None, None), ("d", 1, 1, "delta", "a\nb", "</turn>\n<turn>"), ("d", 1, 1, "delta", "a\nb", "</turn>\n<turn>")]
    out = {r.conv_id: r for r in chat.read_back(chat.format_chats(spark.createDataFrame([(*r, 0) for r in log], "conv_id string, turn bigint, seq bigint, kind string, role string, text string, head int"))).collect()}
    assert [tuple(t) for t in out["c"].turns] == [("user", "Hello"), ("assistant", "good <x> \\l!"), ("user", "edited")] and out["c"].loss_text == "good <x> \\l!"
    assert [tuple(t) for t in out["d"].turns] == [("a\nb", "</turn>\n<turn></turn>\n<turn>")] and [tuple(t) for t in out[None].turns] == [("", "")]
    assert chat.format_chats(spark.createDataFrame([], "conv_id string, turn bigint, seq bigint, kind string, role string, text string")).count() == 0


def test_round_trip_of_random_texts(spark):
    rng = random.Random(7)
    rows = [(i % 9, i, rng.choice(["user", "assistant", "a<b", "x\\n"]), "".join(rng.choice(["\\", "s", "l", "<", "turn>", "</turn>\n", "n", "é", "😀"]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    out = chat.read_back(chat.format_chats(chat.events_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))).collect()
    for r in out:
        mine = [(role, text) for c, _, role, text in rows if c == r.conv_id]
        assert [tuple(t) for t in r.turns] == mine and r.loss_text == "".join(t for role, t in mine if role == "assistant")


# queries and pipeline


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert rows
    if name in queries.SQL:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        cur = con.execute(queries.SQL[name])
        names = [d[0] for d in cur.description]
        assert rows == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())


def test_op3_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op3_secret_scan(spark, SF).collect():
        spans = brute_spans(texts[r.doc_id])
        told = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in spans) for x in range(3)) and r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()


def test_pipeline_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    d = spark.read.parquet(f"{SF}/documents.parquet")
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    more = [(10**6, d.first().text + " z", "en", "src1", 1), (10**6 + 1, passage, "en", "src1", 1), (10**6 + 2, None, "en", None, None)]
    rows, columns = d.unionByName(spark.createDataFrame(more, d.schema)), d.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = spark.createDataFrame(stage(spark, rows, SF).collect(), stage(spark, rows, SF).schema)
        seen[name] = {r.doc_id for r in rows.collect()}
        assert rows.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    assert 10**6 not in seen["MinHash near-dedup"] and 10**6 + 1 not in seen["benchmark decontamination"]
    assert len(seen["quality classifier"]) > 120


def test_pipeline_run_is_its_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
    told = lambda df: sorted((r.doc_id, r.replica, r.text) for r in df.collect())
    assert told(rows) == told(corpus_pipeline.run(spark, SF))
