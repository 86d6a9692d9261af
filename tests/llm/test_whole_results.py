"""The pipeline, the secret counts and the classifiers' scores against plain Python over the same rows."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

from spanledger.llm import quality, secrets, toxicity

from test_llm import ALNUM, SF, brute_groups, brute_spans, odd, words_of

WIDE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])"


def plain_secrets(rows):
    """For each (text, source): spans (start, kind, end, owners, live) by plain dictionaries."""
    found, seen = [], {}
    for text, source in rows:
        base = [(a, k, b, re.search(r"[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)$", text[a:b])[1] if k == 0 else text[a:b]) for a, k, b in brute_spans(text or "")]
        wide = [(m.start(), 3, m.end(), m[0]) for m in re.finditer(WIDE, text or "") if re.search("[0-9]", m[0]) and m[0].lower() != m[0] != m[0].upper()]
        spans = sorted(base + [w for w in wide if not any(a < w[2] and w[0] < b for a, _, b, _ in base)])
        found.append(spans)
        for *_, value in spans:
            seen.setdefault(value, set()).add(source or "")
    out = []
    for spans in found:
        judged = [(a, k, b, len({r.split("/")[0] for r in seen[v]}), len(seen[v])) for a, k, b, v in spans]
        judged = [(a, k, b, n, n <= 2 and m <= 3) for a, k, b, n, m in judged]
        out.append([s for s in judged if s[1] < 3 or s[4]])
    return out


def test_secret_owners_are_those_of_plain_counting(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()
    more = [(10**6 + i, f"api_key = ABCDEFGH{i % 7}IJKLMNOP and Zk3Lm9Qw2Xv8Bn4Rt6Yh{i % 3}P", f"o{i % 5}/r{i}") for i in range(40)] + [(10**6 + 50, None, None), (10**6 + 51, "", "x"), (10**6 + 52, "y" * 200_000, "x")]
    rows = [tuple(r) for r in rows] + more
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: [(s.start, s.kind, s.end, s.n_owners, s.live) for s in r.spans] for r in secrets.secret_spans(d).collect()}
    want = dict(zip((r[0] for r in rows), plain_secrets([r[1:] for r in rows]), strict=True))
    assert got == want and sum(map(len, want.values())) > 40


def plain_pipeline(rows, model, items):
    """(doc_id, text, source) through all stages; the classifier's model is given."""
    rows = [r for r, s in zip(rows, model.scores([r[1].encode() if r[1] else None for r in rows]), strict=True) if s >= 0.3]
    kept, once = [], set()
    for r, (i, _, least) in zip(rows, brute_groups([(r[0], r[1]) for r in rows], 5, 80), strict=True):
        if i == least and (i, r[1]) not in once:
            kept.append(r)
            once.add((i, r[1]))
    windows = {}
    for text in items:
        w = words_of(ALNUM, text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(min(13, len(w)), set()).add(tuple(w[i : i + 13]))
    clean = []
    for r in kept:
        w, hit = words_of(ALNUM, r[1]), set()
        for n, grams in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            clean.append(r)
    masked = []
    for r, spans in zip(clean, plain_secrets([r[1:] for r in clean]), strict=True):
        out, at = "", 0
        for a, _, b, _, live in spans:
            if live and a >= at:
                out += r[1][at:a] + "<secret>"
            at = max(at, b) if live else at
        masked.append((r[0], out + r[1][at:] if r[1] is not None else None, r[2]))
    size = Counter()
    for _, text, source in masked:
        size[source] += len((text or "").encode())
    total, weight = sum(size.values()), sum(n**0.5 for n in size.values())
    drawn = []
    for i, text, source in masked:
        n = size[source]
        mean = n**0.5 * (total / weight) / n if n else 1.0
        u = int(hashlib.md5(f"7|{i}|1".encode()).hexdigest()[:13], 16) / 2**52
        p = cdf = math.exp(-mean)
        k = 0
        while cdf <= u and k < mean + 12 * mean**0.5 + 20:
            k += 1
            p *= mean / k
            cdf += p
        drawn += [(i, text, source, j) for j in range(1, k + 1)]
    return drawn


def test_pipeline_gives_what_plain_python_gives(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    first = d.orderBy("doc_id").first()
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    more = [(10**6, first.text + " z", "en", "src1", 1), (10**6 + 1, f"{first.text[:300]} {passage}", "en", "src1", 1), (10**6 + 2, None, "en", None, None), (10**6 + 3, "", None, "src2", 0), (10**6 + 4, " ".join(f"w{i % 977}" for i in range(60_000)), "en", "src2", 1), (10**6 + 5, first.text, "en", "src2", 1), (10**6 + 6, f"{first.text[:200]} password=Qr7Tz0Lm2Wx9Kp", "en", "only/r", 1)]
    spark.createDataFrame(more, d.schema).write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in d.collect()]
    model = quality.trained(d, spark.read.parquet(f"{SF}/labels.parquet"), "quality", id_col="doc_id", text_col="text")
    want = plain_pipeline(rows, model, [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    got = [(r.doc_id, r.text, r.source, r.replica) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) > 100


@pytest.mark.parametrize("texts", [[], [None, "", " ", "x" * 300_000, "plain words here", "plain words here"]])
def test_every_stage_bears_odd_rows(spark, texts):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    d = odd(spark, texts)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, SF)
        assert out.columns[: len(d.columns)] == d.columns and (name == corpus_pipeline.STAGES[-1][0] or out.columns == d.columns)
        assert out.count() <= len(texts) or name == corpus_pipeline.STAGES[-1][0]
        assert all((r.hits, r.score, r.replica) == ("b", "c", "e") for r in out.collect())


def test_quality_scores_are_those_of_plain_compression(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.trained(whole, labels, "quality", id_col="doc_id", text_col="text")
    got = {r.doc_id: r.score for r in quality.quality_scores(whole, labels).collect()}
    for r in d.collect():
        text = r.text.encode()
        sizes = []
        for content, kind in model.dictionaries or []:
            by = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind), write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(by.compress(text[i : i + 512])) for i in range(0, len(text), 512)))
        n, x = len(text), [0.0, 0.0, 0.0]
        if sizes:
            left = math.log((sizes[1] + 9) / (n + 9))
            x = [n / (n + 150) * v for v in ((sizes[0] - sizes[1]) / sum(sizes), left, left * left)]
        mean, scale, beta = model.curve
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-float(((np.array(x) - mean) / scale) @ beta[:3] + beta[3]))), abs=1e-9)


def test_toxicity_training_lowers_the_corrected_risk():
    rng = np.random.default_rng(4)
    toxic = [sorted(set(rng.choice(20, 5))) for _ in range(80)]
    mixed = [sorted(set(rng.choice(20, 5))) for _ in range(20)] + [sorted(set(20 + rng.choice(20, 5))) for _ in range(180)]
    chosen = [f"w{i:02}".encode() for i in range(40)]

    def risk(model):
        z = lambda rows: np.array([model.offset + sum(model.weights.get(chosen[i], 0.0) for i in r) for r in rows])
        up, down_p, down_u = (np.log1p(np.exp(s * z(r))).mean() for s, r in ((-1, toxic), (1, toxic), (1, mixed)))
        return 0.1 * up + max(0.0, down_u - 0.1 * down_p)

    model = toxicity.NonNegative(0.1)
    before = risk(model)
    model.fit(chosen, toxic, mixed)
    assert risk(model) < 0.3 * before
    text = b" ".join(chosen[i] for i in toxic[0])
    assert model.score(text) == pytest.approx(1 / (1 + math.exp(-(model.offset + sum(model.weights[chosen[i]] for i in toxic[0])))))
    assert model.score(text) > 0.5 > model.score(b"w25 w31")
