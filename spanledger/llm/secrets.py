"""Secret scan with corpus-wide ownership frequency.

Base patterns find assignments, access keys and hex runs; wider candidates (long mixed tokens) are found beside them.
Each candidate's hash is counted over distinct repositories and owners of the whole corpus. A value of few owners looks
live; one that many share is a copied example. A wide candidate becomes a span only if it looks live; base spans stay.

Defined cases: null or empty text has no spans; very long texts are scanned whole, each once; a null repository is one
repository without owner; repeated documents are scanned row by row and count once per repository and owner; ties of
start are ordered by kind, and equal spans of one kind cannot arise; an empty table gives no rows; columns of clashing
names stay as they are in redact, and secret_spans returns none but its own. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow, checkpoint, fresh, hot_join, slices, table_bound

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Wide candidates: long tokens with lower and upper case letters and digits.
WIDE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
KINDS = ("assign", "access", "hex", "token")
SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int8()), ("end", pa.int64()), ("hash", pa.int64())])


def candidates(text: str) -> list[dict]:
    """Base spans and wide candidates of a text, by start and then kind."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = [(a, b) for a, _, b, _ in found]
    for m in WIDE.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and v.upper() != v and v.lower() != v and not any(a < m.end() and m.start() < b for a, b in base):
            found.append((m.start(), 3, m.end(), v))
    return [{"start": a, "kind": k, "end": b, "hash": xxhash.xxh64_intdigest(v) - 2**63} for a, k, b, v in sorted(found)]


def scan(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in parts:
        yield pa.array([candidates(t) if t else [] for held in slices(texts) for t in held], pa.list_(SPAN))


FOUND = "array<struct<start:bigint,kind:tinyint,end:bigint,hash:bigint>>"
JUDGED = "array<struct<start:bigint,kind:tinyint,end:bigint,n_repos:bigint,n_owners:bigint,live:boolean>>"


def joined(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"].cast("int") + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_repos, n_owners of rows (hash, repo, owner). Distinct pairs first, so that a value in a third of all rows is summed up before it is dealt out."""
    pairs = found.groupBy("hash", "repo", "owner").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("hash").agg(F.countDistinct("repo").alias("n_repos"), F.countDistinct("owner").alias("n_owners"), F.sum("n").alias("n_found"))


def judged_spans(found: DataFrame, *, max_owners: int, max_repos: int) -> DataFrame:
    """text_key, spans from rows (text_key, repo, found). Spans depend on the text and the corpus alone, so copies share a row here."""
    each = found.filter(F.size("found") > 0).select("text_key", "repo", F.substring_index("repo", "/", 1).alias("owner"), F.explode("found").alias("s"))
    owned = checkpoint(ownership(each.select(F.col("s.hash").alias("hash"), "repo", "owner")))
    judged = hot_join(checkpoint(each.select("text_key", "s.*").distinct()), owned, "hash").withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    judged = judged.filter((F.col("kind") < 3) | F.col("live"))
    return judged.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "n_repos", "n_owners", "live"))).alias("spans"))


def found_in(docs: DataFrame, text_col: str, repo_col: str, *keep: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(*keep, F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("text_key"), F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"), arrow(scan, FOUND)(text).alias("found"))


def secret_spans(docs: DataFrame, *, text_col: str = "text", repo_col: str = "source", id_col: str = "doc_id", max_owners: int = 2, max_repos: int = 3) -> DataFrame:
    """id_col, spans (start, kind, end, n_repos, n_owners, live), one row per document.

    The owner is what stands before the first slash of the repository's name. Texts are read once; what follows works
    on the few rows with candidates.
    """
    found = checkpoint(found_in(docs, text_col, repo_col, F.col(id_col).alias("id")))
    spans = checkpoint(judged_spans(found, max_owners=max_owners, max_repos=max_repos))
    none = found.filter(F.size("found") == 0).select("id", F.array().cast(JUDGED).alias("spans"))
    some = hot_join(found.filter(F.size("found") > 0).select("id", "text_key"), spans, "text_key", "left").select("id", F.coalesce("spans", F.array().cast(JUDGED)).alias("spans"))
    return none.unionByName(some).withColumnRenamed("id", id_col)


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with each live span, or run of overlapping ones, replaced by mark."""
    live = F.filter(spans, lambda s: s["live"])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(live, start, step)
    return F.when(F.size(live) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["at"].cast("int") + 1, 2**31 - 1)))


def redact(docs: DataFrame, *, text_col: str = "text", repo_col: str = "source", mark: str = "<secret>", max_owners: int = 2, max_repos: int = 3) -> DataFrame:
    """docs with the live secrets of each text replaced; widely copied examples stay. Texts with one are joined by their digest, which moves no text while those are few."""
    key, spans = fresh(docs, "secret_key"), fresh(docs, "secret_spans")
    found = checkpoint(found_in(docs, text_col, repo_col).filter(F.size("found") > 0))
    judged = judged_spans(found, max_owners=max_owners, max_repos=max_repos).filter(F.exists("spans", lambda s: s["live"]))
    judged = table_bound(checkpoint(judged.select(F.col("text_key").alias(key), F.col("spans").alias(spans))))
    keyed = docs.withColumn(key, F.md5(F.col(text_col).cast("binary"))).join(judged, key, "left")
    return keyed.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(masked(F.col(text_col), F.col(spans), mark))).select(*docs.columns)
