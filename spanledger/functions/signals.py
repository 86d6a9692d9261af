"""Signal hits of texts, from the pattern table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules

HIT = "struct<sig_class:string,pattern_id:string,pattern_seq:int,matched_text:string,start:int,end:int>"


def needle(rx: str) -> str:
    """The longest word that every match of a pattern holds, in lower case; empty if none is known."""
    bare = re.sub(r"\[[^\]]*\]", " ", re.sub(r"\(\?[^)]*\)", " ", re.sub(r"\\.", " ", re.sub(r"[A-Za-z][?*]|[A-Za-z]\{\d*,?\d*\}", " ", rx))))
    return "" if "|" in bare else max(re.findall("[A-Za-z]{3,}", bare), key=len, default="").lower()


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """A list made of a value that is worked out once. Flattened: taking the only element would ask for its type, that of all patterns' lists, row by row."""
    return F.flatten(F.transform(F.array(value), body))


def candidates(text: Column, table: tuple = rules.SIGNALS) -> Column:
    """The numbers of the patterns whose longest word stands in a text; the others have no match there."""
    low = F.lower(text)
    return F.array_remove(F.array(*(F.when(F.contains(low, F.lit(needle(rx))), F.lit(seq)).otherwise(F.lit(-1)) for seq, (_, _, rx) in enumerate(table))), F.lit(-1))


def of_each(which: Column, table: tuple, body: Callable[..., Column]) -> Column:
    """body(seq, name, class, pattern) of each candidate; no other pattern costs anything."""

    def chosen(i: Column) -> Column:
        out = F
        for seq, row in enumerate(table):
            out = out.when(i == seq, body(seq, *row))
        return out

    return F.transform(which, chosen)


def blank_dates(text: Column) -> Column:
    """Date phrases replaced by as many # signs, so that offsets stay and no modal stands there."""
    parts = F.regexp_extract_all(text, F.lit(rules.DATE), F.lit(0))
    return F.when(text.rlike(rules.DATE), F.aggregate(F.array_distinct(parts), text, lambda t, d: F.replace(t, d, F.repeat(F.lit("#"), F.length(d))))).otherwise(text)


def positions(text: Column, pattern: str) -> Column:
    """Matches of a pattern as (matched_text, start, end) in characters: the pieces between give the offsets."""
    # each match goes on where the last one ended; split would compile the pattern anew for every row
    onward = F.lit(rf"\G((?s:.*?))({pattern})")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<matched_text:string,start:int,end:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        a = s["at"] + x["b"]
        hit = F.struct(x["m"].alias("matched_text"), a.alias("start"), (a + F.length(x["m"])).alias("end"))
        return F.struct((a + F.length(x["m"])).alias("at"), F.array_append(s["out"], hit).alias("out"))

    pieces = F.zip_with(F.regexp_extract_all(text, onward, F.lit(2)), F.regexp_extract_all(text, onward, F.lit(1)), lambda m, b: F.struct(m.alias("m"), F.length(b).alias("b")))
    return F.aggregate(pieces, start, step, lambda s: s["out"])


def named(name: str, kind: str, seq: int):
    return lambda m: F.struct(F.lit(kind).alias("sig_class"), F.lit(name).alias("pattern_id"), F.lit(seq).alias("pattern_seq"), m["matched_text"].alias("matched_text"), m["start"].alias("start"), m["end"].alias("end"))


def found(text: Column, which: Column, table: tuple = rules.SIGNALS, drop_dates: bool = True) -> Column:
    """All hits of the candidates, by start and then in table order; overlapping ones stay."""
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["pattern_seq"] - b["pattern_seq"])

    def hits(seq: int, name: str, kind: str, rx: str) -> Column:
        each = lambda at: F.transform(positions(at, rx), named(name, kind, seq))
        return bound(blank_dates(text), each) if drop_dates and kind == "modal_permissive" else each(text)

    return F.array_sort(F.flatten(of_each(which, table, hits)), order)


def signals(text: Column, table: tuple = rules.SIGNALS, drop_dates: bool = True) -> Column:
    """All hits of all patterns, by start and then in table order; overlapping ones stay."""
    return bound(F.struct(text.alias("text"), candidates(text, table).alias("which")), lambda t: found(t["text"], t["which"], table, drop_dates))


def obliging(hits: Column) -> Column:
    """The hits of a text with an obligation, none of others."""
    return bound(hits, lambda h: F.when(F.exists(h, lambda x: x["sig_class"].isin(*rules.OBLIGATION_CLASSES)), h))


def hit_rows(rows: DataFrame, key: str, text_col: str, of: Callable[[Column], Column] = lambda hits: hits) -> DataFrame:
    """key, h: a row per signal of each text, or per signal that of keeps."""
    # candidates are a column of their own, so that Spark compiles them; outer, so that no filter for lists that are not empty can be inferred, which would work them out again
    at = rows.select(key, F.col(text_col).alias("text"), candidates(F.col(text_col)).alias("which"))
    return at.select(key, F.explode_outer(of(found(F.col("text"), F.col("which")))).alias("h")).filter("h IS NOT NULL")


def counts(rows: DataFrame, key: str, text_col: str, table: tuple = rules.SIGNALS) -> DataFrame:
    """key, sig_class, pattern_id, n: hits per key. Counting needs no offsets; a pattern is only run where its longest word stands."""

    def count(seq: int, name: str, kind: str, rx: str) -> Column:
        n = F.regexp_count(blank_dates(F.col("text")) if kind == "modal_permissive" else F.col("text"), F.lit(rx))
        return F.struct(F.lit(kind).alias("sig_class"), F.lit(name).alias("pattern_id"), n.alias("n"))

    at = rows.select(key, F.col(text_col).alias("text"), candidates(F.col(text_col), table).alias("which"))
    hits = at.select(key, F.explode_outer(of_each(F.col("which"), table, count)).alias("h")).filter("h.n > 0")
    return hits.groupBy(key, "h.sig_class", "h.pattern_id").agg(F.sum("h.n").cast("bigint").alias("n"))


def has_obligation(text: Column) -> Column:
    """Whether any signal of an obligation class is there; exclusions and re-inclusions do not count."""

    def some(t: Column) -> Column:
        out = F.lit(False)
        for _, kind, rx in rules.SIGNALS:
            if kind in rules.OBLIGATION_CLASSES:
                out = out | F.contains(t["low"], F.lit(needle(rx))) & (blank_dates(t["text"]) if kind == "modal_permissive" else t["text"]).rlike(rx)
        return out

    return F.exists(F.array(F.struct(text.alias("text"), F.lower(text).alias("low"))), some)
