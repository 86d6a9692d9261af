"""Rules on untyped answers: every wrong shape of a packet's answer is a row, not a null.

An answer comes as the text of one JSON object. It is parsed to a variant, so that a list where a text should stand, a
number, a missing field and a text that is no JSON are told apart. A rule names a path, the kinds that may stand there,
whether it must be there, and the texts that are allowed; the rules of a stage are a table, and an answer is held against
all of them in one pass, without a shuffle. What depends on other rows (asked for, answered twice, quotes) is in packets.

Defined cases: null and blank texts and texts that are no JSON have the fault "no json" alone, other values than objects
"no object"; a null in an optional field is as good as none; unknown fields are no fault; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.functions.text import LABELS

from .statements import EDGE_TYPES


@dataclass(frozen=True)
class Rule:
    """kinds: of text, list, object, boolean, number. items: kinds of a list's entries; allowed: texts there or in its entries."""

    path: str
    kinds: tuple[str, ...]
    required: bool = False
    allowed: tuple[str, ...] = ()
    items: tuple[str, ...] = ()


# The fields of the answers of each stage.
RULES = {
    "classify": (
        Rule("span_id", ("text",), True), Rule("label_a", ("text",), True, LABELS), Rule("label_b", ("text",), True, LABELS),
        Rule("final_label", ("text",), True, LABELS), Rule("final_embedded", ("list",), allowed=LABELS, items=("text",)),
        Rule("embedded_a", ("list",), allowed=LABELS, items=("text",)), Rule("embedded_b", ("list",), allowed=LABELS, items=("text",)),
        Rule("reason_a", ("text",), True), Rule("reason_b", ("text",), True), Rule("ambiguous", ("boolean",), True),
    ),
    "decompose": (Rule("span_id", ("text",), True), Rule("requirements", ("list",), True, items=("object",))),
    "embedded_audit": (Rule("span_id", ("text",), True), Rule("has_embedded_obligation", ("boolean",), True), Rule("requirements", ("list",), True, items=("object",))),
    "relate": (
        Rule("source_req_id", ("text",), True), Rule("target_req_id", ("text",), True), Rule("type", ("text",), True, EDGE_TYPES),
        Rule("evidence", ("text",)), Rule("ambiguous", ("boolean",)),
    ),
}
KINDS = (("STRING", "text"), ("ARRAY", "list"), ("OBJECT", "object"), ("BOOLEAN", "boolean"), ("VOID", "null"))


def kind_of(value: Column) -> Column:
    """text, list, object, boolean, null or number; null if there is no value."""
    named = F.schema_of_variant(value)
    out = F.when(named.isNull(), None)
    for start, kind in KINDS:
        out = out.when(F.startswith(named, F.lit(start)), kind)
    return out.otherwise("number")


def faults_of(answer: Column, rule: Rule) -> Column:
    """Faults of one answer under one rule: an array of structs of path, fault and what was there."""
    value = F.try_variant_get(answer, f"$.{rule.path}", "variant")
    kind = kind_of(value)
    absent = kind.isNull() | (kind == "null")
    fault = lambda path, what, got: F.struct(path.alias("path"), F.lit(what).alias("fault"), got.cast("string").alias("got"))
    path = F.lit(rule.path)
    told = [F.when(absent, fault(path, "missing", F.lit(None))) if rule.required else F.lit(None)]
    told.append(F.when(~absent & ~kind.isin(*rule.kinds), fault(path, f"no {' or '.join(rule.kinds)}", kind)))
    text = F.try_variant_get(answer, f"$.{rule.path}", "string")
    if rule.allowed and not rule.items:
        told.append(F.when((kind == "text") & ~text.isin(*rule.allowed), fault(path, "not allowed", text)))
    own = F.array_compact(F.array(*told))
    if not rule.items:
        return own
    entries = F.coalesce(F.try_variant_get(answer, f"$.{rule.path}", "array<variant>"), F.array().cast("array<variant>"))

    def of(entry: Column, i: Column) -> Column:
        at, what = F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), kind_of(entry)
        word = F.try_variant_get(entry, "$", "string")
        wrong = F.when(F.coalesce(~what.isin(*rule.items), F.lit(True)), fault(at, f"no {' or '.join(rule.items)}", what))
        return wrong.when((what == "text") & ~word.isin(*rule.allowed), fault(at, "not allowed", word)) if rule.allowed else wrong

    return F.concat(own, F.array_compact(F.transform(F.when(kind == "list", entries).otherwise(F.array().cast("array<variant>")), of)))


def shape_faults(answers: DataFrame, stage: str) -> DataFrame:
    """path, fault, got beside the columns of answers (..., raw): one row for each thing that is wrong."""
    t = answers.withColumn("answer", F.try_parse_json(F.nullif(F.trim("raw"), F.lit(""))))
    kind = kind_of(F.col("answer"))
    alone = lambda what: F.array(F.struct(F.lit("$").alias("path"), F.lit(what).alias("fault"), kind.alias("got")))
    every = F.concat(*(faults_of(F.col("answer"), rule) for rule in RULES[stage]))
    told = F.when(F.col("answer").isNull(), alone("no json")).when(kind != "object", alone("no object")).otherwise(every)
    return t.select(*(c for c in answers.columns if c != "raw"), F.explode(told).alias("f")).select(*(c for c in answers.columns if c != "raw"), "f.*")
