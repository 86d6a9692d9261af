"""Answers of each stage with faults of every kind, beside SQL that names the faults by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators import answers
from spanledger.plans.regtext import table

# Each stage: texts of answers ({0} is the order's key) and their faults as (path, fault, got).
CASES = {
    "classify": (
        ('{{"span_id": "S{0}", "label_a": "definition", "label_b": "definition", "final_label": "definition", "reason_a": "", "reason_b": "r", "ambiguous": false, "more": 1}}', ()),
        ('{{"span_id": {0}, "label_a": "bogus", "label_b": null, "final_label": ["definition"], "reason_a": "r", "reason_b": "r", "ambiguous": "yes"}}', (("span_id", "no text", "number"), ("label_a", "not allowed", "bogus"), ("label_b", "missing", None), ("final_label", "no text", "list"), ("ambiguous", "no boolean", "text"))),
        ('{{"span_id": "S{0}", "label_a": "definition", "label_b": "structural", "final_label": "structural", "final_embedded": ["definition", "bogus", 7, null], "embedded_a": "definition", "reason_a": "r"}}', (("final_embedded[1]", "not allowed", "bogus"), ("final_embedded[2]", "no text", "number"), ("final_embedded[3]", "no text", "null"), ("embedded_a", "no list", "text"), ("reason_b", "missing", None), ("ambiguous", "missing", None))),
        ("S{0}: definition", (("$", "no json", None),)),
    ),
    "decompose": (
        ('{{"span_id": "S{0}", "requirements": [{{"verbatim_quote": "q"}}, "none", []]}}', (("requirements[1]", "no object", "text"), ("requirements[2]", "no object", "list"))),
        ('{{"span_id": "S{0}", "requirements": null}}', (("requirements", "missing", None),)),
        ('["S{0}"]', (("$", "no object", "list"),)),
    ),
    "embedded_audit": (
        ('{{"span_id": "S{0}", "requirements": []}}', (("has_embedded_obligation", "missing", None),)),
        ('{{"span_id": "S{0}", "has_embedded_obligation": 1, "requirements": {{}}}}', (("has_embedded_obligation", "no boolean", "number"), ("requirements", "no list", "object"))),
        (" ", (("$", "no json", None),)),
    ),
    "relate": (
        ('{{"source_req_id": "R{0}", "target_req_id": "R1", "type": "refines", "evidence": null}}', ()),
        ('{{"source_req_id": true, "type": "leads_to", "evidence": 1.5}}', (("source_req_id", "no text", "boolean"), ("target_req_id", "missing", None), ("type", "not allowed", "leads_to"), ("evidence", "no text", "number"))),
    ),
}


def answer_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with an answer of every stage to each order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    out = None
    for stage, cases in CASES.items():
        raw = F.element_at(F.array(*(F.lit(text.replace("{{", "{").replace("}}", "}")) for text, _ in cases)), (F.col("k") % len(cases) + 1).cast("int"))
        own = answers.shape_faults(orders.withColumn("raw", F.replace(raw, F.lit("{0}"), F.col("k").cast("string"))), stage).withColumn("stage", F.lit(stage))
        out = own if out is None else out.unionByName(own)
    return out.select("k", "stage", "path", "fault", "got")


QUERIES = {"answer_shapes": answer_shapes}


def told(x: str | None) -> str:
    return "NULL" if x is None else f"'{x}'"


ROWS = ", ".join(f"('{stage}', {len(cases)}, {i}, {told(path)}, {told(fault)}, {told(got)})" for stage, cases in CASES.items() for i, (_, found) in enumerate(cases) for path, fault, got in found)
SQL = {"answer_shapes": f"SELECT o_orderkey AS k, stage, path, fault, got FROM orders JOIN (VALUES {ROWS}) v(stage, many, i, path, fault, got) ON o_orderkey % many = i"}
