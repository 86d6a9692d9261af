"""Adjudication of a catalog: decisions on its dependent tables in a fixed order, published as one version.

Labels come first, then the spans that wait for a downgrade, then spans that bear and have no statement, then statements,
whose drops make further spans wait and edges dangle, and edges last, since their numbers depend on all before. Nothing
is visible before the last step is done; a fault in any step, or a version that somebody published meanwhile, leaves the
old one in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanledger.operators import annotate, decide, rulings
from spanledger.operators.graph import cut
from spanledger.sources import sinks

Tables = dict[str, DataFrame]


def rule_labels(t: Tables, d: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    classes, log = rulings.rule_classes(t["classes"], d["classes"])
    return {"classes": classes}, {"class": log}


def rule_downgrades(t: Tables, d: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    classes, statements, log = rulings.rule_downgrades(t["classes"], t["spans"], t["statements"], d["downgrades"])
    return {"classes": classes.drop("resolution"), "statements": statements}, {"downgrade": log}


def mark_unstated(t: Tables, d: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    return {"classes": annotate.mark_pending(t["classes"], t["statements"])}, {}


def rule_statements(t: Tables, d: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    after, log = rulings.rule_statements(t["statements"], t["spans"], d["statements"])
    classes, edges = rulings.after_drops(t["classes"], t["statements"], after, t["edges"], d["statements"])
    return {"classes": classes.drop("downgrade_reason"), "statements": after, "edges": edges}, {"statement": log}


def rule_edges(t: Tables, d: Tables) -> tuple[Tables, dict[str, DataFrame]]:
    edges, log = rulings.rule_edges(t["edges"], d["edges"])
    return {"edges": edges}, {"edge": log}


STEPS = (("labels", rule_labels), ("downgrades", rule_downgrades), ("unstated", mark_unstated), ("statements", rule_statements), ("edges", rule_edges))
NAMES = ("spans", "classes", "statements", "edges")


def adjudicate(tables: Tables, decisions: Tables) -> tuple[Tables, DataFrame]:
    """The tables (spans, classes, statements, edges) after all decisions (classes, downgrades, statements, edges), and how many of each kind led to what."""
    t, logs = dict(tables), {}
    for _, step in STEPS:
        changed, log = step(t, decisions)
        t |= {name: cut(df) for name, df in changed.items()}
        logs |= log
    return t, rulings.tally(logs)


def adjudicate_published(spark: SparkSession, root: str, decisions: Tables, version: str, finalize: bool = False) -> DataFrame:
    """Reads the last commit, adjudicates it and commits the outcome with its tally; with finalize, only if nothing is left open."""
    at, tables = sinks.read_commit(spark, root, *NAMES)
    after, tally = adjudicate(tables, decisions)
    if finalize:
        decide.require_resolved(annotate.unresolved(after["classes"], after["statements"], after["edges"]))
    sinks.commit(after | {"tally": tally}, root, version, at)
    return tally
