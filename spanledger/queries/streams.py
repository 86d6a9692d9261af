"""Claims as events, and windows over the event table (an extension); the same operators run on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.plans.regtext import table
from spanledger.streaming import claims, resume


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resume.sessions(table(spark, sf_dir, "events"))
    return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.max("n_events").alias("most_events"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resume.tumbling(table(spark, sf_dir, "events"))
    return out.select("event_type", F.date_format("started", "yyyy-MM-dd HH").alias("hour"), "n_events")


def claim_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as claims of orders on 40 items of a supplier, a hold lasting 60 days: ruled on up to a date, then from it."""
    events = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS doc_id", "'decompose' AS stage", "concat('S', l_partkey % 40) AS item_id", "concat('b', l_orderkey % 3) AS batch_id", "CAST(date_diff(CAST(l_shipdate AS DATE), DATE'1990-01-01') AS BIGINT) AS at",
        "l_orderkey * 1000 + l_partkey AS seq", "element_at(array('claim', 'claim', 'validate', 'release', 'claim', 'merge', 'other'), CAST((l_orderkey + l_linenumber + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) % 7 AS INT) + 1) AS kind",
    ).distinct()
    first = claims.ruled(events.filter("at < 1800"), None, 60)
    then = claims.ruled(events.filter("at >= 1800"), first, 60)
    return claims.rulings(first).unionByName(claims.rulings(then)).drop("stage")


QUERIES = {f.__name__: f for f in (event_sessions, event_windows, claim_rulings)}
SQL = {
    "event_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first FROM events),
      s AS (SELECT user_id, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g), c AS (SELECT user_id, s, count(*) AS n FROM s GROUP BY 1, 2)
      SELECT user_id, count(*) AS n_sessions, max(n) AS most_events FROM c GROUP BY 1""",
    "event_windows": "SELECT event_type, strftime(ts, '%Y-%m-%d %H') AS hour, count(*) AS n_events FROM events GROUP BY 1, 2",
    "claim_rulings": """WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS doc_id, 'S' || (l_partkey % 40) AS item_id, 'b' || (l_orderkey % 3) AS batch_id, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS pos, l_orderkey * 1000 + l_partkey AS seq,
        ['claim', 'claim', 'validate', 'release', 'claim', 'merge', 'other'][(l_orderkey + l_linenumber + CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END) % 7 + 1] AS kind FROM lineitem),
      n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY pos, seq, kind, batch_id) AS i FROM e),
      w AS (SELECT doc_id, item_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS holder, CAST(NULL AS BIGINT) AS till, false AS done, CAST(NULL AS VARCHAR) AS batch_id, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS outcome FROM (SELECT DISTINCT doc_id, item_id FROM n)
        UNION ALL SELECT doc_id, item_id, i, CASE WHEN got = 'granted' THEN batch_id WHEN got NOT IN ('released', 'merged') THEN holder END, CASE WHEN got IN ('granted', 'renewed') THEN pos + 60 WHEN got NOT IN ('released', 'merged') THEN till END, done OR got = 'merged', batch_id, pos, seq, kind, got
        FROM (SELECT n.*, w.holder, w.till, w.done, CASE WHEN w.done THEN 'done' WHEN n.kind = 'claim' THEN CASE WHEN w.holder = n.batch_id AND n.pos < w.till THEN 'renewed' WHEN w.holder IS NULL OR w.till <= n.pos THEN 'granted' ELSE 'refused' END
          WHEN NOT coalesce(w.holder = n.batch_id AND n.pos < w.till, false) THEN 'ignored' WHEN n.kind = 'validate' THEN 'renewed' WHEN n.kind = 'release' THEN 'released' WHEN n.kind = 'merge' THEN 'merged' ELSE 'ignored' END AS got
          FROM w JOIN n ON n.doc_id = w.doc_id AND n.item_id = w.item_id AND n.i = w.i + 1))
      SELECT doc_id, item_id, pos AS "at", seq, kind, batch_id, outcome FROM w WHERE i > 0""",
}
