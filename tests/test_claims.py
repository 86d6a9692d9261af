"""Claims in a stream: nothing is held twice, and what runs again changes nothing."""

import random

from spanledger.sources import sinks
from spanledger.streaming import claims

EVENTS = "doc_id bigint, stage string, item_id string, batch_id string, at bigint, seq bigint, kind string"


def walk(events, ttl):
    """The same rules, one event after the other."""
    held, out = {}, {}
    for d, s, i, b, at, seq, kind in sorted((e for e in events if None not in e[2:5]), key=lambda e: (e[4], e[5], e[6], e[3])):
        holder, until, done = held.get((d, s, i), (None, 0, False))
        own = holder == b and at < until
        if done:
            got = "done"
        elif kind == "claim":
            got = "renewed" if own else "granted" if holder is None or until <= at else "refused"
        else:
            got = {"validate": "renewed", "fail": "renewed", "release": "released", "merge": "merged"}.get(kind, "ignored") if own else "ignored"
        if got in ("granted", "renewed"):
            held[d, s, i] = (b, at + ttl, False)
        elif got in ("released", "merged"):
            held[d, s, i] = (None, None, got == "merged")
        out[seq] = got
    return out, held


def drawn(n):
    rng = random.Random(4)
    kinds = ["claim", "claim", "claim", "validate", "fail", "release", "merge", "other"]
    rows = [(rng.randrange(2), "decompose", f"S{rng.randrange(6)}", f"b{rng.randrange(4)}", at // 2, at, rng.choice(kinds)) for at in range(n)]
    return [*rows, (1, "decompose", None, "b1", 3, n, "claim"), (1, "decompose", "S1", None, 3, n + 1, "claim"), (None, "decompose", "S1", "b1", 3, n + 2, "claim"), (None, "decompose", "S1", "b2", 4, n + 3, "claim")]


def test_stream_of_epochs_is_one_walk(spark, tmp_path):
    rows = drawn(400)
    rows.sort(key=lambda e: (e[4], e[5]))
    source, root = tmp_path / "in", str(tmp_path / "out")
    for k in range(3):
        spark.createDataFrame(rows[k * 150 : (k + 1) * 150], EVENTS).coalesce(1).write.mode("append").json(str(source))
        claims.work_off(spark.readStream.schema(EVENTS).json(str(source)), root, str(tmp_path / "state"), 20)
    want, held = walk(rows, 20)
    got = claims.all_rulings(spark, root).collect()
    assert len(got) == len(want) and {r.seq: r.outcome for r in got} == want
    assert {(r.doc_id, r.stage, r.item_id): (r.held.holder, r.held.until, r.held.done) for r in claims.holdings(spark, root).collect()} == {k: held.get(k, (None, None, False)) for k in {e[:3] for e in rows if None not in e[2:5]}}
    # a lost checkpoint brings all events again as epoch 0, which is there already
    at = sinks.current(spark, root)
    claims.work_off(spark.readStream.schema(EVENTS).json(str(source)), root, str(tmp_path / "again"), 20)
    assert sinks.current(spark, root) == at and claims.all_rulings(spark, root).count() == len(want)


def test_no_two_hold_an_item_at_once(spark):
    rows, ttl = drawn(300), 15
    got = claims.rulings(claims.ruled(spark.createDataFrame(rows, EVENTS), None, ttl)).orderBy("at", "seq").collect()
    holds: dict = {}
    for r in got:
        key = (r.doc_id, r.item_id)
        if r.outcome == "granted":
            assert holds.get(key, (None, r.at))[1] <= r.at
        if r.outcome in ("granted", "renewed"):
            holds[key] = (r.batch_id, r.at + ttl)
        elif r.outcome in ("released", "merged"):
            holds.pop(key)
    assert claims.ruled(spark.createDataFrame([], EVENTS), None, ttl).count() == 0
