"""Keyed folds over streams in the order of time, with timers; the rate limit and the retry states of the batch operators.

Rows wait in a key's state until the watermark has passed them, then they are folded in the order of time, so a
stream gives what the batch operators give for all rows that are no later than the delay; later ones are left out.
States, rows that wait and timers are in the query's checkpoint and survive a restart.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from palimpsest.operators.attempts import RetryRules

#: own state, time (microseconds), row -> output rows; the own state is changed in place
Step = Callable[[dict, int, list], list[tuple]]


def ordered_fold(rows: DataFrame, key: str, time: str, delay: str, columns: list[str], output: str, step: Step, timer: Callable[[dict], int | None], ring: Step) -> DataFrame:
    """(k, *output) of a fold over the rows of each key in the order of time and ``columns``.

    ``timer`` tells from the own state when something happens without a row, ``ring`` is called then, before rows
    of that time or later.  A key whose own state is empty, without rows that wait, is forgotten.  Columns must be
    numbers, strings or booleans.
    """
    timed = rows.withWatermark(time, delay)
    plain = timed.select(F.col(key).cast("string").alias("k"), F.col(time), F.unix_micros(F.col(time)).alias("t"), F.to_json(F.array(*(F.to_json(F.struct(F.col(c).alias("v"))) for c in columns))).alias("row")).where("t IS NOT NULL")

    def fold(key_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept: dict[str, Any] = json.loads(state.get[0]) if state.exists else {"own": {}, "rows": []}
        own, waiting = kept["own"], kept["rows"]
        for frame in frames:
            for t, row in zip(frame["t"], frame["row"]):
                waiting.append([int(t), [json.loads(v).get("v") for v in json.loads(row)]])
        waiting.sort(key=lambda r: (r[0], [(v is not None, v) for v in r[1]]))
        now, out, at = state.getCurrentWatermarkMs() * 1000, [], 0
        while True:
            rung = timer(own)
            if rung is not None and rung <= now and (at == len(waiting) or rung <= waiting[at][0]):
                out += ring(own, rung, [])
            elif at < len(waiting) and waiting[at][0] <= now:
                out += step(own, *waiting[at])
                at += 1
            else:
                break
        waiting = waiting[at:]
        ahead = [x for x in (timer(own), waiting[0][0] if waiting else None) if x is not None]
        if own or waiting:
            state.update((json.dumps({"own": own, "rows": waiting}),))
            if ahead:
                state.setTimeoutTimestamp(max(-(-min(ahead) // 1000) - 1, state.getCurrentWatermarkMs()))  # fires once the watermark is beyond
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame([(key_[0], *o) for o in out], columns=names)

    schema = f"k string, {output}"
    names = [x.split()[0] for x in schema.split(", ")]
    return plain.groupBy("k").applyInPandasWithState(fold, schema, "kept string", "append", GroupStateTimeout.EventTimeTimeout)


def limit_stream(rows: DataFrame, key: str, time: str, limit: int, *, tie: str, delay: str, width_seconds: int = 60) -> DataFrame:
    """(k, t, tie, window_start, request_number, allowed) of requests, as ``limits.limited_requests``; times are microseconds, keys and ties strings."""
    width = width_seconds * 1_000_000

    def step(own: dict, t: int, row: list) -> list[tuple]:
        if not own or t >= own["start"] + width:
            own.update(start=t, n=0)
        own["n"] += 1
        return [(t, str(row[0]), own["start"], own["n"], own["n"] <= limit)]

    def ring(own: dict, t: int, _: list) -> list[tuple]:  # the window is over: nothing to remember
        own.clear()
        return []

    timer = lambda own: own["start"] + width if own else None
    return ordered_fold(rows, key, time, delay, [tie], "t long, tie string, window_start long, request_number long, allowed boolean", step, timer, ring)


def retry_stream(log: DataFrame, *, delay: str, rules: RetryRules = RetryRules(), time: str = "time") -> DataFrame:
    """(k, at, state, attempts, timeouts, due): every change of a document's state, as ``attempts.retry_states`` has them at its time.

    ``log`` has document_id, attempt, kind, ok and a timestamp column ``time``.  Attempts that don't end and waiting
    documents have timers.  Documents that are done or quarantined stay known, so what comes later is left out.
    """
    limit = rules.timeout * 1_000_000

    def told(own: dict, t: int) -> tuple:
        return (t, own["state"], own["attempts"], own["timeouts"], own.get("due"))

    def ended(own: dict, t: int, ok: bool) -> list[tuple]:
        own["attempts"] += 1
        own["due"] = None
        if ok:
            own.update(state="DONE", open={})
        elif own["attempts"] >= rules.most:
            own.update(state="QUARANTINED", open={})
        elif own["open"]:
            own["last"] = t
            own["state"] = "RUNNING"
        else:
            own.update(state="WAITING", due=t + rules.delay(own["attempts"]) * 1_000_000)
        return [told(own, t)]

    def step(own: dict, t: int, row: list) -> list[tuple]:
        _, attempt, kind, ok = row
        attempt, ok = str(attempt), bool(ok)
        if not own:
            if kind != "started":
                return []
            own.update(state="NEW", attempts=0, timeouts=0, open={}, ended=[], due=None)
        if own["state"] in ("DONE", "QUARANTINED"):
            return []
        if kind == "started":
            if attempt in own["open"] or attempt in own["ended"]:
                return []
            own["open"][attempt] = t
            own.update(state="RUNNING", due=None)
            return [told(own, t)]
        if attempt not in own["open"]:
            return []
        del own["open"][attempt]
        own["ended"].append(attempt)
        return ended(own, t, ok)

    def timer(own: dict) -> int | None:
        if not own:
            return None
        times = [t + limit + 1 for t in own["open"].values()]
        if own["state"] == "WAITING":
            times.append(own["due"])
        return min(times, default=None)

    def ring(own: dict, t: int, _: list) -> list[tuple]:
        over = sorted(a for a, at in own["open"].items() if at + limit + 1 == t)
        if not over:
            own["state"] = "DUE"
            return [told(own, t)]
        own["open"].pop(over[0])
        own["ended"].append(over[0])
        own["timeouts"] += 1
        return ended(own, t, False)

    log = log.withColumn("_end", F.col("kind") != "started")  # an attempt may end at the moment it starts
    return ordered_fold(log, "document_id", time, delay, ["_end", "attempt", "kind", "ok"], "at long, state string, attempts long, timeouts long, due long", step, timer, ring)
