"""Windows that a first request opens, retry states: batch against plain folds, streams against the batch."""

import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import attempts, limits
from palimpsest.streaming import folds


def plain_limits(rows, width, limit):
    """{id: (window start, number, allowed)} of (id, key, seconds)."""
    open_, out = {}, {}
    for i, k, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if k not in open_ or t >= open_[k][0] + width:
            open_[k] = [t, 0]
        open_[k][1] += 1
        out[i] = (open_[k][0], open_[k][1], open_[k][1] <= limit)
    return out


def requests(seed, n, keys, span):
    rng = random.Random(seed)
    return [(i, None if (k := rng.randrange(keys)) == 1 else f"k{k}" if k < keys - 2 else "k0", rng.randrange(span)) for i in range(n)]


@pytest.mark.parametrize("seed,n,keys,span,block", [(1, 800, 6, 4000, 60), (2, 800, 4, 600, 200), (3, 500, 3, 50_000, 3600), (4, 900, 5, 90, 100), (5, 700, 4, 7000, 90)])
def test_windows_of_a_key(spark, seed, n, keys, span, block):
    rows = requests(seed, n, keys, span)
    frame = spark.createDataFrame(rows, "id int, k string, s long").withColumn("at", F.timestamp_seconds("s"))
    got = limits.limited_requests(frame, "k", "at", 4, tie="id", width_seconds=60, block_seconds=block).withColumn("w", F.unix_seconds("window_start")).collect()
    assert {r.id: (r.w, r.request_number, r.allowed) for r in got} == plain_limits(rows, 60, 4) and len(got) == n


def test_windows_of_odd_rows(spark):
    rows = [(1, "a", 10), (1, "a", 10), (2, "a", None), (3, None, 5), (4, "", 5), (None, None, None)]
    frame = spark.createDataFrame(rows, "id int, k string, s long").selectExpr("*", "timestamp_seconds(s) AS at", "7 AS allowed", "8 AS _t", "9 AS _kind")
    got = sorted(((str(r.id), str(r.k), r.request_number, r.allowed) for r in limits.limited_requests(frame, "k", "at", 1, tie="id").collect()), key=str)
    assert got == [("1", "a", 1, True), ("1", "a", 2, False), ("2", "a", None, None), ("3", "None", 1, True), ("4", "", 1, True), ("None", "None", None, None)]
    assert sorted(x[2] for x in got if x[2]) == [1, 1, 1, 2]
    assert limits.limited_requests(frame.limit(0), "k", "at", 1, tie="id").collect() == []


def plain_states(log, now, rules):
    """A fold over (document, attempt, micros, kind, ok) and the moments at which attempts are over."""
    limit, out = rules.timeout * 10**6, {}
    by_doc = {}
    for d, a, at, kind, ok in log:
        if at <= now:
            by_doc.setdefault(d, []).append((at, a, kind, ok))
    for d, rows in by_doc.items():
        open_, known, n, late, done, last = {}, set(), 0, 0, False, None
        ends, moments = [], sorted({r[0] for r in rows})
        for a in {r[1] for r in rows}:
            starts = [r[0] for r in rows if r[1] == a and r[2] == "started"]
            if not starts:
                continue
            s = min(starts)
            known.add(a)
            f = min(((r[0], r[3]) for r in rows if r[1] == a and r[2] == "finished" and r[0] >= s), default=None)
            if f and f[0] <= s + limit:
                ends.append((f[0], 1, a, f[1]))
            elif s + limit + 1 <= now:
                ends.append((s + limit + 1, 0, a, False))
            else:
                open_[a] = s
        if not known:
            continue
        for at, kind, _, ok in sorted(ends):
            if done or n >= rules.most:
                break
            n, late, last, done = n + 1, late + (kind == 0), at, bool(ok)
        due = None
        if done:
            state = "DONE"
        elif n >= rules.most:
            state = "QUARANTINED"
        elif open_:
            state = "RUNNING"
        else:
            due = last + rules.delay(n) * 10**6
            state = "DUE" if due <= now else "WAITING"
        out[d] = (state, n, late, due)
    return out


RULES = attempts.RetryRules(most=3, timeout=100, base=20, longest=50)


def attempt_log(seed, docs=60):
    rng, out = random.Random(seed), []
    for d in range(docs):
        t = rng.randrange(200)
        for a in range(rng.randrange(5)):
            t += rng.randrange(1, 150)
            out.append((f"d{d}", d * 10 + a, t * 10**6, "started", None))
            if rng.random() < 0.7:
                out.append((f"d{d}", d * 10 + a, (t + rng.choice([0, 1, 40, 99, 100, 101, 160])) * 10**6, "finished", rng.random() < 0.3))
            if rng.random() < 0.1:
                out.append(out[-1])
    return out


@pytest.mark.parametrize("now", [150, 400, 2000])
def test_states_by_a_log(spark, now):
    log = attempt_log(now)
    log += [(None, 1, 5, "started", None), ("x", 5, 5, "finished", True), ("y", 6, 10, "finished", True), ("y", 6, 20, "started", None)]
    got = attempts.retry_states(spark.createDataFrame(log, "document_id string, attempt long, at long, kind string, ok boolean"), F.lit(now * 10**6), RULES)
    expected = plain_states([r for r in log if r[0]], now * 10**6, RULES)
    assert {r.document_id: (r.state, r.attempts, r.timeouts, r.due) for r in got.collect()} == expected and len(expected) > 20


def add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def run(frame, out, mark):
    frame.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start().awaitTermination(240)


def test_stream_of_requests_over_restarts(spark, tmp_path):
    source, out, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "mark"))
    rows = [(i, "null" if k is None else k, t) for i, k, t in requests(9, 300, 5, 1500)]
    rows.sort(key=lambda r: r[2] + random.Random(r[0]).randrange(100))  # up to 100 s late
    schema = "id int, k string, s long"
    for part in (rows[:100], rows[100:200], rows[200:], [(-1, "end", 9000)]):
        add(spark, source, part, schema)
        stream = spark.readStream.schema(schema).parquet(source).withColumn("at", F.timestamp_seconds("s"))
        run(folds.limit_stream(stream, "k", "at", 4, tie="id", delay="200 seconds"), out, mark)
    got = spark.read.parquet(out).where("k <> 'end'").collect()
    assert {int(r.tie): (r.window_start // 10**6, r.request_number, r.allowed) for r in got} == plain_limits(rows, 60, 4) and len(got) == 300


def test_stream_of_attempts_over_restarts(spark, tmp_path):
    source, out, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "mark"))
    log = sorted(attempt_log(7, 25), key=lambda r: r[2])
    schema = "document_id string, attempt long, at long, kind string, ok boolean"
    third, end = len(log) // 3, 700 * 10**6
    for part in (log[:third], log[third : 2 * third], log[2 * third :], [("end", 0, end + 60 * 10**6, "started", None)]):
        add(spark, source, part, schema)
        stream = spark.readStream.schema(schema).parquet(source).withColumn("time", F.timestamp_micros("at"))
        run(folds.retry_stream(stream, delay="60 seconds", rules=RULES), out, mark)
    last = {}
    for r in spark.read.parquet(out).orderBy("at", "attempts").collect():
        if r.k not in last or (r.at, r.attempts, r.state == "DUE") >= last[r.k][0]:
            last[r.k] = ((r.at, r.attempts, r.state == "DUE"), (r.state, r.attempts, r.timeouts, r.due))
    batch = attempts.retry_states(spark.createDataFrame(log, schema), F.lit(end), RULES).collect()
    expected = {r.document_id: (r.state, r.attempts, r.timeouts, r.due) for r in batch}
    assert {k: v for k, (_, v) in last.items() if k != "end"} == expected
    assert {v[0] for v in expected.values()} >= {"DONE", "QUARANTINED"}
