"""Registered queries against their SQL over small tables of shapes that the given ones don't have."""

import math
from collections import Counter
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from palimpsest.operators import model_records, retrieval
from palimpsest.plans import flows, knowledge, registry
from tests.test_queries import plain


def agree(spark, folder, name, **tables):
    """The query's rows, which are those of its SQL; ``tables`` are (schema, rows)."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    frame = registry.queries()[name](spark, str(folder))
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    found = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
    return [dict(zip(columns, r)) for r in got]


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def test_run_states_counts_fractions_of_a_second(spark, tmp_path):
    now = datetime(2024, 1, 30, 12, 0, 0, 900_000)
    ago = {1: 0.0, 2: 119.9, 3: 120.5, 4: 120.95, 5: 121.5}
    rows = [(10 + u, now - timedelta(seconds=s), u, "view", 1.0, "") for u, s in ago.items()]
    got = agree(spark, tmp_path, "run_states", events=(EVENTS, rows))
    assert {r["run_id"]: r["stale"] for r in got} == {1: False, 2: False, 3: True, 4: False, 5: True}  # 14 % 7 = 0: ended


def test_audit_counters_without_a_finding_of_a_kind(spark, tmp_path):
    rows = [(k, k % 7, "O", 1.0, datetime(2024, 1, 1), "1-URGENT") for k in range(54)]
    got = agree(spark, tmp_path, "audit_counters", orders=(ORDERS, rows), events=(EVENTS, [(1, datetime(2024, 1, 1), 1, "view", 1.0, "")]))
    assert "missing_member_documents" not in {r["counter"] for r in got}


def written(spark) -> int:
    """Rows that all stages so far have put into shuffles."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


def test_bm25_ranks_in_tasks_whatever_the_frequency(spark):
    texts = {d: ["the"] * (1 + d % 3) + [f"w{d % 11}", f"v{d % 60}"] * (1 + d % 4) for d in range(400)} | {400: [], 401: None}
    asked = [(q, t) for q in range(0, 400, 4) for t in ("the", texts[q][-1], texts[q][-1])] + [(999, "unknown")]
    docs, queries = spark.createDataFrame(list(texts.items()), "doc_id long, tokens array<string>"), spark.createDataFrame(asked, "query_id long, term string")
    before = written(spark)
    got = retrieval.bm25_top_k(docs.repartition(3), queries, 5).collect()
    assert written(spark) - before < 10_000  # the pairs of queries and rows with a common term are 40,000
    held = {d: Counter(w or []) for d, w in texts.items()}
    df = Counter(t for c in held.values() for t in c)
    average = sum(len(w) for w in texts.values() if w is not None) / 401
    weight = lambda t, d: math.log(1 + (402 - df[t] + 0.5) / (df[t] + 0.5)) * held[d][t] * 2.2 / (held[d][t] + 1.2 * (0.25 + 0.75 * len(texts[d] or []) / average))
    for q in range(0, 400, 4):
        terms = {"the", texts[q][-1]}
        scores = {d: round(sum(weight(t, d) for t in sorted(terms) if held[d][t]), 6) for d in held if terms & set(held[d])}
        want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
        own = sorted((r.rank, r.doc_id, r.score) for r in got if r.query_id == q)
        assert [r[1] for r in own] == [d for d, _ in want] and [r[2] for r in own] == pytest.approx([s for _, s in want])
    assert not [r for r in got if r.query_id == 999]


def test_answers_are_dealt_over_all_tasks_and_read_once(spark, tmp_path):
    """Orders of one file and row group, whose answers are many times longer."""
    day = datetime(2024, 1, 1)
    orders = [(k, k % 7, "FOP"[k % 3], 1.0, day, "1-URGENT") for k in range(300)]
    customer = [(c, f"C{c}") for c in range(7)]
    assert agree(spark, tmp_path, "model_tables", orders=(ORDERS, orders), customer=("c_custkey long, c_name string", customer))
    spark.createDataFrame(orders, ORDERS).coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    one = lambda name: spark.read.parquet(f"{tmp_path}/one.parquet")
    assert knowledge._answers(one).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_model_tables_send_no_table_through_the_driver(spark, tmp_path):
    """Spark takes the pages of answers, the known chunks and the facts for small, at any size."""
    orders = [(k, k % 7, "FOP"[k % 3], 1.0, datetime(2024, 1, 1), "1-URGENT") for k in range(60)]
    for name, (schema, rows) in {"orders": (ORDERS, orders), "customer": ("c_custkey long, c_name string", [(c, f"C{c}") for c in range(7)])}.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
    chunks = t("orders").select(F.concat("o_orderkey", F.lit(":1")).alias("chunk_id"), F.lit(1).alias("page_start"), F.lit(2).alias("page_end"))
    facts = t("customer").select(F.col("c_custkey").cast("string").alias("document_id"), *(F.col("c_name").alias(c) for c in model_records.COMMON))
    out = model_records.materialized(model_records.checked_answers(knowledge._answers(t)), chunks, facts, version="v")
    for frame in (registry.queries()["model_tables"](spark, str(tmp_path)), out.events, out.claims, out.obligations, out.entities, out.relations):
        rows = frame.collect()
        assert rows and "Broadcast" not in frame._jdf.queryExecution().executedPlan().toString()
    for records in (out.events, out.claims, out.obligations, out.relations):
        assert {(r.document_id, r.company, r.source_url) for r in records.collect()} <= {(str(c), f"C{c}", f"C{c}") for c in range(7)}
    assert {r.source_url for r in out.entities.collect()} <= {f"C{c}" for c in range(7)}


def test_artifacts_are_dealt_over_all_tasks(spark, tmp_path):
    orders = [(k, k % 7, "F", 1.0, datetime(2024, 1, 1), "1-URGENT") for k in range(1, 1500)]
    assert agree(spark, tmp_path, "artifact_problems", orders=(ORDERS, orders))
    one = lambda name: spark.createDataFrame(orders, ORDERS).coalesce(1)
    assert flows._checked(one).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
