"""Retry and quarantine: the states of documents by a log of attempts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RetryRules:
    """An attempt ends after ``timeout`` seconds at the latest; after ``most`` that failed a document is quarantined."""

    most: int = 3
    timeout: int = 1200
    base: int = 30
    longest: int = 3600

    def delay(self, attempts: int) -> int:
        """Seconds to wait after so many attempts: doubling up to ``longest``."""
        return min(self.base << min(attempts - 1, 40), self.longest)


def ended_attempts(log: DataFrame) -> DataFrame:
    """(document_id, attempt, started, finished, ok) of a log (document_id, attempt, at, kind, ok): the first start of an attempt and its first finish from then on.

    Times are microseconds.  A finish without a start before it is no attempt's.
    """
    start = log.where("kind = 'started'").groupBy("document_id", "attempt").agg(F.min("at").alias("started"))
    finish = log.where("kind = 'finished'").select("document_id", "attempt", F.col("at").alias("finished"), F.coalesce("ok", F.lit(False)).alias("ok"))
    met = start.join(finish, ["document_id", "attempt"], "left").where("finished IS NULL OR finished >= started")
    first = met.groupBy("document_id", "attempt").agg(F.min("started").alias("started"), F.min(F.struct("finished", "ok")).alias("f"))
    # a start whose finishes all lie before it has none
    return start.join(first.drop("started"), ["document_id", "attempt"], "left").select("document_id", "attempt", "started", F.col("f.finished").alias("finished"), F.col("f.ok").alias("ok"))


def retry_states(log: DataFrame, now: Column, rules: RetryRules = RetryRules()) -> DataFrame:
    """(document_id, state, attempts, timeouts, due) at the time ``now`` (microseconds) by a log (document_id, attempt, at, kind, ok) up to then.

    Attempts count in the order of their ends, up to the first that goes well (DONE) or the one that makes
    ``most`` (QUARANTINED); what ends later changes nothing.  Else a document is RUNNING while an attempt is, or
    it waits (WAITING) until ``due`` and is DUE from then on.  Documents without a start have no state; a null
    document_id has none either.

    Only the first ``most`` ends of a document are kept, by each task before the shuffle, however many a hot document has.
    """
    limit = rules.timeout * 1_000_000
    each = ended_attempts(log.where("document_id IS NOT NULL AND attempt IS NOT NULL").where(F.col("at") <= now))
    late = F.col("started") + limit + 1  # the moment after the last one in time
    in_time = F.col("finished") <= F.col("started") + limit
    outcome = F.when(in_time, F.when(F.col("ok"), "SUCCEEDED").otherwise("FAILED")).when(late <= now, "TIMED_OUT").otherwise("RUNNING")
    each = each.withColumns({"outcome": outcome, "ended": F.when(in_time, F.col("finished")).otherwise(late)})
    order = [F.col("ended"), (F.col("outcome") != "TIMED_OUT"), F.col("attempt")]
    ended = each.where("outcome <> 'RUNNING'").withColumn("pos", F.row_number().over(Window.partitionBy("document_id").orderBy(*order))).where(F.col("pos") <= rules.most)
    good = F.min(F.when(F.col("outcome") == "SUCCEEDED", F.col("pos"))).over(Window.partitionBy("document_id"))
    counted = ended.withColumn("good", good).where("good IS NULL OR pos <= good")
    sums = counted.groupBy("document_id").agg(F.count("*").alias("attempts"), F.count_if(F.col("outcome") == "TIMED_OUT").alias("timeouts"), F.max("ended").alias("last"), F.max("good").alias("good"))
    running = each.groupBy("document_id").agg(F.max(F.col("outcome") == "RUNNING").alias("running"))
    out = running.join(sums, "document_id", "left")
    n = F.coalesce("attempts", F.lit(0))
    delay = F.least(F.lit(float(rules.base)) * F.pow(F.lit(2.0), n - 1), F.lit(float(rules.longest))).cast("long") * 1_000_000
    open_ = F.col("good").isNull() & (n < rules.most)
    due = F.when(open_ & ~F.col("running"), F.col("last") + delay)
    state = F.when(F.col("good").isNotNull(), "DONE").when(n >= rules.most, "QUARANTINED").when(F.col("running"), "RUNNING").when(due <= now, "DUE").otherwise("WAITING")
    return out.select("document_id", state.alias("state"), n.alias("attempts"), F.coalesce("timeouts", F.lit(0)).alias("timeouts"), due.alias("due"))
