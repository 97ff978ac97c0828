"""Aggregations: facets, quantiles by two rules, merges of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def facet_counts(rows: DataFrame, facets: list[str], top: int) -> DataFrame:
    """(facet, value, n, rank): the ``top`` most frequent values of each column, ties by value; arrays count each element."""
    kinds = dict(rows.dtypes)
    lists = [F.col(f) if kinds[f].startswith("array") else F.array(F.col(f).cast("string")) for f in facets]
    pairs = F.array(*(F.struct(F.lit(f).alias("facet"), c.cast("array<string>").alias("values")) for f, c in zip(facets, lists)))
    each = rows.select(F.explode(pairs).alias("p")).select("p.facet", F.explode("p.values").alias("value")).where("value is not null")
    counted = each.groupBy("facet", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= top)


def nearest_rank(rows: DataFrame, key: str, value: str, shares: dict[str, float]) -> DataFrame:
    """(key, n, total, mean, quantiles, max_value) of a number: a quantile is the ceil(p * n)-th smallest value.

    Values are counted in ``BANDS`` bands between a key's least and greatest; only the bands that a quantile falls
    into are ordered, each with its own values.  Where a band has too many distinct values it still is one task's:
    bands of a key differ in their rows only as its values cluster, and equal values are counted before the shuffle.
    """
    rows = rows.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_v"))
    base = rows.groupBy(key).agg(F.count("*").alias("n"), F.sum("_v").alias("total"), F.avg("_v").alias("mean"), F.min("_v").alias("_low"), F.max("_v").alias("max_value"))
    width = (F.col("max_value") - F.col("_low")) / BANDS
    band = F.when(width > 0, F.least(F.floor((F.col("_v") - F.col("_low")) / width), F.lit(BANDS - 1))).otherwise(0).cast("int")
    each = rows.groupBy(key, "_v").agg(F.count("*").alias("_c")).join(F.broadcast(base) if _few(base) else base, key).withColumn("_b", band)
    bands = each.groupBy(key, "_b").agg(F.sum("_c").alias("_c"))
    upto = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ahead = bands.select(key, "_b", F.coalesce(F.sum("_c").over(upto), F.lit(0)).alias("_ahead"), "_c")
    wanted = F.array(*(F.struct(F.lit(n).alias("name"), F.ceil(F.lit(p) * F.col("n")).alias("at")) for n, p in shares.items()))
    asked = ahead.join(base.select(key, "n"), key).select(key, "_b", "_ahead", "_c", F.explode(wanted).alias("w")).where("w.at > _ahead AND w.at <= _ahead + _c")
    near = each.select(key, "_b", "_v", "_c").join(asked.select(key, "_b", "_ahead", F.col("w.name").alias("name"), F.col("w.at").alias("at")), [key, "_b"])
    order = Window.partitionBy(key, "_b", "name").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    reached = near.withColumn("_to", F.col("_ahead") + F.sum("_c").over(order)).where("_to >= at").groupBy(key, "name").agg(F.min("_v").alias("_v"))
    wide = reached.groupBy(key).agg(*(F.max(F.when(F.col("name") == n, F.col("_v"))).alias(n) for n in shares))
    return base.join(wide, key).select(key, "n", "total", "mean", *shares, "max_value")


#: Bands of a key's values in nearest_rank; keys up to FEW are broadcast with their bounds.
BANDS, FEW = 1000, 100_000


def _few(rows: DataFrame) -> bool:
    return rows.count() <= FEW


def bankers_percentile(rows: DataFrame, key: str, value: str, share: float, order: str) -> DataFrame:
    """(key, value): the row at index round((n - 1) * share), halves to even."""
    w = Window.partitionBy(key)
    ranked = rows.select(key, value, (F.row_number().over(w.orderBy(value, order)) - 1).alias("at"), F.count("*").over(w).alias("n"))
    return ranked.where(F.col("at") == F.expr(f"bround((n - 1) * {share})").cast("long")).select(key, F.col(value).alias("percentile"))


def merge_entities(rows: DataFrame) -> DataFrame:
    """One row per entity_id of (entity_id, seq, name, alias, source_url): the first name and source, sorted distinct aliases."""
    return rows.groupBy("entity_id").agg(
        F.min_by("name", "seq").alias("name"),
        F.array_sort(F.array_distinct(F.collect_list("alias"))).alias("aliases"),
        F.min_by("source_url", F.when(F.col("source_url").isNotNull(), F.col("seq"))).alias("source_url"),
        F.count("*").alias("observations"),
    )


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """The row of each key with the highest ``seq``."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def first_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), seq).alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest))


def usage_cost(meters: DataFrame, rates: dict[str, float], group: str) -> DataFrame:
    """(group, units, missing, cost): units * rate / 1000 per meter; one meter without a rate makes the cost null."""
    rate = F.coalesce(*(F.when(F.col("meter") == m, F.lit(r)) for m, r in rates.items()))
    priced = meters.withColumn("rate", rate)
    missing = F.array_join(F.array_sort(F.collect_set(F.when(F.col("rate").isNull(), F.col("meter")))), ",")
    out = priced.groupBy(group).agg(F.sum("units").alias("units"), missing.alias("missing"), F.sum(F.col("units") * F.col("rate") / 1000).alias("total"))
    return out.select(group, "units", "missing", F.when(F.col("missing") == "", F.round("total", 2)).alias("cost"))


def ratio_of_sums(a: Column, b: Column) -> Column:
    return F.sum(a) / F.greatest(F.sum(b), F.lit(1))


def parts_else_whole(parts: Column, own: Column) -> Column:
    """The sum of an array of parts; the whole's own number where there are none."""
    return F.when(F.size(F.coalesce(parts, F.array())) > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + F.coalesce(x.cast("double"), F.lit(0.0)))).otherwise(F.coalesce(own.cast("double"), F.lit(0.0)))


def metered_cost(usage: DataFrame, rates: DataFrame, group: str) -> DataFrame:
    """(group, units, missing, cost) of usage (group, meter, units) at rates (group, meter, rate) per thousand; a meter without a rate makes the cost null."""
    summed = usage.groupBy(group, "meter").agg(F.sum("units").alias("units"))
    priced = summed.join(rates, [group, "meter"], "left")
    missing = F.array_join(F.array_sort(F.collect_set(F.when(F.col("rate").isNull(), F.col("meter")))), ",")
    out = priced.groupBy(group).agg(F.sum("units").alias("units"), missing.alias("missing"), F.sum(F.col("units") * F.col("rate") / 1000).alias("total"))
    return out.select(group, "units", "missing", F.when(F.col("missing") == "", F.round("total", 2)).alias("cost"))


# Fixed value: scores that differ by no more are a tie.
TIE = 0.002


def cohort_wins(rows: DataFrame, cohorts: Column, a: str, b: str) -> DataFrame:
    """(cohort, n, a_wins, b_wins, ties, a_mean, b_mean): every row counts in each of its cohorts; scores within TIE of one another tie."""
    each = rows.withColumn("cohort", F.explode(cohorts))
    gap = F.col(a) - F.col(b)
    return each.groupBy("cohort").agg(
        F.count("*").alias("n"), F.count_if(gap > TIE).alias("a_wins"), F.count_if(gap < -TIE).alias("b_wins"), F.count_if(F.abs(gap) <= TIE).alias("ties"), F.avg(a).alias("a_mean"), F.avg(b).alias("b_mean")
    )


def top_cohorts(rows: DataFrame, key: str, rules: dict[str, tuple[Column, list[Column], int]]) -> DataFrame:
    """(key, cohorts): by each rule (condition, order, n) the first n rows; a key's cohorts are sorted."""
    out = None
    for name, (condition, order, n) in rules.items():
        own = rows.where(condition).orderBy(*order, key).limit(n).select(key, F.lit(name).alias("cohort"))
        out = own if out is None else out.unionByName(own)
    return out.groupBy(key).agg(F.array_sort(F.collect_list("cohort")).alias("cohorts"))  # one of each rule at most


def attempt_reliability(rows: DataFrame, most: int) -> DataFrame:
    """(first_attempt, retried, quarantined, unfinished, timeouts) of states (attempts, done, codes)."""
    done, n = F.coalesce("done", F.lit(False)), F.coalesce("attempts", F.lit(0))
    timeouts = F.size(F.filter("codes", lambda c: c == "TIMEOUT"))
    return rows.agg(
        F.count_if(done & (n <= 1)).alias("first_attempt"), F.count_if(done & (n > 1)).alias("retried"), F.count_if(~done & (n >= most)).alias("quarantined"),
        F.count_if(~done & (n < most)).alias("unfinished"), F.sum(timeouts).alias("timeouts"),
    )


def best_page(regions: DataFrame, weights: dict[str, int]) -> DataFrame:
    """(document_id, page, score): the page with the greatest sum of weights of its regions (document_id, page, kind), the first of equals."""
    weight = F.coalesce(*(F.when(F.col("kind") == k, F.lit(w)) for k, w in weights.items()), F.lit(0))
    scored = regions.groupBy("document_id", "page").agg(F.sum(weight).alias("score"))
    best = scored.groupBy("document_id").agg(F.max_by("page", F.struct("score", (-F.col("page")).alias("p"))).alias("page"), F.max("score").alias("score"))
    return best


def answer_fold(events: DataFrame) -> DataFrame:
    """(answer_id, text, last, failed) of answer events (answer_id, pos, kind, payload): deltas joined in order up to an error, the last of other kinds."""
    stop = events.groupBy("answer_id").agg(F.min(F.when(F.col("kind") == "error", F.col("pos"))).alias("_stop"))
    rows = events.join(stop, "answer_id").where(F.col("_stop").isNull() | (F.col("pos") <= F.col("_stop")))
    deltas = F.array_sort(F.collect_list(F.when(F.col("kind") == "delta", F.struct("pos", "payload"))))  # one answer
    out = rows.groupBy("answer_id").agg(deltas.alias("d"), F.max_by("payload", F.when(~F.col("kind").isin("delta", "error"), F.col("pos"))).alias("last"), (F.count_if(F.col("kind") == "error") > 0).alias("failed"))
    return out.select("answer_id", F.array_join(F.transform("d", lambda x: x["payload"]), "").alias("text"), "last", "failed")
