"""Checks of model output and of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole or partial ISO dates.
DATE = r"^\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\d|3[01]))?)?$"


def first_violation(rows: DataFrame) -> DataFrame:
    """Add ``reason`` to rows of (cited, allowed, confidence, statement, date): the first rule broken, null if none is."""
    rules = [
        ("confidence", ~F.coalesce(F.col("confidence").between(0, 1), F.lit(False))),
        ("citation", (F.size("cited") == 0) | (F.size(F.array_except("cited", "allowed")) > 0)),
        ("text", F.trim(F.coalesce("statement", F.lit(""))) == ""),
        ("date", F.col("date").isNotNull() & ~F.col("date").rlike(DATE)),
    ]
    return rows.withColumn("reason", F.coalesce(*(F.when(broken, F.lit(name)) for name, broken in rules)))


def citations(answers: DataFrame, n_sources: str = "n_sources") -> DataFrame:
    """Add ``cited`` (source numbers of ``[S<n>]`` marks that exist, in order) and ``grounded``."""
    marks = F.transform(F.regexp_extract_all("answer", F.lit(r"\[S(\d+)\]"), F.lit(1)), lambda x: x.cast("int"))
    cited = F.array_sort(F.array_distinct(F.filter(marks, lambda x: (x >= 1) & (x <= F.col(n_sources)))))
    return answers.withColumn("cited", cited).withColumn("grounded", F.size("cited") > 0)


def missing_fields(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))
