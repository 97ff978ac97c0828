"""Ordered migrations of a ledger's tables: a log with a chain of checksums, steps of declared changes, versions on disk.

A step is a number, a name and a list of changes.  Its checksum covers all of that and the checksum of the step
before, so a log tells which steps were applied and that none of them, nor their order, has changed since.  Tables
are versioned: a step writes the tables it changes beside the old ones, and the log entry that follows is what makes
them current, so readers see a ledger before a step or after it, and a step that was cut off is done again.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Create:
    """A table with these columns, if there is none; an existing one gets those it lacks, null."""

    table: str
    columns: str

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromDDL(self.columns)
        known = tables.get(self.table)
        if known is None:
            return spark.createDataFrame([], schema)
        return known.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in known.columns})


@dataclass(frozen=True)
class Add:
    """A column by an SQL expression over the table's own; where the table has it, only its nulls are filled."""

    table: str
    column: str
    type: str
    value: str = "NULL"

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        rows = tables[self.table]
        value = F.expr(self.value).cast(self.type)
        return rows.withColumn(self.column, F.coalesce(F.col(self.column).cast(self.type), value) if self.column in rows.columns else value)


@dataclass(frozen=True)
class Rename:
    table: str
    column: str
    to: str

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        if self.column not in tables[self.table].columns:
            raise ValueError(f"{self.table} has no column {self.column}")
        return tables[self.table].withColumnRenamed(self.column, self.to)


@dataclass(frozen=True)
class Drop:
    table: str
    column: str

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        return tables[self.table].drop(self.column)


@dataclass(frozen=True)
class Retype:
    """Another type; values that it can't hold become null."""

    table: str
    column: str
    type: str

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        return tables[self.table].withColumn(self.column, F.col(self.column).try_cast(self.type))


@dataclass(frozen=True)
class Rekey:
    """A legacy table under a new identity: of the rows of a key the first in ``order`` (SQL, "... DESC" for descending) stays, rows with a null in the key go."""

    table: str
    key: tuple[str, ...]
    order: tuple[str, ...]

    def apply(self, tables: Tables, spark: SparkSession) -> DataFrame:
        rows = tables[self.table].dropna(subset=list(self.key))
        down = lambda c: F.expr(c.removesuffix(" DESC")).desc_nulls_last() if c.endswith(" DESC") else F.expr(c)
        ranks = Window.partitionBy(*self.key).orderBy(*map(down, self.order))
        return rows.withColumn("_rank", F.row_number().over(ranks)).where("_rank = 1").drop("_rank")


Change = Create | Add | Rename | Drop | Retype | Rekey


@dataclass(frozen=True)
class Step:
    number: int
    name: str
    changes: tuple[Change, ...] = field(default=())

    def checksum(self, before: str) -> str:
        told = [[type(c).__name__, asdict(c)] for c in self.changes]
        return hashlib.sha256(json.dumps([before, self.number, self.name, told], sort_keys=True).encode()).hexdigest()

    def apply(self, tables: Tables, spark: SparkSession) -> Tables:
        """The tables after the step; those given stay as they are."""
        out = dict(tables)
        for change in self.changes:
            if change.table not in out and not isinstance(change, Create):
                raise ValueError(f"step {self.number} ({self.name}): there is no table {change.table}")
            out[change.table] = change.apply(out, spark)
        return out

    @property
    def touched(self) -> list[str]:
        return sorted({c.table for c in self.changes})


class MigrationError(ValueError):
    """A log that the steps can't follow; ``number`` is the first step that doesn't fit."""

    def __init__(self, number: int, reason: str) -> None:
        super().__init__(f"step {number}: {reason}")
        self.number, self.reason = number, reason


def chained(steps: list[Step]) -> list[str]:
    """The checksum of every step, each over those before it; steps must be numbered 1, 2, 3... in order."""
    out: list[str] = []
    for k, step in enumerate(steps):
        if step.number != k + 1:
            raise MigrationError(k + 1, f"{step.name} has number {step.number}")
        out.append(step.checksum(out[-1] if out else ""))
    return out


@dataclass(frozen=True)
class Entry:
    number: int
    name: str
    checksum: str | None
    release: str
    applied_at: str


def verified(steps: list[Step], log: list[Entry]) -> list[Entry]:
    """``log`` in order, with checksums that it lacks filled in; raises with the first number that is missing, twice, unknown or changed."""
    sums = chained(steps)
    out = []
    for k, entry in enumerate(sorted(log, key=lambda e: (e.number, e.applied_at))):
        if entry.number != k + 1:
            raise MigrationError(k + 1 if entry.number > k + 1 else entry.number, "missing from the log" if entry.number > k + 1 else "in the log more than once")
        if k >= len(steps):
            raise MigrationError(entry.number, f"{entry.name} is in the log, but not known")
        if entry.name != steps[k].name or (entry.checksum and entry.checksum != sums[k]):
            raise MigrationError(entry.number, f"{entry.name} has changed since it was applied")
        out.append(Entry(entry.number, entry.name, sums[k], entry.release, entry.applied_at))
    return out


def status(steps: list[Step], log: list[Entry]) -> dict[str, object]:
    """applied and pending names, the problem (null if there is none), and whether the rest may be applied."""
    names = {e.number for e in log}
    told = {"applied": [s.name for s in steps if s.number in names], "pending": [s.name for s in steps if s.number not in names]}
    try:
        verified(steps, log)
    except MigrationError as problem:
        return told | {"problem": str(problem), "safe": False}
    return told | {"problem": None, "safe": True}


def schema_by_version(tables: Tables, steps: list[Step], spark: SparkSession) -> list[tuple[int, Tables]]:
    """(number, tables) after every step, 0 being those given."""
    chained(steps)
    out = [(0, tables)]
    for step in steps:
        out.append((step.number, step.apply(out[-1][1], spark)))
    return out


class VersionedTables:
    """Tables under a folder that all executors share: ``<root>/tables/<name>/<number>`` and ``<root>/log/<number>.json``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: object):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *map(str, parts)]))

    def _names(self, *parts: object) -> list[str]:
        at = self._path(*parts)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def log(self) -> list[Entry]:
        names = sorted(n for n in self._names("log") if n.endswith(".json"))
        if not names:
            return []
        rows = self.spark.read.schema("number int, name string, checksum string, release string, applied_at string").json([f"{self.root}/log/{n}" for n in names]).collect()  # one for each step
        return [Entry(**r.asDict()) for r in rows]

    def _append(self, entry: Entry) -> None:
        """The moment at which a step counts: its entry gets its name in one move, which fails if there is one."""
        raw, draft = json.dumps(asdict(entry)).encode(), self._path("log", f".{entry.number:05d}.draft")
        out = self._fs.create(draft, True)
        out.write(raw)
        out.close()
        final = self._path("log", f"{entry.number:05d}.json")
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise MigrationError(entry.number, "was applied by someone else in the meantime")

    def tables(self, version: int | None = None) -> Tables:
        """The tables as of ``version`` (the last in the log, if none is told): of each the newest not after it."""
        last = max((e.number for e in self.log()), default=0) if version is None else version
        found: Tables = {}
        for name in self._names("tables"):
            known = [int(v) for v in self._names("tables", name) if v.isdecimal() and int(v) <= last]
            if known:
                found[name] = self.spark.read.parquet(f"{self.root}/tables/{name}/{max(known)}")
        return found

    def install(self, tables: Tables) -> None:
        """The tables that are there before the first step."""
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.root}/tables/{name}/0")

    def migrate(self, steps: list[Step], release: str) -> list[str]:
        """Apply the steps that the log lacks, in order; the names of those applied.  Nothing is if the log doesn't fit."""
        log, sums, done = verified(steps, self.log()), chained(steps), []
        for step in steps[len(log) :]:
            after = step.apply(self.tables(step.number - 1), self.spark)
            for name in step.touched:
                after[name].write.mode("overwrite").parquet(f"{self.root}/tables/{name}/{step.number}")
            self._append(Entry(step.number, step.name, sums[step.number - 1], release, datetime.now(UTC).isoformat(timespec="seconds")))
            done.append(step.name)
        return done

    def problems(self, wanted: dict[str, list[str]]) -> list[str]:
        """What the current tables lack of {table: columns}; further tables and columns are allowed."""
        now = self.tables()
        out = [f"missing table {t}" for t in sorted(wanted) if t not in now]
        return out + [f"missing column {t}.{c}" for t in sorted(wanted) if t in now for c in sorted(set(wanted[t]) - set(now[t].columns))]
