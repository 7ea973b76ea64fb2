"""Stored tables: Parquet folders a run replaces day by day, and the list of commits.

Plain Parquet has neither MERGE nor UPDATE.  A run therefore writes the days it changes
as new folders and then adds one entry to the store's commit list, which names the folder
of each changed day of all its tables.  Readers take each day from the folder named last,
so they see a run as a whole or not at all, and nothing is ever overwritten in place.

Entries are numbered, and a number is given once: of two writers that began at the same
entry, the second one fails and has changed nothing.  Each entry carries aggregates of
the days it names, which roll up to the whole table without reading it.  Every so often
an entry is followed by a checkpoint of all that holds then, so a bounded number of files
is read, however many entries there were.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline import schemas
from ledgerline.operators.id_filter import FILTER, id_filters, may_hold, size_for
from ledgerline.session import COMPRESSION
from ledgerline.sources.files import folder, names, put_text, read_text, remove_folder, subfolders

DAY = "event_day"
WRITE = "write"
CHECKPOINT_EVERY = 16
_ENTRY, _CHECKPOINT = ".json", ".checkpoint.json"


class CommitConflict(RuntimeError):
    """Another writer has committed since this one began."""


def _plain(value: Any) -> Any:
    return value.isoformat() if isinstance(value, (datetime, date)) else value


@dataclass(frozen=True)
class CommitLog:
    """The numbered entries of a store; each is a file of JSON lines, a line per day."""

    spark: SparkSession
    path: str

    def _listed(self) -> tuple[int, list[int], int]:
        """The number of the newest checkpoint, of the entries after it, and of the last entry."""
        found = names(self.spark, self.path)
        points = [int(n[:20]) for n in found if n.endswith(_CHECKPOINT)]
        entries = sorted(
            int(n[:20]) for n in found if n.endswith(_ENTRY) and not n.endswith(_CHECKPOINT)
        )
        point = max(points, default=0)
        return point, [n for n in entries if n > point], max([point, *entries])

    def _file(self, number: int, kind: str) -> str:
        return f"{self.path}/{number:020d}{kind}"

    def files(self) -> list[str]:
        """The files that tell what holds now."""
        point, entries, _ = self._listed()
        held = [self._file(point, _CHECKPOINT)] if point else []
        return held + [self._file(n, _ENTRY) for n in entries]

    def version(self) -> int:
        return self._listed()[2]

    def state(self) -> dict[tuple[str, str], dict[str, Any]]:
        """The last line of each table and day: as many as there are days, whatever the rows."""
        held: dict[tuple[str, str], dict[str, Any]] = {}
        for file in self.files():
            for line in read_text(self.spark, file).splitlines():
                row = json.loads(line)
                held[row["table"], row["day"]] = row
        return held

    def put(self, after: int, lines: Sequence[Mapping[str, Any]]) -> int:
        """Add the entry that follows ``after``, if no other writer has."""
        number = after + 1
        stamped = [{**line, "version": number, "at": time.time()} for line in lines]
        text = "".join(json.dumps(line, default=_plain) + "\n" for line in stamped)
        point, _, last = self._listed()
        if last > after or not put_text(self.spark, self._file(number, _ENTRY), text):
            raise CommitConflict(f"entry {number} of {self.path} is there already")
        if number % CHECKPOINT_EVERY == 0:
            whole = "".join(json.dumps(line) + "\n" for line in self.state().values())
            put_text(self.spark, self._file(number, _CHECKPOINT), whole)
            # What the checkpoint before this one replaced is no longer read by anyone.
            files = folder(self.spark, self.path)[1]
            path = self.spark._jvm.org.apache.hadoop.fs.Path
            for name in names(self.spark, self.path):
                if name[:1] != "." and int(name[:20]) < point:
                    files.delete(path(f"{self.path}/{name}"), False)
        return number


@dataclass(frozen=True)
class Pending:
    """Days of a table that are written but not published."""

    table: DailyTable
    days: tuple[str, ...]
    folder: str | None = None
    stats: dict[str, dict[str, Any]] = field(default_factory=dict)
    of: Mapping[str, str] = field(default_factory=dict)  # what the days were made of

    def made(self) -> dict[str, str]:
        """The folder of each day that has rows."""
        return {day: self.folder for day in self.days if day in self.stats}

    def lines(self) -> list[dict[str, Any]]:
        kept = self.table.measures
        return [
            {
                "table": self.table.name,
                "day": day,
                "folder": self.folder if day in self.stats else None,
                "of": self.of.get(day),
                "stats": {m: self.stats.get(day, {}).get(m) for m in kept},
            }
            for day in self.days
        ]

    def read(self) -> DataFrame:
        """The written days as they will be."""
        return self.table._scan(list(self.made().items()))

    def total(self, measure: str) -> int:
        return sum(day[measure] or 0 for day in self.stats.values())

    def discard(self) -> None:
        if self.folder:
            for path in (self.table.path, self.table.filter_path):
                remove_folder(self.table.spark, f"{path}/{self.folder}")


@dataclass(frozen=True)
class DailyTable:
    """A table kept in one partition per day label.

    ``measures`` are aggregates of a day that its commit carries.  With ``key``, a Bloom
    filter of the key's values is kept beside each day.
    """

    spark: SparkSession
    name: str
    root: str
    schema: StructType
    log: CommitLog
    measures: dict[str, Column] = field(default_factory=lambda: {"rows": F.count("*")})
    key: str | None = None

    @property
    def path(self) -> str:
        return f"{self.root}/{self.name}"

    @property
    def filter_path(self) -> str:
        return f"{self.root}/{self.name}-filters"

    def _state(self) -> dict[str, dict[str, Any]]:
        held = self.log.state().items()
        return {day: row for (table, day), row in held if table == self.name and row["folder"]}

    def _current(self, days: Iterable[str] | None = None) -> list[tuple[str, str]]:
        """Folder of each day; one short row per day ever written."""
        wanted = None if days is None else set(days)
        held = sorted(self._state().items())
        return [(day, row["folder"]) for day, row in held if wanted is None or day in wanted]

    def stats(self) -> dict[str, dict[str, Any]]:
        """The aggregates of each day, from the commit list alone."""
        return {day: row["stats"] for day, row in self._state().items()}

    def total(self, measure: str, days: Iterable[str] | None = None) -> int:
        """The sum of a measure over the table, or over some days of it, without reading it."""
        wanted = None if days is None else set(days)
        return sum(s[measure] or 0 for d, s in self.stats().items() if wanted is None or d in wanted)

    def greatest(self, measure: str) -> str | None:
        return max((s[measure] for s in self.stats().values() if s[measure]), default=None)

    def read(self, days: Iterable[str] | None = None) -> DataFrame:
        """The table, or the given days of it."""
        return self.read_with_day(days).select(self.schema.fieldNames())

    def read_with_day(self, days: Iterable[str] | None = None) -> DataFrame:
        """One scan over the current folder of each day."""
        return self._scan(self._current(days))

    def _scan(self, current: list[tuple[str, str | None]], filters: bool = False) -> DataFrame:
        base = self.filter_path if filters else self.path
        fields = (FILTER if filters else self.schema).fields
        schema = StructType([*fields]).add(DAY, "string")
        paths = [f"{base}/{folder_}/{DAY}={day}" for day, folder_ in current]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (
            self.spark.read.schema(StructType([*schema.fields]).add(WRITE, "string"))
            .option("basePath", base)
            .parquet(*paths)
            .drop(WRITE)
        )

    def days_that_may_hold(self, ids: DataFrame, beside: Iterable[str] = ()) -> list[str]:
        """The days, but for those of ``beside``, that may hold one of the ids.

        Only the filters of these days are read.  A day that holds one is never missed.
        """
        left = [(d, f) for d, f in self._current() if d not in set(beside)]
        if not left:
            return []
        filters = self._scan(left, filters=True)
        sizes = sorted({s["size"] for d, s in self.stats().items() if d not in set(beside)})
        found = may_hold(filters, ids.select(self.key), DAY, self.key, sizes)
        return sorted(r[0] for r in found.select(DAY).distinct().collect())

    def stage(
        self, rows: DataFrame, days: Iterable[str], of: Mapping[str, str] | None = None, **more: Column
    ) -> Pending:
        """Write ``rows``, which carry their day label, as the content of the given days.

        Nothing of it is seen before ``Store.publish``.  Rebalancing gives each day files
        of a sensible size: small days share no task's leftovers, and a day with a large
        share of all rows is written by many tasks.  ``of`` names per day what the
        rows were made of.  ``more`` are further aggregates, which the commit leaves out.
        """
        days = tuple(sorted(set(days)))
        if not days:
            return Pending(self, days)
        written = f"{WRITE}={uuid.uuid4().hex}"
        target = f"{self.path}/{written}"
        rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(target, compression=COMPRESSION)
        filled = {n.partition("=")[2] for n in subfolders(self.spark, target) if n.startswith(DAY)}
        held = self._scan([(day, written) for day in days if day in filled])
        measures = {**self.measures, **more}
        per_day = held.groupBy(DAY).agg(*[c.alias(n) for n, c in measures.items()])
        stats = {r[DAY]: {n: r[n] for n in measures} for r in per_day.collect()} if filled else {}
        if self.key and filled:
            # As many rows as days.
            sizes = self.spark.createDataFrame([(d, s["size"]) for d, s in stats.items()], f"{DAY} string, size int")
            sized = held.select(DAY, self.key).join(F.broadcast(sizes), DAY)
            filters = id_filters(sized, DAY, self.key)
            filters.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{self.filter_path}/{written}")
        return Pending(self, days, written, stats, of or {})

    def replace(
        self, rows: DataFrame, days: Iterable[str], of: Mapping[str, str] | None = None
    ) -> None:
        """Make ``rows`` the content of the given days."""
        version = self.log.version()
        pending = self.stage(rows, days, of)
        if pending.days:
            self.log.put(version, pending.lines())

    def remove_replaced(self, older_than: float) -> int:
        """Delete day folders that are not, or no longer, part of the table; returns how many.

        Only folders that were written and replaced at least ``older_than`` seconds ago
        go, so that a reader that began before the replacement can end.  Like a write,
        this needs the table for itself.
        """
        until = time.time() - older_than
        state = {d: r for (t, d), r in self.log.state().items() if t == self.name}
        removed = 0
        for base in (self.path, self.filter_path):
            pattern, files = folder(self.spark, f"{base}/{WRITE}=*/{DAY}=*")
            for status in files.globStatus(pattern) or []:
                at = status.getPath()
                day, written = at.getName().partition("=")[2], at.getParent().getName()
                row = state.get(day)
                current = row is not None and row["folder"] == written
                replaced_at = row["at"] if row else 0
                if not current and max(replaced_at, status.getModificationTime() / 1000) <= until:
                    files.delete(at, True)
                    removed += base == self.path
        return removed


@dataclass(frozen=True)
class LogTable:
    """A small append-only table; the latest row per key is its current state.

    Rows arrive as numbered files of JSON lines, a few a run.  Every so often the current
    state is written as a checkpoint, so a bounded number of files is read.
    """

    spark: SparkSession
    path: str
    schema: StructType
    key: str

    @property
    def _stored(self) -> StructType:
        return StructType([*self.schema.fields]).add("_seq", "long")

    def _listed(self) -> tuple[int, list[int]]:
        found = names(self.spark, self.path)
        point = max((int(n[6:]) for n in found if n.startswith("point-")), default=0)
        entries = sorted(int(n[: -len(_ENTRY)]) for n in found if n.endswith(_ENTRY) and n[0] != ".")
        return point, [n for n in entries if n > point]

    def files(self) -> list[str]:
        point, entries = self._listed()
        held = [f"{self.path}/point-{point:020d}"] if point else []
        return held + [f"{self.path}/{n:020d}{_ENTRY}" for n in entries]

    def append(self, rows: Sequence[Mapping[str, Any]]) -> None:
        """Add rows; of two writers at the same time both succeed, one after the other."""
        if not rows:
            return
        wanted = self.schema.fieldNames()
        while True:
            point, entries = self._listed()
            number = max([point, *entries]) + 1
            lines = [{**{n: row.get(n) for n in wanted}, "_seq": number} for row in rows]
            text = "".join(json.dumps(line, default=_plain) + "\n" for line in lines)
            if put_text(self.spark, f"{self.path}/{number:020d}{_ENTRY}", text):
                break
        if number % CHECKPOINT_EVERY == 0:
            self._checkpoint(point, number)

    def _checkpoint(self, before: int, number: int) -> None:
        target = f"{self.path}/point-{number:020d}"
        aside = f"{self.path}/.{uuid.uuid4().hex}"
        self._latest().write.parquet(aside)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files = folder(self.spark, self.path)[1]
        files.rename(path(aside), path(target))
        for name in names(self.spark, self.path):
            stale = name.endswith(_ENTRY) and name[0] != "." and int(name[: -len(_ENTRY)]) <= before
            if stale or (name.startswith("point-") and int(name[6:]) < before):
                files.delete(path(f"{self.path}/{name}"), True)

    def _rows(self) -> DataFrame:
        point, entries = self._listed()
        held = self.spark.createDataFrame([], self._stored)
        if point:
            held = self.spark.read.schema(self._stored).parquet(f"{self.path}/point-{point:020d}")
        if entries:
            # Times are read as text, whatever their fraction, and cast.
            as_text = StructType()
            for f in self._stored.fields:
                as_text = as_text.add(f.name, "string" if "timestamp" in f.dataType.typeName() else f.dataType)
            paths = [f"{self.path}/{n:020d}{_ENTRY}" for n in entries]
            added = self.spark.read.schema(as_text).json(paths)
            held = held.unionByName(
                added.select(*[F.col(f.name).cast(f.dataType) for f in self._stored.fields])
            )
        return held

    def _latest(self) -> DataFrame:
        rest = [n for n in self._stored.fieldNames() if n != self.key]
        return self._rows().groupBy(self.key).agg(
            F.max_by(F.struct(*rest), "_seq").alias("_row")
        ).select(*[F.col(n) if n == self.key else F.col(f"_row.{n}") for n in self._stored.fieldNames()])

    def current(self, key: str | None = None) -> DataFrame:
        if key not in (None, self.key):
            raise ValueError(f"the key of {self.path} is {self.key}")
        return self._latest().select(*self.schema.fieldNames())


def _bronze_measures() -> dict[str, Column]:
    """What the commit list tells of a day; ``size`` is that of its filter."""
    return {
        "rows": F.count("*"),
        "duplicates": F.count_if(F.col("is_duplicate")),
        "newest": F.max("transaction_date"),
        "size": size_for(F.count("*")),
    }


@dataclass(frozen=True)
class Store:
    """All tables of one warehouse folder."""

    spark: SparkSession
    root: str

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/commits")

    def _daily(self, name: str, schema: StructType, **options: Any) -> DailyTable:
        return DailyTable(self.spark, name, self.root, schema, self.log, **options)

    def _log_table(self, name: str, schema: StructType, key: str) -> LogTable:
        return LogTable(self.spark, f"{self.root}/{name}", schema, key)

    @property
    def bronze(self) -> DailyTable:
        return self._daily("bronze", schemas.BRONZE, measures=_bronze_measures(), key="transaction_id")

    @property
    def quarantine(self) -> DailyTable:
        return self._daily("quarantine", schemas.QUARANTINE)

    @property
    def summary(self) -> DailyTable:
        return self._daily("summary", schemas.SUMMARY)

    @property
    def watermark(self) -> LogTable:
        return self._log_table("watermark", schemas.WATERMARK, "source_name")

    @property
    def runs(self) -> LogTable:
        return self._log_table("runs", schemas.RUNS, "run_id")

    @property
    def deliveries(self) -> LogTable:
        return self._log_table("deliveries", schemas.DELIVERIES, "delivery")

    def publish(self, pending: Sequence[Pending], after: int) -> int:
        """Make all pending days current at once, if no other writer has since ``after``."""
        lines = [line for p in pending for line in p.lines()]
        return self.log.put(after, lines) if lines else after

    def remove_replaced(self, older_than: float = 86_400) -> int:
        """Delete what later runs replaced, in all tables kept by day."""
        tables = (self.bronze, self.quarantine, self.summary)
        return sum(table.remove_replaced(older_than) for table in tables)

    def reset(self) -> None:
        """Delete every table of the store."""
        for table in (self.bronze, self.quarantine, self.summary):
            remove_folder(self.spark, table.path)
            remove_folder(self.spark, table.filter_path)
        for log in (self.log, self.watermark, self.runs, self.deliveries):
            remove_folder(self.spark, log.path)

    @contextmanager
    def staged(self, rows: DataFrame, *partition_by: str) -> Iterator[DataFrame]:
        """``rows`` written as a table for the time of the block."""
        path = f"{self.root}/staging/{uuid.uuid4().hex}"
        try:
            rows.write.partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            remove_folder(self.spark, path)
