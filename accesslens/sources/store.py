"""Tables that are written by commits: what a reader sees is decided by a log, never by a directory listing.

A commit's files go to directories of their own first. Then one log entry, a single Parquet file that appears at
once, names them for all tables that the commit touches: readers see all of a batch or nothing of it, in every table
of the set. A batch that is delivered again is recognised by its name. Compaction and retention write new files and
switch over by an entry too; files that nothing names any more are emptied by ``vacuum``.

One writer at a time per set. The log is metadata, one row per table and commit; it is what the driver reads.
"""

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from accesslens.functions import times

_ENTRY = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("batch", T.StringType()),
    T.StructField("relation", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("commit", T.StringType()), T.StructField("until", T.DateType()),
    T.StructField("covers", T.ArrayType(T.StringType())), T.StructField("layout", T.StringType()),
    T.StructField("by_day", T.BooleanType()), T.StructField("mark", T.TimestampNTZType()),
])
ADD, REPLACE, FOLD, DROP, NOTE = "add", "replace", "fold", "drop", "note"


@dataclass
class _State:
    """What the log says of one table: its commits, and from which day on each still counts."""

    layout: str = ""
    by_day: bool = False
    commits: dict[str, date | None] = field(default_factory=dict)
    retired: set[str] = field(default_factory=set)


class TableSet:
    """Tables below one path that change together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._pending: list[tuple] = []
        self._known: list | None = None
        self._working: list[tuple[str, T.StructType]] = []

    # --- The log --------------------------------------------------------------------------------

    def _log(self) -> list:
        """All entries in order. They are read once; ``refresh`` shows what another writer has added."""
        if self._known is None:
            try:
                rows = self.spark.read.schema(_ENTRY).parquet(f"{self.path}/log").collect()
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = []  # nothing has been committed yet
            self._known = sorted(rows, key=lambda r: r.version)
        return self._known

    def refresh(self) -> "TableSet":
        self._known = None
        return self

    def _states(self) -> dict[str, _State]:
        found: dict[str, _State] = {}
        for e in self._log():
            if e.kind == NOTE:
                continue
            s = found.setdefault(e.relation, _State())
            s.layout, s.by_day = e.layout, e.by_day
            if e.kind == REPLACE:
                s.retired |= set(s.commits)
                s.commits = {}
            if e.kind == FOLD:
                for c in e.covers:
                    if c in s.commits:
                        s.commits[c] = max(e.until, s.commits[c] or e.until)
            if e.kind == DROP:
                for c in e.covers:
                    s.commits.pop(c, None)
            if e.commit:
                s.commits[e.commit] = None
        return found

    def has(self, batch: object) -> bool:
        """Whether a batch of this name has been committed."""
        return any(e.batch == str(batch) for e in self._log())

    def mark(self) -> datetime | None:
        """The high-water mark that the last batch left."""
        marks = [e.mark for e in self._log() if e.mark is not None]
        return max(marks, default=None)

    # --- Writing --------------------------------------------------------------------------------

    def _written(self, rows: DataFrame, relation: str, day: str | None) -> str:
        name = uuid.uuid4().hex
        path = f"{self.path}/tables/{relation}/commit={name}"
        if day is None:
            rows.write.parquet(path)
        else:
            rows.withColumn("dt", F.to_date(day)).write.partitionBy("dt").parquet(path)
        return name

    def stage(self, rows: DataFrame, relation: str, day: str | None = None, replace: bool = False) -> None:
        """Write rows that the next ``commit`` adds to a table, or that replace all it has. ``day`` is the time
        column whose date the table is laid out by."""
        name = self._written(rows, relation, day)
        self._pending.append((relation, REPLACE if replace else ADD, name, None, None, rows.schema.json(), day is not None))

    def commit(self, batch: object, mark: datetime | None = None) -> None:
        """Make everything staged visible at once, under the batch's name."""
        pending, self._pending = self._pending, []
        self._publish(str(batch), pending or [(None, NOTE, None, None, None, None, None)], mark)

    def _publish(self, batch: str | None, entries: Iterable[tuple], mark: datetime | None = None) -> None:
        version = 1 + max((e.version for e in self._log()), default=0)
        rows = self.spark.createDataFrame([(version, batch, *e, mark) for e in entries], _ENTRY)
        # One file, so that it appears as a whole.
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        self._known = [*self._log(), *rows.collect()]

    def discard(self) -> None:
        """Forget what was staged and not committed; no reader has seen it."""
        self._pending = []

    def worked_out(self, rows: DataFrame) -> DataFrame:
        """The rows, stored as working data and read again; ``tidy`` empties it."""
        path = f"{self.path}/work/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        self._working.append((path, rows.schema))
        return self.spark.read.schema(rows.schema).parquet(path)

    def tidy(self) -> None:
        """Empty the working data, once nothing reads it any more."""
        for path, schema in self._working:
            self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        self._working.clear()

    # --- Reading --------------------------------------------------------------------------------

    def read(self, relation: str, schema: T.StructType | None = None) -> DataFrame:
        """The table as of now, with its day ``dt`` if it is laid out by day: filters on it prune directories.
        ``schema`` serves a table that has no rows yet."""
        state = self._states().get(relation)
        if state is None or not state.commits:
            if state is None and schema is None:
                raise ValueError(f"there is no table {relation}")
            # limit(0) lets the optimizer drop what is joined or united with it.
            return self.spark.createDataFrame([], schema or T.StructType.fromJson(json.loads(state.layout))).limit(0)
        return self._read(relation, state)

    def _read(self, relation: str, state: _State) -> DataFrame:
        fields = list(T.StructType.fromJson(json.loads(state.layout)).fields)
        fields += [T.StructField("commit", T.StringType())]
        fields += [T.StructField("dt", T.DateType())] if state.by_day else []
        base = f"{self.path}/tables/{relation}"
        rows = self.spark.read.schema(T.StructType(fields)).option("basePath", base).parquet(
            *[f"{base}/commit={c}" for c in state.commits])
        for since in sorted({s for s in state.commits.values() if s is not None}):
            covered = [c for c, s in state.commits.items() if s == since]
            rows = rows.filter(~F.col("commit").isin(covered) | (F.col("dt") >= F.lit(since)) | F.col("dt").isNull())
        return rows.drop("commit")

    # --- Folding --------------------------------------------------------------------------------

    def compact(self, relation: str, until: date, fold: Callable[[DataFrame], DataFrame], day: str) -> None:
        """Replace the rows of the days before ``until``, of all commits, by one folded commit. Readers see either
        state; later days, and batches that arrive meanwhile, aren't touched."""
        self._switch(relation, until, lambda rows: fold(rows.filter(F.col("dt") < F.lit(until)).drop("dt")), day)

    def retain(self, relation: str, since: datetime, day: str) -> None:
        """Drop rows older than ``since``: whole days leave with the entry, the border day is written anew without its
        older rows."""
        border = lambda rows: rows.filter(
            (F.col("dt") == F.lit(since.date())) & (F.col(day) >= times.ntz(since))).drop("dt")
        self._switch(relation, date.fromordinal(since.toordinal() + 1), border, day)

    def _switch(self, relation: str, until: date, made: Callable[[DataFrame], DataFrame], day: str) -> None:
        state = self._states().get(relation)
        if state is None or not state.commits:
            return
        if not state.by_day:
            raise ValueError(f"{relation} isn't laid out by day")
        name = self._written(made(self._read(relation, state)), relation, day)
        self._publish(None, [(relation, FOLD, name, until, sorted(state.commits), state.layout, True)])

    def vacuum(self, relation: str) -> int:
        """Empty the directories of commits that no longer count at all; returns how many. Not while an older state is
        still being read."""
        state = self._states().get(relation, _State())
        only = lambda c: _State(state.layout, state.by_day, {c: state.commits[c]})
        over = [c for c, since in state.commits.items() if since is not None and self._read(relation, only(c)).isEmpty()]
        if over:
            self._publish(None, [(relation, DROP, None, None, over, state.layout, state.by_day)])
        nothing = [*sorted(state.retired), *over]
        for commit in nothing:
            empty = self.spark.createDataFrame([], T.StructType.fromJson(json.loads(state.layout)))
            empty.write.mode("overwrite").parquet(f"{self.path}/tables/{relation}/commit={commit}")
        return len(nothing)
