"""A log that runs append to: id ranges reserved under concurrency, a manifest, compaction.

Three kinds of markers in ``_commits`` say what the log is:

* ``r-<n>`` reserves: run ``n`` has an id range and the runs it had seen. The next number is taken by
  exclusive creation, so of two runs that read the same end one starts anew behind the other. Ranges
  are dense in the order of the numbers. A run that is repeated finds its own reservation.
* ``d-<n>`` commits: the folder of run ``n``, its rows, schema and first and last time. Rows without
  it are never read, so a half-written attempt leaves nothing behind.
* ``c-<n>`` compacts: the rows of all runs up to ``n`` by day, one folder each with its times.

A reader takes the newest compaction and the commits after it, leaves out what doesn't overlap the
times that it asks for before any folder is listed, and knows all schemas from the manifest, so no
file footers are merged. Files that lie in the log's own folder (a seed, or a log from
before) are read as well, and ids start behind theirs.

A run id is used by one process at a time; two processes with different ids may run at once.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.sources import markers

COMMITS, RUNS, DATA = "_commits", "_runs", "_data"
RUN = "_run"
DAY = "_day"


class RunConflict(RuntimeError):
    """A run was repeated with another number of rows than it reserved."""


@dataclass(frozen=True)
class Reservation:
    """Run ``number`` of the log: ids from ``first`` on, and the runs whose rows it has seen."""

    number: int
    run: str
    first: int
    rows: int
    base: int | None
    seen: tuple[int, ...]


@dataclass(frozen=True)
class Piece:
    """A folder of rows: of one run (``number``), or of one day of compacted runs."""

    folder: str
    schema: str
    rows: int
    low: int | None
    high: int | None
    number: int | None = None
    day: str | None = None

    def overlaps(self, since: int | None, until: int | None) -> bool:
        if since is None and until is None:
            return True
        if self.low is None:
            return False
        return (since is None or self.high >= since) and (until is None or self.low <= until)


class RunLog:
    """The log in a folder."""

    def __init__(
        self, spark: SparkSession, path: str, id_column: str = "audit_id", time_column: str = "action_time"
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.id_column, self.time_column = id_column, time_column

    # Manifest -----------------------------------------------------------------------------------

    def _numbers(self, kind: str) -> list[int]:
        found = markers.names(self.spark, f"{self.path}/{COMMITS}") or []
        return sorted(int(n[2:]) for n in found if n.startswith(f"{kind}-"))

    def _marker(self, kind: str, number: int) -> str:
        return f"{self.path}/{COMMITS}/{kind}-{number:012d}"

    def _load(self, kind: str, number: int) -> dict | None:
        text = markers.read(self.spark, self._marker(kind, number))
        return None if text is None else json.loads(text)

    def committed(self, after: int = -1) -> list[int]:
        """Numbers of the committed runs behind ``after``."""
        return [n for n in self._numbers("d") if n > after]

    def pieces(self, since: int | None = None, until: int | None = None) -> list[Piece]:
        """What a read of these times (microseconds, both included) has to read."""
        compacted = self._numbers("c")
        out, upto = [], -1
        if compacted:
            upto = compacted[-1]
            out = [Piece(**p) for p in self._load("c", upto)["pieces"]]
        out += [Piece(**self._load("d", n), number=n) for n in self.committed(upto)]
        return [p for p in out if p.overlaps(since, until)]

    # Reading ------------------------------------------------------------------------------------

    def read(
        self, since: datetime | str | None = None, until: datetime | str | None = None
    ) -> DataFrame | None:
        """The rows, of these times if given; None if there is no log."""
        low, high = (None if t is None else micros(self.spark, t) for t in (since, until))
        managed = self._read(self.pieces(low, high))
        if managed is None and (self._numbers("d") or self._numbers("c")):
            managed = self.spark.createDataFrame([], merged([p.schema for p in self.pieces()]))
        parts = [d for d in (self.plain(), managed) if d is not None]
        if not parts:
            return None
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        time = F.col(self.time_column)
        if since is not None:
            out = out.filter(time >= F.lit(since).cast("timestamp"))
        return out if until is None else out.filter(time <= F.lit(until).cast("timestamp"))

    def read_runs(self, numbers: list[int]) -> DataFrame | None:
        """The rows of these committed runs."""
        return self._read([Piece(**self._load("d", n), number=n) for n in numbers])

    def plain(self) -> DataFrame | None:
        """Rows that lie in the log's own folder: a seed, or a log from before."""
        names = [n for n in markers.names(self.spark, self.path) or [] if not n.startswith(("_", "."))]
        if not names:
            return None
        files = [f"{self.path}/{n}" for n in names]
        return self.spark.read.option("mergeSchema", "true").parquet(*files)

    def _read(self, pieces: list[Piece]) -> DataFrame | None:
        if not pieces:
            return None
        schema = merged([p.schema for p in pieces])
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p.folder}" for p in pieces])

    # Appending ----------------------------------------------------------------------------------

    def reservation(self, run: str) -> Reservation | None:
        """What the run reserved earlier, None for a new run. Enters the run's name in the log."""
        name = hashlib.sha256(run.encode()).hexdigest()
        if markers.publish(self.spark, f"{self.path}/{RUNS}/{name}", run):
            return None
        for n in reversed(self._numbers("r")):
            found = self._load("r", n)
            if found["run"] == run:
                return self._reserved(n, found)
        return None

    @staticmethod
    def _reserved(number: int, found: dict) -> Reservation:
        return Reservation(number, **{**found, "seen": tuple(found["seen"])})

    def reserve(
        self, run: str, rows: int, base: int | None = None, seen: tuple[int, ...] = ()
    ) -> Reservation:
        """The next ``rows`` ids. ``base`` and ``seen`` note what the rows were derived from."""
        while True:
            numbers = self._numbers("r")
            if numbers:
                last = self._load("r", numbers[-1])
                number, first = numbers[-1] + 1, last["first"] + last["rows"]
            else:
                number, first = 0, self._highest_plain() + 1
            entry = {"run": run, "first": first, "rows": rows, "base": base, "seen": list(seen)}
            if markers.publish(self.spark, self._marker("r", number), json.dumps(entry)):
                return self._reserved(number, entry)

    def _highest_plain(self) -> int:
        plain = self.plain()
        if plain is None:
            return 0
        return plain.agg(F.coalesce(F.max(self.id_column), F.lit(0))).first()[0]

    def commit(self, own: Reservation, rows: DataFrame) -> None:
        """Write the run's rows and let them count. Does nothing if they count already."""
        if markers.read(self.spark, self._marker("d", own.number)) is not None:
            return
        folder = f"{DATA}/{own.number:012d}-{uuid.uuid4().hex}"
        rows.withColumn(RUN, F.lit(own.run)).write.parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}")
        n, low, high = written.agg(F.count("*"), *self._span()).first()
        if n != own.rows:
            raise RunConflict(f"run {own.run!r} reserved {own.rows} ids and has {n} rows")
        schema = T.StructType([*rows.schema.fields, T.StructField(RUN, T.StringType())]).json()
        entry = {"folder": folder, "schema": schema, "rows": n, "low": low, "high": high}
        markers.publish(self.spark, self._marker("d", own.number), json.dumps(entry))

    def _span(self) -> list:
        at = F.unix_micros(F.col(self.time_column).cast("timestamp"))
        return [F.min(at).alias("low"), F.max(at).alias("high")]

    # Compaction ---------------------------------------------------------------------------------

    def compact(self) -> int | None:
        """Merge the committed runs before the first unfinished one into one folder per day.

        Days that no new run touches keep their folder. Returns the last run that is compacted, None if
        there was nothing to do. Folders that are no longer referred to stay for readers that are
        under way; :meth:`obsolete` names them.
        """
        compacted = self._numbers("c")
        upto = compacted[-1] if compacted else -1
        done, new = set(self.committed(upto)), []
        while upto + len(new) + 1 in done:
            new.append(upto + len(new) + 1)
        if not new:
            return None
        old = [Piece(**p) for p in self._load("c", upto)["pieces"]] if compacted else []
        fresh = self.read_runs(new)
        day = F.coalesce(F.to_date(self.time_column).cast("string"), F.lit("none"))
        days = {r[0] for r in fresh.select(day).distinct().collect()}  # bounded by the calendar
        touched = [p for p in old if p.day in days]
        rows = fresh
        if touched:
            rows = rows.unionByName(self._read(touched), allowMissingColumns=True)
        folder = f"{DATA}/c-{new[-1]:012d}-{uuid.uuid4().hex}"
        by_day = rows.withColumn(DAY, day)
        by_day.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(by_day.schema).parquet(f"{self.path}/{folder}")
        spans = written.groupBy(DAY).agg(F.count("*").alias("rows"), *self._span()).collect()
        pieces = [p for p in old if p.day not in days]
        pieces += [
            Piece(f"{folder}/{DAY}={r[DAY]}", rows.schema.json(), r["rows"], r["low"], r["high"], None, r[DAY])
            for r in spans
        ]
        entry = {"pieces": [vars(p) for p in pieces]}
        markers.publish(self.spark, self._marker("c", new[-1]), json.dumps(entry))
        return new[-1]

    def obsolete(self) -> list[str]:
        """Data folders that no marker needs any more, or not yet."""
        used = {p.folder.split("/")[1] for p in self.pieces()}
        found = markers.names(self.spark, f"{self.path}/{DATA}") or []
        return [f"{DATA}/{n}" for n in found if n not in used]


def merged(schemas: list[str]) -> T.StructType:
    """All columns by name, in the order in which they appeared; a column has one type."""
    fields: dict[str, T.StructField] = {}
    for text in dict.fromkeys(schemas):
        for f in T.StructType.fromJson(json.loads(text)).fields:
            known = fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
            if known.dataType != f.dataType:
                raise TypeError(f"column {f.name} is {known.dataType} in one run and {f.dataType} in another")
    return T.StructType(list(fields.values()))


def micros(spark: SparkSession, at: datetime | str) -> int:
    """An instant as microseconds, read as Spark reads a literal of it."""
    return spark.sql("SELECT 1").select(F.unix_micros(F.lit(at).cast("timestamp"))).first()[0]
