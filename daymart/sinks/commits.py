"""Committed versions of day partitions.

Rows are written by one Spark job to a folder of their own and moved to ``<table>/p_date=<day>/v=<version>``, where nothing reads them
yet.  One small record then names the version of every day that changes, in all tables of a step, and becomes visible by one rename: readers
see all of it or nothing.  A day without rows is an entry without a version, so emptying a day needs no job.  A write that fails leaves files
that no record names.

Days that no record names are read as they lie if they hold files of their own: tables written without versions stay readable, and
such a day gets a version when it is replaced.

Records are numbered; two writers that publish at once get different numbers, and of two versions of one day the later number
holds.  Every ``WHOLE_EVERY``-th record holds the whole state, so a reader opens a few records however many there are.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import as_date

WHOLE_EVERY = 32
NO_ROWS = "0:0"

#: {table: {"schema": JSON of the type, "days": {day: {"v": version or None, "rows": count, "digest": text, "inputs": {"table day": digest}}}}}
Changes = dict[str, dict]


def _digest_part(schema: T.StructType) -> Column:
    """A number for a row, the same in any order of columns; NULLs count by place, which hashing alone leaves out."""
    names = sorted(schema.names)
    return F.xxhash64(F.lit(",".join(names)), *[F.col(f"`{n}`") for n in names], *[F.col(f"`{n}`").isNull() for n in names])


def day_digest(entry: dict) -> str:
    """What stands for the rows of a recorded day, in whatever order they were written."""
    return entry.get("digest") or (NO_ROWS if entry["v"] is None else entry["v"])


def with_inputs(changes: Changes, read: dict[tuple[str, str], str | None]) -> Changes:
    """Record with every written day what was read for it: (table, day) -> digest, ``None`` for a day that was not there."""
    result = merged({}, changes)
    for name, entry in result.items():
        for day, written in entry["days"].items():
            inputs = {f"{t} {d}": digest for (t, d), digest in read.items() if (t, d) != (name, day)}
            entry["days"][day] = {**written, "inputs": inputs} if inputs else written
    return result


def merged(state: Changes, changes: Changes) -> Changes:
    result = {name: {**entry, "days": dict(entry["days"])} for name, entry in state.items()}
    for name, entry in changes.items():
        known = result.setdefault(name, {"schema": None, "days": {}})
        known["schema"] = entry["schema"] or known["schema"]
        known["days"].update(entry["days"])
    return result


class Commits:
    """The records of one folder of tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._read_to, self._state = 0, {}

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder, files = self._path(f"{self.root}/_commits"), self._files()
        if not files.exists(folder):
            return []
        names = (entry.getPath().getName() for entry in files.listStatus(folder))
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith("."))

    def _record(self, number: int) -> dict:
        stream = self._files().open(self._path(f"{self.root}/_commits/{number:010d}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def state(self) -> Changes:
        """What is published now."""
        unread = [n for n in self._numbers() if n > self._read_to]
        whole = [n for n in unread if n % WHOLE_EVERY == 0]
        if whole:
            unread = [n for n in unread if n >= whole[-1]]
            self._state = {}
        for number in unread:
            self._state = merged(self._state, self._record(number)["tables"])
            self._read_to = number
        return self._state

    def publish(self, changes: Changes) -> int:
        """Make the changes visible, all at once; the number of their record."""
        if not changes:
            return self._read_to
        files = self._files()
        while True:
            state = self.state()
            number = self._read_to + 1
            tables = merged(state, changes) if number % WHOLE_EVERY == 0 else changes
            draft = self._path(f"{self.root}/_commits/.{uuid.uuid4().hex}")
            stream = files.create(draft)
            try:
                stream.write(json.dumps({"tables": tables}).encode())
            finally:
                stream.close()
            if self._renamed(draft, self._path(f"{self.root}/_commits/{number:010d}.json")):
                return number
            files.delete(draft, False)

    def _renamed(self, source, target) -> bool:
        """Rename that fails where the target is there, because another writer was first."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri() if source.toUri().getScheme() else self._files().getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(source, target, none)
        except Exception as failure:
            if "FileAlreadyExistsException" in str(failure):
                return False
            raise
        return True

    def folder(self, table: str, day: str, version: str) -> str:
        return f"{self.root}/{table}/p_date={day}/v={version}"

    def write(self, rows: DataFrame, schemas: dict[str, T.StructType], days: list[dt.date | str], route: str | None = None) -> Changes:
        """Write ``rows`` in one job and return what is to be published; every day of every table is replaced.

        With ``route`` that column names the table of a row, else there is one table.  Counts and digests are taken while the rows are written.
        """
        days = sorted({as_date(d).isoformat() for d in days})
        version = f"w{uuid.uuid4().hex}"
        named = rows.withColumn("table", F.lit(next(iter(schemas))) if route is None else F.col(route))
        named = named if route is None else named.drop(route)
        parts = [F.when(F.col("table") == name, _digest_part(schema)) for name, schema in schemas.items()]
        named = named.withColumn("_part", F.coalesce(*parts).cast("decimal(28,0)"))
        counts, seen = {}, {}
        for t, name in enumerate(schemas):
            for d, day in enumerate(days):
                seen[f"n{t}_{d}"] = (name, day)
                own = (F.col("table") == name) & (F.col("p_date") == F.lit(as_date(day)))
                counts[f"n{t}_{d}"] = F.count_if(own)
                counts[f"s{t}_{d}"] = F.sum(F.when(own, F.col("_part")))
        watched = Observation(version)
        staging = f"{self.root}/_staging/{version}"
        (
            named.observe(watched, *[column.alias(label) for label, column in counts.items()])
            .drop("_part")
            .hint("rebalance", "table", "p_date")
            .write.partitionBy("table", "p_date")
            .parquet(staging)
        )
        files = self._files()
        changes = {name: {"schema": schema.json(), "days": {}} for name, schema in schemas.items()}
        written = {label: self._path(f"{staging}/table={name}/p_date={day}") for label, (name, day) in seen.items()}
        written = {label: source for label, source in written.items() if files.exists(source)}
        found = watched.get if written else {}  # a plan that is empty before it runs observes nothing
        for label, (name, day) in seen.items():
            source = written.get(label)
            there = source is not None
            if there:
                target = self._path(self.folder(name, day, version))
                files.mkdirs(target.getParent())
                if not files.rename(source, target):
                    raise OSError(f"{name} {day}: the version could not be moved to {target}")
            entry = {"v": version if there else None, "rows": found.get(label) or 0}
            changes[name]["days"][day] = {**entry, "digest": f"{entry['rows']}:{found[f's{label[1:]}']}"} if there else entry
        files.delete(self._path(staging), True)
        return changes

    def plain_days(self, table: str, named: dict) -> list[str]:
        """Days that no record names and that hold files of their own."""
        files, folder = self._files(), self._path(f"{self.root}/{table}")
        if not files.exists(folder):
            return []
        days = [entry.getPath().getName().removeprefix("p_date=") for entry in files.listStatus(folder) if entry.isDirectory()]
        return [day for day in sorted(days) if day[:1].isdigit() and day not in named and self.holds_files(table, day)]

    def holds_files(self, table: str, day: str) -> bool:
        files, folder = self._files(), self._path(f"{self.root}/{table}/p_date={day}")
        return files.exists(folder) and any(entry.isFile() for entry in files.listStatus(folder))

    def read(self, state: Changes, table: str, day: dt.date | str | None, schema: T.StructType | None = None) -> DataFrame | None:
        """A table, or one day of it, as ``state`` has it; ``None`` where it isn't there."""
        entry = state.get(table) or {"schema": None, "days": {}}
        if day is None:
            days, plain = entry["days"], self.plain_days(table, entry["days"])
        else:
            day = as_date(day).isoformat()
            days = {day: entry["days"][day]} if day in entry["days"] else {}
            plain = [day] if not days and self.holds_files(table, day) else []
        if not days and not plain:
            return None
        base = f"{self.root}/{table}"
        versions = [self.folder(table, d, found["v"]) for d, found in sorted(days.items()) if found["v"]]
        reader = self.spark.read.option("basePath", base)
        if schema is None and entry["schema"]:
            schema = T.StructType.fromJson(json.loads(entry["schema"]))
        elif schema is None:
            schema = reader.parquet(*[f"{base}/p_date={d}/*.parquet" for d in plain]).schema
        parts = [[f"{base}/p_date={d}/*.parquet" for d in plain], versions]
        frames = [reader.schema(schema).parquet(*paths).select(*schema.names) for paths in parts if paths]
        if not frames:
            return self.spark.createDataFrame([], schema)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def digest(self, state: Changes, table: str, day: dt.date | str) -> str | None:
        """The digest of a day; for a day without a record the names of its files; ``None`` for a day that is not there."""
        day = as_date(day).isoformat()
        entry = state.get(table, {"days": {}})["days"].get(day)
        if entry is not None:
            return day_digest(entry)
        if not self.holds_files(table, day):
            return None
        found = self._files().listStatus(self._path(f"{self.root}/{table}/p_date={day}"))
        names = sorted(f"{f.getPath().getName()} {f.getLen()}" for f in found if f.isFile())
        return f"files {uuid.uuid5(uuid.NAMESPACE_OID, '/'.join(names)).hex}"

    def changed_inputs(self, state: Changes, table: str, day: dt.date | str) -> list[str]:
        """What a day was made from and is another now; none for a day that has no record or was made from nothing."""
        entry = state.get(table, {"days": {}})["days"].get(as_date(day).isoformat()) or {}
        return sorted(name for name, digest in entry.get("inputs", {}).items() if self.digest(state, *name.rsplit(" ", 1)) != digest)

    def stale(self, state: Changes) -> dict[tuple[str, str], bool]:
        """Days that a change reaches: true where an input of theirs is another now, false where only something behind an input is.

        Works on the records alone, so it grows with the number of days and not with their rows.
        """
        days = [(table, day) for table, entry in state.items() for day in entry["days"]]
        users: dict[str, list[tuple[str, str]]] = {}
        for table, day in days:
            for name in state[table]["days"][day].get("inputs", {}):
                users.setdefault(name, []).append((table, day))
        found = {key: True for key in days if self.changed_inputs(state, *key)}
        reached = list(found)
        while reached:
            for key in users.get(" ".join(reached.pop()), []):
                if key not in found:
                    found[key] = False
                    reached.append(key)
        return found
