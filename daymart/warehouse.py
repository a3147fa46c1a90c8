"""A folder of day-partitioned tables with known schemas.

What a step writes becomes visible when the step is through, in all its tables at once (``daymart.sinks.commits``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.functions.dates import as_date
from daymart.schemas import table_schema
from daymart.sinks.commits import Commits, merged, with_inputs
from daymart.sinks.load import enforce


class MissingDay(LookupError):
    """Days of tables that were never written."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.commits = Commits(spark, root)
        self._open: dict | None = None
        self._seen: dict[tuple[str, str], str | None] = {}

    @contextmanager
    def step(self) -> Iterator[None]:
        """Publish what is written inside together at the end, and nothing of it if anything fails.

        Inside, the step reads what it wrote itself.  Steps within steps belong to the outer one.  The days that were read are
        recorded with those that were written, so that ``stale`` can tell when these have to be made again.
        """
        if self._open is not None:
            yield
            return
        self._open, self._seen = {}, {}
        try:
            yield
            self.commits.publish(with_inputs(self._open, self._seen))
        finally:
            self._open, self._seen = None, {}

    def _state(self) -> dict:
        return merged(self.commits.state(), self._open or {})

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, ds: dt.date | str | None = None, allow_absent: bool = False) -> DataFrame:
        """A table, or one day of it read from that day's folder only.

        A day that was written without rows is empty.  What was never written raises ``MissingDay``, unless
        ``allow_absent`` says that the history may begin here.  A report has the columns it was last written with.
        """
        schema, state = table_schema(name) if _known(name) else None, self._state()
        if self._open is not None:
            days = [as_date(ds).isoformat()] if ds is not None else self._days(state, name)
            self._seen |= {(name, day): self.commits.digest(state, name, day) for day in days}
        found = self.commits.read(state, name, ds, schema)
        if found is None:
            if not allow_absent:
                raise MissingDay(f"{name} {ds or ''}".strip())
            return self.spark.createDataFrame([], schema or T.StructType())
        return found

    def read_range(self, name: str, first: dt.date, last: dt.date) -> DataFrame:
        """The days of a range that were ever written, from their folders only; none is needed."""
        days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        parts = [self.read(name, day, allow_absent=True) for day in days if self.has(name, day)]
        if self._open is not None:
            self._seen |= {(name, d.isoformat()): None for d in days if (name, d.isoformat()) not in self._seen}
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], table_schema(name))

    def _days(self, state: dict, name: str) -> list[str]:
        recorded = state.get(name, {"days": {}})["days"]
        return [*recorded, *self.commits.plain_days(name, recorded)]

    def stale(self) -> dict[tuple[str, str], bool]:
        """(table, day) that a change reaches since it was written: true where an input itself is another now, false further on."""
        return self.commits.stale(self._state())

    def outdated(self, name: str, ds: dt.date | str) -> bool:
        """Whether the day was never written or one of its inputs is another now."""
        return not self.has(name, ds) or bool(self.commits.changed_inputs(self._state(), name, ds))

    def has(self, name: str, ds: dt.date | str) -> bool:
        """Whether the day was ever written, with rows or without."""
        day = as_date(ds).isoformat()
        return day in self._state().get(name, {"days": {}})["days"] or self.commits.holds_files(name, day)

    def rows_written(self, name: str, ds: dt.date | str) -> int:
        """The count taken when the day was written."""
        return self._state()[name]["days"][as_date(ds).isoformat()]["rows"]

    def require(self, *needed: tuple[str, dt.date | str]) -> None:
        """Stop with the list of all missing days before a step starts."""
        missing = [f"{name} {ds}" for name, ds in needed if not self.has(name, ds)]
        if missing:
            raise MissingDay(", ".join(missing))

    def write(self, name: str, rows: DataFrame, ds: dt.date | str) -> None:
        """Replace one day by typed rows; a row of another day or a missing required value
        fails the job, and the day stays as it was."""
        schema = table_schema(name)
        self._replace(name, enforce(rows, schema), schema, ds)

    def write_mart(self, name: str, rows: DataFrame, ds: dt.date | str) -> None:
        """Replace one day of a report, whose columns are those of its query; their types are those of the
        days before."""
        before = self.commits.read(self._state(), name, None)
        known = rows.schema if before is None else before.schema
        typed = {field.name: field.dataType for field in known.fields}
        cast = rows.select(*[F.col(c).cast(typed.get(c, rows.schema[c].dataType)) for c in rows.columns])
        self._replace(name, cast, cast.schema, ds)

    def write_routed(self, rows: DataFrame, tables: dict[str, list[str] | None], ds: dt.date | str, route: str = "route") -> None:
        """Replace one day of several tables by one job over ``rows``, whose column ``route`` names the table of each row.

        ``tables`` gives the columns of a table that has no fixed schema, such as rejects; with ``None`` its schema is enforced, as by
        ``write``, for its own rows.  Columns of one name share their type.  A row with another route fails the job, and all days stay as they were.
        """
        day = F.lit(as_date(ds))
        fields: dict[str, T.StructField] = {}
        schemas, required = {}, {}
        for name, columns in tables.items():
            if columns is None:
                own = table_schema(name)
            else:
                own = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in columns], T.StructField("p_date", T.DateType())])
            for field in own.fields:
                fields.setdefault(field.name, field)
                if not field.nullable:
                    required.setdefault(field.name, []).append(name)
            schemas[name] = T.StructType([T.StructField(f.name, fields[f.name].dataType, f.nullable) for f in own.fields])

        def typed(name: str):
            value = day if name == "p_date" else F.col(name)
            value = value.cast(fields[name].dataType)
            if name in required:
                failure = F.raise_error(F.lit(f"required field {name} is missing")).cast(fields[name].dataType)
                value = F.when(value.isNull() & F.col(route).isin(required[name]), failure).otherwise(value)
            return value.alias(name)

        target = F.when(F.col(route).isin(list(tables)), F.col(route)).otherwise(
            F.raise_error(F.concat(F.lit("no table for route "), F.coalesce(F.col(route), F.lit("NULL")))).cast("string")
        )
        ready = rows.select(*[typed(name) for name in fields], target.alias("_route"))
        self._keep(self.commits.write(ready, schemas, [ds], "_route"))

    def _replace(self, name: str, rows: DataFrame, schema: T.StructType, ds: dt.date | str) -> None:
        failure = F.raise_error(F.concat(F.lit(f"{name} {ds}: row of "), F.col("p_date").cast("string")))
        same_day = F.when(F.col("p_date").eqNullSafe(F.lit(as_date(ds))), F.lit(True))
        checked = rows.where(same_day.otherwise(failure.cast("boolean")))
        self._keep(self.commits.write(checked, {name: schema}, [ds]))

    def _keep(self, changes: dict) -> None:
        if self._open is None:
            self.commits.publish(changes)
        else:
            self._open = merged(self._open, changes)


def _known(name: str) -> bool:
    try:
        table_schema(name)
    except KeyError:
        return False
    return True
