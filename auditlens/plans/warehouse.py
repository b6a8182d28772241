"""Output tables as Parquet under one root: full writes, day partitions, upserts, guarded reads."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.settings import Settings

# A table that is upserted is a snapshot and the versions after it, each in a folder of its number.
_SNAPSHOT = "snapshot="
_VERSION = "version"
_DELTA = f"{_VERSION}="
# A table by day has a folder for each run that wrote some of its days.
_RUN = "written_by_run="
# Marks the key of such a table in its schema.
_KEY = {"upsert_key": True}


def upsert_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows whose key is not among the new rows, and all new rows. NULL equals NULL."""
    incoming = new.select(*(F.col(k).alias(f"new_{k}") for k in keys)).distinct()
    same_key = reduce(
        lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"new_{k}")) for k in keys)
    )
    return existing.join(incoming, same_key, "left_anti").unionByName(new)


class Warehouse:
    """Tables of one build."""

    def __init__(self, spark: SparkSession, root: str, settings: Settings) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # Writes

    def write_full(self, name: str, df: DataFrame, cluster_by: Sequence[str] = ()) -> DataFrame:
        """Replace the whole table."""
        self._keep_schema(name, df)
        _clustered(df, cluster_by).write.mode("overwrite").parquet(self.path(name))
        return self.read(name)

    def write_days(
        self,
        name: str,
        df: DataFrame,
        day: str,
        cluster_by: Sequence[str] | None = (),
        days: Sequence[dt.date] | None = None,
    ) -> DataFrame:
        """Write a table partitioned by day: all of it, or only the partitions of `days`.

        With `days`, rows of other days are not written and other partitions are kept; a partition
        of `days` without new rows is emptied. All days change at once: rows go to a folder of this
        run, and then one file is put in place that says where each day is. Until then readers find
        the former days, also where a run fails; who has read before is not disturbed while
        `Settings.kept_snapshots` hold. A table is written by one run at a time.

        Rows are spread by ranges of day and cluster columns, so one large day is written by many
        tasks and each file covers a narrow range. Where `cluster_by` is None they are only brought
        together by day, and a large day is split by size: ranges have to be sampled first, which
        would do the work above twice.
        """
        rows = df if days is None else df.filter(F.col(day).isin(*days))
        if cluster_by is None:
            rows = rows.hint("rebalance", F.col(day))
        else:
            rows = _clustered(rows, [day, *cluster_by])
        number = max((*self._numbers(name, _RUN, ended=False), *self._states(name)), default=-1) + 1
        written = self._numbered(name, _RUN, number)
        rows.write.partitionBy(day).parquet(written)
        kept = {}
        if days is not None and self._states(name):
            replaced = {f"{day}={d}" for d in days}
            kept = {d: n for d, n in self._state(name)["days"].items() if d not in replaced}
        found = {d: number for d in self._names(written) if d.startswith(f"{day}=")}
        self._keep_state(name, number, {"schema": df.schema.json(), "days": kept | found})
        self._expire_states(name)
        return self.read(name)

    # A table by day is the state of the highest number: a file that says which run wrote each of its
    # days, and what columns there are. It is there from one rename on.

    def _states_path(self, name: str) -> str:
        return f"{self.path(name)}/_states"

    def _states(self, name: str) -> list[int]:
        """Numbers of the states of a table by day, oldest first."""
        return sorted(int(n) for n in self._names(self._states_path(name)) if n.isdigit())

    def _state(self, name: str, number: int | None = None) -> dict:
        """A state of a table, or else the one of the highest number."""
        number = self._states(name)[-1] if number is None else number
        file, files = self._folder(f"{self._states_path(name)}/{number:08d}")
        opened = files.open(file)
        try:
            return json.loads(bytes(opened.readAllBytes()).decode())
        finally:
            opened.close()

    def _keep_state(self, name: str, number: int, state: dict) -> None:
        """Put a state in place. Of two runs that write a table at once, the later one fails."""
        file, files = self._folder(f"{self._states_path(name)}/{number:08d}")
        unfinished = file.suffix(f".{uuid.uuid4().hex}")
        created = files.create(unfinished, False)
        try:
            created.write(bytearray(json.dumps(state).encode()))
        finally:
            created.close()
        if files.exists(file) or not files.rename(unfinished, file):
            raise RuntimeError(f"{name} was written by another run meanwhile")

    def _read_days(self, name: str) -> DataFrame:
        state = self._state(name)
        schema = T.StructType.fromJson(json.loads(state["schema"]))
        paths = [f"{self._numbered(name, _RUN, n)}/{d}" for d, n in sorted(state["days"].items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", self.path(name))
        return read.parquet(*paths).select(*schema.names)

    def _expire_states(self, name: str) -> None:
        """Drop states beyond those kept, and the days that no state left needs."""
        states = self._states(name)
        left = states[-self.settings.kept_snapshots :]
        needed = {(n, d) for state in left for d, n in self._state(name, state)["days"].items()}
        gone = [f"{self._states_path(name)}/{n:08d}" for n in states if n not in left]
        for n in self._numbers(name, _RUN, ended=False):
            path = self._numbered(name, _RUN, n)
            unused = [d for d in self._names(path) if "=" in d and (n, d) not in needed]
            whole = not any(run == n for run, _ in needed)
            gone += [path] if whole else [f"{path}/{d}" for d in unused]
        for path in gone:
            folder, files = self._folder(path)
            files.delete(folder, True)

    def _names(self, path: str) -> list[str]:
        """Names of what a folder holds; none if there is no such folder."""
        folder, files = self._folder(path)
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder)]

    def _folder(self, path: str):
        """A path and its file system."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())

    def upsert(
        self, name: str, new: DataFrame, keys: Sequence[str], cluster_by: Sequence[str] = ()
    ) -> DataFrame:
        """Put rows into a table: those of the same keys give way to them.

        Only the new rows are written, as the next version; readers find the newest version of a
        key. After `Settings.versions_per_snapshot` of them all rows are written as a snapshot. Those
        who read before are not disturbed, and a run that fails leaves the last version in place.
        """
        snapshot = self._latest_snapshot(name)
        if snapshot is None:
            return self.replace(name, new, cluster_by, keys)
        self._keep_schema(name, new, keys)
        number = self._next_number(name)
        _clustered(new, cluster_by).write.mode("overwrite").parquet(self._numbered(name, _DELTA, number))
        if len(self._versions(name)) >= self.settings.versions_per_snapshot:
            self.replace(name, self.read(name), cluster_by, keys)
        return self.read(name)

    def replace(
        self, name: str, df: DataFrame, cluster_by: Sequence[str] = (), keys: Sequence[str] = ()
    ) -> DataFrame:
        """Write all rows of a table that is upserted as its next snapshot."""
        path = self._numbered(name, _SNAPSHOT, self._next_number(name))
        self._keep_schema(name, df, keys)
        _clustered(df, cluster_by).write.mode("overwrite").parquet(path)
        self._expire_snapshots(name)
        return self.read(name)

    # Reads

    def read(self, name: str) -> DataFrame:
        """A table as it is now; of one that is upserted, the newest version of each key."""
        if self._states(name):
            return self._read_days(name)
        snapshot = self._latest_snapshot(name)
        path = self.path(name) if snapshot is None else self._numbered(name, _SNAPSHOT, snapshot)
        schema = self.spark.read.parquet(self._schema_path(name)).schema
        keys = [field.name for field in schema if field.metadata == _KEY]
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        rows = self.spark.read.schema(plain).parquet(path)
        versions = self._versions(name)
        if not versions:
            return rows
        paths = [self._numbered(name, _DELTA, number) for number in versions]
        numbered = T.StructType([*plain, T.StructField(_VERSION, T.LongType())])
        put = self.spark.read.schema(numbered).option("basePath", self.path(name)).parquet(*paths)
        newest = F.max(_VERSION).over(Window.partitionBy(*keys))
        put = put.withColumn("newest", newest).filter(F.col("newest") == F.col(_VERSION))
        return upsert_by_key(rows, put.select(*plain.names), keys)

    # Schemas are kept beside the tables: a table without rows may have no file to tell its own.

    def _schema_path(self, name: str) -> str:
        return f"{self.root}/_schemas/{name}"

    def _keep_schema(self, name: str, df: DataFrame, keys: Sequence[str] = ()) -> None:
        fields = [
            T.StructField(f.name, f.dataType, metadata=_KEY if f.name in keys else None)
            for f in df.schema
        ]
        none = self.spark.createDataFrame([], T.StructType(fields))
        none.write.mode("overwrite").parquet(self._schema_path(name))

    def read_report(
        self,
        name: str,
        start: dt.date | None = None,
        end: dt.date | None = None,
        day: str = "report_date",
    ) -> DataFrame:
        """Rows of a report from `start` to `end`. Both are required if the settings say so."""
        if self.settings.require_partition_filter and (start is None or end is None):
            raise ValueError(f"{name} is read by day: give a first and a last day")
        df = self.read(name)
        if start is not None:
            df = df.filter(F.col(day) >= F.lit(start))
        if end is not None:
            df = df.filter(F.col(day) <= F.lit(end))
        return df

    # Snapshots and the versions after them

    def _numbered(self, name: str, kind: str, number: int) -> str:
        return f"{self.path(name)}/{kind}{number:08d}"

    def _numbers(self, name: str, kind: str, ended: bool = True) -> list[int]:
        """Numbers of the folders of a kind, oldest first; of those written to their end, or all."""
        path = self.path(name)
        return sorted(
            int(folder.removeprefix(kind))
            for folder in self._names(path)
            if folder.startswith(kind) and (not ended or "_SUCCESS" in self._names(f"{path}/{folder}"))
        )

    def _latest_snapshot(self, name: str) -> int | None:
        return max(self._numbers(name, _SNAPSHOT), default=None)

    def _versions(self, name: str) -> list[int]:
        """Versions after the latest snapshot, oldest first."""
        snapshot = self._latest_snapshot(name)
        return [] if snapshot is None else [n for n in self._numbers(name, _DELTA) if n > snapshot]

    def _next_number(self, name: str) -> int:
        return max((*self._numbers(name, _SNAPSHOT), *self._numbers(name, _DELTA)), default=-1) + 1

    def _expire_snapshots(self, name: str) -> None:
        """Drop snapshots beyond those kept, and versions that only those need."""
        snapshots = self._numbers(name, _SNAPSHOT)
        kept = snapshots[-self.settings.kept_snapshots :]
        gone = [self._numbered(name, _SNAPSHOT, n) for n in snapshots if n not in kept]
        gone += [self._numbered(name, _DELTA, n) for n in self._numbers(name, _DELTA) if n < kept[0]]
        for path in gone:
            folder, files = self._folder(path)
            files.delete(folder, True)


def _clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    if not columns:
        return df
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
