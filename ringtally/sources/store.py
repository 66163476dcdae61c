"""Stored tables: Parquet folders below one root, partitioned by day.

Every write replaces exactly the partitions it produces, so a load that is repeated - a
retried micro-batch, a rerun of a day - leaves the same table as the first time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date as Date
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtally.operators.conform import conform
from ringtally.schema import TABLES

NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for a partition without a value


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _files(self, path: str):
        """Hadoop's file system and path objects: any storage Spark can write to."""
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    @staticmethod
    def _day_column(table: str) -> str:
        for name, (kind, _) in TABLES[table].partitions.items():
            if kind == "date":
                return name
        raise ValueError(f"{table} is not stored by day")

    def create(self) -> "Store":
        for table in TABLES:
            fs, where = self._files(self.path(table))
            fs.mkdirs(where)
        return self

    def read(self, table: str) -> DataFrame:
        """The whole table. Filters on its day column prune folders."""
        return self._visible(table, self.spark.read.schema(TABLES[table].schema).parquet(self.path(table)))

    def read_days(self, table: str, first: Date, last: Date) -> DataFrame:
        """Only the folders of these days are listed and read, however long the history."""
        return self.read_parts(table, _days(first, last))

    def read_parts(self, table: str, days: list[Date | None]) -> DataFrame:
        """Only the folders of these days; None is the folder of rows without a day."""
        day = self._day_column(table)
        present = [
            f"{self.path(table)}/{day}={d or NO_DAY}" for d in days if self.has_day(table, d)
        ]
        if not present:
            return self.spark.createDataFrame([], TABLES[table].schema)
        rows = (
            self.spark.read.schema(TABLES[table].schema)
            .option("basePath", self.path(table))
            .parquet(*present)
        )
        return self._visible(table, rows)

    def has_day(self, table: str, day: Date | None) -> bool:
        column = self._day_column(table)
        fs, where = self._files(f"{self.path(table)}/{column}={day or NO_DAY}")
        return fs.exists(where)

    def load(
        self,
        table: str,
        frame: DataFrame,
        load_id: str | None = None,
        layout: str | None = "rebalance",
        tasks: int | None = None,
    ) -> None:
        """Write ``frame``, replacing the partitions it has rows for.

        Tables with a ``load_id`` partition need one: the name of this piece of input, the
        same whenever it is tried again.

        ``layout``: ``rebalance`` lets AQE pack small partitions and split a large one into
        files of even size; ``repartition`` brings each partition into one of ``tasks`` tasks,
        for results with a bounded number of rows per partition (rollups of a day, windows):
        one file each, written side by side; None writes the tasks as they are.
        """
        spec = TABLES[table]
        if ("load_id" in spec.partitions) != (load_id is not None):
            raise ValueError(f"{table}: load_id is {'not ' if load_id else ''}expected")
        rows = conform(frame, table)
        if load_id is not None:
            rows = rows.withColumn("load_id", F.lit(load_id))
        rows = rows.withColumns({n: F.expr(sql).cast(t) for n, (t, sql) in spec.partitions.items()})
        if layout == "rebalance":
            rows = rows.hint("rebalance", *spec.partitions)
        elif layout == "repartition":
            rows = rows.repartition(*[n for n in [tasks] if n], *spec.partitions)
        _replace_partitions(rows, list(spec.partitions), self.path(table))

    def days(self, table: str) -> list[Date]:
        """Days that have a folder: one name per day, no data is read."""
        column = self._day_column(table)
        fs, where = self._files(self.path(table))
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        texts = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
        return sorted(Date.fromisoformat(t) for t in texts if not t.startswith("__"))

    def drop_days(self, table: str, days: list[Date]) -> list[Date]:
        """Remove whole day folders."""
        column = self._day_column(table)
        for day in days:
            fs, where = self._files(f"{self.path(table)}/{column}={day}")
            fs.delete(where, True)
        return days

    def compact(
        self,
        table: str,
        day: Date,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        by_subscriber: bool = False,
    ) -> bool:
        """Rewrite a closed day of many loads as one load of evenly sized files; returns whether
        there was something to do. ``merge`` combines the rows of several loads, for tables
        whose rows add up. ``by_subscriber`` sorts the day into ranges of ``msisdn``, with bloom
        filters on it and on ``event_id``, so that one subscriber or event is read from few row
        groups.

        Readers see the old loads or the new one, never both or none: a note of what is hidden
        appears by one rename, before the new files do, and another, of the old loads, takes its
        place once they are there. A compaction that was cut off is finished or undone by the
        next call. A read that began before may miss files that are deleted at the end. Run it
        when the streams are past the day: a load that is tried again later is added anew,
        except raw events, which are compared with what is stored."""
        spec = TABLES[table]
        if "load_id" not in spec.partitions:
            raise ValueError(f"{table} is not stored by load")
        self._finish_swap(table, day)
        column = self._day_column(table)
        if not self.has_day(table, day):
            return False
        rows = self.read_days(table, day, day)
        loads = [r.load_id for r in rows.select("load_id").distinct().collect()]
        if not loads or (len(loads) == 1 and loads[0].startswith("compacted")):
            return False
        name = "compacted" if "compacted" not in loads else f"compacted-{uuid.uuid4().hex[:8]}"
        inner = [n for n in spec.partitions if n != column]
        rows = (merge(rows) if merge else rows).withColumn("load_id", F.lit(name))
        rows = rows.select(*[n for n in [*spec.columns, "load_id"] if n != column])
        if by_subscriber:
            rows = rows.repartitionByRange("msisdn", "timestamp").sortWithinPartitions("msisdn", "timestamp")
        else:
            rows = rows.hint("rebalance")
        writer = rows.write.mode("overwrite").partitionBy(*inner)
        for indexed in ("msisdn", "event_id") if by_subscriber else ():
            writer = writer.option(f"parquet.bloom.filter.enabled#{indexed}", "true")
        fresh = f"{self.path(table)}/_fresh/{column}={day}"
        writer.parquet(fresh)
        self._note(table, day, "new", [name])
        for source in self._load_folders(fresh, {name}):
            fs, target = self._files(source.replace("/_fresh/", "/"))
            fs.mkdirs(target.getParent())
            if not fs.rename(self._files(source)[1], target):
                raise OSError(f"cannot rename {source} to {target}")
        self._note(table, day, "old", loads)
        self._finish_swap(table, day)
        return True

    # Notes of loads that a compaction hides: files named after day and kind, a load a line.

    def _note_path(self, table: str, name: str = "") -> str:
        return f"{self.path(table)}/_swaps/{name}"

    def _note(self, table: str, day: Date, kind: str, loads: list[str]) -> None:
        fs, draft = self._files(self._note_path(table, f"_{day}.{kind}"))
        out = fs.create(draft, True)
        out.write(bytearray("\n".join(loads).encode()))
        out.close()
        if not fs.rename(draft, self._files(self._note_path(table, f"{day}.{kind}"))[1]):
            raise OSError(f"cannot rename {draft}")

    def _notes(self, table: str) -> dict[str, list[str]]:
        """Hidden loads by day and kind."""
        fs, where = self._files(self._note_path(table))
        if not fs.exists(where):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        found = {}
        for name in names:
            if name.endswith((".new", ".old")) and not name.startswith("_"):
                lines = self.spark.read.text(self._note_path(table, name)).collect()
                found[name] = [r.value for r in lines]
        return found

    def _visible(self, table: str, rows: DataFrame) -> DataFrame:
        if "load_id" not in TABLES[table].partitions:
            return rows
        notes = self._notes(table)
        for day in {name[:-4] for name in notes}:
            loads = notes.get(f"{day}.old", notes.get(f"{day}.new"))
            at = F.col(self._day_column(table)).eqNullSafe(F.lit(day).cast("date"))
            rows = rows.filter(~(at & F.col("load_id").isin(loads)))
        return rows

    def _load_folders(self, folder: str, loads: set[str]) -> list[str]:
        """Folders of these loads below a day's folder."""
        fs, where = self._files(folder)
        if not fs.exists(where):
            return []
        found = []
        for status in fs.listStatus(where):
            name = status.getPath().getName()
            if name.startswith("load_id="):
                if unquote(name.split("=", 1)[1]) in loads:
                    found.append(f"{folder}/{name}")
            elif status.isDirectory():
                found += self._load_folders(f"{folder}/{name}", loads)
        return found

    def _finish_swap(self, table: str, day: Date) -> None:
        """Delete what the day's notes hide, then the notes."""
        notes = self._notes(table)
        hidden = notes.get(f"{day}.old", notes.get(f"{day}.new"))
        if hidden is None:
            return
        if f"{day}.old" in notes and f"{day}.new" in notes:  # the later note holds; the first goes
            self._delete(self._note_path(table, f"{day}.new"))
        for folder in self._load_folders(f"{self.path(table)}/{self._day_column(table)}={day}", set(hidden)):
            self._delete(folder)
        for kind in ("new", "old"):
            self._delete(self._note_path(table, f"{day}.{kind}"))

    def _delete(self, path: str) -> None:
        fs, where = self._files(path)
        fs.delete(where, True)

    def expire(self, table: str, as_of: Date, keep_days: int) -> list[Date]:
        """Drop the days before ``as_of`` minus ``keep_days``; returns them."""
        limit = as_of - timedelta(days=keep_days)
        self._expire_undated(table, limit)
        return self.drop_days(table, [d for d in self.days(table) if d < limit])

    def _expire_undated(self, table: str, limit: Date) -> None:
        """Rows below no day go with their load, once all of it was stored before ``limit``."""
        spec = TABLES[table]
        if not {"load_id", "created_at"} <= {*spec.partitions, *spec.columns} or not self.has_day(table, None):
            return
        rows = self.read_parts(table, [None])
        old = rows.groupBy("load_id").agg(F.max("created_at").alias("last")).filter(
            F.col("last") < F.lit(limit).cast("timestamp")
        )
        inner = [name for name in spec.partitions if name not in (self._day_column(table), "load_id")]
        folders = rows.join(old, "load_id", "left_semi").select(*inner, "load_id").distinct().collect()
        for r in folders:
            parts = "".join(f"/{name}={r[name]}" for name in (*inner, "load_id"))
            fs, where = self._files(f"{self.path(table)}/{self._day_column(table)}={NO_DAY}{parts}")
            fs.delete(where, True)


def _replace_partitions(rows: DataFrame, columns: list[str], path: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def _days(first: Date, last: Date) -> list[Date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]
