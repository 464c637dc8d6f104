"""Path-based layer tables (raw / staging / intermediate / marts).

Tables are Parquet directories under one root (any Hadoop URI), named
``<layer>.<table>`` and stored at ``<root>/<layer>/<table>``: the layer name
is used verbatim as the namespace. Nothing depends on a metastore;
``register`` exposes the tables as qualified names in the session catalog when
one is wanted.

A table's ``_commit`` record (small, one table each) says what of it counts:

* Snapshot tables are partitioned by ``ingestion_date`` and, below it, by the
  publish that wrote the rows. A publish is staged first, then named in the record
  with its dates as pending, then its date folders are moved into place in ascending
  order, then it's done. One that stops half-way is finished by the next
  (``recover``); until then readers see the table as it was. The record
  also holds the table's watermark.
* Dimensions have two version folders; the record names the one that counts.
* The raw layer is partitioned by ``ingestion_date`` and load. A load replaces
  its own folders when it is retried; readers that name a date leave out loads
  that are not complete.

There is one writer a table at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.schemas import PARTITION_COLUMN

LOAD_COLUMN = "load_id"
PUBLISH_COLUMN = "publish_id"
CODEC = "zstd"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date("ingestion_time"))


def clustered(df: DataFrame, column: str = PARTITION_COLUMN) -> DataFrame:
    """Group rows of one partition value into few tasks before a partitioned
    write (few files per directory instead of one per task and value). The
    ``rebalance`` hint lets AQE split an oversized value across several tasks
    and merge small ones, so a date holding a third of all rows is still
    written in parallel."""
    return df.hint("rebalance", column)


@dataclass
class Staged:
    """Rows written beside a table, by date, that no reader sees yet."""

    path: str
    rows: int
    newest: dt.datetime | None                 # their latest ingestion time
    dates: list[str] = field(default_factory=list)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # One listed DataFrame per table until this Warehouse writes it again:
        # listing a date-partitioned table walks every partition directory.
        self._reads: dict[str, DataFrame] = {}
        self.folders_listed = 0                # date folders that ``read_since`` opened
        self._jvm = jvm = spark.sparkContext._jvm
        self._path_class, self._text_of = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._path_class(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, table: str) -> str:
        layer, name = table.split(".", 1)
        return f"{self.root}/{layer}/{name}"

    # -- the store -------------------------------------------------------------

    def _at(self, path: str):
        return self._path_class(path), self._fs

    def _children(self, path: str) -> list[str]:
        """Names in a folder as its store lists them, in one answer; none if it isn't there."""
        at, fs = self._at(path)
        if not fs.exists(at):
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(at))
        text = self._jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\n")
        return [p.rsplit("/", 1)[1] for p in text.split("\n")] if text else []

    def _delete(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

    def _move(self, source: str, target: str) -> None:
        """A folder to a place of its own, whose parent is there."""
        a, b = self._path_class(source), self._path_class(target)
        if not self._fs.rename(a, b):
            self._fs.delete(b, True)           # what a store without atomic moves left of a stopped one
            if not self._fs.rename(a, b):
                raise OSError(f"{source} could not be moved to {target}")

    def _move_dates(self, staged: str, base: str, own: str) -> None:
        """Staged date folders into the table, in ascending order, one move each:
        a new date as a whole, else its folder ``own``. Done again after a stop, it ends the same."""
        there = set(self._children(base))
        self._fs.mkdirs(self._path_class(base))
        for folder in sorted(n for n in self._children(staged) if n.startswith(f"{PARTITION_COLUMN}=")):
            if folder not in there:
                self._move(f"{staged}/{folder}", f"{base}/{folder}")
            elif self._fs.exists(self._path_class(f"{staged}/{folder}/{own}")):
                self._delete(f"{base}/{folder}/{own}")                     # of an earlier try
                self._move(f"{staged}/{folder}/{own}", f"{base}/{folder}/{own}")

    def _record(self, base: str) -> dict | None:
        """The newer whole one of a record's two files."""
        found = []
        for name in (f"{base}.0", f"{base}.1"):
            at, fs = self._at(name)
            if fs.exists(at):
                stream = fs.open(at)
                text = self._text_of(stream, "UTF-8")
                stream.close()
                try:
                    found.append(json.loads(text))
                except ValueError:             # a write that stopped half-way; the other file counts
                    pass
        return max(found, key=lambda r: r["serial"], default=None)

    def _write_record(self, base: str, record: dict) -> dict:
        """Over the older of the two files, so that a stop leaves the newer one whole."""
        old = self._record(base)
        record = record | {"serial": old["serial"] + 1 if old else 0}
        at, fs = self._at(f"{base}.{record['serial'] % 2}")
        out = fs.create(at, True)
        out.write(json.dumps(record).encode())
        out.close()
        return record

    def record(self, table: str) -> dict | None:
        """What the table's last write committed or began."""
        return self._record(f"{self.path(table)}/_commit")

    # -- reads -----------------------------------------------------------------

    def exists(self, table: str) -> bool:
        """Whether something was committed to the table; any other trouble with its store raises."""
        record = self.record(table)
        if record is not None:
            return "version" in record or record["publish"] > (0 if record["state"] == "pending" else -1)
        return any(not name.startswith(("_", ".")) for name in self._children(self.path(table)))

    def _dates(self, table: str) -> list[str]:
        prefix = f"{PARTITION_COLUMN}="
        return sorted(n[len(prefix):] for n in self._children(self.path(table)) if n.startswith(prefix))

    def newest_date(self, table: str) -> dt.date | None:
        """The newest partition of a table by its folders' names; no file is opened."""
        return max((dt.date.fromisoformat(d) for d in self._dates(table) if d != NO_DATE), default=None)

    def watermark(self, table: str) -> dt.datetime | None:
        """The latest ingestion time that was committed; no folder is listed."""
        record = self.record(table) or {}
        text = record.get("before") if record.get("state") == "pending" else record.get("watermark")
        return dt.datetime.fromisoformat(text) if text else None

    def _committed(self, table: str, df: DataFrame) -> DataFrame:
        """Without what a publish has only begun, and what a finished one replaced."""
        record = self.record(table)
        if record is not None and PUBLISH_COLUMN in df.columns:
            if record["state"] == "pending":
                df = df.where(F.col(PUBLISH_COLUMN) < record["publish"])
            elif record.get("replaces"):
                df = df.where(~(F.col(PARTITION_COLUMN).isin([dt.date.fromisoformat(d) for d in record["replaces"]])
                                & (F.col(PUBLISH_COLUMN) < record["publish"])))
        return df

    def read(self, table: str) -> DataFrame:
        """Whole table with its partition columns (``ingestion_date``, and
        ``load_id`` for the raw layer)."""
        if table not in self._reads:
            record = self.record(table) or {}
            path = self.path(table) + (f"/{record['version']}" if "version" in record else "")
            self._reads[table] = self._committed(table, self.spark.read.parquet(path))
        return self._reads[table]

    def read_since(self, table: str, since: dt.date) -> DataFrame:
        """The table's folders from a date on, chosen by their names: what is
        opened grows with these dates, not with the table. Without any, the newest folder."""
        dates = [d for d in self._dates(table) if d != NO_DATE]
        wanted = [d for d in dates if d >= since.isoformat()] or dates[-1:]
        base = self.path(table)
        self.folders_listed += len(wanted)
        df = self.spark.read.option("basePath", base).parquet(*(f"{base}/{PARTITION_COLUMN}={d}" for d in wanted))
        open_loads = self._children(f"{base}/_open")
        if open_loads and LOAD_COLUMN in df.columns:
            df = df.where(~F.col(LOAD_COLUMN).cast("string").isin(open_loads))
        return self._committed(table, df)

    def read_dates(self, table: str, dates: Iterable[str]) -> DataFrame | None:
        """Only these dates of the table (folder names, ``NO_DATE`` for rows without a time); None if it has none of them."""
        base = self.path(table)
        there = sorted(set(dates) & set(self._dates(table)))
        if not there:
            return None
        self.folders_listed += len(there)
        df = self.spark.read.option("basePath", base).parquet(*(f"{base}/{PARTITION_COLUMN}={d}" for d in there))
        return self._committed(table, df.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("date")))

    def read_staged(self, staged: Staged, date: str | None = None) -> DataFrame:
        df = self.spark.read.option("basePath", staged.path)
        return df.parquet(staged.path if date is None else f"{staged.path}/{PARTITION_COLUMN}={date}")

    def _written(self, table: str) -> None:
        self._reads.pop(table, None)

    def read_model(self, table: str, columns: list[str]) -> DataFrame:
        return self.read(table).select(*columns)

    # -- writes of snapshot tables -----------------------------------------------

    def stage(self, table: str, df: DataFrame, load_id: str | int | None = None, dated: bool = False) -> Staged:
        """Writes rows beside the table, once, in the folders that they will have there; counts them on the way.
        ``dated`` rows come straight from date folders, so their tasks hold few dates each and nothing is shuffled."""
        if load_id is None:
            own = {PUBLISH_COLUMN: F.lit((self.record(table) or {"publish": -1})["publish"] + 1)}
        else:
            own = {LOAD_COLUMN: F.lit(str(load_id))}
        path = f"{self.root}/_staged/{table}/{uuid.uuid4().hex}"
        seen = Observation(f"stage-{uuid.uuid4().hex}")
        df = with_partition(df).withColumns(own).observe(seen, F.count(F.lit(1)).alias("rows"), F.max("ingestion_time").alias("newest"))
        (df if dated else clustered(df)).write.option("compression", CODEC).partitionBy(PARTITION_COLUMN, *own).parquet(path)
        dates = self._staged_dates(path)
        # of a result that adaptive execution found empty, nothing is observed
        return Staged(path, seen.get["rows"], seen.get["newest"], dates) if dates else Staged(path, 0, None)

    def _staged_dates(self, path: str) -> list[str]:
        prefix = f"{PARTITION_COLUMN}="
        return sorted(n[len(prefix):] for n in self._children(path) if n.startswith(prefix))

    def restage(self, staged: Staged, date: str, df: DataFrame) -> Staged:
        """The staged rows of one date replaced by others of that date (which may be read from them)."""
        other, place = f"{staged.path}-{date}", f"{PARTITION_COLUMN}={date}"
        (own,) = self._children(f"{staged.path}/{place}")
        clustered(df).withColumn(PUBLISH_COLUMN, F.lit(own.split("=")[1])).write.option("compression", CODEC).partitionBy(PARTITION_COLUMN, PUBLISH_COLUMN).parquet(other)
        self._delete(f"{staged.path}/{place}")
        if self._children(f"{other}/{place}"):
            self._move(f"{other}/{place}", f"{staged.path}/{place}")
        self._delete(other)
        return Staged(staged.path, staged.rows, staged.newest, self._staged_dates(staged.path))

    def discard(self, staged: Staged) -> None:
        self._delete(staged.path)

    def publish(self, table: str, staged: Staged, replaces: Iterable[str] = ()) -> int:
        """Adds staged rows to the table; those dates in ``replaces`` lose what
        they held before. Returns the publish's number."""
        old = self.record(table)
        before = self.watermark(table)
        newest = max((t for t in (before, staged.newest) if t is not None), default=None)
        iso = lambda t: t.isoformat() if t is not None else None
        self._write_record(f"{self.path(table)}/_commit", {
            "state": "pending", "publish": old["publish"] + 1 if old else 0, "staged": staged.path, "dates": staged.dates,
            "replaces": sorted(replaces), "replaced": sorted(replaces), "before": iso(before), "watermark": iso(newest)})
        return self.recover(table)

    def recover(self, table: str) -> int | None:
        """Finishes a publish that was begun; without one, nothing happens. Returns the last publish's number."""
        record = self.record(table)
        if record is None or "version" in record:
            return None
        base, n = self.path(table), record["publish"]
        if record["state"] == "pending":
            self._move_dates(record["staged"], base, f"{PUBLISH_COLUMN}={n}")
            record = self._write_record(f"{base}/_commit", record | {"state": "done"})
            self._written(table)
        if record["replaces"]:
            for date in record["replaces"]:
                for name in self._children(f"{base}/{PARTITION_COLUMN}={date}"):
                    if name.startswith(f"{PUBLISH_COLUMN}=") and int(name.split("=")[1]) < n:
                        self._delete(f"{base}/{PARTITION_COLUMN}={date}/{name}")
            self._write_record(f"{base}/_commit", record | {"replaces": []})
            self._written(table)
        if record["staged"]:
            self._delete(record["staged"])
        return n

    # -- the raw layer -------------------------------------------------------------

    def write_load(self, table: str, df: DataFrame, load_id: str | int) -> int:
        """Raw append keyed by load: each load owns ``load_id=<id>`` below its
        dates, so a retried load (same id) replaces itself, dates that it no
        longer has included, instead of appending twice. Returns its number of rows."""
        base, name = self.path(table), f"{LOAD_COLUMN}={load_id}"
        staged = self.stage(table, df, load_id)
        entry = f"{base}/_loads/{load_id}"
        old = set((self._record(entry) or {}).get("dates", []))
        at, fs = self._at(f"{base}/_open/{load_id}")
        fs.create(at, True).close()
        self._write_record(entry, {"dates": sorted(old | set(staged.dates))})
        self._move_dates(staged.path, base, name)
        for date in sorted(old - set(staged.dates)):
            self._delete(f"{base}/{PARTITION_COLUMN}={date}/{name}")
            if not self._children(f"{base}/{PARTITION_COLUMN}={date}"):
                self._delete(f"{base}/{PARTITION_COLUMN}={date}")
        self._write_record(entry, {"dates": staged.dates})
        fs.delete(at, False)
        self.discard(staged)
        self._written(table)
        return staged.rows

    # -- dimensions ------------------------------------------------------------------

    def overwrite(self, table: str, df: DataFrame, **state) -> None:
        """Full refresh of an unpartitioned table: the version that doesn't
        count is written, then the record names it. Readers see the old rows
        until then, also after a stop. ``state`` is kept in the record."""
        record = self.record(table) or {}
        version = "v1" if record.get("version") == "v0" else "v0"
        df.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path(table)}/{version}")
        self._write_record(f"{self.path(table)}/_commit", {"version": version, **state})
        self._written(table)

    def mark(self, table: str, **state) -> None:
        """Changes what an unpartitioned table's record keeps beside its version."""
        self._write_record(f"{self.path(table)}/_commit", self.record(table) | state)

    def load_dates(self, table: str, load_id: str | int) -> set[str]:
        """The dates that a load of the raw layer wrote; none before it did."""
        return set((self._record(f"{self.path(table)}/_loads/{load_id}") or {}).get("dates", ()))

    # -- catalog ---------------------------------------------------------------------

    def register(self, table: str) -> None:
        """Expose as ``layer.table`` in the session catalog, or bring the
        catalog in step: a snapshot table gets the partitions of the publishes
        since, a dimension its present version's place. Nothing is walked but the
        dates of those publishes."""
        layer, _ = table.split(".", 1)
        record = self.record(table) or {}
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")
        known, props = self.spark.catalog.tableExists(table), {}
        if known:
            props = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
            if props.get("shelfwise.path") != self.path(table):            # another warehouse's
                self.spark.sql(f"DROP TABLE {table}")
                known, props = False, {}
        if "version" in record:
            place = f"{self.path(table)}/{record['version']}"
            if known:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
                self.spark.catalog.refreshTable(table)
            else:
                self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{place}' TBLPROPERTIES ('shelfwise.path' = '{self.path(table)}')")
            return
        now, seen = record.get("publish", -1), None
        if known:
            seen = int(props["shelfwise.publish"]) if "shelfwise.publish" in props else None
        else:
            self.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{self.path(table)}'")
        if seen is not None and seen == now - 1:
            for date in record["replaced"]:
                for name in [r.partition for r in self.spark.sql(f"SHOW PARTITIONS {table} PARTITION ({PARTITION_COLUMN}='{date}')").collect()]:
                    if int(name.rsplit("=", 1)[1]) < now:
                        self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PARTITION_COLUMN}='{date}', {PUBLISH_COLUMN}={name.rsplit('=', 1)[1]})")
            parts = " ".join(f"PARTITION ({PARTITION_COLUMN}='{d}', {PUBLISH_COLUMN}={now})" for d in record["dates"])
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
        elif seen is None or seen != now or now < 0:
            self.spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('shelfwise.publish' = '{now}', 'shelfwise.path' = '{self.path(table)}')")
        self.spark.catalog.refreshTable(table)
