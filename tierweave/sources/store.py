"""Parquet tables of the layers, and their stage – check – publish protocol.

A table is a row of snapshots. A write goes to a folder of its own, beside the data that readers see. Publishing adds one small
list of the folders that make up the table from then on, under the next number. So a row is written once as a
staged batch and once as part of its table, nothing is copied, and a reader has either the old snapshot or the new one. A run
that dies leaves a folder no snapshot names; ``vacuum`` removes such folders, and those that only old snapshots name.

There is one writer per table: of two that start from the same snapshot the second one to publish fails.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tierweave.sources.layout import (
    NULL_PARTITION,
    TableSpec,
    any_of,
    distinct_partitions,
    lay_out,
    partition_columns,
    partition_fields,
    partition_folder,
    partition_sources,
    with_partition_columns,
)

WRITE = "_write"
#: Columns of a logged table's files beside the declared ones; see ``TableSpec.log``.
CHANGED, BEFORE = "_changed", "_before"
#: Snapshots that stay readable, and whose changes can be asked for.
KEPT_SNAPSHOTS = 20


class PublishConflict(RuntimeError):
    """Another writer has published the snapshot that this one was about to."""


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one that ``spark.checkpoint.dir`` names. In local mode, where it may be unset, one beside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors reach")
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tierweave"


def pin_utc(spark: SparkSession) -> None:
    """Days, windows and weekdays are those of UTC, in whatever zone the session was started."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@dataclass(frozen=True)
class Part:
    """The files of one partition that one write made.

    ``days`` holds first day, last day and number of NULLs per indexed time column, ``states`` the values of the aggregates that the
    write was asked to keep.
    """

    partition: str
    folder: str
    rows: int
    changed: int = 0
    days: Mapping[str, tuple[str | None, str | None, int]] = field(default_factory=dict)
    states: Mapping[str, float | None] = field(default_factory=dict)

    def may_hold(self, column: str, days: Sequence[str | None]) -> bool:
        """Whether rows of these sorted days (None first, for NULL) can be in here."""
        if column not in self.days:
            return True
        first, last, nulls = self.days[column]
        if days and days[0] is None and nulls:
            return True
        return first is not None and any(d is not None and first <= d <= last for d in days)


@dataclass(frozen=True)
class Snapshot:
    """A published state: the parts of the table, the write that led to it, and the versions of other tables it was made from.

    ``whole`` says that the write's log holds everything in which this snapshot differs from the one before.
    """

    version: int
    parts: tuple[Part, ...] = ()
    write: str | None = None
    whole: bool = False
    made_from: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Written:
    """A finished write that no snapshot names yet; ``rows`` reads it."""

    name: str
    version: int
    parts: tuple[Part, ...]
    rows: DataFrame

    @property
    def changed(self) -> int:
        return sum(p.changed for p in self.parts)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, kept_snapshots: int = KEPT_SNAPSHOTS) -> None:
        pin_utc(spark)
        _list_in_few_tasks(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.kept_snapshots = max(1, kept_snapshots)
        # Newest snapshot read per table. Its files never change, so one listing of them serves all its readers.
        self._listed: dict[str, tuple[int, DataFrame]] = {}

    # --- locations -----------------------------------------------------------------------------------

    def path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    def staging(self, spec: TableSpec, part: str = "") -> str:
        return f"{self.root}/_staging/{spec.layer}_{spec.name}" + (f"/{part}" if part else "")

    def exists(self, path: str) -> bool:
        files, location = self._files(path)
        return files.exists(location)

    def remove(self, path: str) -> None:
        files, location = self._files(path)
        files.delete(location, True)

    def drop(self) -> None:
        """Remove the store with all its tables."""
        self.remove(self.root)

    def _files(self, path: str):
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark._jsc.hadoopConfiguration()), location

    def _names(self, path: str) -> list[str]:
        files, location = self._files(path)
        return sorted(s.getPath().getName() for s in files.listStatus(location)) if files.exists(location) else []

    # --- snapshots -----------------------------------------------------------------------------------

    def _snapshot_file(self, spec: TableSpec, version: int) -> str:
        return f"{self.path(spec)}/_snapshots/{version:08d}.json"

    def versions(self, spec: TableSpec) -> list[int]:
        names = self._names(f"{self.path(spec)}/_snapshots")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_")]

    def version(self, spec: TableSpec) -> int:
        """Number of the newest snapshot; 0 before the first publish."""
        return max(self.versions(spec), default=0)

    def snapshot(self, spec: TableSpec, version: int | None = None) -> Snapshot:
        version = self.version(spec) if version is None else version
        if not version:
            return Snapshot(0)
        files, location = self._files(self._snapshot_file(spec, version))
        stream = files.open(location)
        try:
            given = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        parts = tuple(Part(**{**p, "days": {c: tuple(d) for c, d in p["days"].items()}}) for p in given.pop("parts"))
        return Snapshot(parts=parts, **given)

    def _add_snapshot(self, spec: TableSpec, snapshot: Snapshot) -> None:
        """The list is written beside its place and renamed into it, so it is there as a whole or not at all."""
        target = self._snapshot_file(spec, snapshot.version)
        folder, name = target.rsplit("/", 1)
        draft = f"{folder}/_{name}.{uuid4().hex}"
        files, location = self._files(draft)
        stream = files.create(location, False)
        stream.write(bytearray(json.dumps(asdict(snapshot)), "utf-8"))
        stream.close()
        files, place = self._files(target)
        if files.exists(place) or not files.rename(location, place):
            files.delete(location, False)
            raise PublishConflict(f"{spec.layer}.{spec.name} already has snapshot {snapshot.version}")

    # --- reading -------------------------------------------------------------------------------------

    def read(self, spec: TableSpec, with_partitions: bool = False, version: int | None = None) -> DataFrame:
        """The table as of its newest (or the given) snapshot; an empty frame of its schema before the first publish."""
        path, version = self.path(spec), self.version(spec) if version is None else version
        if self._listed.get(path, (None,))[0] != version:
            self._listed[path] = (version, self.read_parts(spec, self.snapshot(spec, version).parts))
        df = self._listed[path][1]
        return df if with_partitions else df.select(*StructType.fromDDL(spec.ddl).fieldNames())

    def read_parts(self, spec: TableSpec, parts: Iterable[Part], logged: bool = False) -> DataFrame:
        """Rows of the given parts with their partition columns; only their folders are listed and read."""
        extra = _log_fields(spec) if logged else []
        stored = StructType([*StructType.fromDDL(spec.ddl).fields, *extra, *partition_fields(spec.layout)])
        folders = [f"{self.path(spec)}/{p.folder}" for p in parts]
        if not folders:
            # Known to be empty when a merge is planned, so a first load is joined with nothing.
            return self.spark.createDataFrame([], stored).where(F.lit(False))
        placed = StructType([*stored.fields, *StructType.fromDDL(f"{WRITE} STRING").fields])
        return self.spark.read.schema(placed).option("basePath", self.path(spec)).parquet(*folders).drop(WRITE)

    def changes(self, spec: TableSpec, since: int) -> DataFrame | None:
        """Rows added or changed after snapshot ``since``, as each write left them, with their logged columns before it in ``_before``.

        None if that cannot be told: a snapshot is no longer kept, or one of them replaced rows without a log.
        """
        now = self.version(spec)
        if not since or not set(range(since + 1, now + 1)) <= set(self.versions(spec)):
            return None
        parts: list[Part] = []
        for version in range(since + 1, now + 1):
            snapshot = self.snapshot(spec, version)
            if not snapshot.whole:
                return None
            parts += [p for p in snapshot.parts if p.changed and p.folder.split("/")[0] == f"{WRITE}={snapshot.write}"]
        return self.read_parts(spec, parts, logged=True).where(CHANGED).drop(CHANGED)

    def register(self, spec: TableSpec) -> str:
        """Make the newest snapshot readable by name, as ``layer.table``, in the session's catalog."""
        name = f"{spec.layer}.{spec.name}"
        parts = [WRITE, *partition_columns(spec.layout)]
        columns = ", ".join([spec.ddl, f"{WRITE} STRING", *[f"{f.name} {f.dataType.simpleString()}" for f in partition_fields(spec.layout)]])
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {spec.layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{self.path(spec)}'")
        places = [p.folder for p in self.snapshot(spec).parts]
        for i in range(0, len(places), 500):
            listed = " ".join(f"PARTITION ({_as_spec(p)}) LOCATION '{self.path(spec)}/{p}'" for p in places[i : i + 500])
            self.spark.sql(f"ALTER TABLE {name} ADD {listed}")
        self.spark.catalog.refreshTable(name)
        return name

    # --- writing -------------------------------------------------------------------------------------

    def append(self, spec: TableSpec, df: DataFrame) -> None:
        self.publish(spec, self.write(spec, df), replaced=())

    def replace(self, spec: TableSpec, df: DataFrame) -> None:
        self.publish(spec, self.write(spec, df), replaced=None)

    def replace_partitions(self, spec: TableSpec, df: DataFrame) -> None:
        """Only the partitions that occur in ``df`` are replaced."""
        written = self.write(spec, df)
        self.publish(spec, written, replaced={p.partition for p in written.parts})

    def truncate(self, spec: TableSpec) -> None:
        self.replace(spec, self.spark.createDataFrame([], StructType.fromDDL(spec.ddl)))

    def write(self, spec: TableSpec, df: DataFrame, states: Mapping[str, Column] | None = None) -> Written:
        """Write a frame into a folder of its own, in the table's layout; no reader sees it before ``publish``.

        A frame of a logged table may carry the log's columns. ``states`` are aggregates to keep for every written partition.
        """
        version = self.version(spec) + 1
        name = f"{version:08d}-{uuid4().hex[:8]}"
        fields = StructType.fromDDL(spec.ddl).fields + [f for f in _log_fields(spec) if f.name in df.columns]
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        lay_out(typed, spec.layout).write.partitionBy(*partition_columns(spec.layout)).parquet(f"{self.path(spec)}/{WRITE}={name}")
        rows = self.read_parts(spec, [Part("", f"{WRITE}={name}", 0)], logged=CHANGED in df.columns)
        return Written(name, version, self._parts(spec, name, rows, states or {}), rows.select(*StructType.fromDDL(spec.ddl).fieldNames()))

    def _parts(self, spec: TableSpec, name: str, whole: DataFrame, states: Mapping[str, Column]) -> tuple[Part, ...]:
        """One row per written partition, by one aggregate over the written files."""
        logged = CHANGED in whole.columns
        names = partition_columns(spec.layout)
        sums = [F.count(F.lit(1)).alias("rows"), (F.count_if(CHANGED) if logged else F.lit(0)).alias("changed")]
        for c in spec.indexed:
            day = F.to_date(c)
            sums.append(F.struct(F.min(day).alias("first"), F.max(day).alias("last"), F.count_if(F.col(c).isNull()).alias("nulls")).alias(f"days_{c}"))
        sums += [value.alias(f"state_{i}") for i, value in enumerate(states.values())]
        found = []
        for r in whole.groupBy(*names).agg(*sums).collect():
            partition = partition_folder(spec.layout, [r[n] for n in names])
            days = {c: (_iso(r[f"days_{c}"].first), _iso(r[f"days_{c}"].last), r[f"days_{c}"].nulls) for c in spec.indexed}
            found.append(Part(partition, f"{WRITE}={name}/{partition}".rstrip("/"), r.rows, r.changed, days, {state: r[f"state_{i}"] for i, state in enumerate(states)}))
        return tuple(sorted((p for p in found if p.rows), key=lambda p: p.partition))

    # --- publishing ----------------------------------------------------------------------------------

    def stage(self, spec: TableSpec, df: DataFrame, part: str) -> DataFrame:
        """Write a frame to the table's staging folder and return the stored copy."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.staging(spec, part))
        return self.spark.read.schema(df.schema).parquet(self.staging(spec, part))

    def discard(self, spec: TableSpec, written: Written | None = None) -> None:
        """Give up what was staged, and a write that was not published."""
        self.remove(self.staging(spec))
        if written is not None:
            self.remove(f"{self.path(spec)}/{WRITE}={written.name}")

    def publish(
        self,
        spec: TableSpec,
        written: Written | None,
        replaced: Iterable[str] | None,
        whole: bool = False,
        made_from: Mapping[str, int] | None = None,
    ) -> Snapshot:
        """Make a write part of the table, in place of the ``replaced`` partitions (None: of all there are).

        Partitions that are replaced and not written again are gone. Without a write only the versions it was made from move on.
        """
        before = self.snapshot(spec)
        if written is not None and written.version != before.version + 1:
            raise PublishConflict(f"{spec.layer}.{spec.name} has moved on from snapshot {written.version - 1}")
        gone = None if replaced is None else set(replaced)
        kept = [p for p in before.parts if gone is not None and p.partition not in gone]
        snapshot = Snapshot(
            before.version + 1,
            (*kept, *(written.parts if written else ())),
            written.name if written else None,
            whole or written is None,
            dict(before.made_from) if made_from is None else dict(made_from),
        )
        self._add_snapshot(spec, snapshot)
        if len(self.versions(spec)) > self.kept_snapshots:
            self.vacuum(spec)
        return snapshot

    def vacuum(self, spec: TableSpec) -> None:
        """Remove snapshots beyond the kept ones, and folders of finished or abandoned writes that no kept snapshot names."""
        versions = self.versions(spec)
        for version in versions[: -self.kept_snapshots]:
            self.remove(self._snapshot_file(spec, version))
        kept = versions[-self.kept_snapshots :]
        stored = [n for n in self._names(self.path(spec)) if n.startswith(f"{WRITE}=")]
        # A write under way belongs to a snapshot that is still to come.
        past = [n for n in stored if kept and int(n.removeprefix(f"{WRITE}=").split("-")[0]) <= kept[-1]]
        named = {p.folder.split("/")[0] for v in kept for p in self.snapshot(spec, v).parts}
        for name in set(past) - named:
            self.remove(f"{self.path(spec)}/{name}")

    # --- affected partitions -------------------------------------------------------------------------

    def affected_partitions(self, spec: TableSpec, batch: DataFrame) -> list[tuple]:
        """Partitions a merge must rewrite: those of the batch and those now holding its keys.

        The list reaches the driver; its length is bounded by the number of partitions. The stored side
        reads only key and partition columns, and not even those when the keys fix the partition.
        """
        found = distinct_partitions(with_partition_columns(batch, spec.layout), spec.layout)
        if not set(partition_sources(spec.layout)) <= set(spec.keys):
            names = partition_columns(spec.layout)
            keys = list(spec.keys)
            stored = self.read(spec, with_partitions=True).select(*keys, *names)
            holding = stored.join(batch.select(*keys).distinct(), keys, "left_semi")
            found += distinct_partitions(holding, spec.layout)
        return sorted(set(found), key=repr)

    def read_partitions(self, spec: TableSpec, affected: Iterable[Sequence]) -> DataFrame:
        """Stored rows of the given partitions; no other folder is listed."""
        return self.read_named(spec, folders_of(spec, affected))

    def read_named(self, spec: TableSpec, partitions: Iterable[str]) -> DataFrame:
        """``read_partitions`` by the names that snapshots have for partitions."""
        wanted, parts = set(partitions), self.snapshot(spec).parts
        within = [p for p in parts if p.partition in wanted]
        df = self.read(spec) if len(within) == len(parts) else self.read_parts(spec, within)
        return df.select(*StructType.fromDDL(spec.ddl).fieldNames())

    def within(self, spec: TableSpec, df: DataFrame, affected: Sequence[Sequence]) -> DataFrame:
        """Rows of a frame that belong to the given partitions."""
        placed = with_partition_columns(df, spec.layout)
        return placed.where(any_of(partition_columns(spec.layout), affected)).select(*df.columns)


def _list_in_few_tasks(spark: SparkSession) -> None:
    """Folders are listed by some tasks per core, not by one task each; a lower setting of the session stays."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    most = max(32, 4 * spark.sparkContext.defaultParallelism)
    if int(spark.conf.get(name)) > most:
        spark.conf.set(name, str(most))


def folders_of(spec: TableSpec, affected: Iterable[Sequence]) -> set[str]:
    """Names by which snapshots know partitions."""
    return {partition_folder(spec.layout, values) for values in affected}


def _log_fields(spec: TableSpec) -> list[StructField]:
    if not spec.log:
        return []
    declared = StructType.fromDDL(spec.ddl)
    before = ", ".join(f"{c}: {declared[c].dataType.simpleString()}" for c in spec.log)
    return StructType.fromDDL(f"{CHANGED} BOOLEAN, {BEFORE} STRUCT<{before}>").fields


def _iso(day: date | None) -> str | None:
    return None if day is None else day.isoformat()


def _as_spec(folder: str) -> str:
    pairs = (level.split("=", 1) for level in folder.split("/"))
    return ", ".join(f"{n} = null" if v == NULL_PARTITION else f"{n} = '{v}'" for n, v in pairs)
