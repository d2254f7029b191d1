"""Stored tables whose loads are staged in folders of their own and go live with one small pointer file."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.scalars import key_to_year
from ledgerline.operators.joins import require_unique
from ledgerline.operators.reshape import union_all
from ledgerline.sources.tables import coerce_types, conform
from ledgerline.spec import RunContext, TableSpec
from ledgerline.storage import checkpointed

LOADS, POINTERS = "loads", "_versions"
RUN_KEY = "run_key"


class ConcurrentLoad(RuntimeError):
    """Another load went live since this one read the table; nothing of this one is visible."""


@dataclass(frozen=True)
class Part:
    """One partition folder of one load: its rows and bytes are counted when the load is written."""

    load: str
    folder: str
    rows: int
    size: int
    run: int | None = None


@dataclass(frozen=True)
class Pointer:
    """What a version of a table consists of; runs: rows of every committed load that was given a run."""

    version: int
    schema: dict
    parts: tuple[Part, ...] = ()
    runs: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def of(cls, text: str) -> Pointer:
        raw = json.loads(text)
        return cls(raw["version"], raw["schema"], tuple(Part(**p) for p in raw["parts"]), raw["runs"])


class Folder:
    """Small files and listings below a path of any file system that Spark can write, from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._jvm = path.rstrip("/"), spark._jvm
        self._files = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._files.listStatus(at)) if self._files.exists(at) else []

    def folders(self, name: str) -> list[str]:
        found = [s.getPath().getName() for s in self._files.listStatus(self._at(name)) if s.isDirectory()]
        return sorted(n for n in found if not n.startswith(("_", ".")))

    def size(self, name: str) -> int:
        return self._files.getContentSummary(self._at(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file in full under another name, then rename it; False if the name is taken."""
        folder, _, last = name.rpartition("/")
        staged, final = self._at(f"{folder}/.{last}.{uuid.uuid4().hex}"), self._at(name)
        out = self._files.create(staged, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        done = not self._files.exists(final) and self._files.rename(staged, final)
        if not done:
            self._files.delete(staged, False)
        return done

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)


class StoredTable:
    """A Parquet table in `path`: each load writes a new folder below loads/, then a pointer file that lists the partition
    folders that are live. A load that is killed leaves the table as it was; readers keep the version that they began with;
    of two loads that began from one version the second fails with ConcurrentLoad.

    A reload replaces all parts, an append adds those of its run (repeating a run replaces them), a merge replaces the
    partitions that its rows touch. Rows are brought to the layout of the spec: its columns and types, partition folders, and
    files by range of the partition and cluster columns. The pointer also holds the rows and bytes of every part, counted
    from the footers of the new files, so that the status of a table needs no scan.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, path: str):
        self.spark, self.spec, self.path = spark, spec, path.rstrip("/")
        self.folder = Folder(spark, path)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names(POINTERS) if n.endswith(".json") and not n.startswith(".")]

    def pointer(self, version: int | None = None) -> Pointer | None:
        known = self.versions()
        if not known and version is None:
            return None
        if version is not None and version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return Pointer.of(self.folder.read(f"{POINTERS}/{known[-1] if version is None else version:09d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default. Filters on partition columns prune the folders."""
        live = self.pointer(version)
        if live is None:
            raise ValueError(f"{self.path} holds no table")
        return self._rows(live, live.parts)

    def _rows(self, live: Pointer, parts: Sequence[Part]) -> DataFrame:
        schema, loads = StructType.fromJson(live.schema), {}
        for part in parts:
            loads.setdefault(part.load, []).append(part.folder)
        if not loads:
            return self.spark.createDataFrame([], schema)
        frames = []
        for load, folders in loads.items():
            base = f"{self.path}/{LOADS}/{load}"
            paths = [f"{base}/{f}" if f else base for f in folders]
            frames.append(self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names))
        return union_all(frames)

    def status(self) -> tuple[int, int]:
        """(rows, bytes) of the live version, from the pointer alone."""
        live = self.pointer()
        return (sum(p.rows for p in live.parts), sum(p.size for p in live.parts)) if live else (0, 0)

    def committed(self, run: RunContext) -> int | None:
        """Rows of the run's load if it went live."""
        live = self.pointer()
        return live.runs.get(str(run.audit_key)) if live else None

    def overwrite(self, df: DataFrame, run: RunContext | None = None) -> int:
        """Replace all rows; the number written."""
        live = self.pointer()
        return self._load(live, self._to_spec(df), self.spec.partition_by, (), run)

    def append(self, df: DataFrame, run: RunContext) -> int:
        """Add the run's rows, marked by `run_key`; rows of an earlier load of the same run go. The number written."""
        live = self.pointer()
        rows = self._to_spec(df).withColumn(RUN_KEY, F.lit(run.audit_key).cast("bigint"))
        self._same_layout(live, rows, "append to", (RUN_KEY, *self.spec.partition_by))
        kept = tuple(p for p in live.parts if p.run != run.audit_key) if live else ()
        return self._load(live, rows, (RUN_KEY, *self.spec.partition_by), kept, run, of_run=True)

    def merge(self, staging: DataFrame, run: RunContext | None = None, preserve: Sequence[str] = ("_created_at",)) -> int:
        """Upsert by the keys of the spec: read and rewrite the partitions that the staging rows touch, keep the others as they
        are, those of null partition values among them. Staging rows without a partition value or with a null key are refused,
        since they match nothing and would be added again by every load. The number of staging rows."""
        from ledgerline.sources.sinks import merge_upsert

        live, spec = self.pointer(), self.spec
        staging = checkpointed(self._to_spec(staging))  # read for its partitions, its keys and the merge
        needed = [*spec.partition_by, *spec.keys]
        lacks = F.count_if(F.expr(" or ".join(f"`{c}` is null" for c in needed)))
        touched = staging.groupBy(*spec.partition_by).agg(F.count(F.lit(1)).alias("_n"), lacks.alias("_lacks")).collect()
        if any(r["_lacks"] for r in touched):
            raise ValueError(f"staging rows of {spec.name} lack a value of {', '.join(needed)}")
        total = sum(r["_n"] for r in touched)
        self._same_layout(live, staging, "merge into", spec.partition_by)
        if live is None or not live.parts:
            require_unique(staging, spec.keys, "staging")
            self._load(live, staging, spec.partition_by, (), run, total)
            return total
        target = self._rows(live, live.parts)
        if spec.partition_by:
            first = spec.partition_by[0]
            target = target.filter(F.col(first).isin(sorted({r[0] for r in touched})))
        merged = merge_upsert(target, staging, spec.keys, preserve)
        self._load(live, merged, spec.partition_by, live.parts if spec.partition_by else (), run, total)
        return total

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the pointers before the last `keep` versions and the loads that only they name. Loads that are being written
        are of later versions and stay. Readers of deleted versions fail."""
        known = self.versions()
        old, kept = known[:-keep], known[-keep:]
        if not old or keep < 1:
            return []
        named = {p.load for v in kept for p in self.pointer(v).parts}
        gone = [n for n in self.folder.folders(LOADS) if int(n.split("-")[0]) <= kept[-1] and n not in named]
        for v in old:
            self.folder.delete(f"{POINTERS}/{v:09d}.json")
        for name in gone:
            self.folder.delete(f"{LOADS}/{name}")
        return gone

    def _to_spec(self, df: DataFrame) -> DataFrame:
        rows = coerce_types(conform(df, self.spec), self.spec)
        for part in self.spec.partition_by:
            if part not in rows.columns:
                if part != "year":
                    raise ValueError(f"{self.spec.name} has no column {part}")
                rows = rows.withColumn("year", key_to_year("date_key").cast("int"))
        return rows

    def _same_layout(self, live: Pointer | None, rows: DataFrame, what: str, partition_by: Sequence[str]) -> None:
        if live is None or not live.parts:
            return
        stored = StructType.fromJson(live.schema)
        levels = live.parts[0].folder.count("/") + 1 if live.parts[0].folder else 0
        if [(f.name, f.dataType) for f in stored] != [(f.name, f.dataType) for f in rows.schema] or levels != len(partition_by):
            raise ValueError(f"cannot {what} {self.path}: its columns or partitions are others")

    def _load(
        self, live: Pointer | None, rows: DataFrame, partition_by: Sequence[str], kept: Sequence[Part],
        run: RunContext | None, total: int | None = None, of_run: bool = False,
    ) -> int:
        version = live.version + 1 if live else 1
        load = f"{version:09d}-{uuid.uuid4().hex[:12]}"
        by = [*partition_by, *self.spec.cluster_by]
        # The last part of the range spreads the rows of one partition folder or cluster value over tasks.
        spread = F.xxhash64(F.spark_partition_id(), *rows.columns)
        laid_out = (
            rows.withColumn("__spread", spread).repartitionByRange(*by, "__spread").drop("__spread").sortWithinPartitions(*by)
            if by
            else rows
        )
        laid_out.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.path}/{LOADS}/{load}")
        parts = self._written(load, rows.schema, partition_by, run.audit_key if of_run else None)
        new = {p.folder for p in parts}
        stays = [p for p in kept if p.folder not in new]
        written = sum(p.rows for p in parts)
        runs = dict(live.runs) if live else {}
        if run is not None:
            runs[str(run.audit_key)] = written if total is None else total
        schema = rows.schema.jsonValue()
        self._publish(Pointer(version, schema, tuple(sorted([*stays, *parts], key=lambda p: (p.folder, p.load))), runs))
        return written

    def _publish(self, pointer: Pointer) -> None:
        if not self.folder.create(f"{POINTERS}/{pointer.version:09d}.json", pointer.text()):
            raise ConcurrentLoad(f"{self.path}: version {pointer.version} went live meanwhile")

    def _written(self, load: str, schema: StructType, partition_by: Sequence[str], run: int | None) -> list[Part]:
        """The partition folders of a load with their rows, counted from the footers of its files."""
        base, folders = f"{LOADS}/{load}", [""]
        for _ in partition_by:
            folders = [f"{f}/{n}" if f else n for f in folders for n in self.folder.folders(f"{base}/{f}" if f else base)]
        if not folders:
            return []
        root = f"{self.path}/{base}"
        files = self.spark.read.schema(schema).option("basePath", root).parquet(root)
        inside = F.regexp_extract(F.col("_metadata.file_path"), f"/{load}/(.*)/[^/]*$", 1) if partition_by else F.lit("")
        counts = {unquote(r["folder"]): r["n"] for r in files.groupBy(inside.alias("folder")).agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = {f: self.folder.size(f"{base}/{f}" if f else base) for f in folders}
        return [Part(load, f, counts.get(f, 0), sizes[f], run) for f in folders]


def load_once(df: DataFrame, run: RunContext, target: StoredTable, audit: StoredTable, script: str, how: str = "append") -> int:
    """An audited load that takes effect once, however often it is run or broken off; the number of rows it loaded.

    `how` is append, merge or overwrite. The data and the run's row count go live in one pointer, so a run that broke after
    that is recognised: its data are not written again, only its audit row is closed. The audit table has one row for each
    run and script: RUNNING, then SUCCESS with the count or FAILED; a later try of a failed run opens the row again.
    """

    def log(status: str, rows: int | None) -> None:
        values = (run.audit_key, run.run_id, run.created_at, script, run.source_file, rows, status)
        row = df.sparkSession.createDataFrame([values], audit.spec.ddl)
        audit.merge(row, preserve=("run_timestamp",))

    rows = target.committed(run)
    if rows is None:
        log("RUNNING", None)
        try:
            rows = getattr(target, how)(df, run)
        except BaseException:
            log("FAILED", None)
            raise
    log("SUCCESS", rows)
    return rows


def pointers_status(tables: dict[str, StoredTable]) -> DataFrame:
    """(table, row_count, size_bytes) by row count, from the pointers: no file of the tables is opened."""
    spark = next(iter(tables.values())).spark
    rows = [(name, *table.status()) for name, table in tables.items()]
    return spark.createDataFrame(rows, "`table` string, row_count bigint, size_bytes bigint").orderBy(F.desc("row_count"), "table")


