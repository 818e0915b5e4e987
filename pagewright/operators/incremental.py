"""Processing only new or changed records, by diffing immutable table versions.

A *manifest* is the set of live entries of one table version. The difference of two manifests gives the records that
were added and removed between them; a reader that stores the version it has processed in the very commit that holds
its output can fail at any point without skipping or repeating a record.

Two forms share that idea. :func:`diff_manifests` works on manifests kept as DataFrames, of any size, with one shuffle.
:class:`VersionedTable` keeps a commit log on a file system: data files never change, a commit adds files, removes files
or attaches deletion vectors (row positions within a file), and :meth:`VersionedTable.changes` turns the difference of
two versions into record deltas.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.session import materialise, shared_dir


def normal_hash(column: str):
    """A content hash trimmed of white space and in lower case; a blank one is null."""
    clean = F.lower(F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", ""))
    return F.when(clean != "", clean)


def live_manifest(arrivals: DataFrame) -> DataFrame:
    """The input tree's manifest: for each file_path, the hash of its current version.

    Each arrival adds a file version and supersedes the path's former one: the row with the greatest modified_at, then
    the greatest arrival_id, is live. Repeated rows change nothing. A null modified_at or arrival_id is older than any
    value. Rows of a null path, and paths whose current hash is null or blank, have no entry. The maximum is combined
    on the map side, so a path that holds a third of all rows costs one row a task.
    """
    current = arrivals.select("file_path", F.struct("modified_at", "arrival_id", normal_hash("file_hash").alias("h")).alias("v"))
    return (
        current.where("file_path IS NOT NULL").groupBy("file_path").agg(F.max("v").alias("v"))
        .select("file_path", F.col("v.h").alias("file_hash")).where("file_hash IS NOT NULL")
    )


def committed_manifest(tracked: DataFrame) -> DataFrame:
    """The output's manifest: hashes with a row of status COMPLETE and a completed_at, at any path.

    It is read from the rows alone, not from the outcome of runs: what an unsuccessful run committed stands, and what
    a successful run didn't commit is still open.
    """
    done = tracked.where("status = 'COMPLETE' AND completed_at IS NOT NULL")
    return done.select(normal_hash("file_hash").alias("file_hash")).where("file_hash IS NOT NULL").distinct()


def diff_manifests(old: DataFrame, new: DataFrame, keys: Iterable[str]) -> DataFrame:
    """keys and change ('added' or 'removed') of the entries that one manifest has and the other has not.

    Repeated entries count once; keys compare null-safely; either side may be empty. One aggregation by key, with both
    sides reduced before the shuffle, instead of two anti-joins.
    """
    keys = list(keys)
    both = old.select(*keys, F.lit(1).alias("side")).unionByName(new.select(*keys, F.lit(2).alias("side")))
    sides = both.groupBy(*keys).agg(F.bit_or("side").alias("sides"))
    return sides.where("sides < 3").select(*keys, F.when(F.col("sides") == 2, "added").otherwise("removed").alias("change"))


def pending_content(arrivals: DataFrame, tracked: DataFrame) -> DataFrame:
    """file_hash of the content that the next run must process, each once: what the live manifest adds to the committed one."""
    added = diff_manifests(committed_manifest(tracked), live_manifest(arrivals).select("file_hash"), ["file_hash"])
    return added.where("change = 'added'").select("file_hash")


def pending_by_versions(arrivals: DataFrame, tracked: DataFrame) -> DataFrame:
    """file_hash of the content that the next run must process, as :func:`pending_content`, read off the versions of a table.

    The arrivals become a table's data files (version 1). A deletion vector hides the rows that a later version of their
    path supersedes (version 2), another those whose content is committed already (version 3). What is processed is the
    difference between the manifest a sink has stored as its last and the latest; it is committed to the sink together
    with that version. The two tables lie in a new folder under the shared one, as both inputs are given whole. Inputs
    and edge cases as for :func:`pending_content`.
    """
    spark = arrivals.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/pagewright/pending-{uuid.uuid4().hex}"
    source, sink = VersionedTable(spark, f"{folder}/arrivals"), VersionedTable(spark, f"{folder}/pending")
    seen = arrivals.select("file_path", "modified_at", "arrival_id", normal_hash("file_hash").alias("file_hash")).where("file_path IS NOT NULL").distinct()
    source.commit(add=seen)
    # One row a path is combined on the map side, so a path of many versions is no hot key.
    version = F.struct("modified_at", "arrival_id", "file_hash")
    live = source.rows(source.manifest()["files"])
    best = live.groupBy("file_path").agg(F.max(version).alias("best"))
    source.commit(delete=live.join(best, "file_path").where(F.col("file_hash").isNull() | (version < F.col("best"))))
    done = committed_manifest(tracked)
    source.commit(delete=source.rows(source.manifest()["files"]).join(done, "file_hash", "left_semi"))
    process_new(source, sink, lambda changes: changes.where("_change = 'added'").select("file_hash").distinct())
    return sink.snapshot()


class CommitConflict(RuntimeError):
    """Another writer made this version first."""


class VersionedTable:
    """An append-only log of immutable versions over parquet files in one folder.

    ``_log/<version>.json`` lists the live files of the version with their deletion vectors. A commit is one exclusive
    creation of that file, so it happens wholly or not at all, and a second writer of the same version fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def _path(self, rel: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{rel}")

    def version(self) -> int:
        """The latest committed version; 0 where there is none."""
        log = self._path("_log")
        if not self._fs.exists(log):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """files (name to deletion-vector name or null) and properties of a version; version 0 is empty."""
        version = self.version() if version is None else version
        if version == 0:
            return {"files": {}, "properties": {}, "schema": None}
        stream = self._fs.open(self._path(f"_log/{version:020d}.json"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def commit(self, add: DataFrame | None = None, remove: Iterable[str] = (), delete: DataFrame | None = None, properties: dict | None = None, base: int | None = None) -> int:
        """Make the next version and return its number.

        add: rows for new data files. remove: names of live files to drop. delete: rows (_file, _row), as :meth:`rows`
        gives them, to hide by a deletion vector. properties: stored in the same commit, over the former ones. base:
        the version the caller has read; if another writer has committed since, :class:`CommitConflict` is raised and
        nothing changes. Files written by a failed commit are never listed, so no reader sees them.
        """
        base = self.version() if base is None else base
        old = self.manifest(base)
        files, schema = dict(old["files"]), old["schema"]
        for name in remove:
            files.pop(name, None)
        if delete is not None:
            files = self._delete(files, delete)
        if add is not None:
            schema = schema or json.loads(add.schema.json())
            part = f"data-{uuid.uuid4().hex}"
            add.write.parquet(f"{self.path}/{part}")
            for s in self._fs.listStatus(self._path(part)):
                if s.getPath().getName().endswith(".parquet"):
                    files[f"{part}/{s.getPath().getName()}"] = None
        body = json.dumps({"files": files, "properties": old["properties"] | (properties or {}), "schema": schema})
        self._fs.mkdirs(self._path("_log"))
        final = self._path(f"_log/{base + 1:020d}.json")
        # Spark's own way to make a file as a whole and only where there is none; a cluster's setting may name another
        # for stores without an atomic rename.
        out = self._manager().createAtomic(final, False)
        try:
            out.write(bytearray(body.encode()))
            out.close()
        except Py4JJavaError as e:
            out.cancel()
            if self._fs.exists(final):
                for name in {n.split("/")[0] for n in (files.keys() - old["files"].keys()) | {v for n, v in files.items() if v and old["files"].get(n) != v}}:
                    self._fs.delete(self._path(name), True)
                raise CommitConflict(f"version {base + 1} of {self.path} exists") from e
            raise
        return base + 1

    def _manager(self):
        return self._jvm.org.apache.spark.sql.execution.streaming.checkpointing.CheckpointFileManager.create(self._path("_log"), self.spark._jsparkSession.sessionState().newHadoopConf())

    def _delete(self, files: dict, delete: DataFrame) -> dict:
        """Write the new vectors in one folder partitioned by file; a file's new vector holds its old one."""
        part = f"dv-{uuid.uuid4().hex}"
        gone = materialise(delete.select("_file", "_row"), "deleted")
        touched = [r["_file"] for r in gone.select("_file").distinct().collect()]  # files, which the manifest lists anyway
        held = [f"{self.path}/{files[n]}" for n in touched if files.get(n)]
        if held:
            gone = gone.unionByName(self.spark.read.parquet(*held).select("_file", "_row"))
        gone = gone.distinct().withColumn("_key", F.md5("_file"))
        gone.write.partitionBy("_key").parquet(f"{self.path}/{part}")
        made = {s.getPath().getName()[5:] for s in self._fs.listStatus(self._path(part)) if s.getPath().getName().startswith("_key=")}
        key = {name: hashlib.md5(name.encode()).hexdigest() for name in files}
        return {name: f"{part}/_key={key[name]}" if key[name] in made else vector for name, vector in files.items()}

    def rows(self, files: dict) -> DataFrame:
        """The live rows of some files, with _file and _row that identify each for ever."""
        schema = self.manifest()["schema"]
        from pyspark.sql.types import StructType

        kind = StructType.fromJson(schema) if schema else StructType()
        if not files:
            return self.spark.createDataFrame([], kind).withColumns({"_file": F.lit(None).cast("string"), "_row": F.lit(None).cast("bigint")})
        full = [f"{self.path}/{name}" for name in files]
        at = F.concat_ws("/", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), F.col("_metadata.file_name"))
        rows = self.spark.read.schema(kind).parquet(*full).withColumns({"_file": at, "_row": F.col("_metadata.row_index")})
        vectors = {n: v for n, v in files.items() if v}
        if vectors:
            gone = self.spark.read.parquet(*[f"{self.path}/{v}" for v in vectors.values()]).select("_file", "_row")
            rows = rows.join(gone, ["_file", "_row"], "left_anti")
        return rows

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        return self.rows(self.manifest(version)["files"]).drop("_file", "_row")

    def changes(self, start: int, end: int | None = None) -> DataFrame:
        """Rows with _change 'added' or 'removed' that lead from version start to version end.

        Only files whose entry differs are read: a file that both versions hold with the same vector is skipped whole.
        """
        a, b = self.manifest(start)["files"], self.manifest(end)["files"]
        same = {n for n in a if n in b and a[n] == b[n]}
        before = self.rows({n: v for n, v in a.items() if n not in same})
        after = self.rows({n: v for n, v in b.items() if n not in same})
        gone = before.join(after.select("_file", "_row"), ["_file", "_row"], "left_anti") if set(a) - same and set(b) - same else before
        new = after.join(before.select("_file", "_row"), ["_file", "_row"], "left_anti") if set(a) - same and set(b) - same else after
        tag = lambda df, kind: df.drop("_file", "_row").withColumn("_change", F.lit(kind))
        return tag(new, "added").unionByName(tag(gone, "removed"))


def process_new(source: VersionedTable, sink: VersionedTable, step: Callable[[DataFrame], DataFrame]) -> int | None:
    """Run step over the changes since the version that the sink has processed; commit its output together with that version.

    Returns the processed version, or None where nothing is new. If it fails before the commit, the next call starts
    from the same version; if the commit succeeds, these changes are never given again. Two runs at once: one commits,
    the other gets :class:`CommitConflict` and leaves no trace.
    """
    base = sink.version()
    done, latest = int(sink.manifest(base)["properties"].get("processed_version", 0)), source.version()
    if latest <= done:
        return None
    sink.commit(add=step(source.changes(done, latest)), properties={"processed_version": latest}, base=base)
    return latest
