"""Versioned tables on plain files: write a version, then make it visible by one commit file.

A commit names the head it builds on, and its file is named after that head and created
only if it isn't there: of two writers that build on one head, one gets a conflict. The
store must create files exclusively, as HDFS and local file systems do. The same run with
the same content returns the commit that is there, so a job may be run again after a failure.
A commit replaces the table or appends to it; an append writes its own rows only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "commit_id string, base_commit string, run_id string, content_hash string, version string, rows long, committed_at timestamp, appends boolean"


class CommitConflict(RuntimeError):
    pass


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    path: str

    def _file(self, name: str):
        """(file system, path) of a name below the table."""
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(context._jsc.hadoopConfiguration()), where

    def log(self) -> DataFrame:
        store, where = self._file("_commits")
        if not store.exists(where):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).json(f"{self.path}/_commits")

    def head(self):
        """The commit on which no other builds, or None."""
        log = self.log()
        return log.join(log.select(F.col("base_commit").alias("_base")), F.col("commit_id") == F.col("_base"), "left_anti").first()

    def read(self) -> DataFrame | None:
        """The table: its newest replacement and all that was appended since."""
        log = {row.commit_id: row for row in self.log().collect()}  # one small row for each commit
        based = {row.base_commit for row in log.values()}
        at = next((row for row in log.values() if row.commit_id not in based), None)
        paths = []
        while at is not None:
            paths.append(f"{self.path}/{at.version}")
            at = log.get(at.base_commit) if at.appends else None
        return self.spark.read.parquet(*paths) if paths else None

    def commit(self, rows: DataFrame, run_id: str, base: str | None, append: bool = False) -> str:
        """Writes a version and its commit file; returns the commit's identifier."""
        known = self.log().where(F.col("run_id") == run_id).first()
        if known:
            if known.content_hash != content_hash(rows):
                raise CommitConflict(f"run {run_id} was committed with other content")
            return known.commit_id
        head = self.head()
        if (head.commit_id if head else None) != base:
            raise CommitConflict(f"built on {base}, but the head is {head.commit_id if head else None}")
        version, commit_id = f"version-{uuid.uuid4().hex}", uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{version}")
        written = self.spark.read.parquet(f"{self.path}/{version}")
        entry = {"commit_id": commit_id, "base_commit": base, "run_id": run_id, "content_hash": content_hash(written), "version": version, "rows": written.count(), "committed_at": datetime.now(timezone.utc).isoformat(), "appends": append}
        store, where = self._file(f"_commits/after-{base or 'nothing'}.json")
        try:
            out = store.create(where, False)
        except Exception as error:
            if not store.exists(where):
                raise
            folder, unseen = self._file(version)
            folder.delete(unseen, True)
            raise CommitConflict(f"another writer has built on {base}") from error
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        return commit_id


def content_hash(rows: DataFrame) -> str:
    """Hash of a table's rows whatever their order: two independent sums of 64-bit row hashes, so no task gathers rows."""
    columns = sorted(rows.columns)
    sums = rows.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")) for seed in (1, 2)]).first()
    return "-".join(str(x or 0) for x in sums)


def coverage_regression(before: DataFrame, after: DataFrame, columns: list[str], most_lost: float = 0.5) -> DataFrame:
    """(column, before, after) of the columns whose filled values drop by more than the share."""
    count = lambda df, name: df.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "column", name)
    both = count(before, "before").join(count(after, "after"), "column")
    return both.where((F.col("before") > 0) & (F.col("after") < (1 - most_lost) * F.col("before")))
