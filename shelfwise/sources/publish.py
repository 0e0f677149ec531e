"""Two outputs published as one: a table and its manifest, with a journal to go back by."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfwise.operators.stages import table_digest


class PublishFault(ValueError):
    """A publication that can't be made or undone."""


class Publication:
    """The pair `name` and `name.manifest` in a folder, replaced together.

    Both are written to a staging folder, which a rename makes the journal. Then
    each old output moves into the journal and each new one out of it. Whoever
    finds a journal finds everything to restore the old pair, whatever step the
    publisher died in; a pair counts as published when the journal is gone. All
    moves are renames of the file system, none copies data.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.targets = [f"{self.folder}/{name}", f"{self.folder}/{name}.manifest"]
        self.journal = f"{self.folder}/.{name}.journal"
        context = spark.sparkContext
        self.path = context._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(context._jsc.hadoopConfiguration())

    def there(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def move(self, source: str, target: str) -> None:
        if self.there(target) or not self.fs.rename(self.path(source), self.path(target)):
            raise PublishFault(f"can't move {source} to {target}")

    def drop(self, at: str) -> None:
        self.fs.delete(self.path(at), True)

    def put(self, at: str, value: dict) -> None:
        out = self.fs.create(self.path(at), False)
        out.write(json.dumps(value, sort_keys=True).encode())
        out.close()

    def get(self, at: str) -> dict:
        return json.loads("".join(r[0] for r in self.spark.read.text(at).collect()))

    def publish(self, rows: DataFrame, manifest: dict) -> None:
        """Replaces the pair; after any fault the old pair is back."""
        if self.there(self.journal):
            raise PublishFault("an earlier publication has to be recovered first")
        staging = f"{self.folder}/.prepare-{uuid.uuid4().hex}"
        started = False
        try:
            rows.write.parquet(f"{staging}/new-0")
            digest = table_digest(self.spark.read.parquet(f"{staging}/new-0"))
            if manifest.get("digest", digest) != digest:
                raise PublishFault("the manifest is of another table")
            self.put(f"{staging}/new-1", manifest | {"digest": digest})
            self.put(f"{staging}/journal.json", {"existed": [self.there(t) for t in self.targets]})
            self.move(staging, self.journal)
            started = True
            for k, target in enumerate(self.targets):
                if self.there(target):
                    self.move(target, f"{self.journal}/old-{k}")
                self.move(f"{self.journal}/new-{k}", target)
            self.drop(self.journal)
        except BaseException:
            if started:
                self.recover()
            raise
        finally:
            self.drop(staging)

    def recover(self) -> bool:
        """Restores the old pair if a journal is there; can be repeated after dying itself."""
        if not self.there(self.journal):
            return False
        if not self.there(f"{self.journal}/journal.json"):
            raise PublishFault("the journal can't be read")
        existed = self.get(f"{self.journal}/journal.json")["existed"]
        for k, target in enumerate(self.targets):
            old, new = f"{self.journal}/old-{k}", f"{self.journal}/new-{k}"
            if self.there(old):
                self.drop(target)
                self.move(old, target)
            elif not existed[k] and not self.there(new):
                self.drop(target)  # the new output, which nothing stood before
        self.drop(self.journal)
        return True

    def read(self) -> tuple[DataFrame, dict]:
        """The published pair; refused while a journal is there or where the two do not belong together."""
        if self.there(self.journal):
            raise PublishFault("a publication is under way or was broken off")
        rows, manifest = self.spark.read.parquet(self.targets[0]), self.get(self.targets[1])
        if table_digest(rows) != manifest["digest"]:
            raise PublishFault("the table and its manifest do not belong together")
        return rows, manifest
