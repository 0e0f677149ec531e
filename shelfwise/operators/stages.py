"""Stages that restart where their inputs changed, kept by a ledger of digests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.evidence import rows_digest


class ChangedFacts(ValueError):
    """What a finished run rests on is no longer what it was."""


def table_digest(df: DataFrame) -> str:
    """A digest of a table's columns and of its rows in any order: two sums, taken by Spark."""
    whole = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).cast("binary"), 256)
    count, low, high = df.select(whole.alias("_d")).agg(F.count(F.lit(1)), *rows_digest(F.col("_d"))).first()
    return hashlib.sha256(json.dumps([sorted(df.dtypes), count, str(low), str(high)]).encode()).hexdigest()


def code_digest(build: Callable) -> str:
    """A digest of what a function does: its code, its constants, what it has closed over and its defaults."""

    def parts(code):
        yield code.co_code.hex()
        yield str(code.co_names)
        for c in code.co_consts:
            yield from parts(c) if hasattr(c, "co_code") else [repr(c)]

    closed = [repr(c.cell_contents) for c in build.__closure__ or ()]
    return hashlib.sha256("\n".join([*parts(build.__code__), *closed, repr(build.__defaults__)]).encode()).hexdigest()


@dataclass(frozen=True)
class Stage:
    """build takes the tables named in `needs`, in this order, and returns one. version: stands for the code where given."""

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    version: str | None = None

    def code(self) -> str:
        return self.version or code_digest(self.build)


class Ledger:
    """Entries and outputs of stages under a folder that the cluster shares.

    A stage's key is the digest of its name, its code and the digests of its
    inputs. An output is used again if its entry is there and names that key; an
    entry is written after its output, by a create that fails if it is there, so
    a run that dies leaves no entry of an unfinished stage. Outputs are read
    again as they are, their digest is compared with the entry's first.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.ran: list[str] = []
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def entry(self, name: str) -> dict | None:
        at = self.path(f"{self.folder}/entries/{name}.json")
        if not self.fs.exists(at):
            return None
        return json.loads("".join(r[0] for r in self.spark.read.text(at.toString()).collect()))

    def record(self, name: str, entry: dict) -> None:
        out = self.fs.create(self.path(f"{self.folder}/entries/{name}.json"), False)
        out.write(json.dumps(entry, sort_keys=True).encode())
        out.close()

    def pin(self, run: str, digests: dict[str, str]) -> None:
        """A run keeps to the inputs that it began with."""
        known = self.entry(f"run-{run}")
        if known is None:
            self.record(f"run-{run}", digests)
        elif known != digests:
            changed = sorted(k for k in known.keys() | digests.keys() if known.get(k) != digests.get(k))
            raise ChangedFacts(f"run {run} began with other inputs: {', '.join(changed)}")

    def stage(self, stage: Stage, tables: dict[str, DataFrame], digests: dict[str, str]) -> tuple[DataFrame, str]:
        """(output, its digest): from the ledger where nothing before it changed, else built and recorded."""
        key = hashlib.sha256(json.dumps([stage.name, stage.code(), [digests[n] for n in stage.needs]]).encode()).hexdigest()
        place, known = f"{self.folder}/{stage.name}/{key[:32]}", self.entry(f"{stage.name}-{key[:32]}")
        if known is not None:
            kept = self.spark.read.parquet(place)
            if table_digest(kept) != known["digest"]:
                raise ChangedFacts(f"the output of {stage.name} was changed after it was recorded")
            return kept, known["digest"]
        self.ran.append(stage.name)
        stage.build(*[tables[n] for n in stage.needs]).write.mode("overwrite").parquet(place)
        done = self.spark.read.parquet(place)
        digest = table_digest(done)
        self.record(f"{stage.name}-{key[:32]}", {"key": key, "digest": digest})
        return done, digest

    def run(self, run: str, inputs: dict[str, DataFrame], stages: list[Stage]) -> dict[str, DataFrame]:
        """All stages' outputs by name; `ran` names those that were built this time."""
        self.ran = []
        tables, digests = dict(inputs), {n: table_digest(df) for n, df in inputs.items()}
        self.pin(run, digests)
        for stage in stages:
            missing = [n for n in stage.needs if n not in tables]
            if missing:
                raise ValueError(f"{stage.name} needs {', '.join(missing)} before it")
            tables[stage.name], digests[stage.name] = self.stage(stage, tables, digests)
        return {s.name: tables[s.name] for s in stages}
