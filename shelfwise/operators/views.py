"""Saved views, selections frozen from them and the log of what was delivered, as versioned tables."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.catalogue import CatalogueQuery, matched
from shelfwise.operators.commits import CommitConflict, VersionedTable
from shelfwise.operators.records import with_ordinals

VIEW = "view_id string, name string, description string, query string, query_hash string, is_system boolean, created_at string, updated_at string"
SELECTION = "selection_id string, name string, view_id string, query string, query_hash string, source_commit string, matched long, created_at string"
ARTIFACT = "artifact_id string, kind string, selection_id string, place string, digest string, rows long, status string, error string, created_at string"


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


class Views:
    """Views by identifier; a view of the system can't be deleted, and a selection outlives the view it came from.

    Every change is one commit that names its base, so of two writers one gets a
    conflict and changes nothing. Views and selections are few, a row each; the
    members of selections are tables of their own, of any size.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.views, self.selections, self.artifacts = (VersionedTable(spark, f"{self.path}/{n}") for n in ("views", "selections", "artifacts"))

    def table(self, store: VersionedTable, schema: str) -> DataFrame:
        kept = store.read()
        return self.spark.createDataFrame([], schema) if kept is None else kept

    def put(self, store: VersionedTable, rows: DataFrame, append: bool = False) -> None:
        head = store.head()
        store.commit(rows, uuid.uuid4().hex, head.commit_id if head else None, append)

    def create(self, name: str, query: dict, description: str = "", is_system: bool = False) -> str:
        asked, moment, view_id = CatalogueQuery.request(query), now(), f"view_{uuid.uuid4().hex[:12]}"
        row = (view_id, name, description, asked.canonical(), asked.digest(), is_system, moment, moment)
        self.put(self.views, self.spark.createDataFrame([row], VIEW), append=True)
        return view_id

    def get(self, view_id: str) -> dict | None:
        row = self.table(self.views, VIEW).where(F.col("view_id") == view_id).first()
        return row and row.asDict() | {"query": json.loads(row["query"])}

    def list(self) -> DataFrame:
        return self.table(self.views, VIEW).orderBy("name", "view_id")

    def update(self, view_id: str, name: str | None = None, description: str | None = None, query: dict | None = None) -> None:
        """Given parts replace the view's; a query that is given comes with its hash."""
        if self.get(view_id) is None:
            raise KeyError("VIEW_NOT_FOUND")
        new = {"updated_at": now()}
        new |= {k: v for k, v in (("name", name), ("description", description)) if v is not None}
        if query is not None:
            asked = CatalogueQuery.request(query)
            new |= {"query": asked.canonical(), "query_hash": asked.digest()}
        own = F.col("view_id") == view_id
        rows = self.table(self.views, VIEW)
        self.put(self.views, rows.withColumns({k: F.when(own, F.lit(v)).otherwise(F.col(k)) for k, v in new.items()}))

    def delete(self, view_id: str) -> None:
        """Selections lose the link to the view and stay."""
        gone = (F.col("view_id") == view_id) & ~F.col("is_system")
        rows = self.table(self.views, VIEW)
        if not rows.where(gone).count():
            return
        kept = self.table(self.selections, SELECTION)
        if kept.where(F.col("view_id") == view_id).count():
            self.put(self.selections, kept.withColumn("view_id", F.when(F.col("view_id") != view_id, F.col("view_id"))))
        self.put(self.views, rows.where(~gone))

    def select(self, name: str, catalogue: DataFrame, query: dict, source_commit: str | None = None, view_id: str | None = None, order: tuple[str, ...] = ("sku",)) -> str:
        """Freezes all rows that match, whatever page a view shows, as (ordinal, sku); facts are read when it is used."""
        scope = {k: v for k, v in query.items() if k not in ("limit", "offset")}
        asked, selection_id = CatalogueQuery.request(scope), f"sel_{uuid.uuid4().hex[:12]}"
        with_ordinals(matched(catalogue, asked).select(*dict.fromkeys(["sku", *order])), list(order)).select("ordinal", "sku").write.parquet(f"{self.path}/members/{selection_id}")
        count = self.members(selection_id).count()
        row = (selection_id, name, view_id, asked.canonical(), asked.digest(), source_commit, count, now())
        self.put(self.selections, self.spark.createDataFrame([row], SELECTION), append=True)
        return selection_id

    def members(self, selection_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/members/{selection_id}")

    def deliver(self, kind: str, place: str, rows: int, digest: str | None, selection_id: str | None = None, status: str = "SUCCESS", error: str | None = None, artifact_id: str | None = None) -> str:
        """Adds to the log of deliveries, which only grows: an identifier that is taken gets a suffix."""
        log = self.table(self.artifacts, ARTIFACT)
        chosen = artifact_id or f"artifact_{uuid.uuid4().hex[:12]}"
        if log.where(F.col("artifact_id") == chosen).count():
            chosen = f"{chosen}_{uuid.uuid4().hex[:8]}"
        self.put(self.artifacts, self.spark.createDataFrame([(chosen, kind, selection_id, place, digest, rows, status, error, now())], ARTIFACT), append=True)
        return chosen

    def delivered(self, selection_id: str | None = None) -> DataFrame:
        log = self.table(self.artifacts, ARTIFACT)
        return (log if selection_id is None else log.where(F.col("selection_id") == selection_id)).orderBy(F.desc("created_at"), "artifact_id")


def members_digest(members: DataFrame) -> str:
    """A digest of a selection's SKUs in their order, by sums that Spark takes."""
    whole = F.xxhash64("ordinal", "sku").cast("decimal(38,0)")
    sums = members.agg(F.count(F.lit(1)), F.sum(whole), F.sum(F.xxhash64(F.lit(2), "sku", "ordinal").cast("decimal(38,0)"))).first()
    return hashlib.sha256("|".join(str(x) for x in sums).encode()).hexdigest()


__all__ = ["ARTIFACT", "CommitConflict", "SELECTION", "VIEW", "Views", "members_digest"]
