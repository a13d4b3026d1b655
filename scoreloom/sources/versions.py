"""Versions of parameter tables: data first, a manifest last, reads as of a version."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "version long, name string, folder string, committed_at timestamp"


class VersionStore:
    """Small tables that belong together, kept version by version below ``path``.

    ``commit`` writes each table to a new folder and then one manifest row per
    table, all in a single file that appears at once. Readers go by manifests, so
    they see all tables of a version or none, and a write that broke off is never
    read. Nothing is overwritten: readers of older versions go on. Writers take
    turns; if two still commit the same number, the manifest written first holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.path}/manifests/*")
        except AnalysisException:
            return None  # no version was ever committed

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = self._manifests()
        return sorted(r["version"] for r in found.select("version").distinct().collect()) if found else []

    def commit(self, tables: Mapping[str, DataFrame]) -> int:
        """Write ``tables`` as the next version and return its number (1, 2, …)."""
        version = max(self.versions(), default=0) + 1
        mark = uuid.uuid4().hex
        rows = []
        for name, table in tables.items():
            folder = f"data/v{version:08d}-{mark}/{name}"
            table.write.parquet(f"{self.path}/{folder}")
            rows.append((version, name, folder))
        manifest = self.spark.createDataFrame(rows, "version long, name string, folder string")
        manifest = manifest.withColumn("committed_at", F.current_timestamp()).coalesce(1)
        manifest.write.parquet(f"{self.path}/manifests/v{version:08d}-{mark}")
        return version

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version, by default the latest that has it."""
        found = self._manifests()
        rows = [] if found is None else found.where(F.col("name") == name).collect()
        wanted = [r for r in rows if version is None or r["version"] == version]
        if not wanted:
            raise LookupError(f"{self.path} has no {name}" + ("" if version is None else f" of version {version}"))
        latest = max(r["version"] for r in wanted)
        held = min((r for r in wanted if r["version"] == latest), key=lambda r: (r["committed_at"], r["folder"]))
        return self.spark.read.parquet(f"{self.path}/{held['folder']}")
