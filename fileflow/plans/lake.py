"""Layout of one deployment's tables under a root folder, and table bootstrap."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from fileflow.operators.table import SnapshotTable
from fileflow.schemas import ELT_DATA, FILE_MANIFEST, PIPELINE_RUN


@dataclass
class Lake:
    spark: SparkSession
    root: str
    _tables: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> SnapshotTable:
        if name not in self._tables:
            self._tables[name] = SnapshotTable(self.spark, f"{self.root.rstrip('/')}/tables/{name}")
        return self._tables[name]

    @property
    def pipeline_run(self) -> SnapshotTable:
        return self.table("pipeline_run")

    @property
    def file_manifest(self) -> SnapshotTable:
        return self.table("file_manifest")

    @property
    def bronze(self) -> SnapshotTable:
        return self.table("bronze")

    @property
    def bronze_chunks(self) -> SnapshotTable:
        """Files too large for a row: one row per chunk."""
        return self.table("bronze_chunks")

    @property
    def rejects(self) -> SnapshotTable:
        """Files and lines that a run left out: run_id, run_date, source_file, line, reason."""
        return self.table("rejects")

    @property
    def silver_root(self) -> str:
        return f"{self.root.rstrip('/')}/silver"

    @property
    def manifests(self) -> str:
        return f"{self.root.rstrip('/')}/manifests"

    def bootstrap(self) -> list[str]:
        """Create the audit tables if absent; existing ones are left alone."""
        if self._tables.get("_bootstrapped"):
            return []
        made = []
        for name, schema in (("pipeline_run", PIPELINE_RUN), ("file_manifest", FILE_MANIFEST),
                             ("elt_data", ELT_DATA)):
            if self.table(name).create_if_absent(schema):
                made.append(name)
        self._tables["_bootstrapped"] = True
        return made
