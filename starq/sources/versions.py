"""Layers that change as a whole: data first, a manifest last.

    folder/data/<name>-<unique>/      a table, or one appended batch of it, as Parquet
    folder/manifest/<number>.json     which of these make up the layer, and their schemas

Data folders are new and never change. A change becomes visible when its manifest
file is created; a file of that number must not exist yet, so of two writers one
fails and nothing is lost. A run that fails in between leaves the layer as it was,
and folders that no manifest names, which `clean` removes. Readers take the manifest
with the highest number. What the driver handles is the manifest, one entry a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import DataFrame, SparkSession, types as T

from starq.sources.tables import conform


class Conflict(RuntimeError):
    """Another writer changed the layer in the meantime; read it again and retry."""


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    # name: schema (JSON) and {batch id: folder}; a refreshed table has one batch.
    tables: dict[str, dict] = field(default_factory=dict)
    # Small values that change together with the tables, high-water marks for one.
    marks: dict[str, int] = field(default_factory=dict)
    # Outputs that are no Parquet tables, by name.
    files: dict[str, str] = field(default_factory=dict)

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(self.tables[name]["schema"])

    def folders(self, name: str) -> list[str]:
        return list(self.tables[name]["batches"].values())


class Layer:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- reading ---

    def manifest(self) -> Manifest:
        """The layer as it stands (number 0: nothing written yet)."""
        place = self._path(f"{self.folder}/manifest")
        if not self._fs.exists(place):
            return Manifest()
        names = [s.getPath().getName() for s in self._fs.listStatus(place)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]
        if not numbers:
            return Manifest()
        stream = self._fs.open(self._path(self._manifest_path(max(numbers))))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(max(numbers), **json.loads(text))

    def read(self, name: str, manifest: Manifest | None = None) -> DataFrame:
        manifest = manifest or self.manifest()
        if name not in manifest.tables:
            raise FileNotFoundError(f"{self.folder}: no table {name}")
        schema, folders = manifest.schema(name), manifest.folders(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def tables(self) -> dict[str, DataFrame]:
        manifest = self.manifest()
        return {name: self.read(name, manifest) for name in manifest.tables}

    # --- changing ---

    def refresh(self, tables: Mapping[str, DataFrame], marks: Mapping[str, int] | None = None) -> list[str]:
        """Makes these the whole layer. Returns the names of tables that are gone."""
        before = self.manifest()
        written = {name: self._write(name, df, df.schema, "refresh") for name, df in tables.items()}
        self._commit(before, written, dict(marks or {}))
        return sorted(set(before.tables) - set(written))

    def append(
        self, batch: str, rows: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType] | None = None,
        marks: Mapping[str, int] | None = None,
    ) -> bool:
        """Adds a batch of rows to tables, all at once. A batch id that a table has adds nothing to it again.

        The first batch, or `schemas`, declares a table's columns; later rows are cast to them.
        Returns whether anything was added.
        """
        before = self.manifest()
        after = dict(before.tables)
        new = {n: df for n, df in rows.items() if batch not in before.tables.get(n, {"batches": {}})["batches"]}
        for name, df in new.items():
            declared = before.schema(name) if name in before.tables else (schemas or {}).get(name, df.schema)
            added = self._write(name, conform(df, declared), declared, batch)
            known = after.get(name, {"batches": {}})["batches"]
            after[name] = added | {"batches": known | added["batches"]}
        if new:
            self._commit(before, after, before.marks | dict(marks or {}), before.files)
        return bool(new)

    def adopt(self, folders: Mapping[str, str], files: Mapping[str, str] = {}) -> None:
        """Makes Parquet folders (and other outputs) that a run has written the whole layer."""
        before = self.manifest()
        tables = {n: {"schema": self.spark.read.parquet(f).schema.jsonValue(), "batches": {"refresh": f}} for n, f in folders.items()}
        self._commit(before, tables, {}, dict(files))

    def clean(self) -> list[str]:
        """Removes data folders that the layer does not name, and older manifests. Not while others read or write."""
        manifest = self.manifest()
        used = {f.rsplit("/", 1)[1] for name in manifest.tables for f in manifest.folders(name)}
        gone = []
        for place, keep in (("data", used), ("manifest", {f"{manifest.number:08d}.json"})):
            path = self._path(f"{self.folder}/{place}")
            for status in self._fs.listStatus(path) if self._fs.exists(path) else ():
                if status.getPath().getName() not in keep:
                    self._fs.delete(status.getPath(), True)
                    gone.append(f"{place}/{status.getPath().getName()}")
        return sorted(gone)

    def _manifest_path(self, number: int) -> str:
        return f"{self.folder}/manifest/{number:08d}.json"

    def _write(self, name: str, df: DataFrame, schema: T.StructType, batch: str) -> dict:
        path = f"{self.folder}/data/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        return {"schema": schema.jsonValue(), "batches": {batch: path}}

    def _commit(self, before: Manifest, tables: dict, marks: dict, files: Mapping[str, str] = {}) -> None:
        # Whole under another name, then renamed: a reader never sees half a manifest.
        text = json.dumps({"tables": tables, "marks": marks, "files": dict(files)})
        final, draft = self._path(self._manifest_path(before.number + 1)), self._path(f"{self.folder}/manifest/draft-{uuid.uuid4().hex}")
        try:
            stream = self._fs.create(draft, False)
            try:
                stream.write(bytearray(text.encode()))
            finally:
                stream.close()
            done = not self._fs.exists(final) and self._fs.rename(draft, final)
        except CapturedException as error:
            raise Conflict(f"{self.folder}: manifest {before.number + 1} could not be created") from error
        if not done:
            raise Conflict(f"{self.folder}: manifest {before.number + 1} is there already")


def refresh_layer(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str, location: str | None = None
) -> list[str]:
    """Replace a catalog database by exactly these tables.

    All data is written, as a version of a layer in the database's folder, before the
    catalog changes: a failure leaves the old tables. The change itself touches names
    and places only. Returns the stale tables that were dropped.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
    layer = Layer(spark, f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/layer")
    layer.refresh(tables)
    manifest = layer.manifest()
    stale = sorted(t.name for t in spark.catalog.listTables(database) if t.name not in tables and not t.isTemporary)
    for name in [*stale, *tables]:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    for name in tables:
        spark.catalog.createTable(f"`{database}`.`{name}`", manifest.folders(name)[0], "parquet", manifest.schema(name))
    return stale
