"""Artifact store with a manifest (A10).

A store is one folder of models (ML persistence), tables (Parquet) and small
documents (JSON).  Every save goes into a folder of its own; when all artifacts
are written, the store's manifest, a table of each file's length and SHA-256, is
committed last.  A reader takes the newest committed manifest and refuses files
that are missing, changed or not in it, so a save cut short is never read: the
one before it stays the store's content.

Files are hashed where they lie, one task each; the manifest has a row per file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "save string, kind string, artifact string, file string, length long, sha256 string"
KINDS = ("models", "tables", "docs")


class StoreError(RuntimeError):
    """The store has no committed save, or its files are not those of the manifest."""


def _file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """(kind, artifact, file, length, sha256) of every file below ``folder``."""
    relative = F.element_at(F.split("path", f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/"), -1)
    part = F.split(relative, "/", 3)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!._]*").load(folder)
            .select(part[0].alias("kind"), part[1].alias("artifact"), relative.alias("file"), "length",
                    F.sha2("content", 256).alias("sha256")))


@dataclass
class ArtifactStore:
    """Saves and loads of one folder, any Hadoop URI."""
    spark: SparkSession
    base: str

    def _manifests(self) -> str:
        return f"{self.base.rstrip('/')}/manifests"

    def save(self, models: Mapping[str, object] | None = None, tables: Mapping[str, DataFrame] | None = None,
             docs: Mapping[str, object] | None = None) -> str:
        """Write every artifact, then commit the manifest; returns the save's name."""
        name = uuid.uuid4().hex
        folder = f"{self.base.rstrip('/')}/{name}"
        for key, model in (models or {}).items():
            model.write().save(f"{folder}/models/{key}")
        for key, df in (tables or {}).items():
            df.write.parquet(f"{folder}/tables/{key}")
        for key, doc in (docs or {}).items():
            (self.spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string").coalesce(1)
             .write.text(f"{folder}/docs/{key}"))
        self.commit(name)
        return name

    def commit(self, name: str) -> None:
        """Hash the files of a save and write its manifest; the save counts from here on."""
        hashes = _file_hashes(self.spark, f"{self.base.rstrip('/')}/{name}")
        stamped = hashes.select(F.lit(name).alias("save"), "*", F.current_timestamp().alias("committed"))
        stamped.coalesce(1).write.json(f"{self._manifests()}/{name}")  # one file: it is there whole or not at all

    def manifest(self) -> DataFrame:
        """``MANIFEST`` rows of the newest committed save."""
        try:
            rows = (self.spark.read.schema(MANIFEST + ", committed timestamp").option("recursiveFileLookup", "true")
                    .json(self._manifests()))
        except Exception as e:
            raise StoreError(f"{self.base}: no save is committed") from e
        last = rows.agg(F.max_by("save", F.struct("committed", "save")).alias("save")).first()["save"]
        if last is None:
            raise StoreError(f"{self.base}: no save is committed")
        return rows.where(F.col("save") == last).drop("committed")

    def verified(self) -> str:
        """The newest committed save's folder, its files compared with the manifest."""
        wanted = self.manifest()
        name = wanted.first()["save"]
        folder = f"{self.base.rstrip('/')}/{name}"
        found = _file_hashes(self.spark, folder).select("file", F.col("length").alias("l"), F.col("sha256").alias("s"))
        bad = (wanted.join(found, "file", "full")
               .where(~(F.col("length").eqNullSafe(F.col("l")) & F.col("sha256").eqNullSafe(F.col("s")))).select("file").limit(5).collect())
        if bad:
            raise StoreError(f"{folder}: not as committed: {[r['file'] for r in bad]}")
        return folder

    def load(self) -> dict[str, dict]:
        """{"models": ..., "tables": ..., "docs": ...} of the newest committed save."""
        folder = self.verified()
        out: dict[str, dict] = {k: {} for k in KINDS}
        for r in self.manifest().select("kind", "artifact").distinct().collect():  # a row per artifact
            path = f"{folder}/{r['kind']}/{r['artifact']}"
            if r["kind"] == "models":
                out["models"][r["artifact"]] = DefaultParamsReader.loadParamsInstance(path, self.spark)
            elif r["kind"] == "tables":
                out["tables"][r["artifact"]] = self.spark.read.parquet(path)
            else:
                out["docs"][r["artifact"]] = json.loads(self.spark.read.text(path).first()[0])
        return out
