"""Model registry.

Models are saved with Spark ML's writer below the registry root, a shared
folder, each at a path of its own.  A version exists from the moment its record,
one small JSON file, appears under its name; the record is created as a whole and
only if no other one has that name, so of several publishers of one version
exactly one succeeds, and a model that is still being written is never listed.
The table of versions is read from the records.  Serving over HTTP is not part
of this package.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_SCHEMA = ("name string, version string, modeler string, path string, "
                   "created_at timestamp, params string, inputs string, outputs string")


class AlreadyExists(Exception):
    """The file that was to be created is there."""


class SharedFolder:
    """Files on the store that a path names, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path(self.root).getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def create(self, path: str, text: str) -> None:
        """``path`` with its whole content, or ``AlreadyExists``: written beside it
        under a fresh name and then linked (local) or renamed without replacing
        (other stores), which one caller at most can do."""
        temporary = f"{self.root}/_new/{uuid.uuid4().hex}"
        out = self.fs.create(self.path(temporary), False)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.mkdirs(self.path(path).getParent())
        try:
            if self.fs.getUri().getScheme() == "file":
                self._link(temporary, path)
            else:
                self._rename(temporary, path)
        finally:
            self.fs.delete(self.path(temporary), False)

    def _link(self, temporary: str, path: str) -> None:
        try:
            os.link(self.path(temporary).toUri().getPath(), self.path(path).toUri().getPath())
        except FileExistsError as e:
            raise AlreadyExists(path) from e

    def _rename(self, temporary: str, path: str) -> None:
        from py4j.protocol import Py4JJavaError
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(self.root).toUri(), self.conf)
        keep = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(temporary), self.path(path), keep)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise AlreadyExists(path) from e
            raise

    def read(self, path: str) -> str | None:
        """The text of a file, null where there is none."""
        if not self.fs.exists(self.path(path)):
            return None
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names of the entries of a folder, sorted; none where it does not exist."""
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class ModelRegistry:
    """A registry rooted at a shared folder ``root``.

    Records: ``<root>/_records/<name>/<version>.<revision>.json``, name and
    version percent-encoded; revision 0 is the first publication of a version,
    further ones are explicit updates."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = SharedFolder(spark, self.root)

    def _records(self, name: str | None = None) -> list[dict]:
        """The records, oldest first."""
        top = f"{self.root}/_records"
        found = []
        for n in [_file_name(name)] if name is not None else self.folder.names(top):
            for f in self.folder.names(f"{top}/{n}"):
                found.append({**json.loads(self.folder.read(f"{top}/{n}/{f}")), "revision": int(f.rsplit(".", 2)[1])})
        return sorted(found, key=lambda r: (r["created_at"], r["name"], r["version"], r["revision"]))

    # -- S12 -----------------------------------------------------------
    def table(self) -> DataFrame:
        """One row a record."""
        cols = [c.split()[0] for c in REGISTRY_SCHEMA.split(", ")]
        rows = [tuple(dt.datetime.fromisoformat(r[c]) if c == "created_at" else r[c] for c in cols) for r in self._records()]
        return self.spark.createDataFrame(rows, REGISTRY_SCHEMA)

    def save(self, model: PipelineModel, name: str, version: str = "1", modeler: str = "",
             params: dict | None = None, inputs: dict | None = None, outputs: dict | None = None,
             update: bool = False) -> str:
        """Save the model, then publish its record.  An existing
        ``(name, version)`` is refused unless ``update`` (then the newest record
        wins on lookup); a refused model's files are removed."""
        folder = f"{self.root}/_records/{_file_name(name)}"
        if not update and self.folder.read(f"{folder}/{_file_name(version)}.0.json") is not None:
            raise ValueError(f"model {name!r} version {version!r} is already published")
        path = f"{self.root}/{_file_name(name)}/{_file_name(version)}/{uuid.uuid4().hex}"
        model.write().overwrite().save(path)
        revision = 0
        while True:
            record = {"name": name, "version": version, "modeler": modeler, "path": path,
                      "created_at": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds"),
                      "params": json.dumps(params or {}, sort_keys=True, default=str),
                      "inputs": json.dumps(inputs or {}, sort_keys=True), "outputs": json.dumps(outputs or {}, sort_keys=True)}
            try:
                self.folder.create(f"{folder}/{_file_name(version)}.{revision}.json", json.dumps(record, sort_keys=True))
                return path
            except AlreadyExists:
                if not update:
                    self.folder.delete(path)
                    raise ValueError(f"model {name!r} version {version!r} is already published") from None
                revision += 1

    publish = save

    # -- lookup ----------------------------------------------------------
    def entry(self, name: str, version: str | None = None) -> dict:
        """The record of ``name`` (a given version, or the latest by
        publication time)."""
        found = [r for r in self._records(name) if version is None or r["version"] == version]
        if not found:
            raise KeyError(f"no model {name!r} version {version!r}")
        return found[-1]

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(self.entry(name, version)["path"])

    def versions(self, name: str) -> DataFrame:
        return self.table().where(F.col("name") == name).select("version", "modeler", "created_at")


def _file_name(text: str) -> str:
    """A name as one part of a path: ``.``, ``_`` at its begin and all signs with a
    meaning in paths encoded."""
    name = quote(text, safe="").replace(".", "%2E")
    return "%5F" + name[1:] if name.startswith("_") else name

