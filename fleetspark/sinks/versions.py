"""Versions of stored tables: a load writes beside the files that count, and a small manifest, put in place last, says which do.

Below the folder of a table, ``data/<load>`` holds what a load wrote and ``_versions/<number>`` which folders make up a
version, with the schema of the table. A load that fails leaves a folder that no version names, so the table stays as it
was. A reader holds the version it began with: no file is ever changed, and files go only by ``drop_versions``.

Two loads at a time: the second to finish is refused, where the file system renames at once (HDFS, local); on others let
one load run at a time. A manifest has a line per folder, one for each day of a daily table and for each append.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

MANIFESTS = "_versions"
LOAD = "_load"  # a column of the folders' names, never of a table


class Conflict(RuntimeError):
    """Another load has put its version in place since this one began."""


@dataclass(frozen=True)
class Version:
    """Which folders below ``data`` make up the table at ``path``; number 0 is the table before its first load."""

    path: str
    number: int
    schema: T.StructType
    folders: tuple[str, ...]

    def read(self, spark: SparkSession, folders: list[str] | None = None) -> DataFrame:
        """The rows of the version, or of some of its folders; columns that files of earlier loads lack are null."""
        chosen = self.folders if folders is None else folders
        if not chosen:
            return spark.createDataFrame([], self.schema)
        base = f"{self.path}/data"
        schema = T.StructType([*self.schema.fields, T.StructField(LOAD, T.StringType())])
        files = spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in chosen))
        return files.select(*self.schema.names)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, files = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions of the table at ``path`` that are still kept, ascending."""
    return sorted(int(n) for n in _names(spark, f"{path}/{MANIFESTS}") if n.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The version of that number, or the latest; None for a table without any."""
    known = versions(spark, path)
    if number is not None and number not in known:
        raise ValueError(f"{path} has no version {number}, but {known}")
    if not known:
        return None
    number = number or known[-1]
    place, files = _file_system(spark, f"{path}/{MANIFESTS}/{number}")
    stream = files.open(place)
    try:
        held = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(path, number, T.StructType.fromJson(held["schema"]), tuple(held["folders"]))


def _widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns and those that are new; a column keeps its type."""
    held = {f.name: f.dataType.simpleString() for f in old}
    changed = [f.name for f in new if held.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if changed:
        raise ValueError(f"columns of another type than the stored ones: {changed}")
    fields = [*old.fields, *(f for f in new if f.name not in held)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


class Load:
    """One load: write below ``target``, then ``commit``; until then no reader sees anything of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.base = version(spark, path)
        others = [n for n in _names(spark, path) if n not in ("data", MANIFESTS)]
        if not self.base and others:
            raise ValueError(f"{path} holds files without versions: {others[:3]}")
        self.name = f"{LOAD}={uuid.uuid4().hex}"
        self.target = f"{path}/data/{self.name}"

    @property
    def held(self) -> tuple[str, ...]:
        return self.base.folders if self.base else ()

    def check(self, schema: T.StructType) -> None:
        """Refuse columns of another type than the stored ones before anything is written."""
        if self.base:
            _widened(self.base.schema, schema)

    def parts(self) -> list[str]:
        """Folders of partitions written so far, such as ``day=2024-01-01``."""
        return [n for n in _names(self.spark, self.target) if "=" in n]

    def commit(self, schema: T.StructType, folders: list[str], replace: bool = False) -> Version:
        """Put a version of these folders in place; with ``replace`` its schema is the new one alone."""
        spark = self.spark
        number = self.base.number + 1 if self.base else 1
        whole = _widened(T.StructType() if replace or not self.base else self.base.schema, schema)
        content = json.dumps({"schema": whole.jsonValue(), "folders": folders}).encode()
        draft, files = _file_system(spark, f"{self.path}/{MANIFESTS}/{self.name}")
        stream = files.create(draft, False)
        try:
            stream.write(content)
        finally:
            stream.close()
        hadoop = spark._jvm.org.apache.hadoop.fs
        strict = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)  # refuses an existing target
        context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, hadoop.Path(f"{self.path}/{MANIFESTS}/{number}"), strict)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                raise Conflict(f"version {number} of {self.path} was made by another load; run this one again") from error
            raise
        return Version(self.path, number, whole, tuple(folders))


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the latest versions, and delete the folders that none of those names; returns these.

    For times without a running load or a reader of an older version; what failed loads left goes too.
    """
    known = versions(spark, path)
    if keep < 1:
        raise ValueError("one version has to stay")
    for number in known[:-keep]:
        place, files = _file_system(spark, f"{path}/{MANIFESTS}/{number}")
        files.delete(place, False)
    wanted = {f for n in known[-keep:] for f in version(spark, path, n).folders}
    dropped = []
    for load in _names(spark, f"{path}/data"):
        if load in wanted:
            continue
        parts = [f"{load}/{n}" for n in _names(spark, f"{path}/data/{load}") if "=" in n]
        unused = [p for p in parts if p not in wanted]
        for folder in [load] if len(unused) == len(parts) else unused:
            place, files = _file_system(spark, f"{path}/data/{folder}")
            files.delete(place, True)
            dropped.append(folder)
    return dropped
