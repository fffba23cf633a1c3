"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_CLEANED: set[str] = set()
_SCOPES: list[list[str]] = []

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "fleetspark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; keyword arguments use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Executors have to see it, so a machine-local folder is only made up in local mode.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="fleetspark-")
        root = _LOCAL_SCRATCH[app]
    home = f"{root.rstrip('/')}/fleetspark-{spark.sparkContext.applicationId}"
    if home not in _CLEANED:
        _CLEANED.add(home)
        atexit.register(_remove, spark, home)  # runs before the session's own end
    path = f"{home}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it is in, while the session lives."""
    with contextlib.suppress(Exception):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end: for steps whose result is written elsewhere by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _remove(spark, path)


def stored(df, name: str, **options: str):
    """Write ``df`` to the scratch folder, with the writer's ``options``, and read it back: lineage ends at the table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
