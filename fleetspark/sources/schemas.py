"""One table from Parquet files whose columns differ: files are grouped by the schema in their footers, each group is read
once, and columns are promoted to a type that holds all values."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Every whole number type holds those before it; unsigned longs arrive as the decimal and have to fit into a long.
WHOLE = ["tinyint", "smallint", "int", "bigint"]
UNSIGNED = "decimal(20,0)"
FRACTIONS = {"float", "double"}
INSTANTS = {"date", "timestamp", "timestamp_ntz"}
THREADS = 16  # footers read at a time


def promoted(types: set[str], column: str = "a column") -> str:
    """The type that holds the values of all ``types``; refuses kinds that do not mix."""
    whole = types & {*WHOLE, UNSIGNED}
    if types == whole and types:
        return "bigint" if UNSIGNED in types else max(types, key=WHOLE.index)
    if types <= whole | FRACTIONS:
        return "float" if types == {"float"} else "double"
    if len(types) == 1:
        return next(iter(types))
    if types <= INSTANTS:
        return "timestamp"
    raise ValueError(f"{column} cannot hold all of {', '.join(sorted(types))}")


def instant(kind: str, column: Column) -> Column:
    """Timestamps as stored, or nanoseconds that arrive as long (spark.sql.legacy.parquet.nanosAsLong), cut to the microsecond.

    Whole numbers throughout: as a double a count of nanoseconds is off by some hundred.
    """
    micros = F.call_function("div", column - F.pmod(column, F.lit(1000)), F.lit(1000))
    return F.timestamp_micros(micros) if kind == "bigint" else column.cast("timestamp")


def parquet_files(spark: SparkSession, pattern: str) -> list[str]:
    """The Parquet files that a glob names, or that lie in folders it names; any file system that Spark reads."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(glob) or []:
        inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [x.getPath().toString() for x in inside if not x.isDirectory() and not x.getPath().getName().startswith(("_", "."))]
    if not found:
        raise ValueError(f"{pattern} names no files")
    return sorted(found)


def by_schema(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """Files with equal schemas together; only footers are read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def schema(file: str) -> str:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(file), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return reader.getFileMetaData().getSchema().toString()
        finally:
            reader.close()

    groups = defaultdict(list)
    with ThreadPoolExecutor(THREADS) as pool:
        for file, found in zip(files, pool.map(schema, files)):
            groups[found].append(file)
    return list(groups.values())


def read_landed(
    spark: SparkSession, pattern: str, required: list[str] = (), instants: list[str] = (), extra: dict[str, Column] | None = None,
) -> DataFrame:
    """All files of a glob as one table: columns that a file lacks are null, types are promoted, ``instants`` are timestamps.

    ``extra`` columns are computed file by file (from ``_metadata``). Refuses a file without a required column, and columns
    whose types do not mix. One read per schema, so the number of scans follows the schemas, not the days.
    """
    frames = []
    for files in by_schema(spark, parquet_files(spark, pattern)):
        df = spark.read.parquet(*files)
        absent = [c for c in required if c not in df.columns]
        if absent:
            raise ValueError(f"{files[0]} has no column {', '.join(absent)}")
        own = [instant(t, F.col(f"`{c}`")).alias(c) if c in instants else F.col(f"`{c}`") for c, t in df.dtypes]
        frames.append(df.select(*own, *(v.alias(k) for k, v in (extra or {}).items())))
    kinds = defaultdict(set)
    for df in frames:
        for name, kind in df.dtypes:
            kinds[name].add(kind)
    target = {name: promoted(found, name) for name, found in kinds.items()}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*((F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in target.items()))

    return reduce(DataFrame.unionByName, map(shaped, frames))
