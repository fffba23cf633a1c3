"""Compare every observation of an entity with the one before it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleetspark.operators.keys import asc
from fleetspark.session import stored


def ordered(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` sorted by ranges of ``keys``, one range per partition and ranges in the order of the partitions."""
    ranged = df.repartitionByRange(partitions, *asc(*keys)) if partitions else df.repartitionByRange(*asc(*keys))
    return ranged.sortWithinPartitions(*asc(*keys))


def _with_previous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the row before them in the partition; its first row is marked, its last one comes again as a mark."""
    part, held = TaskContext.get().partitionId(), None

    def shown(rows: pa.RecordBatch, before: pa.RecordBatch, edge: list) -> pa.RecordBatch:
        previous = pa.StructArray.from_arrays(before.columns, before.schema.names)
        marks = [pa.array(np.full(len(edge), part, np.int32)), pa.array(edge, pa.string())]
        return pa.RecordBatch.from_arrays([*rows.columns, previous, *marks], [*rows.schema.names, "_before", "_part", "_edge"])

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        if held is None:
            yield shown(batch, batch.take(pa.array([None, *range(n - 1)], pa.int64())), ["first", *[None] * (n - 1)])
        else:
            yield shown(batch, pa.concat_batches([held, batch.slice(0, n - 1)]), [None] * n)
        held = batch.slice(n - 1)
    if held is not None:
        yield shown(held, held, ["last"])


def changes(
    df: DataFrame,
    entity: str,
    ts: str,
    carry: list[str],
    keep: Callable[[Column, Column], Column],
    partitions: int | None = None,
) -> DataFrame:
    """(entity, prev, cur) for consecutive observations where ``keep(prev, cur)`` holds.

    ``prev`` and ``cur`` are structs of ``ts`` and the carried columns. Ties on ``ts`` are ordered
    by the carried columns, so equal rows sit next to each other and a pair of different
    neighbours can appear only once: the result needs no DISTINCT.

    A plain LAG per entity would put all rows of a busy entity into one task. Here all rows are
    sorted by ranges of entity, time and the other columns in one shuffle, so a busy entity, even a
    busy hour of one, is spread over as many tasks as it fills. Rows are compared inside their
    partition; changed rows stay where they are, and only the first and last row of each partition
    meet, two rows a partition whatever the data.
    """
    cols = [ts, *carry]
    rows = df.select(entity, *cols)
    seen = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    marked = T.StructType([*seen, T.StructField("_before", seen), T.StructField("_part", T.IntegerType()), T.StructField("_edge", T.StringType())])
    previous = ordered(rows, [entity, *cols], partitions).mapInArrow(_with_previous, marked)
    before = F.struct(*(F.col("_before")[c].alias(c) for c in cols))
    here = F.struct(*cols)
    same = F.col("_before")[entity].eqNullSafe(F.col(entity))
    near = stored(previous.where(F.col("_edge").isNotNull() | (same & keep(before, here))), "changes")
    inside = near.where("_edge IS NULL")
    across = Window.orderBy("_part", "_edge")  # two rows a partition
    ends = near.where("_edge IS NOT NULL").withColumn("_before", F.lag(F.struct(entity, *cols)).over(across))
    ends = ends.where(F.expr("_edge = 'first' AND _before IS NOT NULL")).where(same & keep(before, here))
    both = inside.unionByName(ends)
    return both.select(entity, before.alias("prev"), here.alias("cur"))
