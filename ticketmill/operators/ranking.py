"""Places and running totals in a sorted order, without one task for any group.

Rows are dealt by ranges of (group, order), summed task by task as they stream past, and the
totals of the earlier tasks are added afterwards. A group may span any number of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.session import join_checked, settle


def running_total(rows: DataFrame, group: str, order: list[Column], value: str | None = None, name: str = "place") -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the earlier rows of the same group.

    ``group`` names a string column without nulls, ``order`` sorts within it, ``value`` names a
    long column without nulls (None counts rows, so ``name`` is the place from 0). Rows that tie
    in ``order`` stand in any order, so callers add what tells different rows apart. ``rows`` is
    read twice (once to draw the ranges) and should be settled.
    """
    at = rows.columns.index(group)
    summed = None if value is None else rows.columns.index(value)

    def add(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = batch.column(at).dictionary_encode()
            ids = np.asarray(codes.indices)
            values = np.ones(n, np.int64) if summed is None else np.asarray(batch.column(summed))
            before = np.cumsum(values) - values
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            before = before - np.repeat(before[starts], np.diff(np.r_[starts, n]))
            if codes.dictionary[ids[0]].as_py() == last:
                before[:starts[1] if len(starts) > 1 else n] += carried
            last = codes.dictionary[ids[-1]].as_py()
            carried = int(before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before), pa.array(np.full(n, part, np.int32)), pa.array(values)],
                names=[*batch.schema.names, name, "_part", "_value"])

    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.LongType()), T.StructField("_part", T.IntegerType()),
                           T.StructField("_value", T.LongType())])
    dealt = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    local = settle(dealt.mapInArrow(add, schema), name)
    # One row for each task and group in it: at most as many as tasks and groups together.
    totals = local.groupBy(group, "_part").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(totals.select(group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier")), "offsets")
    joined = join_checked(local, offsets, [group, "_part"], "inner", f"40 + octet_length(`{group}`)")
    return joined.select(*rows.columns, (F.col(name) + F.col("_earlier")).alias(name))
