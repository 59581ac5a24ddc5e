"""Exact running sums inside groups of any size, without sorting or gathering a group.

Rows are summed inside each partition of one written table; only one total per partition and group is shuffled, and
the totals before a partition are added back by a small lookup.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import running
from gramline.plans.lookup import lookup_join
from gramline.plans.storage import written

PART, ROW, START = "part_id", "part_row", "group_start"


def placed(
    df: DataFrame,
    added: T.StructType,
    compute: Callable,
    group: str,
    weight: str | None,
    name: str,
    unkept: tuple[str, ...] = (),
) -> DataFrame:
    """`df` with the columns that `compute(batch) -> {name: array}` makes, an id of the row (`part_id`, `part_row`) and
    `group_start`: the sum of `weight` (1 if None) over earlier rows with the same `group`, a made or own column.

    `group` must hold whole numbers without nulls; columns in `unkept` are for `compute` only. The result is read from
    a written table.
    """
    kept = [f for f in df.schema.fields if f.name not in unkept]
    own = T.StructType(
        [*kept, *added.fields, T.StructField(PART, T.LongType()), T.StructField(ROW, T.LongType()),
         T.StructField(START, T.LongType())]
    )

    def run(batches):
        part, row, totals = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            made = {f.name: np.asarray(v) for f, v in zip(added.fields, compute(batch), strict=True)}
            codes = made[group] if group in made else batch.column(group).to_numpy(zero_copy_only=False)
            n = batch.num_rows
            if weight is None:
                weights = np.ones(n, np.int64)
            else:
                weights = made[weight] if weight in made else batch.column(weight).to_numpy(zero_copy_only=False)
            start = running(codes.astype(np.int64), weights.astype(np.int64), totals)
            new = [pa.array(v) for v in made.values()]
            new += [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(row, row + n)), pa.array(start)]
            row += n
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=own.names)

    table = written(df.mapInArrow(run, own), name)
    size = F.lit(1) if weight is None else F.col(weight)
    totals = table.groupBy(PART, group).agg(F.sum(size).alias("part_total"))
    order = Window.partitionBy(group).orderBy(PART)
    before = written(
        totals.withColumn("part_base", F.coalesce(F.sum("part_total").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(PART, group, "part_base"),
        f"{name}-bases",
    )
    return (
        lookup_join(table, before, [PART, group])
        .withColumn(START, F.col(START) + F.col("part_base"))
        .drop("part_base")
        .select(own.names)
    )
