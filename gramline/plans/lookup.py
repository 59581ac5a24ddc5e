"""Joining a large table to a lookup table that has one row per key.

A lookup table is broadcast only when its measured size is under a bound. Beyond the bound, its heavy keys are
broadcast on their own: a key is heavy if more than 1/HEAVY_KEYS of the large table's rows carry it, so there can be at
most HEAVY_KEYS of them, whatever the data. All other keys are light by the same rule, so an ordinary shuffle join
spreads them evenly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HEAVY_KEYS = 20_000
_ROW_OVERHEAD = 32


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values, counted by one aggregation over it."""
    size = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            size = size + F.lit(8)
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "inner",
    weight: str | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Joins `facts` to a written lookup table with unique keys `on`; `how` is inner, left or left_semi.

    `weight` names a column of the table that counts the rows of `facts` per key, or stands for that count.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"join type {how} is not a lookup")
    lookup = table.drop(weight) if weight else table
    if measured_bytes(lookup) <= limit:
        return facts.join(F.broadcast(lookup), on, how)
    if weight is None:
        return facts.join(lookup, on, how)  # a skewed key is left to adaptive execution
    total = table.agg(F.sum(weight)).first()[0]
    heavy = table.filter(F.col(weight) > total / HEAVY_KEYS).drop(weight)
    if measured_bytes(heavy) > limit:
        return facts.join(lookup, on, how)
    light = table.filter(F.col(weight) <= total / HEAVY_KEYS).drop(weight)
    matched = facts.join(F.broadcast(heavy), on, "inner" if how == "left" else how)
    keyed = facts.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    rest = matched.unionByName(keyed.join(F.broadcast(heavy.select(on)), on, "left_anti").join(light, on, how))
    if how != "left":
        return rest
    # Rows without a key match nothing; kept out of the shuffle, they cannot all land in one task.
    unkeyed = facts.filter(" OR ".join(f"`{c}` IS NULL" for c in on))
    return rest.unionByName(unkeyed, allowMissingColumns=True)
