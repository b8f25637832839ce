"""Keyed upserts as DataFrame merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """`target` after inserting `updates` row by row, overwriting on a known key.

    An unknown key inserts its whole row; a known one overwrites `update_columns` only. Where
    a key occurs more than once in the updates, `order_by` gives the order of arrival: the first
    row inserts, the last one has the final word on the updated columns. Without it, and among rows
    of equal arrival, the rows of a key arrive in the order of their values, so that the result is
    repeatable and a key never occurs twice. Columns missing from the updates are NULL on insert."""
    keys = list(keys)
    columns = [c for c in target.columns if c not in keys]
    given = [c for c in columns if c in updates.columns]
    row = F.struct(*given)
    arrival = F.struct(*order_by, row.alias("_row")) if order_by else row
    folded = updates.groupBy(*keys).agg(
        F.min_by(row, arrival).alias("_first"), F.max_by(row, arrival).alias("_last")
    )
    known = target.select(*keys, F.struct(*columns).alias("_old"))

    def merged(name: str):
        last = F.col(f"_last.{name}") if name in given else None
        first = F.col(f"_first.{name}") if name in given else F.lit(None)
        old = F.col(f"_old.{name}")
        untouched = F.col("_first").isNull()
        if name in update_columns and last is not None:
            return F.when(untouched, old).otherwise(last)
        return F.when(F.col("_old").isNull(), first).otherwise(old)

    joined = known.join(folded, keys, "full_outer")
    types = {f.name: f.dataType for f in target.schema.fields}
    return joined.select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys],
        *[merged(c).cast(types[c]).alias(c) for c in columns],
    ).select(*target.columns)
