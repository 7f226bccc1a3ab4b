"""Latest row per key (the read side of an upsert table sink, K2).

A table whose inserts replace the row with the same primary key ends up
holding, per key, the last row written. As a query that is the greatest
``struct(order columns..., row)`` per key: ``max`` over a struct is a
decomposable aggregate, so a hot key is combined on the map side and never
gathered into one task or sorted as a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key_cols: str | list[str],
                   order_cols: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols`` (compared in order).

    Ties on all ``order_cols`` are broken by the remaining columns, so the
    answer is deterministic; pass a unique column last to make ties impossible.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    order = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    columns = list(columns or df.columns)
    payload = [c for c in columns if c not in keys]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c) for c in payload if c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_best"))
    field = {c: (f"_o{order.index(c)}" if c in order else c) for c in payload}
    return best.select(*keys, *[F.col("_best").getField(field[c]).alias(c) for c in payload])
